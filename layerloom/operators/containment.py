"""What a link stands in: its heading path and its generated block.

Headings open spans that end at the next heading of their level or above; generated blocks are spans of their
own. Spans and links of a page are put in order and swept once with a stack of open spans.
"""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from layerloom.functions.explode import explode_rows
from layerloom.functions.rewrite import WIKILINK
from layerloom.functions.tasks import travels
from layerloom.operators.structure import BLOCK

travels(__name__)

HEADING = r"(?m)^(#{1,6}) ([^\n]*)$"
BLOCK_NAME = r"\A<!-- AUTO-GENERATED:(\w+) -->"
SEPARATOR = " > "

FOUND_TYPE = "array<struct<target:string,path:string,block:string>>"


def spans(body: str) -> list[tuple[int, int, str, str]]:
    """(begin, end, kind, name) of the sections and generated blocks of a page."""
    heads = [(m.start(), len(m[1]), m[2]) for m in re.finditer(HEADING, body)]
    found, open_heads = [], []
    for begin, level, title in [*heads, (len(body), 0, "")]:
        while open_heads and open_heads[-1][1] >= level:
            start, _, name = open_heads.pop()
            found.append((start, begin, "heading", name))
        open_heads.append((begin, level, title))
    for m in re.finditer(BLOCK, body):
        name = re.match(BLOCK_NAME, m[0])
        found.append((m.start(), m.end(), "block", name[1] if name else "auto"))
    # An outer span before the ones inside it.
    return sorted(found, key=lambda s: (s[0], -s[1]))


def contained(body: str) -> list[dict]:
    """The links of a page in order, each with the names of the spans around it."""
    out, stack, rest = [], [], spans(body)[::-1]
    for link in re.finditer(WIKILINK, body):
        while rest and rest[-1][0] <= link.start():
            stack.append(rest.pop())
        # Sections and blocks may cross, so a span below the top can end first.
        stack = [s for s in stack if s[1] > link.start()]
        blocks = [name for _, _, kind, name in stack if kind == "block"]
        path = SEPARATOR.join(name for _, _, kind, name in stack if kind == "heading")
        out.append({"target": link[1].strip(" "), "path": path, "block": blocks[-1] if blocks else None})
    return out


def _contained(bodies: pd.Series) -> pd.Series:
    return pd.Series([contained(b) if b is not None else [] for b in bodies], dtype=object)


def link_sections(pages: DataFrame, page_id: str = "page_id", body: str = "body") -> DataFrame:
    """``page_id``, ``pos``, ``target``, heading ``path`` and generated ``block`` of every wikilink in a body.

    ``pos`` counts the links of the body from 1, as link extraction does. A link before any heading has an
    empty path, one outside generated blocks a null block.
    """
    found = pages.select(F.col(page_id).alias("page_id"), F.pandas_udf(_contained, FOUND_TYPE)(F.col(body)).alias("_links"))
    rows = explode_rows(found, "_links", "page_id", item="_l")
    return rows.select("page_id", (F.col("_at") + 1).cast("bigint").alias("pos"), "_l.target", "_l.path", "_l.block")
