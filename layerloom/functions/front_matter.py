"""Reading typed values out of a page's front matter."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from layerloom.functions.text import group, text_or_null, unquote

TOP_LEVEL_LINE = r"(?m)^\w+:.*$"

# Quote mark, item; a wikilink gives its target alone. Word characters, with which no end begins, are taken at once.
LIST_ITEM = (
    r"""(?m)^[ \t]*-[ \t]+(["']?)(?:\[\[(?=.*\]\]))?(\w*+.*?)(?:(?:[|#].*)?\]\])?\1[ \t]*$"""
)


def _unquoted(value: Column) -> Column:
    """A trimmed value without the two equal quotes around it."""
    mark, size = F.left(value, F.lit(1)), F.length(value)
    quoted = (size > 1) & mark.isin("'", '"') & (F.right(value, F.lit(1)) == mark)
    return F.when(quoted, F.substr(value, F.lit(2), size - 2)).otherwise(value)


def entries(front_matter: Column) -> Column:
    """All top-level ``key: value`` lines, as parallel arrays, in one look at the text.

    The pattern takes whole lines: one that takes them apart goes back at every character of a value.
    """
    lines = F.regexp_extract_all(front_matter, F.lit(TOP_LEVEL_LINE), F.lit(0))

    def parts(found: Column) -> Column:
        values = F.transform(found, lambda x: F.btrim(F.substr(x, F.instr(x, ":") + 1), F.lit(" \t")))
        return F.struct(
            F.transform(found, lambda x: F.substring_index(x, ":", 1)).alias("keys"),
            F.transform(values, _unquoted).alias("values"),
        )

    # The lines are named once.
    return F.get(F.transform(F.array(lines), parts), F.lit(0))


def scalar(found: Column, key: str) -> Column:
    """Value of a top-level key without its quotes; null when absent or empty."""
    at = F.nullif(F.array_position(found["keys"], F.lit(key)), F.lit(0)).cast("int")
    return text_or_null(F.try_element_at(found["values"], at))


def value(front_matter: Column, key: str) -> Column:
    """What ``scalar`` gives for one key, looked up in the text; cheaper where a query reads few of them."""
    return group(front_matter, rf"""(?m)^{re.escape(key)}:[ \t]*(["']?)(\w*+.*?)\1[ \t]*$""", 2)


def block_list(front_matter: Column, key: str) -> Column:
    """Items under a key; an empty, inline-empty or absent list gives an empty array.

    The block is taken line by line, up to the next one that begins with a word character.
    """
    block = F.regexp_extract(
        front_matter,
        rf"(?m)^{re.escape(key)}:[ \t]*$\n((?:^(?!\w).*+(?:\r\n|[\n\r\u0085\u2028\u2029])?+)*+)", 1,
    )
    found = F.regexp_extract_all(block, F.lit(LIST_ITEM), F.lit(2))
    return F.coalesce(found, F.array().cast("array<string>"))


def nested(front_matter: Column, key: str) -> Column:
    """Scalar of an indented key, such as the chapter under ``timeline``."""
    return text_or_null(unquote(group(front_matter, rf"(?m)^[ \t]+{re.escape(key)}:[ \t]*(.*)$")))


def inline_map(front_matter: Column, key: str) -> Column:
    """Text between the braces of an indented inline map."""
    return F.regexp_extract(front_matter, rf"(?m)^[ \t]+{re.escape(key)}:[ \t]*\{{(.*)\}}[ \t]*$", 1)


def provenance(inside: Column) -> Column:
    """Struct of the text of an inline map ``kind: ..., id: ..., date: ...``."""

    def field(name: str) -> Column:
        return group(inside, rf"""(?:^|,)[ \t]*{name}:[ \t]*(["']?)([^,]*?)\1[ \t]*(?=,|$)""", 2)

    return F.struct(
        field("kind").alias("kind"),
        field("id").alias("id"),
        F.to_date(field("date")).alias("date"),
    )
