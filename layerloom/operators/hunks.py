"""Line hunks of changed pages, by unique anchors.

Lines that occur once in the old and once in the new text are anchors where their order agrees: the longest
increasing subsequence of their places. Between anchors the equal lines at both ends are taken off and the
rest is searched for anchors again; what has none is one hunk. Pages are rows, so nothing is shuffled.
"""

from __future__ import annotations

from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from layerloom.functions.tasks import text_parts, travels

travels(__name__)

HUNK_TYPE = "array<struct<old_start:bigint,old_lines:bigint,new_start:bigint,new_lines:bigint,removed:string,added:string>>"
HUNK_ARROW = pa.list_(pa.struct(
    [(c, pa.int64()) for c in ("old_start", "old_lines", "new_start", "new_lines")] + [(c, pa.string()) for c in ("removed", "added")]
))


def longest_increasing(places: list[int]) -> list[int]:
    """The positions of a longest increasing subsequence."""
    tails: list[int] = []
    ends: list[int] = []
    before = [-1] * len(places)
    for at, place in enumerate(places):
        n = bisect_left(ends, place)
        before[at] = tails[n - 1] if n else -1
        ends[n : n + 1] = [place]
        tails[n : n + 1] = [at]
    out, at = [], tails[-1] if tails else -1
    while at >= 0:
        out.append(at)
        at = before[at]
    return out[::-1]


def _anchors(old: list[str], new: list[str]) -> list[tuple[int, int]]:
    """Pairs of places of lines that are unique on both sides, in an order common to both."""
    once = [{line for line, n in Counter(side).items() if n == 1} for side in (old, new)]
    place = {line: at for at, line in enumerate(new) if line in once[1]}
    pairs = [(at, place[line]) for at, line in enumerate(old) if line in once[0] and line in place]
    return [pairs[n] for n in longest_increasing([p for _, p in pairs])]


def line_hunks(old: list[str], new: list[str]) -> list[tuple[int, int, int, int]]:
    """Hunks (old start, old lines, new start, new lines), in order and apart."""
    found, todo = [], [(0, len(old), 0, len(new))]
    while todo:
        a, b, c, d = todo.pop()
        while a < b and c < d and old[a] == new[c]:
            a, c = a + 1, c + 1
        while a < b and c < d and old[b - 1] == new[d - 1]:
            b, d = b - 1, d - 1
        if a == b and c == d:
            continue
        anchors = _anchors(old[a:b], new[c:d]) if a < b and c < d else []
        if not anchors:
            found.append((a, b - a, c, d - c))
            continue
        edges = [(a, c), *[(a + x, c + y) for x, y in anchors], (b, d)]
        # From the last to the first, so that the stack gives them in order; an anchor is equal and needs no hunk.
        for n in range(len(edges) - 2, -1, -1):
            skip = 1 if n else 0
            todo.append((edges[n][0] + skip, edges[n + 1][0], edges[n][1] + skip, edges[n + 1][1]))
    return found


def applied_hunks(old: str, hunks: list) -> str:
    """The new text, from the old one and its hunks."""
    lines, out, at = old.split("\n"), [], 0
    for hunk in hunks:
        out += lines[at : hunk["old_start"]]
        out += hunk["added"].split("\n") if hunk["new_lines"] else []
        at = hunk["old_start"] + hunk["old_lines"]
    return "\n".join([*out, *lines[at:]])


def _hunks(old: str | None, new: str | None) -> list[dict]:
    a, b = (old or "").split("\n"), (new or "").split("\n")
    return [
        {"old_start": s, "old_lines": n, "new_start": t, "new_lines": m, "removed": "\n".join(a[s : s + n]), "added": "\n".join(b[t : t + m])}
        for s, n, t, m in line_hunks(a, b)
    ]


def change_hunks(log: DataFrame) -> DataFrame:
    """A change log with its ``hunks`` in place of the texts; a missing text is one empty line.

    Line numbers count from 0. Texts that differ have a hunk, equal ones none.
    """
    others = [c for c in log.columns if c not in ("before", "after")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_parts(batch, ["before", "after"]):
                found = [_hunks(old, new) for old, new in zip(part.column("before").to_pylist(), part.column("after").to_pylist())]
                yield pa.RecordBatch.from_arrays([*[part.column(c) for c in others], pa.array(found, HUNK_ARROW)], names=[*others, "hunks"])

    schema = T.StructType([*[log.schema[c] for c in others], T.StructField("hunks", T.DataType.fromDDL(HUNK_TYPE))])
    return log.select(*others, "before", "after").mapInArrow(run, schema)


def patched(pages: DataFrame, hunks: DataFrame, key: str = "path", text: str = "text") -> DataFrame:
    """The pages with their hunks applied; pages without a row in ``hunks`` stay as they are."""
    own = pages.columns
    joined = pages.join(hunks.select(key, F.col("hunks").alias("_hunks")), key, "left").select(*own, "_hunks")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_parts(batch, [text]):
                bodies, found = part.column(text).to_pylist(), part.column("_hunks").to_pylist()
                made = [applied_hunks(old or "", h) if h is not None else old for old, h in zip(bodies, found)]
                columns = [pa.array(made, pa.string()) if c == text else part.column(c) for c in own]
                yield pa.RecordBatch.from_arrays(columns, names=own)

    return joined.mapInArrow(run, T.StructType([T.StructField(f.name, f.dataType) for f in pages.schema]))


def hunk_rows(changes: DataFrame, key: str = "path") -> DataFrame:
    """A row per hunk, numbered from 1 within its page."""
    rows = changes.select(key, F.posexplode("hunks").alias("_at", "_h"))
    return rows.select(key, (F.col("_at") + 1).cast("bigint").alias("hunk"), "_h.*")
