"""Fill-in-the-middle rows: a text is cut at two line ends and its parts change places.

A text is its UTF-8 bytes in fixed blocks. Two Fenwick trees over the blocks hold how many lines end in
each and how many code points begin in each. A cut after line u is found by binary-lifting descent to the
block in which line u ends, then by looking for that end inside the block alone; the code points before a
cut are a prefix sum of blocks and a count inside one. Rows are independent: no shuffle, and memory is
bounded by an Arrow batch.

Null and empty texts have no line and stay plain; a null id is read as an empty one; repeated rows are cut
alike; a table without rows gives none. Other columns do not travel: the result holds only its own.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from layerloom.llm.byte_text import rows_of
from layerloom.llm.common import pick, text_of, travels

travels(__name__)

# Bytes of a block.
BLOCK = 1 << 10
# Bytes of output texts that a task holds before it passes them on.
HELD_BYTES = 1 << 24

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"

SCHEMA = "doc_id bigint, n bigint, form string, prefix_chars bigint, middle_chars bigint, output string"


@dataclass(frozen=True)
class Settings:
    """How texts are cut: the seed of the draws, rates in percent and the three marks."""

    seed: int = 7
    rate: int = 100
    spm_rate: int = 50
    prefix: str = PREFIX
    suffix: str = SUFFIX
    middle: str = MIDDLE

    def __post_init__(self) -> None:
        marks = (self.prefix, self.suffix, self.middle)
        if not all(marks) or any(a in b for i, a in enumerate(marks) for j, b in enumerate(marks) if i != j):
            raise ValueError("marks must not be empty or hold each other")
        if any(a[:n] == b[-n:] for a in marks for b in marks for n in range(1, min(len(a), len(b)))):
            raise ValueError("no mark may begin as one ends")


class Fenwick:
    """Sums over blocks: ``before(i)`` of the first i, ``reach(t)`` the first block at which the sum is t."""

    def __init__(self, counts: np.ndarray) -> None:
        n = len(counts)
        sums = np.concatenate([[0], np.cumsum(counts, dtype=np.int64)])
        at = np.arange(1, n + 1)
        self.tree = np.concatenate([[0], sums[at] - sums[at - (at & -at)]])
        self.step = 1 << (n.bit_length() - 1) if n else 0

    def before(self, i: int) -> int:
        total = 0
        while i:
            total += int(self.tree[i])
            i &= i - 1
        return total

    def reach(self, wanted: int) -> tuple[int, int]:
        """The number of blocks whose sum stays below ``wanted``, and that sum."""
        at, total, step = 0, 0, self.step
        while step:
            if at + step < len(self.tree) and total + self.tree[at + step] < wanted:
                at += step
                total += int(self.tree[at])
            step >>= 1
        return at, total


class Lines:
    """One text as blocks of bytes with the two trees."""

    def __init__(self, data: np.ndarray) -> None:
        self.data = data
        edges = np.arange(0, len(data), BLOCK)
        ends, begins = data == 10, (data & 0xC0) != 0x80
        count = lambda marks: np.add.reduceat(marks, edges, dtype=np.int64) if len(edges) else np.zeros(0, np.int64)
        self.ends, self.points = Fenwick(count(ends)), Fenwick(count(begins))
        self.closed = int(ends.sum())
        # The last line may lack its end.
        self.n = self.closed + int(len(data) > 0 and data[-1] != 10)

    def cut(self, unit: int) -> int:
        """The byte after line ``unit``."""
        if unit <= 0:
            return 0
        if unit > self.closed:
            return len(self.data)
        block, below = self.ends.reach(unit)
        inside = np.flatnonzero(self.data[block * BLOCK : (block + 1) * BLOCK] == 10)
        return block * BLOCK + int(inside[unit - below - 1]) + 1

    def chars(self, byte: int) -> int:
        """Code points before a byte."""
        block = byte // BLOCK
        part = self.data[block * BLOCK : byte]
        return self.points.before(block) + int(((part & 0xC0) != 0x80).sum())


def draws(seed: int, doc_id: int | None) -> list[int]:
    """Four numbers of 32 bits for a document."""
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    return [int(digest[k : k + 8], 16) for k in (0, 8, 16, 24)]


def transform(doc_id: int | None, data: np.ndarray, how: Settings) -> tuple[int, str, int | None, int | None, bytes]:
    """Lines, form, code points of prefix and middle, and the output of one text."""
    lines, raw = Lines(data), data.tobytes()
    marks = [m.encode() for m in (how.prefix, how.suffix, how.middle)]
    h = draws(how.seed, doc_id)
    if not raw or any(m in raw for m in marks) or h[2] % 100 >= how.rate:
        return lines.n, "plain", None, None, raw
    first, second = sorted((h[0] % (lines.n + 1), h[1] % (lines.n + 1)))
    a, b = lines.cut(first), lines.cut(second)
    before = lines.chars(a)
    parts = [marks[0] + raw[:a], marks[1] + raw[b:], marks[2] + raw[a:b]]
    form = "spm" if h[3] % 100 < how.spm_rate else "psm"
    if form == "spm":
        parts[:2] = parts[1::-1]
    return lines.n, form, before, lines.chars(b) - before, b"".join(parts)


def fill_in_middle(docs: DataFrame, how: Settings = Settings()) -> DataFrame:
    """``doc_id``, ``n`` lines, ``form``, ``prefix_chars``, ``middle_chars`` and the ``output`` text of every document.

    Forms are ``plain`` (the text), ``psm`` (prefix, suffix, middle, each after its mark) and ``spm`` (suffix,
    prefix, middle). A text that is empty or holds a mark is plain.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def packed(rows: list) -> pa.RecordBatch:
            ids, n, form, prefix, middle, out = zip(*rows)
            texts = pa.array(out, pa.large_binary()).cast(pa.large_string())
            columns = [pa.array(ids, pa.int64()), pa.array(n, pa.int64()), pa.array(form, pa.string()), pa.array(prefix, pa.int64()), pa.array(middle, pa.int64()), texts.cast(pa.string())]
            return pa.RecordBatch.from_arrays(columns, names=["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"])

        for batch in batches:
            data, at = rows_of(batch.column("text"))
            held, size = [], 0
            for k, doc_id in enumerate(batch.column("doc_id").to_pylist()):
                held.append((doc_id, *transform(doc_id, data[at[k] : at[k + 1]], how)))
                size += len(held[-1][-1])
                if size > HELD_BYTES:
                    yield packed(held)
                    held, size = [], 0
            if held:
                yield packed(held)

    return docs.select(pick(docs, "doc_id", "bigint"), text_of().alias("text")).mapInArrow(work, SCHEMA)


def restored(output: Column, form: Column, how: Settings = Settings()) -> Column:
    """The text that an output was made of, read back from the output and its form alone."""
    p, s, m = (F.lit(x) for x in (how.prefix, how.suffix, how.middle))
    after = lambda mark: F.locate(mark, output) + len(mark)
    between = lambda mark, stop: F.substr(output, F.lit(after(mark)), F.locate(stop, output) - after(mark))
    tail = F.substr(output, F.lit(after(how.middle)))
    psm = F.concat(between(how.prefix, how.suffix), tail, between(how.suffix, how.middle))
    spm = F.concat(between(how.prefix, how.middle), tail, between(how.suffix, how.prefix))
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)


def digests(rows: DataFrame, how: Settings = Settings()) -> DataFrame:
    """The rows of ``fill_in_middle`` with checksums in place of texts: of the output and of the text rebuilt from it."""
    sha = lambda text: F.sha2(text.cast("binary"), 256)
    return rows.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars",
        sha(F.col("output")).alias("output_sha256"), sha(restored(F.col("output"), F.col("form"), how)).alias("restored_sha256"),
    )
