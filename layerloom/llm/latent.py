"""Benchmark decontamination by latent semantic retrieval.

Passages are windows of ``2 * BLOCK`` words at every ``BLOCK`` words. A first pass counts in how
many passages each hashed term occurs and multiplies the transposed passage-term matrix with a
random sparse sign matrix (one entry per passage): the range finder of a randomised SVD. Its sums
are ``TERMS`` x ``SKETCH`` numbers, whatever the size of the corpus; term weights scale its rows,
and its singular vectors span the latent space. A second pass projects every passage, compares it
by cosine with the benchmark's passages and verifies each candidate on its words: shared term
weight, longest common subsequence, then the item's most informative words.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from layerloom.llm.byte_text import row_words
from layerloom.llm.common import guarded, text_of, travels

travels(__name__)

TERMS = 1 << 13
SKETCH = 256
RANK = 240
# Leading directions left out: they tell languages apart, not passages.
COMMON = 4
BLOCK = 16
# Passages compared with the benchmark at once in a task.
PASSAGES = 1024

MIN_COSINE = 0.5
# A candidate needs this share of the item's term weight (of a passage of the item, if that is
# shorter) in its passage before its words are compared in order.
MIN_OVERLAP = 0.35
# An item is leaked where this share of its words occurs in order, ...
LCS_SHARE = 0.7
# ... or this share, if its answer words are there too.
LCS_WITH_ANSWER = 0.5
ANSWER_WORDS = 5
ANSWER_SHARE = 0.8


def _blocks(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of words grouped by row: the block of each word, the first word of each block, and whether
    the next block is in the same row."""
    first = np.flatnonzero(np.append(True, rows[1:] != rows[:-1]))
    inside = np.arange(len(rows)) - np.repeat(first, np.diff(np.append(first, len(rows))))
    start = inside % BLOCK == 0
    begin = np.flatnonzero(start)
    joined = np.append(rows[begin[1:]] == rows[begin[:-1]], False)
    return np.cumsum(start) - 1, begin, joined


def _term(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(40)).astype(np.int64) % TERMS


def _chunks(column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    for row, _, h, r in row_words(column):
        if len(h):
            yield row, h, r


def _block_sums(table: np.ndarray, term: np.ndarray, begin: np.ndarray) -> np.ndarray:
    """Sums of the rows ``table[term]`` over blocks; the last row of the table is zero."""
    size = np.diff(np.append(begin, len(term)))
    total = np.zeros((len(begin), table.shape[1]), np.float32)
    for k in range(BLOCK):
        place = np.minimum(begin + k, len(term) - 1)
        total += np.take(table, np.where(k < size, term[place], len(table) - 1), axis=0)
    return total


def _passage_sums(block_sums: np.ndarray, joined: np.ndarray) -> np.ndarray:
    """The sum of each block and the next one of its row: one passage for every block."""
    out = block_sums.copy()
    at = np.flatnonzero(joined)
    out[at] += block_sums[at + 1]
    return out


def _sketch_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per task: passages with each term and the term's row of the sketch; the passage count last."""
    found = np.zeros(TERMS, np.int64)
    sketch = np.zeros(TERMS * SKETCH, np.int64)
    passages = 0
    for batch in batches:
        for _, h, r in _chunks(batch.column(0)):
            term = _term(h)
            block, begin, joined = _blocks(r)
            # A passage draws its column and sign from its words: the same in every run.
            draw = _passage_sums(np.add.reduceat(h, begin)[:, None], joined)[:, 0] * np.uint64(0x9E3779B97F4A7C15)
            column = ((draw >> np.uint64(40)) % np.uint64(SKETCH)).astype(np.int64)
            sign = (draw >> np.uint64(63)).astype(np.int64) * 2 - 1
            # A word is in the passage of its block and in that of the block before.
            np.add.at(sketch, term * SKETCH + column[block], sign[block])
            back = np.append(False, joined[:-1])[block]
            before = np.maximum(block - 1, 0)[back]
            np.add.at(sketch, term[back] * SKETCH + column[before], sign[before])
            order = np.argsort(term.astype(np.uint16), kind="stable")
            t, b = term[order], block[order]
            fresh = np.append(True, (t[1:] != t[:-1]) | (b[1:] != b[:-1]))
            found += np.bincount(t[fresh], minlength=TERMS)
            passages += len(begin)
    seen = np.flatnonzero(found)
    rows = np.concatenate([sketch.reshape(TERMS, SKETCH)[seen], np.zeros((1, SKETCH), np.int64)])
    lists = pa.ListArray.from_arrays(pa.array(np.arange(0, rows.size + 1, SKETCH), pa.int32()), pa.array(rows.ravel()))
    yield pa.RecordBatch.from_arrays(
        [pa.array(np.append(seen, TERMS), pa.int32()), pa.array(np.append(found[seen], passages), pa.int64()), lists],
        names=["term", "n", "y"],
    )


def corpus_model(docs: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Term weights (inverse passage frequency) and ``TERMS`` x rank projection of all documents."""
    partial = docs.select(text_of().alias("text")).mapInArrow(_sketch_task, "term int, n bigint, y array<bigint>")
    sums = partial.groupBy("term").agg(
        F.sum("n").alias("n"), F.array(*[F.sum(F.get("y", F.lit(k))) for k in range(SKETCH)]).alias("y")
    )
    found = np.zeros(TERMS + 1)
    sketch = np.zeros((TERMS + 1, SKETCH))
    for term, n, y in sums.toLocalIterator():
        found[term], sketch[term] = n, y
    passages = max(found[-1], 1.0)
    weight = np.log((1 + passages) / (1 + found[:-1])).astype(np.float32)
    left, single, _ = np.linalg.svd(sketch[:-1] * weight[:, None], full_matrices=False)
    keep = np.flatnonzero(single > single.max() * 1e-6)[:RANK]
    keep = keep[COMMON:] if len(keep) > 2 * COMMON else keep
    # Rows of W V / sigma: a passage's term counts times this are its whitened latent coordinates.
    whitened = left[:, keep] / np.maximum(single[keep], 1e-30) * np.sqrt(passages)
    return weight, np.ascontiguousarray(weight[:, None] * whitened, dtype=np.float32)


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12)


class Items:
    """The benchmark: word hashes of each item, its passages, and bit masks for the verification."""

    def __init__(self, ids: list[int], texts: list[str | None]):
        words: list[np.ndarray] = [np.zeros(0, np.uint64) for _ in ids]
        for row, n, h, r in row_words(pa.array(texts, pa.string())):
            for k in range(n):
                words[row + k] = h[r == k]
        held = [(i, w) for i, w in zip(ids, words) if len(w)]
        self.ids = [i for i, _ in held]
        self.words = [w for _, w in held]
        self.passages: list[tuple[int, np.ndarray]] = []
        for k, w in enumerate(self.words):
            spans = {(0, len(w))} | {(a, a + 2 * BLOCK) for a in range(0, len(w) - 2 * BLOCK + 1, BLOCK)}
            spans |= {(len(w) - 2 * BLOCK, len(w))} if len(w) > 2 * BLOCK else set()
            self.passages += [(k, w[a:b]) for a, b in sorted(spans)]
        self.masks: list[dict[int, int]] = []
        for w in self.words:
            mask: dict[int, int] = {}
            for k, x in enumerate(w.tolist()):
                mask[x] = mask.get(x, 0) | 1 << k
            self.masks.append(mask)

    def answers(self, weight: np.ndarray) -> list[set[int]]:
        """The most informative words of each item."""
        return [
            set(sorted(set(w.tolist()), key=lambda x: (-float(weight[_term(np.array([x], np.uint64))[0]]), x))[:ANSWER_WORDS])
            for w in self.words
        ]

    def latent(self, projection: np.ndarray) -> np.ndarray:
        rows = [projection[_term(w)].sum(axis=0) for _, w in self.passages]
        return _unit(np.array(rows, np.float32).reshape(len(rows), projection.shape[1]))

    def shares(self, weight: np.ndarray) -> np.ndarray:
        """Per passage and term: the term's share of the passage's weight, 0 where it lacks the term."""
        out = np.zeros((len(self.passages), TERMS), np.float32)
        for k, (_, w) in enumerate(self.passages):
            terms = np.unique(_term(w))
            out[k, terms] = weight[terms] / max(float(weight[terms].sum()), 1e-9)
        return out


def common_subsequence(words: list[int], mask: dict[int, int], size: int) -> int:
    """Length of the longest common subsequence with an item, one machine addition per word."""
    full = (1 << size) - 1
    row = full
    for x in words:
        hit = row & mask.get(x, 0)
        row = ((row + hit) | (row - hit)) & full
    return size - row.bit_count()


def _search_task(items: Items, queries: np.ndarray, projection: np.ndarray, weight: np.ndarray, min_cosine: float):
    owner = np.array([k for k, _ in items.passages])
    table = np.concatenate([projection, np.zeros((1, projection.shape[1]), np.float32)])
    answers, shares = items.answers(weight), items.shares(weight).ravel()

    def verified(words: list[int], item: int) -> tuple[float, float] | None:
        size = len(items.words[item])
        share = common_subsequence(words, items.masks[item], size) / size
        answer = len(answers[item].intersection(words)) / len(answers[item])
        good = share >= LCS_SHARE or share >= LCS_WITH_ANSWER and answer >= ANSWER_SHARE
        return (share, answer) if good else None

    def candidates(latent: np.ndarray, terms: np.ndarray) -> Iterator[tuple[int, int, float]]:
        """Passages and items that are close by cosine and share enough of their term weight.

        ``terms`` holds the sorted terms of each passage, repeats replaced by -1.
        """
        cosine = latent @ queries.T
        at, q = np.divmod(np.flatnonzero(cosine.ravel() >= min_cosine), len(queries))
        for cut in range(0, len(at), 1 << 16):
            a, b = at[cut : cut + (1 << 16)], q[cut : cut + (1 << 16)]
            there = terms[a]
            overlap = (shares[there + (b * TERMS)[:, None]] * (there >= 0)).sum(axis=1)
            near = np.flatnonzero(overlap >= MIN_OVERLAP)
            yield from zip(a[near].tolist(), owner[b[near]].tolist(), cosine[a[near], b[near]].tolist())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found: dict[tuple[int, int], tuple[float, float, float]] = {}
            for row, h, r in _chunks(batch.column(0)):
                term = _term(h)
                _, begin, joined = _blocks(r)
                last = np.append(begin[1:], len(h))
                ends = last.copy()
                ends[joined] = last[np.flatnonzero(joined) + 1]
                for a in range(0, len(begin), PASSAGES):
                    b = min(a + PASSAGES, len(begin))
                    # One block more, for the last passage of this run.
                    more = min(b + 1, len(begin))
                    lo, hi = begin[a], last[more - 1]
                    sums = _block_sums(table, term[lo:hi], begin[a:more] - lo)
                    latent = _unit(_passage_sums(sums, np.append(joined[a : more - 1], False))[: b - a])
                    place = begin[a:b, None] + np.arange(2 * BLOCK)
                    inside = place < ends[a:b, None]
                    terms = np.sort(np.where(inside, term[np.minimum(place, len(term) - 1)], -1), axis=1)
                    terms[:, 1:][terms[:, 1:] == terms[:, :-1]] = -1
                    best: dict[tuple[int, int], float] = {}
                    for p, k, c in candidates(latent, terms):
                        best[p + a, k] = max(best.get((p + a, k), 0.0), c)
                    for (p, k), c in best.items():
                        size, doc = len(items.words[k]), int(r[begin[p]])
                        left, right = max(0, int(begin[p]) - size), min(len(h), int(ends[p]) + size)
                        ok = verified(h[left:right][r[left:right] == doc].tolist(), k)
                        if ok:
                            found[row + doc, k] = max(found.get((row + doc, k), (0.0, 0.0, 0.0)), (*ok, c))
            keys = sorted(found)
            rest = batch.select(range(1, batch.num_columns)).take(pa.array([k[0] for k in keys], pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [
                    *rest.columns,
                    pa.array([items.ids[k[1]] for k in keys], pa.int64()),
                    pa.array([round(found[k][2], 6) for k in keys], pa.float64()),
                    pa.array([found[k][0] for k in keys], pa.float64()),
                    pa.array([found[k][1] for k in keys], pa.float64()),
                ],
                names=[*rest.schema.names, "item_id", "cosine", "lcs_share", "answer_share"],
            )

    return run


def leaks(docs: DataFrame, benchmark: DataFrame, keep: str = "doc_id bigint", min_cosine: float = MIN_COSINE) -> DataFrame:
    """Pairs of a document and a benchmark item it holds: the kept columns, ``item_id``, ``cosine``,
    ``lcs_share`` (share of the item's words found in order) and ``answer_share``.

    The benchmark is the query set: its items are read to the driver, as many as they are, and
    sent to the tasks; the documents are never gathered. Null or empty texts on either side match
    nothing; repeated rows and repeated items each have their own pairs; an empty benchmark or
    table gives an empty result.
    """
    names = [part.split()[0] for part in keep.split(",")]
    rows = benchmark.select(F.col("item_id").cast("bigint"), text_of().alias("text")).orderBy("item_id", "text").collect()
    items = Items([r[0] for r in rows], [r[1] for r in rows])
    schema = f"{keep}, item_id bigint, cosine double, lcs_share double, answer_share double"
    if not items.ids:
        return docs.sparkSession.createDataFrame([], schema)
    weight, projection = corpus_model(docs)
    task = _search_task(items, items.latent(projection), projection, weight, min_cosine)
    return docs.select(text_of().alias("_searched"), *names).mapInArrow(task, schema)


def without_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents that hold no benchmark item, with their own columns.

    Documents are told apart by their text, so null and repeated ids are safe; null or empty texts
    hold no item; an empty table gives an empty result.
    """
    plain, own = guarded(docs)
    hashed = plain.withColumn("_hash", F.xxhash64(text_of()))
    found = leaks(hashed, benchmark, "_hash bigint").select("_hash").distinct()
    return hashed.join(found, "_hash", "left_anti").select(*own)
