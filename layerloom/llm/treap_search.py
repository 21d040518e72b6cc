"""Ranked lexical search over a term-document grid kept as K2-treaps.

The rows of the grid are terms, its columns documents, a cell holds the impact of a term in a document. Each
block of documents is one square grid cut into quarters again and again; per level only the non-empty cells
are kept, each with a mask of its non-empty quarters (from which the places of its children follow) and the
largest impact below it. An item is a set of weighted rows. Its search holds document ranges with the cell
that each of its rows has there; the weighted sum of their maxima bounds every score in the range. The
ranges of the highest bounds are halved first, all rows descending together, until no bound can reach the
k-th score found; a range of one document has its exact score.

Tasks read texts once, as (row, occurrences) lists of the terms asked for, which are kept in the shared
folder; counts over all documents follow from them, then the grids. A task holds one block of documents and
k results per item, k rows per task and item are shuffled. Items are answered in parts of ``ITEM_BYTES``.

A null text has no term, documents without terms count nowhere, rows alike in everything are documents of
their own, a null doc_id ranks last among equal scores. A null item text has no result; items alike in id and
text are one; without documents or items there are no rows. Other columns do not matter.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from layerloom.llm.byte_text import pieces, rows_of
from layerloom.llm.common import pick, stored, text_of, travels

travels(__name__)

K = 10
# Documents of one grid, and text of the items answered at once.
BLOCK_DOCS = 1 << 16
ITEM_BYTES = 1 << 22
# Occurrences of terms that a grid takes, unless one document has more.
BLOCK_HITS = 1 << 21
# Ranges halved at a time, and cells that the waiting ranges of one search may name before it goes deep first.
BEAM = 64
HELD_CELLS = 1 << 22

# A term: characters that are neither ASCII punctuation nor ASCII controls, A-Z in lower case.
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

HITS = "doc_id bigint, n bigint, rows array<int>, tf array<int>"
GRID = "docs binary, none binary, side int, masks array<binary>, maxima array<binary>"
FOUND = "item int, doc_id bigint, score bigint"

_BASE = np.uint64(0x9E3779B97F4A7C15)


def _word_bytes() -> tuple[np.ndarray, np.ndarray]:
    """Lower case of A-Z, and which bytes belong to terms: bytes of other than ASCII characters do."""
    lower = np.arange(256, dtype=np.uint8)
    lower[65:91] += 32
    inside = np.zeros(256, dtype=bool)
    inside[48:58] = inside[65:91] = inside[97:123] = inside[128:] = True
    return lower, inside


class Vocabulary:
    """The terms asked for, found among the words of many texts at once, byte for byte."""

    def __init__(self, terms: list[str]) -> None:
        raw = [t.encode() for t in terms]
        self.size = np.array([len(t) for t in raw], np.int64)
        self.begin = np.concatenate([[0], np.cumsum(self.size)]).astype(np.int64)
        self.bytes = np.frombuffer(b"".join(raw) or b"\0", np.uint8)
        hashes = np.array([self._hash_one(np.frombuffer(t, np.uint8)) for t in raw], np.uint64)
        self.order = np.argsort(hashes, kind="stable")
        self.hashes = hashes[self.order]

    @staticmethod
    def _hash_one(data: np.ndarray) -> np.uint64:
        powers = np.full(len(data), _BASE)
        powers[0] = 1
        with np.errstate(over="ignore"):
            return ((data.astype(np.uint64) + np.uint64(1)) * np.multiply.accumulate(powers)).sum(dtype=np.uint64)

    def find(self, low: np.ndarray, begin: np.ndarray, size: np.ndarray, sums: np.ndarray, down: np.ndarray) -> np.ndarray:
        """The term of each word, -1 for other words."""
        out = np.full(len(begin), -1, np.int64)
        if not len(self.hashes) or not len(begin):
            return out
        hashed = (sums[begin + size] - sums[begin]) * down[begin]
        at = np.searchsorted(self.hashes, hashed)
        # Terms of one hash stand side by side: try each of them.
        todo = np.flatnonzero((at < len(self.hashes)) & (self.hashes[np.minimum(at, len(self.hashes) - 1)] == hashed))
        while len(todo):
            term = self.order[at[todo]]
            same = self.size[term] == size[todo]
            for length in np.unique(size[todo][same]):
                k = np.flatnonzero(same & (size[todo] == length))
                step = np.arange(length)
                equal = (low[begin[todo[k]][:, None] + step] == self.bytes[self.begin[term[k]][:, None] + step]).all(axis=1)
                same[k] = equal
            out[todo[same]] = term[same]
            todo = todo[~same]
            at[todo] += 1
            todo = todo[at[todo] < len(self.hashes)]
            todo = todo[self.hashes[at[todo]] == hashed[todo]]
        return out


def _powers(n: int, kept: dict) -> tuple[np.ndarray, np.ndarray]:
    if len(kept.get("up", ())) <= n:
        for name, base in (("up", _BASE), ("down", np.uint64(pow(int(_BASE), -1, 1 << 64)))):
            powers = np.full(n + 1, base)
            powers[0] = 1
            kept[name] = np.multiply.accumulate(powers)
    return kept["up"][:n], kept["down"][: n + 1]


def term_hits(docs: DataFrame, terms: list[str]) -> DataFrame:
    """``doc_id``, ``n`` (terms of the text, with repeats), ``rows`` and ``tf`` (terms asked for, by number) of texts with terms."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted, kept = Vocabulary(terms), {}
        lower, inside = _word_bytes()
        stride = np.int64(len(terms) + 1)
        for batch in batches:
            data, at = rows_of(batch.column("text"))
            count = np.zeros(len(at) - 1, np.int64)
            keys, times = [], []
            # A long text goes in several pieces, cut at spaces: no term is cut.
            for row, part, offsets in pieces(data, at):
                low = lower[part]
                word = inside[low]
                before = np.concatenate([[False], word[:-1]])
                before[offsets[1:-1][offsets[1:-1] < len(word)]] = False
                after = np.concatenate([word[1:], [False]])
                ends = offsets[1:-1][offsets[1:-1] > 0] - 1
                after[ends] = False
                begin, end = np.flatnonzero(word & ~before), np.flatnonzero(word & ~after) + 1
                up, down = _powers(len(low), kept)
                sums = np.zeros(len(low) + 1, np.uint64)
                np.cumsum((low.astype(np.uint64) + np.uint64(1)) * up, out=sums[1:])
                owner = np.searchsorted(offsets, begin, side="right") - 1 + row
                count += np.bincount(owner, minlength=len(count))
                term = wanted.find(low, begin, end - begin, sums, down)
                hit = term >= 0
                key, n = np.unique(owner[hit] * stride + term[hit], return_counts=True)
                keys.append(key)
                times.append(n)
            key, where = np.unique(np.concatenate([*keys, np.zeros(0, np.int64)]), return_inverse=True)
            tf = np.bincount(where, weights=np.concatenate([*times, np.zeros(0)]), minlength=len(key)).astype(np.int32)
            has = np.flatnonzero(count)
            place = np.searchsorted(key // stride, np.arange(len(count) + 1))
            listed = np.concatenate([[0], np.cumsum((place[1:] - place[:-1])[has])]).astype(np.int32)
            # A text with a hit has terms, so the hits of texts without terms are none.
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").take(pa.array(has)), pa.array(count[has]),
                    pa.ListArray.from_arrays(pa.array(listed), pa.array((key % stride).astype(np.int32))),
                    pa.ListArray.from_arrays(pa.array(listed), pa.array(tf)),
                ],
                names=["doc_id", "n", "rows", "tf"],
            )

    return docs.select(pick(docs, "doc_id", "bigint"), text_of().alias("text")).mapInArrow(work, HITS)


def corpus_counts(hits: DataFrame, n_terms: int) -> tuple[int, int, np.ndarray]:
    """Documents with terms, all their terms, and the documents of each term asked for."""
    total = hits.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df = np.zeros(n_terms, np.int64)
        for batch in batches:
            df += np.bincount(batch.column("rows").flatten().to_numpy(zero_copy_only=False), minlength=n_terms)
        some = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(df[some])], names=["row", "df"])

    df = np.zeros(n_terms, np.int64)
    for r in hits.select("rows").mapInArrow(work, "row bigint, df bigint").groupBy("row").agg(F.sum("df").alias("df")).collect():
        df[r["row"]] = r["df"]
    return total[0], total[1], df


def treap(rows: np.ndarray, columns: np.ndarray, impact: np.ndarray, side: int) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Masks and maxima of the non-empty cells, level by level from the whole grid of ``2 ** side`` to single cells."""
    place = np.zeros(len(rows), np.int64)
    for bit in range(side):
        place |= ((columns >> bit) & 1) << (2 * bit) | ((rows >> bit) & 1) << (2 * bit + 1)
    order = np.argsort(place)
    cells, high = place[order], impact[order]
    maxima, masks = [high.astype(np.int32)], []
    for _ in range(side):
        parents, first = np.unique(cells >> 2, return_index=True)
        masks.append(np.bitwise_or.reduceat(np.left_shift(1, cells & 3), first).astype(np.uint8))
        high = np.maximum.reduceat(high, first)
        maxima.append(high.astype(np.int32))
        cells = parents
    return masks[::-1], maxima[::-1]


def grids(hits: DataFrame, n_docs: int, n_terms_seen: int, n_rows: int, block_docs: int = BLOCK_DOCS) -> DataFrame:
    """A K2-treap per block of documents: its ids in order, the level masks and maxima.

    The impact of a term is ``(10**9 * tf) div (1000 * tf + 8 * m)`` with the length norm
    ``m = 10 + (90 * n * N) div L``.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def built(held: list[pa.RecordBatch]) -> pa.RecordBatch:
            table = pa.Table.from_batches(held)
            ids = table.column("doc_id")
            none = ids.is_null().to_numpy().astype(bool)
            doc = ids.fill_null(0).to_numpy()
            order = np.lexsort((doc, none))
            column = np.empty(len(order), np.int64)
            column[order] = np.arange(len(order))
            norm = 10 + (90 * table.column("n").to_numpy() * n_docs) // n_terms_seen
            lists = table.column("rows").combine_chunks()
            lists = pa.concat_arrays(lists.chunks) if isinstance(lists, pa.ChunkedArray) else lists
            owner = np.repeat(np.arange(len(doc)), lists.value_lengths().to_numpy())
            row = lists.flatten().to_numpy().astype(np.int64)
            counts = table.column("tf").combine_chunks()
            counts = pa.concat_arrays(counts.chunks) if isinstance(counts, pa.ChunkedArray) else counts
            tf = counts.flatten().to_numpy().astype(np.int64)
            impact = (1_000_000_000 * tf) // (1000 * tf + 8 * norm[owner])
            side = max(n_rows - 1, len(doc) - 1, 1).bit_length()
            masks, maxima = treap(row, column[owner], impact, side) if len(row) else ([], [])
            packed = lambda parts: pa.array([[p.tobytes() for p in parts]], pa.list_(pa.binary()))
            columns = [pa.array([doc[order].tobytes()], pa.binary()), pa.array([none[order].tobytes()], pa.binary()), pa.array([side], pa.int32())]
            return pa.RecordBatch.from_arrays([*columns, packed(masks), packed(maxima)], names=["docs", "none", "side", "masks", "maxima"])

        held, size, named = [], 0, 0
        step = min(block_docs, 1 << 10)
        for batch in batches:
            for at in range(0, batch.num_rows, step):
                part = batch.slice(at, step)
                more = len(part.column("rows").flatten())
                if size and (size + part.num_rows > block_docs or named + more > BLOCK_HITS):
                    yield built(held)
                    held, size, named = [], 0, 0
                held.append(part)
                size, named = size + part.num_rows, named + more
        if size:
            yield built(held)

    return hits.mapInArrow(work, GRID)


class Best:
    """The k best documents of an item so far: by score, then null ids last, then by id."""

    def __init__(self, k: int) -> None:
        self.k = k
        self.score, self.none, self.doc = np.zeros(0, np.int64), np.zeros(0, bool), np.zeros(0, np.int64)

    def add(self, score: np.ndarray, none: np.ndarray, doc: np.ndarray) -> None:
        score, none, doc = np.concatenate([self.score, score]), np.concatenate([self.none, none]), np.concatenate([self.doc, doc])
        top = np.lexsort((doc, none, -score))[: self.k]
        self.score, self.none, self.doc = score[top], none[top], doc[top]

    def may_enter(self, bound: np.ndarray, none: np.ndarray, doc: np.ndarray) -> np.ndarray:
        """Whether a document of at most this score, and of this id or a later one, can still enter."""
        if len(self.score) < self.k:
            return bound > 0
        last, last_none, last_doc = self.score[-1], self.none[-1], self.doc[-1]
        earlier = (none < last_none) | ((none == last_none) & (doc < last_doc))
        return (bound > last) | ((bound == last) & earlier)


class Grid:
    """A K2-treap opened for search; where the children of a cell begin follows from the masks before it."""

    def __init__(self, docs: bytes, none: bytes, side: int, masks: list[bytes], maxima: list[bytes]) -> None:
        self.docs, self.none, self.side = np.frombuffer(docs, np.int64), np.frombuffer(none, bool), side
        self.masks = [np.frombuffer(m, np.uint8) for m in masks]
        self.maxima = [np.frombuffer(m, np.int32) for m in maxima]
        self.ones = np.array([bin(m).count("1") for m in range(16)], np.int64)
        self.children = [np.cumsum(self.ones[m]) - self.ones[m] for m in self.masks]

    def _halved(self, level: int, cells: np.ndarray, rows: np.ndarray, right: int) -> np.ndarray:
        """The cell of every row in one half of each range, -1 where it is empty."""
        quarter = (((rows >> (self.side - 1 - level)) & 1) << 1 | right)[None, :]
        mask = np.where(cells >= 0, self.masks[level][cells], 0)
        child = self.children[level][cells] + self.ones[mask & ((1 << quarter) - 1)]
        return np.where((mask >> quarter) & 1 == 1, child, -1)

    def search(self, rows: np.ndarray, weights: np.ndarray, best: Best, beam: int = BEAM) -> int:
        """Bring the best documents of an item into ``best``; returns how many ranges were halved.

        Documents are columns in the order of ties, so the first document of a range speaks for it.
        """
        if not self.masks:
            return 0

        def bounded(level: int, cells: np.ndarray) -> np.ndarray:
            return (np.where(cells >= 0, self.maxima[level][cells], 0).astype(np.int64) * weights).sum(axis=1)

        whole = np.zeros((1, len(rows)), np.int64)
        pools = [None] * (self.side + 1)
        pools[0] = (bounded(0, whole), np.zeros(1, np.int64), whole)
        done, widest = 0, max(1, HELD_CELLS // (64 * len(rows)))
        while True:
            tops = [int(p[0].max()) if p is not None and len(p[0]) else -1 for p in pools]
            highest = max(tops)
            if highest <= 0:
                return done
            # Of the levels with the highest bound the deepest one ends soonest. An item of very many rows
            # that has too many ranges waiting goes on with the deepest ones, which ends in as many documents.
            full = sum(p[2].size for p in pools if p is not None) > HELD_CELLS
            level = max(n for n, t in enumerate(tops) if t == highest or full and t > 0)
            bound, column, cells = pools[level]
            first = column << (self.side - level)
            live = best.may_enter(bound, self.none[first], self.docs[first])
            bound, column, cells = bound[live], column[live], cells[live]
            chosen = np.lexsort((column, -bound))
            now, later = chosen[: min(beam, widest)], chosen[min(beam, widest) :]
            pools[level] = (bound[later], column[later], cells[later])
            if not len(now):
                continue
            done += len(now)
            halves = [(column[now] << 1 | right, self._halved(level, cells[now], rows, right)) for right in (0, 1)]
            column, cells = (np.concatenate([h[k] for h in halves]) for k in (0, 1))
            bound = bounded(level + 1, cells)
            some = np.flatnonzero(bound > 0)
            bound, column, cells = bound[some], column[some], cells[some]
            if level + 1 == self.side:
                best.add(bound, self.none[column], self.docs[column])
                continue
            old = pools[level + 1]
            new = (bound, column, cells)
            pools[level + 1] = new if old is None else tuple(np.concatenate([a, b]) for a, b in zip(old, new))


def search_grids(blocks: DataFrame, items: list[tuple[np.ndarray, np.ndarray]], k: int = K) -> DataFrame:
    """The k best documents per task for items given as rows and weights: ``item`` (its place), ``doc_id``, ``score``."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = [Best(k) for _ in items]
        for batch in batches:
            for block in range(batch.num_rows):
                grid = Grid(*[batch.column(c)[block].as_py() for c in ("docs", "none", "side", "masks", "maxima")])
                for (rows, weights), top in zip(items, best):
                    if len(rows):
                        grid.search(rows, weights, top)
        for at, top in enumerate(best):
            if len(top.score):
                ids = pa.array(top.doc, mask=top.none)
                yield pa.RecordBatch.from_arrays([pa.array([at] * len(top.score), pa.int32()), ids, pa.array(top.score)], names=["item", "doc_id", "score"])

    return blocks.mapInArrow(work, FOUND)


def item_terms(text: str) -> list[str]:
    """The distinct terms of an item."""
    lower, inside = _word_bytes()
    data = lower[np.frombuffer(text.encode(), np.uint8)]
    spaced = np.where(inside[data], data, 32).astype(np.uint8).tobytes()
    return sorted({w.decode() for w in spaced.split(b" ") if w})


def _answered(docs: DataFrame, asked: list, k: int) -> DataFrame | None:
    """Ranks for a bounded list of items (item_id, text)."""
    found = [item_terms(r["text"]) for r in asked]
    terms = sorted({t for f in found for t in f})
    if not terms:
        return None
    number = {t: n for n, t in enumerate(terms)}
    hits = stored(term_hits(docs, terms))
    n_docs, n_seen, df = corpus_counts(hits, len(terms))
    if not n_docs:
        return None
    weight = np.floor(1000 * np.log((2.0 * n_docs + 2) / (2.0 * df + 1))).astype(np.int64)
    rows = [np.array([number[t] for t in f], np.int64) for f in found]
    items = [(r[df[r] > 0], weight[r[df[r] > 0]]) for r in rows]
    top = search_grids(grids(hits, n_docs, n_seen, len(terms)), items, k)
    names = docs.sparkSession.createDataFrame([(n, r["item_id"]) for n, r in enumerate(asked)], "item int, item_id bigint")
    order = W.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    ranked = top.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.join(F.broadcast(names), "item").select("item_id", "rank", "doc_id", "score")


def search(docs: DataFrame, items: DataFrame, k: int = K, item_bytes: int = ITEM_BYTES) -> DataFrame:
    """``item_id``, ``rank``, ``doc_id`` and ``score`` of the k best documents of every item with a score above 0.

    With N documents that have a term and L terms in them: a term in df of them weighs
    ``floor(1000 * ln((2N + 2) / (2 df + 1)))``, a score sums weight times impact (see ``grids``) over the
    distinct terms of the item. Equal scores rank by doc_id.
    """
    asked = items.select(pick(items, "item_id", "bigint"), pick(items, "text", "string")).filter("text IS NOT NULL").distinct()
    size = asked.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    parts = max(1, -(-size // item_bytes))
    share = F.pmod(F.xxhash64("item_id", "text"), F.lit(parts))
    result = docs.sparkSession.createDataFrame([], "item_id bigint, rank int, doc_id bigint, score bigint")
    for part in range(parts):
        rows = sorted(asked.filter(share == part).collect(), key=lambda r: (r["item_id"] is None, r["item_id"], r["text"]))
        answer = _answered(docs, rows, k)
        result = result if answer is None else result.unionByName(answer)
    return result
