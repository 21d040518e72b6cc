"""Search of a name ledger of any size in page texts.

The ledger is cut into shards of at most ``SHARD_NAMES`` names, which travel to the tasks packed, with the sorted
hashes of all names and marks of the hashes of what names begin with. A task takes a piece of its texts at a time
as bytes and follows all places where a name may begin byte by byte, as long as the marks allow; names found by
their hash are read from the shards and compared. The work on a piece so depends on its own length, besides
reading the shards. Texts are searched and rewritten where they lie, and nothing is shuffled. Beyond
``PASS_SHARDS`` shards the ledger does not travel at once: every such part of it is searched by automata in a
pass of its own that leaves a row of hits per distinct text in a kept table, and a text meets its rows of all
passes in one join.

Hits belong to texts, not to page ids: pages that repeat, or share an id, are pages of their own.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Iterable, Iterator
from functools import partial
from itertools import count

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from layerloom.functions.skew import join_dimension
from layerloom.functions.tasks import kept, travels

travels(__name__)

# Names of one automaton, and shards that travel at once. Read when a function runs, so a deployment or a test
# may set them here.
SHARD_NAMES = 200_000
PASS_SHARDS = 64

# Characters of the texts that go through the shards together (bytes, where they lie), and texts that are returned together.
PIECE_CHARS = 1_000_000
RETURNED_TEXTS = 128
# Bytes that are copied at once.
COPIED = 1 << 18

# Names are compared with a piece by at most so many first bytes, each length as a bit of their hash.
PREFIX_BYTES = 12
MARK_BITS = 23
# Most bits by which the marks of an index know a hash: 16 MB for what names begin with, 8 MB for whole names.
PREFIX_MARKS = 27
NAME_MARKS = 26

AUDIT_STRUCT = "struct<name:string,representative:string,confidence:string,replaced:bigint>"
REWRITTEN_TYPE = f"struct<text:string,audit:array<{AUDIT_STRUCT}>>"
NOTES_TYPE = "array<struct<at:string,name:string,representative:string>>"
NORMALIZED_TYPE = f"struct<text:string,audit:array<{AUDIT_STRUCT}>,notes:{NOTES_TYPE}>"


def one_per_name(ledger: DataFrame, columns: list[str]) -> DataFrame:
    """``name`` and ``columns``, one row per name: of rows alike in name the one with the smallest columns."""
    usable = ledger.filter(F.col("name").isNotNull() & (F.col("name") != ""))
    return usable.groupBy("name").agg(F.min(F.struct(*columns)).alias("_r")).select("name", "_r.*")


def text_key(text: Column) -> Column:
    return F.md5(F.coalesce(text, F.lit("")))


def _automaton(names: list[tuple]):
    import ahocorasick

    found = ahocorasick.Automaton()
    for name, first, second in names:
        found.add_word(name, (len(name), first, second))
    found.make_automaton()
    return found


def longest_hits(automaton, text: str, longest: dict[int, tuple[int, str, str]]) -> None:
    """For every place where a name begins, the longest one: its length and its two values."""
    for end, hit in automaton.iter(text):
        start = end - hit[0] + 1
        if start not in longest or longest[start][0] < hit[0]:
            longest[start] = hit


def rewrite(text: str, hits: dict[int, tuple[int, str, str]], protected: re.Pattern) -> tuple[str, list[tuple]]:
    """One pass from left to right: the leftmost of a protected span and a name, the longest name at its place.

    Returns the new text and the audit rows by falling count, ties in the order the names first occur.
    """
    parts, counts, values = [], Counter(), {}
    at, shield = 0, protected.search(text)
    for start in sorted(hits):
        if start < at:
            continue
        # A span found earlier may begin inside a name that was replaced since; then it is none.
        while shield and shield.start() <= start:
            if shield.start() < at:
                shield = protected.search(text, at)
                continue
            parts.append(text[at : shield.end()])
            at = shield.end()
            shield = protected.search(text, at)
        if start < at:
            continue
        length, representative, confidence = hits[start]
        name = text[start : start + length]
        parts += [text[at:start], representative]
        counts[name] += 1
        values[name] = (representative, confidence)
        at = start + length
    parts.append(text[at:])
    # A stable sort: names of one count stay in the order they first occur.
    return "".join(parts), [(n, *values[n], c) for n, c in sorted(counts.items(), key=lambda x: -x[1])]


def names_held(automaton, text: str, held: set[tuple]) -> None:
    """The distinct names of a text: their first value, which is a sort key in text form, the name, their second."""
    held.update((first, text[end - size + 1 : end + 1], second) for end, (size, first, second) in automaton.iter(text))


def _hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For 1, 2, ... bytes from ``starts``: which still lie before ``ends``, and their hashes."""
    at, value = np.arange(len(starts)), np.zeros(len(starts), np.uint32)
    for n in range(PREFIX_BYTES):
        inside = starts[at] + n < ends[at]
        at, value = at[inside], value[inside]
        value = (value + data[starts[at] + n] + np.uint32(1)) * np.uint32(2_654_435_761)
        value ^= value >> np.uint32(15)
        yield at, value >> np.uint32(32 - MARK_BITS)


def _marks(texts: list[str], firsts: np.ndarray) -> np.ndarray:
    """The hashes of what begins in the texts with one of the bytes ``firsts``."""
    marks = np.zeros(1 << MARK_BITS, bool)
    for text in texts:
        data = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
        starts = np.flatnonzero(firsts[data])
        for _, value in _hashes(data, starts, np.full(len(starts), len(data))):
            marks[value] = True
    return marks


def _bytes_of(names: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of the names and where each begins, with the end of the last."""
    column = names.column("name").combine_chunks()
    _, offsets, data = column.buffers()
    edges = np.frombuffer(offsets, np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    return np.frombuffer(data, np.uint8), edges


def _prefix_hash(names: pa.Table) -> np.ndarray:
    """The hash of the first bytes of every name; one with fewer bytes has that of its last."""
    data, edges = _bytes_of(names)
    last = np.zeros(len(names), np.uint32)
    for at, value in _hashes(data, edges[:-1], edges[1:]):
        last[at] = value
    return last


class Shards:
    """A packed ledger, or a part of it, in a task."""

    def __init__(self, packed: list[bytes], firsts: np.ndarray) -> None:
        self.packed, self.firsts, self.only = packed, firsts, None
        self.hashes = [_prefix_hash(_unpacked(part)) for part in packed] if len(packed) > 1 else []

    def automata(self, texts: list[str]) -> Iterator:
        """Automata that together find every name of the ledger in the texts."""
        if len(self.packed) == 1:
            if self.only is None:
                self.only = _automaton(_rows(_unpacked(self.packed[0])))
            yield self.only
            return
        marks, waiting = _marks(texts, self.firsts), []
        for part, hashes in zip(self.packed, self.hashes):
            # All names that occur are among these.
            waiting += _rows(_unpacked(part).filter(pa.array(marks[hashes])))
            if len(waiting) >= SHARD_NAMES:
                yield _automaton(waiting)
                waiting = []
        if waiting:
            yield _automaton(waiting)


def _unpacked(part: bytes) -> pa.Table:
    return pa.ipc.open_stream(part).read_all()


def _rows(names: pa.Table) -> list[tuple]:
    return list(zip(*[c.to_pylist() for c in names.columns]))


def _packed(names: DataFrame, shards: int, wanted: Iterable[int]) -> tuple[list[bytes], np.ndarray]:
    """The shards as Arrow streams, and which bytes their names begin with. One shard is in the driver unpacked."""
    parts, firsts = [], np.zeros(256, bool)
    for shard in wanted:
        mine = names.filter(F.pmod(F.xxhash64("name"), F.lit(shards)) == shard) if shards > 1 else names
        table = mine.toArrow().cast(pa.schema([(c, pa.string()) for c in names.columns]))
        if not len(table):
            continue
        data, edges = _bytes_of(table)
        firsts[data[edges[:-1]]] = True
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, table.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
            out.write_table(table)
        parts.append(sink.getvalue().to_pybytes())
    return parts, firsts


class Marks:
    """A set of 64-bit hashes by their first bits: what is not marked is not in it."""

    def __init__(self, bits: int, known: np.ndarray | None = None) -> None:
        self.bits, self.known = bits, np.zeros(1 << bits, bool) if known is None else known

    def add(self, values: np.ndarray) -> None:
        self.known[values >> np.uint64(64 - self.bits)] = True

    def packed(self) -> tuple[int, np.ndarray]:
        return self.bits, np.packbits(self.known, bitorder="little")

    def have(self, values: np.ndarray) -> np.ndarray:
        """Of packed marks."""
        at = values >> np.uint64(64 - self.bits)
        return (self.known[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 == 1


def _levels(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, seed: int, marks: Marks | None = None) -> Iterator[tuple]:
    """For 1, 2, ... bytes from ``starts``: the length, which still lie before ``ends`` and are marked, and their 64-bit hashes."""
    at, value = np.arange(len(starts)), np.full(len(starts), seed, np.uint64)
    for n in count(1):
        inside = starts[at] + n <= ends[at]
        at, value = at[inside], value[inside]
        if not len(at):
            return
        value = (value + data[starts[at] + n - 1] + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
        value ^= value >> np.uint64(32)
        if marks is not None:
            known = marks.have(value)
            at, value = at[known], value[known]
        yield n, at, value


def _same(data: np.ndarray, at: np.ndarray, other: np.ndarray, other_at: np.ndarray, n: int) -> np.ndarray:
    """Whether the ``n`` bytes of ``data`` from each place ``at`` are those of ``other`` from ``other_at``."""
    same = np.ones(len(at), bool)
    for k in range(n):
        same &= data[at + k] == other[other_at + k]
    return same


def _indexed(names: DataFrame, shards: int, bits: int = 64) -> tuple:
    """What an ``Index`` needs; a shard at a time is in the driver unpacked. ``bits``: of the hashes that tell names apart."""
    size = names.agg(F.count("*"), F.sum(F.octet_length("name"))).first()
    name_bits, prefix_bits = (max(16, (8 * n).bit_length()) for n in size)
    packed, firsts = _packed(names, shards, range(shards))
    for seed in count():
        begins, ends = Marks(min(prefix_bits, PREFIX_MARKS)), Marks(min(name_bits, NAME_MARKS))
        hashes, bounds = [], [0]
        for part in packed:
            data, edges = _bytes_of(_unpacked(part))
            last = np.zeros(len(edges) - 1, np.uint64)
            for _, at, value in _levels(data, edges[:-1], edges[1:], seed):
                begins.add(value)
                last[at] = value
            ends.add(last)
            hashes.append(last)
            bounds.append(bounds[-1] + len(last))
        values = np.concatenate(hashes)
        order = np.argsort(values)
        values, kept_bits = values[order], np.uint64(64 - bits)
        # Two names of one hash: other hashes.
        if not (values[1:] >> kept_bits == values[:-1] >> kept_bits).any():
            return seed, packed, firsts, bounds, values, order.astype(np.uint32), begins.packed(), ends.packed()


class Index:
    """A packed ledger as it is searched in place."""

    def __init__(self, seed: int, packed: list[bytes], firsts: np.ndarray, bounds: list[int], hashes: np.ndarray, places: np.ndarray, begins: tuple, ends: tuple) -> None:
        self.seed, self.packed, self.firsts, self.bounds, self.hashes, self.places = seed, packed, firsts, bounds, hashes, places
        self.begins, self.ends = Marks(*begins), Marks(*ends)

    def _read(self, places: np.ndarray) -> pa.Table:
        """The names at sorted places."""
        found = []
        for part, first, last in zip(self.packed, self.bounds, self.bounds[1:]):
            low, high = np.searchsorted(places, [first, last])
            if low < high:
                found.append(_unpacked(part).take(pa.array(places[low:high].astype(np.int64) - first)))
        return pa.concat_tables(found or [_unpacked(self.packed[0]).slice(0, 0)])

    def search(self, data: np.ndarray, edges: np.ndarray) -> tuple[np.ndarray, list[tuple], pa.Table]:
        """Where names may begin in the texts between ``edges``; per length which of these do begin one, and its row; the rows."""
        starts = np.flatnonzero(self.firsts[data])
        ends = edges[np.searchsorted(edges, starts, "right")]
        found = []
        for n, at, value in _levels(data, starts, ends, self.seed, self.begins):
            whole = self.ends.have(value)
            found.append((n, at[whole], value[whole]))
        values, row = np.unique(np.concatenate([v for _, _, v in found] or [np.zeros(0, np.uint64)]), return_inverse=True)
        slot = np.minimum(np.searchsorted(self.hashes, values), len(self.hashes) - 1)
        known = self.hashes[slot] == values
        places, rank = np.unique(self.places[slot[known]], return_inverse=True)
        names = self._read(places)
        number = np.full(len(values), -1)
        number[known] = rank
        body, begin = _bytes_array(names.column("name").combine_chunks())
        hits, done = [], 0
        for n, at, value in found:
            mine = number[row[done : done + len(at)]]
            done += len(at)
            at, mine = at[mine >= 0], mine[mine >= 0]
            fits = begin[mine + 1] - begin[mine] == n
            at, mine = at[fits], mine[fits]
            same = _same(data, starts[at], body, begin[mine], n)
            hits.append((n, at[same], mine[same]))
        return starts, hits, names


def _picked(data: bytes, begin: int, end: int, hits: list[tuple[int, int]], protected: re.Pattern) -> list[int]:
    """Which hits (place and length, in order) ``rewrite`` replaces in the text from ``begin`` to ``end``."""
    picked, at, shield = [], begin, protected.search(data, begin, end)
    for k, (start, length) in enumerate(hits):
        if start < at:
            continue
        while shield and shield.start() <= start:
            if shield.start() >= at:
                at = shield.end()
            shield = protected.search(data, at, end)
        if start >= at:
            picked.append(k)
            at = start + length
    return picked


def _replaced(data: np.ndarray, edges: np.ndarray, starts: np.ndarray, hits: list[tuple], protected: re.Pattern) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Place, length and row of the names that are replaced, as by ``rewrite``."""
    size, row = np.zeros(len(starts), np.int64), np.zeros(len(starts), np.int64)
    for n, at, mine in hits:
        size[at], row[at] = n, mine
    place, size, row = starts[size > 0], size[size > 0], row[size > 0]
    body = data.tobytes()
    spans = [m.span() for a, b in zip(edges.tolist(), edges.tolist()[1:]) for m in protected.finditer(body, a, b) if m.end() > m.start()]
    span = np.array([*spans, (len(body), len(body))], np.int64)
    after = np.searchsorted(span[:, 0], place, "right")
    hidden = (after > 0) & (place < span[after - 1, 1])
    # Texts in which a name reaches into a protected span or another name are gone through in order.
    shown = np.flatnonzero(~hidden)
    reach = np.maximum.accumulate(place[shown] + size[shown]) if len(shown) else shown
    meets = span[after[shown], 0] < place[shown] + size[shown]
    meets[1:] |= place[shown][1:] < reach[:-1]
    text = np.searchsorted(edges, place, "right") - 1
    chosen = ~hidden
    for k in np.unique(text[shown[meets]]).tolist():
        first, last = np.searchsorted(place, edges[[k, k + 1]])
        chosen[first:last] = False
        mine = list(zip(place[first:last].tolist(), size[first:last].tolist()))
        chosen[first + np.array(_picked(body, int(edges[k]), int(edges[k + 1]), mine, protected), np.int64)] = True
    return place[chosen], size[chosen], row[chosen]


def _bytes_array(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of the texts, null ones without any, and where each begins, with the end of the last."""
    if not len(texts):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    _, offsets, data = texts.buffers()
    edges = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    body = np.frombuffer(data, np.uint8)[edges[0] : edges[-1]] if edges[-1] > edges[0] else np.zeros(0, np.uint8)
    return body, edges - edges[0]


def _listed(item: np.ndarray, texts: pa.Array, rows: pa.StructArray) -> pa.Array:
    """A list per text of its ``rows``, whose texts ``item`` has in order; null texts have none."""
    edges = np.searchsorted(item, np.arange(len(texts) + 1)).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(edges, mask=np.append(texts.is_null().to_numpy(zero_copy_only=False), False)), rows)


def _joined(data: np.ndarray, source: np.ndarray, length: np.ndarray) -> np.ndarray:
    """The stretches of ``data`` one after the other."""
    ends = np.cumsum(length)
    out, first = np.empty(ends[-1], np.uint8), 0
    while first < len(length):
        begin = ends[first] - length[first]
        last = max(first + 1, int(np.searchsorted(ends, begin + COPIED, "right")))
        at = np.arange(begin, ends[last - 1])
        out[begin : ends[last - 1]] = data[at + np.repeat(source[first:last] - (ends[first:last] - length[first:last]), length[first:last])]
        first = last
    return out


def _rewritten(index: Index, texts: pa.Array, protected: re.Pattern) -> pa.Array:
    """``REWRITTEN_TYPE`` of every text."""
    data, edges = _bytes_array(texts)
    starts, hits, names = index.search(data, edges)
    place, size, row = _replaced(data, edges, starts, hits, protected)
    new, new_at = _bytes_array(names.column("representative").combine_chunks())
    # The new texts: what stands before each name, and its representative, by turns.
    begin = np.concatenate([[0], place + size])
    source = np.stack([begin, np.append(new_at[row] + len(data), 0)], axis=1).ravel()
    length = np.stack([np.append(place, len(data)) - begin, np.append(new_at[row + 1] - new_at[row], 0)], axis=1).ravel()
    body = _joined(np.concatenate([data, new]), source, length)
    item = np.searchsorted(edges, place, "right") - 1
    grown = np.bincount(item, new_at[row + 1] - new_at[row] - size, minlength=len(texts)).astype(np.int64)
    out = np.concatenate([[0], np.cumsum(np.diff(edges) + grown)])
    null = texts.is_null().to_numpy(zero_copy_only=False)
    valid = pa.array(~null).buffers()[1]
    made = pa.LargeStringArray.from_buffers(len(texts), pa.py_buffer(out), pa.py_buffer(body), valid, int(null.sum())).cast(pa.string())
    # Audit rows by falling count, ties in the order the names first occur.
    held, first, times = np.unique(item * max(len(names), 1) + row, return_index=True, return_counts=True)
    order = np.lexsort((first, -times, item[first]))
    mine = names.take(pa.array(row[first[order]]))
    columns = [mine.column(c).combine_chunks() for c in ("name", "representative", "confidence")]
    audit = pa.StructArray.from_arrays([*columns, pa.array(times[order].astype(np.int64))], ["name", "representative", "confidence", "replaced"])
    return pa.StructArray.from_arrays([made, _listed(item[first[order]], texts, audit)], ["text", "audit"], mask=pa.array(null))


def _noted(index: Index, texts: pa.Array) -> pa.Array:
    """The notes of every text: (at, name, representative) of the names it holds, in that order."""
    data, edges = _bytes_array(texts)
    starts, hits, names = index.search(data, edges)
    order = pc.sort_indices(names, [("at", "ascending"), ("name", "ascending")]).to_numpy()
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(len(order))
    text = np.searchsorted(edges, starts, "right") - 1
    held = np.unique(np.concatenate([text[at] * max(len(names), 1) + rank[row] for _, at, row in hits] or [np.zeros(0, np.int64)]))
    mine = names.take(pa.array(order[held % max(len(names), 1)]))
    columns = [mine.column(c).combine_chunks() for c in ("at", "name", "representative")]
    return _listed(held // max(len(names), 1), texts, pa.StructArray.from_arrays(columns, ["at", "name", "representative"]))


def _in_pieces(batches: Iterator[pa.Array], work: Callable[[pa.Array], pa.Array]) -> Iterator[pa.Array]:
    """What ``work`` makes of the texts, about ``PIECE_CHARS`` bytes at a time."""
    held, size = [], 0
    for batch in batches:
        batch = batch.cast(pa.large_string())
        ends = np.cumsum(pc.fill_null(pc.binary_length(batch), 0).to_numpy(zero_copy_only=False).astype(np.int64))
        at = 0
        while at < len(batch):
            last = min(len(batch), 1 + int(np.searchsorted(ends, (ends[at - 1] if at else 0) + PIECE_CHARS - size)))
            held.append(batch.slice(at, last - at))
            size += int(ends[last - 1] - (ends[at - 1] if at else 0))
            at = last
            if size >= PIECE_CHARS:
                yield from _returned(work(pa.concat_arrays(held)))
                held, size = [], 0
    if held:
        yield from _returned(work(pa.concat_arrays(held)))


def _returned(made: pa.Array) -> Iterator[pa.Array]:
    for at in range(0, len(made), RETURNED_TEXTS):
        yield made.slice(at, RETURNED_TEXTS)
    # A task has several such workers beside it.
    pa.default_memory_pool().release_unused()


def _pieces(batches: Iterator[pd.Series]) -> Iterator[list[str | None]]:
    """The texts, about ``PIECE_CHARS`` characters at a time."""
    held, size = [], 0
    for batch in batches:
        for text in batch:
            held.append(text)
            size += len(text or "")
            if size >= PIECE_CHARS:
                yield held
                held, size = [], 0
    if held:
        yield held


def _found(shards: Shards, texts: list[str | None], work: Callable, none: Callable) -> list:
    """What ``work`` collects from every text over the whole ledger, in a ``none()`` of its own; null texts have none."""
    found = [None if t is None else none() for t in texts]
    for automaton in shards.automata([t for t in texts if t]):
        for text, held in zip(texts, found):
            if text:
                work(automaton, text, held)
    return found


def _kept_names(names: DataFrame) -> tuple[DataFrame, int]:
    """The names, worked out once, and the number of shards."""
    names = kept(names)
    return names, max(1, -(-names.count() // SHARD_NAMES))


def _hits(texts: DataFrame, names: DataFrame, shards: int, work: Callable, none: Callable, listed: Callable, kind: str) -> DataFrame:
    """A row ``key``, ``hits`` per pass and distinct text that has some."""

    def search(shared) -> Callable:
        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            mine = Shards(*shared.value)
            keys: list[str] = []

            def bodies() -> Iterator[pd.Series]:
                for batch in batches:
                    keys.extend(batch["key"])
                    yield batch["text"]

            for texts in _pieces(bodies()):
                rows = [(key, listed(held)) for key, held in zip(keys, _found(mine, texts, work, none)) if held]
                del keys[: len(texts)]
                for at in range(0, len(rows), RETURNED_TEXTS):
                    yield pd.DataFrame(rows[at : at + RETURNED_TEXTS], columns=["key", "hits"])

        return run

    found = None
    for first in range(0, shards, PASS_SHARDS):
        packed = _packed(names, shards, range(first, min(first + PASS_SHARDS, shards)))
        if not packed[0]:
            continue
        shared = texts.sparkSession.sparkContext.broadcast(packed)
        part = kept(texts.mapInPandas(search(shared), f"key string, hits {kind}"))
        shared.destroy()
        found = part if found is None else found.unionByName(part)
    return found.groupBy(F.col("key").alias("_key")).agg(F.flatten(F.collect_list("hits")).alias("_hits"))


def _per_text(df: DataFrame, text: str) -> DataFrame:
    """The distinct texts, each with its key, kept for the passes over them."""
    keyed = df.filter(F.col(text).isNotNull()).select(text_key(F.col(text)).alias("key"), F.col(text).alias("text"))
    return kept(keyed.dropDuplicates(["key"]))


def substituted(pages: DataFrame, names: DataFrame, text: str, protected: str) -> DataFrame:
    """``pages`` with ``text`` rewritten and its ``audit``; ``names`` is (name, representative, confidence), each name once."""
    pattern = re.compile(protected, re.DOTALL)
    names, shards = _kept_names(names)

    def packed(made: Iterable[tuple[str, list[tuple]] | None]) -> pd.DataFrame:
        fields = ("name", "representative", "confidence", "replaced")
        rows = [(m[0], [dict(zip(fields, a)) for a in m[1]]) if m else (None, None) for m in made]
        return pd.DataFrame(rows, columns=["text", "audit"])

    if shards <= PASS_SHARDS:
        shared = pages.sparkSession.sparkContext.broadcast(_indexed(names, shards))
        in_bytes = re.compile(protected.encode(), re.DOTALL)

        @F.arrow_udf(REWRITTEN_TYPE)
        def in_place(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
            yield from _in_pieces(batches, partial(_rewritten, Index(*shared.value), protected=in_bytes))

        done = pages.withColumn("_done", in_place(F.col(text)))
    else:
        # As many hits per text as it has places.
        lists = _hits(
            _per_text(pages, text), names, shards, longest_hits, dict,
            lambda held: [dict(zip(("start", "length", "first", "second"), (start, *hit))) for start, hit in held.items()],
            "array<struct<start:int,length:int,first:string,second:string>>",
        )
        keyed = pages.withColumn("_key", text_key(F.col(text)))
        joined = join_dimension(keyed, lists, ["_key"], "left", salt_by=["_key", *_plain(pages)])

        def of_all(found: Iterable | None) -> dict[int, tuple[int, str, str]]:
            longest: dict[int, tuple[int, str, str]] = {}
            for hit in found if found is not None else ():
                if hit["start"] not in longest or longest[hit["start"]][0] < hit["length"]:
                    longest[hit["start"]] = (hit["length"], hit["first"], hit["second"])
            return longest

        @F.pandas_udf(REWRITTEN_TYPE)
        def merged(bodies: pd.Series, found: pd.Series) -> pd.DataFrame:
            return packed(rewrite(t, of_all(h), pattern) if t is not None else None for t, h in zip(bodies, found))

        done = joined.withColumn("_done", merged(F.col(text), F.col("_hits"))).drop("_key", "_hits")
    none = F.array().cast(f"array<{AUDIT_STRUCT}>")
    return done.withColumns({text: F.col("_done.text"), "audit": F.coalesce("_done.audit", none)}).drop("_done")


def substituted_and_noted(pages: DataFrame, names: DataFrame, open_names: DataFrame, text: str, protected: str) -> DataFrame:
    """What ``noted`` with ``open_names`` makes of what ``substituted`` makes of ``pages``; where both ledgers travel, in one worker."""
    (names, shards), (open_names, more) = _kept_names(names), _kept_names(open_names.select("name", "at", "representative"))
    if max(shards, more) > PASS_SHARDS:
        return noted(substituted(pages, names, text, protected), open_names, text)
    shared = pages.sparkSession.sparkContext.broadcast((_indexed(names, shards), _indexed(open_names, more)))
    in_bytes = re.compile(protected.encode(), re.DOTALL)

    @F.arrow_udf(NORMALIZED_TYPE)
    def in_place(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        index, notes = (Index(*made) for made in shared.value)

        def work(texts: pa.Array) -> pa.Array:
            done = _rewritten(index, texts, in_bytes)
            columns = [done.field("text"), done.field("audit"), _noted(notes, done.field("text"))]
            return pa.StructArray.from_arrays(columns, ["text", "audit", "notes"], mask=texts.is_null())

        yield from _in_pieces(batches, work)

    done = pages.withColumn("_done", in_place(F.col(text)))
    none = F.array().cast(f"array<{AUDIT_STRUCT}>")
    return done.withColumns({text: F.col("_done.text"), "audit": F.coalesce("_done.audit", none), "_notes": F.col("_done.notes")}).drop("_done")


def _plain(df: DataFrame) -> list[str]:
    """Columns of simple types, whose content tells rows apart."""
    return [c for c, kind in df.dtypes if not kind.startswith(("array", "map", "struct", "binary"))]


def noted(pages: DataFrame, names: DataFrame, text: str) -> DataFrame:
    """``pages`` with ``_notes``: (at, name, representative) of the names in ``text``, in order.

    ``names`` is (name, at, representative), each name once; ``at`` is text that sorts as the notes do.
    """
    names, shards = _kept_names(names.select("name", "at", "representative"))
    fields = ("at", "name", "representative")
    if shards <= PASS_SHARDS:
        shared = pages.sparkSession.sparkContext.broadcast(_indexed(names, shards))

        @F.arrow_udf(NOTES_TYPE)
        def in_place(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
            yield from _in_pieces(batches, partial(_noted, Index(*shared.value)))

        return pages.withColumn("_notes", in_place(F.col(text)))
    # The pages are read by every pass and by the join, so a rewrite before this one is not run again.
    pages = kept(pages)
    lists = _hits(_per_text(pages, text), names, shards, names_held, set, lambda held: [dict(zip(fields, row)) for row in held], NOTES_TYPE)
    lists = lists.select("_key", F.sort_array("_hits").alias("_notes"))
    keyed = pages.withColumn("_key", text_key(F.col(text)))
    return join_dimension(keyed, lists, ["_key"], "left", salt_by=["_key", *_plain(pages)]).drop("_key")
