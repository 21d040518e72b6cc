"""Near copies of documents: a wide SimHash over five-word shingles, searched by the generalised pigeonhole.

A fingerprint has ``8 * 64`` bits, so that its distance tells similarities of 0.8 and 0.7 apart. As
in ``simhash``, correlated bits are grouped into partitions and dynamic programming gives each its
own threshold (or leaves it out) at the least estimated number of candidates; here the thresholds
have to find a pair of similarity ``SIMILARITY`` with probability ``RECALL``, by the angle law. Pairs
close on all bits are candidates; a task returns their lightest spanning forest, so a group of n near
copies gives about n rows and not n^2. Each link is then held against the shingle sets themselves. Where
one does not hold, a second pass over its cells does so with every pair between two groups found so far.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from layerloom.functions.explode import worked_out
from layerloom.functions.skew import measured_small
from layerloom.llm.common import durable, guarded, stored, text_of, travels, words_of
from layerloom.llm.components import components
from layerloom.llm.simhash import BITS, BLOCK, PARTS, SIGNATURE_COST, first_of_each, group_bits, lowered, projected, smallest_label

travels(__name__)

WORDS = 8
SHINGLE = 5
SIMILARITY = 0.8
# Share of the pairs of exactly that similarity that some partition brings together.
RECALL = 0.98
# Candidates differ by at most as many bits as a pair of that similarity, and so many deviations more.
DEVIATIONS = 3
# Bits of a sketch: whether an odd number of a text's shingles fall on a place.
PLACES = 1024
# Shingles whose bits are counted at once.
COUNTED = 255 * 32
FPS = [f"f{k}" for k in range(WORDS)]


def agreement(similarity: float) -> float:
    """Probability that a bit is equal in two texts whose shingle sets have this Jaccard similarity."""
    return 1 - math.acos(2 * similarity / (1 + similarity)) / math.pi


def widest() -> int:
    """Most bits in which a candidate may differ."""
    q, bits = agreement(SIMILARITY), WORDS * BITS
    return round(bits * (1 - q) + DEVIATIONS * math.sqrt(bits * q * (1 - q)))


def shingles(text: Column) -> Column:
    """Hashes of the five-word shingles, A to Z lower-cased; fewer words make one shingle, no word none."""
    words = words_of(lowered(text))
    each = lambda w: F.transform(
        F.sequence(F.lit(0), F.size(w) - SHINGLE), lambda i: F.xxhash64(F.concat_ws(" ", F.slice(w, i + 1, F.lit(SHINGLE))))
    )
    one = lambda w: F.array(F.xxhash64(F.concat_ws(" ", w)))
    none = F.array().cast("array<bigint>")
    chosen = lambda w: F.when(F.size(w) >= SHINGLE, each(w)).when(F.size(w) > 0, one(w)).otherwise(none)
    return F.get(F.transform(F.array(words), chosen), F.lit(0))


def _mixed(values: np.ndarray) -> np.ndarray:
    """``WORDS`` independent hashes of each hash."""
    steps = (np.arange(1, WORDS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))[None, :]
    x = values[:, None] + steps
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def wide_fingerprint(hashes: np.ndarray) -> np.ndarray:
    """``WORDS`` signed numbers: a bit is 1 where over half of the different shingles have it."""
    distinct = np.unique(np.asarray(hashes, dtype=np.int64)).view(np.uint64)
    ones = np.zeros(WORDS * BITS, dtype=np.int64)
    for at in range(0, len(distinct), COUNTED):
        raw = _mixed(distinct[at : at + COUNTED]).astype("<u8").view(np.uint8).reshape(-1, WORDS * 8)
        bits = np.unpackbits(raw, axis=1, bitorder="little")
        for low in range(0, len(bits), 255):
            ones += bits[low : low + 255].sum(axis=0, dtype=np.uint8)
    return np.packbits(2 * ones > len(distinct), bitorder="little").view("<i8")


@F.pandas_udf(T.ArrayType(T.LongType()))
def _wide(hashes: pd.Series) -> pd.Series:
    return pd.Series([wide_fingerprint(values) for values in hashes])


@F.pandas_udf(T.BinaryType())
def _sketch(sets: pd.Series) -> pd.Series:
    odd = (np.bincount(np.asarray(s, dtype=np.int64) & (PLACES - 1), minlength=PLACES) & 1 for s in sets)
    return pd.Series([np.packbits(bits.astype(np.uint8)).tobytes() for bits in odd], dtype=object)


def _pair_counts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Per task and word, how often bits i and j are both 1, at place 64 i + j; the row count at the end."""
    both, n = np.zeros((WORDS, BITS, BITS)), 0
    for batch in batches:
        for k, name in enumerate(FPS):
            raw = np.ascontiguousarray(batch[name].to_numpy(), dtype="<i8").view(np.uint8).reshape(-1, 8)
            bits = np.unpackbits(raw, axis=1, bitorder="little").astype(np.float32)
            both[k] += bits.T @ bits
        n += len(batch)
    yield pd.DataFrame({"at": np.arange(both.size + 1), "n": np.append(both.ravel(), n).astype(np.int64)})


def allocate(options: list[dict[int, tuple[float, float]]], need: float) -> tuple[float, list[int]]:
    """Threshold per partition (-1: left out) at least cost; options[k][t] is (cost, gain), the gains reach ``need``."""
    unit = need / 400
    best: dict[int, tuple[float, list[int]]] = {0: (0.0, [])}
    for choices in options:
        grown: dict[int, tuple[float, list[int]]] = {}
        for have, (cost, chosen) in best.items():
            for t, (more, gain) in choices.items():
                reached = min(have + int(gain / unit), 400)
                found = (cost + more, [*chosen, t])
                if reached not in grown or found < grown[reached]:
                    grown[reached] = found
        best = grown
    return best[400] if 400 in best else (math.inf, [])


def search_plan(nodes: DataFrame) -> list[tuple[int, list[int], int]]:
    """(word, bits, threshold) of the partitions to probe.

    Of all partition counts the plan of least estimated cost; candidates are estimated from the
    shares of rows in which each bit is set, counted over all rows.
    """
    sums = nodes.select(*FPS).mapInPandas(_pair_counts, "at int, n bigint").groupBy("at").agg(F.sum("n").alias("n"))
    flat = np.zeros(WORDS * BITS * BITS + 1)
    for at, count in sums.collect():
        flat[at] = count
    n, both = int(flat[-1]), flat[:-1].reshape(WORDS, BITS, BITS)
    q, plans = agreement(SIMILARITY), []
    for m in PARTS:
        parts = [(w, g) for w in range(WORDS) for g in group_bits(n, both[w], m)]
        options = []
        for w, group in parts:
            p = np.diag(both[w])[group] / max(n, 1)
            same = [1.0, 0.0, 0.0]
            for equal in p * p + (1 - p) * (1 - p):
                same = [same[0] * equal] + [same[t] * equal + same[t - 1] * (1 - equal) for t in (1, 2)]
            choices, probes, near, found = {-1: (0.0, 0.0)}, 0, 0.0, 0.0
            for t in range(3):
                probes += math.comb(len(group), t)
                near += same[t]
                found += math.comb(len(group), t) * q ** (len(group) - t) * (1 - q) ** t
                choices[t] = (n * probes * SIGNATURE_COST + n * n / 2 * near, -math.log(1 - found))
            options.append(choices)
        cost, chosen = allocate(options, -math.log(1 - RECALL))
        plans.append((cost, m, [(w, g, t) for (w, g), t in zip(parts, chosen) if t >= 0]))
    return min(plans, key=lambda x: x[:2])[2]


def _signatures(nodes: DataFrame, plan: list[tuple[int, list[int], int]], *keep: str) -> DataFrame:
    """``part``, ``value``, ``probe`` (false: the projection itself) and the kept columns."""
    cells = []
    for k, (word, group, t) in enumerate(plan):
        own = projected(F.col(FPS[word]), group)
        for flips in (c for size in range(t + 1) for c in combinations(group, size)):
            mask = sum(1 << b for b in flips)
            value = own.bitwiseXOR(F.lit(mask - (1 << 64) if mask >> 63 else mask).cast("bigint"))
            cells.append(F.struct(F.lit(k).alias("part"), value.alias("value"), F.lit(bool(flips)).alias("probe")))
    return nodes.select(*keep, F.explode(F.array(*cells)).alias("c")).select("c.*", *keep)


def lightest_forest(size: int, a: np.ndarray, b: np.ndarray, d: np.ndarray) -> np.ndarray:
    """Places of the links of a spanning forest of least total distance."""
    rank = np.empty(len(d), dtype=np.int64)
    rank[np.lexsort((b, a, d))] = np.arange(len(d))
    label, chosen = np.arange(size), []
    left = np.arange(len(d))
    while True:
        left = left[label[a[left]] != label[b[left]]]
        if not len(left):
            return np.concatenate(chosen) if chosen else left
        least = np.full(size, len(d), dtype=np.int64)
        np.minimum.at(least, label[a[left]], rank[left])
        np.minimum.at(least, label[b[left]], rank[left])
        taken = left[(rank[left] == least[label[a[left]]]) | (rank[left] == least[label[b[left]]])]
        chosen.append(taken)
        label = smallest_label(size, label[a[taken]], label[b[taken]])[label]


def _close(limit: int, all_pairs: bool = False):
    """Links of close rows of a cell: a lightest forest of each cell, or every pair of two classes that may be similar.

    Two sets differ in at least as many shingles as their sketches in places, and as their sizes differ.
    """

    def linked(part: pd.DataFrame) -> Iterator[pd.DataFrame]:
        cell, fp = part["cell"].to_numpy(), part[FPS].to_numpy().view(np.uint64)
        if all_pairs:
            group, size = part["class"].to_numpy(), part["size"].to_numpy()
            sketch = np.frombuffer(b"".join(part["sketch"]), dtype=np.uint64).reshape(len(part), -1)
        ids, place = np.unique(part["id"].to_numpy(), return_inverse=True)
        # A node is an id in a cell: each cell has a forest of its own, however the rows come in batches.
        begins = np.concatenate([[True], cell[1:] != cell[:-1]])
        distinct, at = np.unique((np.cumsum(begins) - 1) * len(ids) + place, return_inverse=True)

        def rows(a: np.ndarray, b: np.ndarray) -> pd.DataFrame:
            named = {"a": ids[distinct[a] % len(ids)], "b": ids[distinct[b] % len(ids)]}
            return pd.DataFrame(named if all_pairs else {"cell": cell[begins][distinct[a] // len(ids)], **named})

        index, step, held = np.flatnonzero(~part["probe"].to_numpy()), 0, 0
        found = [(at[:0], at[:0], at[:0])]
        while len(index):
            step += 1
            index = index[index + step < len(cell)]
            index = index[cell[index] == cell[index + step]]
            d = np.bitwise_count(fp[index] ^ fp[index + step]).sum(axis=1, dtype=np.int64)
            near = (d <= limit) & (at[index] != at[index + step])
            if all_pairs:
                near &= group[index] != group[index + step]
                i, j = index[near], index[near] + step
                apart = np.maximum(np.bitwise_count(sketch[i] ^ sketch[j]).sum(axis=1, dtype=np.int64), abs(size[i] - size[j]))
                # One more than may be, for what the comparison of ``similar`` rounds.
                near[near] = (apart - 1) * (1 + SIMILARITY) <= (1 - SIMILARITY) * (size[i] + size[j])
            x, y = at[index[near]], at[index[near] + step]
            found.append((np.minimum(x, y), np.maximum(x, y), d[near]))
            held += int(near.sum())
            if held > 1_000_000 or not len(index):
                a, b, d = (np.concatenate(x) for x in zip(*found))
                if all_pairs:
                    yield rows(a, b)
                    found, held = [(at[:0], at[:0], at[:0])], 0
                else:
                    kept = lightest_forest(len(distinct), a, b, d)
                    found, held = [(a[kept], b[kept], d[kept])], len(kept)
        a, b, _ = (np.concatenate(x) for x in zip(*found))
        yield rows(a, b)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rest = None
        for batch in batches:
            rest = batch if rest is None else pd.concat([rest, batch], ignore_index=True)
            cell = rest["cell"].to_numpy()
            # The last cell may go on in the next batch.
            cut = int(np.searchsorted(cell, cell[-1])) if len(cell) else 0
            if cut:
                yield from linked(rest.iloc[:cut])
                rest = rest.iloc[cut:].reset_index(drop=True)
        if rest is not None and len(rest):
            yield from linked(rest)

    return run


def cells_of(nodes: DataFrame) -> DataFrame:
    """A row of ``cell``, ``probe``, ``id`` and the fingerprint per meeting place; buckets above ``BLOCK`` rows meet in blocks."""
    plan = search_plan(nodes)
    counted = _signatures(nodes, plan).groupBy("part", "value").agg(F.count("*").alias("n"))
    sizes = durable(counted.filter(F.col("n") > BLOCK))
    sizes = F.broadcast(sizes) if measured_small(sizes) else sizes
    blocks = F.ceil(F.coalesce(F.col("n"), F.lit(1)) / BLOCK).cast("int")
    own = F.pmod(F.xxhash64("id"), blocks).cast("int").alias("own")
    other = F.explode(F.sequence(F.lit(0), blocks - 1)).alias("other")
    placed = _signatures(nodes, plan, "id", *FPS).join(sizes, ["part", "value"], "left")
    placed = placed.select("part", "value", "probe", "id", *FPS, own, other)
    cell = F.xxhash64("part", "value", F.least("own", "other"), F.greatest("own", "other")).alias("cell")
    return placed.select(cell, "probe", "id", *FPS)


def _in_cells(cells: DataFrame) -> DataFrame:
    """The rows of a cell together, in one task.

    By a hash of the cell: rows that a join has dealt by ``cell`` would not be dealt anew, and adaptive
    execution may read them from that join in another way, which parts cells.
    """
    return cells.repartition(F.xxhash64("cell")).sortWithinPartitions("cell", "probe")


def forest_links(cells: DataFrame) -> DataFrame:
    """Links ``a``, ``b`` of the forest of each ``cell``."""
    return _in_cells(cells).mapInPandas(_close(widest()), "cell bigint, a bigint, b bigint")


def links_across(cells: DataFrame, classes: DataFrame, texts: DataFrame) -> DataFrame:
    """Links ``a``, ``b`` between close ids of different classes (``node``, ``component``; others are alone) that may be similar.

    ``texts`` has the ``id`` and ``set`` of every id that is close to another one of its cell.
    """
    known = stored(texts.select("id", F.size("set").cast("bigint").alias("size"), _sketch("set").alias("sketch")))
    named = cells.join(known, "id").join(classes.withColumnRenamed("node", "id"), "id", "left")
    named = named.select("cell", "probe", "id", F.coalesce("component", "id").alias("class"), "size", "sketch", *FPS)
    return _in_cells(named).mapInPandas(_close(widest(), all_pairs=True), "a bigint, b bigint").distinct()


def similar(links: DataFrame, texts: DataFrame) -> DataFrame:
    """The links whose shingle sets (``texts``: ``id``, ``set``) have a Jaccard similarity of ``SIMILARITY`` or more."""
    x = texts.select(F.col("id").alias("a"), F.col("set").alias("x"))
    y = texts.select(F.col("id").alias("b"), F.col("set").alias("y"))
    both = links.join(x, "a").join(y, "b").select("a", "b", F.size("x").alias("nx"), F.size("y").alias("ny"), F.size(F.array_intersect("x", "y")).alias("n"))
    return worked_out(both).filter(F.col("n") >= SIMILARITY * (F.col("nx") + F.col("ny") - F.col("n"))).select("a", "b")


def all_similar(cells: DataFrame, forest: DataFrame, links: DataFrame, texts: DataFrame) -> DataFrame:
    """Similar links that connect what all similar pairs of the cells connect; ``links`` are those of ``forest``, once each.

    Where a link of a forest is not similar, the forest may have left out similar pairs for it. In the
    cells of such links every close pair between two classes of the similar links is held against the sets.
    """
    first = durable(similar(links, texts))
    refused = durable(links.join(first, ["a", "b"], "left_anti"))
    if refused.isEmpty():
        return first
    torn = durable(forest.join(refused, ["a", "b"], "left_semi").select("cell").distinct())
    torn = F.broadcast(torn) if measured_small(torn) else torn
    across = links_across(cells.join(torn, "cell", "left_semi"), components(first), texts)
    return first.union(similar(across.join(refused, ["a", "b"], "left_anti"), texts))


def near_groups(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``_hash`` (of the text) and ``component`` of every row.

    Texts of one fingerprint are one node, named by a 64-bit hash of it. A null, empty or blank
    text has no shingle; all such texts are one group. Repeated rows come back once each, null
    ids are kept, an empty table gives an empty result.
    """
    cut = worked_out(docs.select("doc_id", F.xxhash64(text_of()).alias("_hash"), shingles(text_of()).alias("_set")))
    ready = cut.select("doc_id", "_hash", _wide("_set").alias("_fp"))
    named = ready.select("doc_id", "_hash", F.xxhash64("_fp").alias("id"), *[F.get("_fp", F.lit(k)).alias(c) for k, c in enumerate(FPS)])
    keyed = stored(named)
    nodes = stored(keyed.groupBy("id").agg(F.min("_hash").alias("_hash"), *[F.first(c).alias(c) for c in FPS]))
    cells = cells_of(nodes)
    forest = durable(forest_links(cells))
    links = durable(forest.select("a", "b").distinct())
    ends = nodes.join(links.select(F.explode(F.array("a", "b")).alias("id")).distinct(), "id", "left_semi").select("id", "_hash")
    ends = F.broadcast(ends) if measured_small(ends) else ends
    found = docs.select(F.xxhash64(text_of()).alias("_hash"), text_of().alias("text")).join(ends, "_hash")
    # One text of each node, whichever of its equal copies comes first.
    texts = stored(found.select("id", F.array_distinct(shingles(F.col("text"))).alias("set")).groupBy("id").agg(F.first("set").alias("set")))
    classes = components(all_similar(cells, forest, links, texts)).withColumnRenamed("node", "id")
    return keyed.select("doc_id", "_hash", "id").join(classes, "id", "left").select(
        "doc_id", "_hash", F.coalesce("component", "id").alias("component")
    )


def keep_one_near(docs: DataFrame) -> DataFrame:
    """One document of each group of near copies, with its own columns: the one of the smallest doc_id.

    Rows alike in doc_id and text are one document; ties between texts of one doc_id go to the
    smaller text hash, null ids come last, an empty table gives an empty result.
    """
    plain, own = guarded(docs)
    return first_of_each(plain, durable(near_groups(plain))).select(*own)
