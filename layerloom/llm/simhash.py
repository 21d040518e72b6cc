"""SimHash near-duplicates by the generalised pigeonhole principle.

Fingerprints of 64 bits link when at most ``TAU`` bits differ. Correlated bits are grouped into
partitions; each partition gets its own threshold (-1: never probed), chosen by dynamic
programming on the candidate counts that the corpus' own projections predict. The thresholds sum
to ``TAU - parts + 1``, so every linked pair agrees within the threshold in some partition: the
search misses nothing, whatever the partitions. Candidates are verified on all 64 bits.

Equal fingerprints are one node from the start, and a large bucket is cut into blocks that meet
pairwise. A task returns a spanning forest of the links it sees, not the links, so that a dense
group of n near copies does not turn into n^2 rows; the components are those of all links.
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
from layerloom.llm.common import durable, guarded, text_of, travels, words_of
from layerloom.llm.components import components

travels(__name__)

TAU = 3
BITS = 64
SHINGLE = 3
# Signatures of one bucket that are compared in one piece.
BLOCK = 256
# Partition counts that are weighed against each other.
PARTS = (2, 3, 4, 5)
# Shuffling one signature costs about as much as comparing so many pairs of fingerprints.
SIGNATURE_COST = 40
# Hashes whose bits are unpacked at once.
UNPACKED = 1 << 16


def lowered(text: Column) -> Column:
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def _shingle_hashes(words: Column) -> Column:
    n = F.size(words)
    each = F.transform(
        F.sequence(F.lit(0), n - SHINGLE),
        lambda i: F.xxhash64(F.concat_ws(" ", *[F.get(words, i + k) for k in range(SHINGLE)])),
    )
    return F.when(n >= SHINGLE, each).when(n > 0, F.array(F.xxhash64(F.concat_ws(" ", words))))


@F.pandas_udf(T.LongType())
def _majority(hashes: pd.Series) -> pd.Series:
    """Bit i is 1 where over half of the hashes have it; 0 without hashes."""
    out = np.zeros(len(hashes), dtype=np.int64)
    for k, values in enumerate(hashes):
        if values is None or len(values) == 0:
            continue
        raw = np.asarray(values, dtype="<i8").view(np.uint8).reshape(-1, 8)
        ones = np.zeros(BITS, dtype=np.int64)
        for at in range(0, len(raw), UNPACKED):
            ones += np.unpackbits(raw[at : at + UNPACKED], axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
        out[k] = np.packbits(2 * ones > len(raw), bitorder="little").view("<i8")[0]
    return pd.Series(out)


def fingerprints(docs: DataFrame, *keep: Column | str) -> DataFrame:
    """The kept columns and ``fp``, the fingerprint as a signed 64-bit number.

    Bits are summed over three-word shingles of the text with A to Z lower-cased, repeats
    included. Fewer words make one shingle; a null, empty or blank text has fingerprint 0.
    """
    ready = worked_out(docs.select(*keep, words_of(lowered(text_of())).alias("_words")))
    return ready.withColumn("fp", _majority(_shingle_hashes(F.col("_words")))).drop("_words")


def _bits(values: np.ndarray) -> np.ndarray:
    raw = np.ascontiguousarray(values, dtype="<i8").view(np.uint8).reshape(-1, 8)
    return np.unpackbits(raw, axis=1, bitorder="little")


def _pair_counts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """How often bits i and j are both 1, per task, at place 64 i + j; the row count at the end."""
    both, n = np.zeros((BITS, BITS)), 0
    for batch in batches:
        bits = _bits(batch["fp"].to_numpy()).astype(np.float32)
        both += bits.T @ bits
        n += len(bits)
    yield pd.DataFrame({"at": np.arange(BITS * BITS + 1), "n": np.append(both.ravel(), n).astype(np.int64)})


def bit_statistics(nodes: DataFrame) -> tuple[int, np.ndarray]:
    """Rows and the 64 x 64 counts of bit pairs; each task sends 4,097 numbers to be summed."""
    sums = nodes.select("fp").mapInPandas(_pair_counts, "at int, n bigint").groupBy("at").agg(F.sum("n").alias("n"))
    flat = np.zeros(BITS * BITS + 1)
    for at, n in sums.collect():
        flat[at] = n
    return int(flat[-1]), flat[:-1].reshape(BITS, BITS)


def group_bits(n: int, both: np.ndarray, parts: int) -> list[list[int]]:
    """Bits in ``parts`` groups of about equal size; each grows by the bit most correlated with it."""
    p = np.diag(both) / max(n, 1)
    spread = np.sqrt(np.maximum(np.outer(p * (1 - p), p * (1 - p)), 1e-12))
    strength = np.abs(both / max(n, 1) - np.outer(p, p)) / spread
    left, groups = list(range(BITS)), []
    for k in range(parts):
        size = len(left) // (parts - k)
        group = [max(left, key=lambda b: (strength[b, left].sum(), -b))]
        left.remove(group[0])
        while len(group) < size:
            group.append(max(left, key=lambda b: (strength[b, group].sum(), -b)))
            left.remove(group[-1])
        groups.append(sorted(group))
    return groups


def projected(fp: Column, group: list[int]) -> Column:
    mask = sum(1 << b for b in group)
    return fp.bitwiseAND(F.lit(mask - (1 << 64) if mask >> 63 else mask).cast("bigint"))


def equal_pairs(nodes: DataFrame, groups: dict[tuple[int, int], list[int]]) -> dict[tuple[int, int], float]:
    """Pairs of rows that agree on a group of bits, counted over all rows."""
    cells = F.array(*[F.struct(F.lit(m).alias("m"), F.lit(k).alias("k"), projected(F.col("fp"), g).alias("v")) for (m, k), g in groups.items()])
    counts = nodes.select(F.explode(cells).alias("c")).groupBy("c").agg(F.count("*").cast("double").alias("n"))
    return {(r["m"], r["k"]): r["pairs"] for r in counts.groupBy("c.m", "c.k").agg(F.sum(F.col("n") * (F.col("n") - 1) / 2).alias("pairs")).collect()}


def allocate(costs: list[dict[int, float]], budget: int) -> tuple[float, list[int]]:
    """Thresholds per partition that sum to ``budget`` at least cost; costs[k][t] is that of t in k."""
    best: dict[int, tuple[float, list[int]]] = {0: (0.0, [])}
    for options in costs:
        grown: dict[int, tuple[float, list[int]]] = {}
        for used, (cost, chosen) in best.items():
            for t, more in options.items():
                found = (cost + more, [*chosen, t])
                if used + t not in grown or found < grown[used + t]:
                    grown[used + t] = found
        best = grown
    return best[budget]


def search_plan(nodes: DataFrame) -> list[tuple[list[int], int]]:
    """Groups of bits with their thresholds: of all partition counts, the plan of least estimated cost.

    The pairs that agree on a whole group are counted; those within t bits follow from the share
    of rows in which each bit is set.
    """
    n, both = bit_statistics(nodes)
    groups = {(m, k): g for m in PARTS for k, g in enumerate(group_bits(n, both, m))}
    equal = equal_pairs(nodes, groups)
    p = np.diag(both) / max(n, 1)
    odds = 2 * p * (1 - p) / np.maximum(1 - 2 * p * (1 - p), 0.5)
    plans = []
    for m in PARTS:
        costs = []
        for k in range(m):
            group = groups[m, k]
            options, pairs, probes = {-1: 0.0}, 0.0, 0
            symmetric = [1.0, *np.zeros(2)]
            for b in group:
                symmetric = [symmetric[0], symmetric[1] + odds[b], symmetric[2] + symmetric[1] * odds[b]]
            for t in range(3):
                probes += math.comb(len(group), t)
                pairs += max(equal.get((m, k), 0.0), n * n / 2 / 2 ** len(group)) * symmetric[t]
                options[t] = n * (probes + (t > 0)) * SIGNATURE_COST + pairs
            costs.append(options)
        cost, chosen = allocate(costs, TAU - m + 1)
        plans.append((cost, m, [(groups[m, k], t) for k, t in enumerate(chosen) if t >= 0]))
    return min(plans, key=lambda x: x[:2])[2]


def _signatures(nodes: DataFrame, plan: list[tuple[list[int], int]]) -> DataFrame:
    """``part``, ``value``, ``probe`` (false: the projection itself) and ``fp``."""
    cells = []
    for k, (group, t) in enumerate(plan):
        own = projected(F.col("fp"), group)
        for flips in (c for size in range(t + 1) for c in combinations(group, size)):
            mask = sum(1 << b for b in flips)
            value = own.bitwiseXOR(F.lit(mask - (1 << 64) if mask >> 63 else mask).cast("bigint"))
            cells.append(F.struct(F.lit(k).alias("part"), value.alias("value"), F.lit(bool(flips)).alias("probe")))
    return nodes.select("fp", F.explode(F.array(*cells)).alias("c")).select("c.*", "fp")


def _in_blocks(signatures: DataFrame) -> DataFrame:
    """Buckets above ``BLOCK`` rows cut into blocks; every two blocks meet in one cell."""
    sizes = signatures.groupBy("part", "value").agg(F.count("*").alias("n")).filter(F.col("n") > BLOCK)
    joined = signatures.join(sizes, ["part", "value"], "left")
    blocks = F.ceil(F.coalesce(F.col("n"), F.lit(1)) / BLOCK).cast("int")
    own = F.pmod(F.xxhash64("fp"), blocks).cast("int")
    return joined.select(
        "part", "value", "probe", "fp", own.alias("own"), F.explode(F.sequence(F.lit(0), blocks - 1)).alias("other")
    ).select(
        F.xxhash64("part", "value", F.least("own", "other"), F.greatest("own", "other")).alias("cell"), "probe", "fp"
    )


def smallest_label(size: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    label = np.arange(size)
    while True:
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        np.minimum.at(new, label[a], low)
        np.minimum.at(new, label[b], low)
        new = new[new]
        if np.array_equal(new, label):
            return label
        label = new


def _verified(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Links of at most ``TAU`` bits inside each cell, as a forest. Rows come sorted by cell and probe."""
    rest = pd.DataFrame({"cell": [], "probe": [], "fp": []}).astype({"cell": "int64", "probe": "bool", "fp": "int64"})

    def linked(part: pd.DataFrame) -> pd.DataFrame:
        cell, fp = part["cell"].to_numpy(), part["fp"].to_numpy().view(np.uint64)
        index = np.flatnonzero(~part["probe"].to_numpy())
        lefts, rights, held = [], [], 0
        distinct, at = np.unique(part["fp"].to_numpy(), return_inverse=True)
        step = 0
        while len(index):
            step += 1
            index = index[index + step < len(cell)]
            index = index[cell[index] == cell[index + step]]
            close = index[np.bitwise_count(fp[index] ^ fp[index + step]) <= TAU]
            lefts.append(at[close])
            rights.append(at[close + step])
            held += len(close)
            if held > 1_000_000:
                label = smallest_label(len(distinct), np.concatenate(lefts), np.concatenate(rights))
                lefts, rights = [np.arange(len(distinct))], [label]
                held = len(distinct)
        if not lefts:
            return pd.DataFrame({"a": [], "b": []}).astype("int64")
        label = smallest_label(len(distinct), np.concatenate(lefts), np.concatenate(rights))
        moved = np.flatnonzero(label != np.arange(len(label)))
        return pd.DataFrame({"a": distinct[moved], "b": distinct[label[moved]]})

    for batch in batches:
        rest = pd.concat([rest, batch], ignore_index=True)
        cell = rest["cell"].to_numpy()
        # The last cell may go on in the next batch.
        cut = int(np.flatnonzero(cell != cell[-1])[-1]) + 1 if len(cell) and (cell != cell[-1]).any() else 0
        if cut:
            yield linked(rest.iloc[:cut])
            rest = rest.iloc[cut:].reset_index(drop=True)
    if len(rest):
        yield linked(rest)


def link_forest(nodes: DataFrame, plan: list[tuple[list[int], int]]) -> DataFrame:
    """Links ``a``, ``b`` whose components are those of all links between the distinct fingerprints."""
    cells = _in_blocks(_signatures(nodes, plan)).repartition("cell").sortWithinPartitions("cell", "probe")
    return cells.mapInPandas(_verified, "a bigint, b bigint").distinct()


def clusters(keyed: DataFrame) -> DataFrame:
    """``fp`` and ``component_id`` of rows with ``doc_id`` and ``fp``: the smallest doc_id reachable.

    Null ids never name a component, unless it has no other id; repeated rows change nothing.
    """
    nodes = durable(keyed.groupBy("fp").agg(F.min("doc_id").alias("rep")))
    links = components(link_forest(nodes, search_plan(nodes)))
    labelled = nodes.join(links.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "rep", F.coalesce("component", "fp").alias("component")
    )
    names = labelled.groupBy("component").agg(F.min("rep").alias("component_id"))
    return labelled.join(names, "component").select("fp", "component_id", "component")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``fingerprint`` (16 hex digits) and ``component_id`` of every row.

    A null, empty or blank text has fingerprint 0 and links like any other; repeated rows come
    back once each; an empty table gives an empty result; other columns are not looked at.
    """
    keyed = durable(fingerprints(docs, F.col("doc_id")))
    found = keyed.join(clusters(keyed), "fp", "left")
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame) -> DataFrame:
    """One document of each component, with its own columns: the one of the smallest doc_id.

    Rows alike in doc_id and text are one document; ties between texts of one doc_id go to the
    smaller text hash, null ids come last.
    """
    plain, own = guarded(docs)
    keyed = durable(fingerprints(plain, F.col("doc_id"), F.xxhash64(text_of()).alias("_hash")))
    return first_of_each(plain, keyed.join(clusters(keyed).select("fp", "component"), "fp")).select(*own)


def first_of_each(docs: DataFrame, found: DataFrame) -> DataFrame:
    """The document of the smallest id of each ``component`` in ``found``, which has ``doc_id`` and ``_hash`` (of the text)."""
    order = F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("doc_id"), F.col("_hash").alias("hash"))
    first = found.groupBy("component").agg(F.min(order).alias("o")).select(
        F.col("o.doc_id").alias("_first"), F.col("o.hash").alias("_hash")
    )
    kept = docs.withColumn("_hash", F.xxhash64(text_of()))
    rule = kept["doc_id"].eqNullSafe(first["_first"]) & (kept["_hash"] == first["_hash"])
    # Repeated rows of one document: only ids that occur more than once go through this step.
    again = found.groupBy("doc_id", "_hash").count().filter("count > 1").select(
        F.col("doc_id").alias("_again"), F.col("_hash").alias("_again_hash")
    )
    chosen = kept.join(first, rule, "left_semi")
    twice = chosen["doc_id"].eqNullSafe(again["_again"]) & (chosen["_hash"] == again["_again_hash"])
    once = chosen.join(again, twice, "left_anti")
    more = chosen.join(again, twice, "left_semi").dropDuplicates(["doc_id", "_hash"])
    return once.unionByName(more).drop("_hash")
