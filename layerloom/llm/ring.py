"""Sharding on a consistent-hash ring with virtual nodes and bounded loads.

Every row has a position on the ring, from its id and text checksum. A shard owns the stretches
before its virtual nodes. No shard takes more than its bound: its own rows come first, and rows
beyond the bound go on clockwise to the next shard with room. Rows of one ring cell differ only
by their order, so who overflows where is worked out on counts per cell, a table of ``CELLS``
rows at any corpus size. Built-in functions only.
"""

from __future__ import annotations

import bisect
import hashlib
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from layerloom.functions.skew import rank_within
from layerloom.llm.common import durable, guarded, text_of

CELLS = 1 << 16
VIRTUAL_NODES = 64
SHARDS = 16


def virtual_nodes(shards: int, each: int = VIRTUAL_NODES) -> list[tuple[int, int]]:
    """Cell and shard of every virtual node, clockwise. A node's place depends on its own name only."""
    taken: dict[int, int] = {}
    for shard in range(shards):
        for k in range(each):
            cell = int.from_bytes(hashlib.md5(f"{shard}/{k}".encode()).digest()[:8], "big") % CELLS
            while cell in taken:
                cell = (cell + 1) % CELLS
            taken[cell] = shard
    return sorted(taken.items())


def bounds(total: int, shards: int, slack: float = 0.0) -> list[int]:
    """The most rows of each shard: an equal share, one row apart, plus ``slack`` of it."""
    return [total // shards + (s < total % shards) + int(slack * total / shards) for s in range(shards)]


def assign(counts: dict[int, int], shards: int, limits: list[int], each: int = VIRTUAL_NODES) -> list[tuple[int, int, int, int, int]]:
    """(cell, from rank, to rank, shard, first slot): where the rows of every cell go.

    A cell belongs to the first virtual node at or after it. A shard keeps room for its own rows;
    what is beyond its bound is carried clockwise and fills the room that others have.
    """
    nodes = virtual_nodes(shards, each)
    places = [cell for cell, _ in nodes]
    arcs: list[list[int]] = [[] for _ in nodes]
    # From the stretch that passes zero on, cells are met in ring order.
    for cell in sorted(counts, key=lambda c: (c <= places[-1], c)):
        arcs[bisect.bisect_left(places, cell) % len(nodes)].append(cell)
    own = [0] * shards
    for (_, shard), cells in zip(nodes, arcs):
        own[shard] += sum(counts[c] for c in cells)
    room = [max(0, limits[s] - own[s]) for s in range(shards)]
    left = list(limits)
    used = [0] * shards
    out: list[tuple[int, int, int, int, int]] = []
    carried: list[tuple[int, int, int]] = []

    def place(shard: int, cell: int, low: int, high: int) -> None:
        out.append((cell, low, high, shard, used[shard]))
        used[shard] += high - low
        left[shard] -= high - low

    for turn in range(2):
        for (_, shard), cells in zip(nodes, arcs):
            while carried and room[shard]:
                cell, low, high = carried.pop(0)
                take = min(high - low, room[shard])
                place(shard, cell, low, low + take)
                room[shard] -= take
                if low + take < high:
                    carried.insert(0, (cell, low + take, high))
            for cell in cells if turn == 0 else []:
                take = min(counts[cell], left[shard] - room[shard])
                if take > 0:
                    place(shard, cell, 0, take)
                if take < counts[cell]:
                    carried.append((cell, max(take, 0), counts[cell]))
    if carried:
        raise ValueError("the bounds are below the number of rows")
    return out


def shard(docs: DataFrame, shards: int = SHARDS, slack: float = 0.0, each: int = VIRTUAL_NODES) -> DataFrame:
    """The rows with ``shard`` and ``slot`` (0, 1, ... within the shard).

    Without slack the shards' row counts differ by one at most. Null ids take their place from the
    text, a null text counts as empty, wholly equal rows get neighbouring slots, and an empty table
    gives an empty result. Input columns called ``shard`` or ``slot`` are replaced.
    """
    own = docs.drop("shard", "slot")
    crc = F.crc32(text_of())
    position = F.when(F.col("doc_id").isNull(), F.xxhash64(text_of())).otherwise(F.xxhash64("doc_id", crc))
    placed = own.withColumns({"_at": position, "_cell": F.pmod(F.shiftright(position, 16), F.lit(CELLS)).cast("int")})
    counts = {r["_cell"]: r["n"] for r in placed.groupBy("_cell").agg(F.count("*").alias("n")).collect()}
    total = sum(counts.values())
    parts = assign(counts, shards, bounds(total, shards, slack), each) if total else []
    # At most CELLS rows and one more for each time a cell is split: a bounded table.
    where = docs.sparkSession.createDataFrame(parts, "_cell int, _low bigint, _high bigint, shard int, _slot bigint")
    rank = F.row_number().over(W.partitionBy("_cell").orderBy("_at", "doc_id", F.crc32(text_of()), F.octet_length(text_of()))) - 1
    ranked = placed.withColumn("_rank", rank.cast("bigint"))
    inside = (ranked["_cell"] == where["_cell"]) & (F.col("_rank") >= F.col("_low")) & (F.col("_rank") < F.col("_high"))
    return ranked.join(F.broadcast(where), inside).select(
        *own.columns, "shard", (F.col("_slot") + F.col("_rank") - F.col("_low")).alias("slot")
    )


def stored_order(docs: DataFrame) -> Column | None:
    """Where a row of written files stands: number of its task, file and row; None for rows not read from files."""
    if "_metadata" in docs.columns:
        return None
    file = F.col("_metadata.file_name")
    place = F.struct(
        F.regexp_extract(file, r"^part-([0-9]+)", 1).try_cast("int").alias("_part"),
        F.xxhash64(file).alias("_file"),
        F.col("_metadata.row_index").alias("_row"),
    )
    try:
        docs.select(place)
    except AnalysisException:
        return None
    return place


def shard_in_order(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """The rows with ``shard`` and ``slot``, where the slots of a shard follow the order in which the rows were written.

    So a range-sorted training stream keeps its order in every shard. The place in that order counts
    as a part of a row's key on the ring: a text that the stream repeats is dealt anew each time.
    Rows that were not read from Parquet files have no such order and are dealt by ``shard``. Ids,
    nulls, repeated rows, empty tables and clashing names as there, other columns are untouched.
    """
    order = stored_order(docs)
    if order is None:
        plain, own = guarded(docs.drop("shard", "slot"))
        return shard(plain, shards).select(*own, "shard", "slot")
    names = {c: f"_own{k}" for k, c in enumerate(docs.columns) if c.lower() not in ("shard", "slot")}
    named = docs.select(*[F.col(f"`{c}`").alias(name) for c, name in names.items()], order.alias("_order"))
    content = F.xxhash64(*[F.col(names[c]) for c in ("doc_id", "text") if c in names], "_order")
    # Only numbers go through the windows; the texts meet their slots once.
    slim = named.select("_order.*", content.alias("doc_id"), F.lit("").alias("text"))
    dealt = durable(shard(slim, shards).select("_part", "_file", "_row", "shard"))
    placed = rank_within(dealt, ["shard"], ["_part", "_file", "_row"], name="_place")
    same = reduce(lambda x, y: x & y, [F.col(f"_order.{c}").eqNullSafe(placed[c]) for c in ("_part", "_file", "_row")])
    back = [F.col(name).alias(c) for c, name in names.items()]
    return named.join(placed, same).select(*back, "shard", (F.col("_place") - 1).alias("slot"))


def shard_table(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """``doc_id``, ``size`` (bytes + 1), ``text_crc32``, ``law``, ``shard``, ``slot`` and ``grown_shard`` per row.

    The law is ``rows``: bounded loads make the counts equal, so no row's place is fixed by its id
    alone and ``grown_shard`` is null.
    """
    slim = docs.select(
        "doc_id",
        (F.octet_length(text_of()) + 1).cast("bigint").alias("size"),
        F.crc32(text_of()).alias("text_crc32"),
        F.crc32(text_of()).cast("string").alias("text"),
    )
    return shard(slim, shards).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )
