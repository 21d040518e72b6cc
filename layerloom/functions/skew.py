"""Joins and numbering that stay balanced when one key holds a large share of the rows."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

# All limits are read when a function runs, so a deployment or a test may set them here.

# A side is broadcast only when it is measured to be below both limits.
BROADCAST_ROWS = 200_000
BROADCAST_BYTES = 64 * 1024 * 1024

# Rows of one key that one task may join; a key with more is cut into shares of that size.
HOT_ROWS = 1_000_000

# Rows of one group a single window task may hold.
GROUP_ROWS = 1_000_000


def measured_small(
    df: DataFrame, max_rows: int | None = None, max_bytes: int | None = None
) -> bool:
    """Count at most ``max_rows + 1`` rows and their text size."""
    max_rows = BROADCAST_ROWS if max_rows is None else max_rows
    max_bytes = BROADCAST_BYTES if max_bytes is None else max_bytes
    width = sum((F.coalesce(F.octet_length(F.col(c).cast("string")), F.lit(0)) for c in df.columns), F.lit(0))
    size = df.select(width.alias("w")).limit(max_rows + 1).agg(
        F.count("*").alias("n"), F.coalesce(F.sum("w"), F.lit(0)).alias("bytes")
    ).first()
    return size["n"] <= max_rows and size["bytes"] <= max_bytes


def join_dimension(
    facts: DataFrame,
    dimension: DataFrame,
    on: Sequence[str],
    how: str = "inner",
    salt_by: Sequence[str] | None = None,
    max_rows: int | None = None,
    small: bool | None = None,
    rows_per_key: DataFrame | None = None,
    hot_rows: int | None = None,
) -> DataFrame:
    """Join a large, possibly skewed table to a smaller one by equality.

    A measured-small side is broadcast. Otherwise rows are counted per key (``rows_per_key``, the
    keys and a ``rows`` count of the large side, saves that), and a key above ``hot_rows`` is cut
    into as many shares as it has multiples of them; nothing else is repeated. A row picks its share
    from ``salt_by`` (a hash of row content, so a rerun task gives the same rows). Rows with a null
    key match nothing and are spread by that hash alone. ``small`` states what a measurement would
    find, where it is known already or where measuring would compute the side twice.
    """
    on = list(on)
    if measured_small(dimension, max_rows) if small is None else small:
        return facts.join(F.broadcast(dimension), on, how)
    hot_rows = HOT_ROWS if hot_rows is None else hot_rows
    counted = facts.groupBy(*on).agg(F.count("*").alias("rows")) if rows_per_key is None else rows_per_key
    shares = F.ceil(F.col("rows") / hot_rows).cast("int")
    hot = counted.filter(F.col("rows") > hot_rows).select(*on, shares.alias("_shares"))
    if measured_small(hot):
        hot = F.broadcast(hot)
    content = F.xxhash64(*(salt_by or facts.columns))
    no_key = F.greatest(*[F.col(c).isNull() for c in on], F.lit(False))
    salt = F.when(no_key, content).otherwise(F.coalesce(F.pmod(content, F.col("_shares")), F.lit(0)))
    copies = F.sequence(F.lit(0), F.coalesce(F.col("_shares"), F.lit(1)) - 1).cast("array<bigint>")
    spread = dimension.join(hot, on, "left").withColumn("_salt", F.explode(copies)).drop("_shares")
    salted = facts.join(hot, on, "left").withColumn("_salt", salt.cast("bigint")).drop("_shares")
    return salted.join(spread, [*on, "_salt"], how).drop("_salt")


def _ordering(columns: Sequence[str]) -> Column:
    return F.struct(*[F.col(c) for c in columns])


def rank_within(
    df: DataFrame,
    group: Sequence[str],
    order: Sequence[str],
    name: str = "position",
    group_rows: int | None = None,
    sizes: DataFrame | None = None,
) -> DataFrame:
    """Number the rows of each group 1, 2, ... by ``order``, whatever the size of the group.

    Groups measured below ``group_rows`` use one window. Larger ones are cut into key ranges that
    are numbered apart; each range then adds the rows its group has in earlier ranges. ``sizes``
    (a ``rows`` column) saves counting the groups where that is known.
    """
    group, order = list(group), list(order)
    if sizes is None:
        sizes = df.groupBy(*group).agg(F.count("*").alias("rows"))
    largest = sizes.agg(F.max("rows")).first()[0] or 0
    if largest <= (GROUP_ROWS if group_rows is None else group_rows):
        place = F.row_number().over(W.partitionBy(*group).orderBy(*order))
        return df.withColumn(name, place.cast("bigint"))
    return _rank_by_range(df, group, order, name)


def _rank_by_range(
    df: DataFrame, group: list[str], order: list[str], name: str
) -> DataFrame:
    keys = group + order
    shuffles = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # One row per range: its lowest key. Ranges are disjoint, so these are the cut points.
    lows = (
        df.select(*keys)
        .repartitionByRange(shuffles, *keys)
        .groupBy(F.spark_partition_id())
        .agg(F.min(_ordering(keys)).alias("low"))
        .collect()
    )
    types = dict(df.select(*keys).dtypes)
    cuts = [
        F.struct(*[F.lit(row[k]).cast(types[k]).alias(k) for k in keys])
        for row in sorted(row["low"] for row in lows)
    ]
    # Cut points are looked up in two steps, first among every width-th, then inside that block.
    width = max(1, math.isqrt(len(cuts)))
    blocks = [cuts[i : i + width] for i in range(0, len(cuts), width)]
    block = F.size(F.filter(F.array(*[b[0] for b in blocks]), lambda low: low <= _ordering(keys)))
    inside = F.element_at(F.array(*[F.array(*b) for b in blocks]), F.col("_block"))
    ranged = df.withColumn("_block", block).withColumn(
        "_range",
        (F.col("_block") - 1) * width
        + F.size(F.filter(inside, lambda low: low <= _ordering(keys))),
    ).drop("_block")
    per_range = ranged.groupBy("_range", *group).agg(F.count("*").alias("_rows"))
    earlier = W.partitionBy(*group).orderBy("_range").rowsBetween(W.unboundedPreceding, -1)
    # A range continues at most one group of an earlier range: no more rows here than ranges.
    offsets = (
        per_range.withColumn("_before", F.sum("_rows").over(earlier))
        .filter("_before > 0")
        .drop("_rows")
    )
    local = F.row_number().over(W.partitionBy("_range", *group).orderBy(*order))
    return (
        ranged.withColumn("_local", local)
        .join(F.broadcast(offsets), ["_range", *group], "left")
        .withColumn(name, (F.col("_local") + F.coalesce(F.col("_before"), F.lit(0))).cast("bigint"))
        .drop("_range", "_local", "_before")
    )
