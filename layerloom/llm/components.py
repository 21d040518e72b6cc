"""Connected components of a link table, in a logarithmic number of joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from layerloom.llm.common import durable


def _large_star(edges: DataFrame) -> DataFrame:
    """Every node sends its larger neighbours to its smallest one."""
    both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m"))
    return both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Every node sends itself and its smaller neighbours to its smallest one."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    moved = down.join(least, "a").filter("b > m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.union(least.select("a", F.col("m").alias("b")))


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """``node`` and ``component`` (the smallest node of its component) of links ``a``, ``b``.

    Only nodes that are not the smallest of their component are listed. Each round is kept in the
    shared folder, so a lost executor costs one round. No group is gathered in one task: a node
    with many links meets its minimum in a join, which adaptive execution can split.
    """
    now = durable(edges.filter("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    state = None
    for _ in range(max_rounds):
        now = durable(_small_star(_large_star(now)).filter("a != b").distinct())
        # Unchanged rows under both star steps are stars around the smallest node.
        then, state = state, now.agg(F.count("*"), F.sum(F.xxhash64("a", "b") % 1_000_003), F.bit_xor(F.xxhash64("a", "b"))).first()
        if state == then or state[0] == 0:
            return now.select(F.col("a").alias("node"), F.col("b").alias("component"))
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")
