"""Stored aggregates kept up to date by signed rows of changed pages.

A changed page contributes its old rows with sign -1 and its new rows with sign +1. An aggregate that counts
a bag is the sum of signs, so folding the signed counts into the stored ones gives what a recount would; rows
that come to nothing are dropped. Only changed pages are read again, and an aggregate row per touched key is
shuffled beside the stored ones.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from layerloom.functions.skew import join_dimension
from layerloom.functions.tasks import kept
from layerloom.operators.lineage import moved_keys

SIGN = "_sign"


def signed_changes(old: DataFrame, new: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """``key``, ``columns`` and the sign of every row that one version has and the other has not, or has otherwise.

    Keys are unique in each version. Keys and checksums of all rows are compared; rows travel only where they differ.
    """
    content = F.to_json(F.struct(*columns), {"ignoreNullFields": "false"})
    sides = [df.select(key, *columns, content.alias("_content")) for df in (old, new)]
    moved = kept(moved_keys(*sides, key, "_content"))
    before, after = (
        join_dimension(df.select(key, *columns), moved.filter(has).select(key), [key], "left_semi").withColumn(SIGN, F.lit(sign))
        for df, has, sign in ((old, "_old", -1), (new, "_new", 1))
    )
    return before.unionByName(after)


def fold(state: DataFrame, changes: DataFrame, keys: Sequence[str], counts: Sequence[str]) -> DataFrame:
    """The stored counts with signed counts of the same columns added; keys whose counts are all 0 leave."""
    together = state.select(*keys, *counts).unionByName(changes.select(*keys, *counts))
    summed = together.groupBy(*keys).agg(*[F.sum(c).cast("bigint").alias(c) for c in counts])
    left = F.greatest(*[F.abs(F.col(c)) for c in counts], F.lit(0)) != 0
    return summed.filter(left)


def _signed(rows: DataFrame) -> DataFrame:
    return rows if SIGN in rows.columns else rows.withColumn(SIGN, F.lit(1))


def entry_counts(rows: DataFrame, name: str) -> DataFrame:
    """Rows per chapter as the count ``name``, signed where the rows are."""
    return _signed(rows).groupBy("chapter").agg(F.sum(SIGN).cast("bigint").alias(name))


def reference_uses(claims: DataFrame) -> DataFrame:
    """How often each chapter cites each reference: what a distinct count needs to lose a member again."""
    return _signed(claims).groupBy("chapter", F.col("object_id").alias("ref_id")).agg(F.sum(SIGN).cast("bigint").alias("uses"))


def backlink_uses(claims: DataFrame) -> DataFrame:
    """The bag of backlinks: how often each claim with its statement is listed under a reference."""
    rows = _signed(claims).select(F.col("object_id").alias("ref_id"), "claim_id", "statement", SIGN)
    return rows.groupBy("ref_id", "claim_id", "statement").agg(F.sum(SIGN).cast("bigint").alias("uses"))


def chapter_counts(chapters: DataFrame, claim_counts: DataFrame, mystery_counts: DataFrame, uses: DataFrame) -> DataFrame:
    """``rollup.chapter_counts`` from the stored aggregates; null references are no references."""
    refs = uses.filter("ref_id IS NOT NULL").groupBy("chapter").agg(F.count("*").alias("refs"))
    joined = chapters.select("chapter").distinct()
    for counted in (claim_counts, mystery_counts, refs):
        joined = joined.join(counted, "chapter", "left")
    return joined.select("chapter", *[F.coalesce(c, F.lit(0)).alias(c) for c in ("claims", "mysteries", "refs")])


def backlink_counts(uses: DataFrame) -> DataFrame:
    """``rollup.backlink_counts`` from the stored bag."""
    return uses.groupBy("ref_id").agg(F.sum("uses").alias("backlinks"), F.countDistinct("claim_id").alias("distinct_claims"))
