"""Layers, versions and unfinished work."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from layerloom.functions.skew import join_dimension, rank_within
from layerloom.functions.text import run_parts


def lineage(l2: DataFrame, l1: DataFrame) -> DataFrame:
    """Each L2 page with the L1 path it came from: exact, by letter case only, or none.

    ``l2`` names its parent in ``normalized_from``. Both sides of each join are unique paths.
    """
    paths = l1.select(F.col("path").alias("normalized_from"))
    named = l2.filter(F.col("normalized_from").isNotNull())
    exact = named.join(paths, "normalized_from", "left_semi").withColumns(
        {"match": F.lit("exact"), "l1_path": F.col("normalized_from")}
    )
    # Only what has no exact parent is folded, so exact matches never share one empty join key.
    folded = l1.groupBy(F.lower("path").alias("_folded")).agg(F.min("path").alias("l1_path"))
    rest = named.join(paths, "normalized_from", "left_anti").withColumn("_folded", F.lower("normalized_from"))
    by_case = rest.join(folded, "_folded", "left").drop("_folded").withColumn(
        "match", F.when(F.col("l1_path").isNotNull(), "case").otherwise("none")
    )
    orphans = l2.filter(F.col("normalized_from").isNull()).withColumns(
        {"match": F.lit("none"), "l1_path": F.lit(None).cast("string")}
    )
    return exact.unionByName(by_case).unionByName(orphans)


def union_layers(l1: DataFrame, l2: DataFrame) -> DataFrame:
    """Both layers in one table, told apart by ``layer``."""
    return l1.withColumn("layer", F.lit("l1")).unionByName(
        l2.withColumn("layer", F.lit("l2")), allowMissingColumns=True
    )


def layer_coverage(l1: DataFrame, l2: DataFrame, key: str = "page_id") -> DataFrame:
    """How many pages are in both layers, only in L1 and only in L2.

    Presence is aggregated per key, so one shuffle of ids is enough and copies do not multiply.
    """
    both = (
        l1.select(key, F.lit(1).alias("_l1"), F.lit(0).alias("_l2"))
        .unionByName(l2.select(key, F.lit(0).alias("_l1"), F.lit(1).alias("_l2")))
        .groupBy(key)
        .agg(F.max("_l1").alias("_l1"), F.max("_l2").alias("_l2"))
    )
    status = F.when((F.col("_l1") == 1) & (F.col("_l2") == 1), "both").when(
        F.col("_l1") == 1, "only_l1"
    ).otherwise("only_l2")
    return both.groupBy(status.alias("coverage")).agg(F.count("*").alias("pages"))


def todo(inputs: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """Inputs that have no output yet."""
    return inputs.join(done.select(key), key, "left_anti")


def batches(units: DataFrame, key: str, size: int = 10, group_rows: int | None = None) -> DataFrame:
    """Consecutive batches of ``size`` units in key order with their first and last unit."""
    numbered = rank_within(units.select(key).distinct(), [], [key], "_n", group_rows)
    number = F.floor((F.col("_n") - 1) / size).cast("bigint") + 1
    return numbered.groupBy(number.alias("batch")).agg(
        F.min(key).alias("first"), F.max(key).alias("last"), F.count("*").alias("units")
    ).withColumn("label", F.concat(F.col("first"), F.lit("-"), F.col("last")))


def progress(units: DataFrame, key: str, group_rows: int | None = None) -> DataFrame:
    """Place of every unit in key order and the total, with the label ``i/N``."""
    numbered = rank_within(units.select(key).distinct(), [], [key], "i", group_rows)
    total = units.select(key).distinct().agg(F.count("*").alias("n")).scalar()
    return numbered.withColumn("n", total).withColumn(
        "label", F.concat(F.col("i").cast("string"), F.lit("/"), F.col("n").cast("string"))
    )


def latest_run(pages: DataFrame, key: str = "page_id", run: str = "run") -> DataFrame:
    """The newest version of each page by run time, then run version.

    An aggregation, not a window: a page with very many versions is reduced before the shuffle.
    """
    parts = run_parts(F.col(run))
    row = F.struct(*[F.col(c) for c in pages.columns if c != key])
    order = F.struct(parts["run_ts"], parts["version"], F.col(run))
    return pages.groupBy(key).agg(F.max_by(row, order).alias("_row")).select(key, "_row.*")


def moved_keys(old: DataFrame, new: DataFrame, key: str, text: str) -> DataFrame:
    """Keys whose texts differ, with ``_old`` and ``_new``: whether each side has the key."""

    def marked(df: DataFrame, name: str) -> DataFrame:
        digest = F.sha2(F.col(text).cast("string"), 256)
        return df.select(key, F.lit(True).alias(f"_{name}"), digest.alias(f"_{name}_sha"))

    both = marked(old, "old").join(marked(new, "new"), key, "full")
    present = {c: F.coalesce(F.col(c), F.lit(False)) for c in ("_old", "_new")}
    differs = (F.col("_old") != F.col("_new")) | ~F.col("_old_sha").eqNullSafe(F.col("_new_sha"))
    return both.withColumns(present).filter(differs).select(key, "_old", "_new")


def changed_pages(old: DataFrame, new: DataFrame, key: str = "path", text: str = "text") -> DataFrame:
    """Pages of ``new`` that are not in ``old`` or whose text differs there.

    Keys and checksums are compared first; texts of unchanged pages are not shuffled while the list
    of changed keys is measured small.
    """
    moved = moved_keys(old, new, key, text).filter("_new").select(key)
    return join_dimension(new, moved, [key], "left_semi")


def change_log(
    old: DataFrame, new: DataFrame, rule: str, key: str = "path", text: str = "text"
) -> DataFrame:
    """Before and after of every page that was added, removed or changed by a rule.

    Keys and checksums are compared first; texts are fetched for the differing keys only.
    """
    change = F.when(~F.col("_old"), "added").when(~F.col("_new"), "removed").otherwise("changed")
    moved = moved_keys(old, new, key, text).select(key, change.alias("change"))
    before, after = (
        join_dimension(df.select(key, F.col(text).alias(name)), moved.select(key), [key], "left_semi")
        for df, name in ((old, "before"), (new, "after"))
    )
    return moved.join(before, key, "left").join(after, key, "left").select(
        key, F.lit(rule).alias("rule"), "change", "before", "after"
    )


def run_summary(log: DataFrame, unit: str = "unit", code: str = "rc") -> DataFrame:
    """Units run, succeeded and failed by return code."""
    return log.groupBy(unit).agg(
        F.count("*").alias("runs"),
        F.count_if(F.col(code) == 0).alias("ok"),
        F.count_if(F.col(code) != 0).alias("failed"),
    )


def l2_front_matter(front_matter: Column, path: Column, run: Column) -> Column:
    """Front matter of an L2 page: the L1 text plus its parent and run."""
    return F.concat(front_matter, F.lit("\nnormalized_from: "), path, F.lit("\nl2_run: "), run)


