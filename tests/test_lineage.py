import pytest
from conftest import rows
from pyspark.sql import functions as F

from layerloom.operators import lineage
from layerloom.sources.sinks import current_pages


def frame(spark, schema, *made):
    return spark.createDataFrame(list(made), schema)


def test_lineage_by_path_then_by_case(spark):
    l1 = frame(spark, "path string", ("l1/references/ME_internet_flame_war.md",), ("l1/claims/A.md",))
    l2 = frame(
        spark, "page_id string, normalized_from string",
        ("a", "l1/claims/A.md"), ("b", "l1/references/ME_Internet_Flame_War.md"), ("c", "l1/gone.md"),
    )
    got = rows(lineage.lineage(l2, l1).select("page_id", "match", "l1_path"))
    assert got == [
        ("a", "exact", "l1/claims/A.md"), ("b", "case", "l1/references/ME_internet_flame_war.md"), ("c", "none", None),
    ]


def test_exact_parent_wins_over_another_spelling(spark):
    l1 = frame(spark, "path string", ("l1/a.md",), ("l1/A.md",))
    l2 = frame(spark, "page_id string, normalized_from string", ("x", "l1/a.md"), ("y", "l1/A.md"))
    assert rows(lineage.lineage(l2, l1).select("page_id", "l1_path")) == [("x", "l1/a.md"), ("y", "l1/A.md")]


def test_coverage_partitions_the_total(spark):
    l1 = frame(spark, "page_id string", ("a",), ("b",), ("b",))
    l2 = frame(spark, "page_id string", ("b",), ("c",))
    assert rows(lineage.layer_coverage(l1, l2)) == [("both", 1), ("only_l1", 1), ("only_l2", 1)]


def test_union_of_layers(spark):
    l1 = frame(spark, "page_id string", ("a",))
    l2 = frame(spark, "page_id string, run string", ("a", "r"))
    got = lineage.union_layers(l1, l2).select("layer", "page_id", "run")
    assert rows(got) == [("l1", "a", None), ("l2", "a", "r")]


def test_resume(spark):
    inputs, done = frame(spark, "unit string", ("a",), ("b",), ("c",)), frame(spark, "unit string", ("b",))
    assert rows(lineage.todo(inputs, done, "unit")) == [("a",), ("c",)]


@pytest.mark.parametrize("group_rows", [1_000_000, 4])
def test_batches_and_progress(spark, group_rows):
    units = spark.range(1, 24).select(F.col("id").alias("unit"))
    got = rows(lineage.batches(units, "unit", 10, group_rows).select("batch", "label", "units"))
    assert got == [(1, "1-10", 10), (2, "11-20", 10), (3, "21-23", 3)]
    shown = lineage.progress(units, "unit", group_rows).filter("unit = 23").select("label")
    assert rows(shown) == [("23/23",)]


def test_latest_run_by_time_then_version(spark):
    made = frame(
        spark, "page_id string, run string, text string",
        ("p", "20261116T1500_v143", "a"), ("p", "20261116T1700_v144", "b"), ("p", "20261116T1700_v99", "c"),
        ("q", "20251231T2359_v7", "d"),
    )
    assert rows(lineage.latest_run(made)) == [("p", "20261116T1700_v144", "b"), ("q", "20251231T2359_v7", "d")]


def test_changes(spark):
    old = frame(spark, "path string, text string", ("a", "1"), ("b", "2"), ("gone", "x"))
    new = frame(spark, "path string, text string", ("a", "1"), ("b", "3"), ("new", "y"))
    assert rows(lineage.changed_pages(old, new)) == [("b", "3"), ("new", "y")]
    assert rows(lineage.change_log(old, new, "T1")) == [
        ("b", "T1", "changed", "2", "3"), ("gone", "T1", "removed", "x", None), ("new", "T1", "added", None, "y"),
    ]


def test_lineage_without_a_parent(spark):
    l1 = frame(spark, "path string", ("l1/a.md",))
    l2 = frame(spark, "page_id string, normalized_from string", ("x", None), ("y", "l1/a.md"))
    assert rows(lineage.lineage(l2, l1).select("page_id", "match", "l1_path")) == [
        ("x", "none", None), ("y", "exact", "l1/a.md"),
    ]


def test_null_text_is_a_text_of_its_own(spark):
    old = frame(spark, "path string, text string", ("a", None), ("b", None))
    new = frame(spark, "path string, text string", ("a", None), ("b", "1"))
    assert rows(lineage.changed_pages(old, new)) == [("b", "1")]
    assert rows(lineage.change_log(old, new, "T1").select("path", "change")) == [("b", "changed")]


def test_current_pages_are_the_newest_versions(spark):
    schema = "path string, text string"
    base = frame(spark, schema, ("a", "1"), ("b", "2"))
    first, second = frame(spark, schema, ("a", "3"), ("c", "4")), frame(spark, schema, ("c", "5"))
    assert rows(current_pages(base, [first, second])) == [("a", "3"), ("b", "2"), ("c", "5")]


def test_run_summary(spark):
    log = frame(spark, "unit string, rc int", ("a", 0), ("a", 1), ("b", 0))
    assert rows(lineage.run_summary(log)) == [("a", 2, 1, 1), ("b", 1, 1, 0)]
