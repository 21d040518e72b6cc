import pytest
from conftest import rows
from pyspark.sql import functions as F

from layerloom.functions import skew


@pytest.fixture(scope="module")
def facts(spark):
    # Key 0 holds over a third of the rows.
    key = F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 40)
    return spark.range(3000).select("id", key.alias("k")).cache()


@pytest.fixture(scope="module")
def dimension(spark):
    return spark.range(0, 30).select(F.col("id").alias("k"), (F.col("id") * 10).alias("v"))


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_every_join_way_agrees_with_a_plain_join(facts, dimension, how):
    expected = rows(facts.join(dimension, "k", how))
    assert rows(skew.join_dimension(facts, dimension, ["k"], how)) == expected
    assert rows(skew.join_dimension(facts, dimension, ["k"], how, small=False)) == expected
    counts = facts.groupBy("k").agg(F.count("*").alias("rows"))
    hot = skew.join_dimension(facts, dimension, ["k"], how, small=False, rows_per_key=counts, hot_rows=100)
    assert rows(hot) == expected


def test_large_side_is_not_broadcast(facts, dimension):
    assert skew.measured_small(dimension)
    assert not skew.measured_small(dimension, max_rows=10)
    assert not skew.measured_small(dimension, max_bytes=10)
    joined = skew.join_dimension(facts, dimension, ["k"], max_rows=10)
    assert "_salt" in joined._jdf.queryExecution().analyzed().toString()


def test_hot_key_is_spread_over_salts(facts, dimension):
    joined = skew.join_dimension(facts, dimension, ["k"], small=False, salt_by=["id"], hot_rows=100)
    shuffled = joined.withColumn("task", F.spark_partition_id()).filter("k = 0").groupBy("task").count()
    assert joined.filter("k = 0").count() == facts.filter("k = 0").count()
    assert shuffled.agg(F.max("count")).first()[0] < 1000


def test_rows_without_a_key_are_kept_and_spread(spark, dimension):
    facts = spark.range(1000).select("id", F.when(F.col("id") % 2 == 0, F.col("id") % 30).alias("k"))
    joined = skew.join_dimension(facts, dimension, ["k"], "left", small=False, hot_rows=100)
    assert rows(joined) == rows(facts.join(dimension, "k", "left"))


@pytest.mark.parametrize("group", [["k"], []])
def test_ranking_in_ranges_equals_one_window(facts, group):
    shown = [*group, "id", "position"]
    plain = skew.rank_within(facts, group, ["id"]).select(*shown)
    ranged = skew.rank_within(facts, group, ["id"], group_rows=50).select(*shown)
    assert rows(ranged) == rows(plain)


def test_ranking_by_strings_and_ties(spark):
    df = spark.createDataFrame([("g", c, i) for i, c in enumerate("bananaäß’zz")], "g string, c string, i int")
    plain = skew.rank_within(df, ["g"], ["c", "i"])
    assert rows(skew.rank_within(df, ["g"], ["c", "i"], group_rows=2)) == rows(plain)
