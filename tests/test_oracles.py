"""Every registered query against its SQL on the small tables."""

import glob
import os

import duckdb
import pytest

import __spark_entry__ as driver
from layerloom.plans.oracles import ORACLES
from layerloom.plans.queries import QUERIES


@pytest.fixture(scope="module")
def database(sf_dir):
    connection = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return connection


def plain(frame):
    frame = frame[sorted(frame.columns)]
    found = []
    for row in frame.itertuples(index=False, name=None):
        found.append(repr(tuple(round(float(v), 6) if isinstance(v, float) else getattr(v, "item", lambda v=v: v)() for v in row)))
    return sorted(found)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(driver.queries())
    assert set(ORACLES) <= set(driver.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_its_sql(spark, sf_dir, database, name):
    mine = QUERIES[name](spark, sf_dir).toPandas()
    theirs = database.execute(ORACLES[name]).fetchdf()
    assert sorted(mine.columns) == sorted(theirs.columns)
    assert len(mine) > 0
    assert plain(mine) == plain(theirs)


def test_entry_has_rows(spark):
    assert driver.entry(spark).count() == 200
