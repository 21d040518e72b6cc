"""Turning arrays into rows without evaluating them twice."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def worked_out(df: DataFrame) -> DataFrame:
    """The same rows, their columns computed here and only once.

    A filter on a derived column is otherwise pushed to the scan with the whole derivation inlined,
    which then runs again for the rows that stay.
    """
    return df.select(F.explode(F.array(F.struct(*df.columns))).alias("_row")).select("_row.*")


def explode_rows(df: DataFrame, array: Column | str, *keep: Column | str, item: str = "_item") -> DataFrame:
    """One row per element: the kept columns, ``_at`` (from 0) and the element.

    The outer form with a filter behind it gives the rows of a plain explode. A plain explode lets
    the optimizer put ``size(array) > 0`` in front of the scan, which computes the array again.
    Kept columns are worked out before the explode, so that no row drags the array along.
    """
    ready = df.select(*keep, (F.col(array) if isinstance(array, str) else array).alias("_array"))
    kept = [c for c in ready.columns if c != "_array"]
    return ready.select(*kept, F.posexplode_outer("_array").alias("_at", item)).filter(
        F.col("_at").isNotNull()
    )
