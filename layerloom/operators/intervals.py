"""Ranges of any width and the units in them: an interval join over nested bins.

Bins nest by ``FAN``: a bin of one level is ``FAN`` bins of the level below. A range takes the few largest bins
that fill it exactly, at most ``2 * (FAN - 1)`` per level however wide it is, and a unit asks for its bin on
every level that some range uses. Both meet by equality; hot bins are cut into shares by measured rows.

Totals of the units of a range need no pair of a unit and a range: units are summed per bin first.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from layerloom.functions.skew import join_dimension
from layerloom.functions.tasks import kept

# Bins of one level in a bin of the next, as a power of two, and the levels.
FAN_BITS = 4
LEVELS = 15


def _floor(value: Column, level: int) -> Column:
    return F.shiftright(value, FAN_BITS * level)


def _ceil(value: Column, level: int) -> Column:
    return F.shiftright(value + F.lit((1 << (FAN_BITS * level)) - 1), FAN_BITS * level)


def bins_of_range(low: Column, high: Column) -> Column:
    """(level, bin) of the largest bins that together are exactly the units ``low`` to ``high``, both included.

    On each level the bins beside those of the next level are taken, and all of them where that has none inside.
    """
    none = F.array().cast("array<bigint>")

    def span(first: Column, last: Column) -> Column:
        return F.when(first <= last, F.sequence(first, last)).otherwise(none)

    def taken(level: int) -> Column:
        first, last = _ceil(low, level), _floor(high + 1, level) - 1
        if level + 1 == LEVELS:
            return span(first, last)
        inner_first = F.shiftleft(_ceil(low, level + 1), FAN_BITS)
        inner_last = F.shiftleft(_floor(high + 1, level + 1), FAN_BITS) - 1
        beside = F.concat(span(first, F.least(last, inner_first - 1)), span(F.greatest(first, inner_last + 1), last))
        return F.when(inner_first > inner_last, span(first, last)).otherwise(beside)

    def marked(level: int) -> Column:
        return F.transform(taken(level), lambda b: F.struct(F.lit(level).alias("level"), b.alias("bin")))

    return F.flatten(F.array(*[marked(n) for n in range(LEVELS)]))


def _spread(ranges: DataFrame, low: str, high: str) -> DataFrame:
    """The ranges that hold something, a row for each of their bins."""
    first, last = F.greatest(F.col(low).cast("bigint"), F.lit(0)), F.col(high).cast("bigint")
    return ranges.filter(first <= last).withColumn("_part", F.explode(bins_of_range(first, last))).select(
        *ranges.columns, F.col("_part.level").alias("_level"), F.col("_part.bin").alias("_bin")
    )


def _placed(units: DataFrame, unit: str, spread: DataFrame) -> DataFrame:
    """The units, a row for each level that ``spread`` uses."""
    # As many rows as levels.
    used = sorted(r[0] for r in spread.select("_level").distinct().collect()) or [0]
    number = F.col(unit).cast("bigint")
    asked = F.array(*[F.struct(F.lit(n).alias("level"), _floor(number, n).alias("bin")) for n in used])
    return units.filter(number >= 0).withColumn("_part", F.explode(asked)).select(
        *units.columns, F.col("_part.level").alias("_level"), F.col("_part.bin").alias("_bin")
    )


def ranges_of_units(units: DataFrame, ranges: DataFrame, unit: str = "unit", low: str = "low", high: str = "high") -> DataFrame:
    """Every unit row beside every inclusive range it lies in; ranges may overlap, units in none are left out.

    ``unit``, ``low`` and ``high`` are whole numbers from 0, below 2 ** 60; a range that ends before it begins,
    or lacks an end, holds nothing. Columns of both sides come along and must differ in name.
    """
    spread = _spread(ranges, low, high)
    return join_dimension(_placed(units, unit, spread), spread, ["_level", "_bin"], "inner").drop("_level", "_bin")


def range_totals(
    units: DataFrame, ranges: DataFrame, sums: list[str], unit: str = "unit", low: str = "low", high: str = "high"
) -> DataFrame:
    """Every range row that holds a unit, with ``rows``, ``first`` and ``last`` of its units and the totals of ``sums``.

    What ``ranges_of_units`` gives, grouped by range rows (equal ones together), at the cost of the bins of the
    ranges: units are summed per unit, then per bin. ``sums`` are columns of whole numbers; nulls add nothing.
    """
    number = F.col(unit).cast("bigint")
    parts = [F.sum("_rows").alias("_rows"), F.min("_first").alias("_first"), F.max("_last").alias("_last"), *[F.sum(f"_sum_{c}").alias(f"_sum_{c}") for c in sums]]
    # Read for the measurement of the bins and for the join.
    per_unit = kept(units.groupBy(number.alias("_unit")).agg(
        F.count("*").alias("_rows"), F.min(number).alias("_first"), F.max(number).alias("_last"), *[F.sum(c).alias(f"_sum_{c}") for c in sums]
    ))
    spread = _spread(ranges, low, high)
    per_bin = _placed(per_unit, "_unit", spread).groupBy("_level", "_bin").agg(*parts)
    # The bins of the ranges are the large side; a bin has one row of totals.
    met = join_dimension(spread, per_bin, ["_level", "_bin"], "inner")
    whole = met.groupBy(*ranges.columns).agg(*parts)
    return whole.select(
        *ranges.columns, F.col("_rows").alias("rows"), F.col("_first").alias("first"), F.col("_last").alias("last"),
        *[F.col(f"_sum_{c}").alias(c) for c in sums],
    )
