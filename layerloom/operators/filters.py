"""Row filters: what a reader may see, how strong the evidence is, what is still empty."""

from __future__ import annotations

import functools
import operator
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from layerloom.fixed_values import APPLIED_CONFIDENCES, EVIDENCE_LEVELS, PLACEHOLDERS
from layerloom.functions import text as tx
from layerloom.functions.explode import worked_out


def visible_at(df: DataFrame, chapter: str, column: str = "spoiler_after") -> DataFrame:
    """Rows a reader who has finished ``chapter`` may see, within that chapter's edition."""
    reader = int(chapter.removeprefix("ch"))
    # Numbers of one edition lie on one side of the second edition's first number.
    first = tx.SECOND_EDITION_START if reader >= tx.SECOND_EDITION_START else 0
    return df.filter(tx.chapter_number(F.col(column)).between(first, reader))


def min_evidence(
    df: DataFrame,
    level: str,
    review_status: str | None = None,
    document_status: str | None = None,
) -> DataFrame:
    """Rows at or above an evidence level, optionally of one review or document status."""
    kept = df.filter(F.col("evidence_strength").isin(EVIDENCE_LEVELS[EVIDENCE_LEVELS.index(level):]))
    if review_status is not None:
        kept = kept.filter(F.col("review_status") == review_status)
    if document_status is not None:
        kept = kept.filter(F.col("document_status") == document_status)
    return kept


def of(pages: DataFrame, layer: str, section: str | None = None) -> DataFrame:
    """One layer, or one section of it; prunes partitions of a table written by both."""
    kept = pages.filter(F.col("layer") == layer)
    return kept if section is None else kept.filter(F.col("section") == section)


def has_placeholder(body: Column, placeholders: Sequence[str] = PLACEHOLDERS) -> Column:
    # Plain searches of bytes; a pattern would try every text at every character.
    return functools.reduce(operator.or_, [F.contains(body, F.lit(p)) for p in placeholders], F.lit(False))


def stub_pages(
    pages: DataFrame, elements: str | None = None, placeholders: Sequence[str] = PLACEHOLDERS
) -> DataFrame:
    """Pages with template text left in them or, given ``elements``, with an empty list."""
    unfilled = has_placeholder(F.col("body"), placeholders)
    empty = F.lit(False) if elements is None else F.size(elements) == 0
    marked = pages.withColumns({"has_placeholder": unfilled, "is_empty": empty})
    return worked_out(marked).filter("has_placeholder OR is_empty")


def thin_units(
    observations: DataFrame, units: DataFrame, minimum: int, key: str = "unit"
) -> DataFrame:
    """Units with fewer than ``minimum`` observations, those without any included."""
    counted = observations.groupBy(key).agg(F.count("*").alias("observed"))
    full = counted.withColumnRenamed(key, "_unit")
    joined = units.select(key).distinct().join(full, F.col(key) == F.col("_unit"), "left")
    return joined.select(key, F.coalesce("observed", F.lit(0)).alias("observed")).filter(
        F.col("observed") < minimum
    )


def applied(ledger: DataFrame) -> DataFrame:
    """Ledger rows sure enough to be applied."""
    return ledger.filter(F.col("confidence").isin(APPLIED_CONFIDENCES))
