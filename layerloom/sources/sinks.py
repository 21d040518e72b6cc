"""Versioned page tables and the run log."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from layerloom.functions.skew import join_dimension
from layerloom.operators.lineage import changed_pages

# Most lines of one text part of a rendered page, and about the bytes of text of one written file.
PART_LINES = 10_000
FILE_BYTES = 256 * 1024 * 1024


def write_pages(pages: DataFrame, path: str, text: str = "text") -> None:
    """Write pages as Parquet by layer and section, so later reads prune to what they need.

    A section gets as many files as its measured text fills; small ones get one.
    """
    place = F.to_json(F.struct("layer", "section"), {"ignoreNullFields": "false"})
    placed = pages.withColumn("_place", place)
    size = F.sum(F.coalesce(F.octet_length(text), F.lit(0)))
    files = placed.groupBy("_place").agg(F.greatest(F.ceil(size / FILE_BYTES), F.lit(1)).cast("int").alias("_files"))
    dealt = join_dimension(placed, files, ["_place"], "left", salt_by=["path"]).drop("_place")
    spread = dealt.repartition("layer", "section", F.pmod(F.xxhash64("path"), F.col("_files"))).drop("_files")
    spread.write.mode("errorifexists").partitionBy("layer", "section").parquet(path)


def current_pages(base: DataFrame, versions: list[DataFrame], key: str = "path") -> DataFrame:
    """The pages as they are now: the newest version of every path, ``versions`` oldest first.

    Only paths that a later version holds are looked up, so each layer of changes is one anti join.
    """
    now = base
    for version in versions:
        now = now.join(version.select(key), key, "left_anti").unionByName(version, allowMissingColumns=True)
    return now


def page_text(lines: DataFrame, page: str, part_lines: int = PART_LINES) -> DataFrame:
    """Text of rendered pages (``n``, ``line``) as (page, part, text) for writing out.

    A page may hold any number of lines, so a text part holds ``part_lines`` lines at most; the
    parts of a page in order, joined by line breaks, are the page.
    """
    part = F.floor((F.col("n") - 1) / part_lines).cast("bigint")
    return (
        lines.groupBy(page, part.alias("part"))
        .agg(F.sort_array(F.collect_list(F.struct("n", "line"))).alias("_lines"))
        .select(page, "part", F.array_join(F.transform("_lines", lambda n: n["line"]), "\n").alias("text"))
    )


def write_changed(old: DataFrame, new: DataFrame, path: str, key: str = "path", text: str = "text") -> None:
    """Write only the new pages and those whose text differs, as a new version; nothing is edited in place."""
    write_pages(changed_pages(old, new, key, text), path, text)


def append_run_log(log: DataFrame, path: str) -> None:
    """Append run log rows: one at the start, one per unit, one at the end."""
    log.write.mode("append").parquet(path)


def run_log(units: DataFrame, run: str, unit: str, rc: str, message: str) -> DataFrame:
    """Log rows of a finished run: a start row, a row per unit and a done row."""
    total = units.agg(F.count("*").alias("n")).select("n")
    rows = units.select(
        F.lit(run).alias("run"), F.col(unit).cast("string").alias("unit"),
        F.col(rc).cast("int").alias("rc"), F.col(message).alias("message"),
    )
    start = total.select(
        F.lit(run).alias("run"), F.lit("start").alias("unit"), F.lit(0).alias("rc"),
        F.concat(F.lit("todo="), F.col("n").cast("string")).alias("message"),
    )
    done = total.select(
        F.lit(run).alias("run"), F.lit("done").alias("unit"), F.lit(0).alias("rc"), F.lit("").alias("message"),
    )
    return start.unionByName(rows).unionByName(done).withColumn("logged_at", F.current_timestamp())
