"""Reading pages, chapter fact logs, chapter lists, manifests and the arc dimension."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from layerloom import schemas
from layerloom.functions.text import chapter_number
from layerloom.operators.structure import with_path_columns


def file_path() -> Column:
    """The path of the current file with its percent escapes undone."""
    return F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))


def read_pages(
    spark: SparkSession,
    root: str,
    layers: Sequence[str] | None = None,
    sections: Sequence[str] | None = None,
) -> DataFrame:
    """One row per Markdown file; layers and sections given are selected by directory listing.

    Files are tiny and many: write the result to Parquet once and work on that.
    """
    base = root.rstrip("/")
    paths = [base]
    if layers:
        paths = [f"{p}/{layer}" for p in paths for layer in layers]
    if sections:
        paths = [f"{p}/{s}" for p in (paths if layers else [f"{base}/*"]) for s in sections]
    files = (
        spark.read
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", "*.md")
        .text(paths, wholetext=True)
        .select(file_path().alias("path"), F.col("value").alias("text"))
    )
    return with_path_columns(files, base.removeprefix("file:"))


def parse_fact_lines(lines: DataFrame, schema: str = schemas.FACT) -> DataFrame:
    """Fact rows from (file_name, value) lines; the chapter is the stem of the file."""
    chapter = F.regexp_extract("file_name", r"([^/]+?)\.jsonl?$", 1)
    return lines.select(chapter.alias("chapter"), F.from_json("value", schema).alias("_f")).select(
        "chapter", "_f.*"
    )


def read_fact_log(spark: SparkSession, folder: str, schema: str = schemas.FACT) -> DataFrame:
    """All chapter fact logs of a folder, one JSON object per line."""
    chapter = F.regexp_extract(F.col("_metadata.file_name"), r"^(.+?)\.jsonl?$", 1)
    columns = spark.createDataFrame([], schema).columns
    return spark.read.schema(schema).json(folder).select(chapter.alias("chapter"), *columns)


def read_chapter_list(lines: DataFrame, text: str = "value") -> DataFrame:
    """Chapter numbers out of comma-separated lines; blank items are skipped."""
    others = [c for c in lines.columns if c != text]
    item = F.trim(F.col("_item"))
    return (
        lines.select(*others, F.posexplode(F.split(F.col(text), ",")).alias("pos", "_item"))
        .filter(item != "")
        .select(*others, (F.col("pos") + 1).cast("bigint").alias("pos"), item.cast("int").alias("chapter"))
    )


def source_manifest(chapters: DataFrame, source_type: str = "primary_text") -> DataFrame:
    """Manifest of raw chapters: id, path, checksum and type; ``chapters`` is (chapter, text)."""
    return chapters.select(
        F.concat(F.lit("SRC_"), "chapter").alias("id"),
        "chapter",
        F.concat(F.lit("raw/"), "chapter", F.lit(".txt")).alias("local_path"),
        F.concat(F.lit("sha256:"), F.sha2("text", 256)).alias("checksum"),
        F.lit(source_type).alias("source_type"),
    )


def changed_sources(manifest: DataFrame, previous: DataFrame) -> DataFrame:
    """Chapters that are new or whose checksum moved since the previous manifest."""
    before = previous.select("id", F.col("checksum").alias("_before"))
    return (
        manifest.join(before, "id", "left")
        .filter(~F.col("checksum").eqNullSafe(F.col("_before")))
        .drop("_before")
    )


def arcs_dim(definitions: DataFrame) -> DataFrame:
    """Arc rows with numeric bounds from (id, name, slug, chapters.start, chapters.end, theme)."""
    return definitions.select(
        F.col("id").alias("arc_id"),
        "name",
        "slug",
        chapter_number(F.col("chapters.start")).alias("ch_start"),
        chapter_number(F.col("chapters.end")).alias("ch_end"),
        "theme",
    )


def read_arcs(spark: SparkSession, path: str) -> DataFrame:
    """Arc definitions stored as JSON lines."""
    return arcs_dim(spark.read.schema(schemas.CHAPTER_MAP).json(path))
