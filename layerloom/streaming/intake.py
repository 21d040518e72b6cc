"""Incremental page intake: new files in small batches, resumable after a stop."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from layerloom.operators.structure import split_front_matter, with_path_columns
from layerloom.sources.readers import file_path

FILES_PER_BATCH = 10


def page_stream(spark: SparkSession, root: str, files_per_batch: int = FILES_PER_BATCH) -> DataFrame:
    """Pages under ``root`` as a stream, ``files_per_batch`` files at a time."""
    base = root.rstrip("/")
    files = (
        spark.readStream
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", "*.md")
        .option("maxFilesPerTrigger", files_per_batch)
        .text(base, wholetext=True)
        .select(file_path().alias("path"), F.col("value").alias("text"))
    )
    return split_front_matter(with_path_columns(files, base.removeprefix("file:")))


def ingest_stream(
    spark: SparkSession,
    root: str,
    target: str,
    checkpoint: str,
    files_per_batch: int = FILES_PER_BATCH,
) -> StreamingQuery:
    """Take in every page not seen yet, then stop.

    The checkpoint remembers finished files. Each batch overwrites its own folder, so a batch that
    is repeated after a failure leaves its pages once.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{target}/batch={batch_id}")

    return (
        page_stream(spark, root, files_per_batch)
        .writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
