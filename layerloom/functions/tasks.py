"""What tasks need from the driver's side: functions that travel by value, and intermediates that outlive executors."""

from __future__ import annotations

import sys
import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession


def travels(module: str) -> None:
    """Send the functions of a module to the executors by value, so that they need no copy of it."""
    cloudpickle.register_pickle_by_value(sys.modules[module])


travels(__name__)

# Bytes of text and rows that a task turns into Python objects at once.
PART_BYTES = 1 << 20
PART_ROWS = 64


def text_parts(batch: pa.RecordBatch, texts: list[str], most: int = PART_BYTES) -> Iterator[pa.RecordBatch]:
    """The rows of a batch in parts of about ``most`` bytes in the columns ``texts`` and at most ``PART_ROWS`` rows."""
    size = np.full(batch.num_rows, -(-most // PART_ROWS))
    for name in texts:
        size += pc.fill_null(pc.binary_length(batch.column(name)), 0).to_numpy(zero_copy_only=False)
    # A row belongs to the part in which it begins.
    part = (np.cumsum(size) - size) // most
    edges = [*np.flatnonzero(np.diff(part, prepend=-1)), batch.num_rows]
    for first, last in zip(edges, edges[1:]):
        yield batch.slice(first, last - first)


def shared_folder(spark: SparkSession) -> str:
    """The folder that all executors share, as ``spark.checkpoint.dir`` names it.

    A local session without one gets a folder of its own; on a cluster that would be lost with its machine.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not folder:
        if not context.master.startswith("local[") and context.master != "local":
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="layerloom-")
    if not context.getCheckpointDir():
        context.setCheckpointDir(folder)
    return folder


def kept(df: DataFrame) -> DataFrame:
    """The rows, computed now and kept as Parquet in the shared folder: lost executors do not lose them."""
    path = f"{shared_folder(df.sparkSession)}/kept-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
