"""Words, row barriers and durable intermediates shared by the training-data operators."""

from __future__ import annotations

import sys
import tempfile
import uuid
from collections.abc import Callable

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Whitespace as the contracts name it: space and the characters 9 to 13.
SPACE = r"[\x20\x09-\x0D]+"
# Columns that operators read by name.
CORE = ("doc_id", "text", "lang", "source", "n_chars")
SPACE_CHARS = " \t\n\x0b\x0c\r"


def travels(module: str) -> None:
    """Send the functions of a module to the executors by value, so that they need no copy of it."""
    cloudpickle.register_pickle_by_value(sys.modules[module])


def text_of(column: str = "text") -> Column:
    """The text, a null one read as empty."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def words_of(text: Column) -> Column:
    """Maximal runs of characters other than whitespace; an empty array where there are none."""
    trimmed = F.btrim(text, F.lit(SPACE_CHARS))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, SPACE))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` with ``value`` worked out once, however often the body names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def pick(df: DataFrame, name: str, kind: str) -> Column:
    """A column by name, typed, or null where the table lacks it."""
    return (F.col(f"`{name}`") if name in df.columns else F.lit(None)).cast(kind).alias(name)


def guarded(docs: DataFrame) -> tuple[DataFrame, list[Column]]:
    """The rows with all columns but those of ``documents`` renamed, and the columns that restore them.

    So no column of the user meets a name that an operator uses on the way.
    """
    names = {c: c if c in CORE else f"_own{k}" for k, c in enumerate(docs.columns)}
    plain = docs.select(*[F.col(f"`{c}`").alias(name) for c, name in names.items()])
    return plain, [F.col(name).alias(c) for c, name in names.items()]


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors share. Where the session names none (tests), a local one is set."""
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not folder:
        folder = tempfile.mkdtemp(prefix="layerloom-")
        context.setCheckpointDir(folder)
    elif not context.getCheckpointDir():
        context.setCheckpointDir(folder)
    return folder


def durable(df: DataFrame) -> DataFrame:
    """The rows, computed now and kept in the shared folder: lost executors do not lose them."""
    shared_folder(df.sparkSession)
    return df.checkpoint()


def stored(df: DataFrame) -> DataFrame:
    """Like ``durable``, as Parquet: for whole texts that are read column by column afterwards."""
    path = f"{shared_folder(df.sparkSession)}/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")
