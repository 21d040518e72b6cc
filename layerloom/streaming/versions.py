"""The newest run of every page as a keyed stream: late versions are rejected, also after a restart."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from layerloom.functions.tasks import travels

travels(__name__)

RUN = re.compile(r"(\d{8}T\d{4})_v(\d+)")

VERSION = "page_id string, run string, text string, accepted boolean"
STATE = "run string"


def run_order(run: str | None) -> tuple:
    """Sort key of a run id: its minute, its version, its text; one that is no run id comes first."""
    found = RUN.fullmatch(run or "")
    return (found is not None, found[1] if found else "", int(found[2]) if found else -1, run or "")


def _judge(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    """The rows of one page and trigger: the newest is accepted where it is newer than the one held.

    The state is one run id, whatever the number of versions and the size of their texts.
    """
    held = state.get[0] if state.exists else None
    best, known = None, state.exists
    for frame in frames:
        late = []
        for run, text in zip(frame["run"], frame["text"]):
            run = run if isinstance(run, str) else None
            text = text if isinstance(text, str) else None
            if known and run_order(run) <= run_order(held):
                late.append((key[0], run, text, False))
                continue
            if best is not None:
                late.append((key[0], *best, False))
            held, known, best = run, True, (run, text)
        if late:
            yield pd.DataFrame(late, columns=["page_id", "run", "text", "accepted"])
    if best is not None:
        state.update((held or "",))
        yield pd.DataFrame([(key[0], *best, True)], columns=["page_id", "run", "text", "accepted"])


def judged_versions(versions: DataFrame) -> DataFrame:
    """A stream of (page_id, run, text) with ``accepted``: true for rows that were the newest of their page when
    their trigger ended, false for those that came late or were overtaken within it."""
    rows = versions.selectExpr("CAST(page_id AS STRING) AS page_id", "run", "text")
    return rows.groupBy("page_id").applyInPandasWithState(_judge, VERSION, STATE, "append", GroupStateTimeout.NoTimeout)


def follow_versions(versions: DataFrame, target: str, checkpoint: str) -> StreamingQuery:
    """Judge every version that is there and not judged yet, then stop.

    The checkpoint holds the newest run of every page, so a later start goes on from it. A batch overwrites its
    own folder, so one that is repeated after a failure leaves its rows once.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{target}/batch={batch_id}")

    return (
        judged_versions(versions)
        .writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def newest_versions(spark: SparkSession, target: str) -> DataFrame:
    """The newest version of every page out of what ``follow_versions`` has written: the last one accepted."""
    rows = spark.read.schema(f"{VERSION}, batch bigint").parquet(target).filter("accepted")
    last = F.max_by(F.struct("run", "text"), "batch").alias("_last")
    return rows.groupBy("page_id").agg(last).select("page_id", "_last.*")
