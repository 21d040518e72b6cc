"""Toxicity: a linear classifier on character n-grams scaled by naive Bayes log-count ratios.

How many labelled texts of each class hold each hashed n-gram is counted over all training rows.
The log ratios of those counts scale the features; the most telling ones are kept and weighted by
logistic regression, fitted on a bounded number of training rows. Every whole text is then scored
inside its task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from layerloom.functions.skew import measured_small
from layerloom.llm.byte_text import lowered, pieces, rows_of
from layerloom.llm.common import text_of, travels

travels(__name__)

BUCKETS = 1 << 18
ORDERS = (4, 5, 6)
# Features kept, by their chi-square over all training rows.
FEATURES = 1024
# A feature occurs in at least so many training rows.
MIN_ROWS = 5
# Rows of each class that the regression is fitted on, the first by a hash of the id.
FIT_ROWS = 2048
SMOOTHING = 1.0
PENALTY = 1.0
HELD_OUT = 5


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % HELD_OUT == 0, F.lit(False))


def _grams(data: np.ndarray, at: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Buckets of the n-grams of each order, and where each begins; none spans two rows."""
    low = lowered(data)
    low[low < 0x20] = 0x20
    wide = low.astype(np.uint32)
    for n in ORDERS:
        if len(low) < n:
            continue
        h = np.full(len(low) - n + 1, n, np.uint32)
        for k in range(n):
            h = h * np.uint32(0x01000193) ^ wide[k : len(low) - n + 1 + k]
        h = (h ^ (h >> np.uint32(15))) * np.uint32(0x85EBCA6B)
        bucket = (h >> np.uint32(14)).astype(np.int64)
        whole = np.ones(len(h), bool)
        for edge in range(1, n):
            cut = at[1:-1] - edge
            whole[cut[(cut >= 0) & (cut < len(h))]] = False
        yield bucket[whole], np.flatnonzero(whole)


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per task: rows of each class with each n-gram; the rows themselves at bucket ``BUCKETS``."""
    counts = np.zeros((2, BUCKETS + 1), np.int64)
    for batch in batches:
        label = batch.column(1).to_numpy(zero_copy_only=False).astype(np.int64)
        counts[:, BUCKETS] += np.bincount(label, minlength=2)
        for row, data, at in pieces(*rows_of(batch.column(0))):
            if not len(data):
                continue
            keys = [(np.searchsorted(at, start, side="right") - 1) * BUCKETS + bucket for bucket, start in _grams(data, at)]
            distinct = np.unique(np.concatenate(keys)) if keys else np.zeros(0, np.int64)
            np.add.at(counts, (label[row + distinct // BUCKETS], distinct % BUCKETS), 1)
    seen = np.flatnonzero(counts.any(axis=0))
    yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(counts[0, seen]), pa.array(counts[1, seen])], names=["bucket", "clean", "toxic"])


def _active(column: pa.Array, place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, feature) pairs, each once, of a column of texts; ``place`` maps buckets to features or -1."""
    rows, features = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for row, data, at in pieces(*rows_of(column)):
        for bucket, start in _grams(data, at) if len(data) else ():
            feature = place[bucket]
            hit = np.flatnonzero(feature >= 0)
            rows.append(row + np.searchsorted(at, start[hit], side="right") - 1)
            features.append(feature[hit])
    pairs = np.unique(np.concatenate(rows) * FEATURES + np.concatenate(features))
    return pairs // FEATURES, pairs % FEATURES


def _featured(place: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row, feature = _active(batch.column(0), place)
            ends = np.searchsorted(row, np.arange(batch.num_rows + 1)).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(feature.astype(np.int32)))
            yield pa.RecordBatch.from_arrays([batch.column(1), batch.column(2), lists], names=["label", "draw", "features"])

    return run


def _fit(x: np.ndarray, y: np.ndarray, prior: float) -> tuple[np.ndarray, float]:
    """Weights and intercept of a ridge logistic regression by Newton steps; the intercept fits the prior."""
    design = np.hstack([x, np.ones((len(x), 1))])
    weights = np.zeros(design.shape[1])
    ridge = np.full(design.shape[1], PENALTY)
    ridge[-1] = 1e-6
    for _ in range(25):
        p = 1 / (1 + np.exp(-np.clip(design @ weights, -30, 30)))
        gradient = design.T @ (p - y) + ridge * weights
        curve = design.T @ (design * (p * (1 - p))[:, None]) + np.diag(ridge)
        step = np.linalg.solve(curve, gradient)
        weights -= step
        if np.abs(step).max() < 1e-6:
            break
    shift = np.log(prior / (1 - prior)) - np.log(y.mean() / (1 - y.mean()))
    return weights[:-1], float(weights[-1] + shift)


def train(docs: DataFrame, labels: DataFrame) -> tuple[np.ndarray, float] | None:
    """A weight per n-gram bucket and an intercept; None without training rows of both classes.

    A label counts once per document: 1 where any of its rows says so. Null labels are no labels.
    """
    truth = labels.filter("doc_id is not null and toxic in (0, 1)").groupBy("doc_id").agg(F.max("toxic").alias("label"))
    truth = truth.filter(~held_out(F.col("doc_id")))
    small = measured_small(truth)
    rows = docs.select("doc_id", text_of().alias("text")).join(F.broadcast(truth) if small else truth, "doc_id")
    found = (
        rows.select("text", "label")
        .mapInArrow(_counted, "bucket bigint, clean bigint, toxic bigint")
        .groupBy("bucket")
        .agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
        .toPandas()
    )
    counts = np.zeros((2, BUCKETS + 1))
    counts[:, found["bucket"]] = found[["clean", "toxic"]].to_numpy().T
    total, counts = counts[:, -1], counts[:, :-1]
    if not total.all():
        return None
    both = counts.sum(axis=0)
    expected = both * total[1] / total.sum()
    spread = np.maximum(both * (total.prod() / total.sum() ** 2) * (1 - both / total.sum()), 1e-9)
    telling = np.where(both >= min(MIN_ROWS, total.min()), (counts[1] - expected) ** 2 / spread, 0.0)
    chosen = np.lexsort((np.arange(BUCKETS), -telling))[:FEATURES]
    smooth = counts + SMOOTHING
    ratio = np.log(smooth[1] / smooth[1].sum()) - np.log(smooth[0] / smooth[0].sum())
    place = np.full(BUCKETS, -1, np.int32)
    place[chosen] = np.arange(len(chosen))
    drawn = rows.select("text", "label", F.xxhash64("doc_id").alias("draw")).mapInArrow(
        _featured(place), "label int, draw bigint, features array<int>"
    )
    sample = pd.concat([drawn.filter(F.col("label") == c).orderBy("draw").limit(FIT_ROWS).toPandas() for c in (0, 1)])
    x = np.zeros((len(sample), len(chosen)))
    for k, features in enumerate(sample["features"]):
        x[k, list(features)] = ratio[chosen[list(features)]]
    fitted, intercept = _fit(x, sample["label"].to_numpy(float), total[1] / total.sum())
    weights = np.zeros(BUCKETS)
    weights[chosen] = fitted * ratio[chosen]
    return weights, intercept


def _scored(weights: np.ndarray, intercept: float, columns: int):
    chosen = np.flatnonzero(weights)
    place = np.full(BUCKETS, -1, np.int32)
    place[chosen] = np.arange(len(chosen))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row, feature = _active(batch.column(0), place)
            total = np.bincount(row, weights[chosen[feature]], minlength=batch.num_rows) + intercept
            score = 1 / (1 + np.exp(-np.clip(total, -30, 30)))
            kept = [batch.column(k + 1) for k in range(columns)]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(score)], names=[*batch.schema.names[1:], "score"])

    return run


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id``, ``held_out``, ``score`` and ``predicted`` of every row.

    A null or empty text has no n-grams and gets the score of the intercept; a null doc_id is
    scored and not held out; repeated rows score alike; without labels of both classes every score
    is 0; an empty table gives an empty result. Only the text enters a score.
    """
    model = train(docs, labels)
    if model is None:
        scored = docs.select("doc_id", F.lit(0.0).alias("score"))
    else:
        kind = dict(docs.dtypes)["doc_id"]
        scored = docs.select(text_of().alias("text"), "doc_id").mapInArrow(_scored(*model, 1), f"doc_id {kind}, score double")
    return scored.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )
