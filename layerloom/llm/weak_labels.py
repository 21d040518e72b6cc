"""Quality classifier from weak labels.

Overlapping heuristics vote good, bad or not at all on every document. Expectation maximisation on
the counts of vote patterns, a table of at most ``3 ** 8`` rows over all documents, estimates how
accurate each heuristic is and what each pattern says. These posteriors are the labels that a
hashed linear scorer is trained on; the scorer reads the text alone and judges every document,
also where the heuristics are silent.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from layerloom.llm.byte_text import pieces, rows_of, word_hashes
from layerloom.llm.common import text_of, travels

travels(__name__)

HEURISTICS = ("length", "symbols", "symbols_per_word", "capitals", "repeats", "word_length", "variety", "stops")
# Documents that the scorer is fitted on, drawn by a hash of the id.
FIT_ROWS = 4096
CLASS_BUCKETS = 512
WORD_BUCKETS = 512
SHAPES = 4
WIDTH = CLASS_BUCKETS + WORD_BUCKETS + SHAPES
ROUNDS = 50
PENALTY = 1.0


def _classes() -> np.ndarray:
    """Eight classes of bytes: small, capital, digit, space, newline, stop, other sign, beyond ASCII."""
    table = np.full(256, 6, np.int64)
    table[97:123], table[65:91], table[48:58] = 0, 1, 2
    table[:33], table[10] = 3, 4
    table[[ord(c) for c in ".,;:'\"?()-"]] = 5
    table[128:] = 7
    return table


def _measured(column: pa.Array, n: int, features: bool) -> tuple[dict[str, np.ndarray], np.ndarray | None]:
    """Counts per row, and the hashed feature counts per row if asked for."""
    table = _classes()
    counts = {k: np.zeros(n) for k in ("bytes", "small", "capital", "sign", "stop", "space", "words", "same", "distinct")}
    x = np.zeros((n, WIDTH), np.float32) if features else None
    for row, data, at in pieces(*rows_of(column)):
        if not len(data):
            continue
        kinds = table[data]
        rows = row + np.repeat(np.arange(len(at) - 1), np.diff(at))
        for name, kind in (("small", (0, 7)), ("capital", (1,)), ("sign", (6,)), ("stop", (5,)), ("space", (3, 4))):
            counts[name] += np.bincount(rows[np.isin(kinds, kind)], minlength=n)
        counts["bytes"] += np.bincount(rows, minlength=n)
        h, r = word_hashes(data, at)
        r = r + row
        counts["words"] += np.bincount(r, minlength=n)
        counts["same"] += np.bincount(r[1:][(h[1:] == h[:-1]) & (r[1:] == r[:-1])], minlength=n)
        order = np.lexsort((h, r))
        fresh = np.append(True, (h[order][1:] != h[order][:-1]) | (r[order][1:] != r[order][:-1])) if len(h) else np.zeros(0, bool)
        counts["distinct"] += np.bincount(r[order][fresh], minlength=n)
        if x is not None:
            if len(kinds) > 2:
                gram = kinds[:-2] * 64 + kinds[1:-1] * 8 + kinds[2:]
                inside = rows[:-2] == rows[2:]
                np.add.at(x, (rows[:-2][inside], gram[inside]), 1)
            np.add.at(x, (r, CLASS_BUCKETS + (h % np.uint64(WORD_BUCKETS)).astype(np.int64)), 1)
    return counts, x


def _votes(c: dict[str, np.ndarray]) -> np.ndarray:
    """One row per heuristic: 2 good, 0 bad, 1 no vote."""
    words, size = np.maximum(c["words"], 1), np.maximum(c["bytes"], 1)
    letters = np.maximum(c["small"] + c["capital"], 1)
    # A heuristic that sees nothing wrong of its own kind says nothing; only full sentences speak for a text.
    bad = lambda flag: np.where(flag, 0, 1)
    short, mean, stops = c["words"] < 20, letters / words, c["stop"] / words
    return np.array([
        bad(short),
        bad(c["sign"] / size > 0.02),
        bad(c["sign"] / words > 0.25),
        bad((c["capital"] / letters > 0.3) & ~short),
        bad((c["same"] / words > 0.1) & ~short),
        bad((mean < 2) | (mean > 9)),
        bad((c["distinct"] / words < 0.3) & (c["words"] < 2000) & ~short),
        np.where((stops < 0.01) & ~short, 0, np.where((c["words"] >= 40) & (stops > 0.02) & (stops < 0.5), 2, 1)),
    ]).astype(np.int64)


def _pattern(votes: np.ndarray) -> np.ndarray:
    return (votes * (3 ** np.arange(len(HEURISTICS)))[:, None]).sum(axis=0)


def _patterns(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        counts, _ = _measured(batch.column(0), batch.num_rows, False)
        seen, n = np.unique(_pattern(_votes(counts)), return_counts=True)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(n)], names=["pattern", "n"])


def expectation_maximisation(patterns: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Posterior of "good" for every pattern, and each heuristic's accuracy on (bad, good) where it votes.

    Given the class, each heuristic votes bad, nothing or good at its own rates, independent of the
    others. The start takes a document without a bad vote for good; rates are smoothed by one row of
    each outcome, so a pattern that was never seen in a class stays possible.
    """
    votes = (patterns[:, None] // 3 ** np.arange(len(HEURISTICS))) % 3
    outcome = votes[:, :, None] == np.arange(3)
    posterior = np.where((votes == 0).any(axis=1), 0.05, 0.95)
    rates = np.full((2, len(HEURISTICS), 3), 1 / 3)
    for _ in range(ROUNDS):
        prior = float(np.clip((n * posterior).sum() / max(n.sum(), 1), 0.05, 0.95))
        for k, weight in enumerate((n * (1 - posterior), n * posterior)):
            counts = (weight[:, None, None] * outcome).sum(axis=0) + 1
            rates[k] = counts / counts.sum(axis=1, keepdims=True)
        bad, good = ((np.log(rates[k])[None] * outcome).sum(axis=(1, 2)) for k in (0, 1))
        posterior = 1 / (1 + np.exp(np.clip(bad + np.log(1 - prior) - good - np.log(prior), -50, 50)))
    accuracy = np.stack([rates[0, :, 0] / (rates[0, :, 0] + rates[0, :, 2]), rates[1, :, 2] / (rates[1, :, 0] + rates[1, :, 2])], axis=1)
    return posterior, accuracy


def _scaled(x: np.ndarray, counts: dict[str, np.ndarray]) -> np.ndarray:
    """Square roots of shares, so that the length of a text does not matter."""
    size, words = np.maximum(counts["bytes"], 1)[:, None], np.maximum(counts["words"], 1)
    out = x.astype(np.float64)
    out[:, :CLASS_BUCKETS] = np.sqrt(out[:, :CLASS_BUCKETS] / size)
    out[:, CLASS_BUCKETS : CLASS_BUCKETS + WORD_BUCKETS] = np.sqrt(out[:, CLASS_BUCKETS : CLASS_BUCKETS + WORD_BUCKETS] / words[:, None])
    out[:, -4] = np.minimum(np.log1p(words) / 4, 1)
    out[:, -3] = np.minimum(5 * counts["same"] / words, 1)
    out[:, -2] = counts["distinct"] / words
    out[:, -1] = counts["words"] < 20
    return out


def _sampled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        counts, x = _measured(batch.column(0), batch.num_rows, True)
        rows = _scaled(x, counts).astype(np.float32)
        ends = pa.array(np.arange(0, rows.size + 1, WIDTH), pa.int32())
        lists = pa.ListArray.from_arrays(ends, pa.array(rows.ravel()))
        yield pa.RecordBatch.from_arrays([pa.array(_pattern(_votes(counts))), lists], names=["pattern", "x"])


def _fit(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Ridge logistic regression on soft labels by Newton steps; the last weight is the intercept."""
    design = np.hstack([x, np.ones((len(x), 1))])
    weights = np.zeros(design.shape[1])
    ridge = np.full(design.shape[1], PENALTY)
    ridge[-1] = 1e-6
    for _ in range(8):
        p = 1 / (1 + np.exp(-np.clip(design @ weights, -30, 30)))
        curve = design.T @ (design * np.maximum(p * (1 - p), 1e-4)[:, None]) + np.diag(ridge)
        weights -= np.linalg.solve(curve, design.T @ (p - y) + ridge * weights)
    return weights


def train(docs: DataFrame) -> tuple[dict[int, float], np.ndarray, np.ndarray] | None:
    """Posterior per pattern, accuracies, and the scorer's weights; None for an empty table."""
    found = (
        docs.select(text_of().alias("text")).mapInArrow(_patterns, "pattern bigint, n bigint")
        .groupBy("pattern").agg(F.sum("n").alias("n")).orderBy("pattern").toPandas()
    )
    if found.empty:
        return None
    posterior, accuracy = expectation_maximisation(found["pattern"].to_numpy(), found["n"].to_numpy(float))
    says = dict(zip(found["pattern"].tolist(), posterior.tolist()))
    total = int(found["n"].sum())
    draw = F.pmod(F.xxhash64("doc_id", text_of()), F.lit(1 << 30))
    drawn = docs.filter(draw < int(min(1.0, FIT_ROWS / total) * (1 << 30)) + 1)
    sample = drawn.select(text_of().alias("text")).mapInArrow(_sampled, "pattern bigint, x array<float>").limit(2 * FIT_ROWS).toPandas()
    if sample.empty:
        return says, accuracy, np.zeros(WIDTH + 1)
    x = np.array(sample["x"].tolist(), dtype=np.float64)
    return says, accuracy, _fit(x, sample["pattern"].map(says).to_numpy(float))


def _scores(weights: np.ndarray, says: dict[int, float], kept: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for cut in range(0, whole.num_rows, 2048):
                batch = whole.slice(cut, 2048)
                counts, x = _measured(batch.column(0), batch.num_rows, True)
                score = 1 / (1 + np.exp(-np.clip(_scaled(x, counts) @ weights[:-1] + weights[-1], -30, 30)))
                label = np.array([says[p] for p in _pattern(_votes(counts)).tolist()])
                own = [batch.column(k + 1) for k in range(kept)]
                yield pa.RecordBatch.from_arrays([*own, pa.array(label), pa.array(score)], names=[*batch.schema.names[1:], "posterior", "score"])

    return run


def classify(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``posterior`` (of the weak labels), ``score`` (of the scorer), ``predicted`` and ``kept`` of every row.

    A null or empty text has no words and is judged by that; a null doc_id is judged by its text;
    repeated rows are judged alike; an empty table gives an empty result. ``kept`` is a score of
    one half or more.
    """
    kind = dict(docs.dtypes)["doc_id"]
    schema = f"doc_id {kind}, posterior double, score double"
    model = train(docs)
    if model is None:
        scored = docs.sparkSession.createDataFrame([], schema)
    else:
        says, _, weights = model
        scored = docs.select(text_of().alias("text"), "doc_id").mapInArrow(_scores(weights, says, 1), schema)
    good = F.col("score") >= 0.5
    return scored.withColumns({"predicted": good.cast("int"), "kept": good})
