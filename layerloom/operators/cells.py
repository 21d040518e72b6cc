"""Nearest vectors by cosine over k-means cells with radii, exact by the triangle inequality.

Vectors are scaled to length one, where the cosine follows from the distance. The cells are fitted on a
bounded sample; every vector goes to its nearest centre and every cell keeps the radius of its members, so
no member is nearer to a query than the centre's distance less the radius. A query first probes its nearest
cells that hold k vectors; only cells whose bound still reaches the k-th cosine found are probed after that.

Queries are rows at every step: they meet cells by number. A cell with more than ``CELL_ROWS`` vectors or
queries is cut into shares of both sides, so a cell of copies is no single task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from layerloom.functions.tasks import kept, travels

travels(__name__)

# Vectors that centres are fitted on, rounds of the fit, and the most centres.
FIT_ROWS = 8_192
FIT_ROUNDS = 8
MOST_CELLS = 1_024
# Vectors, or queries, of one cell that one task compares.
CELL_ROWS = 16_384

# Cosines are rounded to this many places before they are ranked; a bound must be lower by more to be passed over.
SCORE_DIGITS = 6
SLACK = 2 * 10.0**-SCORE_DIGITS

# The cell of vectors without a direction: their cosine is 0 to every query.
NOWHERE = -1

FOUND = "query_id bigint, vec_id bigint, score double"


def unit(rows: pd.Series) -> np.ndarray:
    """The vectors at length one; a vector of zeros stays."""
    matrix = np.stack(rows).astype(np.float64)
    length = np.linalg.norm(matrix, axis=1, keepdims=True)
    return np.divide(matrix, length, out=np.zeros_like(matrix), where=length > 0)


def fit_centres(vectors: DataFrame, cells: int | None = None) -> np.ndarray:
    """Centres of a bounded sample, the vectors of lowest id hashes: k-means by cosine, begun on spread members."""
    sample = vectors.filter(F.size("vector") > 0).orderBy(F.xxhash64("vec_id")).limit(FIT_ROWS).toPandas()
    if sample.empty:
        return np.zeros((0, 0))
    rows = unit(sample["vector"])
    rows = rows[(rows != 0).any(axis=1)]
    rows = np.unique(rows, axis=0)
    wanted = min(cells or max(1, int(np.sqrt(len(rows)))), MOST_CELLS, len(rows))
    centres = rows[np.linspace(0, len(rows) - 1, wanted).astype(int)] if len(rows) else rows
    for _ in range(FIT_ROUNDS if len(rows) else 0):
        nearest = np.argmax(rows @ centres.T, axis=1)
        sums = np.zeros_like(centres)
        np.add.at(sums, nearest, rows)
        length = np.linalg.norm(sums, axis=1, keepdims=True)
        centres = np.where(length > 0, sums / np.where(length > 0, length, 1), centres)
    return centres


def cell_table(vectors: DataFrame, centres: np.ndarray) -> DataFrame:
    """``vec_id``, ``vector``, its ``cell`` and its distance ``away`` from the centre."""
    shared = vectors.sparkSession.sparkContext.broadcast(centres)

    @F.pandas_udf("struct<cell:int,away:double>")
    def placed(rows: pd.Series) -> pd.DataFrame:
        have, middle = unit(rows), shared.value
        lost = ~(have != 0).any(axis=1)
        if not len(middle):
            return pd.DataFrame({"cell": np.full(len(have), NOWHERE, np.int32), "away": np.zeros(len(have))})
        cosine = have @ middle.T
        nearest = np.argmax(cosine, axis=1)
        away = np.linalg.norm(have - middle[nearest], axis=1)
        return pd.DataFrame({"cell": np.where(lost, NOWHERE, nearest).astype(np.int32), "away": np.where(lost, 0.0, away)})

    return vectors.select("vec_id", "vector", placed(F.col("vector")).alias("_p")).select("vec_id", "vector", "_p.cell", "_p.away")


def cell_bounds(placed: DataFrame) -> pd.DataFrame:
    """Members and radius of every cell that has members; at most ``MOST_CELLS + 1`` rows."""
    return placed.groupBy("cell").agg(F.count("*").alias("members"), F.max("away").alias("radius")).orderBy("cell").toPandas()


def _probes(queries: DataFrame, centres: np.ndarray, bounds: pd.DataFrame, k: int) -> DataFrame:
    """The cells that a query probes: its nearest ones that hold k vectors or, where ``queries`` brings the ``least``
    cosine that still counts (null: any does), the others whose members can reach it."""
    again = "least" in queries.columns
    shared = queries.sparkSession.sparkContext.broadcast((centres, bounds))

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        middle, table = shared.value
        number, members, radius = (table[c].to_numpy() for c in ("cell", "members", "radius"))
        for batch in batches:
            asked = unit(batch["vector"])
            away = np.zeros((len(asked), len(number)))
            real = number != NOWHERE
            if real.any():
                away[:, real] = np.sqrt(np.maximum(0, (asked**2).sum(axis=1)[:, None] + 1 - 2 * asked @ middle[number[real]].T))
            least = np.maximum(0, away - radius[None, :])
            upper = 1 - least**2 / 2
            # No direction on either side: every cosine is 0.
            upper[:, ~real] = 0
            upper[~(asked != 0).any(axis=1)] = 0
            order = np.argsort(-upper, axis=1, kind="stable")
            held = np.cumsum(members[order], axis=1)
            first = np.zeros_like(upper, dtype=bool)
            np.put_along_axis(first, order, held - members[order] < k, axis=1)
            wanted = first
            if again:
                least_cosine = batch["least"].to_numpy(np.float64, na_value=-np.inf)
                wanted = ~first & (upper + SLACK >= least_cosine[:, None])
            query, cell = np.nonzero(wanted)
            yield pd.DataFrame({"query_id": batch["query_id"].to_numpy()[query], "cell": number[cell]})

    return queries.mapInPandas(work, "query_id bigint, cell int")


def _shares(table: DataFrame, name: str) -> DataFrame:
    """``cell`` and the number of shares its rows are cut into."""
    return table.groupBy("cell").agg(F.ceil(F.count("*") / CELL_ROWS).cast("int").alias(name))


def _compared(placed: DataFrame, probes: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    """The k best of every share of a cell for every query that probes it."""
    # One row per cell on the right: both sides learn how both are cut.
    cuts = F.broadcast(_shares(placed, "vparts").join(_shares(probes, "qparts"), "cell"))

    def dealt(df: DataFrame, mine: str, other: str, key: str) -> DataFrame:
        # A row lies in one share of its own side and meets every share of the other.
        number = F.pmod(F.xxhash64(key), F.col(f"{mine}parts")).cast("int").alias(f"{mine}part")
        every: Column = F.explode(F.sequence(F.lit(0), F.col(f"{other}parts") - 1)).alias(f"{other}part")
        return df.join(cuts, "cell").select("cell", key, "vector", number, every)

    left = dealt(placed.select("cell", "vec_id", "vector"), "v", "q", "vec_id")
    right = dealt(probes.select("cell", "query_id").join(queries, "query_id"), "q", "v", "query_id")

    def best(have: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        out = [pd.DataFrame({"query_id": np.zeros(0, np.int64), "vec_id": np.zeros(0, np.int64), "score": np.zeros(0)})]
        if len(have) and len(asked):
            ids, members = have["vec_id"].to_numpy(), unit(have["vector"])
            for at in range(0, len(asked), 256):
                part = asked.iloc[at : at + 256]
                cosine = np.round(unit(part["vector"]) @ members.T, SCORE_DIGITS) + 0.0
                for query_id, row in zip(part["query_id"], cosine):
                    # All that reach the k-th score are ordered, so ties at the border go to the lower id.
                    border = np.partition(row, len(row) - k)[len(row) - k] if len(row) > k else -np.inf
                    near = np.flatnonzero(row >= border)
                    near = near[np.lexsort((ids[near], -row[near]))[:k]]
                    out.append(pd.DataFrame({"query_id": query_id, "vec_id": ids[near], "score": row[near]}))
        return pd.concat(out)

    keys = ("cell", "vpart", "qpart")
    return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInPandas(best, FOUND)


def nearest(vectors: DataFrame, queries: DataFrame, k: int, cells: int | None = None) -> DataFrame:
    """Candidates ``query_id``, ``vec_id``, ``score`` that hold the k nearest vectors of every query.

    ``vectors`` is (vec_id, vector), ``queries`` (query_id, vector); rows without a vector are left out.
    """
    vectors = vectors.filter(F.size("vector") > 0)
    queries = kept(queries.filter(F.size("vector") > 0).select("query_id", "vector"))
    centres = fit_centres(vectors, cells)
    placed = kept(cell_table(vectors, centres))
    bounds = cell_bounds(placed)
    if bounds.empty:
        return vectors.sparkSession.createDataFrame([], FOUND)
    probes = kept(_probes(queries, centres, bounds, k))
    found = kept(_compared(placed, probes, queries, k))
    # The k-th cosine of a query so far; without k results every cell stays open.
    kth = F.get(F.sort_array(F.collect_list("score"), asc=False), F.lit(k - 1))
    ranked = _best(found, k).groupBy("query_id").agg(kth.alias("least"))
    rest = kept(_probes(queries.join(ranked, "query_id", "left"), centres, bounds, k))
    return found.unionByName(_compared(placed, rest, queries, k))


def _best(found: DataFrame, k: int) -> DataFrame:
    order = W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("_rank", F.row_number().over(order)).filter(F.col("_rank") <= k).drop("_rank")
