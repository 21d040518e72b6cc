"""Keyword, vector and hybrid ranking for a table of queries."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from layerloom.functions.explode import explode_rows, worked_out
from layerloom.functions.skew import join_dimension
from layerloom.functions.tasks import kept
from layerloom.operators import blocks, cells

K1 = 1.2
B = 0.75
RRF_OFFSET = 60
WORD = r"[\p{L}\p{N}]+"

# Queries held in memory at once; more are answered in further passes.
QUERY_BATCH = 1_024

# Scores are rounded before ranking, so ranks do not depend on the order sums are taken in.
SCORE_DIGITS = blocks.SCORE_DIGITS

RANKED = "query_id bigint, doc_id bigint, score double"


def words(text: Column) -> Column:
    """Lower-cased letter and digit runs, in order."""
    return F.regexp_extract_all(F.lower(text), F.lit(WORD), F.lit(0))


def _counted(found: Column) -> Column:
    """(term, tf) of an array of words: they are sorted, and each run's length is a count."""

    def runs(ordered: Column) -> Column:
        size = F.size(ordered)
        places = F.filter(
            F.sequence(F.lit(1), size),
            lambda i: (i == 1) | (F.element_at(ordered, i) != F.get(ordered, i - 2)),
        )
        return F.get(F.transform(F.array(places), lambda starts: F.transform(starts, lambda i, at: F.struct(
            F.element_at(ordered, i).alias("term"),
            (F.coalesce(F.get(starts, at + 1), size + 1) - i).cast("bigint").alias("tf"),
        ))), F.lit(0))

    none = F.array().cast("array<struct<term:string,tf:bigint>>")
    return F.get(
        F.transform(F.array(F.sort_array(found)), lambda s: F.when(F.size(s) > 0, runs(s)).otherwise(none)),
        F.lit(0),
    )


def postings(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, length, term, tf). A document is one row, so its words are counted without a shuffle."""
    return _numbered_postings(docs, doc_id, text).drop("at")


def _numbered_postings(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """``postings`` with their place ``at`` in the document, from 0."""
    listed = worked_out(docs.select(F.col(doc_id).alias("doc_id"), words(F.col(text)).alias("_words")))
    rows = explode_rows(listed, _counted(F.col("_words")), "doc_id", F.size("_words").alias("length"), item="_p")
    return rows.select("doc_id", "length", "_p.term", "_p.tf", F.col("_at").alias("at"))


def term_stats(index: DataFrame) -> DataFrame:
    """Documents per term."""
    return index.groupBy("term").agg(F.count("*").alias("df"))


def doc_sizes(docs: DataFrame, text: str = "text") -> DataFrame:
    """Number of documents with words, and their mean length."""
    length = F.nullif(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0))
    return docs.select(length.alias("length")).agg(
        F.count("length").alias("n"), F.avg("length").alias("mean")
    )


def build_index(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Inverted index with document frequency: (term, doc_id, length, tf, df)."""
    # Counted once: the document frequencies and the index both come from the kept postings.
    index = kept(postings(docs, doc_id, text))
    stats = term_stats(index)
    # The document frequency is the number of postings per word: words hold their own skew.
    rows = stats.withColumnRenamed("df", "rows")
    return join_dimension(
        index, stats, ["term"], "inner", salt_by=["doc_id"], small=False, rows_per_key=rows
    )


def _ranked(scores: DataFrame, k: int, item: str) -> DataFrame:
    """Best k per query, ties by id. Only k rows per task and query reach the shuffle."""
    order = W.partitionBy("query_id").orderBy(F.desc("score"), item)
    return scores.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def _share(n_terms: Column, mean: float) -> Column:
    """What a posting adds to a score, before the weight of its term."""
    return F.col("tf") * (K1 + 1) / (F.col("tf") + K1 * (1 - B + B * n_terms / mean))


def _weight(n: int, df: int) -> float:
    return math.log(1 + (n - df + 0.5) / (df + 0.5))


def _query_batches(queries: DataFrame, size: int) -> Iterator[dict[int, list[str]]]:
    """The distinct terms of the queries, about ``size`` queries at a time."""
    total = queries.count()
    parts = max(1, math.ceil(total / (size / 2))) if total > size else 1
    share = F.pmod(F.xxhash64("query_id"), F.lit(parts))
    terms = F.array_distinct(words(F.col("query"))).alias("terms")
    for part in range(parts):
        rows = queries.filter(share == part).select("query_id", terms).collect()
        asked: dict[int, list[str]] = {}
        for r in rows:
            asked.setdefault(r["query_id"], []).extend(r["terms"] or [])
        if any(asked.values()):
            yield asked


def _weights(asked: dict[int, list[str]], n: int, df: dict[str, int]) -> dict[int, dict[str, float]]:
    return {q: {t: _weight(n, df[t]) for t in terms if t in df} for q, terms in asked.items()}


def _hits(docs: DataFrame, terms: list[str], doc_id: str, text: str) -> DataFrame:
    """(doc_id, length, term, tf) of wanted terms, and of the empty term once per document with words.

    One pass over the text. Words are cut in the JVM; a batch of them is counted at once, so that only wanted
    ones leave the task.
    """
    wanted = ["", *terms]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = pa.array(wanted, pa.string())
        for batch in batches:
            listed = batch.column("words")
            lengths = listed.value_lengths().to_numpy(zero_copy_only=False)
            code = pc.fill_null(pc.index_in(listed.flatten(), value_set=known), -1).to_numpy(zero_copy_only=False)
            owner = np.repeat(np.arange(len(lengths)), lengths)
            hit = code > 0
            found, tf = np.unique(owner[hit] * len(wanted) + code[hit], return_counts=True)
            filled = np.flatnonzero(lengths)
            rows = np.concatenate([filled, found // len(wanted)])
            term = np.concatenate([np.zeros(len(filled), np.int64), found % len(wanted)])
            columns = [batch.column("doc_id").take(pa.array(rows)), pa.array(lengths[rows].astype(np.int64)), known.take(pa.array(term))]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(np.concatenate([np.ones(len(filled), np.int64), tf]))], names=["doc_id", "length", "term", "tf"]
            )

    none = F.array().cast("array<string>")
    listed = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.coalesce(words(F.col(text)), none).alias("words"))
    return listed.mapInArrow(count, "doc_id bigint, length bigint, term string, tf bigint")


def bm25(
    docs: DataFrame, queries: DataFrame, k: int, doc_id: str = "doc_id", text: str = "text", query_batch: int = QUERY_BATCH,
) -> DataFrame:
    """Best k documents per query, straight from text; ids are unique.

    The postings of the wanted words are counted in one pass and kept; sizes and document frequencies follow
    from them. Scores are worked out per range of documents (``blocks``), so k rows per range and query are
    shuffled, not one per query and document. More than ``query_batch`` queries take further passes.
    """
    best = docs.sparkSession.createDataFrame([], RANKED)
    for asked in _query_batches(queries, query_batch):
        terms = sorted({t for found in asked.values() for t in found})
        hits = kept(_hits(docs, terms, doc_id, text))
        stats = {r["term"]: r for r in hits.groupBy("term").agg(F.count("*").alias("docs"), F.sum("length").alias("length")).collect()}
        whole = stats.pop("", None)
        if not stats:
            continue
        df = {t: r["docs"] for t, r in stats.items()}
        share = _share(F.col("length"), whole["length"] / whole["docs"])
        # As many hits as documents that hold each term.
        ranges = blocks.ranges_for(sum(df.values()), _tasks(docs))
        cut = blocks.posting_blocks(hits.filter("term <> ''"), share, ranges)
        best = best.unionByName(blocks.top_by_range(cut, _weights(asked, whole["docs"], df), k))
    return _ranked(best, k, "doc_id")


def _tasks(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def index_blocks(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """A stored form of the index: the posting blocks of every term, beside the number of documents ``n``.

    Write it by ``range`` and sorted by ``term``: a search reads the blocks of its own terms.
    """
    found = kept(_numbered_postings(docs, doc_id, text))
    # Every document with words has one posting at 0, so its text is read once.
    length = F.when(F.col("at") == 0, F.col("length"))
    sizes = found.agg(F.count(length).alias("n"), F.avg(length).alias("mean"), F.count("*").alias("postings")).first()
    ranges = blocks.ranges_for(sizes["postings"], _tasks(docs))
    cut = blocks.posting_blocks(found.drop("at"), _share(F.col("length"), sizes["mean"] or 1.0), ranges)
    return cut.withColumn("n", F.lit(sizes["n"]))


def bm25_indexed(index: DataFrame, queries: DataFrame, k: int, query_batch: int = QUERY_BATCH) -> DataFrame:
    """``bm25`` from an ``index_blocks`` table: only blocks of the queries' terms are read, and of them only as
    many scored as the bounds ask for."""
    best = index.sparkSession.createDataFrame([], RANKED)
    for asked in _query_batches(queries, query_batch):
        terms = sorted({t for found in asked.values() for t in found})
        wanted = index.sparkSession.createDataFrame([(t,) for t in terms], "term string")
        mine = index.join(F.broadcast(wanted), "term", "left_semi")
        rows = mine.groupBy("term").agg(F.sum(F.size("docs")).alias("df"), F.max("n").alias("n")).collect()
        if rows:
            weights = _weights(asked, rows[0]["n"], {r["term"]: r["df"] for r in rows})
            best = best.unionByName(blocks.top_by_range(mine, weights, k))
    return _ranked(best, k, "doc_id")


def _nearest(vectors: DataFrame, rows: list, k: int) -> DataFrame:
    """Best k of every task for a bounded list of queries; the caller merges the tasks."""

    # Nested, so that the tasks need nothing but numpy and pandas.
    def unit(matrix: np.ndarray) -> np.ndarray:
        length = np.linalg.norm(matrix, axis=1, keepdims=True)
        return np.divide(matrix, length, out=np.zeros_like(matrix), where=length > 0)

    ids = np.array([r["query_id"] for r in rows], dtype=np.int64)
    wanted = unit(np.array([r["vector"] for r in rows], dtype=np.float64))

    def best(have: np.ndarray, cosine: np.ndarray) -> np.ndarray:
        # All that reach the k-th score are ordered, so ties at the border go to the lower id.
        if len(have) > k:
            border = np.partition(cosine, len(have) - k)[len(have) - k]
            kept = np.flatnonzero(cosine >= border)
        else:
            kept = np.arange(len(have))
        return kept[np.lexsort((have[kept], -cosine[kept]))[:k]]

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = [(np.empty(0, dtype=np.int64), np.empty(0))] * len(ids)
        for batch in batches:
            if batch.empty:
                continue
            have = batch["vec_id"].to_numpy()
            cosine = np.round(unit(np.stack(batch["vector"]).astype(np.float64)) @ wanted.T, SCORE_DIGITS)
            for q in range(len(ids)):
                all_ids = np.concatenate([held[q][0], have])
                scores = np.concatenate([held[q][1], cosine[:, q]])
                top = best(all_ids, scores)
                held[q] = (all_ids[top], scores[top])
        for query_id, (found, scores) in zip(ids, held):
            if len(found):
                yield pd.DataFrame({"query_id": query_id, "vec_id": found, "score": scores + 0.0})

    return vectors.mapInPandas(score, "query_id bigint, vec_id bigint, score double")


def vector_topk(vectors: DataFrame, queries: DataFrame, k: int, query_batch: int = QUERY_BATCH) -> DataFrame:
    """Nearest k vectors by cosine for each query.

    ``vectors`` is (vec_id bigint, vector array), ``queries`` (query_id bigint, vector array). The
    queries travel to the vectors in batches of bounded size; the vectors are never shuffled, only
    k rows per task and query are.
    """
    total = queries.count()
    passes = max(1, math.ceil(total / (query_batch / 2))) if total > query_batch else 1
    share = F.pmod(F.xxhash64("query_id"), F.lit(passes))
    best = None
    for part in range(passes):
        rows = queries.filter(share == part).select("query_id", "vector").collect()
        if rows:
            found = _nearest(vectors, rows, k)
            best = found if best is None else best.unionByName(found)
    if best is None:
        best = vectors.sparkSession.createDataFrame([], "query_id bigint, vec_id bigint, score double")
    return _ranked(best, k, "vec_id")


def vector_topk_indexed(vectors: DataFrame, queries: DataFrame, k: int, n_cells: int | None = None) -> DataFrame:
    """``vector_topk`` over k-means cells: the same rows, queries stay rows and meet only cells whose bound allows."""
    vectors, queries = vectors.select(F.col("vec_id").cast("bigint"), "vector"), queries.select(F.col("query_id").cast("bigint"), "vector")
    return _ranked(cells.nearest(vectors, queries, k, n_cells), k, "vec_id")


def reciprocal_rank_fusion(rankings: list[DataFrame], k: int) -> DataFrame:
    """Fuse rankings of (query_id, doc_id, rank) by summed 1 / (60 + rank)."""
    together = rankings[0].select("query_id", "doc_id", "rank")
    for ranking in rankings[1:]:
        together = together.unionByName(ranking.select("query_id", "doc_id", "rank"))
    fused = together.groupBy("query_id", "doc_id").agg(
        F.round(F.sum(1.0 / (RRF_OFFSET + F.col("rank"))), SCORE_DIGITS).alias("score")
    )
    return _ranked(fused, k, "doc_id")
