import math
from collections import Counter

import numpy as np
import pandas as pd
import pytest
from conftest import rows

from layerloom.operators import blocks, cells, search


@pytest.fixture(scope="module")
def docs(spark):
    made = [(1, "The cat sat. The CAT ran"), (2, "a dog ran"), (3, ""), (4, "cat-dog, dog!")]
    return spark.createDataFrame(made, "doc_id bigint, text string")


@pytest.fixture(scope="module")
def queries(spark):
    return spark.createDataFrame([(7, "cat dog cat"), (8, "ran"), (9, "nothing")], "query_id bigint, query string")


def test_index(docs):
    index = search.build_index(docs).select("term", "doc_id", "tf", "df", "length")
    assert ("cat", 1, 2, 2, 6) in rows(index) and ("dog", 4, 2, 2, 3) in rows(index)
    assert index.filter("doc_id = 3").count() == 0


def brute_bm25():
    texts = {1: "the cat sat the cat ran".split(), 2: "a dog ran".split(), 4: "cat dog dog".split()}
    n, mean = len(texts), sum(map(len, texts.values())) / len(texts)
    out = {}
    for qid, terms in {7: ["cat", "dog"], 8: ["ran"]}.items():
        for doc, words in texts.items():
            score = 0.0
            for term in terms:
                df = sum(term in w for w in texts.values())
                tf = words.count(term)
                score += math.log(1 + (n - df + 0.5) / (df + 0.5)) * tf * 2.2 / (
                    tf + 1.2 * (0.25 + 0.75 * len(words) / mean)
                )
            if score:
                out[qid, doc] = round(score, 6)
    return out


def test_bm25_from_text_and_from_a_stored_index(docs, queries):
    expected = brute_bm25()
    for found in (search.bm25(docs, queries, 10), search.bm25_indexed(search.index_blocks(docs), queries, 10), search.bm25(docs, queries, 10, query_batch=1)):
        got = {(r["query_id"], r["doc_id"]): r["score"] for r in found.collect()}
        assert got == expected
    assert search.bm25(docs, queries, 1).count() == 2
    assert search.bm25(docs.filter("false"), queries, 1).count() == 0
    assert search.bm25(docs, queries.filter("false"), 1).count() == 0


def made_lists(seed, block):
    r = np.random.default_rng(seed)
    rows, shares = [], {}
    for term in "abcdef":
        docs = r.choice(2_000, size=r.integers(50, 1_500), replace=False)
        # Few high shares, many low ones, and ties.
        share = np.round(r.exponential(0.2, len(docs)) ** 3, 2) + 0.01
        order = np.lexsort((docs, -share))
        shares[term] = dict(zip(docs.tolist(), share.tolist()))
        for at in range(0, len(docs), block):
            part = order[at : at + block]
            rows.append((0, term, at // block, share[part[0]], docs[part], share[part]))
    return pd.DataFrame(rows, columns=list(blocks.BLOCK_COLUMNS)), shares


def test_blocks_below_the_bound_are_not_opened():
    for seed in range(6):
        frame, shares = made_lists(seed, 16)
        lists, opened, every = blocks.Lists(frame), 0, 0
        for weights in ({"a": 9.0, "b": 0.1, "z": 3.0}, {"c": 1.0}, {"d": 2.0, "e": 1.0, "f": 0.05}, dict.fromkeys("abcdef", 1.0)):
            docs, scores, n = blocks.best(lists, weights, 10)
            total = Counter()
            for term, weight in weights.items():
                for doc, share in shares.get(term, {}).items():
                    total[doc] += weight * share
            want = sorted(((-round(s, 6), d) for d, s in total.items()))[:10]
            assert [(-s, d) for d, s in zip(docs.tolist(), scores.tolist())] == want
            opened, every = opened + n, every + sum(len(lists.bounds[lists.number[t]]) for t in weights if t in lists.number)
        assert opened < 0.7 * every
        assert blocks.best(lists, {"z": 1.0}, 10)[2] == 0


def test_index_blocks_are_ordered_by_impact(spark, docs, monkeypatch):
    monkeypatch.setattr(blocks, "BLOCK_POSTINGS", 1)
    index = search.index_blocks(docs)
    for row in index.collect():
        assert len(row["docs"]) == 1 and row["bound"] == row["shares"][0] and row["n"] == 3
    by_term = {}
    for row in index.orderBy("range", "term", "block").collect():
        by_term.setdefault((row["range"], row["term"]), []).append(row["bound"])
    assert all(b == sorted(b, reverse=True) for b in by_term.values())


@pytest.mark.parametrize("query_batch", [1_024, 3])
def test_vectors_against_brute_force(spark, query_batch):
    rng = np.random.default_rng(3)
    have, want = rng.normal(size=(300, 8)), rng.normal(size=(7, 8))
    have[10] = 0
    vectors = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(have)], "vec_id bigint, vector array<double>")
    queries = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(want)], "query_id bigint, vector array<double>")
    got = search.vector_topk(vectors.repartition(5), queries, 4, query_batch).collect()
    unit = np.divide(have, np.linalg.norm(have, axis=1, keepdims=True), out=np.zeros_like(have), where=have.any(axis=1, keepdims=True))
    cosine = np.round(unit @ (want / np.linalg.norm(want, axis=1, keepdims=True)).T, 6)
    for q in range(7):
        best = sorted(range(300), key=lambda i: (-cosine[i, q], i))[:4]
        mine = [r["vec_id"] for r in sorted(got, key=lambda r: r["rank"]) if r["query_id"] == q]
        assert mine == best


def clustered(seed, n, groups, size=12):
    r = np.random.default_rng(seed)
    middle = r.normal(size=(groups, size))
    return middle[r.integers(0, groups, n)] + r.normal(scale=0.05, size=(n, size))


@pytest.mark.parametrize("cell_rows", [cells.CELL_ROWS, 20])
def test_cells_give_the_nearest_vectors(spark, monkeypatch, cell_rows):
    monkeypatch.setattr(cells, "CELL_ROWS", cell_rows)
    have, want = clustered(1, 500, 9), clustered(2, 40, 9)
    have[7] = have[8] = want[3] = 0
    # A third are copies of one vector.
    have[300:] = have[300]
    want[5] = have[300]
    vectors = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(have)], "vec_id bigint, vector array<double>")
    queries = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(want)], "query_id bigint, vector array<double>")
    for k in (1, 10):
        mine = rows(search.vector_topk_indexed(vectors, queries, k).select("query_id", "vec_id", "score", "rank"))
        assert mine == rows(search.vector_topk(vectors, queries, k).select("query_id", "vec_id", "score", "rank"))
    few = vectors.filter("vec_id < 3")
    assert search.vector_topk_indexed(few, queries, 10).count() == 3 * 40
    assert search.vector_topk_indexed(vectors.filter("false"), queries, 10).count() == 0
    assert search.vector_topk_indexed(vectors, queries.filter("false"), 10).count() == 0


def test_cells_beyond_the_bound_are_not_probed(spark):
    have, want = clustered(3, 400, 6), clustered(3, 30, 6)
    vectors = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(have)], "vec_id bigint, vector array<double>")
    queries = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(want)], "query_id bigint, vector array<double>")
    found = cells.nearest(vectors, queries, 5, 24)
    # Compared: k rows at most per probed cell. All 24 cells would give 24 * 5 rows per query.
    assert found.count() < 0.5 * 30 * 24 * 5


def test_copies_of_one_vector_are_ranked_by_id(spark):
    vectors = spark.range(50).selectExpr("id AS vec_id", "array(1.0D, 2.0D) AS vector").repartition(4)
    queries = spark.createDataFrame([(1, [1.0, 2.0])], "query_id bigint, vector array<double>")
    assert [r["vec_id"] for r in search.vector_topk(vectors, queries, 3).orderBy("rank").collect()] == [0, 1, 2]


def test_fusion(spark):
    a = spark.createDataFrame([(1, 10, 1), (1, 11, 2)], "query_id bigint, doc_id bigint, rank int")
    b = spark.createDataFrame([(1, 11, 1), (1, 12, 2)], "query_id bigint, doc_id bigint, rank int")
    got = rows(search.reciprocal_rank_fusion([a, b], 2).select("doc_id", "score", "rank"))
    assert got == [(10, round(1 / 61, 6), 2), (11, round(1 / 61 + 1 / 62, 6), 1)]


def test_index_blocks_read_the_text_once(spark, monkeypatch):
    """Sizes once came from a second pass over every text."""
    told = spark.createDataFrame([(1, "a b a"), (2, ""), (3, None), (4, "b c"), (5, "- -")], "doc_id bigint, text string")
    want = search.doc_sizes(told).first()
    monkeypatch.setattr(search, "doc_sizes", None)
    found = search.index_blocks(told)
    assert {r["n"] for r in found.collect()} == {want["n"]} == {2}
    shares = {(r["term"], d): s for r in found.collect() for d, s in zip(r["docs"], r["shares"])}
    assert shares[("a", 1)] == pytest.approx(2 * 2.2 / (2 + 1.2 * (0.25 + 0.75 * 3 / want["mean"])))
