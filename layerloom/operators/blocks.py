"""BM25 over impact-ordered posting blocks, exact, by score bounds.

Documents are dealt into ranges of bounded size by a hash of their id. Within a range the postings of a term
are ordered by their share of the score and cut into blocks; a block row carries its largest share. A query
takes the blocks of its terms best bound first. Every new document of a block gets its whole score at once,
from the postings of the range turned document by document; when the bounds of the blocks not yet opened can no
longer add up to the k-th score found, the others are never scored. A range answers all queries of a batch in
one task and leaves k rows for each.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from layerloom.functions.tasks import travels

travels(__name__)

# Postings of a range about, and of one block.
RANGE_POSTINGS = 1_000_000
BLOCK_POSTINGS = 128

# Scores are rounded to this many places before they are ranked; a bound must be lower by more to be passed over.
SCORE_DIGITS = 6
SLACK = 2 * 10.0**-SCORE_DIGITS

BLOCK_COLUMNS = ("range", "term", "block", "bound", "docs", "shares")


def range_of(doc_id: Column, ranges: int) -> Column:
    return F.pmod(F.xxhash64(doc_id), F.lit(ranges)).cast("int")


def ranges_for(postings: int, least: int) -> int:
    """How many ranges hold about ``RANGE_POSTINGS`` each, at least as many as can run at once."""
    return max(least, -(-postings // RANGE_POSTINGS))


def posting_blocks(postings: DataFrame, share: Column, ranges: int, block: int | None = None) -> DataFrame:
    """Blocks of postings (term, doc_id and what ``share`` needs): ``BLOCK_COLUMNS``.

    A range holds a bounded number of documents, so no list of postings grows with the corpus.
    """
    block = BLOCK_POSTINGS if block is None else block
    placed = postings.select("term", "doc_id", share.alias("share"), range_of(F.col("doc_id"), ranges).alias("range"))
    # By falling share, ties by id.
    listed = placed.groupBy("range", "term").agg(F.array_sort(F.collect_list(F.struct((-F.col("share")).alias("minus"), "doc_id"))).alias("p"))
    starts = F.sequence(F.lit(0), F.size("p") - 1, F.lit(block))
    cut = listed.select("range", "term", F.posexplode(F.transform(starts, lambda at: F.slice("p", at + 1, F.lit(block)))).alias("block", "b"))
    return cut.select(
        "range", "term", "block", (-F.col("b")[0]["minus"]).alias("bound"),
        F.transform("b", lambda x: x["doc_id"]).alias("docs"), F.transform("b", lambda x: -x["minus"]).alias("shares"),
    )


class Lists:
    """The posting lists of a range, documents numbered in the order of their ids.

    Per term: bounds and members of its blocks by falling bound.
    """

    def __init__(self, frame: pd.DataFrame) -> None:
        frame = frame.sort_values(["term", "block"])
        members = [np.asarray(d, np.int64) for d in frame["docs"]]
        sizes = np.array([len(m) for m in members], np.int64)
        self.ids, numbers = np.unique(np.concatenate(members), return_inverse=True)
        shares = np.concatenate([np.asarray(s, np.float64) for s in frame["shares"]])
        starts = np.concatenate([[0], np.cumsum(sizes)])
        rows = frame["term"].to_numpy()
        firsts = np.flatnonzero(np.concatenate([[True], rows[1:] != rows[:-1]]))
        self.number = {rows[first]: n for n, first in enumerate(firsts)}
        self.bounds: list[np.ndarray] = []
        self.edges: list[np.ndarray] = []
        self.ranked: list[np.ndarray] = []
        for first, last in zip(firsts, [*firsts[1:], len(rows)]):
            self.bounds.append(frame["bound"].to_numpy()[first:last])
            self.edges.append(starts[first : last + 1] - starts[first])
            self.ranked.append(numbers[starts[first] : starts[last]])
        # The other way round: per document its terms in order, for whole scores.
        term = np.repeat(np.arange(len(firsts)), [len(r) for r in self.ranked])
        order = np.lexsort((term, numbers))
        self.terms, self.shares = term[order], shares[order]
        self.begin = np.searchsorted(numbers[order], np.arange(len(self.ids) + 1))

    def score(self, docs: np.ndarray, weights: np.ndarray) -> np.ndarray:
        """The whole score of documents; each has a term, as it stands in a list."""
        sizes = self.begin[docs + 1] - self.begin[docs]
        edges = np.cumsum(sizes) - sizes
        at = np.arange(sizes.sum()) + np.repeat(self.begin[docs] - edges, sizes)
        return np.round(np.add.reduceat(weights[self.terms[at]] * self.shares[at], edges), SCORE_DIGITS)


def best(lists: Lists, weights: dict[str, float], k: int) -> tuple[np.ndarray, np.ndarray, int]:
    """The k best documents of a range for one query, their scores, and how many blocks were opened.

    The term with the highest bound opens as many blocks as it has open already, one at first.
    """
    asked = {lists.number[t]: w for t, w in weights.items() if t in lists.number}
    weight = np.zeros(len(lists.number))
    weight[list(asked)] = list(asked.values())
    docs, scores = np.zeros(0, np.int64), np.zeros(0)
    seen = np.zeros(len(lists.ids), bool)
    place = dict.fromkeys(asked, 0)
    bounds = {t: w * lists.bounds[t][0] for t, w in asked.items()}
    while bounds:
        # A document in none of the opened blocks has at most the sum of what the next blocks begin with.
        if len(docs) >= k and sum(bounds.values()) < scores[-1] - SLACK:
            break
        term = max(bounds, key=bounds.get)
        first = place[term]
        place[term] = last = min(2 * first or 1, len(lists.bounds[term]))
        if last < len(lists.bounds[term]):
            bounds[term] = asked[term] * lists.bounds[term][last]
        else:
            del bounds[term]
        members = lists.ranked[term][lists.edges[term][first] : lists.edges[term][last]]
        fresh = members[~seen[members]]
        if not len(fresh):
            continue
        seen[fresh] = True
        docs, scores = np.concatenate([docs, fresh]), np.concatenate([scores, lists.score(fresh, weight)])
        top = np.lexsort((docs, -scores))[:k]
        docs, scores = docs[top], scores[top]
    return lists.ids[docs], scores, sum(place.values())


def top_by_range(blocks: DataFrame, queries: dict[int, dict[str, float]], k: int) -> DataFrame:
    """The k best documents per range for a bounded batch of queries, given as weights of terms: query_id, doc_id, score."""
    shared = blocks.sparkSession.sparkContext.broadcast(queries)

    def answer(frame: pd.DataFrame) -> pd.DataFrame:
        lists, out = Lists(frame), []
        for query_id, weights in shared.value.items():
            docs, scores, _ = best(lists, weights, k)
            out.append(pd.DataFrame({"query_id": np.full(len(docs), query_id, np.int64), "doc_id": docs, "score": scores}))
        return pd.concat(out) if out else pd.DataFrame({"query_id": [], "doc_id": [], "score": []})

    schema = "query_id bigint, doc_id bigint, score double"
    return blocks.select(*BLOCK_COLUMNS).groupBy("range").applyInPandas(answer, schema)
