"""Where quotes stand that name no page: a positional gram index.

A paragraph is indexed by the grams of ``GRAM`` characters that begin at every ``GRAM``-th place. Wherever a
quote stands, some of its own grams fall on those places: those at one remainder of their place in the quote.
So a quote picks the rarest gram of every remainder as a pivot, meets the paragraphs that hold a pivot, and is
verified there. Other grams are never joined; a pivot that is common all the same is cut into shares by
measured rows. Quotes too short for that meet the pieces of their own length that paragraphs hold. Grams and
short quotes that are measured few travel to the paragraphs, and only those found leave the task.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from layerloom.functions.skew import join_dimension, measured_small
from layerloom.functions.tasks import kept, travels

travels(__name__)

GRAM = 8
# From this length on a quote has a gram at every remainder.
PIVOT_LENGTH = 2 * GRAM - 1

# Items that a task holds before it hands them on, and quotes that meet a text in one row.
HELD_ITEMS = 100_000
QUOTES_PER_ROW = 1_024

GRAM_TYPE = T.StructType([T.StructField("rest", T.IntegerType()), T.StructField("gram", T.StringType())])
GRAM_ARROW = pa.struct([("rest", pa.int32()), ("gram", pa.string())])
FOUND_TYPE = T.StructType([T.StructField("quote", T.StringType()), T.StructField("place", T.LongType())])
FOUND_ARROW = pa.struct([("quote", pa.string()), ("place", pa.int64())])


def grams(text: str, step: int) -> list[tuple[int, str]]:
    """(place, gram) of the grams that begin at every ``step``-th character."""
    return [(at, text[at : at + GRAM]) for at in range(0, len(text) - GRAM + 1, step)]


def occurrences(text: str, quote: str) -> list[int]:
    """The places, from 0, at which ``quote`` begins in ``text``, overlapping ones too."""
    found, at = [], text.find(quote)
    while at >= 0:
        found.append(at)
        at = text.find(quote, at + 1)
    return found


def _rows_of(df: DataFrame, keys: list[str], values: list[str], item: str, kind: T.DataType, arrow: pa.DataType, work: Callable) -> DataFrame:
    """The ``keys`` of every row beside every ``item`` that ``work`` makes of its ``values``; no task holds many at once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = work()
        for batch in batches:
            owner, items = [], []

            def out() -> pa.RecordBatch:
                held = [batch.column(k).take(pa.array(owner, pa.int64())) for k in keys]
                return pa.RecordBatch.from_arrays([*held, pa.array(items, arrow)], names=[*keys, item])

            for at in range(batch.num_rows):
                found = made(*[batch.column(v)[at].as_py() for v in values])
                owner += [at] * len(found)
                items += found
                if len(items) >= HELD_ITEMS:
                    yield out()
                    owner, items = [], []
            yield out()

    schema = T.StructType([*[df.schema[k] for k in keys], T.StructField(item, kind)])
    return df.mapInArrow(run, schema)


def _offered(told: DataFrame, asked: DataFrame, item: str, pieces: Callable[[str], set], search: Callable) -> DataFrame:
    """The ``pieces`` of paragraphs that are among the ``asked``, a row per paragraph and piece.

    Few asked ones travel to the texts, where ``search`` makes of them what finds them in a text.
    """
    keys = ["chapter", "para"]
    if measured_small(asked):
        shared = told.sparkSession.sparkContext.broadcast([r[0] for r in asked.collect()])
        return _rows_of(told, keys, ["text"], item, T.StringType(), pa.string(), lambda: search(shared.value))
    offered = _rows_of(told, keys, ["text"], item, T.StringType(), pa.string(), lambda: pieces)
    return join_dimension(offered, asked, [item], "left_semi", salt_by=keys, small=False)


def _grams_among(asked: list[str]) -> Callable[[str], set]:
    known = set(asked)
    return lambda text: known.intersection(g for _, g in grams(text, GRAM))


def _quotes_among(asked: list[str]) -> Callable[[str], set]:
    if not asked:
        return lambda text: set()
    import ahocorasick

    automaton = ahocorasick.Automaton()
    for quote in asked:
        automaton.add_word(quote, quote)
    automaton.make_automaton()
    return lambda text: {quote for _, quote in automaton.iter(text)}


def _by_pivot(wanted: DataFrame, told: DataFrame) -> DataFrame:
    """(chapter, para, quote) pairs that share a pivot."""
    asked = _rows_of(
        wanted.select("quote", F.col("quote").alias("_text")), ["quote"], ["_text"], "_g", GRAM_TYPE, GRAM_ARROW,
        lambda: lambda q: sorted({(at % GRAM, g) for at, g in grams(q, 1)}),
    ).select("quote", "_g.rest", "_g.gram")
    # Grams that no quote asks for end here, before a shuffle while the asked ones are measured small.
    hits = kept(_offered(told, asked.select("gram").distinct(), "gram", lambda t: {g for _, g in grams(t, GRAM)}, _grams_among))
    rows = hits.groupBy("gram").agg(F.count("*").alias("rows"))
    # A remainder whose rarest gram no paragraph has rules its places out.
    rated = join_dimension(asked, rows, ["gram"], "left", salt_by=["quote", "rest"])
    rarest = F.min(F.struct(F.coalesce("rows", F.lit(0)).alias("n"), "gram")).alias("p")
    pivots = rated.groupBy("quote", "rest").agg(rarest).filter("p.n > 0").select("quote", F.col("p.gram").alias("gram")).distinct()
    return join_dimension(hits, pivots, ["gram"], "inner", salt_by=["chapter", "para"], rows_per_key=rows).select("chapter", "para", "quote")


def _by_length(wanted: DataFrame, told: DataFrame) -> DataFrame | None:
    """(chapter, para, quote) pairs of quotes below ``PIVOT_LENGTH``, of which there are few lengths."""
    lengths = [r[0] for r in wanted.select(F.length("quote")).distinct().collect()]
    if not lengths:
        return None
    pieces = lambda t: {t[at : at + n] for n in lengths for at in range(len(t) - n + 1)}
    return _offered(told, wanted, "quote", pieces, _quotes_among).select("chapter", "para", "quote")


def locate_quotes(quotes: DataFrame, paragraphs: DataFrame) -> DataFrame:
    """``quote_id``, ``chapter``, ``para`` and ``place`` of every occurrence of every quote.

    ``quotes`` has (quote_id, quote), ``paragraphs`` (chapter, para, text), one row per chapter and para. Places
    count characters from 0. Equal quotes are searched once. Empty and null quotes have no place.
    """
    named = quotes.filter(F.length("quote") > 0).select("quote_id", "quote")
    wanted = kept(named.select("quote").distinct())
    told = paragraphs.filter(F.length("text") > 0).select("chapter", "para", "text")
    pairs = _by_pivot(wanted.filter(F.length("quote") >= PIVOT_LENGTH), told)
    short = _by_length(wanted.filter(F.length("quote") < PIVOT_LENGTH), told)
    pairs = kept((pairs if short is None else pairs.unionByName(short)).distinct())
    # Texts meet their pairs last: a paragraph once per row of quotes that may stand in it.
    most = pairs.groupBy("chapter", "para").count().agg(F.max("count")).first()[0] or 0
    share = F.pmod(F.xxhash64("quote"), F.lit(max(1, -(-most // QUOTES_PER_ROW)))).alias("_share")
    listed = pairs.groupBy("chapter", "para", share).agg(F.collect_list("quote").alias("_quotes"))
    texts = join_dimension(listed, told, ["chapter", "para"], "inner", salt_by=["_share"])
    found = _rows_of(
        texts, ["chapter", "para"], ["text", "_quotes"], "_found", FOUND_TYPE, FOUND_ARROW,
        lambda: lambda text, quotes: [(quote, at) for quote in quotes for at in occurrences(text, quote)],
    )
    places = found.select("chapter", "para", "_found.quote", "_found.place")
    return join_dimension(places, named, ["quote"], "inner", salt_by=["chapter", "para", "place"]).select(
        "quote_id", "chapter", "para", "place"
    )
