"""Mixing sources to target weights along a time-varying curriculum.

Each source has a weight and a linear schedule over training time 0 to 1. The integral of its
schedule says how many words it is due by a time; inverting it gives every taken word, and so every
document, its training position, by which the mix is range-sorted. Running totals are cut by
buckets of a row hash, so a source with a third of all rows is spread over many tasks. Built-in
functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from layerloom.llm.common import SPACE, durable, guarded, pick, text_of, words_of

# Weights of the sources in order, repeating, and how strong each weight class starts: a source
# that starts at 1.5 times its mean ends at 0.5 times.
WEIGHTS = (5, 2, 1)
STARTS = (1.5, 1.0, 0.5)
# Words taken, as a share of all words, and the most often a document is taken.
SHARE = 1.5
MOST = 2

RESULTS = ("size", "source_size", "target", "taken", "positions")

ROWS_PER_BUCKET = 256
MAX_BUCKETS = 1 << 16


def word_count(text: Column) -> Column:
    return F.size(words_of(text)).cast("bigint")


def _numbered(sources: DataFrame) -> DataFrame:
    """The sources with ``_n`` = 0, 1, ... in code point order, null last.

    Names are counted by their first characters, so that no task orders all names.
    """
    head = W.orderBy("_none", "_head").rowsBetween(W.unboundedPreceding, -1)
    heads = sources.groupBy("_none", F.substring("_source", 1, 4).alias("_head")).agg(F.count("*").alias("_rows"))
    before = heads.withColumn("_before", F.coalesce(F.sum("_rows").over(head), F.lit(0))).drop("_rows")
    place = F.row_number().over(W.partitionBy("_none", "_head").orderBy("_source")) - 1
    return (
        sources.withColumn("_head", F.substring("_source", 1, 4))
        .withColumn("_place", place)
        .join(before, ["_none", "_head"])
        .withColumn("_n", (F.col("_place") + F.col("_before")).cast("bigint"))
        .drop("_head", "_place", "_before")
    )


def _nth(values: tuple, n: Column) -> Column:
    return F.get(F.array(*[F.lit(float(v)) for v in values]), F.pmod(n, F.lit(len(values))).cast("int"))


def targets(sized: DataFrame, share: float = SHARE, most: int = MOST) -> DataFrame:
    """``source_size``, ``target`` and schedule ``_start`` of every source of rows with ``_none``, ``_source``, ``size``.

    The words to take are shared by weight; a source stops at ``most`` times its size and the
    excess is shared again among the others until none is above its stop.
    """
    totals = sized.groupBy("_none", "_source").agg(F.sum("size").alias("source_size"))
    ready = _numbered(totals).withColumns({"_weight": _nth(WEIGHTS, F.col("_n")), "_start": _nth(STARTS, F.col("_n"))})
    stop = most * F.col("source_size").cast("double")
    wanted = share * (ready.agg(F.sum("source_size")).first()[0] or 0)
    level, settled = 0.0, False
    while not settled:
        # Sources whose share at this level reaches their stop are full; the rest share what is left.
        full = stop <= level * F.col("_weight")
        row = ready.agg(
            F.coalesce(F.sum(F.when(full, stop)), F.lit(0.0)), F.coalesce(F.sum(F.when(~full, F.col("_weight"))), F.lit(0.0))
        ).first()
        raised = (wanted - row[0]) / row[1] if row[1] > 0 else level
        settled, level = raised <= level, max(raised, level)
    return ready.withColumn("target", F.least(stop, level * F.col("_weight"))).drop("_n", "_weight")


def position(words: Column, target: Column, start: Column) -> Column:
    """Training time at which a source has spent ``words``: the inverse of its integrated schedule.

    A schedule of start a has spent target * (a t + (1 - a) t^2) words by time t.
    """
    y = F.when(target > 0, F.least(words / target, F.lit(1.0))).otherwise(0.0)
    bend = 1 - start
    return F.when(bend == 0, y).otherwise((F.sqrt(F.greatest(start * start + 4 * bend * y, F.lit(0.0))) - start) / (2 * bend))


def _range_sorted(rows: DataFrame, position: Column, *ties: Column | str) -> DataFrame:
    """The rows in the order of training time: dealt into ranges of it, each range sorted. What has no position is last."""
    time = F.coalesce(position, F.lit(float("inf")))
    return rows.repartitionByRange(time, F.xxhash64(*ties)).sortWithinPartitions(time, *ties)


def mix(docs: DataFrame, share: float = SHARE, most: int = MOST, keep: list[str] | None = None) -> DataFrame:
    """The rows of ``placed`` in the order of their first training position, with the input columns ``keep`` (all)."""
    made = placed(docs, share, most)
    own = [c for c in made.columns if c not in RESULTS]
    # A range sort looks at its rows twice; they are worked out once.
    ready = durable(made.select(*(own if keep is None else keep), *RESULTS))
    return _range_sorted(ready, F.get("positions", F.lit(0))["position"], "doc_id")


def placed(docs: DataFrame, share: float = SHARE, most: int = MOST) -> DataFrame:
    """Every row with ``size``, ``source_size``, ``target``, ``taken`` and ``positions``.

    Documents of a source are taken in hash order, again and again, until its target is spent; the
    last one is taken in part. ``positions`` holds for each time the document is taken its training
    position and the words taken. A null or missing source is a source of its own (the last), a
    null or blank text has size 0 and takes nothing, repeated rows are documents of their own, and
    an empty table gives an empty result. Input columns named like a result column are replaced.
    """
    own = docs.drop(*RESULTS)
    source = pick(docs, "source", "string")
    ready = own.withColumns(
        {
            "_none": source.isNull(),
            "_source": F.coalesce(source, F.lit("")),
            "size": word_count(text_of()),
            "_order": F.md5(F.concat_ws("/", F.col("doc_id").cast("string"), text_of())),
        }
    )
    rows = docs.count()
    buckets = 1
    while buckets < MAX_BUCKETS and buckets * ROWS_PER_BUCKET < rows:
        buckets *= 2
    # Buckets are stretches of the order itself, so their number does not change who is taken.
    lead = F.conv(F.substring("_order", 1, 4), 16, 10).cast("int")
    cut = ready.withColumn("_bucket", F.floor(lead / (MAX_BUCKETS // buckets)).cast("int"))
    # Sources times buckets rows, read several times below.
    sums = durable(cut.groupBy("_none", "_source", "_bucket").agg(F.sum("size").alias("_sum")))
    earlier = W.partitionBy("_none", "_source").orderBy("_bucket").rowsBetween(W.unboundedPreceding, -1)
    goals = targets(sums.withColumnRenamed("_sum", "size"), share, most)
    offsets = (
        sums.withColumn("_before", F.coalesce(F.sum("_sum").over(earlier), F.lit(0)))
        .drop("_sum")
        .join(goals, ["_none", "_source"])
    )
    within = W.partitionBy("_none", "_source", "_bucket").orderBy("_order", "doc_id", "size").rowsBetween(W.unboundedPreceding, -1)
    begun = cut.withColumn("_within", F.coalesce(F.sum("size").over(within), F.lit(0))).join(offsets, ["_none", "_source", "_bucket"])
    first = F.col("_before") + F.col("_within")
    due = F.floor("target").cast("bigint")

    def turn(k: Column) -> Column:
        begin = first + k * F.col("source_size")
        words = F.greatest(F.least(due - begin, F.col("size")), F.lit(0).cast("bigint"))
        return F.struct(
            position(begin + words / 2, F.col("target"), F.col("_start")).alias("position"), words.alias("words")
        )

    turns = F.filter(F.transform(F.sequence(F.lit(0), F.lit(most - 1)), turn), lambda x: x["words"] > 0)
    timed = begun.withColumn("positions", turns)
    taken = F.aggregate("positions", F.lit(0).cast("bigint"), lambda a, x: a + x["words"])
    return timed.withColumn("taken", taken).select(*own.columns, *RESULTS)


def mix_table(docs: DataFrame) -> DataFrame:
    """The contract's row per document: ids and numbers, and the first training position, in its order."""
    slim = docs.select("doc_id", pick(docs, "source", "string"), text_of().alias("text"))
    return mix(slim, keep=["doc_id"]).select(
        "doc_id", "size", "source_size", F.round("target", 6).alias("target"), "taken", F.round(F.get("positions", F.lit(0))["position"], 9).alias("first_position")
    )


def mixed(docs: DataFrame) -> DataFrame:
    """The training stream: a row for each time a document is taken, range-sorted by position.

    A document taken in part keeps its first words. ``text`` and ``n_chars`` are those of what is taken;
    other columns stay, whatever they are called. Nulls, repeated rows and empty tables as in ``placed``.
    """
    plain, own = guarded(docs)
    stream = placed(plain).select("*", F.explode("positions").alias("_turn"))
    whole = F.col("_turn.words") == F.col("size")
    cut = F.regexp_extract(F.col("text"), f"^{SPACE.replace('+', '*')}", 0)
    part = F.concat(cut, F.array_join(F.slice(words_of(text_of()), F.lit(1), F.col("_turn.words").cast("int")), " "))
    out = stream.withColumn("text", F.when(whole, F.col("text")).otherwise(part))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(whole, F.col("n_chars")).otherwise(F.length("text").cast("bigint")))
    return _range_sorted(out, F.col("_turn.position"), "doc_id", "text").select(*own)
