"""Near-duplicate lines by a segment-partition edit join.

Two lines link when at most ``TAU`` edits apart. A line is cut into ``TAU + 1`` segments; of two
linked lines at least one segment of the shorter occurs unchanged in the longer, at a place that
the lengths and the number of edits allow. Segments are indexed by (length, number, characters),
longer lines probe the few substrings that can match. Probes meet segments in one equi-join of
hashes, which adaptive execution splits where a segment is frequent; counts of frequent letters turn
most chance meetings away inside it. Candidates are verified by the built-in edit distance with
threshold ``TAU``, which is exact up to it; ``within_edits`` is the same test as a bit-parallel band
of ``2 * TAU + 1`` diagonals, against which it is held. Built-in functions only.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from layerloom.functions.explode import explode_rows, worked_out
from layerloom.functions.skew import measured_small
from layerloom.llm.common import durable, let, stored, text_of
from layerloom.llm.components import components

TAU = 2
# Shorter lines are compared exactly: an edit would often make a different line of them.
MIN_LENGTH = 24
# A segment of more different lines than this, estimated on every SPARSE-th line, is searched in blocks.
HOT_LINES = 64
SPARSE = 8
BLOCK = 128
# Twelve frequent letters.
LETTERS = "etaonirslduc"


def _segment(length: Column, i: int) -> tuple[Column, Column]:
    """Start (from 1) and length of segment i of ``TAU + 1``; the last ones are one longer."""
    parts = TAU + 1
    small, rest = F.floor(length / parts).cast("int"), (length % parts).cast("int")
    longer = F.greatest(rest - (parts - i), F.lit(0))
    return 1 + small * i + longer, small + F.when(rest >= parts - i, 1).otherwise(0)


def _signatures(line: Column, length: Column) -> tuple[list[Column], list[Column]]:
    """Keys of a line's own segments, and of its other substrings that may equal a segment of a line as long or shorter."""
    key = lambda size, i, part: F.xxhash64(size, F.lit(i), part)
    own, probes = [], []
    for i in range(TAU + 1):
        start, n = _segment(length, i)
        own.append(key(length, i, F.substring(line, start, n)))
        for shorter in range(TAU + 1):
            size = length - shorter
            start, n = _segment(size, i)
            # Edits left of the segment shift it by at most i, edits right of it by TAU - i.
            for shift in range(max(-i, shorter - (TAU - i)), min(i, shorter + (TAU - i)) + 1):
                if shorter or shift:
                    probes.append(key(size, i, F.substring(line, start + shift, n)))
    return own, probes


def within_edits(a: Column, b: Column) -> Column:
    """Whether two strings are at most ``TAU`` edits apart, over a band of ``2 * TAU + 1`` diagonals.

    Bit k of number e says that diagonal k - TAU (place in a minus place in b) can be reached with e
    edits. One character of b advances all diagonals at once: a match stays, a substitution stays at
    one edit more, a character left out of b or a moves down or up a diagonal.
    """
    full = (1 << (2 * TAU + 1)) - 1
    begin = F.struct(*[F.lit(((1 << (e + 1)) - 1) << TAU).bitwiseAND(F.lit(full)).alias(f"e{e}") for e in range(TAU + 1)])

    def advanced(old: Column, match: Column, e: int, below: Column | None) -> Column:
        stay = old[f"e{e}"].bitwiseAND(match)
        if e == 0:
            return stay
        fewer = old[f"e{e - 1}"]
        moved = stay.bitwiseOR(fewer).bitwiseOR(F.shiftright(fewer, 1)).bitwiseOR(F.shiftleft(below, 1))
        return moved.bitwiseAND(F.lit(full))

    def banded(x: Column, y: Column) -> Column:
        def step(acc: Column, c: Column) -> Column:
            i = acc["i"]
            match = sum((F.when(F.get(x, i + (k - TAU)) == c, 1 << k).otherwise(0) for k in range(2 * TAU + 1)), F.lit(0))

            def levels(m: Column, e: int, done: list[Column]) -> Column:
                if e > TAU:
                    return F.struct((i + 1).alias("i"), F.struct(*[d.alias(f"e{k}") for k, d in enumerate(done)]).alias("r"))
                return let(advanced(acc["r"], m, e, done[-1] if done else None), lambda v: levels(m, e + 1, [*done, v]))

            return let(match, lambda m: levels(m, 0, []))

        last = F.aggregate(y, F.struct(F.lit(0).alias("i"), begin.alias("r")), step, lambda acc: acc["r"][f"e{TAU}"])
        return F.call_function("shiftright", last, F.size(x) - F.size(y) + TAU).bitwiseAND(F.lit(1)) == 1

    near = F.abs(F.char_length(a) - F.char_length(b)) <= TAU
    return F.when(near, let(F.split(a, ""), lambda x: let(F.split(b, ""), lambda y: banded(x, y)))).otherwise(False)


def letter_counts(line: Column) -> Column:
    """How often each of twelve frequent letters occurs, modulo 32, in five bits each."""
    counts = [F.octet_length(line) - F.octet_length(F.replace(line, F.lit(c), F.lit(""))) for c in LETTERS]
    parts = [F.shiftleft(n.bitwiseAND(F.lit(31)).cast("bigint"), 5 * k) for k, n in enumerate(counts)]
    return reduce(lambda x, y: x.bitwiseOR(y), parts)


def letter_difference(a: Column, b: Column) -> Column:
    """By how much two packed counts differ at least; an edit changes it by two at most."""
    of = lambda x, k: F.shiftrightunsigned(x, 5 * k).bitwiseAND(F.lit(31))
    differences = [(of(a, k) - of(b, k)).bitwiseAND(F.lit(31)) for k in range(len(LETTERS))]
    return reduce(lambda x, y: x + y, [F.least(d, 32 - d) for d in differences])


def lines(docs: DataFrame) -> DataFrame:
    """A row per line with a word: ``doc_id``, ``_doc`` (text hash), ``_at``, ``h`` (line hash) and ``line``, trimmed."""
    ready = docs.select("doc_id", F.xxhash64(text_of()).alias("_doc"), text_of().alias("_text"))
    found = explode_rows(ready, F.split("_text", "\n"), "doc_id", "_doc", item="_line")
    trimmed = worked_out(found.select("doc_id", "_doc", "_at", F.btrim("_line", F.lit(" \t\r\x0b\x0c")).alias("line")))
    return trimmed.filter(F.col("line") != "").withColumn("h", F.xxhash64("line"))


def sketches(all_lines: DataFrame) -> DataFrame:
    """A row per different line: ``h``, its letter counts ``s`` and the keys ``k0``, ``k1``, ... (its own segments first).

    All columns are numbers, so equal lines fall together in the tasks before anything is shuffled.
    """
    own, probes = _signatures(F.col("line"), F.length("line"))
    keys = {f"k{i}": key for i, key in enumerate([*own, *probes])}
    ready = all_lines.select("h", letter_counts(F.col("line")).alias("s"), *[key.alias(name) for name, key in keys.items()])
    return ready.groupBy("h").agg(*[F.first(c).alias(c) for c in ["s", *keys]])


def hot_keys(sized: DataFrame) -> DataFrame:
    """Keys of segments that about ``HOT_LINES`` different lines share, counted on every ``SPARSE``-th line by hash.

    The count only chooses the way a key is searched; both ways find the same classes.
    """
    some = sized.filter(F.pmod("h", F.lit(SPARSE)) == 0)
    own = some.select(F.explode(F.array(*[f"k{i}" for i in range(TAU + 1)])).alias("key"))
    hot = durable(own.groupBy("key").count().filter(F.col("count") * SPARSE > HOT_LINES).select("key"))
    return F.broadcast(hot) if measured_small(hot) else hot


def forest(members: Column) -> Column:
    """Links ``a``, ``b`` of structs (``h``, ``line``) whose components are those of all links between them.

    Each line in turn takes over the labels of all earlier lines it is near to.
    """
    def near(x: Column, y: Column) -> Column:
        return F.levenshtein(F.get(members, x)["line"], F.get(members, y)["line"], TAU) >= 0

    def step(labels: Column, x: Column) -> Column:
        met = F.array_distinct(F.array_compact(F.transform(labels, lambda label, y: F.when(near(x, y), label))))
        return let(met, lambda m: F.concat(F.transform(labels, lambda label: F.when(F.array_contains(m, label), x).otherwise(label)), F.array(x)))

    count = F.sequence(F.lit(0), F.size(members) - 1)
    labels = F.aggregate(count, F.array().cast("array<int>"), step)
    links = lambda found: F.transform(
        found, lambda label, x: F.struct(F.get(members, x)["h"].alias("a"), F.get(members, label)["h"].alias("b"))
    )
    return F.filter(let(labels, links), lambda link: link["a"] != link["b"])


def _hot_links(rows: DataFrame, long: DataFrame) -> DataFrame:
    """Links between lines of one key, for keys of many lines: blocks of ``BLOCK`` lines meet pairwise, each cell gives a forest.

    ``rows`` has ``key`` and ``h``. A cell holds two blocks, so no task holds a whole key, and a dense
    group of n lines gives rows for its blocks, not for its n^2 links.
    """
    rows = durable(rows.distinct())
    wanted = rows.select("h").distinct()
    texts = long.join(F.broadcast(wanted) if measured_small(wanted) else wanted, "h", "left_semi")
    texts = texts.groupBy("h").agg(F.first("line").alias("line"))
    sizes = rows.groupBy("key").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
    own = F.pmod(F.xxhash64("h"), F.col("blocks")).cast("int").alias("own")
    placed = rows.join(sizes, "key").select("key", "h", own, F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
    cells = placed.select("key", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"), "h")
    filled = cells.join(texts, "h").groupBy("key", "low", "high").agg(F.array_sort(F.collect_list(F.struct("h", "line"))).alias("members"))
    return worked_out(filled.select(forest(F.col("members")).alias("links"))).select(F.inline("links")).distinct()


def line_links(all_lines: DataFrame) -> DataFrame:
    """Pairs ``a``, ``b`` of hashes of different lines at most ``TAU`` edits apart.

    Their components are those of all such pairs: every pair that shares a segment of few lines, and
    for a segment that many lines share a spanning forest of its pairs.
    """
    long = all_lines.filter(F.length("line") >= MIN_LENGTH)
    # From here on a line is its hash, its letter counts and its keys; the text stays where it is.
    sized = stored(sketches(long))
    keys = lambda names: F.explode(F.array_distinct(F.array(*names))).alias("key")
    every = [c for c in sized.columns if c.startswith("k")]
    hot = hot_keys(sized)
    index = sized.select(F.col("h").alias("a"), F.col("s").alias("sa"), keys(every[: TAU + 1])).join(hot, "key", "left_anti")
    probe = sized.select(F.col("h").alias("b"), F.col("s").alias("sb"), keys(every))
    # Lines that share a segment but have too many other letters fall out inside the join.
    alike = (
        (index["key"] == probe["key"])
        & (F.col("a") != F.col("b"))
        & (letter_difference(F.col("sa"), F.col("sb")) <= 2 * TAU)
    )
    pairs = durable(index.join(probe, alike).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
    wanted = pairs.select(F.explode(F.array("a", "b")).alias("h")).distinct()
    wanted = F.broadcast(wanted) if measured_small(wanted) else wanted
    texts = long.join(wanted, "h", "left_semi").groupBy("h").agg(F.first("line").alias("line"))
    near = pairs.join(texts.select(F.col("h").alias("a"), F.col("line").alias("x")), "a").join(
        texts.select(F.col("h").alias("b"), F.col("line").alias("y")), "b"
    )
    dense = _hot_links(probe.select("key", F.col("b").alias("h")).join(hot, "key", "left_semi"), long)
    return near.filter(F.levenshtein("x", "y", TAU) >= 0).select("a", "b").union(dense)


def line_classes(docs: DataFrame) -> DataFrame:
    """A row per line with a word: ``doc_id``, ``_doc``, ``_at``, ``h``, its class ``c`` and ``keep``.

    Equal lines are one class, and linked lines are; ``keep`` marks the first line of each class
    by doc_id (null ids last), text hash and place.
    """
    found = lines(docs)
    classes = components(line_links(found)).select(F.col("node").alias("h"), F.col("component").alias("_c"))
    slim = found.drop("line").join(classes, "h", "left").withColumn("c", F.coalesce("_c", "h")).drop("_c")
    order = F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("id"), "_doc", "_at")
    first = slim.groupBy("c").agg(F.min(order).alias("first"))
    return slim.join(first, "c").withColumn(
        "keep",
        F.col("first.id").eqNullSafe(F.col("doc_id")) & (F.col("first._doc") == F.col("_doc")) & (F.col("first._at") == F.col("_at")),
    ).drop("first")


def line_table(docs: DataFrame) -> DataFrame:
    """A row per document with its line counts and the classes of its lines.

    ``n_lines`` with a word, ``n_removed`` (not the first of their class), ``removed`` (their
    places, from 0) and ``line_classes`` (the distinct classes in order). A null, empty or blank
    text has no lines; rows alike in doc_id and text are one row; a null id sorts last; an empty
    table gives an empty result.
    """
    per_doc = line_classes(docs).groupBy("doc_id", "_doc").agg(
        F.count("*").alias("n_lines"),
        F.sum((~F.col("keep")).cast("bigint")).alias("n_removed"),
        F.array_sort(F.collect_set(F.when(~F.col("keep"), F.col("_at")))).alias("removed"),
        F.array_sort(F.collect_set("c")).alias("line_classes"),
    )
    rows = docs.select("doc_id", F.xxhash64(text_of()).alias("_doc")).distinct()
    same = rows["doc_id"].eqNullSafe(per_doc["doc_id"]) & (rows["_doc"] == per_doc["_doc"])
    none = F.lit(0).cast("bigint")
    return rows.join(per_doc, same, "left").select(
        rows["doc_id"],
        F.coalesce("n_lines", none).alias("n_lines"),
        F.coalesce("n_removed", none).alias("n_removed"),
        F.coalesce("removed", F.array().cast("array<int>")).alias("removed"),
        F.coalesce("line_classes", F.array().cast("array<bigint>")).alias("line_classes"),
    )


def without_repeats(docs: DataFrame) -> DataFrame:
    """The documents without the lines that repeat or nearly repeat an earlier line of the corpus."""
    gone = line_classes(docs).filter(~F.col("keep")).groupBy("doc_id", "_doc").agg(F.collect_set("_at").alias("_gone"))
    gone = gone.select(F.col("doc_id").alias("_id"), F.col("_doc").alias("_hash"), "_gone")
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.xxhash64(text_of()) == F.col("_hash"))
    left = F.filter(F.split("text", "\n"), lambda x, i: ~F.array_contains(F.col("_gone"), i))
    joined = docs.join(gone, same, "left")
    text = F.when(F.col("_gone").isNull(), F.col("text")).otherwise(F.array_join(left, "\n"))
    return joined.withColumn("text", text).select(*docs.columns)
