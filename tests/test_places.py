"""Quote places, link containment, ranges of units and stratified samples against brute force."""

import random
import re

import pytest
from conftest import rows
from pyspark.sql import functions as F

from layerloom.functions import skew
from layerloom.operators import containment, intervals, places, quality


@pytest.mark.parametrize("hot", [skew.HOT_ROWS, 2])
def test_quotes_are_found_wherever_they_stand(spark, monkeypatch, hot):
    monkeypatch.setattr(skew, "HOT_ROWS", hot)
    if hot == 2:
        monkeypatch.setattr(skew, "BROADCAST_ROWS", 0)
    r = random.Random(hot)
    texts = ["".join(r.choices("abé語🙂 \n", k=r.randint(0, 120))) for _ in range(60)] + ["a" * 70, None, ""]
    # A third are copies.
    texts += [texts[3] + texts[4]] * 30
    told = [(f"c{n % 3}", n, t) for n, t in enumerate(texts)]
    quotes = []
    for size in [1, 2, 5, 7, 8, 9, 14, 15, 16, 23, 40]:
        source = r.choice([t for t in texts if t and len(t) > size])
        at = r.randrange(len(source) - size + 1)
        quotes += [source[at : at + size], source[at : at + size][:-1] + "#"]
    quotes += ["a" * 20, "a" * 3, "", None, quotes[0]]
    named = list(enumerate(quotes))
    found = places.locate_quotes(
        spark.createDataFrame(named, "quote_id int, quote string"), spark.createDataFrame(told, "chapter string, para int, text string")
    )
    want = [
        (n, c, p, at) for n, q in named if q for c, p, t in told if t
        for at in range(len(t) - len(q) + 1) if t[at : at + len(q)] == q
    ]
    assert rows(found) == sorted(want, key=repr)


def test_no_quotes_and_no_paragraphs(spark):
    quotes = spark.createDataFrame([(1, "long enough to have a pivot"), (2, "ab")], "quote_id int, quote string")
    told = spark.createDataFrame([("c", 1, "ab")], "chapter string, para int, text string")
    assert rows(places.locate_quotes(quotes, told)) == [(2, "c", 1, 0)]
    assert places.locate_quotes(quotes.filter("false"), told).count() == 0
    assert places.locate_quotes(quotes, told.filter("false")).count() == 0


def test_texts_are_handed_on_in_parts(spark, monkeypatch):
    """The pieces of ten thousand texts at once were more than an executor holds; now none leave a task but hits."""
    monkeypatch.setattr(places, "HELD_ITEMS", 3)
    monkeypatch.setattr(places, "QUOTES_PER_ROW", 2)
    told = spark.createDataFrame([("c", n, "abcab" * n) for n in range(1, 9)], "chapter string, para int, text string")
    words = ["ab", "abc", "b", "cab", "abcababcababcab", "x"]
    quotes = spark.createDataFrame(list(enumerate(words)), "quote_id int, quote string")
    want = [(i, "c", n, at) for i, q in enumerate(words) for n in range(1, 9) for at in places.occurrences("abcab" * n, q)]
    assert rows(places.locate_quotes(quotes, told)) == sorted(want, key=repr)
    offered = places._by_length(quotes.filter("length(quote) < 15").select("quote"), told)
    plan = offered._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" in plan and "ArrowEvalPython" not in plan and "Join" not in plan


PAGE = """[[Z]] before
# one
[[A|a]] and [[B#x]]
## two
<!-- AUTO-GENERATED:links -->
[[C]]
### three
[[D]]
<!-- /AUTO-GENERATED:links -->
[[E]]
<!-- AUTO:BEGIN -->[[F]]<!-- AUTO:END -->
## four
<!-- AUTO-GENERATED:open -->
[[G]]
# five
[[H]]"""


def test_links_know_their_headings_and_blocks(spark):
    pages = spark.createDataFrame([("p", PAGE), ("q", None), ("r", "no link"), ("s", "####### no heading\n[[I]]")], "page_id string, body string")
    assert rows(containment.link_sections(pages).select("page_id", "pos", "target", "path", "block")) == sorted([
        ("p", 1, "Z", "", None), ("p", 2, "A", "one", None), ("p", 3, "B", "one", None), ("p", 4, "C", "one > two", "links"),
        ("p", 5, "D", "one > two > three", "links"), ("p", 6, "E", "one > two > three", None),
        ("p", 7, "F", "one > two > three", "auto"), ("p", 8, "G", "one > four", None), ("p", 9, "H", "five", None),
        ("s", 1, "I", "", None),
    ], key=repr)


def test_containment_equals_a_scan_of_the_spans():
    r = random.Random(8)
    parts = ["# h1\n", "## h2\n", "### h3\n", "<!-- AUTO-GENERATED:x -->\n", "<!-- /AUTO-GENERATED:x -->\n", "[[L]]\n", "text\n"]
    for _ in range(200):
        body = "".join(r.choices(parts, k=25))
        found = containment.contained(body)
        for link, got in zip(re.finditer(r"\[\[L\]\]", body), found, strict=True):
            path = []
            for head in re.finditer(r"(?m)^(#+) (.*)$", body[: link.start()]):
                path = [h for h in path if h[0] < len(head[1])] + [(len(head[1]), head[2])]
            inside = [m for m in re.finditer(containment.BLOCK, body) if m.start() <= link.start() < m.end()]
            assert got == {"target": "L", "path": " > ".join(n for _, n in path), "block": "x" if inside else None}


def test_bins_fill_a_range_exactly(spark):
    r = random.Random(9)
    spans = [(r.randrange(5_000), 0) for _ in range(150)]
    spans = [(a, a + r.choice([-1, 0, 1, 15, 16, 17, 255, 300, 4_000])) for a, _ in spans] + [(0, 4_095), (16, 31), (5, 2**40), (3, 3)]
    made = spark.createDataFrame(spans, "low bigint, high bigint").distinct().filter("low <= high")
    for row in made.select("low", "high", intervals.bins_of_range(F.col("low"), F.col("high")).alias("bins")).collect():
        edges = sorted((b["bin"] << 4 * b["level"], (b["bin"] + 1) << 4 * b["level"]) for b in row["bins"])
        assert edges[0][0] == row["low"] and edges[-1][1] == row["high"] + 1
        assert all(a[1] == b[0] for a, b in zip(edges, edges[1:]))
        assert max(sum(b["level"] == n for b in row["bins"]) for n in range(intervals.LEVELS)) <= 30


@pytest.mark.parametrize("hot", [skew.HOT_ROWS, 3])
def test_units_meet_all_their_ranges(spark, monkeypatch, hot):
    monkeypatch.setattr(skew, "HOT_ROWS", hot)
    if hot == 3:
        monkeypatch.setattr(skew, "BROADCAST_ROWS", 0)
    r = random.Random(hot)
    spans = [(f"r{n}", a, a + r.choice([-2, 0, 3, 40, 700])) for n, a in enumerate(r.choices(range(1_000), k=60))]
    spans += [("all", 0, 10**9), ("none", 5, 4), ("open", 5, None), ("below", -9, 2)]
    units = [(n, r.randrange(1_200)) for n in range(150)] + [(200 + n, 7) for n in range(80)] + [(999, None), (998, -3)]
    found = intervals.ranges_of_units(
        spark.createDataFrame(units, "id int, unit int"), spark.createDataFrame(spans, "name string, low bigint, high bigint")
    )
    want = [(i, u, n, a, b) for i, u in units if u is not None and u >= 0 for n, a, b in spans if b is not None and a <= u <= b]
    assert rows(found) == sorted(want, key=repr)
    assert intervals.ranges_of_units(spark.createDataFrame(units, "id int, unit int"), spark.createDataFrame(spans, "name string, low bigint, high bigint").filter("false")).count() == 0


def test_stratified_sample_does_not_depend_on_partitions(spark):
    r = random.Random(3)
    made = spark.createDataFrame([(n, r.choice(["a", "a", "a", "b", None]), r.randrange(2)) for n in range(400)], "id int, stratum string, found int")
    samples = [rows(quality.audit_sample_strata(made.repartition(n), 20, "id", "stratum")) for n in (1, 9)]
    assert samples[0] == samples[1] and len(samples[0]) == 60
    sample = quality.audit_sample_strata(made, 20, "id", "stratum").withColumn("expected", F.lit(1))
    sizes = made.groupBy("stratum").agg(F.count("*").alias("rows"))
    for row in quality.agreement_by_stratum(sample, sizes, "found", "expected", "stratum").collect():
        assert row["sampled"] == 20 and 0 <= row["low"] <= row["rate"] <= row["high"] <= 1
    assert {x["stratum"] for x in quality.agreement_by_stratum(sample, sizes, "found", "expected", "stratum").collect()} == {"a", "b", None}


@pytest.mark.parametrize("broadcast", [skew.BROADCAST_ROWS, 0])
def test_totals_of_ranges_need_no_pairs(spark, monkeypatch, broadcast):
    monkeypatch.setattr(skew, "BROADCAST_ROWS", broadcast)
    r = random.Random(4)
    units = [(n, r.choice([None, *range(40), 700])) for n in range(300)] + [(None, 3), (1, -2)]
    spans = [(n, a, a + w) for n, (a, w) in enumerate((r.randrange(-5, 60), r.choice([-1, 0, 2, 35, 900])) for _ in range(60))] + [(90, None, 4), (91, 2, None)]
    told = spark.createDataFrame(units, "id int, unit int")
    asked = spark.createDataFrame(spans, "name int, low bigint, high bigint")
    paired = intervals.ranges_of_units(told, asked).groupBy("name", "low", "high").agg(
        F.count("*").alias("rows"), F.min("unit").cast("bigint").alias("first"), F.max("unit").cast("bigint").alias("last"), F.sum("id").alias("id")
    )
    found = intervals.range_totals(told, asked, ["id"])
    assert found.columns == ["name", "low", "high", "rows", "first", "last", "id"]
    assert rows(found) == rows(paired) and found.count() > 30
    assert intervals.range_totals(told.filter("false"), asked, ["id"]).count() == 0
