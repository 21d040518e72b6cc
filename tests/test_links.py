from conftest import rows
from pyspark.sql import functions as F

from layerloom.operators import links as lk


def pages(spark, *bodies, front=""):
    made = [(f"p{i}", "l1", front, b) for i, b in enumerate(bodies)]
    return spark.createDataFrame(made, "page_id string, layer string, front_matter string, body string")


def ids(spark, *known):
    return spark.createDataFrame([(k,) for k in known], "target string")


def test_wikilinks_of_both_parts(spark):
    df = pages(spark, "x [[A|b]] y [[C#d]] [[E]] [[]] [not](a.md)", front='subject: "[[S]]"')
    got = rows(lk.extract_wikilinks(df).select("part", "pos", "target", "anchor", "display"))
    assert got == [
        ("body", 1, "A", None, "b"), ("body", 2, "C", "d", None), ("body", 3, "E", None, None),
        ("fm", 1, "S", None, None),
    ]


def test_page_without_front_matter(spark):
    df = pages(spark, "[[A]]").withColumn("front_matter", F.lit(None).cast("string"))
    assert rows(lk.extract_wikilinks(df).select("target")) == [("A",)]


def test_markdown_and_html_links(spark):
    df = pages(spark, '["女神"](./ARC.md) and [x](https://a.b/c) <a class="k" href="/y">z</a>')
    assert rows(lk.extract_links(df).select("pos", "display", "url")) == [
        (1, '"女神"', "./ARC.md"), (2, "x", "https://a.b/c"),
    ]
    assert rows(lk.extract_links(df, html=True).select("display", "url")) == [("z", "/y")]


def test_resolution_and_dead_links(spark):
    df = lk.extract_wikilinks(pages(spark, "[[A]] [[B]] [[B]]"))
    assert rows(lk.resolve_links(df, ids(spark, "A")).select("target", "status")) == [
        ("A", "ok"), ("B", "dead"), ("B", "dead"),
    ]
    assert rows(lk.dead_links(df, ids(spark, "A")).select("target", "pos")) == [("B", 2), ("B", 3)]
    assert rows(lk.cited_minus_existing(df, ids(spark, "A"))) == [("B",)]


def test_existing_ids_of_one_layer(spark):
    df = spark.createDataFrame([("a", "l1"), ("a", "l2"), ("b", "l2")], "page_id string, layer string")
    assert rows(lk.existing_ids(df, layer="l1")) == [("a",)]
    assert rows(lk.existing_ids(df)) == [("l1", "a"), ("l2", "a"), ("l2", "b")]


def test_links_are_looked_up_in_their_own_layer(spark):
    found = lk.extract_wikilinks(pages(spark, "[[a]] [[b]]"), keep=["layer"])
    here = spark.createDataFrame([("l1", "a"), ("l2", "b")], "layer string, target string")
    assert rows(lk.resolve_links(found, here).select("target", "status")) == [("a", "ok"), ("b", "dead")]
    assert rows(lk.dead_links(found, here).select("target")) == [("b",)]


def test_unlink_wikilinks_is_idempotent(spark):
    df = pages(spark, "- [[A|shown]] — [[B]], [[C#d|e]] $1 \\", "untouched [[B]]", "no links")
    once = lk.unlink_missing(df, ids(spark, "B"), lk.WIKI)
    expected = [("- shown — [[B]], e $1 \\",), ("no links",), ("untouched [[B]]",)]
    assert rows(once.select("body")) == expected
    assert rows(lk.unlink_missing(once, ids(spark, "B"), lk.WIKI).select("body")) == expected


def test_unlink_cites_only(spark):
    form = lk.cite_form("https://site.example/w")
    text = (
        "[`ch1¶2`](https://site.example/w/L1/episodes/ch1/) [`ch9¶3`](https://site.example/w/episodes/ch9) "
        "[`ch9¶3`](https://other/episodes/ch9) [plain](https://site.example/w/L2/episodes/ch9) `ch9¶3`"
    )
    got = lk.unlink_missing(pages(spark, text), ids(spark, "ch1"), form).first()["body"]
    assert got == text.replace("[`ch9¶3`](https://site.example/w/episodes/ch9)", "`ch9¶3`")


def test_unlink_markdown(spark):
    got = lk.unlink_missing(pages(spark, "[a](x) [b](y)"), ids(spark, "y"), lk.MARKDOWN).first()["body"]
    assert got == "a [b](y)"


def test_counters(spark):
    before = pages(spark, "[[A]] [[B]] [[B]]", "[[A]]")
    after = lk.unlink_missing(before, ids(spark, "A"), lk.WIKI)
    assert rows(lk.link_counters(before, after, lk.WIKI)) == [("l1", 4, 2, 2)]
