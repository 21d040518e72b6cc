import pytest
from conftest import rows
from pyspark.sql import functions as F

from layerloom import schemas
from layerloom.operators import render, rollup
from layerloom.sources.sinks import page_text


@pytest.fixture(scope="module")
def claims(spark):
    made = [
        ("ch5004", "A_2", "t2", "alludes_to", "ME_b", "strong", "s2"),
        ("ch5004", "A_1", "t1", "analogous_to", "ME_a", "weak", "s1"),
        ("ch5004", "A_1", "t1", "analogous_to", "ME_a", "weak", "s1"),
        ("ch5009", "A_3", "t3", "sublates", "ME_a", "weak", "s3"),
    ]
    return spark.createDataFrame(
        made,
        "chapter string, claim_id string, title string, predicate string, object_id string, "
        "evidence_strength string, statement string",
    )


@pytest.fixture(scope="module")
def mysteries(spark):
    return spark.createDataFrame(
        [("ch5004", "MY_b", "b"), ("ch5004", "MY_B", "B")], "chapter string, mystery_id string, title string"
    )


@pytest.fixture(scope="module")
def chapters(spark):
    return spark.createDataFrame([("ch5004", "four"), ("ch5001", "one")], "chapter string, title string")


def test_references_of_backlinks_are_worked_out_once(spark, claims):
    refs = claims.select(F.col("object_id").alias("ref_id"))
    plan = rollup.backlinks(claims, refs)._jdf.queryExecution().optimizedPlan().toString()
    # Measured and joined as kept rows, not derived again in the join.
    assert "Join" in plan and "Aggregate" not in plan


def test_backlinks_keep_duplicates(spark, claims):
    refs = spark.createDataFrame([("ME_a",), ("ME_none",)], "ref_id string")
    got = rows(rollup.backlinks(claims, refs))
    assert got == [("ME_a", "A_1", "s1"), ("ME_a", "A_1", "s1"), ("ME_a", "A_3", "s3")]
    assert rows(rollup.backlink_counts(claims)) == [("ME_a", 3, 2), ("ME_b", 1, 1)]
    top = rollup.top_references(rollup.backlink_counts(claims), 1)
    assert rows(top.select("ref_id", "backlinks")) == [("ME_a", 3)]


def test_chapter_counts_keep_empty_chapters(chapters, claims, mysteries):
    assert rows(rollup.chapter_counts(chapters, claims, mysteries)) == [("ch5001", 0, 0, 0), ("ch5004", 3, 2, 2)]


def test_chapter_index(chapters, claims, mysteries):
    got = rows(rollup.chapter_index(chapters, claims, mysteries).select("chapter", "kind", "entry_id", "tag"))
    assert ("ch5001", "none", None, None) in got and ("ch5004", "claim", "A_2", "暗喩") in got
    assert ("ch5004", "reference", "ME_a", None) in got and len(got) == 8


def test_arc_edges(spark):
    arcs = spark.createDataFrame(
        [("ARC_01", "n", "s", 1, 50, "t"), ("ARC_03", "n", "s", 101, 150, "t")], schemas.ARCS
    )
    codes = ["ch0001", "ch0050", "ch0051", "ch0100", "ch0101", "ch0150", "ch0151", "ch5001"]
    df = spark.createDataFrame([(c,) for c in codes], "chapter string")
    got = dict(rows(rollup.arc_of_chapter(df, arcs).select("chapter", "arc_id")))
    assert got == {
        "ch0001": "ARC_01", "ch0050": "ARC_01", "ch0051": None, "ch0100": None, "ch0101": "ARC_03",
        "ch0150": "ARC_03", "ch0151": None, "ch5001": None,
    }


def test_listing_orders(mysteries):
    exact = rollup.listing(mysteries, "mystery_id", ["chapter"])
    assert rows(exact.select("position", "mystery_id")) == [(1, "MY_B"), (2, "MY_b")]
    folded = rollup.listing(mysteries, "mystery_id", ["chapter"], ignore_case=True)
    assert rows(folded.select("position", "mystery_id")) == [(1, "MY_B"), (2, "MY_b")]


def test_facets_and_totals(spark, claims):
    got = rows(rollup.claim_facets(claims))
    assert (None, None, 4) in got and (None, "weak", 3) in got and ("alludes_to", "strong", 1) in got
    pages = spark.createDataFrame(
        [("l1", "nav", "a"), ("l1", "arcs", "b"), ("l2", "nav", "a")], "layer string, section string, page_id string"
    )
    counted = rows(rollup.layer_counts(pages))
    assert (None, None, 3) in counted and ("l1", None, 2) in counted and ("l2", "nav", 1) in counted
    assert rows(rollup.section_index(pages))[0] == ("l1", "arcs", "b", 1)


@pytest.fixture(scope="module")
def observations(spark):
    made = [(1, "a", "says", 1, 5), (2, "a", "says", 1, 2), (3, "a", "uses", 4, 1), (4, "b", "says", 2, 1)]
    df = spark.createDataFrame(made, "event_id int, subject string, verb string, chapter_no int, para int")
    return df.selectExpr("*", "2 AS edition")


def test_entities(observations):
    assert rows(rollup.entity_stats(observations)) == [("a", 2, 1, 3, 2), ("b", 2, 2, 1, 1)]
    assert rows(rollup.top_quotes(observations, 2).select("subject", "event_id", "rank")) == [
        ("a", 1, 2), ("a", 2, 1), ("b", 4, 1),
    ]
    assert rows(rollup.observation_histogram(observations)) == [
        ("subject", "a", 3), ("subject", "b", 1), ("verb", "says", 3), ("verb", "uses", 1),
    ]
    assert rows(rollup.gaps(observations, 1, 5)) == [(2, 3), (2, 5)]


NAV = """---
title: four
id: nav/ch5004
description: 第5004話のアナロジー 3 件・伏線 2 件・外部参照 2 件
---

# four

## アナロジークレーム（3 件）

- [[A_1|t1]] `[類似]`
- [[A_1|t1]] `[類似]`
- [[A_2|t2]] `[暗喩]`

## 伏線（2 件）

- [[MY_B|B]]
- [[MY_b|b]]

## 引喩先・外部参照（2 件）

- [[ME_a]]
- [[ME_b]]"""


@pytest.mark.parametrize("group_rows", [1_000_000, 3])
def test_chapter_page_in_one_part_or_many(chapters, claims, mysteries, group_rows):
    lines = render.render_nav(chapters, claims, mysteries, group_rows=group_rows)
    text = {r["chapter"]: r["text"] for r in page_text(lines, "chapter").collect()}
    assert text["ch5004"] == NAV
    # Without references there is no such section, and the page ends with the mysteries.
    assert text["ch5001"].endswith("## アナロジークレーム（0 件）\n\n\n## 伏線（0 件）\n") and set(text) == {"ch5001", "ch5004"}
    parts = page_text(lines, "chapter", part_lines=5).collect()
    mine = sorted((r["part"], r["text"]) for r in parts if r["chapter"] == "ch5004")
    assert len(mine) > 1 and "\n".join(t for _, t in mine) == NAV


def test_chapter_page_with_headings_and_untitled_entries(spark, claims):
    chapters = spark.createDataFrame(
        [("ch5004", "four", "part two", "up | down"), ("ch5001", None, None, None)],
        "chapter string, title string, heading string, breadcrumb string",
    )
    mysteries = spark.createDataFrame(
        [("ch5004", "MY_a", None, "Lost key"), ("ch5004", "MY_b", None, None)],
        "chapter string, mystery_id string, title string, heading string",
    )
    bare = claims.withColumn("title", F.lit(None).cast("string")).withColumn("predicate", F.lit(None).cast("string"))
    lines = render.render_nav(chapters, bare, mysteries)
    assert lines.filter("line IS NULL").count() == 0
    text = {r["chapter"]: r["text"] for r in page_text(lines, "chapter").collect()}
    assert "# four\n\n## part two\n\nup | down\n\n## " in text["ch5004"]
    assert "- [[MY_a|Lost key]]\n- [[MY_b|MY_b]]\n" in text["ch5004"]
    assert "- [[A_2|A_2]] `[]`" in text["ch5004"]
    assert "# ch5001\n\n## アナロジークレーム（0 件）" in text["ch5001"]


def test_reference_page(spark, claims):
    refs = spark.createDataFrame([("ME_a", "a"), ("ME_z", None)], "ref_id string, canonical_name string")
    links = rollup.backlinks(claims, refs)
    text = {r["ref_id"]: r["text"] for r in page_text(render.render_reference(refs, links), "ref_id").collect()}
    assert text["ME_a"] == (
        "# a\n\n## 本作からの参照 (3 件)\n\n- [[A_1]] — s1\n- [[A_1]] — s1\n- [[A_3]] — s3"
    )
    assert text["ME_z"] == "# ME_z\n\n## 本作からの参照 (0 件)\n"
    made = page_text(render.render_reference(refs, links, intro="Cited here."), "ref_id")
    assert {r["ref_id"]: r["text"] for r in made.collect()}["ME_z"] == (
        "# ME_z\n\nCited here.\n\n## 本作からの参照 (0 件)\n"
    )


def test_editions_are_kept_apart(spark):
    seen = spark.createDataFrame(
        [(1, "a", 1, 9, 1), (2, "a", 2, 1, 1)], "event_id int, subject string, edition int, chapter_no int, para int"
    )
    assert rows(rollup.top_quotes(seen, 1).select("edition", "event_id", "rank")) == [(1, 1, 1), (2, 2, 1)]
    assert rows(rollup.gaps(seen, 8, 10).filter("edition = 1")) == [(1, 10), (1, 8)]
    assert rows(rollup.gaps(seen, 1, 2).filter("edition = 2")) == [(2, 2)]
