import re

import pytest
from conftest import rows
from pyspark.sql import functions as F

from layerloom.functions import front_matter as fm
from layerloom.operators import filters, quality
from layerloom.operators import structure as st
from layerloom.plans import stand_ins as si

CLAIM = """---
schema_version: "5.1"
id: A_ch5004_alludes_to_E_p12_keys
title: 三本の鍵

type: analytical_claim
created: "2026-10-21"
subject: "[[E_ch5004_ノエル_thinks_港_p2]]"
predicate: alludes_to
object: "[[ME_three_keys]]"
epistemic_status: hypothesized
review_status: llm_verified
document_status: draft
spoiler_after: ch5004
evidence_strength: moderate
provenance:
  proposed_by: {kind: agent, id: agent-1}
  reviewed_by: {kind: agent, id: agent-2, date: "2026-10-22"}
---
<!-- LLM-GENERATED -->

# 扉の鍵が合う。

> 鍵は三本、机の上に並ぶ。（p12）

**審査（LLM 代替）**: 根拠として十分。
"""

MYSTERY = """---
title: "lost_bell"
id: MY_ch0009_lost_bell
type: mystery
created: "2026-09-30"
mystery_status: candidate
spoiler_after: ch0009
review_status: llm_verified
timeline:
  introduced: ch0009
provenance:
  proposed_by: {kind: agent, id: a}
  reviewed_by: {kind: agent, id: a, date: "2026-09-30"}
---
<!-- LLM-GENERATED -->

# lost_bell

「鐘の音」の出どころ。

**回収示唆**: 明示される。

> 『朝か？』（p41）
> まだか？（p43）

**審査（LLM 代替）**: 成立している。
"""

EPISODE = """---
schema_version: '5.1'
id: O_ch0001_summary
chapter: ch0001
characters:
- '[[E_char_灯台守]]'
- '[[E_char_灯台]]'
items:
- '[[E_item_ノエル]]'
relationships:
arc: '[[ARC_01_港の章]]'
---
# ch0001

## 概要

（ここにエピソードの要約を記述。人間が書くか、LLMで生成）

<!-- AUTO-GENERATED:links -->
### 登場人物

- [[E_char_灯台守]]
- [[E_char_灯台]]

### 物品

- [[E_item_ノエル]]

<!-- /AUTO-GENERATED:links -->

## メモ
<!-- AUTO:BEGIN -->
x
<!-- AUTO:END -->
"""


@pytest.fixture(scope="module")
def split(spark):
    made = [("claim", CLAIM), ("mystery", MYSTERY), ("episode", EPISODE), ("index", "# 索引\n\n全 **2 件**。\n")]
    return st.split_front_matter(spark.createDataFrame(made, "page_id string, text string")).cache()


def page(split, page_id):
    return split.filter(F.col("page_id") == page_id)


def test_split_puts_the_page_back_together(split):
    for row in split.collect():
        if row["page_id"] == "index":
            assert row["front_matter"] is None and row["body"] == row["text"]
        else:
            assert f"---\n{row['front_matter']}\n---\n{row['body']}" == row["text"]


def test_rule_inside_a_page_is_not_front_matter(spark):
    df = spark.createDataFrame([("x\n---\na: b\n---\n",), ("---\nnever closed",)], "text string")
    assert [r["front_matter"] for r in st.split_front_matter(df).collect()] == [None, None]


def test_claim(split):
    c = st.typed(page(split, "claim"), "claims").first()
    assert c["claim_id"] == "A_ch5004_alludes_to_E_p12_keys" and str(c["created"]) == "2026-10-21"
    assert c["subject_id"] == "E_ch5004_ノエル_thinks_港_p2" and c["object_id"] == "ME_three_keys"
    assert (c["predicate"], c["evidence_strength"], c["spoiler_after"]) == ("alludes_to", "moderate", "ch5004")
    assert c["proposed_by"]["id"] == "agent-1" and str(c["reviewed_by"]["date"]) == "2026-10-22"
    assert c["statement"] == "扉の鍵が合う。" and c["quote"] == "鍵は三本、机の上に並ぶ。"
    assert [tuple(x) for x in c["locators"]] == [(12, 12)] and c["review_note"] == "根拠として十分。"


def test_mystery(split):
    m = st.typed(page(split, "mystery"), "mysteries").first()
    assert (m["mystery_id"], m["introduced"], m["title"]) == ("MY_ch0009_lost_bell", "ch0009", "lost_bell")
    assert m["question"] == "「鐘の音」の出どころ。" and m["payoff_hint"] == "明示される。"
    assert [q["text"] for q in m["quotes"]] == ["『朝か？』", "まだか？"]


def test_episode_and_its_elements(split):
    episodes = st.typed(page(split, "episode"), "episodes")
    e = episodes.first()
    assert e["characters"] == ["E_char_灯台守", "E_char_灯台"] and e["relationships"] == [] and e["motifs"] == []
    assert e["arc"] == "ARC_01_港の章"
    assert rows(st.episode_entities(episodes).select("kind", "name", "pos")) == [
        ("char", "灯台", 2), ("char", "灯台守", 1), ("item", "ノエル", 3),
    ]


def test_quote_ordinals(split):
    got = st.extract_quotes(page(split, "mystery")).select("ordinal", "text")
    assert rows(got) == [(1, "『朝か？』"), (2, "まだか？")]


def test_sections(split, spark):
    got = rows(st.sections(page(split, "episode")).select("level", "title", "declared"))
    assert (1, "ch0001", None) in got and (3, "物品", None) in got and (2, "メモ", None) in got
    counted = spark.createDataFrame([("p", "## 伏線（4 件）\nx\n## 本作からの参照 (2 件)\n")], "page_id string, body string")
    assert rows(st.sections(counted).select("declared", "content")) == [(2, ""), (4, "x\n")]


def test_generated_blocks(split):
    got = rows(st.generated_blocks(page(split, "episode")).select("ordinal", "block"))
    assert got == [(1, "links"), (2, "auto")]
    hand = page(split, "episode").select(st.hand_written(F.col("body")).alias("h")).first()["h"]
    assert "E_char" not in hand and "AUTO" not in hand and "## メモ" in hand


def test_declared_counts(split, spark):
    assert page(split, "index").select(st.declared_index(F.col("body")).alias("n")).first()["n"] == 2
    text = "第5004話のアナロジー 6 件・伏線 4 件・外部参照 5 件"
    got = spark.createDataFrame([(text,)], "d string").select(st.declared_chapter(F.col("d")).alias("x")).first()
    assert tuple(got["x"]) == (6, 4, 5)


def test_reference_and_entity(spark):
    ref = '---\nid: ME_Tide\ntitle: 潮風\nsubtype: popular_culture\ncanonical_name: "Tide"\n---\n\n## 本作からの参照 (3 件)\n'
    ent = "---\nid: E_term_Lantern\ntitle: Lantern\nsubtype: terminology\naliases: []\nfirst_appearance: ch5063\n---\n# Lantern\n"
    pages = st.split_front_matter(spark.createDataFrame([("r", ref), ("e", ent)], "page_id string, text string"))
    r = st.typed(pages.filter("page_id = 'r'"), "references").first()
    assert (r["ref_id"], r["canonical_name"], r["declared_count"], r["domain"]) == ("ME_Tide", "Tide", 3, None)
    e = st.typed(pages.filter("page_id = 'e'"), "entities").first()
    assert (e["entity_id"], e["aliases"], e["first_appearance"]) == ("E_term_Lantern", [], "ch5063")


def test_spoiler_gate_stays_in_its_edition(spark):
    df = spark.createDataFrame([("ch0001",), ("ch0100",), ("ch5004",), ("ch5099",)], "spoiler_after string")
    assert rows(filters.visible_at(df, "ch5050")) == [("ch5004",)]
    assert rows(filters.visible_at(df, "ch0100")) == [("ch0001",), ("ch0100",)]


def test_minimum_evidence(spark):
    df = spark.createDataFrame(
        [("weak", "ok"), ("strong", "ok"), ("explicit", "no")], "evidence_strength string, review_status string"
    )
    assert rows(filters.min_evidence(df, "moderate")) == [("explicit", "no"), ("strong", "ok")]
    assert rows(filters.min_evidence(df, "weak", review_status="ok")) == [("strong", "ok"), ("weak", "ok")]


def test_stubs(split):
    typed = st.typed_episodes(page(split, "episode"), keep=["page_id", "body"])
    assert rows(filters.stub_pages(typed).select("has_placeholder", "is_empty")) == [(True, False)]
    assert rows(filters.stub_pages(typed, "organizations").select("is_empty")) == [(True,)]


def test_thin_units_include_missing(spark):
    seen = spark.createDataFrame([(1,), (1,), (1,), (2,)], "unit int")
    units = spark.createDataFrame([(1,), (2,), (3,)], "unit int")
    assert rows(filters.thin_units(seen, units, 3)) == [(2, 1), (3, 0)]


def test_lines_of_a_front_matter_as_one_pattern_reads_them(spark):
    lines = [
        "a: x", "b: 'x'", 'c: "x y"  ', "d:", "e:\t ", "f: '", 'g: "\'"', "h: 'x\"", "i: \"a\" \"b\"", "j: ''", "k:'' '", "l: ' x ' \t", " m: no",
        "n o: no", "p: a: b", "q:x\r", "r: '''", "a: again", "s: {k: v, id: 'w'}", "t: 語'", "u: \u3000x\u3000",
    ]
    front = "\n".join(lines)
    # What the lines are by definition: key, quote mark, value without its quotes.
    want = [(k, v) for k, _, v in re.findall(r"""(?m)^(\w+):[ \t]*(["']?)(.*?)\2[ \t]*$""", front.replace("\r", ""))]
    got = spark.createDataFrame([(front,)], "f string").select(fm.entries(F.col("f")).alias("e")).first()["e"]
    assert list(zip(got["keys"], got["values"])) == want


def test_pages_of_a_few_splits_are_dealt_over_the_tasks(spark, sf_dir):
    for made in (si.claim_pages(spark, sf_dir), si.episode_pages(spark, sf_dir)):
        assert made.rdd.getNumPartitions() == int(spark.conf.get("spark.sql.shuffle.partitions"))


def test_lists_and_single_values_as_their_definitions_read_them(spark):
    fronts = [
        "k:\n- a\n- 'b'\n- \"c d\" \n- [[E|x]]\n- '[[E_b#s|y]]'\nz: 1\nk:\n- late", "k: \t\n- a\n\n  - b\n # c\n-d\n- \n-\t'\n_z:\n- no",
        "a: 1\nk:\n", "k:\nz:\n- no", "k: []\n- no", " k:\n- no", "k:\n- [[a]] b\n- a|b]]\n- 'x\n- '[[y]]\n- \"it's\"\n- a]] ]]",
        "k:\n- 語|#]]\n- [[語 x]]\n- x_1 '\n- ''\n- \"'\"", "k: 'it''s' ' \t", "k:\n", "k: \"a b", "k: a\nk: b", "kk: a\nk : b", "k:' x'", "",
    ]
    block = re.compile(r"(?ms)^k:[ \t]*$\n(.*?)(?=^\w|\Z)")
    item = re.compile(r"""(?m)^[ \t]*-[ \t]+(["']?)(?:\[\[(?=.*\]\]))?(.*?)(?:(?:[|#].*)?\]\])?\1[ \t]*$""")
    front = F.col("f")
    got = spark.createDataFrame([(f,) for f in fronts], "f string").select(
        "f", fm.block_list(front, "k").alias("items"), fm.value(front, "k").alias("value"), fm.scalar(fm.entries(front), "k").alias("entry")
    )
    for f, items, value, entry in got.collect():
        found = block.search(f)
        assert items == [x for _, x in item.findall(found[1] if found else "")], f
        assert value == entry, f


def test_drift_of_lists_reads_the_lists_alone(spark, sf_dir):
    drift = quality.list_drift(st.typed_episodes(si.episode_pages(spark, sf_dir), keep=["body"]))
    plan = drift._jdf.queryExecution().optimizedPlan().toString()
    assert "relationships:" in plan
    assert not any(part in plan for part in ("proposed_by:", "^>", r"^\w+:.*$"))
