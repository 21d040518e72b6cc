from conftest import rows
from pyspark.sql import functions as F

from layerloom.functions import rewrite as rw
from layerloom.operators import quality as q
from layerloom.operators import structure as st


def frame(spark, schema, *made):
    return spark.createDataFrame(list(made), schema)


def test_count_drift_sees_unlinked_bullets(spark):
    head = "## 本作からの参照 (1 件)\n\n"
    pages = frame(
        spark, "page_id string, body string",
        ("plain", head + "- A_1 — x\n"), ("linked", head + "- [[A_1]] — x\n"), ("none", "# t\n"),
    )
    assert rows(q.count_drift(pages)) == [("plain", 1, 0)]


def test_chapter_and_index_drift(spark):
    front = "description: 第1話のアナロジー {} 件・伏線 1 件・外部参照 0 件"
    body = "- [[A_1|x]]\n- [[MY_1|y]]\n"
    nav = frame(
        spark, "page_id string, front_matter string, body string",
        ("good", front.format(1), body), ("bad", front.format(2), body),
    )
    got = rows(q.chapter_drift(nav).select("page_id", "declared_claims", "actual_claims"))
    assert got == [("bad", 2, 1)]
    index = frame(
        spark, "page_id string, body string",
        ("good", "全 **1 件**。\n\n- [a](./a.md)\n"), ("bad", "全 **2 件**。\n\n- [a](./a.md)\n"), ("other", "- x"),
    )
    assert rows(q.index_drift(index)) == [("bad", 2, 1)]


def test_list_drift(spark):
    def page(listed, shown):
        items = "".join(f"\n- '[[E_char_{n}]]'" for n in listed)
        return f"---\nid: {'-'.join(listed)}\ncharacters:{items}\n---\n" + "".join(f"- [[E_char_{n}]]\n" for n in shown)

    texts = [page("ab", "ab"), page("cd", "dc"), page("ef", "eg")]
    pages = st.split_front_matter(frame(spark, "text string", *[(t,) for t in texts]))
    got = rows(q.list_drift(st.typed_episodes(pages, keep=["body"])))
    assert got == [
        ("a-b", "none", [], []), ("c-d", "order", [], []), ("e-f", "content", ["E_char_f"], ["E_char_g"]),
    ]


def test_ids(spark):
    pages = frame(
        spark, "page_id string, fm_id string",
        ("ME_internet_flame_war", "ME_Internet_Flame_War"), ("ME_a", "ME_a"), ("ME_A", None),
    )
    assert rows(q.id_mismatches(pages).select("page_id")) == [("ME_internet_flame_war",)]
    assert rows(q.casefold_collisions(pages)) == [("me_a", 2, "ME_A", "ME_a")]


def test_kind_conflicts(spark):
    seen = frame(
        spark, "kind string, name string", ("char", "ノエル"), ("item", "ノエル"), ("motif", "ノエル"), ("char", "灯台守")
    )
    assert rows(q.kind_conflicts(seen)) == [("ノエル", 3, "char,item,motif", 3)]


def test_sample_is_reproducible_and_agreement_counts(spark):
    df = spark.range(1000).select("id", (F.col("id") % 10 > 0).cast("int").alias("found"), F.lit(1).alias("want"))
    first = q.audit_sample(df, 400, "id")
    again = q.audit_sample(df.repartition(7), 400, "id")
    assert rows(first) == rows(again) and first.count() == 400
    got = q.agreement(first, "found", "want").first()
    assert got["sampled"] == 400 and got["rate"] == round(got["agreed"] / 400, 6)


def test_grounding(spark):
    quotes = frame(
        spark, "quote_id string, chapter string, p_start int, p_end int, quote string",
        ("in", "c", 2, 3, "fox"), ("out", "c", 1, 1, "fox"), ("missing", "d", 1, 9, "fox"),
        ("wide", "c", 0, 5000, "owl"),
    )
    paragraphs = frame(
        spark, "chapter string, para int, text string",
        ("c", 1, "a hen"), ("c", 2, "a cat"), ("c", 3, "the fox"), ("c", 4000, "an owl"),
    )
    assert rows(q.ground_quotes(quotes, paragraphs)) == [
        ("in", 2, True), ("missing", 0, False), ("out", 1, False), ("wide", 4, True),
    ]


def test_lint_table(spark):
    claims = frame(
        spark, "claim_id string, predicate string, evidence_strength string",
        ("ok", "inverts", "weak"), ("bad", "loves", "huge"), ("none", None, "weak"),
    )
    links = frame(spark, "page_id string, target string", ("p", "gone"))
    doubled = frame(spark, "ref_id string, claim_id string", ("r", "c"), ("r", "c"), ("r", "d"))
    table = q.lint([q.lint_links(links), q.lint_enums(claims), q.lint_duplicates(q.duplicate_backlinks(doubled))])
    assert rows(table) == [
        ("DUP001", "warning", "r", "c x2"), ("LNK003", "error", "p", "gone"),
        ("REF001", "error", "bad", "predicate=loves,evidence_strength=huge"), ("REF001", "error", "none", "predicate="),
    ]


FIXES = [
    q.Fix("LNK-DEPTH", "safe", rw.section_links),
    q.Fix("UPPER", "review", F.upper),
]


def test_fix_plan_and_application(spark):
    pages = frame(spark, "path string, text string", ("a", "[n](nav/index.md)"), ("b", "OK"))
    plan = rows(q.plan_fixes(pages, FIXES).select("path", "rule", "safety", "after"))
    assert plan == [
        ("a", "LNK-DEPTH", "safe", "[n](../../../nav/index.md)"), ("a", "UPPER", "review", "[N](NAV/INDEX.MD)"),
    ]
    found = frame(spark, "path string, rule string", ("a", "UPPER"), ("a", "UPPER"), ("b", "UPPER"))
    assert rows(q.plan_fixes(pages, FIXES, findings=found).select("path", "rule")) == [("a", "UPPER")]
    assert rows(q.apply_fixes(pages, FIXES)) == [("a", "[n](../../../nav/index.md)"), ("b", "OK")]
    both = q.apply_fixes(pages, FIXES, ("safe", "review"))
    assert rows(both) == [("a", "[N](../../../NAV/INDEX.MD)"), ("b", "OK")]


def test_idempotence_check(spark):
    pages = frame(spark, "text string", ("[n](nav/index.md)",), ("x",))
    assert q.not_idempotent(pages, rw.section_links).count() == 0
    assert q.not_idempotent(pages, lambda t: F.concat(t, F.lit("!"))).count() == 2
