import random

import pytest
from conftest import rows
from pyspark.sql import functions as F

from layerloom import schemas
from layerloom.fixed_values import EXPLICIT, SAME_SPELLING, UNVERIFIED
from layerloom.functions import skew
from layerloom.operators import ledger as lg
from layerloom.operators import name_search
from layerloom.plans.layers import build_l2


def ledger(spark, *entries):
    made = [(n, r, c, at) for at, (n, r, c) in enumerate(entries)]
    return spark.createDataFrame(made, schemas.LEDGER)


def pages(spark, *bodies):
    return spark.createDataFrame([(f"p{i}", b) for i, b in enumerate(bodies)], "page_id string, body string")


def run(spark, entries, body, **limits):
    done = lg.normalize_names(pages(spark, body), ledger(spark, *entries), **limits).first()
    audit = [(a["name"], a["representative"], a["replaced"]) for a in done["audit"]]
    return done["body"], audit, [n["name"] for n in done["notes"]]


@pytest.fixture(params=["inline", "one shard", "many shards"])
def limits(request, monkeypatch):
    """The ways a ledger is applied: written into the query, searched in one shard, or in shards of one name each."""
    if request.param == "many shards":
        monkeypatch.setattr(skew, "BROADCAST_ROWS", 0)
        monkeypatch.setattr(skew, "HOT_ROWS", 1)
        monkeypatch.setattr(name_search, "SHARD_NAMES", 1)
    return {} if request.param == "inline" else {"inline_names": 0}


def test_no_chaining(spark, limits):
    entries = [("ノエル", "書き手", EXPLICIT), ("書き手", "ミナトノエル", EXPLICIT)]
    body, audit, _ = run(spark, entries, "ノエルとノエル。書き手。ノエル、ノエル", **limits)
    assert body == "書き手と書き手。ミナトノエル。書き手、書き手"
    assert audit == [("ノエル", "書き手", 4), ("書き手", "ミナトノエル", 1)]


def test_longest_match(spark, limits):
    entries = [("霧猫", "霧獣", EXPLICIT), ("霧猫の老商人", "メル・オルト", SAME_SPELLING)]
    body, audit, _ = run(spark, entries, "霧猫の老商人による", **limits)
    assert body == "メル・オルトによる" and audit == [("霧猫の老商人", "メル・オルト", 1)]


def test_link_target_address_and_block_are_protected(spark, limits):
    entries = [("ノエル", "書き手", EXPLICIT)]
    block = "<!-- AUTO-GENERATED:l2ref -->\nノエル\n<!-- /AUTO-GENERATED:l2ref -->"
    text = f"[[MY_ノエルの腕|ノエルの腕]] [ノエル](./ノエル.md) [[ノエル]]\n{block}\nノエル"
    body, audit, _ = run(spark, entries, text, **limits)
    assert body == f"[[MY_ノエルの腕|書き手の腕]] [書き手](./ノエル.md) [[ノエル]]\n{block}\n書き手"
    assert audit == [("ノエル", "書き手", 3)]


def test_block_without_end_is_ordinary_text(spark, limits):
    text = "<!-- AUTO-GENERATED:l2ref -->\nノエル"
    body, _, _ = run(spark, [("ノエル", "書き手", EXPLICIT)], text, **limits)
    assert body == text.replace("ノエル", "書き手")


def test_notes_scan_the_result(spark, limits):
    entries = [
        ("ルカ", "ルカーシャ", UNVERIFIED), ("ルカーシャ", "x", UNVERIFIED), ("潮見", "y", UNVERIFIED),
        ("潮見祭礼", "カイト", EXPLICIT), ("カイ", "z", UNVERIFIED),
    ]
    body, audit, notes = run(spark, entries, "ルカーシャの潮見祭礼", **limits)
    assert body == "ルカーシャのカイト" and audit == [("潮見祭礼", "カイト", 1)]
    assert notes == ["ルカ", "ルカーシャ", "カイ"]


def test_unverified_names_are_not_applied(spark, limits):
    body, audit, notes = run(spark, [("a", "b", UNVERIFIED)], "aaa", **limits)
    assert (body, audit, notes) == ("aaa", [], ["a"])


def test_audit_order_by_count_then_first_place(spark, limits):
    entries = [("a", "1", EXPLICIT), ("b", "2", EXPLICIT), ("c", "3", EXPLICIT)]
    _, audit, _ = run(spark, entries, "c a b b a c x c", **limits)
    assert [(n, k) for n, _, k in audit] == [("c", 3), ("a", 2), ("b", 2)]


def test_names_with_regex_characters(spark, limits):
    entries = [("a.b", "dot", EXPLICIT), ("(c)", "ring", EXPLICIT), ("$d", "cash", EXPLICIT)]
    body, _, _ = run(spark, entries, "a.b axb (c) $d d", **limits)
    assert body == "dot axb ring cash d"


def test_a_name_may_begin_before_a_protected_span(spark, limits):
    entries = [("a[[", "A", EXPLICIT), ("b", "B", EXPLICIT)]
    body, audit, _ = run(spark, entries, "a[[b|b]] [[b|b](b) ]b", **limits)
    assert body == "AB|B]] [[b|B](b) ]B"
    assert audit == [("b", "B", 4), ("a[[", "A", 1)]


def test_repeated_page_ids_and_names_and_null_texts(spark, limits):
    source = [("p", "a b"), ("p", "a b"), ("p", "b c"), (None, "c"), ("q", None), ("r", "")]
    book = ledger(
        spark, ("a", "2", EXPLICIT), ("a", "1", SAME_SPELLING), ("a", "0", UNVERIFIED), ("b", "x", EXPLICIT),
        ("b", None, EXPLICIT), ("c", "z", UNVERIFIED), ("c", "y", UNVERIFIED), ("", "e", EXPLICIT), (None, "e", EXPLICIT),
    )
    done = lg.normalize_names(spark.createDataFrame(source, "page_id string, body string"), book, **limits)
    got = [(r["page_id"], r["body"], [tuple(a) for a in r["audit"]], [tuple(n) for n in r["notes"]]) for r in done.collect()]
    both = [("a", "1", SAME_SPELLING, 1), ("b", "x", EXPLICIT, 1)]
    # The note's representative is that of the lowest ord.
    assert sorted(got, key=repr) == sorted([
        ("p", "1 x", both, []), ("p", "1 x", both, []), ("p", "x c", [("b", "x", EXPLICIT, 1)], [("c", "z")]),
        (None, "c", [], [("c", "z")]), ("q", None, [], []), ("r", "", [], []),
    ], key=repr)


def test_one_shard_and_eight_give_the_same(spark, monkeypatch):
    rng = random.Random(11)
    names = {"".join(rng.choices("abc", k=rng.randint(1, 6))): rng.choice([EXPLICIT, UNVERIFIED]) for _ in range(160)}
    book = ledger(spark, *[(n, f"<{n}>", c) for n, c in names.items()])
    source = pages(spark, *["".join(rng.choices("abcd[|](", k=200)) for _ in range(30)])
    found = []
    for size in (1_000, len(names) // 8):
        monkeypatch.setattr(name_search, "SHARD_NAMES", size)
        found.append(rows(lg.normalize_names(source, book, inline_names=0).selectExpr("page_id", "body", "string(audit)", "string(notes)")))
    assert found[0] == found[1]
    assert found[0] == rows(lg.normalize_names(source, book).selectExpr("page_id", "body", "string(audit)", "string(notes)"))


def test_empty_ledger(spark):
    body, audit, notes = run(spark, [], "text")
    assert (body, audit, notes) == ("text", [], [])


def plain_single_pass(text, names):
    out, i = [], 0
    ordered = sorted(names, key=len, reverse=True)
    while i < len(text):
        name = next((n for n in ordered if text.startswith(n, i)), None)
        out.append(names[name] if name else text[i])
        i += len(name) if name else 1
    return "".join(out)


def test_random_ledgers_against_a_plain_replacer(spark, limits):
    rng = random.Random(7)
    for _ in range(4):
        names = {"".join(rng.choices("abc", k=rng.randint(1, 4))): f"<{i}>" for i in range(8)}
        bodies = ["".join(rng.choices("abcd\n", k=rng.randint(0, 60))) for _ in range(40)]
        book = ledger(spark, *[(n, r, EXPLICIT) for n, r in names.items()])
        done = lg.substitute(pages(spark, *bodies), book, **limits).select("page_id", "body", "audit").collect()
        for row in done:
            source = bodies[int(row["page_id"][1:])]
            assert row["body"] == plain_single_pass(source, names)
            for a in row["audit"]:
                # Representatives are unique marks, so their count is the number replaced.
                assert row["body"].count(a["representative"]) == a["replaced"]


PAGE = "---\nid: MY_1\n---\n# t\n\nノエル、書き手、トト\n"


def test_layer_page_and_its_audit_section(spark):
    book = ledger(
        spark, ("ノエル", "書き手", EXPLICIT), ("書き手", "ミナト", EXPLICIT), ("トト", "トト(仮)", UNVERIFIED)
    )
    source = spark.createDataFrame(
        [("l1/mysteries/MY_1.md", "MY_1", "mysteries", PAGE), ("l1/arcs/index.md", "index", "arcs", "何もない")],
        "path string, page_id string, section string, text string",
    )
    made = {r["page_id"]: r for r in build_l2(source, book, "20261116T1700_v144").collect()}
    assert made["MY_1"]["path"] == "l2/mysteries/MY_1.md"
    assert made["MY_1"]["text"] == (
        "---\nid: MY_1\nnormalized_from: l1/mysteries/MY_1.md\nl2_run: 20261116T1700_v144\n---\n"
        "# t\n\n書き手、ミナト、トト\n\n\n---\n\n## 名前正規化監査（L2 run 20261116T1700_v144）\n\n"
        "| 元名義 | 代表名 | 確度 | 置換件数 |\n|---|---|---|---|\n| ノエル | 書き手 | 明言 | 1 |\n"
        "| 書き手 | ミナト | 明言 | 1 |\n\n\n注記（置換しない）:\n- 未置換（要検証）: 「トト」→ トト(仮)（要検証）"
    )
    assert made["index"]["text"] == "何もない"
    again = build_l2(source, book, "20261116T1700_v144")
    assert rows(lg.parse_audit(again).select("page_id", "run", "seq", "name", "replaced")) == [
        ("MY_1", "20261116T1700_v144", 1, "ノエル", 1), ("MY_1", "20261116T1700_v144", 2, "書き手", 1),
    ]
    assert rows(lg.parse_notes(again)) == [("MY_1", 1, "トト", "トト(仮)")]


def test_header_is_kept_without_rows(spark):
    book = ledger(spark, ("灯守", "ヴィオラ", UNVERIFIED))
    done = lg.normalize_names(pages(spark, "灯守"), book)
    text = done.select(lg.render_audit(F.col("audit"), F.col("notes"), F.lit("r")).alias("t")).first()["t"]
    assert "|---|---|---|---|\n\n\n注記" in text


def test_audit_sum_equals_tokens_changed(spark):
    book = ledger(spark, ("the", "then", EXPLICIT), ("then", "there", EXPLICIT))
    done = lg.substitute(pages(spark, "the then the", "none"), book)
    assert rows(lg.audit_totals(lg.audit_rows(done))) == [("the", "then", EXPLICIT, 2, 1), ("then", "there", EXPLICIT, 1, 1)]


def test_chains_and_groups(spark):
    book = ledger(
        spark, ("a", "b", EXPLICIT), ("b", "c", EXPLICIT), ("x", "c", EXPLICIT), ("same", "same", EXPLICIT)
    )
    assert rows(lg.ledger_chains(book)) == [("a", "b", "c")]
    assert rows(lg.alias_groups(book).select("representative", "name", "names")) == [
        ("b", "a", 1), ("c", "b", 2), ("c", "x", 2), ("same", "same", 1),
    ]


def test_canonicalize(spark):
    book = ledger(spark, ("a", "b", EXPLICIT), ("u", "v", UNVERIFIED))
    seen = spark.createDataFrame([("char", "a"), ("item", "u")], "kind string, name string")
    got = lg.canonicalize(seen, book).select("name", "representative", "confidence", "canonical_id")
    assert rows(got) == [("a", "b", EXPLICIT, "E_char_b"), ("u", "u", None, "E_item_u")]

def test_passes_of_a_ledger_give_the_same(spark, monkeypatch):
    rng = random.Random(13)
    names = {"".join(rng.choices("abé語🙂", k=rng.randint(1, 16))): rng.choice([EXPLICIT, UNVERIFIED]) for _ in range(120)}
    book = ledger(spark, *[(n, f"<{n}>", c) for n, c in names.items()])
    source = pages(spark, *["".join(rng.choices([*"abé語🙂d[|](", *names], k=60)) for _ in range(25)], "", None)
    found = []
    for shards, piece in ((64, 8_000_000), (64, 300), (2, 300)):
        monkeypatch.setattr(name_search, "SHARD_NAMES", 20)
        monkeypatch.setattr(name_search, "PASS_SHARDS", shards)
        monkeypatch.setattr(name_search, "PIECE_CHARS", piece)
        found.append(rows(lg.normalize_names(source, book, inline_names=0).selectExpr("page_id", "body", "string(audit)", "string(notes)")))
    assert found[0] == rows(lg.normalize_names(source, book).selectExpr("page_id", "body", "string(audit)", "string(notes)"))
    assert found[1] == found[0] and found[2] == found[0]


def test_shards_of_a_ledger_are_searched_without_a_kept_table_of_hits(spark, monkeypatch):
    """Hits of every place in every text once filled the disk."""
    monkeypatch.setattr(name_search, "SHARD_NAMES", 2)
    book = ledger(spark, *[(n, f"<{n}>", UNVERIFIED if n < "c" else EXPLICIT) for n in "abcdefgh"])
    done = lg.normalize_names(pages(spark, "a b c d", "h g f"), book, inline_names=0)
    assert "Exchange" not in done._jdf.queryExecution().executedPlan().toString()
    assert rows(done.select("body")) == [("<h> <g> <f>",), ("a b <c> <d>",)]


def test_work_on_a_piece_does_not_build_automata(spark, monkeypatch):
    """Automata of the names of each piece, from the whole ledger, once took more time the larger the ledger."""
    monkeypatch.setattr(name_search, "SHARD_NAMES", 50)
    monkeypatch.setattr(name_search, "PIECE_CHARS", 40)
    monkeypatch.setattr(name_search, "_automaton", None)
    rng = random.Random(4)
    words = sorted({"".join(rng.choices("abc", k=rng.randint(1, 9))) for _ in range(300)})
    book = ledger(spark, *[(f" {w}", f" <{w}>", UNVERIFIED if len(w) % 4 == 0 else EXPLICIT) for w in words])
    source = pages(spark, *["".join(f" {w}" for w in rng.choices([*words, "[[", "d"], k=12)) for _ in range(20)], None)
    shown = ("page_id", "body", "string(audit)", "string(notes)")
    found = rows(lg.normalize_names(source, book, inline_names=0).selectExpr(*shown))
    assert found == rows(lg.normalize_names(source, book).selectExpr(*shown))


def test_names_of_one_hash_are_told_apart(spark):
    names = spark.createDataFrame([(f"n{k}", f"<{k}>", EXPLICIT) for k in range(300)], "name string, representative string, confidence string")
    # Of 14 bits some two names have the same; another seed gives hashes that differ in all.
    seed, _, _, _, hashes, places, *_ = name_search._indexed(names, 3, bits=14)
    assert seed > 0 and len(set((hashes >> 50).tolist())) == 300 and sorted(places.tolist()) == list(range(300))


def test_a_ledger_is_worked_out_once_and_a_cached_one_stays(spark):
    book = ledger(spark, *[(f"n{k}", f"<{k}>", EXPLICIT) for k in range(30)]).cache()
    assert lg.normalize_names(pages(spark, "n1 n2"), book, inline_names=5).first()["body"] == "<1> <2>"
    assert book.storageLevel.useMemory
    book.unpersist()
