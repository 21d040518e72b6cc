from conftest import rows
from pyspark.sql import functions as F

from layerloom.functions import front_matter as fm
from layerloom.functions import rewrite as rw
from layerloom.functions import text as tx


def one(spark, value, expression):
    return spark.createDataFrame([(value,)], "v string").select(expression(F.col("v")).alias("x")).first()["x"]


def ranges(spark, line):
    return [(r["p_start"], r["p_end"]) for r in one(spark, line, tx.locators)]


def test_locator_forms(spark):
    assert ranges(spark, "あ（p36）") == [(36, 36)]
    assert ranges(spark, "あ（p118-p119）") == [(118, 119)]
    assert ranges(spark, "あ（p200-201）") == [(200, 201)]
    assert ranges(spark, "あ（p172, p173）") == [(172, 172), (173, 173)]
    assert ranges(spark, "あ（p1-p2, p9）") == [(1, 2), (9, 9)]
    assert ranges(spark, "あ") == []
    assert ranges(spark, "（p1）と言った（笑）") == []
    assert ranges(spark, "（強制（リフューズ）まで）（p103）") == [(103, 103)]


def test_quote_loses_only_its_locator(spark):
    quotes = one(spark, "（強制（リフューズ）まで）（p103）", lambda v: tx.quotes(F.array(v)))
    assert quotes[0]["text"] == "（強制（リフューズ）まで）"
    kept = one(spark, "笑った（笑）", lambda v: tx.quotes(F.array(v)))
    assert kept[0]["text"] == "笑った（笑）"


def test_chapter_codes(spark):
    for code, edition, number in [("ch0124", 1, 124), ("ch5004", 2, 4), ("ch12345", 2, 7345)]:
        assert one(spark, code, tx.edition) == edition
        assert one(spark, code, tx.chapter_no) == number
        assert one(spark, code, lambda v: tx.chapter_code(tx.edition(v), tx.chapter_no(v))) == code
    assert one(spark, "x", tx.edition) is None


def test_observation_with_underscores_in_verb_and_names(spark):
    parts = one(spark, "E_ch5522_祝祭二日目_is_located_ガロアンディアン_p2", tx.observation_parts)
    assert tuple(parts) == ("ch5522", "祝祭二日目", "is_located", "ガロアンディアン", 2)
    parts = one(spark, "E_ch5004_マフス・アズ_アリ_appears_as_青い_石_p10", tx.observation_parts)
    assert tuple(parts) == ("ch5004", "マフス・アズ_アリ", "appears_as", "青い_石", 10)


def test_claim_id_parts(spark):
    parts = one(spark, "A_ch5004_alludes_to_E_ch5004_p36_mythical_weapons", tx.claim_id_parts)
    assert tuple(parts) == ("ch5004", "alludes_to", "ch5004", "p36", "mythical_weapons")
    parts = one(spark, "A_ch5011_inverts_E_p15-p20_name_theft", tx.claim_id_parts)
    assert tuple(parts) == ("ch5011", "inverts", None, "p15-p20", "name_theft")
    parts = one(spark, "A_ch5045_foreshadows_E_State_Mind_Control", tx.claim_id_parts)
    assert tuple(parts) == ("ch5045", "foreshadows", None, None, "State_Mind_Control")


def test_labels_and_ranks(spark):
    assert one(spark, "sublates", tx.predicate_label) == "止揚"
    assert one(spark, "other", tx.predicate_label) is None
    assert one(spark, "strong", tx.evidence_rank) == 3
    assert one(spark, "odd", tx.evidence_rank) is None


def test_run_parts(spark):
    parts = one(spark, "20261116T1700_v144", tx.run_parts)
    assert str(parts["run_ts"]) == "2026-11-16 17:00:00" and parts["version"] == 144


def test_log_tail_short_and_long(spark):
    assert one(spark, "\na\r\nb\nc\nd\ne\n\n", tx.log_tail) == "b / c / d / e"
    assert one(spark, " only ", tx.log_tail) == "only"
    assert one(spark, "x" * 400, tx.error_tail) == "x" * 300


FRONT = """schema_version: '5.1'
id: O_1
title: "a \\"b\\""
odd: "open
aliases: []
characters:
- '[[E_char_人狼]]'
- "[[E_char_b|c]]"
- [[E_char_d#e]]
- plain#text
relationships:
arc: '[[ARC_01]]'
timeline:
  introduced: ch0006
provenance:
  proposed_by: {kind: agent, id: a-1}
  reviewed_by: {kind: agent, id: b, date: "2026-10-21"}"""


def test_front_matter_scalars(spark):
    def value(key):
        return one(spark, FRONT, lambda v: fm.scalar(fm.entries(v), key))

    assert value("schema_version") == "5.1"
    assert value("title") == 'a \\"b\\"'
    assert value("odd") == '"open'
    assert value("relationships") is None and value("missing") is None
    assert value("arc") == "[[ARC_01]]"


def test_front_matter_lists(spark):
    def listed(key):
        return one(spark, FRONT, lambda v: fm.block_list(v, key))

    assert listed("characters") == ["E_char_人狼", "E_char_b", "E_char_d", "plain#text"]
    assert listed("relationships") == [] and listed("aliases") == [] and listed("motifs") == []


def test_front_matter_nested(spark):
    assert one(spark, FRONT, lambda v: fm.nested(v, "introduced")) == "ch0006"
    got = one(spark, FRONT, lambda v: fm.provenance(fm.inline_map(v, "reviewed_by")))
    assert (got["kind"], got["id"], str(got["date"])) == ("agent", "b", "2026-10-21")
    got = one(spark, FRONT, lambda v: fm.provenance(fm.inline_map(v, "proposed_by")))
    assert (got["kind"], got["id"], got["date"]) == ("agent", "a-1", None)


def test_section_links_keep_their_bracket_and_are_idempotent(spark):
    text = "[n](nav/index.md) [up](../nav/index.md) [x](other/index.md) [d](../../../nav/index.md)"
    once = one(spark, text, rw.section_links)
    assert once == text.replace("](nav/", "](../../../nav/")
    assert one(spark, once, rw.section_links) == once
    assert one(spark, text, rw.bare_section_links) == 1 and one(spark, once, rw.bare_section_links) == 0


def test_unwiki_keeps_anchored_links(spark):
    front = 'id: x\nsubject: "[[A|b]] [[C#d]]"\nobject: plain\nother: "[[E]]"'
    assert one(spark, front, rw.unwiki_fields) == 'id: x\nsubject: `A` `C`\nobject: plain\nother: "[[E]]"'
    again = one(spark, one(spark, front, rw.unwiki_fields), rw.unwiki_fields)
    assert again == one(spark, front, rw.unwiki_fields)


def test_pieces_join_back(spark):
    text = "a[[b|c]]\nd [[e]]" * 50 + "x" * 50_000
    df = spark.createDataFrame([(text,)], "v string")
    joined = df.select(F.array_join(rw.pieces(F.col("v"), rw.WIKILINK), "").alias("x"))
    assert rows(joined) == [(text,)]
