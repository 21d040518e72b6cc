import hashlib

import pytest
from conftest import rows

from layerloom import schemas
from layerloom.sources import readers, sinks
from layerloom.streaming.intake import ingest_stream


def put(root, name, text):
    path = root / name
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text, encoding="utf-8")


@pytest.fixture
def wiki(tmp_path):
    put(tmp_path, "l1/claims/A_ノエル+1 x.md", "---\nid: A\n---\n一\n二\n")
    put(tmp_path, "l1/entities/terminology/E_term.md", "e")
    put(tmp_path, "l1/index.md", "top")
    put(tmp_path, "l2/claims/A.md", "l2")
    put(tmp_path, "l1/claims/notes.txt", "no page")
    return tmp_path


def test_page_scan(spark, wiki):
    got = rows(readers.read_pages(spark, str(wiki)).select("layer", "section", "page_id", "path"))
    assert got == [
        ("l1", "", "index", "l1/index.md"),
        ("l1", "claims", "A_ノエル+1 x", "l1/claims/A_ノエル+1 x.md"),
        ("l1", "entities", "E_term", "l1/entities/terminology/E_term.md"),
        ("l2", "claims", "A", "l2/claims/A.md"),
    ]
    whole = readers.read_pages(spark, str(wiki), ["l1"], ["claims"])
    assert rows(whole.select("text")) == [("---\nid: A\n---\n一\n二\n",)]
    assert readers.read_pages(spark, str(wiki), sections=["claims"]).count() == 2


def test_fact_logs(spark, tmp_path):
    put(tmp_path, "ch0001.jsonl", '{"event_id": 1, "k": 5}\n{"event_id": 2}\n')
    put(tmp_path, "ch0002.jsonl", '{"event_id": 3, "value": 1.5}\n')
    got = readers.read_fact_log(spark, str(tmp_path)).select("chapter", "event_id", "k", "value")
    assert rows(got) == [("ch0001", 1, 5, None), ("ch0001", 2, None, None), ("ch0002", 3, None, 1.5)]


def test_chapter_list_skips_blanks(spark):
    df = spark.createDataFrame([("3, 14,,\n 15 ,",)], "value string")
    assert rows(readers.read_chapter_list(df).select("pos", "chapter")) == [(1, 3), (2, 14), (4, 15)]


def test_manifest_and_change_detection(spark):
    def manifest(*texts):
        return readers.source_manifest(
            spark.createDataFrame([(f"ch{i}", t) for i, t in enumerate(texts)], "chapter string, text string")
        )

    first = manifest("a").first()
    assert first["id"] == "SRC_ch0" and first["local_path"] == "raw/ch0.txt"
    assert first["checksum"] == "sha256:" + hashlib.sha256(b"a").hexdigest()
    assert rows(readers.changed_sources(manifest("a", "B", "c"), manifest("a", "b")).select("id")) == [
        ("SRC_ch1",), ("SRC_ch2",),
    ]


def test_arcs(spark, tmp_path):
    put(tmp_path, "arcs.json", '{"id": "ARC_01", "name": "n", "chapters": {"start": "ch0001", "end": "ch0050"}}\n')
    assert rows(readers.read_arcs(spark, str(tmp_path / "arcs.json")).select("arc_id", "ch_start", "ch_end")) == [
        ("ARC_01", 1, 50)
    ]


def test_changed_only_sink_prunes_by_layer(spark, wiki, tmp_path):
    old = readers.read_pages(spark, str(wiki))
    new = old.selectExpr("path", "layer", "section", "CASE WHEN layer = 'l2' THEN 'new' ELSE text END AS text")
    target = str(tmp_path / "out" / "v2")
    sinks.write_changed(old, new, target)
    written = spark.read.parquet(target)
    assert rows(written.select("layer", "section", "path", "text")) == [("l2", "claims", "l2/claims/A.md", "new")]
    plan = written.filter("layer = 'l1'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(layer" in plan
    with pytest.raises(Exception, match="already exists"):
        sinks.write_changed(old, new, target)


def test_run_log_appends(spark, tmp_path):
    units = spark.createDataFrame([("ch1", 0, "ok"), ("ch2", 1, "bad")], "unit string, rc int, message string")
    for run in ("r1", "r2"):
        sinks.append_run_log(sinks.run_log(units, run, "unit", "rc", "message"), str(tmp_path / "log"))
    log = spark.read.parquet(str(tmp_path / "log"))
    assert rows(log.filter("run = 'r1'").select("unit", "rc", "message")) == [
        ("ch1", 0, "ok"), ("ch2", 1, "bad"), ("done", 0, ""), ("start", 0, "todo=2"),
    ]
    assert log.count() == 8 and schemas.RUN_LOG.startswith("run string")


def test_intake_takes_each_page_once_in_two_waves(spark, tmp_path):
    source, target, check = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "check")
    for i in range(23):
        put(source, f"l1/claims/A_{i:02}.md", f"---\nid: A_{i}\n---\nbody {i}\n")
    first = ingest_stream(spark, str(source), target, check)
    first.awaitTermination()
    assert [p["numInputRows"] for p in first.recentProgress if p["numInputRows"]] == [10, 10, 3]
    for i in range(23, 28):
        put(source, f"l1/claims/A_{i:02}.md", "plain")
    ingest_stream(spark, str(source), target, check).awaitTermination()
    ingest_stream(spark, str(source), target, check).awaitTermination()
    pages = spark.read.parquet(target)
    assert pages.count() == 28 and pages.select("page_id").distinct().count() == 28
    assert rows(pages.filter("page_id = 'A_03'").select("layer", "front_matter", "body")) == [
        ("l1", "id: A_3", "body 3\n")
    ]
