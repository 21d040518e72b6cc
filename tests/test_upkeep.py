"""Deltas, manifest trees, ledger closures and line hunks against recounts and brute force."""

import random

import pyarrow as pa
import pytest
from conftest import rows
from pyspark.sql import functions as F

from layerloom.fixed_values import EXPLICIT
from layerloom.functions import tasks
from layerloom.operators import closure, delta, hunks, lineage, manifest, rollup

CLAIMS = "page string, chapter string, object_id string, claim_id string, statement string"


def test_deltas_equal_a_recount_over_many_versions(spark):
    r = random.Random(4)
    chapters = spark.createDataFrame([(f"c{n}",) for n in range(6)], "chapter string")
    mysteries = spark.createDataFrame([("c1",), ("c1",)], "chapter string")
    made = lambda n: (f"p{n}", f"c{r.randrange(6)}", r.choice(["ME_a", "ME_b", None]), f"A{r.randrange(9)}", r.choice(["s", "t", None]))
    now = {n: made(n) for n in range(30)}
    frame = lambda: spark.createDataFrame(list(now.values()), CLAIMS)
    old = frame()
    counts, uses, links = delta.entry_counts(old, "claims"), delta.reference_uses(old), delta.backlink_uses(old)
    for step in range(3):
        for n in r.sample(sorted(now), 8):
            now.pop(n)
        for n in r.sample(sorted(now), 8):
            now[n] = made(n)
        now |= {n: made(n) for n in range(100 * (step + 1), 100 * (step + 1) + 5)}
        new = frame()
        changes = delta.signed_changes(old, new, "page", ["chapter", "object_id", "claim_id", "statement"])
        counts = delta.fold(counts, delta.entry_counts(changes, "claims"), ["chapter"], ["claims"])
        uses = delta.fold(uses, delta.reference_uses(changes), ["chapter", "ref_id"], ["uses"])
        links = delta.fold(links, delta.backlink_uses(changes), ["ref_id", "claim_id", "statement"], ["uses"])
        old = new
    again = delta.chapter_counts(chapters, counts, delta.entry_counts(mysteries, "mysteries"), uses)
    assert rows(again) == rows(rollup.chapter_counts(chapters, old, mysteries))
    assert rows(delta.backlink_counts(links)) == rows(rollup.backlink_counts(old))
    assert rows(links) == rows(delta.backlink_uses(old))


def test_only_changed_pages_give_signed_rows(spark):
    old = spark.createDataFrame([("a", "c1", "x"), ("b", "c1", None), ("c", "c2", "y")], "page string, chapter string, object_id string")
    new = spark.createDataFrame([("a", "c1", "x"), ("b", "c2", None), ("d", "c2", "y")], "page string, chapter string, object_id string")
    got = delta.signed_changes(old, new, "page", ["chapter", "object_id"])
    assert rows(got) == [("b", "c1", None, -1), ("b", "c2", None, 1), ("c", "c2", "y", -1), ("d", "c2", "y", 1)]
    assert delta.signed_changes(old, old, "page", ["chapter", "object_id"]).count() == 0


PAGES = "layer string, section string, path string, text string"


def test_manifest_diff_opens_unequal_sections_only(spark):
    old = [("l1", s, f"l1/{s}/{n}", f"t{n}") for s in "abc" for n in range(4)] + [("l2", "a", "l2/a/0", None), (None, None, "x", "t")]
    new = [p for p in old if p[2] != "l1/b/1"] + [("l1", "c", "l1/c/9", "t9"), ("l3", "a", "l3/a/0", "t")]
    new = [(*p[:3], "changed") if p[2] == "l1/c/2" else p for p in new]
    before, after = (manifest.leaves(spark.createDataFrame(p, PAGES)) for p in (old, new))
    trees = manifest.tree(before), manifest.tree(after)
    assert rows(manifest.unequal_sections(*trees)) == [("l1", "b"), ("l1", "c"), ("l3", "a")]
    found = manifest.manifest_diff(before, after, *trees)
    assert rows(found.select("path", "change")) == [
        ("l1/b/1", "removed"), ("l1/c/2", "changed"), ("l1/c/9", "added"), ("l3/a/0", "added"),
    ]
    # Equal corpora end at the root, however their rows are ordered.
    same = manifest.leaves(spark.createDataFrame(old[::-1], PAGES).repartition(3))
    assert manifest.manifest_diff(before, same).count() == 0
    counts = {r["level"]: r["pages"] for r in trees[0].groupBy("level").agg(F.sum("pages").alias("pages")).collect()}
    assert counts == dict.fromkeys(manifest.LEVELS, 14)
    empty = before.filter("false")
    assert manifest.manifest_diff(empty, before).filter("change = 'added'").count() == 14
    assert manifest.manifest_diff(empty, empty).count() == 0


def walked(ledger):
    out = []
    for name in ledger:
        seen, at = [], name
        while at in ledger and ledger[at] != at and at not in seen:
            seen.append(at)
            at = ledger[at]
        loop = at in seen
        out.append((name, min(seen[seen.index(at) :]) if loop else at, None if loop else len(seen), loop))
    return sorted(out, key=repr)


@pytest.mark.parametrize("seed", [1, 2])
def test_closure_equals_a_walk(spark, seed):
    r = random.Random(seed)
    ledger = {f"n{k}": f"n{r.randrange(90)}" for k in range(60)}
    ledger |= {f"m{k}": f"m{k + 1}" for k in range(37)} | {"s": "s", "t": "s"}
    # Many names lead to one.
    ledger |= {f"p{k}": "m0" for k in range(20)}
    book = spark.createDataFrame([(a, b, EXPLICIT) for a, b in ledger.items()], "name string, representative string, confidence string")
    assert rows(closure.ledger_closure(book)) == walked(ledger)
    assert closure.ledger_closure(book.filter("false")).count() == 0
    twice = book.unionByName(spark.createDataFrame([("s", "zz", EXPLICIT), ("q", None, EXPLICIT)], book.schema))
    assert rows(closure.ledger_closure(twice)) == walked(ledger)


def test_longest_increasing_subsequence():
    r = random.Random(5)
    for _ in range(60):
        places = r.sample(range(30), r.randint(0, 9))
        got = [places[n] for n in hunks.longest_increasing(places)]
        best = max((sum(1 for b in range(len(places)) if mask >> b & 1) for mask in range(1 << len(places)) if sorted(s := [p for b, p in enumerate(places) if mask >> b & 1]) == s), default=0)
        assert got == sorted(got) and len(got) == best


def test_hunks_rebuild_the_new_text(spark):
    r = random.Random(6)
    pairs = [("a\nb\nc", "a\nc"), ("", "x"), ("x", ""), (None, "n\nm"), ("m", None), ("same", "same"), ("a\na\na", "a\na"), ("\n\n", "\n")]
    for _ in range(60):
        old = [r.choice("abcdefgh") for _ in range(r.randint(0, 14))]
        new = [r.choice("abcdefgh") if r.random() < 0.3 else line for line in old if r.random() < 0.8] + r.choices("xyz", k=r.randint(0, 2))
        pairs.append(("\n".join(old), "\n".join(new)))
    # A moved block: the longer run of anchors stays, the shorter one moves.
    pairs.append(("1\n2\n3\n4\n5\n6", "4\n5\n6\n1\n2\n3\n7"))
    log = spark.createDataFrame([(f"p{n}", "R", a, b) for n, (a, b) in enumerate(pairs)], "path string, rule string, before string, after string")
    found = hunks.change_hunks(log)
    made = hunks.patched(log.select("path", F.col("before").alias("text")), found)
    assert {x["path"]: x["text"] for x in made.collect()} == {f"p{n}": b or "" for n, (_, b) in enumerate(pairs)}
    by_page = {x["path"]: x["hunks"] for x in found.collect()}
    assert all((not by_page[f"p{n}"]) == ((a or "") == (b or "")) for n, (a, b) in enumerate(pairs))
    assert [tuple(h)[:4] for h in by_page["p0"]] == [(1, 1, 1, 0)]
    first = hunks.hunk_rows(found).filter("path = 'p0'").first()
    assert (first["hunk"], first["removed"], first["added"]) == (1, "b", "")


def test_texts_become_python_objects_in_parts(spark):
    """Hunks of ten thousand pages at once were held by a task."""
    texts = ["a" * 400, None, "b" * 700, "", "c" * 5_000, *["d"] * 300]
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array(texts)], names=["n", "text"])
    parts = list(tasks.text_parts(batch, ["text"], 1_000))
    assert [x for p in parts for x in p.column("text").to_pylist()] == texts
    assert len(parts) >= 8 and max(p.num_rows for p in parts) <= tasks.PART_ROWS
    assert list(tasks.text_parts(batch.slice(0, 0), ["text"])) == []
    log = spark.createDataFrame([("p", "a\nb", "a\nc"), ("q", None, "x"), ("r", "y", None)], "path string, before string, after string")
    found = hunks.change_hunks(log)
    made = hunks.patched(log.select("path", F.col("before").alias("text")).unionByName(spark.createDataFrame([("s", None)], "path string, text string")), found)
    assert rows(made) == [("p", "a\nc"), ("q", "x"), ("r", ""), ("s", None)]
    assert "ArrowEvalPython" not in made._jdf.queryExecution().executedPlan().toString()


def test_hunks_leave_unchanged_lines_alone():
    old = [f"line {n}" for n in range(200)]
    new = [*old[:50], "new", *old[50:120], *old[121:]]
    assert hunks.line_hunks(old, new) == [(50, 0, 50, 1), (120, 1, 121, 0)]


def test_pages_without_hunks_stay(spark):
    pages = spark.createDataFrame([("a", "x"), ("b", None)], "path string, text string")
    log = lineage.change_log(pages, pages.filter("path = 'a'").withColumn("text", F.lit("y\nz")), "R").filter("change = 'changed'")
    assert rows(hunks.patched(pages, hunks.change_hunks(log))) == [("a", "y\nz"), ("b", None)]
