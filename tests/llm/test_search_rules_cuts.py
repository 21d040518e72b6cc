"""URL rules, ranked search and fill-in-the-middle against brute force, and on awkward tables."""

import hashlib
import math
import os
import random
import re
from collections import Counter

import duckdb
import numpy as np
import pytest
from test_oracles import plain

from layerloom.llm import fill_middle, queries, treap_search, url_rules

TERM = re.compile(treap_search.TERM)


@pytest.mark.parametrize("name", ["op11_url_verdicts", "op12_treap_search", "op13_fill_in_middle"])
def test_query_equals_its_sql(spark, sf_dir, name):
    con = duckdb.connect()
    for table in ("documents", "pages", "benchmark"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{os.path.join(sf_dir, table)}.parquet'")
    mine, theirs = queries.QUERIES[name](spark, sf_dir).toPandas(), con.execute(queries.ORACLES[name]).fetchdf()
    assert sorted(mine.columns) == sorted(theirs.columns)
    assert plain(mine) == plain(theirs)


# --- URL rules ---------------------------------------------------------------------------------

SCHEMA = "page_id bigint, url string, host int, path string, key string, rule string, _page int"


def plain_verdicts(urls, rules, otherwise="allow"):
    out = []
    for page_id, url in urls:
        rest = url.split("://", 1)[1] if url is not None and "://" in url else ""
        host = re.match(r"[^/?#]*", rest)[0]
        path = re.match(r"[^?#]*", rest[len(host) :])[0]
        host = host.translate({c: c + 32 for c in range(65, 91)})
        fits = [r for r in rules if (host == r[0] or host.endswith("." + r[0])) and path.startswith(r[1])]
        best = max(fits, key=lambda r: (len(r[0] + r[1]), len(r[0]), r[0] + r[1]), default=None)
        out.append((page_id, host, path, best and best[0] + best[1], best[2] if best else otherwise))
    return sorted(out, key=repr)


@pytest.mark.parametrize("ranges", [1, 40])
def test_url_rules_equal_brute_force(spark, monkeypatch, ranges):
    r = random.Random(ranges)
    labels, steps = ["a", "b", "net", "org", "x-y", "é"], ["/", "/en", "/en/", "/en/a", "/é/", "/en/a/b/c", "/~"]
    host = lambda: ".".join(r.choice(labels) for _ in range(r.randint(1, 4)))
    rules = {(host(), r.choice([*steps, ""])): r.choice(["allow", "block"]) for _ in range(60)}
    rules = [(h, p, v) for (h, p), v in rules.items()]
    urls = [(k, f"{r.choice(['http', 'ftp'])}://{host().upper() if k % 3 else host()}{r.choice(steps)}{r.choice(['', 'q', '?a=://b', '#/en/'])}") for k in range(600)]
    urls += [(9_000 + k, "https://www.hot.net/en/a") for k in range(300)]
    monkeypatch.setattr(url_rules, "RANGE_BYTES", 10**9 if ranges == 1 else 600)
    pages = spark.createDataFrame(urls, "page_id bigint, url string")
    found = url_rules.judge(pages, url_rules.rule_table(spark, rules))
    assert sorted(map(tuple, found.collect()), key=repr) == plain_verdicts(urls, rules)


def test_url_rules_on_awkward_rows(spark):
    urls = [(1, None), (1, "no scheme"), (None, "http://NET/"), (2, "http://net"), (2, "http://net"), (3, "x://"), (4, "a://b..net/" + "z" * 300_000), (5, "http://user@net:80/")]
    pages = spark.createDataFrame([(*u, 1, "p", "k", "r", 2) for u in urls], SCHEMA)
    rules = [("NET", "/", "block"), ("net", "/", "block"), ("net", "no", "block"), ("", "", "block"), (None, "/", "block"), ("b..net", None, "block")]
    table = url_rules.rule_table(spark, rules)
    whole = [("net", "/", "block"), ("", "", "block")]
    assert sorted(map(tuple, url_rules.judge(pages, table).collect()), key=repr) == plain_verdicts(urls, whole)
    kept = url_rules.allowed(pages, table)
    assert kept.columns == pages.columns
    assert Counter(x.url for x in kept.collect()) == Counter(u for (_, u), v in zip(urls, [0, 0, 0, 1, 1, 0, 0, 1]) if v)
    assert url_rules.judge(pages.filter("false"), table).count() == 0
    assert {x.verdict for x in url_rules.judge(pages, table.filter("false"), "block").collect()} == {"block"}


# --- ranked search -----------------------------------------------------------------------------


def plain_search(docs, items, k=10):
    lists = [(d, [w.translate({c: c + 32 for c in range(65, 91)}) for w in TERM.findall(t or "")]) for d, t in docs]
    lists = [(d, w) for d, w in lists if w]
    n_docs, n_terms = len(lists), sum(len(w) for _, w in lists)
    counts = [Counter(w) for _, w in lists]
    df = Counter(w for c in counts for w in c)
    out = []
    for item, text in items:
        asked = {w.translate({c: c + 32 for c in range(65, 91)}) for w in TERM.findall(text or "")}
        scores = []
        for (doc, words), c in zip(lists, counts):
            m = 10 + (90 * len(words) * n_docs) // n_terms
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[w] + 1))) * ((10**9 * c[w]) // (1000 * c[w] + 8 * m)) for w in asked if w in c)
            scores.append((-score, doc is None, doc or 0))
        top = sorted(s for s in scores if s[0] < 0)[:k]
        out += [(item, at, None if none else doc, -score) for at, (score, none, doc) in enumerate(top, 1)]
    return sorted(out, key=repr)


def corpus(seed, n=400):
    r = random.Random(seed)
    words = [f"w{k}" for k in range(60)] + ["Ärger", "ÄRGER", "naïve", "東京", "x" * 40]
    docs = [(k, r.choice([" ", ", ", "\n"]).join(r.choices(words, weights=range(len(words), 0, -1), k=r.randint(0, 40)))) for k in range(n)]
    # A third are copies, which tie.
    docs += [(n + k, docs[7][1].upper()) for k in range(n // 2)]
    items = [(k, " ".join(r.choices(words, k=r.randint(1, 12)))) for k in range(12)] + [(50, docs[7][1])]
    r.shuffle(docs)
    return docs, items


@pytest.mark.parametrize("block", [16, 1 << 16])
def test_search_equals_brute_force(spark, monkeypatch, block):
    docs, items = corpus(block)
    monkeypatch.setattr(treap_search.grids, "__defaults__", (block,))
    found = treap_search.search(spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame(items, "item_id bigint, text string"), item_bytes=10**6 if block > 16 else 150)
    assert sorted(map(tuple, found.collect()), key=repr) == plain_search(docs, items)


def test_search_on_awkward_rows(spark):
    long = " ".join(f"w{k % 977}" for k in range(90_000))
    docs = [(None, "Alpha beta"), (1, "alpha beta"), (1, "alpha beta"), (2, None), (3, ""), (4, " .,\n"), (5, long), (None, "ALPHA BETA"), (6, "y" * 400_000)]
    items = [(1, "alpha"), (1, "alpha"), (1, "beta!"), (2, None), (3, ""), (None, "w5 w6"), (7, "y" * 400_000), (8, "nowhere")]
    table = spark.createDataFrame([(*d, 1, [2], 3) for d in docs], "doc_id bigint, text string, n int, rows array<int>, score int")
    asked = spark.createDataFrame([(*i, 4) for i in items], "item_id bigint, text string, rank int")
    found = treap_search.search(table, asked)
    assert sorted(map(tuple, found.collect()), key=repr) == plain_search(docs, [items[0], *items[2:]])
    assert treap_search.search(table.filter("false"), asked).count() == 0
    assert treap_search.search(table, asked.filter("false")).count() == 0


def test_search_passes_over_ranges_below_the_bound():
    r = np.random.default_rng(5)
    n, terms = 4_096, 30
    rows, columns = np.nonzero(r.random((terms, n)) < 0.02)
    impact = r.integers(1, 100_000, len(rows))
    # Ten documents hold every term.
    best = np.arange(100, 110)
    rows = np.concatenate([rows, np.repeat(np.arange(terms), 10)])
    columns, impact = np.concatenate([columns, np.tile(best, terms)]), np.concatenate([impact, np.full(terms * 10, 200_000)])
    cell, first = np.unique(rows * n + columns, return_index=True)
    masks, maxima = treap_search.treap(rows[first], columns[first], impact[first], 12)
    grid = treap_search.Grid(np.arange(n).tobytes(), np.zeros(n, bool).tobytes(), 12, [m.tobytes() for m in masks], [m.tobytes() for m in maxima])
    for limit in (treap_search.HELD_CELLS, 100):
        treap_search.HELD_CELLS, old = limit, treap_search.HELD_CELLS
        top = treap_search.Best(10)
        halved = grid.search(np.arange(terms), np.full(terms, 3), top, beam=8)
        treap_search.HELD_CELLS = old
        scores = np.zeros(n, np.int64)
        np.add.at(scores, columns[first], 3 * impact[first])
        order = np.lexsort((np.arange(n), -scores))[:10]
        assert top.doc.tolist() == order.tolist() and top.score.tolist() == scores[order].tolist()
        assert halved < n / 2


# --- fill in the middle ------------------------------------------------------------------------


def plain_cut(doc_id, text, seed=7, rate=100, spm=50):
    text = text or ""
    units = re.findall(r"[^\n]*\n|[^\n]+", text)
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * k : 8 * k + 8], 16) for k in range(4)]
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= rate:
        return len(units), "plain", None, None, text
    a, b = sorted((h[0] % (len(units) + 1), h[1] % (len(units) + 1)))
    p, m, s = ("".join(x) for x in (units[:a], units[a:b], units[b:]))
    if h[3] % 100 < spm:
        return len(units), "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return len(units), "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


@pytest.mark.parametrize("block", [1, 3, 16, 1 << 10])
def test_cuts_equal_brute_force(monkeypatch, block):
    monkeypatch.setattr(fill_middle, "BLOCK", block)
    r = random.Random(block)
    for doc_id in range(400):
        text = "".join(r.choices(["a", "é", "東", "🙂", "\n", "<", "P>", "S>"], weights=[9, 3, 3, 2, 4, 1, 1, 1], k=r.randint(0, 90)))
        n, form, prefix, middle, out = fill_middle.transform(doc_id, np.frombuffer(text.encode(), np.uint8), fill_middle.Settings())
        assert (n, form, prefix, middle, out.decode()) == plain_cut(doc_id, text)


def test_fenwick_descends_to_the_block():
    r = random.Random(1)
    for n in range(0, 70):
        counts = np.array([r.choice([0, 0, 1, 4]) for _ in range(n)], np.int64)
        tree, sums = fill_middle.Fenwick(counts), np.concatenate([[0], np.cumsum(counts)])
        assert [tree.before(i) for i in range(n + 1)] == sums.tolist()
        for wanted in range(1, int(sums[-1]) + 1):
            block = int(np.searchsorted(sums, wanted)) - 1
            assert tree.reach(wanted) == (block, sums[block])


def test_cuts_and_round_trip_on_awkward_rows(spark):
    from pyspark.sql import functions as F

    texts = [None, "", "\n", "\n\n", "no end", "one\ntwo\nthree", "holds <M> a mark\n", "é\n" * 50_000, "<" * 9 + "\nP>\n" * 7, "a\r\nb\u2028c\n"]
    rows = [(k % 7 if k % 5 else None, t, "o", "f", 3) for k, t in enumerate(texts * 3)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, output string, form string, n int")
    for how in (fill_middle.Settings(), fill_middle.Settings(seed=11, rate=40, spm_rate=20)):
        made = fill_middle.fill_in_middle(docs, how)
        found = made.withColumn("back", fill_middle.restored(F.col("output"), F.col("form"), how)).collect()
        want = sorted(((d, *plain_cut(d, t, how.seed, how.rate, how.spm_rate), t or "") for d, t, *_ in rows), key=repr)
        assert sorted(map(tuple, found), key=repr) == want
    digest = fill_middle.digests(fill_middle.fill_in_middle(docs)).collect()
    assert sorted(x.restored_sha256 for x in digest) == sorted(hashlib.sha256((t or "").encode()).hexdigest() for _, t, *_ in rows)
    assert fill_middle.fill_in_middle(docs.filter("false")).count() == 0
    for marks in (("", "b", "c"), ("a", "ab", "c"), ("ab", "bc", "d"), ("aba", "x", "y")):
        with pytest.raises(ValueError):
            fill_middle.Settings(prefix=marks[0], suffix=marks[1], middle=marks[2])
