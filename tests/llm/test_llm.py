"""The training-data operators against brute force on small and awkward tables."""

import hashlib
import random
import re
import zlib

import duckdb
import numpy as np
import pandas
import pytest
from pyspark.sql import functions as F

from layerloom.llm import curriculum, divergence, latent, line_dedup, near_texts, pii, queries, ring, secret_scan, simhash, toxicity, weak_labels
from layerloom.llm.components import components

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, shard string, size string, spans string"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def prose(seed, n=60):
    r = random.Random(seed)
    return " ".join("".join(r.choice("etaonirshdlu") for _ in range(r.randint(2, 8))) for _ in range(n)) + "."


@pytest.fixture(scope="module")
def awkward(spark):
    """Nulls everywhere, empty and long texts, repeated rows, and columns with clashing names."""
    one = (1, prose(1), "en", "a", 5, "x", "y", "z")
    rows = [one, one, (2, None, None, None, None, None, None, None), (3, "", "en", "b", 0, None, None, None)]
    rows += [(None, prose(4), "xx", None, 1, "s", "s", "s"), (5, prose(5, 30_000), "de", "b", 1, "s", "s", "s")]
    rows += [(6, "\n \t\n", "fr", "c", 3, None, None, None), (1, prose(7), "en", "a", 5, "x", "y", "z")]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(1, 0), (5, 1), (3, None)], "doc_id bigint, toxic int")


@pytest.fixture(scope="module")
def benchmark(spark):
    return spark.createDataFrame([(1, prose(99, 30)), (2, None), (3, "")], "item_id bigint, text string")


def test_awkward_rows_and_empty_tables(spark, awkward, labels, benchmark):
    empty = awkward.filter("false")
    for docs, n in ((awkward, 8), (empty, 0)):
        assert weak_labels.classify(docs).count() == n
        assert simhash.near_duplicates(docs).count() == n
        assert toxicity.toxicity(docs, labels).count() == n
        assert ring.shard_table(docs).count() == n
        assert ring.shard(docs).count() == n
        assert secret_scan.secret_table(docs).count() == n
        assert divergence.judge(docs).count() == n
        assert curriculum.mix_table(docs).count() == n
        assert pii.span_table(docs).count() == n
        assert latent.leaks(docs, benchmark).count() == 0
        assert latent.without_leaks(docs, benchmark).count() == n
    assert line_dedup.line_table(awkward).count() == 7
    assert simhash.keep_one(awkward).count() == 5
    assert latent.leaks(awkward, benchmark.filter("false")).count() == 0


def test_components_equal_brute_force(spark):
    r = random.Random(2)
    edges = [(r.randrange(300), r.randrange(300)) for _ in range(170)] + [(k, k + 1) for k in range(400, 440)]
    found = {x.node: x.component for x in components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    smallest = {n: n for e in edges for n in e}
    for _ in range(100):
        for a, b in edges:
            smallest[a] = smallest[b] = min(smallest[a], smallest[b])
    assert {n: c for n, c in smallest.items() if n != c} == found


def test_simhash_search_misses_no_link(spark):
    r = random.Random(3)
    fps = [r.getrandbits(64) for _ in range(60)]
    fps += [f ^ sum(1 << b for b in r.sample(range(64), r.randint(1, 5))) for f in fps for _ in range(6)]
    # One dense group, larger than a block.
    fps += [fps[0] ^ sum(1 << b for b in r.sample(range(14), r.randint(1, 6))) for _ in range(500)]
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    keyed = spark.createDataFrame(list(enumerate(signed)), "doc_id bigint, fp bigint")
    got = {x.fp: x.component_id for x in simhash.clusters(keyed).collect()}
    distinct = np.array(sorted(set(fps)), dtype=np.uint64)
    near = np.bitwise_count(distinct[:, None] ^ distinct[None, :]) <= 3
    first = {}
    for k, f in enumerate(signed):
        first.setdefault(f, k)
    label = np.array([first[int(f) - (1 << 64) if int(f) >> 63 else int(f)] for f in distinct])
    while True:
        new = np.where(near, label[None, :], 1 << 40).min(axis=1)
        if (new == label).all():
            break
        label = new
    want = {int(f) - (1 << 64) if int(f) >> 63 else int(f): int(x) for f, x in zip(distinct, label)}
    assert got == want


def test_fingerprint_by_definition(spark, awkward):
    import xxhash

    for row in simhash.near_duplicates(awkward.select("doc_id", "text").filter("doc_id is not null and doc_id <> 5 and doc_id <> 1")).collect():
        assert row.fingerprint == "0" * 16
    text = "One TWO three four Five six"
    words = text.lower().split()
    hashes = [xxhash.xxh64(" ".join(words[k : k + 3]), seed=42).intdigest() for k in range(4)]
    want = sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))
    docs = spark.createDataFrame([(1, text)], "doc_id bigint, text string")
    assert simhash.near_duplicates(docs).first().fingerprint == f"{want:016x}"


def test_thresholds_sum_to_the_budget():
    cost, chosen = simhash.allocate([{-1: 0, 0: 5, 1: 50}, {-1: 0, 0: 100, 1: 900}, {-1: 0, 0: 5, 1: 20}], 0)
    assert sum(chosen) == 0 and chosen == [0, -1, 1] and cost == 25


def test_lines_within_an_edit(spark):
    r = random.Random(1)
    base = [f"the quick brown fox jumps over {k} lazy dogs now" for k in range(0, 200, 7)]

    def edited(s):
        for _ in range(r.randint(1, 2)):
            p = r.randrange(len(s))
            s = r.choice([s[:p] + "é" + s[p + 1 :], s[:p] + s[p + 1 :], s[:p] + " " + s[p:]])
        return s

    docs = spark.createDataFrame(list(enumerate(base + [edited(r.choice(base)) for _ in range(200)])), "doc_id bigint, text string")
    rows = line_dedup.lines(docs)
    got = {tuple(x) for x in line_dedup.line_links(rows).collect()}
    a = rows.select(F.col("h").alias("a"), F.col("line").alias("x")).distinct()
    b = rows.select(F.col("h").alias("b"), F.col("line").alias("y")).distinct()
    near = F.levenshtein("x", "y", line_dedup.TAU) >= 0
    assert got == {tuple(x) for x in a.crossJoin(b).filter("a < b").filter(near).select("a", "b").collect()} and len(got) > 50
    verified = a.crossJoin(b).filter(line_dedup.within_edits(F.col("x"), F.col("y")) != near)
    assert verified.count() == 0


def test_lines_of_a_frequent_segment_are_linked_in_blocks(spark, monkeypatch):
    r = random.Random(4)
    base = "the terms of this very common line " + prose(11, 6)
    texts = {base}
    for _ in range(300):
        p, q = r.randrange(len(base)), r.randrange(len(base))
        one = base[:p] + r.choice("xyzq") + base[p + 1 :]
        texts.add(one[:q] + r.choice("xyzq") + one[q + 1 :])
    # A dense group: all of them within two edits of each other.
    texts |= {f"{base} {p}{q}" for p in "abcdefghijklmn" for q in "abcdefghijklmn"}
    # Shares the segments, yet is far from all others.
    texts |= {base[:60] + prose(k, 3) for k in range(20)}
    docs = spark.createDataFrame(list(enumerate(sorted(texts))), "doc_id bigint, text string")
    rows = line_dedup.lines(docs)
    monkeypatch.setattr(line_dedup, "HOT_LINES", 10**9)
    pairs = line_dedup.line_links(rows)
    want = {tuple(x) for x in components(pairs).collect()}
    monkeypatch.setattr(line_dedup, "HOT_LINES", 16)
    monkeypatch.setattr(line_dedup, "BLOCK", 32)
    links = line_dedup.line_links(rows)
    assert {tuple(x) for x in components(links).collect()} == want and len(want) > 440
    assert links.count() < pairs.count() / 4


def test_lines_two_edits_apart_are_one(spark):
    line = "Licensed under terms of 2019: " + prose(77, 30)
    far = line.replace("2019", "2058").replace("Licensed", "Licenced")
    rows = [(1, line), (2, line.replace("2019", "2035")), (3, line[:60] + line[62:]), (4, "xy" + line), (5, far), (6, prose(78, 30))]
    got = {r.doc_id: r.n_removed for r in line_dedup.line_table(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert got == {1: 0, 2: 1, 3: 1, 4: 1, 5: 0, 6: 0}


def test_repeated_lines_go(spark):
    docs = spark.createDataFrame([(1, "alpha\nbeta\nalpha"), (2, "beta\ngamma"), (3, None)], "doc_id bigint, text string")
    assert {r.doc_id: r.text for r in line_dedup.without_repeats(docs).collect()} == {1: "alpha\nbeta", 2: "gamma", 3: None}


def test_ring_is_even_and_moves_little(spark):
    docs = spark.createDataFrame([(k, f"t{k % 50}") for k in range(2003)], "doc_id bigint, text string")
    rows = ring.shard_table(docs).collect()
    slots = {}
    for r in rows:
        assert r.text_crc32 == zlib.crc32(f"t{r.doc_id % 50}".encode()) and r.size == len(f"t{r.doc_id % 50}") + 1
        slots.setdefault(r["shard"], []).append(r.slot)
    assert sorted(map(len, slots.values())) == [125] * 13 + [126] * 3
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert rows and sorted(map(tuple, rows), key=repr) == sorted(map(tuple, ring.shard_table(docs.repartition(7)).collect()), key=repr)
    # With slack, a further shard takes rows and few others move.
    at = {k: {r.doc_id: r["shard"] for r in ring.shard(docs, k, slack=0.3).collect()} for k in (16, 17)}
    moved = [d for d in at[16] if at[16][d] != at[17][d]]
    assert len(moved) < 2003 / 4


def test_mix_meets_targets(spark):
    r = random.Random(5)
    rows = [(k, "w " * r.randint(0, 40), r.choice(["a", "b", "c", "d", None])) for k in range(600)]
    got = curriculum.mix_table(spark.createDataFrame(rows, "doc_id bigint, text string, source string")).collect()
    size = {}
    for _, t, s in rows:
        size[s] = size.get(s, 0) + len(WORD.findall(t))
    names = sorted((s for s in size if s is not None)) + [None]
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(names)}
    left, target, full = 1.5 * sum(size.values()), {}, set()
    while True:
        share = {s: (left - sum(2 * size[f] for f in full)) * weight[s] / sum(weight[x] for x in names if x not in full) for s in names if s not in full}
        over = {s for s in share if share[s] >= 2 * size[s]}
        if not over:
            break
        full |= over
    target = {s: 2.0 * size[s] if s in full else share[s] for s in names}
    source = {k: s for k, _, s in rows}
    taken = {}
    for x in got:
        assert x.size == len(WORD.findall(rows[x.doc_id][1])) and x.taken <= 2 * x.size
        assert x.target == pytest.approx(target[source[x.doc_id]]) and x.source_size == size[source[x.doc_id]]
        taken[source[x.doc_id]] = taken.get(source[x.doc_id], 0) + x.taken
    assert all(abs(taken[s] - target[s]) <= 1 for s in names)
    assert sum(len(WORD.findall(x.text)) for x in curriculum.mixed(spark.createDataFrame(rows, "doc_id bigint, text string, source string")).collect()) == sum(taken.values())


def test_quality_counts_by_definition(spark):
    text = "\n".join([prose(8, 30), "a b c d e f g h i", "same line", "same line", "  ", "x a b c d e f g h #|"])
    got = divergence.judge(spark.createDataFrame([(1, text, "en")], "doc_id bigint, text string, lang string")).first()
    words = WORD.findall(text)
    windows = [tuple(words[k : k + 8]) for k in range(len(words) - 7)]
    inside = {k + j for k, w in enumerate(windows) if windows.count(w) > 1 for j in range(8)}
    assert (got.n_words, got.word_chars, got.n_symbols) == (len(words), sum(map(len, words)), 2)
    assert (got.n_dup_lines, got.n_repeat_words) == (1, len(inside)) and len(inside) == 16


def test_texts_without_words_are_judged(spark, tmp_path):
    texts = [None, "", " \n\t", "\n" * 50, "a", " ".join("abcdefg"), *[prose(k, 80) for k in range(9)]]
    rows = [(k, text, "en", "a", len(text or "")) for k, text in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: (r.n_words, r.kept) for r in queries.op7_quality_rules(spark, str(tmp_path)).collect()}
    assert got == {k: (len(WORD.findall(text or "")), k > 5) for k, text in enumerate(texts)}
    good = divergence.keep_good(spark.read.parquet(f"{tmp_path}/documents.parquet"))
    assert sorted(r.doc_id for r in good.collect()) == list(range(6, 15))


def test_junk_that_fails_the_base_rules_shapes_no_reference(spark):
    good = [(k, prose(k, 80), "en") for k in range(60)]
    junk = [(1000 + k, f"## 9{k} $$ 77 || 4#4 && 1*1 " * 30, "en") for k in range(30)]
    wanted = lambda rows: {
        r.doc_id: (r.base_failed, round(r.class_distance, 9), round(r.word_distance, 9), r.kept)
        for r in divergence.judge(spark.createDataFrame(rows, "doc_id bigint, text string, lang string")).collect()
    }
    both, alone = wanted(good + junk), wanted(good)
    assert all(both[k][0] for k, _, _ in junk) and {k: both[k] for k, _, _ in good} == alone


def test_secrets_and_guess_costs(spark):
    text = 'x Password: "abcdef12" AKIA' + "A" * 16 + " " + "0a" * 12 + " the passphrase is xK9#vQ2!mZ7p"
    row = secret_scan.secret_table(spark.createDataFrame([(1, text)], "doc_id bigint, text string")).first()
    assert (row.n_assign, row.n_access, row.n_hex) == (1, 1, 1) and row.spans.endswith(":%d" % len(text)) and "guess" in row.spans
    assert row.base_sha256 == hashlib.sha256(row.spans.rsplit(",", 1)[0].encode()).hexdigest()
    weak = [secret_scan.guess_cost(v) for v in ("password", "aaaaaaaaaaaa", "qwertyuiop", "20240131")]
    assert max(weak) < 8 < secret_scan.guess_cost("xK9#vQ2!mZ7p")


def test_secret_values_are_whole(spark):
    # One source of draws: a new one for each character would repeat a single letter, which is no secret.
    r = random.Random(6)
    token = "".join(r.choice("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789-_") for _ in range(403))
    texts = [
        f"Authorization: Bearer {token} end", 'password = "S3cure!Pass#2024zQ" end', "DB_PASSWORD=P@ss!w0rd#9xQ end",
        "the secret ingredient end", "an ingredient of the soup", "the secret qzvkwjxhpt end", "the secret qzvkwjxhpt end",
    ]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    got = {r.doc_id: r.text for r in secret_scan.redact(docs, "#").collect()}
    assert got[0] == "Authorization: Bearer # end"
    assert got[1] == "#\" end" and got[2] == "DB_PASSWORD=# end" and got[3] == texts[3] and got[4] == texts[4]
    assert got[5] == got[6] == "the secret # end"
    spans = {r.doc_id: r.spans for r in secret_scan.secret_table(docs).collect()}
    assert spans[1] == "assign:0:18,guess:12:30"


def test_private_spans_by_regular_expression(spark):
    forms = {
        "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
        "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    }

    def good(kind, value):
        d = re.sub("[^0-9]", "", value)
        double = [int(c) * (1 + k % 2) for k, c in enumerate(reversed(d))]
        return {
            "email": lambda: True, "ip": lambda: all(int(p) <= 255 for p in value.split(".")),
            "card": lambda: 13 <= len(d) <= 19 and sum(x - 9 if x > 9 else x for x in double) % 10 == 0, "phone": lambda: 9 <= len(d) <= 15,
        }[kind]()

    texts = [
        "é a@b.c_d@e.f 1.2.3.4.5.6.7.8 999.1.1.1 001.002.003.004 x@y x@y.z.", "+1 (2) 345-6789- 4111 1111-1111 1111 and 4111111111111112",
        "1 " * 3000 + "a@" * 50 + "+1" + "(" * 500, "", None, "tel: 555-123-4567",
    ]
    got = pii.span_table(spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")).collect()
    for row in got:
        spans = [f"{k}:{m.start()}:{m.end()}" for k, f in forms.items() for m in re.finditer(f, texts[row.doc_id] or "") if good(k, m[0])]
        assert row.base_sha256 == hashlib.sha256(",".join(spans).encode()).hexdigest()
        assert row.n_email + row.n_ip + row.n_card + row.n_phone == len(spans)


def test_boosting_learns_a_feature():
    scores = pii.boost([(0, 100, 2), (1, 100, 98), (3, 50, 49)])
    assert scores[1] > 0.9 > 0.1 > scores[0]
    assert pii.threshold(scores, [(0, 100, 2), (1, 100, 98)], 0.9) == scores[1]


def test_benchmark_passages_are_found(spark):
    items = [(k, prose(1000 + k, 20 + k)) for k in range(12)]
    docs = [(k, prose(k, 150)) for k in range(300)]
    docs += [(500 + k, prose(5000 + k, 37 + 5 * k) + " " + t.upper() + " " + prose(6000 + k, 90)) for k, t in items]
    found = latent.leaks(spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame(items, "item_id bigint, text string"))
    assert {(r.doc_id, r.item_id) for r in found.collect()} == {(500 + k, k) for k, _ in items}


def test_toxic_words_are_learned(spark):
    r = random.Random(9)
    docs = [(k, prose(k) + (" you idiot " if k % 4 == 0 else "") + prose(k + 9000)) for k in range(400)]
    marks = spark.createDataFrame([(k, int(k % 4 == 0)) for k in range(400)], "doc_id bigint, toxic int")
    got = toxicity.toxicity(spark.createDataFrame(docs, "doc_id bigint, text string"), marks).collect()
    assert all(x.held_out == (zlib.crc32(str(x.doc_id).encode()) % 5 == 0) for x in got)
    held = [x for x in got if x.held_out]
    assert sum(x.predicted == int(x.doc_id % 4 == 0) for x in held) > 0.95 * len(held)


def test_weak_labels_name_the_bad(spark):
    docs = [(k, prose(k, 80)) for k in range(200)] + [(500 + k, " ".join(w + "***" for w in prose(k, 80).split())) for k in range(40)]
    got = {x.doc_id: x.kept for x in weak_labels.classify(spark.createDataFrame(docs, "doc_id bigint, text string")).collect()}
    assert all(got[k] for k in range(200)) and not any(got[500 + k] for k in range(40))


def five_word_shingles(text):
    words = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    return {tuple(words[k : k + 5]) for k in range(max(len(words) - 4, 1))} if words else set()


def jaccard(x, y):
    return len(x & y) / max(len(x | y), 1)


def test_near_copies_by_brute_force(spark):
    r = random.Random(12)
    rows = [(k, prose(k, 120)) for k in range(60)]
    for k, text in list(rows):
        words = text.split()
        for n in range(4):
            # One to four words changed: similarities from 0.96 down to 0.7.
            changed = list(words)
            for at in r.sample(range(0, 120, 8), n + 1):
                changed[at] = changed[at] + "q"
            rows.append((100 + 4 * k + n, " ".join(changed)))
    rows += [(900, None), (901, ""), (902, " \n"), (903, "one two"), (904, "ONE  two"), (None, rows[0][1])]
    docs = spark.createDataFrame([(*x, "x", 1, 2) for x in rows], "doc_id bigint, text string, _hash string, component int, id int")
    got = {}
    for x in near_texts.near_groups(docs).collect():
        got.setdefault(x.component, []).append(x.doc_id)
    group = {d: c for c, ids in got.items() for d in ids}
    sets = [(d, five_word_shingles(t)) for d, t in rows]
    near = [(x, y) for k, (x, sx) in enumerate(sets) for y, sy in sets[:k] if jaccard(sx, sy) >= 0.8]
    assert sum(group[x] == group[y] for x, y in near) >= 0.98 * len(near) and len(near) > 150
    # Nothing else is together: each group is connected by pairs that brute force finds.
    reach = {d: d if d is not None else -1 for d, _ in rows}
    for _ in range(12):
        for x, y in near:
            reach[x] = reach[y] = min(reach[x], reach[y])
    assert all(len({reach[d] for d in ids}) == 1 for ids in got.values() if not set(ids) & {900, 901, 902})
    assert group[900] == group[901] == group[902] and group[903] == group[904]
    kept = near_texts.keep_one_near(docs)
    assert kept.columns == docs.columns and sorted(x.doc_id for x in kept.collect()) == sorted(min((d for d in ids if d is not None)) for ids in got.values())
    assert near_texts.keep_one_near(docs.filter("false")).count() == 0


def test_similar_pairs_behind_a_refused_link_are_found(spark):
    # Of three texts two are similar (0.8), and the third is close to both by fingerprint but not similar.
    rows = []
    for k in range(80):
        words = prose(5000 + k, 121).split()
        for n, (first, last) in enumerate(((20, 23), (50, 52), (80, 84))):
            changed = [w + "q" if first <= at < last else w for at, w in enumerate(words)]
            rows.append((10 * k + n, " ".join(changed)))
    x, y, z = (five_word_shingles(rows[n][1]) for n in range(3))
    assert jaccard(x, y) >= 0.8 > max(jaccard(x, z), jaccard(y, z)) > 0.77
    found = near_texts.near_groups(spark.createDataFrame(rows, "doc_id bigint, text string"))
    group = {r.doc_id: r.component for r in found.collect()}
    together = sum(group[10 * k] == group[10 * k + 1] for k in range(80))
    assert together >= 78 and all(group[10 * k + 2] not in (group[10 * k], group[10 * k + 1]) for k in range(80)), together


def test_lightest_forest_keeps_the_closest_links():
    a, b, d = np.array([0, 1, 0, 2]), np.array([1, 2, 2, 3]), np.array([5, 3, 4, 9])
    assert sorted(near_texts.lightest_forest(4, a, b, d).tolist()) == [1, 2, 3]


def test_shards_keep_the_written_order(spark, tmp_path):
    rows = [(k % 150, f"text {k % 150}", "x", 1, k) for k in range(600)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, _cell string, slot int, nth int")
    docs.repartitionByRange(5, "nth").sortWithinPartitions("nth").write.parquet(f"{tmp_path}/t")
    got = ring.shard_in_order(spark.read.parquet(f"{tmp_path}/t")).collect()
    assert len(got) == 600 and sorted(r.nth for r in got) == list(range(600))
    by_shard = {}
    for r in sorted(got, key=lambda r: (r["shard"], r.slot)):
        by_shard.setdefault(r["shard"], []).append(r.nth)
    assert all(v == sorted(v) and len(v) in (37, 38) for v in by_shard.values()) and len(by_shard) == 16
    assert ring.shard_in_order(docs).count() == 600
    assert ring.shard_in_order(spark.read.parquet(f"{tmp_path}/t").filter("false")).count() == 0


def test_names_that_operators_use_are_left_alone(spark):
    names = ["_text", "_lang", "_classes", "_hash", "_cell", "_turn", "_order", "_source", "size", "target", "kept", "n_words", "_at"]
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint, " + ", ".join(f"{n} string" for n in names)
    docs = spark.createDataFrame([(k, prose(k, 90), "en", "a", 5, *names) for k in range(8)], schema)
    items = spark.createDataFrame([(1, prose(99, 30))], "item_id bigint, text string")
    for out in (divergence.keep_good(docs), simhash.keep_one(docs), latent.without_leaks(docs, items), curriculum.mixed(docs)):
        found = out.collect()
        assert out.columns == docs.columns and found and all(list(r)[5:] == names for r in found)


def test_pipeline_decisions_take_effect(spark, sf_dir):
    import corpus_pipeline

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    good = corpus_pipeline.quality_rules(spark, docs, sf_dir)
    judged = divergence.judge(docs)
    assert {r.doc_id for r in good.collect()} == {r.doc_id for r in judged.filter("kept").collect()}
    one = corpus_pipeline.near_dedup(spark, good, sf_dir)
    sets = {r.doc_id: five_word_shingles(r.text) for r in good.collect()}
    assert {r.doc_id for r in one.collect()} <= set(sets)
    kept = [r.doc_id for r in one.collect()]
    left = [(x, y) for k, x in enumerate(kept) for y in kept[:k] if jaccard(sets[x], sets[y]) >= 0.8]
    assert len(left) <= 0.1 * (len(sets) - len(kept))
    assert corpus_pipeline.run(spark, sf_dir).columns == [*docs.columns, "shard", "slot"]


def test_queries_with_sql_equal_it(spark, sf_dir):
    database = duckdb.connect()
    for table in ("documents", "pages", "benchmark"):
        database.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    for name, sql in queries.ORACLES.items():
        mine = queries.QUERIES[name](spark, sf_dir).toPandas()
        keys = [c for c in ("page_id", "item_id", "rank", "doc_id") if c in mine.columns]
        theirs = database.execute(sql).fetchdf()[mine.columns]
        mine, theirs = (df.sort_values(keys).reset_index(drop=True) for df in (mine, theirs))
        pandas.testing.assert_frame_equal(mine.fillna(-1), theirs.fillna(-1), check_dtype=False, rtol=0, atol=1e-6)


def test_op8_rows_come_in_the_order_of_the_mix(spark):
    rows = [(n, "w " * (n % 37), f"src{n % 5}") for n in range(600)]
    found = curriculum.mix_table(spark.createDataFrame(rows, "doc_id bigint, text string, source string").repartition(3))
    ranges = [[r["first_position"] for r in part] for part in found.rdd.glom().collect() if part]
    times = [float("inf") if t is None else t for part in ranges for t in part]
    assert "rangepartitioning" in found._jdf.queryExecution().executedPlan().toString() and times == sorted(times)
    assert sorted(r["doc_id"] for r in found.collect()) == list(range(600))
