"""Guess costs of whole values against a plain search over all segmentations, and the counts of values."""

import math
import random
from functools import cache

import pytest

from layerloom.llm import secret_scan


def plain_cost(value, rank):
    """The cheapest of all segmentations, piece by piece from the end."""
    pieces = {}
    for a, b, cost in secret_scan._segments(value, rank):
        pieces[a, b] = min(cost, pieces.get((a, b), math.inf))

    @cache
    def upto(n):
        if n == 0:
            return 0.0
        costs = [upto(n - 1) + math.log10(secret_scan._alphabet(value[n - 1]))]
        return min(costs + [upto(a) + cost for (a, b), cost in pieces.items() if b == n])

    return upto(len(value))


def values(seed, n, size):
    r = random.Random(seed)
    parts = ["pass", "word", "dragon", "aaaa", "abab", "qwert", "2024-01-31", "Z", "7", "#", "xK9", "é", "1234567"]
    return ["".join(r.choice(parts) for _ in range(r.randint(1, size))) for _ in range(n)]


def test_costs_equal_a_search_over_all_segmentations():
    rank = secret_scan.RANK | {"pass": 200, "word": 300}
    for value in values(1, 120, 12):
        assert secret_scan.guess_cost(value, rank) == pytest.approx(plain_cost(value, rank))


@pytest.mark.parametrize("value", ["a" * 200, "ab" * 100, "0" * 256, "a" * 5_000, "abcd" * 3_000])
def test_a_long_trivial_value_stays_cheap(value):
    assert secret_scan.guess_cost(value) < secret_scan.MIN_COST
    assert not secret_scan.costly(value)


def test_long_values_are_decided_as_their_whole_cost_decides(monkeypatch):
    monkeypatch.setattr(secret_scan, "FIRST_LOOK", 40)
    for value in values(2, 200, 40) + ["a" * 300 + "xK9#vQ2!mZ7p", "abcabc" * 60 + "Q", "q" * 39 + "w" * 39 + "e" * 39]:
        assert secret_scan.costly(value) == (secret_scan.guess_cost(value) >= secret_scan.MIN_COST)


def test_every_value_in_context_is_counted(spark):
    rows = [
        (1, 'password = "S3cure!Pass#2024zQ" and token: aaaaaaaaaaaa'), (2, "secret: " + "ab" * 100), (3, "nothing here"), (4, None),
        (5, "api_key=AAAAAAAAAAAA password=xK9#vQ2!mZ7pLw0"),
    ]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = {r.doc_id: (r.n_values, r.n_cheap, "guess" in r.spans) for r in secret_scan.secret_table(docs).collect()}
    assert got == {1: (2, 1, True), 2: (1, 1, False), 3: (0, 0, False), 4: (0, 0, False), 5: (2, 1, True)}


def test_ranks_stop_at_a_count_and_keep_ties_together(spark, monkeypatch):
    monkeypatch.setattr(secret_scan, "RANKED", 3)
    docs = spark.createDataFrame([(1, "zebra yak xerus"), (2, "zebra yak walrus"), (3, "zebra")], "doc_id bigint, text string")
    ranks = secret_scan.word_ranks(secret_scan.text_of(), docs)
    # Two words are in two documents or more; the two in one would make four.
    assert {w: r for w, r in ranks.items() if w not in secret_scan.RANK} == {"zebra": len(secret_scan.WORDS) + 1, "yak": len(secret_scan.WORDS) + 2}
