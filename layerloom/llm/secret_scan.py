"""Secret scans: fixed forms, and values in a credential context that are costly to guess.

The guess cost of a value is the least over all its segmentations into words, dates, repeats,
keyboard walks and brute-force stretches, found by dynamic programming. Words are ranked by the
number of documents that have them outside credential contexts. A value that stands where
a credential stands and costs at least ``MIN_COST`` (log10 of guesses) is a span of kind
``guess``. Texts are scanned whole, each in its own task row.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from layerloom.llm.common import stored, text_of, travels

travels(__name__)

KINDS = ("assign", "access", "hex", "guess")
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
# A credential word, a separator, an optional quote, and the value up to a space or quote.
CONTEXT = re.compile(
    r"""(?<![A-Za-z0-9])(?:pass(?:word|wd|phrase|code)|pwd|secret|token|api[_ -]?key|access[_ -]?key|credentials?|private[_ -]?key|bearer|auth)"""
    r"""["']?(?:\x20*[:=]>?\x20*|\x20+(?:is|was)\x20+|\x20+)["'`]?([^\s"'`<>]{6,})""",
    re.IGNORECASE | re.ASCII,
)
# log10 of the guesses from which a value counts as a secret.
MIN_COST = 10.0
# Characters of a long value looked at first; more are taken until the limit is decided.
FIRST_LOOK = 1_024

# Frequent words and passwords, most frequent first.
WORDS = (
    "password the you and love test user admin login welcome secret token key value name example string your with from this that "
    "master dragon monkey letmein football baseball sunshine princess shadow superman default changeme hello access private public "
    "server client service account email phone number date time data file path type code null none true false"
).split()
RANK = {w: k + 1 for k, w in enumerate(WORDS)}
# Words of the corpus that get a rank, the most frequent ones, and their greatest length. A word beyond
# them costs more than log10 of RANKED anyway.
RANKED = 100_000
LONGEST_WORD = 24
# The rows and columns of a keyboard.
WALKS = ("1234567890", "qwertyuiop", "asdfghjkl", "zxcvbnm", "1qaz", "2wsx", "3edc", "4rfv", "5tgb", "6yhn", "7ujm", "abcdefghijklmnopqrstuvwxyz")
DATE = re.compile(r"(?:19|20)\d\d[-/._]?(?:0[1-9]|1[0-2])[-/._]?(?:[0-2]\d|3[01])|(?:[0-2]\d|3[01])[-/._]?(?:0[1-9]|1[0-2])[-/._]?(?:19|20)\d\d|(?:19|20)\d\d")


def _alphabet(text: str) -> int:
    size = 26 * any("a" <= c <= "z" for c in text) + 26 * any("A" <= c <= "Z" for c in text)
    size += 10 * any("0" <= c <= "9" for c in text) + 33 * any(not c.isalnum() for c in text)
    return max(size, 10)


def _segments(value: str, rank: dict[str, int]) -> Iterator[tuple[int, int, float]]:
    """Stretches that are cheaper than brute force: (from, to, log10 of guesses)."""
    low = value.lower()
    for a in range(len(value)):
        for b in range(a + 3, min(len(value), a + LONGEST_WORD) + 1):
            if low[a:b] in rank:
                yield a, b, math.log10(rank[low[a:b]] * (1 if value[a:b] == low[a:b] else 2)) + 0.5
    for m in DATE.finditer(value):
        yield m.start(), m.end(), math.log10(365 * 120)
    for size in (1, 2, 3, 4):
        a = 0
        while a + 2 * size <= len(value):
            b = a + size
            while b < len(value) and value[b] == value[b - size]:
                b += 1
            if b - a >= max(3, 2 * size):
                yield a, b, size * math.log10(_alphabet(value[a : a + size])) + math.log10((b - a) / size)
                a = b - size + 1
            else:
                a += 1
    for walk in WALKS:
        for line in (walk, walk[::-1]):
            where = {pair: True for pair in zip(line, line[1:])}
            a = 0
            for b in range(1, len(value) + 1):
                if b == len(value) or (low[b - 1], low[b]) not in where:
                    if b - a >= 3:
                        yield a, b, math.log10(40 * (b - a))
                    a = b


def _prefix_costs(value: str, rank: dict[str, int]) -> tuple[list[float], list[tuple[int, int]]]:
    """log10 of the guesses for the cheapest segmentation of every prefix, and the stretches of known form."""
    into: dict[int, list[tuple[int, float]]] = {}
    for a, b, cost in _segments(value, rank):
        into.setdefault(b, []).append((a, cost))
    single = {c: math.log10(_alphabet(c)) for c in set(value)}
    best = [0.0]
    for b in range(1, len(value) + 1):
        # A character by brute force costs its own kind; a stretch of known form ends here at its own cost.
        cost = best[b - 1] + single[value[b - 1]]
        for a, more in into.get(b, ()):
            cost = min(cost, best[a] + more)
        best.append(cost)
    return best, [(a, b) for b, starts in into.items() for a, _ in starts]


def guess_cost(value: str, rank: dict[str, int] = RANK) -> float:
    """log10 of the guesses for the cheapest segmentation of the whole value."""
    return _prefix_costs(value, rank)[0][-1]


def costly(value: str, rank: dict[str, int] = RANK) -> bool:
    """Whether the whole value costs at least ``MIN_COST``.

    A place that no stretch crosses splits every segmentation, so the value costs at least what it costs up to
    there. A long value is read from its begin until such a place decides it, else to its end.
    """
    size = FIRST_LOOK
    while size < len(value):
        best, stretches = _prefix_costs(value[:size], rank)
        # Stretches that go on behind the part show in it already, but for words that begin in its last characters.
        last = size - LONGEST_WORD
        crossed = [0] * (size + 1)
        for a, b in stretches:
            crossed[a + 1] += 1
            crossed[b] -= 1
        depth = 0
        for at in range(1, last + 1):
            depth += crossed[at]
            if depth == 0 and best[at] >= MIN_COST:
                return True
        size *= 2
    return guess_cost(value, rank) >= MIN_COST


def _inside(start: int, end: int, spans: list[tuple[int, int, int]]) -> bool:
    """Whether sorted spans cover all of a stretch."""
    for a, _, b in spans:
        if a > start or start >= end:
            break
        start = max(start, b)
    return start >= end


def scanned(text: str, rank: dict[str, int] = RANK) -> tuple[list[tuple[int, int, int]], int, int]:
    """(start, kind, end) of all spans, sorted, in code points, end exclusive; then the number of values in
    credential context and of those among them that are cheap to guess.

    Values inside base spans are costed too. A costly value that base spans do not cover whole is a span of its
    own beside them.
    """
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if len(m[0]) >= 20]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    base, values, cheap = sorted(found), 0, 0
    for m in CONTEXT.finditer(text):
        start, end = m.span(1)
        while end > start and text[end - 1] in ".,;:!?)]}":
            end -= 1
        if end - start < 6:
            continue
        values += 1
        if not costly(text[start:end], rank):
            cheap += 1
        elif not _inside(start, end, base):
            found.append((start, 3, end))
    return sorted(found), values, cheap


def spans_of(text: str, rank: dict[str, int] = RANK) -> list[tuple[int, int, int]]:
    """The spans of ``scanned`` alone."""
    return scanned(text, rank)[0]


_SPAN = "struct<start:bigint,kind:int,end:bigint>"


def word_ranks(text: Column, docs: DataFrame) -> dict[str, int]:
    """Ranks of words: the fixed ones, then those of the corpus by the number of documents that have them.

    What stands where a credential stands is not counted, so copies of a secret do not make it a word.
    """
    bare = text
    for form in (CONTEXT, ASSIGN):
        bare = F.regexp_replace(bare, "(?i)" + form.pattern, " ")
    words = F.array_distinct(F.split(F.lower(bare), r"[^\p{L}]+"))
    fit = F.filter(words, lambda w: F.length(w).between(3, LONGEST_WORD))
    counts = stored(docs.select(F.explode(fit).alias("w")).groupBy("w").agg(F.count("*").alias("n")).filter(~F.col("w").isin(*WORDS)))
    # From the words at each count follows the count that at most RANKED words reach; they alone are sent.
    least, total = None, 0
    for r in counts.groupBy("n").agg(F.count("*").alias("words")).orderBy(F.desc("n")).limit(RANKED).collect():
        total += r["words"]
        if total > RANKED:
            break
        least = r["n"]
    top = counts.filter(F.col("n") >= least).collect() if least is not None else []
    ordered = sorted(top, key=lambda r: (-r["n"], r["w"]))
    return RANK | {r["w"]: len(WORDS) + k + 1 for k, r in enumerate(ordered)}


def find_secrets(docs: DataFrame, text: Column | None = None) -> DataFrame:
    """The rows with ``secret_spans`` (start, kind as place in ``KINDS``, and end of each span), ``secret_values``
    (values in credential context) and ``secret_cheap`` (those among them that are cheap to guess).

    A null text is empty and has none; repeated rows have the same spans; other columns stay.
    """
    text = text_of() if text is None else text
    rank = docs.sparkSession.sparkContext.broadcast(word_ranks(text, docs))

    @F.pandas_udf(f"struct<spans:array<{_SPAN}>,vals:bigint,cheap:bigint>")
    def spans(texts: pd.Series) -> pd.DataFrame:
        found = [scanned(t, rank.value) for t in texts]
        listed = [[{"start": a, "kind": k, "end": b} for a, k, b in spans] for spans, _, _ in found]
        return pd.DataFrame({"spans": pd.Series(listed, dtype=object), "vals": [v for _, v, _ in found], "cheap": [c for _, _, c in found]})

    made = docs.withColumn("_secrets", spans(text))
    names = {"secret_spans": "spans", "secret_values": "vals", "secret_cheap": "cheap"}
    return made.withColumns({name: F.col(f"_secrets.{field}") for name, field in names.items()}).drop("_secrets")


def secret_table(docs: DataFrame) -> DataFrame:
    """Per row: the counts of the base kinds, a digest of the base spans, and all spans as text."""
    found = find_secrets(docs.select("doc_id", text_of().alias("text"))).select("doc_id", "secret_spans", "secret_values", "secret_cheap")
    names = F.array(*[F.lit(k) for k in KINDS])
    joined = lambda spans: F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ","
    )
    base = F.filter("secret_spans", lambda s: s["kind"] < 3)
    count = lambda kind: F.size(F.filter("secret_spans", lambda s: s["kind"] == kind)).cast("bigint")
    return found.select(
        "doc_id",
        count(0).alias("n_assign"),
        count(1).alias("n_access"),
        count(2).alias("n_hex"),
        F.sha2(joined(base), 256).alias("base_sha256"),
        joined(F.col("secret_spans")).alias("spans"),
        F.col("secret_values").alias("n_values"),
        F.col("secret_cheap").alias("n_cheap"),
    )


def redact(docs: DataFrame, mark: str = "[secret]") -> DataFrame:
    """The documents with every span in their text replaced; overlapping spans are one."""
    rank = docs.sparkSession.sparkContext.broadcast(word_ranks(text_of(), docs))

    @F.pandas_udf("string")
    def clean(texts: pd.Series) -> pd.Series:
        def one(text: str) -> str:
            out, at = [], 0
            for start, _, end in spans_of(text, rank.value):
                if start >= at:
                    out += [text[at:start], mark]
                at = max(at, end)
            return "".join(out) + text[at:]

        return texts.map(lambda t: t if t is None else one(t))

    return docs.withColumn("text", clean("text"))


def digest(spans: str) -> str:
    """What ``base_sha256`` holds for base spans written as text."""
    return hashlib.sha256(spans.encode()).hexdigest()
