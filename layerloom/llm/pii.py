"""Personal data: generated candidate spans, selected by boosted trees with calibrated thresholds.

Base forms (email, ip, card, phone) are found and validated as such. High-recall generators
propose further, overlapping spans of the same kinds: written-out addresses, grouped numbers
without a plus, dotted numbers. Every candidate has eight yes/no features of its format and of
the words before it. Candidates are counted by feature pattern over all documents, so training
sees at most 4 * 256 rows of counts at any corpus size: trees are boosted on them, with the base
validation as label, and a threshold per kind is calibrated to a precision. Candidates above it
are added to the base spans. Built-in functions only.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from layerloom.functions.explode import worked_out
from layerloom.llm.common import let, text_of

# The base forms, with runs that never give back characters. What cannot begin a
# leftmost match is excluded in front, so that long runs are read once.
BASE = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:(?<![0-9])|\G)[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
KINDS = tuple(BASE)
# A text without a match of this has no match of the form; it is cheaper to look for.
HINT = {"email": r"@", "ip": r"[0-9]\.[0-9]", "card": r"[0-9](?:[\x20-]?[0-9]){12}", "phone": r"\+[0-9]"}

# Generators of high recall beside the base forms: kind and form.
WIDE = {
    "email": r"(?i)(?<![a-z0-9])[a-z0-9._%+-]{1,64}+\x20?(?:\(at\)|\[at\]|\x20at\x20)\x20?[a-z0-9-]{1,63}+\x20?(?:\.|\(dot\)|\[dot\]|\x20dot\x20)\x20?[a-z]{2,12}(?![a-z])",
    "ip": r"(?<![0-9.])[0-9]{1,3}+(?:[.,:][0-9]{1,3}+){3}(?![0-9])",
    "card": r"(?<![0-9])[0-9]{4}+(?:[\x20./-]?[0-9]{4}+){2}[\x20./-]?[0-9]{1,7}+(?![0-9])",
    "phone": r"(?<![0-9+])\(?[0-9]{3}\)?[\x20./-][0-9]{3}[\x20./-][0-9]{4}(?![0-9])",
}
WIDE_HINT = {
    "email": r"(?i)(?:\(at\)|\[at\]|\x20at\x20)",
    "ip": r"[0-9][.,:][0-9]",
    "card": r"[0-9]{4}[\x20./-]?[0-9]{4}[\x20./-]?[0-9]{4}",
    "phone": r"[0-9]{3}\)?[\x20./-][0-9]{3}[\x20./-][0-9]{4}",
}
# Words before a span that speak for its kind.
CUES = {
    "email": r"(?i)(?:mail|contact|write|reach)",
    "ip": r"(?i)(?:\bip\b|host|server|address|from)",
    "card": r"(?i)(?:card|visa|master|credit|pay)",
    "phone": r"(?i)(?:phone|tel|call|mobile|fax)",
}
CONTEXT = 24

ROUNDS = 30
DEPTH = 2
RATE = 0.3
# A candidate is selected where at least this share of the like candidates is personal data.
PRECISION = 0.9
FEATURES = 8


def matches(text: Column, pattern: str, hint: str) -> Column:
    """All leftmost non-overlapping matches: start (code points, from 0), the match, and 24 characters before.

    Each find begins where the last ended, takes the gap lazily and then the form, so a text is
    read once; offsets are running sums of the lengths.
    """
    both = rf"(?s)\G(.*?)({pattern})"

    def placed(gaps: Column) -> Column:
        found = F.regexp_extract_all(text, F.lit(both), F.lit(2))
        empty = F.array().cast("array<struct<start:int,value:string,before:string>>")
        zero = F.struct(F.lit(0).alias("at"), empty.alias("out"))

        def step(acc: Column, x: Column) -> Column:
            start = acc["at"] + F.char_length(x["gap"])
            one = F.struct(start.alias("start"), x["value"].alias("value"), F.right(x["gap"], F.lit(CONTEXT)).alias("before"))
            return F.struct((start + F.char_length(x["value"])).alias("at"), F.concat(acc["out"], F.array(one)).alias("out"))

        pairs = F.zip_with(gaps, found, lambda g, v: F.struct(g.alias("gap"), v.alias("value")))
        return F.aggregate(pairs, zero, step, lambda acc: acc["out"])

    none = F.array().cast("array<struct<start:int,value:string,before:string>>")
    gaps = F.regexp_extract_all(text, F.lit(both), F.lit(1))
    return F.when(F.regexp_like(text, F.lit(hint)), let(gaps, placed)).otherwise(none)


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]+", "")


def luhn(digits: Column) -> Column:
    """Whether a string of digits passes the Luhn check."""
    doubled = F.aggregate(
        F.split(F.reverse(digits), ""),
        F.struct(F.lit(0).alias("sum"), F.lit(0).alias("k")),
        lambda acc, d: F.struct(
            (
                acc["sum"]
                + let(d.cast("int") * (1 + acc["k"] % 2), lambda x: F.when(x > 9, x - 9).otherwise(x))
            ).alias("sum"),
            (acc["k"] + 1).alias("k"),
        ),
        lambda acc: acc["sum"],
    )
    return doubled % 10 == 0


def _small_part(part: Column) -> Column:
    stripped = F.regexp_replace(part, "^0+", "")
    return (F.length(stripped) < 3) | ((F.length(stripped) == 3) & (stripped <= "255"))


def is_valid(kind: str, value: Column) -> Column:
    """The base form's own check."""
    if kind == "email":
        return F.lit(True)
    if kind == "ip":
        return F.forall(F.split(value, r"\."), _small_part)
    if kind == "card":
        return let(_digits(value), lambda d: F.length(d).between(13, 19) & F.when(F.length(d).between(13, 19), luhn(d)).otherwise(False))
    return F.length(_digits(value)).between(9, 15)


def base_spans(text: Column, kind: str) -> Column:
    """Valid base spans: start and end, code points, end exclusive."""
    good = F.filter(matches(text, BASE[kind], HINT[kind]), lambda m: is_valid(kind, m["value"]))
    return F.transform(good, lambda m: F.struct(m["start"].alias("start"), (m["start"] + F.char_length(m["value"])).alias("end")))


def features(kind: str, value: Column, before: Column) -> Column:
    """Eight yes/no features as the bits of a number."""
    digits = _digits(value)
    bits = [
        F.regexp_like(before, F.lit(CUES[kind])),
        F.length(digits) >= 12,
        F.length(digits) >= 9,
        F.regexp_like(value, F.lit(r"[\x20/-]")),
        F.regexp_like(value, F.lit(r"[@+]")),
        F.regexp_like(value, F.lit(r"\.")),
        F.regexp_like(before, F.lit(r"[:=(\"']\x20*$")),
        F.regexp_like(before, F.lit(r"[A-Za-z0-9]$")),
    ]
    return sum((F.when(b, F.lit(1 << k)).otherwise(0) for k, b in enumerate(bits)), F.lit(0))


def _judged(text: Column) -> Column:
    """Candidates of all generators with kind, span, feature pattern and whether the base check accepts them."""
    def judge(k: int, kind: str, wide: bool):
        return lambda m: F.struct(
            F.lit(k).alias("kind"),
            m["start"].alias("start"),
            (m["start"] + F.char_length(m["value"])).alias("end"),
            features(kind, m["value"], m["before"]).alias("pattern"),
            # A written-out address is not valid by itself; numbers are checked whatever found them.
            (is_valid(kind, m["value"]) if kind != "email" else F.lit(not wide)).alias("valid"),
            F.lit(wide).alias("wide"),
        )

    forms = [(BASE, HINT, False), (WIDE, WIDE_HINT, True)]
    out = [
        F.transform(matches(text, form[kind], hint[kind]), judge(k, kind, wide))
        for k, kind in enumerate(KINDS)
        for form, hint, wide in forms
    ]
    return F.concat(*out)


def candidates(docs: DataFrame, *keep: str) -> DataFrame:
    """The kept columns and ``_found``: all candidates of the text."""
    ready = worked_out(docs.select(*keep, text_of().alias("_text")))
    return worked_out(ready.select(*keep, _judged(F.col("_text")).alias("_found")))


def pattern_counts(found: DataFrame) -> DataFrame:
    """Candidates and valid ones by kind and pattern: at most 1,024 rows."""
    one = found.select(F.explode("_found").alias("c"))
    return one.groupBy("c.kind", "c.pattern").agg(F.count("*").alias("n"), F.sum(F.col("c.valid").cast("bigint")).alias("good"))


def _tree(rows: list[tuple[int, float, float]], depth: int) -> tuple:
    """A regression tree on pattern bits: rows are (pattern, gradient, curvature)."""
    g, h = sum(r[1] for r in rows), sum(r[2] for r in rows)
    leaf = ("leaf", RATE * g / (h + 1.0))
    if depth == 0:
        return leaf
    best = (1e-9, None)
    for bit in range(FEATURES):
        gl = sum(r[1] for r in rows if r[0] >> bit & 1)
        hl = sum(r[2] for r in rows if r[0] >> bit & 1)
        gain = gl * gl / (hl + 1) + (g - gl) ** 2 / (h - hl + 1) - g * g / (h + 1)
        if gain > best[0] + 1e-12:
            best = (gain, bit)
    if best[1] is None:
        return leaf
    bit = best[1]
    yes, no = [r for r in rows if r[0] >> bit & 1], [r for r in rows if not r[0] >> bit & 1]
    return ("split", bit, _tree(yes, depth - 1), _tree(no, depth - 1)) if yes and no else leaf


def _value(tree: tuple, pattern: int) -> float:
    while tree[0] == "split":
        tree = tree[2] if pattern >> tree[1] & 1 else tree[3]
    return tree[1]


def boost(counts: list[tuple[int, int, int]]) -> list[float]:
    """A score (0 to 1) for each of the 256 patterns of one kind; rows are (pattern, n, good)."""
    n, good = sum(c[1] for c in counts), sum(c[2] for c in counts)
    start = math.log((good + 1) / (n - good + 1))
    trees: list[tuple] = []
    raw = {p: start for p, _, _ in counts}
    for _ in range(ROUNDS if n else 0):
        rows = []
        for p, m, g in counts:
            share = 1 / (1 + math.exp(-raw[p]))
            rows.append((p, g - m * share, m * share * (1 - share)))
        trees.append(_tree(rows, DEPTH))
        for p in raw:
            raw[p] += _value(trees[-1], p)
    total = [start + sum(_value(t, p) for t in trees) for p in range(1 << FEATURES)]
    return [1 / (1 + math.exp(-x)) for x in total]


def threshold(scores: list[float], counts: list[tuple[int, int, int]], precision: float = PRECISION) -> float:
    """The lowest score from which upward at least ``precision`` of the candidates are valid; above 1 where none is."""
    n = good = 0
    best = 2.0
    for score, m, g in sorted(((scores[p], m, g) for p, m, g in counts), reverse=True):
        n, good = n + m, good + g
        if good >= precision * n:
            best = score
    return best


def train(docs: DataFrame) -> list[list[bool]]:
    """For each kind, which of the 256 patterns are selected."""
    rows = pattern_counts(candidates(docs)).collect()
    chosen = []
    for k in range(len(KINDS)):
        counts = sorted((r["pattern"], r["n"], r["good"]) for r in rows if r["kind"] == k)
        scores = boost(counts)
        limit = threshold(scores, counts)
        seen = {p for p, _, _ in counts}
        chosen.append([p in seen and scores[p] >= limit for p in range(1 << FEATURES)])
    return chosen


def detect(docs: DataFrame, *keep: str, selected: list[list[bool]] | None = None) -> DataFrame:
    """The kept columns and ``spans``: kind (place in ``KINDS``), start, end and ``base`` of each span, sorted.

    Base spans always stay; selected candidates that overlap no base span and no earlier candidate
    of their kind are added. A null or empty text has none; repeated rows have the same spans; an
    empty table gives an empty result.
    """
    selected = train(docs) if selected is None else selected
    flat = F.array(*[F.lit(x) for kind in selected for x in kind])
    found = candidates(docs, *keep)
    slim = lambda c, base: F.struct(c["kind"].alias("kind"), c["start"].alias("start"), c["end"].alias("end"), F.lit(base).alias("base"))
    base = F.transform(F.filter("_found", lambda c: c["valid"] & ~c["wide"]), lambda c: slim(c, True))
    more = F.filter("_found", lambda c: ~(c["valid"] & ~c["wide"]) & F.get(flat, c["kind"] * (1 << FEATURES) + c["pattern"]))

    def joined(kept: Column) -> Column:
        free = F.filter(more, lambda c: ~F.exists(kept, lambda b: (b["start"] < c["end"]) & (c["start"] < b["end"])))
        first = F.aggregate(
            F.array_sort(F.transform(free, lambda c: slim(c, False))),
            F.array().cast("array<struct<kind:int,start:int,end:int,base:boolean>>"),
            lambda acc, c: F.when(
                F.exists(acc, lambda a: (a["kind"] == c["kind"]) & (a["start"] < c["end"]) & (c["start"] < a["end"])), acc
            ).otherwise(F.concat(acc, F.array(c))),
        )
        return F.array_sort(F.concat(kept, first))

    return found.select(*keep, let(base, joined).alias("spans"))


def span_table(docs: DataFrame) -> DataFrame:
    """Per row: the counts of the base kinds, a digest of the base spans, and all spans as text."""
    found = worked_out(detect(docs.select("doc_id", "text"), "doc_id"))
    names = F.array(*[F.lit(k) for k in KINDS])
    written = lambda spans: F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ","
    )
    base = F.filter("spans", lambda s: s["base"])
    count = lambda k: F.size(F.filter("spans", lambda s: s["base"] & (s["kind"] == k))).cast("bigint")
    return found.select(
        "doc_id",
        *[count(k).alias(f"n_{kind}") for k, kind in enumerate(KINDS)],
        F.sha2(written(base), 256).alias("base_sha256"),
        written(F.col("spans")).alias("spans"),
    )


def redacted(docs: DataFrame, mark: str = "[private]") -> DataFrame:
    """The documents with every span in their text replaced by ``mark``."""
    found = worked_out(detect(docs, *docs.columns))
    zero = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))
    text = F.col("text")

    def step(acc: Column, s: Column) -> Column:
        gap = F.substring(text, acc["at"] + 1, F.greatest(s["start"] - acc["at"], F.lit(0)))
        new = F.concat(acc["out"], gap, F.lit(mark))
        return F.struct(
            F.greatest(acc["at"], s["end"]).alias("at"),
            F.when(s["start"] >= acc["at"], new).otherwise(acc["out"]).alias("out"),
        )

    by_place = F.array_sort(F.transform("spans", lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"))))
    clean = F.aggregate(by_place, zero, step, lambda acc: F.concat(acc["out"], F.substring(text, acc["at"] + 1, F.char_length(text))))
    return found.withColumn("text", F.when(F.size("spans") > 0, clean).otherwise(text)).select(*docs.columns)
