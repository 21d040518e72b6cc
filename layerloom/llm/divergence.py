"""Quality rules: base counts and the divergence of a document from its language's reference.

Method: histograms of character classes and of common words are compared with the reference of the
document's language by Jensen-Shannon distance, behind minimum-length guards. The references are
sums over all documents that pass the base rules. Built-in functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from layerloom.functions.explode import worked_out
from layerloom.llm.common import guarded, let, stored, text_of, words_of

# Frequent function words of the languages that have a reference.
COMMON_WORDS = {
    "en": "the of and to a in is that it for was on are as with be at by this from or have an they which".split(),
    "de": "der die und in den von zu das mit sich des auf für ist im dem nicht ein eine als auch es an".split(),
    "fr": "de la le et les des en un du une que est pour qui dans par pas au sur il ne se ce plus avec".split(),
    "es": "de la que el en y a los del se las por un para con no una su al lo es como más".split(),
}
OTHER = "other"

# Character classes, as Java character sets. The class "symbol" is what is neither a
# letter, a digit, a space nor a stop; what none of them matches is the last class (small letters).
CLASSES = {
    "upper": r"\p{Lu}",
    "digit": r"\p{Nd}",
    "space": r"\x20\x09-\x0D",
    "stop": r".,;:'\"?()\-",
    "symbol": r"^\p{L}\p{Nd}\x20\x09-\x0D.,;:'\"?()\-",
}
SYMBOLS = "#*$%&|<>"

WINDOW = 8
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
# Shorter texts than these are too noisy for a histogram to say anything.
MIN_CHARS = 100
MIN_HISTOGRAM_WORDS = 40
# A short text gives a rough histogram, so each limit is a base plus noise / sqrt(length).
CLASS_LIMIT = (0.22, 1.2)
WORD_LIMIT = (0.20, 1.6)
# Both distances together, the class distance counted twice.
JOINT_LIMIT = (0.50, 1.6)


def _count_in(text: Column, chars: str) -> Column:
    """Characters of a set, counted by removing the runs of all others."""
    others = chars[1:] if chars[0] == "^" else "^" + chars
    return F.length(F.regexp_replace(text, f"[{others}]+", ""))


def repeated_words(words: Column) -> Column:
    """Words that lie in a window of eight words which the text has more than once."""
    n = F.size(words)
    hashes = let(
        F.transform(words, lambda w: F.xxhash64(w)),
        lambda each: F.transform(F.sequence(F.lit(1), n - (WINDOW - 1)), lambda i: F.xxhash64(F.slice(each, i, WINDOW))),
    )

    def covered(h: Column) -> Column:
        ordered = F.array_sort(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
        twice = lambda s: F.filter(
            s, lambda e, k: (F.get(s, k - 1)["h"] == e["h"]) | (F.get(s, k + 1)["h"] == e["h"])
        )
        places = let(ordered, lambda s: F.array_sort(F.transform(twice(s), lambda e: e["i"])))
        zero = F.struct(F.lit(0).cast("bigint").alias("n"), F.lit(0).alias("end"))
        return F.aggregate(
            places,
            zero,
            lambda acc, p: F.struct(
                (acc["n"] + WINDOW - F.greatest(F.lit(0), acc["end"] - p)).alias("n"), (p + WINDOW).alias("end")
            ),
            lambda acc: acc["n"],
        )

    none = F.lit(0).cast("bigint")
    return F.when(
        n > WINDOW,
        let(hashes, lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), none).otherwise(covered(h))),
    ).otherwise(none)


def repeated_lines(text: Column) -> Column:
    """Lines with a word that equal an earlier line."""
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    return let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("bigint")


def class_histogram(text: Column) -> Column:
    counts = let(
        F.array(*[_count_in(text, chars) for chars in CLASSES.values()]),
        lambda c: F.concat(c, F.array(F.length(text) - F.aggregate(c, F.lit(0), lambda x, y: x + y))),
    )
    return F.transform(counts, lambda c: c.cast("double"))


def language_of(lang: Column) -> Column:
    return F.when(lang.isin(*COMMON_WORDS), lang).otherwise(OTHER)


def _vocabulary(lang: Column) -> Column:
    """The common words of a language; of all languages for texts in another or none."""
    lists = {**COMMON_WORDS, OTHER: sorted({w for ws in COMMON_WORDS.values() for w in ws})}
    found = F.lit(None).cast("array<string>")
    for key, words in lists.items():
        found = F.when(lang == key, F.array(*[F.lit(w) for w in words])).otherwise(found)
    return found


def word_histogram(text: Column, lang: Column) -> Column:
    """How often each common word of the language occurs, and the rest of the words."""
    return let(
        F.split(F.lower(text), r"[\x20\x09-\x0D.,;:'\"?()!#*$%&|<>]+"),
        lambda ws: let(
            F.transform(_vocabulary(lang), lambda w: F.size(ws) - F.size(F.array_remove(ws, w))),
            lambda found: F.transform(
                F.concat(found, F.array(F.size(ws) - F.aggregate(found, F.lit(0), lambda a, b: a + b))),
                lambda x: x.cast("double"),
            ),
        ),
    )


def js_distance(counts: Column, reference: Column) -> Column:
    """Jensen-Shannon distance (base 2, 0 to 1) of two histograms; 0 where one of them is empty."""
    total = lambda a: F.aggregate(a, F.lit(0.0), lambda x, y: x + y)
    share = lambda a: let(total(a), lambda t: F.transform(a, lambda x: x / F.greatest(t, F.lit(1e-300))))
    part = lambda p, q: F.when(p > 0, p * F.log2(2 * p / (p + q))).otherwise(0.0)
    bits = F.aggregate(
        F.zip_with(share(counts), share(reference), lambda p, q: part(p, q) + part(q, p)), F.lit(0.0), lambda x, y: x + y
    )
    return F.when((total(counts) > 0) & (total(reference) > 0), F.sqrt(F.greatest(bits, F.lit(0.0)) / 2)).otherwise(0.0)


def base_counts(docs: DataFrame) -> DataFrame:
    """The documents with ``_text``, ``_words`` and the base counts beside their own columns."""
    ready = worked_out(docs.withColumns({"_text": text_of(), "_words": words_of(text_of())}))
    text, words = F.col("_text"), F.col("_words")
    counted = ready.withColumns(
        {
            "n_words": F.size(words).cast("bigint"),
            "word_chars": F.length(F.concat_ws("", words)).cast("bigint"),
            "n_symbols": _count_in(text, SYMBOLS).cast("bigint"),
            "n_dup_lines": repeated_lines(text),
            "n_repeat_words": repeated_words(words),
        }
    )
    return worked_out(counted.drop("_words")).withColumn(
        "base_failed",
        (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")),
    )


def _histograms(df: DataFrame) -> DataFrame:
    lang = F.col("_lang")
    return df.withColumns({"_classes": class_histogram(F.col("_text")), "_common": word_histogram(F.col("_text"), lang)})


def references(measured: DataFrame) -> DataFrame:
    """One row per language (five at most): the summed histograms of its documents that pass the base rules.

    Takes ``_lang``, ``base_failed`` and the histograms. Each document counts with its shares, not
    its length, so a few long texts do not set the reference. Texts below the minimum lengths are
    left out, as they are never compared.
    """
    size = lambda name: F.aggregate(F.col(name), F.lit(0.0), lambda x, y: x + y)
    passed = measured.filter(~F.col("base_failed")).select("_lang", "_classes", "_common")
    ready = passed.withColumns({"_chars": size("_classes"), "_n": size("_common")}).filter(
        (F.col("_chars") >= MIN_CHARS) & (F.col("_n") >= MIN_HISTOGRAM_WORDS)
    )
    longest = max(len({w for ws in COMMON_WORDS.values() for w in ws}), *map(len, COMMON_WORDS.values())) + 1
    share = lambda name, of, k: F.sum(F.coalesce(F.get(F.col(name), F.lit(k)), F.lit(0.0)) / F.col(of))
    sums = ready.groupBy("_lang").agg(
        F.array(*[share("_classes", "_chars", k) for k in range(len(CLASSES) + 1)]).alias("_ref_classes"),
        F.array(*[share("_common", "_n", k) for k in range(longest)]).alias("_ref_common"),
    )
    return sums.withColumn("_ref_common", F.slice("_ref_common", F.lit(1), F.size(_vocabulary(F.col("_lang"))) + 1))


def judge(
    docs: DataFrame,
    class_limit: tuple[float, float] = CLASS_LIMIT,
    word_limit: tuple[float, float] = WORD_LIMIT,
    joint_limit: tuple[float, float] = JOINT_LIMIT,
    keep: list[str] | None = None,
) -> DataFrame:
    """Every document with its base counts, both distances and ``kept``; of its own columns those in ``keep``, or all.

    A null text is empty and fails the base rules; a null or unknown language is compared with the
    reference of all such texts; a language without a reference keeps its documents; repeated rows
    are judged alike; an empty table gives an empty result. Input columns named like a result
    column are replaced by it.
    """
    results = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
               "class_distance", "word_distance", "kept"]
    own = docs.drop(*results, "_text", "_words", "_lang", "_classes", "_common", "_ref_classes", "_ref_common")
    lang = language_of(F.col("lang")) if "lang" in docs.columns else F.lit(OTHER)
    kept = own.columns if keep is None else keep
    counted = worked_out(_histograms(base_counts(own).withColumn("_lang", lang)).drop("_text"))
    # The texts are read once: the references and the distances both come from what is stored here.
    measured = stored(counted.select(*kept, *results[:6], "_lang", "_classes", "_common"))
    # At most five rows: the listed languages and the rest.
    joined = measured.join(F.broadcast(references(measured)), "_lang", "left")
    distances = {
        "class_distance": F.coalesce(js_distance(F.col("_classes"), F.col("_ref_classes")), F.lit(0.0)),
        "word_distance": F.coalesce(js_distance(F.col("_common"), F.col("_ref_common")), F.lit(0.0)),
    }
    # Spark may work out a shared part of both sides of an ``and`` in advance, so a text without words must not divide by zero.
    beyond = lambda value, limit, size: value > limit[0] + limit[1] / F.sqrt(F.greatest(size, F.lit(1)))
    long_enough = (F.col("word_chars") >= MIN_CHARS), (F.col("n_words") >= MIN_HISTOGRAM_WORDS)
    chars, words = F.col("class_distance"), F.col("word_distance")
    far = (
        (long_enough[0] & beyond(chars, class_limit, F.col("word_chars")))
        | (long_enough[1] & beyond(words, word_limit, F.col("n_words")))
        | (long_enough[1] & beyond(2 * chars + words, joint_limit, F.col("n_words")))
    )
    return (
        joined.withColumns(distances)
        .withColumn("kept", ~F.col("base_failed") & ~far)
        .select(*kept, *results)
    )


def keep_good(docs: DataFrame) -> DataFrame:
    """The documents that pass, with their own columns, whatever these are called.

    Null and repeated rows are judged as ``judge`` says; an empty table gives an empty result.
    """
    plain, own = guarded(docs)
    return judge(plain).filter("kept").select(*own)
