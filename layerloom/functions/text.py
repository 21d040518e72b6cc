"""Scalar text expressions: chapter codes, ids, locators, labels and log tails."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from layerloom.fixed_values import (
    EVIDENCE_LEVELS,
    OBSERVATION_VERBS,
    PREDICATE_LABELS,
    PREDICATES,
)

# First number of the second edition; the two editions are never ordered against each other.
SECOND_EDITION_START = 5000

# Last full-width parenthesis of a line, and the locators such as p36 or p118-p119 listed in it.
LAST_PARENTHESIS = r"^.*（([^（）]*)）[^（）]*$"
LOCATOR = r"(?:^|[,、，])\s*p(\d+)(?:\s*-\s*p?(\d+))?\s*(?=[,、，]|$)"


def any_of(words: Sequence[str]) -> str:
    """A regex alternation, longest word first so that a prefix never hides a longer word."""
    return "|".join(re.escape(w) for w in sorted(words, key=lambda w: (-len(w), w)))


def text_or_null(value: Column) -> Column:
    return F.nullif(value, F.lit(""))


def group(value: Column, pattern: str, index: int = 1) -> Column:
    """A regex group, null instead of the empty string when nothing matched."""
    return text_or_null(F.regexp_extract(value, pattern, index))


def chapter_number(code: Column) -> Column:
    """The number printed in a chapter code, ``ch5004`` -> 5004."""
    return group(code, r"^ch(\d+)$").cast("int")


def edition(code: Column) -> Column:
    return F.when(chapter_number(code) >= SECOND_EDITION_START, 2).when(
        chapter_number(code).isNotNull(), 1
    )


def chapter_no(code: Column) -> Column:
    """Position inside the chapter's own edition."""
    number = chapter_number(code)
    return F.when(number >= SECOND_EDITION_START, number - SECOND_EDITION_START).otherwise(number)


def chapter_code(edition_col: Column, number: Column) -> Column:
    """The inverse of ``edition`` and ``chapter_no``: at least four digits, zero padded."""
    start = F.when(edition_col == 2, SECOND_EDITION_START).otherwise(0)
    return F.concat(F.lit("ch"), F.format_string("%04d", (number + start).cast("int")))


def unquote(value: Column) -> Column:
    """Drop one matching pair of single or double quotes."""
    return F.regexp_replace(F.trim(value), r"""^(["'])(.*)\1$""", "$2")


def link_target(value: Column) -> Column:
    """Id inside a ``[[id]]`` scalar, or the plain text when there is no link."""
    return F.coalesce(group(value, r"\[\[([^\]|#]+)"), text_or_null(value))


def predicate_label(predicate: Column) -> Column:
    pairs = [F.lit(part) for item in PREDICATE_LABELS.items() for part in item]
    return F.create_map(*pairs)[predicate]


def evidence_rank(level: Column) -> Column:
    """1 for the weakest level, rising; null for an unknown one."""
    names = F.array(*[F.lit(name) for name in EVIDENCE_LEVELS])
    return F.nullif(F.array_position(names, level), F.lit(0))


def locators(line: Column) -> Column:
    """Page ranges named by the last full-width parenthesis of a quote line."""
    inside = F.regexp_extract(line, LAST_PARENTHESIS, 1)
    starts = F.regexp_extract_all(inside, F.lit(LOCATOR), F.lit(1))
    ends = F.regexp_extract_all(inside, F.lit(LOCATOR), F.lit(2))
    return F.zip_with(
        starts,
        ends,
        lambda start, end: F.struct(
            start.cast("int").alias("p_start"),
            # The second number is optional; an empty string is no integer.
            F.coalesce(end.try_cast("int"), start.cast("int")).alias("p_end"),
        ),
    )


def quotes(lines: Column) -> Column:
    """Quote lines to (text, locators); the text loses its parenthesis when that holds locators."""
    read = F.transform(lines, lambda q: F.struct(q.alias("line"), locators(q).alias("locators")))
    return F.transform(
        read,
        lambda q: F.struct(
            F.when(
                F.size(q["locators"]) > 0, F.regexp_replace(q["line"], r"（[^（）]*）[^（）]*$", "")
            )
            .otherwise(q["line"])
            .alias("text"),
            q["locators"].alias("locators"),
        ),
    )


def labelled_text(body: Column, label: str) -> Column:
    """Text of a ``**label**: ...`` paragraph."""
    return group(body, rf"(?m)^\*\*{re.escape(label)}\*\*[:：][ \t]*(.*)$")


def heading_text(body: Column, level: int = 1) -> Column:
    return group(body, rf"(?m)^{'#' * level} (.*)$")


def claim_id_parts(claim_id: Column) -> Column:
    """Struct of what a claim id spells out; the slug keeps whatever follows the known parts."""
    pattern = (
        rf"^A_(ch\d+)_({any_of(PREDICATES)})_E_(?:(ch\d+)_)?(?:(p\d+(?:-p?\d+)?)_)?(.+)$"
    )
    return F.struct(
        group(claim_id, pattern, 1).alias("chapter"),
        group(claim_id, pattern, 2).alias("predicate"),
        group(claim_id, pattern, 3).alias("event_chapter"),
        group(claim_id, pattern, 4).alias("locator"),
        group(claim_id, pattern, 5).alias("slug"),
    )


def observation_parts(event_id: Column, verbs: Sequence[str] = OBSERVATION_VERBS) -> Column:
    """Subject, verb, object and paragraph of ``E_<chapter>_<subject>_<verb>_<object>_p<n>``.

    Names may hold underscores, so the verb is found by its dictionary and not by position.
    """
    pattern = rf"^E_(ch\d+)_(.+?)_({any_of(verbs)})_(.+)_p(\d+)$"
    return F.struct(
        group(event_id, pattern, 1).alias("chapter"),
        group(event_id, pattern, 2).alias("subject"),
        group(event_id, pattern, 3).alias("verb"),
        group(event_id, pattern, 4).alias("object"),
        group(event_id, pattern, 5).cast("int").alias("para"),
    )


def run_parts(run: Column) -> Column:
    """Timestamp and version of a run id ``YYYYMMDDTHHMM_vNNN``."""
    pattern = r"^(\d{8}T\d{4})_v(\d+)$"
    stamp = group(run, pattern, 1)
    return F.struct(
        F.to_timestamp_ntz(stamp, F.lit("yyyyMMdd'T'HHmm")).alias("run_ts"),
        group(run, pattern, 2).cast("int").alias("version"),
    )


def log_tail(text: Column, lines: int = 4, separator: str = " / ") -> Column:
    """The last ``lines`` lines of a stripped log text, joined."""
    rows = F.split(F.regexp_replace(text, r"^\s+|\s+$", ""), r"\r?\n")
    start = F.greatest(F.size(rows) - lines, F.lit(0)) + 1
    return F.array_join(F.slice(rows, start, lines), separator)


def error_tail(text: Column, chars: int = 300) -> Column:
    return F.right(text, F.lit(chars))


def shown_count(body: Column, prefix: str, suffix: str) -> Column:
    """An integer printed between two fixed strings."""
    return group(body, rf"{re.escape(prefix)}(\d+){re.escape(suffix)}").cast("bigint")
