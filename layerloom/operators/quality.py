"""Lint rules, drift checks, grounding and fixes. Finding and repairing are kept apart."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from layerloom.fixed_values import ELEMENT_LISTS, EVIDENCE_LEVELS, PREDICATES
from layerloom.functions.explode import worked_out
from layerloom.functions.skew import join_dimension
from layerloom.operators.structure import (
    body_elements,
    declared_backlinks,
    declared_chapter,
    declared_index,
)


def count_drift(references: DataFrame, page_id: str = "page_id", body: str = "body") -> DataFrame:
    """Reference pages whose printed backlink count differs from the links they list."""
    counted = references.select(
        F.col(page_id).alias("page_id"),
        declared_backlinks(F.col(body)).alias("declared"),
        F.regexp_count(F.col(body), F.lit(r"(?m)^- \[\[")).cast("bigint").alias("actual"),
    )
    return worked_out(counted).filter("declared IS NOT NULL AND declared <> actual")


def chapter_drift(nav: DataFrame, page_id: str = "page_id") -> DataFrame:
    """Chapter pages whose announced claims, mysteries or references differ from their bullets."""
    announced = declared_chapter(F.col("front_matter"))
    kinds = {"claims": "A", "mysteries": "MY", "refs": "ME"}
    counted = nav.select(
        F.col(page_id).alias("page_id"),
        *[announced[k].alias(f"declared_{k}") for k in kinds],
        *[
            F.regexp_count("body", F.lit(rf"(?m)^- \[\[{prefix}_")).cast("bigint").alias(f"actual_{k}")
            for k, prefix in kinds.items()
        ],
    )
    differs = " OR ".join(f"declared_{k} <> actual_{k}" for k in kinds)
    return worked_out(counted).filter(differs)


def heading_drift(references: DataFrame, page_id: str = "page_id") -> DataFrame:
    """Reference pages whose first heading is not their canonical name, such as one left in template brackets."""
    shown = F.regexp_extract("body", r"(?m)^# (.*)$", 1)
    counted = references.select(F.col(page_id).alias("page_id"), F.col("canonical_name").alias("expected"), shown.alias("shown"))
    return worked_out(counted).filter("expected IS NOT NULL AND expected <> shown")


def index_drift(pages: DataFrame, page_id: str = "page_id") -> DataFrame:
    """Index pages whose printed total differs from their bullets."""
    counted = pages.select(
        F.col(page_id).alias("page_id"),
        declared_index(F.col("body")).alias("declared"),
        F.regexp_count("body", F.lit(r"(?m)^- \[")).cast("bigint").alias("actual"),
    )
    return worked_out(counted).filter("declared IS NOT NULL AND declared <> actual")


def list_drift(episodes: DataFrame) -> DataFrame:
    """Front-matter element lists against the bullets of the body.

    ``episodes`` has the typed list columns and ``body``. ``drift`` is none, order or content.
    """
    listed = F.flatten(F.array(*[F.col(key) for key in ELEMENT_LISTS]))
    found = worked_out(
        episodes.select(
            "episode_id", listed.alias("listed"), body_elements(F.col("body")).alias("shown")
        )
    )
    same_set = (F.size("only_listed") == 0) & (F.size("only_shown") == 0)
    drift = F.when(F.col("listed") == F.col("shown"), "none").when(same_set, "order").otherwise("content")
    return found.withColumns(
        {
            "only_listed": F.array_except("listed", "shown"),
            "only_shown": F.array_except("shown", "listed"),
        }
    ).select("episode_id", drift.alias("drift"), "only_listed", "only_shown")


def id_mismatches(pages: DataFrame) -> DataFrame:
    """Pages whose file name is not their id; ``fm_id`` is the id their front matter gives."""
    return pages.filter(F.col("fm_id").isNotNull() & (F.col("fm_id") != F.col("page_id")))


def casefold_collisions(pages: DataFrame, column: str = "page_id") -> DataFrame:
    """Ids that are equal once case is ignored."""
    return (
        pages.groupBy(F.lower(column).alias("folded"))
        .agg(
            F.countDistinct(column).alias("spellings"),
            F.min(column).alias("first_spelling"),
            F.max(column).alias("last_spelling"),
        )
        .filter("spellings > 1")
    )


def kind_conflicts(entities: DataFrame) -> DataFrame:
    """Names listed under more than one entity kind; kinds are few, so their set stays small."""
    return (
        entities.groupBy("name")
        .agg(F.sort_array(F.collect_set("kind")).alias("_kinds"), F.count("*").alias("uses"))
        .filter(F.size("_kinds") > 1)
        .select(
            "name", F.size("_kinds").cast("bigint").alias("kinds"),
            F.array_join("_kinds", ",").alias("kind_list"), "uses",
        )
    )


def duplicate_backlinks(backlinks: DataFrame) -> DataFrame:
    """Backlinks a reference lists more than once."""
    return backlinks.groupBy("ref_id", "claim_id").agg(F.count("*").alias("times")).filter("times > 1")


def audit_sample(df: DataFrame, n: int, key: str) -> DataFrame:
    """A fixed-size sample that is the same on every run: the n lowest id hashes."""
    return df.orderBy(F.md5(F.col(key).cast("string")), key).limit(n)


def agreement(sample: DataFrame, found: str, expected: str) -> DataFrame:
    """How many sampled rows agree, and their share."""
    same = F.col(found).eqNullSafe(F.col(expected))
    return sample.agg(
        F.count("*").alias("sampled"),
        F.count_if(same).alias("agreed"),
        F.round(F.avg(same.cast("double")), 6).alias("rate"),
    )


def audit_sample_strata(df: DataFrame, n: int, key: str, stratum: str) -> DataFrame:
    """The n lowest id hashes of every stratum, the same for any number of partitions.

    Each task keeps its own n lowest per stratum before the shuffle, so no stratum is sorted as a whole.
    """
    order = W.partitionBy(stratum).orderBy(F.md5(F.col(key).cast("string")), key)
    return df.withColumn("_place", F.row_number().over(order)).filter(F.col("_place") <= n).drop("_place")


def agreement_by_stratum(sample: DataFrame, sizes: DataFrame, found: str, expected: str, stratum: str, z: float = 1.96) -> DataFrame:
    """Per stratum the rows, those sampled and agreeing, the rate and its Wilson interval at ``z``.

    ``sizes`` has the ``rows`` of every stratum.
    """
    same = F.col(found).eqNullSafe(F.col(expected))
    counted = sample.groupBy(stratum).agg(F.count("*").alias("sampled"), F.count_if(same).alias("agreed"))
    rate, n = F.col("agreed") / F.col("sampled"), F.col("sampled")
    middle = (rate + z * z / (2 * n)) / (1 + z * z / n)
    half = z * F.sqrt(rate * (1 - rate) / n + z * z / (4 * n * n)) / (1 + z * z / n)
    bounds = [F.round(c, 6).alias(name) for name, c in (("rate", rate), ("low", middle - half), ("high", middle + half))]
    # Strata without a value are one stratum.
    key = F.coalesce(F.col(stratum).cast("string"), F.lit("")).alias("_key")
    joined = sizes.select(key, "rows").join(counted.withColumn("_key", key), "_key")
    return joined.select(stratum, "rows", "sampled", "agreed", *bounds)


def ground_quotes(quotes: DataFrame, paragraphs: DataFrame) -> DataFrame:
    """Does any cited paragraph contain the quote?

    ``quotes`` has (quote_id, chapter, p_start, p_end, quote), ``paragraphs`` (chapter, para, text).
    A page range is first cut to the paragraphs its chapter has and then becomes paragraph numbers,
    so the join is an equality and yields exactly the pairs to check. Text is repeated only for
    paragraphs cited very often. A quote without any cited paragraph is kept as not grounded.
    """
    extent = paragraphs.groupBy("chapter").agg(
        F.min("para").alias("_first"), F.max("para").alias("_last")
    )
    placed = join_dimension(quotes, extent, ["chapter"], "inner", salt_by=["quote_id"])
    low, high = F.greatest("p_start", "_first"), F.least("p_end", "_last")
    numbers = F.when(low <= high, F.sequence(low, high))
    cited = placed.select("quote_id", "chapter", "quote", F.explode(numbers).alias("para"))
    often = cited.groupBy("chapter", "para").agg(F.count("*").alias("rows"))
    pairs = join_dimension(
        cited, paragraphs.select("chapter", "para", "text"), ["chapter", "para"], "inner",
        salt_by=["quote_id"], rows_per_key=often,
    )
    checked = pairs.groupBy("quote_id").agg(
        F.count("*").alias("paragraphs"), F.bool_or(F.contains("text", "quote")).alias("grounded")
    )
    return quotes.join(checked, "quote_id", "left").select(
        "quote_id",
        F.coalesce("paragraphs", F.lit(0)).alias("paragraphs"),
        F.coalesce("grounded", F.lit(False)).alias("grounded"),
    )


# --- lint -----------------------------------------------------------------------------------


def finding(rule: str, severity: str, rows: DataFrame, path: str, detail: Column) -> DataFrame:
    return rows.select(
        F.lit(rule).alias("rule"),
        F.lit(severity).alias("severity"),
        F.col(path).cast("string").alias("path"),
        detail.cast("string").alias("detail"),
    )


def lint_links(dead: DataFrame) -> DataFrame:
    return finding("LNK003", "error", dead, "page_id", F.col("target"))


def lint_ids(pages: DataFrame) -> DataFrame:
    return finding("ID001", "error", id_mismatches(pages), "page_id", F.col("fm_id"))


def lint_counts(drift: DataFrame) -> DataFrame:
    shown = F.concat_ws("/", "declared", "actual")
    return finding("CNT001", "warning", drift, "page_id", shown)


def lint_headings(drift: DataFrame) -> DataFrame:
    return finding("HDG001", "warning", drift, "page_id", F.col("shown"))


def lint_lists(drift: DataFrame) -> DataFrame:
    rows = drift.filter("drift <> 'none'")
    return finding("LST001", "warning", rows, "episode_id", F.col("drift"))


def lint_stubs(stubs: DataFrame) -> DataFrame:
    reason = F.when(F.col("has_placeholder"), "placeholder").otherwise("empty list")
    return finding("STB001", "info", stubs, "page_id", reason)


def lint_duplicates(duplicates: DataFrame) -> DataFrame:
    shown = F.concat(F.col("claim_id"), F.lit(" x"), F.col("times"))
    return finding("DUP001", "warning", duplicates, "ref_id", shown)


def lint_enums(claims: DataFrame) -> DataFrame:
    """Claims whose predicate or evidence strength is not a known member."""
    bad_predicate = ~F.coalesce(F.col("predicate").isin(PREDICATES), F.lit(False))
    bad_evidence = ~F.coalesce(F.col("evidence_strength").isin(EVIDENCE_LEVELS), F.lit(False))
    detail = F.concat_ws(
        ",",
        F.when(bad_predicate, F.concat(F.lit("predicate="), F.coalesce("predicate", F.lit("")))),
        F.when(bad_evidence, F.concat(F.lit("evidence_strength="), F.coalesce("evidence_strength", F.lit("")))),
    )
    return finding("REF001", "error", claims.filter(bad_predicate | bad_evidence), "claim_id", detail)


def lint_fixable(pages: DataFrame, fixes: Sequence[Fix], key: str = "page_id", text: str = "text") -> DataFrame:
    """A finding per page and fix whose rewrite would change it; nothing is rewritten here."""
    rules = F.array(*[F.struct(F.lit(f.rule).alias("rule"), f.rewrite(F.col(text)).alias("after")) for f in fixes])
    touched = F.filter(rules, lambda r: r["after"] != F.col(text))
    rows = pages.select(key, F.explode(F.transform(touched, lambda r: r["rule"])).alias("rule"))
    return rows.select("rule", F.lit("warning").alias("severity"), F.col(key).cast("string").alias("path"), F.lit("fixable").alias("detail"))


def lint(findings: Sequence[DataFrame]) -> DataFrame:
    """One findings table from the rule queries."""
    table = findings[0]
    for rows in findings[1:]:
        table = table.unionByName(rows)
    return table


# --- fixes ----------------------------------------------------------------------------------


@dataclass(frozen=True)
class Fix:
    """A named text rewrite and how safe it is to apply unseen: safe, review or manual."""

    rule: str
    safety: str
    rewrite: Callable[[Column], Column]


def plan_fixes(
    pages: DataFrame,
    fixes: Sequence[Fix],
    key: str = "path",
    text: str = "text",
    findings: DataFrame | None = None,
) -> DataFrame:
    """Proposed text per page and rule; each rule sees the page as published.

    With ``findings`` (a lint table) only pages with a finding of the same rule get a proposal.
    """
    proposals = F.array(
        *[
            F.struct(
                F.lit(f.rule).alias("rule"), F.lit(f.safety).alias("safety"),
                f.rewrite(F.col(text)).alias("after"),
            )
            for f in fixes
        ]
    )
    plan = (
        pages.select(key, F.col(text).alias("before"), F.explode(proposals).alias("_p"))
        .filter(F.col("_p.after") != F.col("before"))
        .select(key, "_p.rule", "_p.safety", "before", "_p.after")
    )
    if findings is None:
        return plan
    found = findings.select(F.col("path").cast(dict(pages.dtypes)[key]).alias(key), "rule").distinct()
    return join_dimension(plan, found, [key, "rule"], "left_semi")


def apply_fixes(
    pages: DataFrame, fixes: Sequence[Fix], allowed: Sequence[str] = ("safe",), text: str = "text"
) -> DataFrame:
    """A new version of the pages with the allowed fixes applied in order."""
    value = F.col(text)
    for fix in fixes:
        if fix.safety in allowed:
            value = fix.rewrite(value)
    return pages.withColumn(text, value)


def not_idempotent(
    pages: DataFrame, rewrite: Callable[[Column], Column], text: str = "text"
) -> DataFrame:
    """Pages a second run of a rewrite would still change; empty for a sound rule."""
    once = pages.withColumn(text, rewrite(F.col(text)))
    return once.filter(rewrite(F.col(text)) != F.col(text))


