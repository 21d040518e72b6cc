"""The name ledger: one-pass replacement with a full audit, notes and checks of the ledger itself.

A ledger row is ``(name, representative, confidence)``; an optional ``ord`` column fixes the order
notes are printed in.
"""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from layerloom.fixed_values import (
    AUDIT_HEADER,
    AUDIT_RULE,
    AUDIT_TITLE,
    AUDIT_TITLE_END,
    LEDGER_BLOCK,
    NOTE_MIDDLE,
    NOTE_PREFIX,
    NOTE_SUFFIX,
    NOTE_TITLE,
    UNVERIFIED,
)
from layerloom.functions.explode import explode_rows
from layerloom.functions.rewrite import pieces
from layerloom.functions.skew import join_dimension
from layerloom.functions.tasks import kept
from layerloom.operators.filters import applied
from layerloom.operators.name_search import noted, one_per_name, substituted, substituted_and_noted

# Up to this many rows (measured) the ledger becomes part of the query; beyond it is searched in the tasks.
INLINE_NAMES = 2_000

# Link targets, link addresses and the ledger's own block are never rewritten.
PROTECTED = (
    rf"<!-- AUTO-GENERATED:{LEDGER_BLOCK} -->.*?<!-- /AUTO-GENERATED:{LEDGER_BLOCK} -->"
    r"|\[\[[^\]|]*|\]\([^)]*\)"
)
PROTECTED_FIRST = r"<\[\]"

AUDIT_TYPE = "array<struct<name:string,representative:string,confidence:string,replaced:bigint>>"
NOTE_TYPE = "array<struct<name:string,representative:string>>"


def hit_pattern(names: Iterable[str]) -> str:
    """A regex for a protected span or any of the names, longest first.

    Most characters begin neither, so one look at the first character comes before the
    alternatives, and only names sharing that character are tried.
    """
    by_first: dict[str, list[str]] = {}
    for name in sorted(names, key=lambda n: (-len(n), n)):
        by_first.setdefault(name[0], []).append(re.escape(name[1:]))
    branches = [f"{re.escape(first)}(?:{'|'.join(rest)})" for first, rest in sorted(by_first.items())]
    firsts = "".join(re.escape(first) for first in sorted(by_first))
    return rf"(?=[{PROTECTED_FIRST}{firsts}])(?:{PROTECTED}|{'|'.join(branches)})"


def _entry(representative: Column, confidence: Column) -> Column:
    return F.struct(representative.alias("representative"), confidence.alias("confidence"))


def _with_inline_ledger(pages: DataFrame, rows: list) -> DataFrame:
    entries = [
        part
        for r in rows
        for part in (F.lit(r["name"]), _entry(F.lit(r["representative"]), F.lit(r["confidence"])))
    ]
    return pages.withColumns(
        {
            "_pattern": F.lit(hit_pattern(r["name"] for r in rows)),
            "_entries": F.create_map(*entries),
        }
    )


def _first(rows: list, name: str, *columns: str) -> list:
    """One row per name, of rows alike in it the one with the smallest columns; a null is smallest."""
    smallest = lambda r: [(r[c] is not None, r[c]) for c in columns]
    chosen: dict[str, object] = {}
    for row in sorted(rows, key=smallest):
        chosen.setdefault(row[name], row)
    return list(chosen.values())


def substitute(
    pages: DataFrame,
    ledger: DataFrame,
    page_id: str = "page_id",
    text: str = "body",
    inline_names: int | None = None,
) -> DataFrame:
    """Replace names by their representatives and add an ``audit`` array of what was replaced.

    One pass from left to right, longest name first; replacements are never looked at again, so
    chains in the ledger are not followed. Audit rows come by falling count, ties in the order the
    names first occur. Of ledger rows alike in name the one with the smallest representative counts;
    empty names and rows without a representative do not. Page ids need not be unique.

    Up to ``inline_names`` rows become a pattern in the query, more are searched in the tasks; both
    ways give the same.
    """
    inline_names = INLINE_NAMES if inline_names is None else inline_names
    usable = _usable(ledger)
    head = usable.limit(inline_names + 1).collect()
    if not head:
        return pages.withColumn("audit", F.array().cast(AUDIT_TYPE))
    if len(head) > inline_names:
        names = one_per_name(usable, ["representative", "confidence"])
        return substituted(pages, names, text, PROTECTED)
    prepared = _with_inline_ledger(pages, _first(head, "name", "representative", "confidence"))
    cut = prepared.withColumn("_pieces", pieces(F.col(text), F.col("_pattern")))
    hit = cut.withColumn(
        "_hits", F.filter("_pieces", lambda p: F.map_contains_key("_entries", p))
    )
    order = F.transform(
        F.array_distinct("_hits"),
        lambda n, at: F.struct(
            (-F.size(F.filter("_hits", lambda h: h == n))).cast("bigint").alias("minus"),
            at.alias("at"),
            n.alias("name"),
        ),
    )
    audit = F.transform(
        F.sort_array(order),
        lambda o: F.struct(
            o["name"].alias("name"),
            F.col("_entries")[o["name"]]["representative"].alias("representative"),
            F.col("_entries")[o["name"]]["confidence"].alias("confidence"),
            (-o["minus"]).alias("replaced"),
        ),
    )
    replaced = F.array_join(
        F.transform(
            "_pieces", lambda p: F.coalesce(F.col("_entries")[p]["representative"], p)
        ),
        "",
    )
    return hit.withColumns(
        {text: replaced, "audit": F.coalesce(audit, F.array().cast(AUDIT_TYPE))}
    ).drop("_pattern", "_entries", "_pieces", "_hits")


def add_notes(
    pages: DataFrame,
    ledger: DataFrame,
    page_id: str = "page_id",
    text: str = "body",
    inline_names: int | None = None,
) -> DataFrame:
    """Add a ``notes`` array: unverified names that occur in the (already rewritten) text."""
    inline_names = INLINE_NAMES if inline_names is None else inline_names
    open_names = _open_names(ledger)
    head = open_names.limit(inline_names + 1).collect()
    if not head:
        return pages.withColumn("notes", F.array().cast(NOTE_TYPE))
    if len(head) <= inline_names:
        rows = sorted(_first(head, "name", "at", "representative"), key=lambda r: (r["at"] is not None, r["at"], r["name"]))
        literal = F.array(
            *[
                F.struct(F.lit(r["name"]).alias("name"), F.lit(r["representative"]).cast("string").alias("representative"))
                for r in rows
            ]
        )
        found = F.filter(literal, lambda n: F.contains(F.col(text), n["name"]))
        return pages.withColumn("notes", F.coalesce(found, F.array().cast(NOTE_TYPE)))
    return _with_notes(noted(pages, _ordered(open_names), text))


def _open_names(ledger: DataFrame) -> DataFrame:
    """The unverified names with what notes are ordered by."""
    order = "ord" if "ord" in ledger.columns else "name"
    return ledger.filter((F.col("confidence") == UNVERIFIED) & (F.col("name") != "")).select(
        F.col(order).alias("at"), "name", "representative"
    )


def _ordered(open_names: DataFrame) -> DataFrame:
    """One row per name, the order as text that sorts alike: whole numbers are moved above zero and filled up."""
    names = one_per_name(open_names, ["at", "representative"])
    number = dict(names.dtypes)["at"] in ("tinyint", "smallint", "int", "bigint")
    moved = F.lpad((F.col("at").cast("decimal(20,0)") + F.lit(str(1 << 63)).cast("decimal(20,0)")).cast("string"), 20, "0") if number else F.col("at").cast("string")
    return names.select("name", F.coalesce(moved, F.lit("")).alias("at"), "representative")


def _with_notes(pages: DataFrame) -> DataFrame:
    listed = F.transform("_notes", lambda n: n.dropFields("at"))
    return pages.withColumn("notes", F.coalesce(listed, F.array().cast(NOTE_TYPE))).drop("_notes")


def _usable(ledger: DataFrame) -> DataFrame:
    return applied(ledger).filter("name <> '' AND representative IS NOT NULL").select("name", "representative", "confidence")


def normalize_names(
    pages: DataFrame, ledger: DataFrame, page_id: str = "page_id", text: str = "body", **limits
) -> DataFrame:
    """Rewritten ``text`` with its ``audit`` and ``notes``."""
    inline_names = INLINE_NAMES if limits.get("inline_names") is None else limits["inline_names"]
    # A large ledger is read several times; counting and keeping it work it out once. A caller's own cache stays.
    cached = ledger.storageLevel.useMemory or ledger.storageLevel.useDisk
    once = ledger if cached else ledger.persist(StorageLevel.DISK_ONLY)
    large = once.limit(inline_names + 1).count() > inline_names
    if large:
        ledger = kept(once)
    if not cached:
        once.unpersist()
    usable, open_names = _usable(ledger), _open_names(ledger)
    if large and all(df.limit(inline_names + 1).count() > inline_names for df in (usable, open_names)):
        names = one_per_name(usable, ["representative", "confidence"])
        return _with_notes(substituted_and_noted(pages, names, _ordered(open_names), text, PROTECTED))
    return add_notes(substitute(pages, ledger, page_id, text, **limits), ledger, page_id, text, **limits)


def audit_rows(normalized: DataFrame, page_id: str = "page_id") -> DataFrame:
    """The audit array as rows, in printed order."""
    return explode_rows(normalized, "audit", F.col(page_id).alias("page_id"), item="_a").select("page_id", (F.col("_at") + 1).cast("bigint").alias("seq"), "_a.*")


def note_rows(normalized: DataFrame, page_id: str = "page_id") -> DataFrame:
    """The notes array as rows, in printed order."""
    return explode_rows(normalized, "notes", F.col(page_id).alias("page_id"), item="_n").select("page_id", (F.col("_at") + 1).cast("bigint").alias("seq"), "_n.*")


def render_audit(audit: Column, notes: Column, run: Column) -> Column:
    """Text of the audit section, empty when there is neither a row nor a note."""
    rows = F.array_join(
        F.transform(
            audit,
            lambda a: F.concat(
                F.lit("| "), a["name"], F.lit(" | "), a["representative"], F.lit(" | "),
                a["confidence"], F.lit(" | "), a["replaced"].cast("string"), F.lit(" |\n"),
            ),
        ),
        "",
    )
    lines = F.array_join(
        F.transform(
            notes,
            lambda n: F.concat(
                F.lit(NOTE_PREFIX), n["name"], F.lit(NOTE_MIDDLE), n["representative"], F.lit(NOTE_SUFFIX)
            ),
        ),
        "\n",
    )
    noted = F.when(F.size(notes) > 0, F.concat(F.lit(NOTE_TITLE), lines)).otherwise("")
    section = F.concat(
        F.lit(AUDIT_RULE + AUDIT_TITLE), run, F.lit(AUDIT_TITLE_END + "\n\n" + AUDIT_HEADER), rows, noted
    )
    return F.when((F.size(audit) > 0) | (F.size(notes) > 0), section).otherwise("")


AUDIT_LINE = r"(?m)^\| (.+?) \| (.+?) \| (.+?) \| (\d+) \|$"
NOTE_LINE = rf"(?m)^{re.escape(NOTE_PREFIX)}(.+?){re.escape(NOTE_MIDDLE)}(.+){re.escape(NOTE_SUFFIX)}$"


def _audit_section(text: Column) -> Column:
    return F.regexp_extract(text, rf"(?s){re.escape(AUDIT_TITLE)}.*\z", 0)


def parse_audit(pages: DataFrame, page_id: str = "page_id", text: str = "text") -> DataFrame:
    """Audit table rows read back from published pages."""
    tail = pages.select(F.col(page_id).alias("page_id"), _audit_section(F.col(text)).alias("_tail"))
    lines = F.regexp_extract_all("_tail", F.lit(AUDIT_LINE), F.lit(0))
    run = F.regexp_extract("_tail", rf"\A{re.escape(AUDIT_TITLE)}([^）\n]*)", 1)
    return explode_rows(tail, lines, "page_id", run.alias("run"), item="_line").select(
        "page_id",
        "run",
        (F.col("_at") + 1).cast("bigint").alias("seq"),
        F.regexp_extract("_line", AUDIT_LINE, 1).alias("name"),
        F.regexp_extract("_line", AUDIT_LINE, 2).alias("representative"),
        F.regexp_extract("_line", AUDIT_LINE, 3).alias("confidence"),
        F.regexp_extract("_line", AUDIT_LINE, 4).cast("bigint").alias("replaced"),
    )


def parse_notes(pages: DataFrame, page_id: str = "page_id", text: str = "text") -> DataFrame:
    """Unresolved-name notes read back from published pages."""
    lines = F.regexp_extract_all(_audit_section(F.col(text)), F.lit(NOTE_LINE), F.lit(0))
    return explode_rows(pages, lines, F.col(page_id).alias("page_id"), item="_line").select(
        "page_id",
        (F.col("_at") + 1).cast("bigint").alias("seq"),
        F.regexp_extract("_line", NOTE_LINE, 1).alias("name"),
        F.regexp_extract("_line", NOTE_LINE, 2).alias("representative"),
    )


def audit_totals(audit: DataFrame) -> DataFrame:
    """How often, and on how many pages, each name was replaced."""
    return audit.groupBy("name", "representative", "confidence").agg(
        F.sum("replaced").cast("bigint").alias("replaced"), F.count("*").alias("pages")
    )


def ledger_chains(ledger: DataFrame) -> DataFrame:
    """Names whose representative is itself a ledger name with another representative."""
    # Drawn onto distinct representatives first, so a popular one does not skew the join.
    second = ledger.select(
        F.col("name").alias("representative"), F.col("representative").alias("next_representative")
    )
    used = ledger.select("representative").distinct()
    onward = used.join(second, "representative").filter("representative <> next_representative")
    return join_dimension(
        ledger.select("name", "representative"), onward, ["representative"], "inner"
    ).filter("name <> representative").select("name", "representative", "next_representative")


def alias_groups(ledger: DataFrame) -> DataFrame:
    """Every name beside its representative with the size of the group, one row per name.

    Rows rather than one array per representative: a group may be of any size.
    """
    members = ledger.select("representative", "name").distinct()
    sizes = members.groupBy("representative").agg(F.count("*").alias("names"))
    return join_dimension(
        members, sizes, ["representative"], "inner", salt_by=["name"],
        rows_per_key=sizes.withColumnRenamed("names", "rows"),
    )


def canonicalize(entities: DataFrame, ledger: DataFrame, name: str = "name") -> DataFrame:
    """Give each entity its representative, kind, confidence and canonical id.

    Entities whose name the ledger does not know stand for themselves.
    """
    lookup = applied(ledger).select(F.col("name").alias(name), "representative", "confidence")
    joined = join_dimension(entities, lookup, [name], "left")
    canonical = F.coalesce(F.col("representative"), F.col(name))
    return joined.withColumn("representative", canonical).withColumn(
        "canonical_id", F.concat(F.lit("E_"), F.col("kind"), F.lit("_"), canonical)
    )
