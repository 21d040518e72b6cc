"""Page lines from rows: chapter index pages and reference pages.

The numbered lines (``n``, ``line``) of a page are the result, at every size, and no line is null;
``sources.sinks.page_text`` puts them together when pages are written out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from layerloom.fixed_values import (
    BACKLINK_DASH,
    BACKLINK_HEADING,
    BACKLINK_HEADING_END,
    CLAIM_HEADING,
    COUNT_END,
    MYSTERY_HEADING,
    REFERENCE_HEADING,
)
from layerloom.functions import text as tx
from layerloom.functions.skew import join_dimension, rank_within
from layerloom.operators.rollup import chapter_counts, chapter_refs, display_name


def number_lines(
    lines: DataFrame, page: str, order: list[str],
    group_rows: int | None = None, sizes: DataFrame | None = None,
) -> DataFrame:
    """(page, n, line): the lines of every page, numbered from 1 in order."""
    return rank_within(lines, [page], order, "n", group_rows, sizes).select(page, "n", "line")


def _heads(df: DataFrame, page: str, fixed: list[tuple[int, Column]]) -> DataFrame:
    """The fixed lines of every page; a null one is an optional line that the page lacks."""
    listed = F.array(*[F.struct(F.lit(rank).alias("rank"), line.alias("line")) for rank, line in fixed])
    present = F.filter(listed, lambda x: x["line"].isNotNull())
    return df.select(page, F.explode(present).alias("h")).select(page, "h.rank", F.lit("").alias("key"), "h.line")


def _line(chapter: str, rank: int, key: Column, text: Column) -> list[Column]:
    return [F.col(chapter), F.lit(rank).alias("rank"), key.alias("key"), text.alias("line")]


def _link(page_id: Column, display: Column | None = None) -> Column:
    inner = page_id if display is None else F.concat(page_id, F.lit("|"), display)
    return F.concat(F.lit("- [["), inner, F.lit("]]"))


def render_nav(
    chapters: DataFrame, claims: DataFrame, mysteries: DataFrame, group_rows: int | None = None,
) -> DataFrame:
    """Lines of the chapter index pages.

    ``chapters`` has ``chapter`` and ``title``, and may have ``heading`` (printed as a second-level
    heading) and ``breadcrumb`` lines; where they are null the page goes without. A link without a
    title shows the heading of its page, else its id.
    """
    optional = [c for c in ("heading", "breadcrumb") if c in chapters.columns]
    heads = chapters.select(
        "chapter", F.coalesce("title", "chapter").alias("title"), *optional,
        F.coalesce(tx.chapter_number(F.col("chapter")).cast("string"), "chapter").alias("number"),
    ).join(chapter_counts(chapters, claims, mysteries), "chapter")
    announced = F.concat(
        F.lit("description: 第"), F.col("number"), F.lit("話のアナロジー "), F.col("claims"),
        F.lit(" 件・伏線 "), F.col("mysteries"), F.lit(" 件・外部参照 "), F.col("refs"), F.lit(" 件"),
    )

    def counted(heading: str, column: str) -> Column:
        return F.concat(F.lit(heading), F.col(column), F.lit(COUNT_END))

    empty = F.lit("")
    fixed = [
        (0, F.lit("---")), (1, F.concat(F.lit("title: "), F.col("title"))),
        (2, F.concat(F.lit("id: nav/"), F.col("chapter"))), (3, announced), (4, F.lit("---")),
        (5, empty), (6, F.concat(F.lit("# "), F.col("title"))), (7, empty),
        (20, counted(CLAIM_HEADING, "claims")), (21, empty), (23, empty),
        (30, counted(MYSTERY_HEADING, "mysteries")), (31, empty),
    ]
    # Claims and mysteries are announced at any count, references only where there are some.
    cited = [(33, empty), (40, counted(REFERENCE_HEADING, "refs")), (41, empty)]
    fixed += [(rank, F.when(F.col("refs") > 0, line)) for rank, line in cited]
    for rank, name, mark in ((8, "heading", "## "), (10, "breadcrumb", "")):
        if name in optional:
            fixed += [(rank, F.concat(F.lit(mark), F.col(name))), (rank + 1, F.when(F.col(name).isNotNull(), ""))]
    label = F.coalesce(tx.predicate_label(F.col("predicate")), F.col("predicate"), empty)
    tag = F.concat(F.lit(" `["), label, F.lit("]`"))
    listed = (
        claims.select(*_line("chapter", 22, F.col("claim_id"),
                             F.concat(_link(F.col("claim_id"), display_name(claims, "claim_id")), tag)))
        .unionByName(mysteries.select(
            *_line("chapter", 32, F.col("mystery_id"),
                   _link(F.col("mystery_id"), display_name(mysteries, "mystery_id")))))
        .unionByName(chapter_refs(claims).filter("ref_id IS NOT NULL").select(
            *_line("chapter", 42, F.col("ref_id"), _link(F.col("ref_id")))))
    )
    known = join_dimension(
        listed, chapters.select("chapter").distinct(), ["chapter"], "left_semi", salt_by=["key"]
    )
    sizes = heads.select((F.col("claims") + F.col("mysteries") + F.col("refs") + len(fixed)).alias("rows"))
    return number_lines(
        _heads(heads, "chapter", fixed).unionByName(known), "chapter", ["rank", "key", "line"], group_rows, sizes
    )


def render_reference(
    references: DataFrame, backlinks: DataFrame, intro: str | None = None, group_rows: int | None = None,
) -> DataFrame:
    """Lines of the reference pages: name, ``intro`` paragraph, count heading, a bullet per backlink.

    ``backlinks`` is a bag of (ref_id, claim_id, statement); the heading counts that bag.
    """
    counts = backlinks.groupBy("ref_id").agg(F.count("*").alias("backlinks"))
    heads = references.select("ref_id", "canonical_name").join(counts, "ref_id", "left")
    heading = F.concat(
        F.lit(BACKLINK_HEADING), F.coalesce("backlinks", F.lit(0)), F.lit(BACKLINK_HEADING_END)
    )
    fixed = [
        (0, F.concat(F.lit("# "), F.coalesce("canonical_name", "ref_id"))), (1, F.lit("")),
        (4, heading), (5, F.lit("")),
    ]
    if intro is not None:
        fixed += [(2, F.lit(intro)), (3, F.lit(""))]
    bullet = F.concat(_link(F.col("claim_id")), F.lit(BACKLINK_DASH), F.coalesce("statement", F.lit("")))
    known = join_dimension(
        backlinks, references.select("ref_id").distinct(), ["ref_id"], "left_semi", salt_by=["claim_id"]
    )
    bullets = known.select(*_line("ref_id", 6, F.col("claim_id"), bullet))
    sizes = counts.select((F.col("backlinks") + len(fixed)).alias("rows"))
    return number_lines(
        _heads(heads, "ref_id", fixed).unionByName(bullets), "ref_id", ["rank", "key", "line"], group_rows, sizes
    )
