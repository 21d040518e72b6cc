"""Roll-ups by chapter, arc, reference, entity and facet."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from layerloom.functions import text as tx
from layerloom.functions.skew import join_dimension, rank_within
from layerloom.functions.tasks import kept


def display_name(df: DataFrame, page_id: str) -> Column:
    """What a link to a page shows: its title, else its heading, else its id."""
    return F.coalesce(*[F.col(c) for c in ("title", "heading") if c in df.columns], F.col(page_id))


def backlinks(claims: DataFrame, references: DataFrame) -> DataFrame:
    """Claims that point at each reference, with their statement; sort by claim id to print."""
    cited = claims.select(F.col("object_id").alias("ref_id"), "claim_id", "statement")
    # Measured and then joined, so worked out once.
    known = kept(references.select("ref_id").distinct())
    return join_dimension(cited, known, ["ref_id"], "inner", salt_by=["claim_id"])


def backlink_counts(claims: DataFrame) -> DataFrame:
    """Backlinks per reference: the bag count, and the distinct count beside it."""
    return claims.groupBy(F.col("object_id").alias("ref_id")).agg(
        F.count("*").alias("backlinks"), F.countDistinct("claim_id").alias("distinct_claims")
    )


def chapter_counts(chapters: DataFrame, claims: DataFrame, mysteries: DataFrame) -> DataFrame:
    """Claims, mysteries and distinct references of every chapter; chapters with none are kept.

    Each side is counted per chapter before it is joined.
    """
    per_claim = claims.groupBy("chapter").agg(
        F.count("*").alias("claims"), F.countDistinct("object_id").alias("refs")
    )
    per_mystery = mysteries.groupBy("chapter").agg(F.count("*").alias("mysteries"))
    joined = (
        chapters.select("chapter").distinct().join(per_claim, "chapter", "left").join(per_mystery, "chapter", "left")
    )
    return joined.select(
        "chapter", *[F.coalesce(c, F.lit(0)).alias(c) for c in ("claims", "mysteries", "refs")]
    )


def chapter_index(chapters: DataFrame, claims: DataFrame, mysteries: DataFrame) -> DataFrame:
    """Entries of every chapter page: its claims, mysteries and distinct references, by id.

    One row per entry (``kind`` claim, mystery or reference, or ``none`` for an empty chapter).
    """
    entries = (
        claims.select(
            "chapter", F.lit("claim").alias("kind"), F.col("claim_id").alias("entry_id"),
            "title", tx.predicate_label(F.col("predicate")).alias("tag"),
        )
        .unionByName(
            mysteries.select(
                "chapter", F.lit("mystery").alias("kind"), F.col("mystery_id").alias("entry_id"),
                display_name(mysteries, "mystery_id").alias("title"), F.lit(None).cast("string").alias("tag"),
            )
        )
        .unionByName(
            chapter_refs(claims).select(
                "chapter", F.lit("reference").alias("kind"), F.col("ref_id").alias("entry_id"),
                F.lit(None).cast("string").alias("title"), F.lit(None).cast("string").alias("tag"),
            )
        )
    )
    known = chapters.select("chapter").distinct()
    listed = join_dimension(entries, known, ["chapter"], "left_semi", salt_by=["entry_id"])
    active = claims.select("chapter").unionByName(mysteries.select("chapter")).distinct()
    empty = known.join(active, "chapter", "left_anti")
    return listed.unionByName(
        empty.select("chapter", F.lit("none").alias("kind")), allowMissingColumns=True
    )


def chapter_refs(claims: DataFrame) -> DataFrame:
    """Distinct references of each chapter, one row each."""
    return claims.select("chapter", F.col("object_id").alias("ref_id")).distinct()


def listing(
    df: DataFrame, key: str, group: list[str] | None = None, ignore_case: bool = False
) -> DataFrame:
    """Number entries by id in code-point order, or ignoring case, within each group."""
    ordered = df.withColumn("_order", F.lower(key) if ignore_case else F.col(key))
    return rank_within(ordered, group or [], ["_order", key]).drop("_order")


def top_references(counts: DataFrame, k: int) -> DataFrame:
    """The k most-referenced ids, ties by id."""
    return counts.orderBy(F.desc("backlinks"), "ref_id").limit(k)


def arc_chapters(arcs: DataFrame) -> DataFrame:
    """One row per chapter number of each inclusive arc range."""
    return arcs.select(
        F.explode(F.sequence("ch_start", "ch_end")).alias("chapter_number"), "arc_id"
    )


def arc_of_chapter(df: DataFrame, arcs: DataFrame, chapter: str = "chapter") -> DataFrame:
    """Add the arc a chapter lies in, null outside every range.

    Ranges become chapter numbers first, so this is an equi-join and not a range comparison.
    """
    keyed = df.withColumn("chapter_number", tx.chapter_number(F.col(chapter)))
    return join_dimension(keyed, arc_chapters(arcs), ["chapter_number"], "left").drop("chapter_number")


def layer_counts(pages: DataFrame) -> DataFrame:
    """Pages per layer and section with layer totals and the grand total (null = all)."""
    return pages.rollup("layer", "section").agg(F.count("*").alias("pages"))


def section_index(pages: DataFrame) -> DataFrame:
    """Every page of a section beside the section's page count, to print as an index."""
    sizes = pages.groupBy("layer", "section").agg(F.count("*").alias("pages"))
    entries = pages.select("layer", "section", "page_id")
    return join_dimension(
        entries, sizes, ["layer", "section"], "inner", salt_by=["page_id"],
        rows_per_key=sizes.withColumnRenamed("pages", "rows"),
    )


def entity_stats(observations: DataFrame, entity: str = "subject") -> DataFrame:
    """First chapter, observations and distinct chapters of each entity, per edition."""
    return observations.groupBy(F.col(entity).alias("entity"), "edition").agg(
        F.min("chapter_no").alias("first_chapter_no"),
        F.count("*").alias("observations"),
        F.countDistinct("chapter_no").alias("chapters"),
    )


def claim_facets(claims: DataFrame) -> DataFrame:
    """Claims by predicate and evidence, with both margins and the total (null = all)."""
    return claims.cube("predicate", "evidence_strength").agg(F.count("*").alias("claims"))


def observation_histogram(observations: DataFrame) -> DataFrame:
    """Observations by verb and by subject, one row per bar."""
    bar = F.explode(
        F.array(
            *[
                F.struct(F.lit(axis).alias("axis"), F.col(axis).alias("value"))
                for axis in ("verb", "subject")
            ]
        )
    )
    return observations.select(bar.alias("b")).groupBy("b.axis", "b.value").agg(
        F.count("*").alias("observations")
    )


def top_quotes(observations: DataFrame, k: int = 2, entity: str = "subject") -> DataFrame:
    """First k observations of each entity and edition in chapter and paragraph order.

    Editions are numbered apart, as they are never ordered against each other. The rank filter runs before the shuffle too, so an entity sends at most k rows per task.
    """
    order = W.partitionBy(entity, "edition").orderBy("chapter_no", "para", "event_id")
    return observations.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def gaps(
    records: DataFrame, first: int, last: int, key: str = "chapter_no", edition: str = "edition"
) -> DataFrame:
    """Numbers from first to last that no record of an edition carries, for every edition with records."""
    seen = records.select(edition, F.col(key).cast("int").alias(key)).distinct()
    numbers = F.explode(F.sequence(F.lit(first), F.lit(last))).alias(key)
    return seen.select(edition).distinct().select(edition, numbers).join(seen, [edition, key], "left_anti")
