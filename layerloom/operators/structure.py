"""Page structure: front matter, headings, generated blocks, quotes and typed rows."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from layerloom.fixed_values import (
    BACKLINK_HEADING,
    BACKLINK_HEADING_END,
    ELEMENT_LISTS,
    PAYOFF_LABEL,
    REVIEW_LABEL,
)
from layerloom.functions import front_matter as fm
from layerloom.functions import text as tx
from layerloom.functions.explode import explode_rows, worked_out

FRONT_MATTER = r"(?s)\A---\n(.*?)\n---\n"


def with_path_columns(files: DataFrame, root: str = "", path: str = "path") -> DataFrame:
    """Layer, section and page id from ``<root>/<layer>/<section>/.../<page id>.md``."""
    inside = F.regexp_replace(F.col(path), rf"^(?:file:)?/*{re.escape(root.strip('/'))}/*", "")
    steps = F.split(inside, "/")
    return files.withColumns(
        {
            "path": inside,
            "layer": steps[0],
            "section": F.when(F.size(steps) > 2, steps[1]).otherwise(F.lit("")),
            "page_id": F.regexp_extract(inside, r"([^/]+?)(?:\.md)?$", 1),
        }
    )


def split_front_matter(pages: DataFrame, text: str = "text") -> DataFrame:
    """Add ``front_matter`` (null when the page has none) and ``body``."""
    head = F.when(F.col(text).rlike(FRONT_MATTER), F.regexp_extract(F.col(text), FRONT_MATTER, 1))
    # The body starts after the text of the head and its two rules.
    body = F.substr(F.col(text), F.length("front_matter") + F.lit(len("---\n\n---\n") + 1))
    return pages.withColumn("front_matter", head).withColumn(
        "body", F.when(F.col("front_matter").isNotNull(), body).otherwise(F.col(text))
    )


def quote_lines(body: Column) -> Column:
    """Text of the ``>`` lines of a page, in order."""
    return F.regexp_extract_all(body, F.lit(r"(?m)^>[ \t]?(.*)$"), F.lit(1))


def _with_entries(pages: DataFrame) -> DataFrame:
    """The front matter lines of a page, read by several columns, taken out of the text once."""
    return worked_out(pages.withColumn("_fm", fm.entries(F.col("front_matter"))))


def _reviewed_base(pages: DataFrame) -> DataFrame:
    """The same for pages with quotes and provenance, whose parts are read more than once too."""
    front = F.col("front_matter")
    return worked_out(pages.withColumns(
        {
            "_fm": fm.entries(front),
            "_proposed": fm.inline_map(front, "proposed_by"),
            "_reviewed": fm.inline_map(front, "reviewed_by"),
            "_quotes": tx.quotes(quote_lines(F.col("body"))),
        }
    ))


def _value(key: str) -> Column:
    return fm.scalar(F.col("_fm"), key)


def typed_claims(pages: DataFrame) -> DataFrame:
    """Claim pages (``front_matter``, ``body``) to typed claim rows."""
    quote = F.try_element_at("_quotes", F.lit(1))
    return _reviewed_base(pages).select(
        _value("id").alias("claim_id"),
        _value("title").alias("title"),
        F.to_date(_value("created")).alias("created"),
        tx.link_target(_value("subject")).alias("subject_id"),
        _value("predicate").alias("predicate"),
        tx.link_target(_value("object")).alias("object_id"),
        _value("epistemic_status").alias("epistemic_status"),
        _value("review_status").alias("review_status"),
        _value("document_status").alias("document_status"),
        _value("spoiler_after").alias("spoiler_after"),
        _value("evidence_strength").alias("evidence_strength"),
        fm.provenance(F.col("_proposed")).alias("proposed_by"),
        fm.provenance(F.col("_reviewed")).alias("reviewed_by"),
        tx.heading_text(F.col("body")).alias("statement"),
        quote["text"].alias("quote"),
        quote["locators"].alias("locators"),
        tx.labelled_text(F.col("body"), REVIEW_LABEL).alias("review_note"),
    )


def typed_mysteries(pages: DataFrame) -> DataFrame:
    front = F.col("front_matter")
    # The question is the paragraph between the heading and the payoff hint.
    question = tx.group(
        F.col("body"), rf"(?s)\n# [^\n]*\n\n(.*?)\n\n(?:\*\*{re.escape(PAYOFF_LABEL)}\*\*|>|\z)"
    )
    return _reviewed_base(pages).select(
        _value("id").alias("mystery_id"),
        _value("title").alias("title"),
        tx.heading_text(F.col("body")).alias("heading"),
        F.to_date(_value("created")).alias("created"),
        _value("mystery_status").alias("mystery_status"),
        _value("spoiler_after").alias("spoiler_after"),
        fm.nested(front, "introduced").alias("introduced"),
        _value("review_status").alias("review_status"),
        fm.provenance(F.col("_proposed")).alias("proposed_by"),
        fm.provenance(F.col("_reviewed")).alias("reviewed_by"),
        question.alias("question"),
        tx.labelled_text(F.col("body"), PAYOFF_LABEL).alias("payoff_hint"),
        F.col("_quotes").alias("quotes"),
        tx.labelled_text(F.col("body"), REVIEW_LABEL).alias("review_note"),
    )


def typed_references(pages: DataFrame) -> DataFrame:
    return _with_entries(pages).select(
        _value("id").alias("ref_id"),
        _value("title").alias("title"),
        _value("subtype").alias("subtype"),
        _value("canonical_name").alias("canonical_name"),
        _value("domain").alias("domain"),
        _value("review_status").alias("review_status"),
        declared_backlinks(F.col("body")).cast("int").alias("declared_count"),
    )


def typed_episodes(pages: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Episode rows with their element lists; ``keep`` carries page columns along.

    Each column is looked up by itself, so that a query works out only those it reads.
    """
    front = F.col("front_matter")
    lists = [fm.block_list(front, key).alias(key) for key in ELEMENT_LISTS]
    return pages.select(
        fm.value(front, "id").alias("episode_id"),
        fm.value(front, "chapter").alias("chapter"),
        tx.link_target(fm.value(front, "arc")).alias("arc"),
        *lists,
        *keep,
    )


def typed_entities(pages: DataFrame) -> DataFrame:
    return _with_entries(pages).select(
        _value("id").alias("entity_id"),
        _value("title").alias("title"),
        _value("subtype").alias("subtype"),
        _value("canonical_name").alias("canonical_name"),
        fm.block_list(F.col("front_matter"), "aliases").alias("aliases"),
        _value("first_appearance").alias("first_appearance"),
        _value("spoiler_after").alias("spoiler_after"),
    )


def typed(pages: DataFrame, section: str) -> DataFrame:
    """Typed rows of one page family; ``pages`` has ``front_matter`` and ``body``."""
    families = {
        "claims": typed_claims,
        "mysteries": typed_mysteries,
        "references": typed_references,
        "episodes": typed_episodes,
        "entities": typed_entities,
    }
    return families[section](pages)


def episode_entities(episodes: DataFrame) -> DataFrame:
    """One row per listed element: chapter, kind (from the id prefix), entity and place."""
    lists = F.flatten(F.array(*[F.col(key) for key in ELEMENT_LISTS]))
    exploded = explode_rows(episodes, lists, "episode_id", "chapter", item="entity_id")
    return exploded.select(
        "episode_id",
        "chapter",
        F.regexp_extract("entity_id", r"^E_([a-z]+)_", 1).alias("kind"),
        "entity_id",
        F.regexp_extract("entity_id", r"^E_[a-z]+_(.*)$", 1).alias("name"),
        (F.col("_at") + 1).cast("bigint").alias("pos"),
    )


def body_elements(body: Column) -> Column:
    """Element ids listed as bullets in a page body, linked or plain, in order."""
    found = F.regexp_extract_all(body, F.lit(r"(?m)^- (?:\[\[)?(E_[^\]|#\r\n]+)"), F.lit(1))
    return F.transform(found, lambda e: F.rtrim(e))


def extract_quotes(pages: DataFrame, page_id: str = "page_id", body: str = "body") -> DataFrame:
    """One row per quote: its ordinal on the page, its text and its page ranges."""
    found = tx.quotes(quote_lines(F.col(body)))
    return explode_rows(pages, found, F.col(page_id).alias("page_id"), item="_quote").select(
        "page_id",
        (F.col("_at") + 1).cast("bigint").alias("ordinal"),
        F.col("_quote.text").alias("text"),
        F.col("_quote.locators").alias("locators"),
    )


def sections(pages: DataFrame, page_id: str = "page_id", body: str = "body") -> DataFrame:
    """Heading sections: level, title, count shown in the title, and the text below it."""
    parts = F.split(F.col(body), r"(?m)^(?=#{1,6} )")
    head = r"(?s)\A(#{1,6}) ([^\n]*)(?:\n(.*))?\z"
    rows = explode_rows(pages, parts, F.col(page_id).alias("page_id"), item="_part").filter(
        F.col("_part").rlike(r"\A#{1,6} ")
    )
    title = F.regexp_extract("_part", head, 2)
    return rows.select(
        "page_id",
        F.length(F.regexp_extract("_part", head, 1)).cast("bigint").alias("level"),
        title.alias("title"),
        tx.group(title, r"[（(](\d+) ?件[）)]").cast("bigint").alias("declared"),
        F.regexp_extract("_part", head, 3).alias("content"),
    )


BLOCK = (
    r"(?s)<!-- AUTO-GENERATED:\w+ -->.*?<!-- /AUTO-GENERATED:\w+ -->"
    r"|<!-- AUTO:BEGIN -->.*?<!-- AUTO:END -->"
)


def generated_blocks(pages: DataFrame, page_id: str = "page_id", body: str = "body") -> DataFrame:
    """Machine-written spans of a page with their name; ``AUTO:BEGIN`` spans are named auto."""
    found = F.regexp_extract_all(F.col(body), F.lit(BLOCK), F.lit(0))
    name = F.coalesce(tx.group(F.col("_block"), r"\A<!-- AUTO-GENERATED:(\w+) -->"), F.lit("auto"))
    inner = F.regexp_replace("_block", r"(?s)\A<!--.*?-->\n?|\n?<!-- /?AUTO[^>]*-->\z", "")
    return explode_rows(pages, found, F.col(page_id).alias("page_id"), item="_block").select(
        "page_id",
        (F.col("_at") + 1).cast("bigint").alias("ordinal"),
        name.alias("block"),
        inner.alias("content"),
    )


def hand_written(body: Column) -> Column:
    """A body without its machine-written spans."""
    return F.regexp_replace(body, BLOCK, "")


def declared_backlinks(body: Column) -> Column:
    """The count a reference page prints in its backlink heading."""
    return tx.shown_count(body, BACKLINK_HEADING, BACKLINK_HEADING_END)


def declared_index(body: Column) -> Column:
    """The count an index page prints as ``全 **N 件**``."""
    return tx.shown_count(body, "全 **", " 件**")


def declared_chapter(description: Column) -> Column:
    """Claims, mysteries and references a chapter index announces in its description."""
    return F.struct(
        tx.shown_count(description, "アナロジー ", " 件").alias("claims"),
        tx.shown_count(description, "伏線 ", " 件").alias("mysteries"),
        tx.shown_count(description, "外部参照 ", " 件").alias("refs"),
    )
