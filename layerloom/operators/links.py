"""Links: extraction, resolution against existing ids, repair and counters."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from layerloom.fixed_values import SECTIONS
from layerloom.functions.explode import explode_rows
from layerloom.functions.rewrite import (
    HTML_LINK,
    MARKDOWN_LINK,
    WIKILINK,
    bare_section_links,
    rewrite_pieces,
    section_links,
)
from layerloom.functions.skew import join_dimension
from layerloom.functions.text import text_or_null


@dataclass(frozen=True)
class LinkForm:
    """How one kind of link is written: its pattern, the groups of its parts, and what it points to.

    ``points_to`` reads the id from the target and the display, null for links of another kind; without it
    the target is the id.
    """

    pattern: str
    target: int
    display: int
    points_to: Callable[[Column, Column], Column] | None = None

    def parts(self, link: Column) -> tuple[Column, Column]:
        """The id that a written link points to, and its display."""
        target = F.regexp_extract(link, self.pattern, self.target)
        display = F.regexp_extract(link, self.pattern, self.display)
        return self.points_to(target, display) if self.points_to else target, display


WIKI = LinkForm(WIKILINK, target=1, display=3)
MARKDOWN = LinkForm(MARKDOWN_LINK, target=2, display=1)


def cite_form(site: str) -> LinkForm:
    """Markdown links that cite a paragraph: shown as code, with the address of an episode below ``site``.

    The id is the last step of the address, where the step before it is the episodes folder and the display
    names the same chapter before its paragraph mark.
    """

    def chapter(address: Column, display: Column) -> Column:
        below = F.startswith(address, F.lit(site.rstrip("/") + "/"))
        steps = F.filter(F.split(address, "/"), lambda step: step != "")
        last, folder = F.try_element_at(steps, F.lit(-1)), F.try_element_at(steps, F.lit(-2))
        shown = F.startswith(display, F.concat(F.lit("`"), last, F.lit("¶"))) & F.endswith(display, F.lit("`"))
        return F.when(below & (folder == "episodes") & shown, last)

    return LinkForm(MARKDOWN_LINK, target=2, display=1, points_to=chapter)


def extract_wikilinks(
    pages: DataFrame, page_id: str = "page_id", keep: Sequence[str] = ()
) -> DataFrame:
    """Wikilinks of front matter and body with target, anchor, display and place.

    ``keep`` carries page columns along, such as the layer.
    """

    def tagged(part: str, column: str) -> Column:
        found = F.regexp_extract_all(F.col(column), F.lit(WIKILINK), F.lit(0))
        return F.transform(
            F.coalesce(found, F.array().cast("array<string>")),
            lambda link, at: F.struct(F.lit(part).alias("part"), at.alias("at"), link.alias("link")),
        )

    both = F.concat(tagged("fm", "front_matter"), tagged("body", "body"))
    rows = explode_rows(pages, both, F.col(page_id).alias("page_id"), *keep, item="_l")
    link = F.col("_l.link")
    return rows.select(
        "page_id",
        *keep,
        F.col("_l.part").alias("part"),
        (F.col("_l.at") + 1).cast("bigint").alias("pos"),
        F.trim(F.regexp_extract(link, WIKILINK, 1)).alias("target"),
        text_or_null(F.regexp_extract(link, WIKILINK, 2)).alias("anchor"),
        text_or_null(F.regexp_extract(link, WIKILINK, 3)).alias("display"),
    )


def extract_links(
    pages: DataFrame, page_id: str = "page_id", text: str = "body", html: bool = False
) -> DataFrame:
    """Markdown links, or HTML anchors, with display text, address and place."""
    pattern, url, display = (HTML_LINK, 1, 2) if html else (MARKDOWN_LINK, 2, 1)
    found = F.regexp_extract_all(F.col(text), F.lit(pattern), F.lit(0))
    return explode_rows(pages, found, F.col(page_id).alias("page_id"), item="_link").select(
        "page_id",
        (F.col("_at") + 1).cast("bigint").alias("pos"),
        F.regexp_extract("_link", pattern, display).alias("display"),
        F.regexp_extract("_link", pattern, url).alias("url"),
        F.lit("html" if html else "markdown").alias("kind"),
    )


def existing_ids(pages: DataFrame, column: str = "page_id", layer: str | None = None) -> DataFrame:
    """The id set links are checked against: of one layer when given, else per layer."""
    target = F.col(column).alias("target")
    if layer is not None:
        return pages.filter(F.col("layer") == layer).select(target).distinct()
    return pages.select("layer", target).distinct()


def resolve_links(links: DataFrame, existing: DataFrame) -> DataFrame:
    """Mark every link ok or dead.

    ``existing`` has one row per ``target``, or per ``layer`` and ``target``; in the second form a
    link is looked up in its own layer.
    """
    on = [c for c in ("layer", "target") if c in existing.columns]
    known = existing.select(*on).distinct().withColumn("_known", F.lit(True))
    joined = join_dimension(links, known, on, "left")
    status = F.when(F.col("_known"), "ok").otherwise("dead")
    return joined.withColumn("status", status).drop("_known")


def dead_links(links: DataFrame, existing: DataFrame) -> DataFrame:
    """Links whose target does not exist, in their own layer when ``existing`` names layers."""
    on = [c for c in ("layer", "target") if c in existing.columns]
    return join_dimension(links, existing.select(*on), on, "left_anti")


def cited_minus_existing(links: DataFrame, existing: DataFrame) -> DataFrame:
    """Ids that are linked to but do not exist, each once."""
    cited = links.select("target").distinct()
    return cited.join(existing.select("target"), "target", "left_anti")


def unlink_missing(
    pages: DataFrame,
    existing: DataFrame,
    form: LinkForm,
    page_id: str = "page_id",
    text: str = "body",
) -> DataFrame:
    """Turn links to missing targets into their display text; other text is untouched.

    A link is looked up in its page's own layer when ``existing`` names layers. Only ids are joined: the
    page text travels at most once, beside its own short list of dead targets. Plain text holds no link, so a second run changes nothing.
    """
    written = F.regexp_extract_all(F.col(text), F.lit(form.pattern), F.lit(0))
    found = F.array_compact(F.transform(written, lambda link: form.parts(link)[0]))
    on = [c for c in ("layer", "target") if c in existing.columns]
    page = [page_id, *[c for c in on if c != "target"]]
    cited = explode_rows(pages, F.array_distinct(found), *page, item="target").drop("_at")
    missing = join_dimension(cited, existing.select(*on), on, "left_anti")
    # Grouped per page, so a list is never longer than the links of one page.
    per_page = missing.groupBy(*page).agg(F.collect_set("target").alias("_missing"))
    shown = pages.join(per_page, page, "left")

    def plain(link: Column) -> Column:
        target, display = form.parts(link)
        dead = F.array_contains("_missing", target)
        return F.when(dead, F.coalesce(text_or_null(display), target)).otherwise(link)

    changed = rewrite_pieces(F.col(text), form.pattern, plain)
    return shown.withColumn(
        text, F.when(F.col("_missing").isNull(), F.col(text)).otherwise(changed)
    ).drop("_missing")


def rewrite_counters(
    pages: DataFrame, sections: Sequence[str] = SECTIONS, layer: str = "layer", text: str = "body"
) -> DataFrame:
    """Per layer: section links that get their depth prefix, and those still bare afterwards."""
    before = bare_section_links(F.col(text), sections)
    after = bare_section_links(section_links(F.col(text), sections), sections)
    return pages.groupBy(layer).agg(
        F.sum(before).cast("bigint").alias("rewritten"), F.sum(after).cast("bigint").alias("remaining")
    )


def link_counters(
    before: DataFrame, after: DataFrame, form: LinkForm, layer: str = "layer",
    page_id: str = "page_id", text: str = "body",
) -> DataFrame:
    """Per layer: links seen, links kept and links turned into plain text."""

    def counted(df: DataFrame, name: str) -> DataFrame:
        # regexp_count only looks at the text, so each side is one scan and one small shuffle.
        return df.groupBy(layer).agg(
            F.sum(F.regexp_count(F.col(text), F.lit(form.pattern))).cast("bigint").alias(name)
        )

    joined = counted(before, "seen").join(counted(after, "kept"), layer, "full")
    seen, kept = (F.coalesce(F.col(c), F.lit(0)) for c in ("seen", "kept"))
    return joined.select(
        layer, seen.alias("seen"), kept.alias("kept"), (seen - kept).alias("unlinked")
    )
