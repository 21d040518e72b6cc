"""Corpus-shaped tables derived from the benchmark tables.

The corpus's own tables (observations, claims, pages, links, ledger) are expressed over the given
Parquet tables, row by row, so every query grows with them. Nothing here is part of an operator.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from layerloom import schemas
from layerloom.fixed_values import (
    BACKLINK_HEADING,
    BACKLINK_HEADING_END,
    EXPLICIT,
    PLACEHOLDERS,
    PREDICATES,
    REVIEW_LABEL,
    SAME_SPELLING,
    UNVERIFIED,
)

EVENT_VERBS = {
    "view": "observes", "click": "is_located", "error": "has_property",
    "purchase": "functions_as", "signup": "says",
}

# Overlapping names on purpose: prefixes of each other, a chain, and an unverified result word.
WORD_LEDGER = [
    ("the", "then", EXPLICIT, 1), ("then", "there", EXPLICIT, 2), ("there", "yonder", SAME_SPELLING, 3),
    ("que", "quoi", EXPLICIT, 4), ("der", "dem", SAME_SPELLING, 5),
    ("and", "also", UNVERIFIED, 6), ("die", "dice", UNVERIFIED, 7), ("yonder", "beyond", UNVERIFIED, 8),
]
ARC_RANGES = [
    ("ARC_01", "first", "first", 5001, 5010, "opening"),
    ("ARC_03", "third", "third", 5021, 5025, "mirror"),
]
RUN = "20261116T1700_v144"
PAGE_SECTIONS = ["The", "the", "and", "of", "la", "que", "de", "die", "der", "en", "is", "in"]

ANCHOR = r'<a href="/([^"]*)">([^<]*)</a>'


# Days after this one stand for the first edition, so that both editions occur.
FIRST_EDITION_AFTER = 300


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of the data folder."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text(*parts: Column | str) -> Column:
    """Concatenate columns and literal strings."""
    return F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])


def word_ledger(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(WORD_LEDGER, schemas.LEDGER)


def vocabulary_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A name per word in the documents, with the space before it; words of four, eight, ... letters are unverified.

    Many names begin others, so the longest one has to be found.
    """
    words = F.explode(F.split("text", " "))
    listed = table(spark, sf_dir, "documents").select(words.alias("word")).filter(F.col("word").rlike("^[a-z]+$")).distinct()
    confidence = F.when(F.length("word") % 4 == 0, UNVERIFIED).otherwise(EXPLICIT)
    return listed.select(
        text(" ", F.col("word")).alias("name"), text(" ", F.reverse("word"), "~").alias("representative"), confidence.alias("confidence")
    )


def arcs(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(ARC_RANGES, schemas.ARCS)


def observations(spark: SparkSession, sf_dir: str, spread: bool = False) -> DataFrame:
    verbs = F.create_map(*[F.lit(x) for pair in EVENT_VERBS.items() for x in pair])
    day = F.dayofyear("ts")
    edition = F.when(day > FIRST_EDITION_AFTER, 1).otherwise(2)
    number = F.when(edition == 1, day - FIRST_EDITION_AFTER).otherwise(day)
    events = table(spark, sf_dir, "events")
    made = (dealt(events, "event_id") if spread else events).select(
        "event_id", "ts", "user_id", "event_type", "value",
        F.get_json_object("props", "$.k").cast("bigint").alias("k"),
        edition.alias("edition"),
        number.alias("chapter_no"),
        F.concat(F.lit("ch"), F.format_string("%04d", F.when(edition == 2, 5000 + number).otherwise(number))).alias("chapter"),
        text("user_", F.col("user_id")).alias("subject"),
        verbs[F.col("event_type")].alias("verb"),
        (F.col("event_id") % 500).alias("para"),
    )
    object_name = text("key_", F.col("k"))
    return made.withColumn("object", object_name).withColumn(
        "observation_id",
        text("E_", F.col("chapter"), "_", F.col("subject"), "_", F.col("verb"), "_", object_name, "_p",
             F.col("para")),
    )


def claims(spark: SparkSession, sf_dir: str, spread: bool = False) -> DataFrame:
    predicates = F.array(*[F.lit(p) for p in PREDICATES])
    made = observations(spark, sf_dir, spread).withColumn(
        "predicate", F.element_at(predicates, (F.col("k") % len(PREDICATES) + 1).cast("int"))
    )
    value = F.col("value")
    strength = F.when(value < 5, "weak").when(value < 20, "moderate").when(value < 100, "strong")
    return made.withColumns(
        {
            "claim_id": text("A_", F.col("chapter"), "_", F.col("predicate"), "_E_p", F.col("user_id"),
                             "_key_", F.col("k")),
            "title": text(F.col("event_type"), " of user ", F.col("user_id")),
            "created": F.to_date("ts"),
            "object_id": text("ME_key_", F.col("k")),
            "evidence_strength": strength.otherwise("explicit"),
            "review_status": F.lit("llm_verified"),
            "spoiler_after": F.col("chapter"),
            "statement": text(F.col("event_type"), " seen with key ", F.col("k")),
        }
    )


def locator_text(para: Column, form: Column) -> Column:
    """The five ways a quote names its pages, the last being none."""
    return (
        F.when(form == 0, text("（p", para, "）"))
        .when(form == 1, text("（p", para, "-p", para + 2, "）"))
        .when(form == 2, text("（p", para, "-", para + 3, "）"))
        .when(form == 3, text("（p", para, ", p", para + 5, "）"))
        .otherwise("")
    )


def dealt(df: DataFrame, key: str) -> DataFrame:
    """The rows over as many tasks as a shuffle has: a file of narrow rows is a few splits, each of many pages."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), key)


def claim_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Claims written out as pages (``front_matter``, ``body``)."""
    c = F.col
    made = claims(spark, sf_dir, spread=True)
    front = text(
        'schema_version: "5.1"\nid: ', c("claim_id"), "\ntitle: ", c("title"),
        '\n\ntype: analytical_claim\ncreated: "', c("created"), '"\nsubject: "[[', c("observation_id"),
        ']]"\npredicate: ', c("predicate"), '\nobject: "[[', c("object_id"),
        ']]"\nepistemic_status: hypothesized\nreview_status: llm_verified\ndocument_status: draft\n',
        "spoiler_after: ", c("chapter"), "\nevidence_strength: ", c("evidence_strength"),
        "\nprovenance:\n  proposed_by: {kind: agent, id: ", c("subject"),
        "}\n  reviewed_by: {kind: agent, id: checker_", c("k"), ', date: "', c("created"), '"}',
    )
    body = text(
        "\n# ", c("statement"), "\n\n> （", c("event_type"), "） by ", c("subject"),
        locator_text(c("para"), c("event_id") % 5), f"\n\n**{REVIEW_LABEL}**: checked ", c("event_id"), "\n",
    )
    return made.withColumns({"front_matter": front, "body": body})


def mysteries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every turn as a mystery; those of odd turns have a heading and no title."""
    number = (5001 + F.col("conv_id") % 30).cast("int")
    chapter = F.concat(F.lit("ch"), F.format_string("%04d", number))
    asked = table(spark, sf_dir, "conversations").withColumn("chapter", chapter)
    name = text("c", F.col("conv_id"), "_t", F.col("turn"))
    return asked.select(
        "conv_id", "turn", "chapter", F.col("text").alias("question"), name.alias("heading"),
        F.when(F.col("turn") % 2 == 0, name).alias("title"),
        text("MY_", F.col("chapter"), "_", name).alias("mystery_id"), F.col("chapter").alias("spoiler_after"),
    )


def chapters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fifty chapters out of part sizes; those past the observed days are empty on purpose."""
    number = (5000 + F.col("p_size")).cast("int")
    code = F.concat(F.lit("ch"), F.format_string("%04d", number))
    listed = table(spark, sf_dir, "part").select(code.alias("chapter")).distinct()
    return listed.withColumns(
        {
            "title": text("Chapter ", F.col("chapter")),
            "heading": F.when(F.col("chapter") < "ch5030", text("Part of ", F.col("chapter"))),
            "breadcrumb": text("up from ", F.col("chapter")),
        }
    )


def references(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys = observations(spark, sf_dir).select("k").distinct()
    return keys.select(
        text("ME_key_", F.col("k")).alias("ref_id"), text("key_", F.col("k")).alias("canonical_name")
    )


def entity_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per user: its first key names the representative, its first type the confidence."""
    first = observations(spark, sf_dir).groupBy("subject").agg(
        F.min_by(F.struct("k", "event_type"), "event_id").alias("f")
    )
    confidence = F.when(F.col("f.event_type") == "error", UNVERIFIED).when(
        F.col("f.event_type") == "signup", SAME_SPELLING
    )
    return first.select(
        F.col("subject").alias("name"), text("user_", F.col("f.k")).alias("representative"),
        confidence.otherwise(EXPLICIT).alias("confidence"),
    )


def document_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as pages: language is the layer and source the section."""
    page = text("D_", F.col("doc_id"))
    return table(spark, sf_dir, "documents").select(
        "doc_id", page.alias("page_id"), F.col("lang").alias("layer"), F.col("source").alias("section"),
        text(F.col("lang"), "/", F.col("source"), "/", page, ".md").alias("path"), "text", "n_chars",
    )


def ledger_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Document pages with a link, whose target must survive, and a protected block around them."""
    body = text(
        "[[the_", F.col("doc_id"), "|then ", F.col("layer"), "]]\n", F.col("text"),
        "\n<!-- AUTO-GENERATED:l2ref -->\nthe ", F.col("section"), "\n<!-- /AUTO-GENERATED:l2ref -->",
    )
    return document_pages(spark, sf_dir).withColumn("body", body)


def full_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Document pages with front matter, except those in Spanish, which have none."""
    front = text("---\nid: ", F.col("page_id"), '\nsource: "', F.col("section"), '"\n---\n')
    head = F.when(F.col("layer") == "es", F.lit("")).otherwise(front)
    return document_pages(spark, sf_dir).withColumn("text", text(head, F.col("text")))


def web_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Crawled pages with their anchors written as wikilinks (``body``) or Markdown (``md``)."""
    html = F.col("html")
    return table(spark, sf_dir, "pages").select(
        "page_id", "url", "html",
        F.regexp_extract("url", r"example\.([a-z]+)/", 1).alias("layer"),
        text('subject: "[[', F.col("url"), ']]"').alias("front_matter"),
        F.regexp_replace(html, ANCHOR, "[[$1|$2]]").alias("body"),
        F.regexp_replace(html, ANCHOR, "[$2]($1)").alias("md"),
        F.regexp_replace(
            F.regexp_replace(html, ANCHOR, "[$2]($1/index.md)"), "<footer>", "[up](../the/index.md) \n"
        ).alias("indexed"),
    )


def known_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ids that exist for link checks: every word of the benchmark passages."""
    listed = F.explode(F.split(F.col("text"), r"\s+"))
    return table(spark, sf_dir, "benchmark").select(listed.alias("target")).filter("target <> ''").distinct()


def words_shown(pages: DataFrame) -> DataFrame:
    """Ids per layer: every word that a crawled page of the layer shows."""
    words = F.explode(F.split(F.regexp_replace("html", r"<[^>]*>", " "), r"\s+"))
    return pages.select("layer", words.alias("page_id")).filter("page_id <> ''")


def reference_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages that print a backlink count; capitalised targets were unlinked earlier."""
    targets = F.regexp_extract_all("html", F.lit(ANCHOR), F.lit(1))
    bullets = F.transform(
        targets,
        lambda t: F.when(t.rlike("^[A-Z]"), text("- ", t, " — x")).otherwise(text("- [[", t, "]] — x")),
    )
    return table(spark, sf_dir, "pages").select(
        text("ME_", F.col("page_id")).alias("page_id"),
        text("# page\n\n", BACKLINK_HEADING, F.size(targets), BACKLINK_HEADING_END + "\n\n",
             F.array_join(bullets, "\n"), "\n").alias("body"),
    )


def episode_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One episode page per observation; errors show another order and signups miss an element."""
    c = F.col
    made = observations(spark, sf_dir, spread=True)
    listed = [
        text("E_char_", c("subject")), text("E_term_key_", c("k")), text("E_item_user_", c("k")),
        text("E_item_key_", c("para")),
    ]
    front = text(
        "schema_version: '5.1'\nid: O_", c("event_id"), "_summary\ntype: episode\ntitle: summary\nchapter: ",
        c("chapter"), "\ncharacters:\n- '[[", listed[0], "]]'\nterminology:\n- '[[", listed[1],
        "]]'\norganizations:\nitems:\n- '[[", listed[2], "]]'\n- '[[", listed[3],
        "]]'\nmotifs: []\narc: '[[ARC_01_first]]'",
    )
    bullets = [text("- [[", e, "]]\n") for e in listed]
    shown = (
        F.when(c("event_type") == "error", text(bullets[1], bullets[0], bullets[2], bullets[3]))
        .when(c("event_type") == "signup", text(bullets[0], bullets[1], bullets[2]))
        .when(c("event_type") == "view", text(bullets[0], "- ", listed[1], "\n", bullets[2], "- ", listed[3], " \n"))
        .otherwise(text(*bullets))
    )
    body = text("# ", c("chapter"), "\n\n## このエピソードの要素\n\n", shown)
    return made.select("event_id", "chapter", front.alias("front_matter"), body.alias("body"))


def stub_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spanish pages still hold the memo placeholder; ``lines`` lists the line ends of a page."""
    memo = F.when(F.col("layer") == "es", text("\n## メモ\n\n", PLACEHOLDERS[3])).otherwise("")
    return document_pages(spark, sf_dir).select(
        "page_id", text(F.col("text"), memo).alias("body"),
        F.regexp_extract_all("text", F.lit(r"\n"), F.lit(0)).alias("lines"),
    )


def centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One query vector per label: the mean of its vectors, taken position by position."""
    cells = table(spark, sf_dir, "embeddings").select(
        F.col("label").cast("bigint").alias("query_id"), F.posexplode("embedding").alias("at", "v")
    )
    means = cells.groupBy("query_id", "at").agg(F.avg(F.col("v").cast("double")).alias("mean"))
    # As many entries per query as a vector has positions.
    listed = means.groupBy("query_id").agg(F.sort_array(F.collect_list(F.struct("at", "mean"))).alias("m"))
    return listed.select("query_id", F.transform("m", lambda x: x["mean"]).alias("vector"))


def vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "embeddings").select("vec_id", F.col("embedding").alias("vector"))


def text_queries(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "benchmark").select(
        F.col("item_id").alias("query_id"), F.col("text").alias("query")
    )
