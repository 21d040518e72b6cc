"""The L1 to L2 pipeline: rewritten body, audit section, parent and run in the front matter."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from layerloom.operators import ledger as lg
from layerloom.operators.lineage import l2_front_matter
from layerloom.operators.structure import split_front_matter


def build_l2(pages: DataFrame, ledger: DataFrame, run: str) -> DataFrame:
    """L2 pages of L1 pages (``path``, ``page_id``, ``section``, ``text``).

    A projection over the pages: each row carries its own audit and notes, and nothing is
    shuffled as long as the ledger is inlined.
    """
    split = split_front_matter(pages)
    done = lg.normalize_names(split, ledger, "path", "body")
    head = l2_front_matter(F.col("front_matter"), F.col("path"), F.lit(run))
    section = lg.render_audit(F.col("audit"), F.col("notes"), F.lit(run))
    # A page without front matter stays without one.
    text = F.when(
        F.col("front_matter").isNotNull(),
        F.concat(F.lit("---\n"), head, F.lit("\n---\n"), F.col("body"), section),
    ).otherwise(F.concat(F.col("body"), section))
    return done.withColumns(
        {
            "normalized_from": F.col("path"),
            "path": F.regexp_replace("path", r"^[^/]+/", "l2/"),
            "layer": F.lit("l2"),
            "l2_run": F.lit(run),
            "text": text,
        }
    )
