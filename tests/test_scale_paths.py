"""The same queries with every size limit set so low that the ways for large data are taken."""

import pytest
import test_oracles
from test_oracles import database, plain  # noqa: F401

from layerloom.functions import skew
from layerloom.operators import blocks, cells, ledger, name_search

# Queries that join, number or replace; the others do not depend on a limit.
AFFECTED = [
    "alias_groups", "arc_of_chapter", "audit_rows", "audit_totals", "backlinks", "batches", "bm25_topk", "bm25_topk_indexed",
    "build_layer", "changed_pages", "change_log", "canonical_entities", "chapter_index", "chapter_listing", "dead_links", "ground_quotes",
    "inverted_index", "ledger_chains", "lint_findings", "progress", "render_chapter", "render_reference",
    "normalize_names_large", "resolve_links", "resolve_links_in_layer", "section_index", "unlink_cites", "unlink_missing", "unlink_missing_in_layer",
    "unresolved_notes", "vector_topk_indexed",
]


@pytest.mark.parametrize("name", AFFECTED)
def test_large_data_ways_give_the_same(spark, sf_dir, database, name, monkeypatch):  # noqa: F811
    monkeypatch.setattr(skew, "BROADCAST_ROWS", 0)
    monkeypatch.setattr(skew, "HOT_ROWS", 5)
    monkeypatch.setattr(skew, "GROUP_ROWS", 7)
    monkeypatch.setattr(blocks, "RANGE_POSTINGS", 500)
    monkeypatch.setattr(blocks, "BLOCK_POSTINGS", 3)
    monkeypatch.setattr(cells, "CELL_ROWS", 40)
    monkeypatch.setattr(ledger, "INLINE_NAMES", 0)
    monkeypatch.setattr(name_search, "SHARD_NAMES", 5_000 if name == "normalize_names_large" else 2)
    mine = test_oracles.QUERIES[name](spark, sf_dir).toPandas()
    theirs = database.execute(test_oracles.ORACLES[name]).fetchdf()
    assert plain(mine) == plain(theirs)
