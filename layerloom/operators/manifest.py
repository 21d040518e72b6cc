"""A manifest as a tree of digests, section under layer under corpus, and the difference of two of them.

A node's digest is that of the sum of its children's digests, so it depends on what it holds and not on any
order, and no section is gathered in one task. Two manifests are compared from the root: equal nodes end the
descent, and paths are compared only in sections that differ.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from layerloom.functions.skew import join_dimension
from layerloom.functions.tasks import kept

LEVELS = {"section": ["layer", "section"], "layer": ["layer"], "corpus": []}

# A digest is summed in parts of so many hexadecimal digits; four of them keep 224 of its bits.
PART_DIGITS = 14
PARTS = 4


def leaves(pages: DataFrame, text: str = "text") -> DataFrame:
    """``layer``, ``section``, ``path`` and ``checksum`` of every page."""
    checksum = F.concat(F.lit("sha256:"), F.sha2(F.coalesce(F.col(text), F.lit("")), 256))
    return pages.select("layer", "section", "path", checksum.alias("checksum"))


def _parts(digest: Column) -> list[Column]:
    cut = [F.substring(digest, 1 + PART_DIGITS * n, PART_DIGITS) for n in range(PARTS)]
    return [F.conv(c, 16, 10).cast("decimal(38,0)").alias(f"d{n}") for n, c in enumerate(cut)]


def _digest(*columns: Column) -> Column:
    return F.sha2(F.concat_ws("|", *[F.coalesce(c.cast("string"), F.lit("\u0000")) for c in columns]), 256)


def tree(manifest: DataFrame) -> DataFrame:
    """``level``, ``layer``, ``section``, ``pages`` and ``digest`` of every node; layer and section are null above them."""
    below = manifest.select("layer", "section", F.lit(1).alias("pages"), *_parts(_digest(F.col("path"), F.col("checksum"))))
    nodes = None
    for level, keys in LEVELS.items():
        sums = [F.sum("pages").cast("bigint").alias("pages"), *[F.sum(f"d{n}").cast("decimal(38,0)").alias(f"d{n}") for n in range(PARTS)]]
        found = below.groupBy(*keys).agg(*sums).filter("pages > 0")
        named = [F.col(c) if c in keys else F.lit(None).cast("string").alias(c) for c in ("layer", "section")]
        digest = _digest(*[F.col(k) for k in keys], F.col("pages"), *[F.col(f"d{n}") for n in range(PARTS)])
        made = found.select(F.lit(level).alias("level"), *named, "pages", digest.alias("digest"))
        # A tree has a row per section, so it is kept whole between the levels.
        made = kept(made)
        nodes = made if nodes is None else nodes.unionByName(made)
        below = made.select("layer", "section", "pages", *_parts(F.col("digest")))
    return nodes


def _place(*columns: str) -> Column:
    """Keys as one value; null layers and sections are layers and sections like others."""
    return F.to_json(F.struct(*columns), {"ignoreNullFields": "false"})


def _unequal(old: DataFrame, new: DataFrame, level: str) -> DataFrame:
    """Keys of a level's nodes that differ or that one tree lacks."""
    keys = LEVELS[level]
    sides = [t.filter(F.col("level") == level).select(*keys, F.col("digest").alias(name)) for t, name in ((old, "_old"), (new, "_new"))]
    both = sides[0].unionByName(sides[1], allowMissingColumns=True).groupBy(*keys).agg(F.max("_old").alias("_old"), F.max("_new").alias("_new"))
    return both.filter(~F.col("_old").eqNullSafe(F.col("_new"))).select(*keys)


def unequal_sections(old_tree: DataFrame, new_tree: DataFrame) -> DataFrame:
    """The sections whose pages must be compared, found from the root down."""
    none = new_tree.limit(0).select("layer", "section")
    if not _unequal(old_tree, new_tree, "corpus").count():
        return none
    layers = _unequal(old_tree, new_tree, "layer").select(_place("layer").alias("_place"))
    inside = [
        join_dimension(t.filter("level = 'section'").withColumn("_place", _place("layer")), layers, ["_place"], "left_semi", salt_by=["section"])
        for t in (old_tree, new_tree)
    ]
    return _unequal(*inside, "section")


def manifest_diff(old: DataFrame, new: DataFrame, old_tree: DataFrame | None = None, new_tree: DataFrame | None = None) -> DataFrame:
    """``path``, ``change`` (added, changed or removed), ``before`` and ``after`` checksums.

    ``old`` and ``new`` are ``leaves``; give their stored trees to save reading all of them. A page that moves
    to another section stays one path: it is changed only if its checksum is.
    """
    sections = kept(unequal_sections(old_tree if old_tree is not None else tree(old), new_tree if new_tree is not None else tree(new)))
    place = _place("layer", "section")
    wanted = sections.select(place.alias("_place"))

    def opened(manifest: DataFrame, name: str) -> DataFrame:
        rows = manifest.select("path", F.col("checksum").alias(name), place.alias("_place"))
        return join_dimension(rows, wanted, ["_place"], "left_semi", salt_by=["path"]).drop("_place")

    both = opened(old, "before").join(opened(new, "after"), "path", "full")
    change = F.when(F.col("before").isNull(), "added").when(F.col("after").isNull(), "removed").otherwise("changed")
    return both.filter(~F.col("before").eqNullSafe(F.col("after"))).select("path", change.alias("change"), "before", "after")
