"""URL allow and block rules by a sort-merge range join.

The canonical key of an address is its host read from the right, label by label, each label closed by a dot,
then its path: ``www.example.net`` with ``/en/1`` is ``net.example.www./en/1``. A rule's key is a prefix of the
keys it fits, so a rule is the interval of keys that begin with its own, and intervals nest or are apart. A
rule also fits subdomains: an address gets one key per host suffix of as many labels as any rule has.

Keys and rules are dealt into ranges, sorted inside them, and swept once: rules stand on a stack while the
keys begin with theirs, and the top of the stack is the longest rule that fits. What is open where a range
begins is found from one row per range (its first key and its open rules at the end, which are prefixes of
each other), so no task sees more than its range and one nested chain of rules. Addresses are made distinct
first; they meet the pages again in a join that cuts hot addresses into shares.

A null url, or one without ``://``, has an empty host and path. Rows of rules with a null host, path or
verdict do not count; of rules alike in host and path the one with the smaller verdict does (allow). Repeated
pages stay; an empty table gives an empty result; other columns of the pages do not matter.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from layerloom.functions.skew import join_dimension
from layerloom.llm.common import durable, pick, travels

travels(__name__)

# The rules of the registered query: host, path, verdict.
RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]
# What a url gets that no rule fits.
OTHERWISE = "allow"
# Bytes of keys a range holds about.
RANGE_BYTES = 64 * 1024 * 1024
# The letters that are lower-cased in a host.
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def parts_of(url: Column) -> tuple[Column, Column]:
    """Host and path of a url; both empty where there is no ``://``."""
    at = F.coalesce(F.instr(url, "://"), F.lit(0))
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"\A[^/?#]*", 0), UPPER, LOWER)
    return host, F.regexp_extract(rest, r"\A[^/?#]*([^?#]*)", 1)


def _labels(host: Column) -> Column:
    return F.split(host, r"\.")


def _key(labels: Column, path: Column) -> Column:
    """The last labels first, each closed by a dot, then the path."""
    return F.concat(F.array_join(F.reverse(labels), "."), F.lit("."), path)


def rule_table(spark: SparkSession, rules: list[tuple[str, str, str]]) -> DataFrame:
    """Rules given as a list, as the rows the operator takes."""
    return spark.createDataFrame(rules, "host string, path string, verdict string")


def _distinct_rules(rules: DataFrame) -> DataFrame:
    host = F.translate("host", UPPER, LOWER).alias("host")
    whole = rules.select(host, "path", "verdict").filter("host IS NOT NULL AND path IS NOT NULL AND verdict IS NOT NULL")
    # Others fit no url: a host ends before these characters, a path is empty or begins with a slash.
    whole = whole.filter(~F.col("host").rlike("[/?#]") & ((F.col("path") == "") | F.startswith("path", F.lit("/"))))
    return whole.groupBy("host", "path").agg(F.min("verdict").alias("verdict"))


def _swept(rows: DataFrame, schema: str, start: dict[int, list[tuple]] | None) -> DataFrame:
    """Sweep sorted rows (range, key, kind, host, path, rule, verdict).

    Without ``start``: one row per range with its first key and the rules open at its end. With it: a row
    per key that a rule fits, the sweep of a range beginning with the rules that ``start`` holds for it.
    """
    summary = start is None

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stack: list[tuple] | None = None
        first, number = None, None
        names = schema.replace(" string", "").replace(" bigint", "").split(", ")
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("range", "key", "kind", "host", "path", "rule", "verdict")]
            out = []
            for here, key, kind, host, path, rule, verdict in zip(*columns):
                if stack is None:
                    number, first = here, key
                    stack = [] if summary else list(start.get(here, []))
                while stack and not key.startswith(stack[-1][0]):
                    stack.pop()
                if kind == 0:
                    stack.append((key, rule, verdict))
                elif stack and not summary:
                    out.append((host, path, *stack[-1][1:]))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in zip(*out)], names=names)
        if summary and stack is not None:
            # A range without an open rule still tells its first key.
            rows = [(number, first, *r) for r in stack or [(None, None, None)]]
            kinds = [pa.int64()] + [pa.string()] * 4
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)

    return rows.mapInArrow(work, schema)


def _carried(summary: list) -> dict[int, list[tuple]]:
    """The rules open at the begin of every range, from the ranges before it."""
    ranges: dict[int, tuple[str, list[tuple]]] = {}
    for r in summary:
        first, own = ranges.setdefault(r["range"], (r["first"], []))
        if r["key"] is not None:
            own.append((r["key"], r["rule"], r["verdict"]))
    carried, open_rules = {}, []
    for number in sorted(ranges):
        first, own = ranges[number]
        carried[number] = open_rules = [r for r in open_rules if first.startswith(r[0])]
        # A rule that no longer holds where the next range begins falls out there.
        open_rules = [*open_rules, *sorted(own, key=lambda r: len(r[0]))]
    return carried


def fitting_rules(addresses: DataFrame, rules: DataFrame) -> DataFrame:
    """``host``, ``path``, ``rule`` and ``verdict`` of distinct addresses that a rule fits, by their longest rule."""
    rules = _distinct_rules(rules)
    sizes = rules.agg(F.max(F.size(_labels(F.col("host")))).alias("labels"), F.max(F.length("path")).alias("path")).first()
    if sizes["labels"] is None:
        return addresses.limit(0).select("host", "path", F.lit("").alias("rule"), F.lit("").alias("verdict"))
    # A rule sees no more of a path than its own length.
    labels, cut = _labels(F.col("host")), F.substring("path", 1, sizes["path"])
    suffixes = F.transform(
        F.sequence(F.lit(1), F.least(F.size(labels), F.lit(sizes["labels"]))),
        lambda k: _key(F.slice(labels, F.size(labels) - k + 1, k), cut),
    )
    asked = addresses.select(F.explode(suffixes).alias("key"), F.lit(1).alias("kind"), "host", "path", F.lit(None).cast("string").alias("rule"), F.lit(None).cast("string").alias("verdict"))
    named = rules.select(
        _key(_labels(F.col("host")), F.col("path")).alias("key"), F.lit(0).alias("kind"), F.lit(None).cast("string").alias("host"),
        F.lit(None).cast("string").alias("path"), F.concat("host", "path").alias("rule"), "verdict",
    )
    together = asked.unionByName(named)
    size = together.agg(F.coalesce(F.sum(F.octet_length("key") + F.octet_length(F.coalesce("path", F.lit("")))), F.lit(0))).first()[0]
    ranges = max(int(addresses.sparkSession.conf.get("spark.sql.shuffle.partitions")), size // RANGE_BYTES)
    # Equal keys may be many: host and path spread them over ranges, a rule comes before all of them.
    order = ["key", "kind", "host", "path"]
    ordered = together.repartitionByRange(ranges, *order).sortWithinPartitions(*order)
    # Both sweeps must see the same ranges, so these are kept.
    kept = durable(ordered.withColumn("range", F.spark_partition_id().cast("bigint")))
    ends = _swept(kept, "range bigint, first string, key string, rule string, verdict string", None).collect()
    found = _swept(kept, "host string, path string, rule string, verdict string", _carried(ends))
    longest = F.struct(F.length("rule").alias("n"), F.length(F.substring_index("rule", "/", 1)).alias("host"), "rule", "verdict")
    best = found.groupBy("host", "path").agg(F.max(longest).alias("r"))
    return best.select("host", "path", "r.rule", "r.verdict")


def judge(pages: DataFrame, rules: DataFrame, otherwise: str = OTHERWISE) -> DataFrame:
    """``page_id``, ``host``, ``path``, ``rule`` and ``verdict`` of every page.

    A rule (``host``, ``path``, ``verdict``) fits its host and all subdomains where the path begins with its
    path. The longest rule decides, by code points of host and path; of rules of one length the one with the
    longer host, then the larger name. Where none fits, ``rule`` is null and the verdict is ``otherwise``.
    """
    host, path = parts_of(pick(pages, "url", "string"))
    read = pages.select(pick(pages, "page_id", "bigint"), host.alias("host"), path.alias("path"))
    fits = fitting_rules(read.select("host", "path").distinct(), rules)
    joined = join_dimension(read, fits, ["host", "path"], "left", salt_by=["page_id"])
    return joined.select("page_id", "host", "path", "rule", F.coalesce("verdict", F.lit(otherwise)).alias("verdict"))


def allowed(pages: DataFrame, rules: DataFrame, otherwise: str = OTHERWISE) -> DataFrame:
    """The pages that their rule, or ``otherwise``, allows, with all their columns.

    Pages with the same address share a verdict, so whole rows meet the blocked addresses alone.
    """
    host, path = parts_of(pick(pages, "url", "string"))
    addresses = pages.select(host.alias("host"), path.alias("path")).distinct()
    judged = addresses.join(fitting_rules(addresses, rules), ["host", "path"], "left")
    blocked = judged.filter(F.coalesce("verdict", F.lit(otherwise)) != "allow").select(F.array("host", "path").alias("_address"))
    row = pages.select(F.array(host, path).alias("_address"), F.struct(*[F.col(f"`{c}`") for c in pages.columns]).alias("_page"))
    kept = join_dimension(row, blocked, ["_address"], "left_anti")
    return kept.select("_page.*")
