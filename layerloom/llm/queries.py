"""The registered queries of the training-data operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from layerloom.llm import (
    curriculum,
    divergence,
    fill_middle,
    latent,
    line_dedup,
    pii,
    ring,
    secret_scan,
    simhash,
    toxicity,
    treap_search,
    url_rules,
    weak_labels,
)
from layerloom.llm.common import documents


def op1_quality_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return weak_labels.classify(documents(spark, sf_dir))


def op2_simhash_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(documents(spark, sf_dir))


def op3_toxicity_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.line_table(documents(spark, sf_dir))


def op5_ring_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ring.shard_table(documents(spark, sf_dir))


def op6_secret_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.secret_table(documents(spark, sf_dir))


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.judge(documents(spark, sf_dir), keep=["doc_id"]).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


def op8_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return curriculum.mix_table(documents(spark, sf_dir))


def op9_private_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.span_table(documents(spark, sf_dir))


def op10_benchmark_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row for each document and benchmark item that it holds."""
    return latent.leaks(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def op11_url_verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    return url_rules.judge(pages, url_rules.rule_table(spark, url_rules.RULES))


def op12_treap_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return treap_search.search(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def op13_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fill_middle.digests(fill_middle.fill_in_middle(documents(spark, sf_dir)))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_quality_scores,
        op2_simhash_clusters,
        op3_toxicity_scores,
        op4_line_dedup,
        op5_ring_shards,
        op6_secret_spans,
        op7_quality_rules,
        op8_source_mix,
        op9_private_spans,
        op10_benchmark_leaks,
        op11_url_verdicts,
        op12_treap_search,
        op13_fill_in_middle,
    )
}

# The mix in SQL: sources by the ratio of their stop to their weight fill up first; the level of the
# others is what is left over their weights.
MIX_SQL = r"""WITH sized AS (
  SELECT doc_id, source IS NULL AS none, coalesce(source, '') AS s,
    CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
    md5(concat_ws('/', CAST(doc_id AS VARCHAR), coalesce(text, ''))) AS o FROM documents),
totals AS (SELECT none, s, CAST(sum(size) AS BIGINT) AS source_size FROM sized GROUP BY none, s),
weighed AS (
  SELECT none, s, source_size, 2.0::DOUBLE * source_size AS stop,
    CAST([5, 2, 1][n % 3 + 1] AS DOUBLE) AS w, CAST([1.5, 1.0, 0.5][n % 3 + 1] AS DOUBLE) AS a
  FROM (SELECT *, row_number() OVER (ORDER BY none, s) - 1 AS n FROM totals)),
levels AS (
  SELECT *, stop / w AS ratio, row_number() OVER by_ratio AS place,
    (1.5::DOUBLE * (SELECT sum(source_size) FROM totals)
      - coalesce(sum(stop) OVER (by_ratio ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
    / sum(w) OVER (by_ratio ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM weighed WINDOW by_ratio AS (ORDER BY stop / w, none, s)),
goals AS (
  SELECT none, s, source_size, a,
    least(stop, w * (SELECT arg_min(level, place) FROM levels WHERE level <= ratio)) AS target FROM levels),
begun AS (
  SELECT *, CAST(floor(target) AS BIGINT) AS due, CAST(coalesce(sum(size) OVER (PARTITION BY none, s
    ORDER BY o, doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS first
  FROM sized JOIN goals USING (none, s)),
turns AS (
  SELECT *, greatest(least(due - first, size), 0) AS once, greatest(least(due - first - source_size, size), 0) AS again,
    CASE WHEN target > 0 THEN least((first + once / 2) / target, 1) ELSE 0 END AS y FROM begun)
SELECT doc_id, size, source_size, round(target, 6) AS target, CAST(once + again AS BIGINT) AS taken,
  CASE WHEN once = 0 THEN NULL WHEN a = 1 THEN round(y, 9)
    ELSE round((sqrt(greatest(a * a + 4 * (1 - a) * y, 0)) - a) / (2 * (1 - a)), 9) END AS first_position
FROM turns"""

URL_SQL = r"""WITH rules(rule_host, rule_path, decided) AS (
  VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'), ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')),
rest AS (
  SELECT page_id, url, CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
parts AS (
  SELECT row_number() OVER () AS n, page_id,
    translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM rest),
fits AS (
  SELECT n, arg_max(rule_host || rule_path, length(rule_host || rule_path)) AS rule, arg_max(decided, length(rule_host || rule_path)) AS verdict
  FROM parts JOIN rules ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path) GROUP BY n)
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM parts LEFT JOIN fits USING (n)"""

SEARCH_SQL = r"""WITH listed AS (
  SELECT row_number() OVER () AS row, doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms FROM documents),
sizes AS (SELECT row, doc_id, CAST(len(terms) AS BIGINT) AS n FROM listed WHERE len(terms) > 0),
whole AS (SELECT CAST(count(*) AS BIGINT) AS docs, CAST(sum(n) AS BIGINT) AS terms FROM sizes),
counted AS (SELECT row, term, CAST(count(*) AS BIGINT) AS tf FROM (SELECT row, unnest(terms) AS term FROM listed) GROUP BY ALL),
asked AS (SELECT DISTINCT item_id, unnest(regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark),
weights AS (
  SELECT term, CAST(floor(1000 * ln((2 * CAST(docs AS DOUBLE) + 2) / (2 * CAST(df AS DOUBLE) + 1))) AS BIGINT) AS w
  FROM (SELECT term, count(*) AS df FROM counted GROUP BY term), whole),
scores AS (
  SELECT item_id, row, doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * docs) // terms)))) AS BIGINT) AS score
  FROM asked JOIN weights USING (term) JOIN counted USING (term) JOIN sizes USING (row), whole GROUP BY ALL),
ranked AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST) AS rank FROM scores WHERE score > 0)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM ranked WHERE rank <= 10"""

MIDDLE_SQL = r"""WITH cut AS (
  SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\n]*\n|[^\n]+') AS lines,
    sha256('7:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS hash FROM documents),
drawn AS (
  SELECT *, CAST(len(lines) AS BIGINT) AS n,
    CAST('0x' || hash[1:8] AS BIGINT) AS h1, CAST('0x' || hash[9:16] AS BIGINT) AS h2, CAST('0x' || hash[25:32] AS BIGINT) AS h4 FROM cut),
parts AS (
  SELECT *, CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') THEN 'plain'
      WHEN h4 % 100 < 50 THEN 'spm' ELSE 'psm' END AS form,
    array_to_string(lines[1:least(h1 % (n + 1), h2 % (n + 1))], '') AS p,
    array_to_string(lines[least(h1 % (n + 1), h2 % (n + 1)) + 1:greatest(h1 % (n + 1), h2 % (n + 1))], '') AS m,
    array_to_string(lines[greatest(h1 % (n + 1), h2 % (n + 1)) + 1:], '') AS s FROM drawn)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(p) END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
    ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256, sha256(text) AS restored_sha256 FROM parts"""

ORACLES: dict[str, str] = {
    "op8_source_mix": MIX_SQL,
    "op11_url_verdicts": URL_SQL,
    "op12_treap_search": SEARCH_SQL,
    "op13_fill_in_middle": MIDDLE_SQL,
}
