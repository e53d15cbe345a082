"""The registered queries of the training-data operators and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from fieldreports.llm import (
    decontaminate, importance_resampling, jaccard_join, language_id, line_dedup, mixing, periodic_runs, pseudonyms,
    quality_classifier, quality_rules, secrets, simhash_join, substring_dedup,
)


# A deployment passes its own key; the registered query needs a stated one.
PSEUDONYM_KEY = "registered-query-key"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.line_report(table(spark, sf_dir, "documents"), blocks=True)


def op2_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pseudonyms.pseudonymise(table(spark, sf_dir, "documents"), key=PSEUDONYM_KEY)


def op3_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contamination_report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.substring_report(table(spark, sf_dir, "documents"))


def op5_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.secret_spans(table(spark, sf_dir, "documents"))


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.language_report(table(spark, sf_dir, "documents"))


def op7_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_classifier.quality_report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.jaccard_classes(table(spark, sf_dir, "documents"))


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"))


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.quality_rules(table(spark, sf_dir, "documents"))


def op11_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return importance_resampling.importance_sample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).select(
        "doc_id", "n_features", "weight", "score", "rank")


def op12_simhash_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_join.simhash_groups(table(spark, sf_dir, "documents"))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic_runs.periodic_runs(table(spark, sf_dir, "documents"), rewrite=periodic_runs.planted_order).select(
        "doc_id", "n_runs", "start", "length", "period", "exponent_milli", "n_dropped", "runs_sha256", "collapsed_sha256")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_line_dedup": op1_line_dedup,
    "op2_pseudonyms": op2_pseudonyms,
    "op3_decontaminate": op3_decontaminate,
    "op4_substring_dedup": op4_substring_dedup,
    "op5_secret_scan": op5_secret_scan,
    "op6_language_id": op6_language_id,
    "op7_quality_classifier": op7_quality_classifier,
    "op8_quality_rules": op8_quality_rules,
    "op9_jaccard_join": op9_jaccard_join,
    "op10_mixing": op10_mixing,
    "op11_importance_resampling": op11_importance_resampling,
    "op12_simhash_join": op12_simhash_join,
    "op13_periodic_runs": op13_periodic_runs,
}

_OP3_SQL = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
i AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
iw AS (
  SELECT DISTINCT item_id, m, list_aggregate(list_slice(w, s, s + m - 1), 'string_agg', ' ') AS k
  FROM (SELECT item_id, w, least(len(w), 10) AS m, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS s FROM i WHERE len(w) > 0)),
dw AS (
  SELECT doc_id, s, m, list_aggregate(list_slice(w, s, s + m - 1), 'string_agg', ' ') AS k
  FROM (SELECT doc_id, w, m, unnest(range(1, len(w) - m + 2)) AS s FROM d, (SELECT DISTINCT m FROM iw) WHERE len(w) >= m)),
hit AS (SELECT doc_id, s, dw.m, item_id FROM dw JOIN iw USING (m, k)),
words AS (SELECT doc_id, count(DISTINCT p) AS n_hit
  FROM (SELECT doc_id, unnest(range(s, s + m)) AS p FROM (SELECT DISTINCT doc_id, s, m FROM hit)) GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n_items, string_agg(i, ',' ORDER BY i) AS ids
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS i FROM hit) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)
"""

_OP4_SQL = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
k AS (SELECT doc_id, s, array_to_string(w[s:s + 12], ' ') AS k
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 11)) AS s FROM d WHERE len(w) >= 13)),
f AS (SELECT k, min(doc_id) AS first FROM k GROUP BY k HAVING min(doc_id) < max(doc_id)),
r AS (SELECT DISTINCT doc_id, unnest(range(s, s + 13)) AS p FROM k JOIN f USING (k) WHERE first < doc_id),
rl AS (SELECT doc_id, list(p) AS gone FROM r GROUP BY doc_id),
kept AS (SELECT d.doc_id, len(w) AS n, coalesce(len(gone), 0) AS g,
    array_to_string([w[p] for p in range(1, len(w) + 1) if gone IS NULL OR NOT list_contains(gone, p)], ' ') AS t
  FROM d LEFT JOIN rl USING (doc_id))
SELECT doc_id, CAST(n AS BIGINT) AS n_words, CAST(g AS BIGINT) AS n_removed, sha256(t) AS kept_sha256 FROM kept
"""

_OP10_SQL = r"""
WITH RECURSIVE d AS (
  SELECT * FROM (SELECT doc_id, source, CAST(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) AS BIGINT) AS n_tokens FROM documents)
  WHERE n_tokens > 0),
s AS (SELECT source, CAST(sum(n_tokens) AS BIGINT) AS tokens FROM d GROUP BY source),
t AS (SELECT CAST(sum(tokens) AS BIGINT) AS total, count(*) AS n FROM s),
sh AS (SELECT list(tokens / total) AS p, any_value(n) AS n FROM s, t),
even AS (
  SELECT 0 AS r, 0::DOUBLE AS lo, 1::DOUBLE AS hi
  UNION ALL
  SELECT r + 1, CASE WHEN a IS NULL THEN lo WHEN a = 32 THEN hi ELSE lo + (hi - lo) * a / 32 END,
    CASE WHEN a IS NULL THEN lo WHEN a = 32 THEN hi ELSE lo + (hi - lo) * (a + 1) / 32 END
  FROM (SELECT r, lo, hi, list_max(list_filter(range(0, 33), lambda i:
      ln(list_sum(list_transform(p, lambda x: pow(x, lo + (hi - lo) * i / 32))))
      - list_sum(list_transform(p, lambda x: pow(x, lo + (hi - lo) * i / 32) * ln(pow(x, lo + (hi - lo) * i / 32))))
        / list_sum(list_transform(p, lambda x: pow(x, lo + (hi - lo) * i / 32)))
      >= {entropy}::DOUBLE * ln(n))) AS a FROM even, sh WHERE r < 6)),
rare AS (
  SELECT 0 AS r, 0::DOUBLE AS lo, 1::DOUBLE AS hi
  UNION ALL
  SELECT r + 1, CASE WHEN a IS NULL THEN lo WHEN a = 32 THEN hi ELSE lo + (hi - lo) * a / 32 END,
    CASE WHEN a IS NULL THEN lo WHEN a = 32 THEN hi ELSE lo + (hi - lo) * (a + 1) / 32 END
  FROM (SELECT r, lo, hi, list_max(list_filter(range(0, 33), lambda i:
      {budget}::DOUBLE * list_max(list_transform(p, lambda x: pow(x, lo + (hi - lo) * i / 32) / x))
        / list_sum(list_transform(p, lambda x: pow(x, lo + (hi - lo) * i / 32))) > {repeats}::DOUBLE)) AS a FROM rare, sh WHERE r < 6)),
x AS (SELECT greatest((SELECT lo FROM even WHERE r = 6), (SELECT hi FROM rare WHERE r = 6)) AS x),
w AS (SELECT source, tokens, pow(tokens / total, x) / (SELECT sum(pow(tokens / total, x)) FROM s, t, x) AS weight, total FROM s, t, x),
b AS (SELECT source, CAST(budget // tokens AS INTEGER) AS epochs, budget % tokens AS rest
  FROM (SELECT *, CAST(floor({budget}::DOUBLE * total * weight) AS BIGINT) AS budget FROM w)),
u AS (SELECT doc_id, d.source, n_tokens, epochs, rest,
    CAST('0x' || substr(md5('{seed}:' || epochs || ':' || doc_id), 1, 15) AS BIGINT) AS u
  FROM d JOIN b ON d.source IS NOT DISTINCT FROM b.source),
c AS (SELECT doc_id, source, n_tokens, epochs + CASE WHEN sum(n_tokens) OVER (PARTITION BY source ORDER BY u, doc_id, n_tokens) <= rest
    THEN 1 ELSE 0 END AS copies FROM u),
e AS (SELECT doc_id, source, n_tokens, CAST(unnest(range(0, copies)) AS INTEGER) AS epoch FROM c),
k AS (SELECT *, CAST('0x' || substr(md5('{seed}:' || epoch || ':' || doc_id), 1, 15) AS BIGINT) AS order_key FROM e)
SELECT *, CAST(order_key >> 48 AS INTEGER) AS block FROM k
""".replace("{entropy}", str(mixing.ENTROPY_SHARE)).replace("{repeats}", str(mixing.MAX_REPEATS)).replace(
    "{budget}", str(mixing.BUDGET_SHARE)).replace("{seed}", mixing.SEED)

# The table of the checksum (one entry per byte value) comes from its polynomial; each word is reduced byte by byte.
_OP11_SQL = r"""
WITH tab AS (SELECT list(c ORDER BY i) AS tab FROM (
  SELECT i, list_reduce([i]::BIGINT[] || range(0, 8), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS c
  FROM (SELECT unnest(range(0, 256)) AS i))),
d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (
  SELECT regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
dw AS (SELECT doc_id, f, count(*) AS n FROM (SELECT doc_id, unnest(w) AS f FROM d) GROUP BY doc_id, f),
bw AS (SELECT f, count(*) AS n FROM (SELECT unnest(w) AS f FROM b) GROUP BY f),
v AS (SELECT f, xor(list_reduce([4294967295]::BIGINT[] || list_transform(range(0, strlen(f)),
      lambda j: CAST('0x' || substr(hex(f), CAST(2 * j + 1 AS BIGINT), 2) AS BIGINT)),
      lambda c, x: xor(c >> 8, tab[CAST((xor(c, x) & 255) + 1 AS BIGINT)])), 4294967295) % {buckets} AS bucket
  FROM (SELECT f FROM dw UNION SELECT f FROM bw), tab),
s AS (SELECT bucket, sum(n) AS s FROM dw JOIN v USING (f) GROUP BY bucket),
t AS (SELECT bucket, sum(n) AS t FROM bw JOIN v USING (f) GROUP BY bucket),
g AS (SELECT bucket, CAST(floor(1000 * ln((coalesce(t, 0) + 1)::DOUBLE * (all_s + {buckets})::DOUBLE
      / ((coalesce(s, 0) + 1)::DOUBLE * (all_t + {buckets})::DOUBLE))) AS BIGINT) AS gain
  FROM (SELECT DISTINCT bucket FROM v) LEFT JOIN s USING (bucket) LEFT JOIN t USING (bucket),
    (SELECT coalesce(sum(n), 0) AS all_s FROM dw), (SELECT coalesce(sum(n), 0) AS all_t FROM bw)),
w AS (SELECT doc_id, sum(n * gain) AS weight FROM dw JOIN v USING (f) JOIN g USING (bucket) GROUP BY doc_id),
x AS (
  SELECT doc_id, CAST(len(w) AS BIGINT) AS n_features, CAST(coalesce(weight, 0) AS BIGINT) AS weight,
    CAST(coalesce(weight, 0) + floor(-1000 * ln(-ln((CAST('0x' || substr(sha256('{seed}:' || doc_id), 1, 8) AS BIGINT) + 0.5::DOUBLE)
      / 4294967296::DOUBLE))) AS BIGINT) AS score
  FROM d LEFT JOIN w USING (doc_id)),
r AS (SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS r, count(*) OVER () AS n FROM x WHERE n_features >= {least})
SELECT x.*, CASE WHEN r <= {share} * n // 100 THEN r END AS rank FROM x LEFT JOIN r USING (doc_id)
""".replace("{buckets}", str(importance_resampling.BUCKETS)).replace("{seed}", importance_resampling.SEED).replace(
    "{least}", str(importance_resampling.LEAST_WORDS)).replace("{share}", str(importance_resampling.SHARE_PERCENT))

ORACLE_SQL: dict[str, str] = {"op3_decontaminate": _OP3_SQL, "op4_substring_dedup": _OP4_SQL, "op10_mixing": _OP10_SQL,
                              "op11_importance_resampling": _OP11_SQL}
