"""The registered queries of this subpackage, with DuckDB SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import decontaminate, hardnegatives, infilling, jaccard, langid, licenses, linededup, mixing, quality, sharding, suffixdedup, tokencounts, toxicity


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(_table(spark, sf_dir, "documents"), 40)


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mix = mixing.plan_mix(_table(spark, sf_dir, "documents"))
    return mix.select("doc_id", "size", "source_size", "target", "taken")


def op3_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licenses.scan_licenses(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "open_choice")


def op4_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.near_duplicates(_table(spark, sf_dir, "documents"))


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality.judge(_table(spark, sf_dir, "documents"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.judge_toxicity(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op7_linededup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = linededup.drop_boilerplate(_table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2(F.coalesce("kept_text", F.lit("")), 256).alias("kept_sha256"))


def op8_suffixdedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixdedup.remove_repeats(_table(spark, sf_dir, "documents"))


def op9_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contamination_report(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op10_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(_table(spark, sf_dir, "documents"))


def op11_infilling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return infilling.infill(_table(spark, sf_dir, "documents"))


def op12_hardnegatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hardnegatives.mine(_table(spark, sf_dir, "embeddings"))


def op13_tokencounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokencounts.count_tokens(_table(spark, sf_dir, "documents"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_sharding": op1_sharding,
    "op2_mixing": op2_mixing,
    "op3_licenses": op3_licenses,
    "op4_jaccard": op4_jaccard,
    "op5_quality": op5_quality,
    "op6_toxicity": op6_toxicity,
    "op7_linededup": op7_linededup,
    "op8_suffixdedup": op8_suffixdedup,
    "op9_decontaminate": op9_decontaminate,
    "op10_langid": op10_langid,
    "op11_infilling": op11_infilling,
    "op12_hardnegatives": op12_hardnegatives,
    "op13_tokencounts": op13_tokencounts,
    "pipeline": pipeline,
}

_MIX_SQL = r"""
WITH d AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
         md5('mix-1|' || coalesce(CAST(doc_id AS VARCHAR), '') || '|' || md5(coalesce(text, ''))) AS k
  FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
r AS (SELECT *, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS i FROM s),
c AS (
  SELECT source, source_size, CASE i % 3 WHEN 0 THEN 3.0::DOUBLE WHEN 1 THEN 1.0::DOUBLE ELSE 2.0::DOUBLE END AS w,
         source_size * 2.0::DOUBLE AS cap, sum(source_size) OVER () * 1.5::DOUBLE AS want
  FROM r),
l AS (
  SELECT *, (want - coalesce(sum(cap) OVER b, 0.0)) / (sum(w) OVER () - coalesce(sum(w) OVER b, 0.0)) AS level
  FROM c WINDOW b AS (ORDER BY cap / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
t AS (
  SELECT source, source_size,
         CASE WHEN cap <= level * w THEN cap ELSE max(CASE WHEN cap > level * w THEN level END) OVER () * w END AS target
  FROM l),
p AS (
  SELECT d.doc_id, d.size, t.source_size, t.target,
         coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY d.k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start,
         CASE WHEN t.source_size > 0 THEN CAST(floor(t.target / t.source_size) AS BIGINT) ELSE 0 END AS epochs
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
       CAST(epochs * size + greatest(0, least(size, CAST(floor(target) AS BIGINT) - epochs * source_size - start)) AS BIGINT) AS taken
FROM p
"""

_QUALITY_SQL = r"""
WITH d AS (
  SELECT doc_id, source, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
base AS (
  SELECT doc_id, source, CAST(len(w) AS BIGINT) AS n_words, CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
         CAST(len(regexp_extract_all(t, '[#*$%&|<>]')) AS BIGINT) AS n_symbols
  FROM d),
lines AS (SELECT doc_id, unnest(string_split(t, chr(10))) AS line FROM d),
dups AS (SELECT doc_id, CAST(count(*) AS BIGINT) AS n_lines, CAST(count(*) - count(DISTINCT line) AS BIGINT) AS n_dup_lines FROM lines WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY doc_id),
words AS (SELECT doc_id, unnest(w) AS x, unnest(range(len(w))) AS i FROM d),
windows AS (
  SELECT doc_id, i, x AS a, lead(x, 1) OVER o AS b, lead(x, 2) OVER o AS c FROM words WINDOW o AS (PARTITION BY doc_id ORDER BY i)),
rep AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, a, b, c) AS n FROM windows WHERE c IS NOT NULL),
cov AS (
  SELECT doc_id, CAST(count(DISTINCT j) AS BIGINT) AS n_repeat_words
  FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS j FROM rep WHERE n > 1) GROUP BY doc_id),
m AS (
  SELECT base.*, coalesce(n_lines, 0) AS n_lines, coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words
  FROM base LEFT JOIN dups USING (doc_id) LEFT JOIN cov USING (doc_id)),
f AS (
  SELECT *, (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AS base_failed,
         (n_words < 50 OR 100 * n_repeat_words > 50 * n_words OR n_symbols > 0.1::DOUBLE * n_words OR n_dup_lines > 0.3::DOUBLE * n_lines
          OR word_chars < 2.5::DOUBLE * n_words OR word_chars > 12.0::DOUBLE * n_words) AS rule_failed
  FROM m),
h AS (SELECT source, count(*) AS n, count(*) FILTER (rule_failed) AS k FROM f GROUP BY source),
q AS (
  SELECT sum(k) / sum(n) AS mean, var_pop(k / n) AS v, avg(1.0::DOUBLE / n) AS inv FROM h),
z AS (SELECT mean, least(greatest(mean * (1 - mean) / greatest(v - mean * (1 - mean) * inv, 1e-9) - 1, 1.0), 1e6) AS strength FROM q),
r AS (SELECT source, n, (k + mean * strength) / (n + strength) AS rate, mean, strength FROM h, z),
ok AS (SELECT source, rate - 1.645::DOUBLE * sqrt(rate * (1 - rate) / (n + (strength + 1.0::DOUBLE))) AS least, mean FROM r)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       (NOT base_failed AND least <= 0.5 AND NOT (rule_failed AND least > mean)) AS kept
FROM f JOIN ok ON f.source IS NOT DISTINCT FROM ok.source
"""

_LINES_SQL = r"""
WITH d AS (SELECT doc_id, source, text, CASE WHEN text = '' OR text IS NULL THEN [] ELSE string_split(text, chr(10)) END AS w FROM documents),
l AS (
  SELECT doc_id, source, unnest(w) AS raw, unnest(range(len(w))) AS i FROM d),
k AS (SELECT *, regexp_replace(raw, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g') AS line FROM l),
pages AS (SELECT source, count(*) AS pages FROM documents GROUP BY source),
freq AS (SELECT source, line, count(DISTINCT doc_id) AS n FROM k WHERE line <> '' GROUP BY source, line),
bad AS (
  SELECT freq.source, line FROM freq JOIN pages ON freq.source IS NOT DISTINCT FROM pages.source WHERE n >= 5 AND n > pages * 0.05),
marked AS (SELECT k.*, bad.line IS NOT NULL AS dropped FROM k LEFT JOIN bad ON k.source IS NOT DISTINCT FROM bad.source AND k.line = bad.line),
agg AS (
  SELECT doc_id, CAST(count(*) AS BIGINT) AS n_lines, CAST(count(*) FILTER (dropped) AS BIGINT) AS n_dropped,
         string_agg(raw, chr(10) ORDER BY i) FILTER (NOT dropped) AS kept
  FROM marked GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_lines, 0) AS n_lines, coalesce(n_dropped, 0) AS n_dropped, sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN agg USING (doc_id)
"""

_LEAKS_SQL = r"""
WITH dw AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents),
bw AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark),
bs AS (SELECT item_id, w, unnest(range(greatest(len(w) - 9, 1))) AS s FROM bw WHERE len(w) > 0),
win AS (SELECT DISTINCT CAST(item_id AS VARCHAR) AS item_id, array_to_string(w[s + 1 : s + 10], ' ') AS x, least(len(w), 10) AS n FROM bs),
sizes AS (SELECT DISTINCT n FROM win),
ds AS (SELECT doc_id, w, n, unnest(range(len(w) - n + 1)) AS s FROM dw, sizes WHERE len(w) >= n),
hits AS (
  SELECT doc_id, s, n, item_id FROM (SELECT doc_id, s, n, array_to_string(w[s + 1 : s + n], ' ') AS x FROM ds) q JOIN win USING (x, n)),
words AS (SELECT doc_id, count(DISTINCT j) AS n_hit FROM (SELECT doc_id, unnest(range(s, s + n)) AS j FROM (SELECT DISTINCT doc_id, s, n FROM hits)) GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids FROM (SELECT DISTINCT doc_id, item_id FROM hits) GROUP BY doc_id)
SELECT dw.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM dw LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)
"""

_INFILL_SQL = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, sha256('7:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents),
u AS (
  SELECT doc_id, t, regexp_extract_all(t, '[^\n]*\n|[^\n]+') AS u,
         CAST('0x' || substr(h, 1, 8) AS BIGINT) AS h1, CAST('0x' || substr(h, 9, 8) AS BIGINT) AS h2, CAST('0x' || substr(h, 25, 8) AS BIGINT) AS h4
  FROM d),
c AS (SELECT *, CAST(len(u) AS BIGINT) AS n, least(h1 % (len(u) + 1), h2 % (len(u) + 1)) AS a, greatest(h1 % (len(u) + 1), h2 % (len(u) + 1)) AS b FROM u),
p AS (
  SELECT doc_id, t, n,
         CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') THEN 'plain' WHEN h4 % 100 < 50 THEN 'spm' ELSE 'psm' END AS form,
         array_to_string(u[1 : a], '') AS prefix, array_to_string(u[a + 1 : b], '') AS middle, array_to_string(u[b + 1 : n], '') AS suffix
  FROM c)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN CAST(length(prefix) AS BIGINT) END AS prefix_chars, CASE WHEN form <> 'plain' THEN CAST(length(middle) AS BIGINT) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'spm' THEN '<S>' || suffix || '<P>' || prefix || '<M>' || middle ELSE '<P>' || prefix || '<S>' || suffix || '<M>' || middle END) AS output_sha256,
       sha256(CASE form WHEN 'plain' THEN t ELSE prefix || middle || suffix END) AS restored_sha256
FROM p
"""

_NEGATIVES_SQL = r"""
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS q
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.vec_id AS anchor_id, v.vec_id, a.label = v.label AS same, CAST(list_dot_product(a.q, v.q) AS BIGINT) AS score
  FROM v AS a JOIN v ON a.vec_id % 100 = 0 AND a.vec_id <> v.vec_id),
p AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score
  FROM (SELECT *, row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) AS r FROM s WHERE same) WHERE r <= 5),
n AS (
  SELECT p.*, s.vec_id AS negative_id, s.score AS negative_score,
         CAST(row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.vec_id) AS INT) AS rank
  FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT s.same AND 80 * positive_score <= 100 * s.score AND s.score <= positive_score)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 5
"""

ORACLES: dict[str, str] = {
    "op2_mixing": _MIX_SQL,
    "op5_quality": _QUALITY_SQL,
    "op7_linededup": _LINES_SQL,
    "op9_decontaminate": _LEAKS_SQL,
    "op11_infilling": _INFILL_SQL,
    "op12_hardnegatives": _NEGATIVES_SQL,
}
