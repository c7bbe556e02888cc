"""The queries of the training-data operators: whole tables, production parameters, full results."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import exact_dedup, langid, line_dedup, lm_score, mixing, neighbours, packing, quality, simhash, toxicity
from .common import fold, spread, table


def _texts(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    return spread(table(spark, sf_dir, "documents").select("doc_id", "text", *columns))


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = _texts(spark, sf_dir), table(spark, sf_dir, "labels")
    held_out = fold("doc_id", 5) == 0
    index = toxicity.fit(docs, labels, "toxic", ~held_out)
    return toxicity.score(docs, index).select("doc_id", held_out.alias("held_out"), "score", "predicted")


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_plan(table(spark, sf_dir, "documents"))


def op3_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_score.pseudo_likelihood(_texts(spark, sf_dir))


def op4_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _texts(spark, sf_dir, "lang")
    held_out = fold("doc_id", 4) == 2
    model = langid.fit(docs, ~held_out)
    return langid.identify(docs, model).select("doc_id", held_out.alias("held_out"), F.col("lang_nearest").alias("lang_pred"), "score", "rejected")


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.simhash_components(_texts(spark, sf_dir), shingle=3)


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return line_dedup.line_dedup(docs, F.col("source")).select("doc_id", "n_lines", "removed_lines", "text")


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The site is the source, its paths are the source's languages."""
    docs, labels = _texts(spark, sf_dir, "lang", "source"), table(spark, sf_dir, "labels")
    held_out = fold("doc_id", 5) == 0
    classifier = quality.fit(docs, labels, ~held_out)
    return quality.posteriors(docs, classifier, *site(docs)).withColumn("held_out", held_out)


def site(docs: DataFrame) -> tuple[Column, Column]:
    """Host and path of a document: the source up to its first slash, and all of it with the language as a section."""
    return F.substring_index("source", "/", 1), F.concat_ws("/", "source", "lang")


def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_groups(table(spark, sf_dir, "documents"))


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_texts(spark, sf_dir), tokenizer_path())


def op10_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, 20)


QUERIES = {
    "op1_toxicity": op1_toxicity,
    "op2_mixing": op2_mixing,
    "op3_lm_score": op3_lm_score,
    "op4_langid": op4_langid,
    "op5_simhash": op5_simhash,
    "op6_line_dedup": op6_line_dedup,
    "op7_quality": op7_quality,
    "op8_exact_dedup": op8_exact_dedup,
    "op9_packing": op9_packing,
    "op10_neighbours": op10_neighbours,
}

ORACLE: dict[str, str] = {}
ORACLE["op8_exact_dedup"] = """
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
g AS (SELECT t, max(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY t)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(d.t) AS text_sha256 FROM d JOIN g ON d.t = g.t
"""
ORACLE["op10_neighbours"] = """
WITH v AS (
  SELECT row_number() OVER () AS row, vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
p AS (
  SELECT q.row, q.vec_id AS query_id, c.vec_id AS vec_id, list_inner_product(q.e, c.e) AS score
  FROM v q JOIN v c ON q.row <> c.row AND len(q.e) = len(c.e) WHERE q.vec_id % 20 = 0)
SELECT query_id, CAST(row_number() OVER (PARTITION BY row ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
FROM p QUALIFY row_number() OVER (PARTITION BY row ORDER BY score DESC, vec_id) <= 20
"""

# Targets by filling up the sources in the order of cap / weight; golden-ratio points through the cumulative quotas give each slot its
# source and rank; the documents are laid out in the shuffled order and cut by the blocks (words w with floor(b * total / blocks) <= w).
ORACLE["op2_mixing"] = rf"""
WITH d AS (
  SELECT row_number() OVER () AS row, doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
w AS (
  SELECT *, row_number() OVER (ORDER BY source ASC NULLS LAST) - 1 AS k, source_size * 2.0::DOUBLE AS cap,
    CASE (row_number() OVER (ORDER BY source ASC NULLS LAST) - 1) % 3 WHEN 0 THEN 3.0::DOUBLE WHEN 1 THEN 1.0::DOUBLE ELSE 2.0::DOUBLE END AS weight FROM s),
o AS (
  SELECT *, row_number() OVER (ORDER BY cap / weight, k) AS n,
    (1.5::DOUBLE * sum(source_size) OVER () - coalesce(sum(cap) OVER (ORDER BY cap / weight, k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
    / (sum(weight) OVER () - coalesce(sum(weight) OVER (ORDER BY cap / weight, k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) AS rate FROM w),
f AS (SELECT arg_min(rate, n) AS rate, min(n) AS n FROM o WHERE rate * weight <= cap),
t AS (
  SELECT source, source_size, CASE WHEN f.n IS NULL OR o.n < f.n THEN cap ELSE f.rate * weight END AS target,
    greatest(CAST(ceil(source_size / 4096.0::DOUBLE) AS BIGINT), least(source_size, {mixing.LEAST})) AS blocks FROM o, f),
q AS (SELECT *, target / source_size * blocks AS quota, coalesce('s' || source, '') AS key FROM t WHERE source_size > 0),
c AS (
  SELECT *, sum(quota) OVER (ORDER BY key) / sum(quota) OVER () AS high,
    coalesce(sum(quota) OVER (ORDER BY key ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) / sum(quota) OVER () AS low, lead(key) OVER (ORDER BY key) IS NULL AS last FROM q),
i AS (SELECT unnest(generate_series(0, (SELECT CAST(ceil(sum(quota) - 1e-6) AS BIGINT) FROM q) - 1)) AS slot),
x AS (SELECT slot, (slot // {mixing._STEP}) * {math.fmod(mixing._STEP * mixing.GOLDEN, 1.0)!r}::DOUBLE + (slot % {mixing._STEP}) * {mixing.GOLDEN!r}::DOUBLE AS x FROM i),
r AS (
  SELECT source, source_size, blocks, slot, row_number() OVER (PARTITION BY source ORDER BY slot) - 1 AS rank
  FROM x JOIN c ON x - floor(x) >= low AND (x - floor(x) < high OR last)),
b AS (
  SELECT source, rank % blocks AS b, (rank % blocks) * source_size // blocks AS b0, (rank % blocks + 1) * source_size // blocks AS b1, count(*) AS times, min(slot) AS slot
  FROM r WHERE rank < 2 * blocks GROUP BY source, rank % blocks, source_size, blocks),
h AS (SELECT *, ('0x' || substr(md5(CAST(doc_id AS VARCHAR)), 1, 15))::BIGINT AS h FROM d WHERE size > 0),
l AS (
  SELECT row, source, size, CAST(coalesce(sum(size) OVER (PARTITION BY source ORDER BY h % 4096, h, doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS start FROM h),
p AS (
  SELECT l.row, sum(times * greatest(0, least(b1, start + size) - greatest(b0, start))) AS taken, min(slot) AS first_slot
  FROM l JOIN b ON l.source IS NOT DISTINCT FROM b.source AND b0 < start + size AND b1 > start GROUP BY l.row)
SELECT d.doc_id, d.size, t.source_size, t.target, CAST(coalesce(p.taken, 0) AS BIGINT) AS taken, p.first_slot
FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source LEFT JOIN p ON d.row = p.row
"""

ORACLE["op6_line_dedup"] = r"""
WITH d AS (SELECT row_number() OVER () AS row, * FROM documents),
l AS (
  SELECT row, coalesce(source, '\x01') AS source, unnest(string_split(text, chr(10))) AS line, unnest(generate_series(1, len(string_split(text, chr(10))))) AS pos FROM d WHERE text IS NOT NULL),
k AS (SELECT *, trim(line, chr(9) || chr(13) || ' ') AS cut FROM l),
b AS (SELECT cut FROM k WHERE cut <> '' GROUP BY cut HAVING count(DISTINCT source) >= 8),
c AS (
  SELECT row, string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE b.cut IS NULL) AS text, count(*) AS n_lines, count(b.cut) AS removed_lines
  FROM k LEFT JOIN b ON k.cut = b.cut GROUP BY row)
SELECT d.doc_id, CAST(coalesce(n_lines, 0) AS INTEGER) AS n_lines, CAST(coalesce(removed_lines, 0) AS INTEGER) AS removed_lines,
  CASE WHEN d.text IS NULL THEN NULL ELSE coalesce(c.text, '') END AS text FROM d LEFT JOIN c ON d.row = c.row
"""
