"""Queries op1..op13 and pipeline: each applies its operator to the whole table with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roadlake.llm import byte_bpe, chat_perspective, fair_mix, fill_middle, hard_negatives, hmm_lm, license_index, mih_search, page_diff, personal_data, quality_mcd, simhash_dedup, toxicity_nnpu
from roadlake.llm.common import crc_mod, table

#: Score from which a document counts as toxic.
TOXIC = 0.7


def op1_quality_mcd(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = quality_mcd.quality_verdicts(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "lang", "source", "distance")


def op2_mih_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mih_search.nearest_by_product(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, 20)


def op3_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_dedup.near_duplicates(table(spark, sf_dir, "documents")).select("doc_id", "fingerprint", "component_id", "n_copies")


def op4_page_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    return page_diff.extract_pages(table(spark, sf_dir, "pages"))


def op5_fair_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fair_mix.mix_sources(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op6_toxicity_nnpu(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A null doc_id has no fold and counts as not held out; its label is unknown, so nothing is learned from it."""
    scored = toxicity_nnpu.score_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), ["doc_id"])
    return scored.select("doc_id", F.coalesce(crc_mod("doc_id", 3) == 1, F.lit(False)).alias("held_out"), F.col("toxic_score").alias("score"), (F.col("toxic_score") >= TOXIC).cast("int").alias("predicted"))


def bpe_digests(docs: DataFrame) -> DataFrame:
    import public_tokenizers

    return byte_bpe.encode_table(docs, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN, ["doc_id"], return_ids=False)


def op7_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_digests(table(spark, sf_dir, "documents"))


def op8_license_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_index.scan_licenses(table(spark, sf_dir, "documents"), ["doc_id"])


def op9_hmm_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hmm_lm.score_texts(table(spark, sf_dir, "documents"), crc_mod("doc_id", 5) != 1)


def op10_chat_perspective(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat_perspective.rotate_perspectives(table(spark, sf_dir, "conversations"))


def op11_fill_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = fill_middle.fill_in_middle(table(spark, sf_dir, "documents"))
    digest = lambda text: F.sha2(text.cast("binary"), 256)
    back = fill_middle.restored(F.col("output"), F.col("form"))
    return made.select("doc_id", "n", "form", "prefix_chars", "middle_chars", digest(F.col("output")).alias("output_sha256"), digest(back).alias("restored_sha256"))


def op12_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    spans = personal_data.find_personal_data(table(spark, sf_dir, "documents"))
    count = lambda k: F.size(F.filter("base", lambda s: s["kind"] == k)).cast("long")
    counts = [count(i).alias(f"n_{kind}") for i, kind in enumerate(personal_data.KINDS)]
    text = personal_data.span_text
    return spans.select("doc_id", *counts, F.sha2(text(F.col("base")).cast("binary"), 256).alias("base_sha256"), text(F.concat("base", "found")).alias("spans"), F.size("found").cast("long").alias("n_found"))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings").withColumn("label", F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")))
    return hard_negatives.mine(rows, F.col("vec_id") % 100 == 0)


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    first = (op1_quality_mcd, op2_mih_search, op3_simhash_dedup, op4_page_diff, op5_fair_mix, op6_toxicity_nnpu, op7_byte_bpe, op8_license_index, op9_hmm_lm, op10_chat_perspective)
    return {f.__name__: f for f in (*first, op11_fill_middle, op12_personal_data, op13_hard_negatives, pipeline)}


OP5_SQL = r"""
WITH sized AS (
  SELECT doc_id, CASE WHEN source IS NULL THEN '1' ELSE concat('0', source) END AS key,
         CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
         md5(concat('mix', coalesce(CAST(doc_id AS VARCHAR), ''))) AS h
  FROM documents),
s AS (SELECT key, CAST(sum(size) AS BIGINT) AS source_size FROM sized GROUP BY key),
r AS (SELECT *, row_number() OVER (ORDER BY key) AS source_rank FROM s),
w AS (SELECT *, CASE (source_rank - 1) % 3 WHEN 0 THEN 3e0 WHEN 1 THEN 1e0 ELSE 2e0 END AS weight, source_size * 2e0 AS cap,
             CAST(sum(source_size) OVER () AS BIGINT) * 15e-1 AS budget FROM r),
l AS (SELECT *, (budget - (sum(cap) OVER o - cap)) / (sum(weight) OVER () - (sum(weight) OVER o - weight)) AS level
      FROM w WINDOW o AS (ORDER BY cap / weight, key ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
f AS (SELECT *, max(CAST(cap > level * weight AS INT)) OVER (ORDER BY cap / weight, key ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS free FROM l),
t AS (SELECT key, source_size, source_rank, budget,
             CASE WHEN free = 1 THEN (SELECT min_by(level, cap / weight) FROM f WHERE free = 1) * weight ELSE cap END AS target FROM f),
q AS (SELECT d.*, t.source_size, t.source_rank, t.budget, t.target,
             CAST(sum(d.size) OVER (PARTITION BY d.key ORDER BY h, doc_id, d.size) AS BIGINT) AS queue FROM sized d JOIN t USING (key)),
e AS (SELECT *, p AS pass, (queue + p * source_size) / target AS fin FROM q, (VALUES (0), (1)) AS v(p) WHERE target > 0 AND size > 0),
c AS (SELECT *, sum(size) OVER (ORDER BY fin, source_rank, pass, doc_id) AS used FROM e)
SELECT q.doc_id, q.size, q.source_size, q.target, q.size * coalesce(n.n, 0) AS taken
FROM q LEFT JOIN (SELECT doc_id, count(*) AS n FROM c WHERE used <= budget GROUP BY doc_id) n ON q.doc_id = n.doc_id
"""

OP10_SQL = r"""
WITH said AS (SELECT conv_id, turn, role AS author, coalesce(text, '') AS content FROM conversations WHERE conv_id IS NOT NULL AND role IS NOT NULL),
speakers AS (SELECT DISTINCT conv_id, author AS speaker FROM said WHERE author <> 'system'),
made AS (
  SELECT s.conv_id, p.speaker, s.turn, s.author, s.content,
         CASE WHEN s.author = 'system' THEN 'system' WHEN s.author = p.speaker THEN 'assistant' ELSE 'user' END AS role,
         CASE WHEN s.author <> 'system' AND s.author <> p.speaker THEN s.author END AS name
  FROM said s JOIN speakers p ON s.conv_id = p.conv_id),
headed AS (SELECT *, concat('<|', role, CASE WHEN name IS NULL THEN '' ELSE concat(' name=', name) END, '|>', chr(10)) AS head FROM made),
full_text AS (SELECT *, concat(head, content, '<|end|>', chr(10)) AS rendered FROM headed),
placed AS (SELECT *, CAST(sum(length(rendered)) OVER (PARTITION BY conv_id, speaker ORDER BY turn NULLS FIRST, author, content ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS "end" FROM full_text)
SELECT conv_id, speaker, turn, role, name, content, rendered, CAST(role = 'assistant' AS INT) AS mask,
       "end" - length(rendered) AS start, "end" - length(rendered) + length(head) AS content_start, "end"
FROM placed
"""


OP11_SQL = r"""
WITH h AS (
  SELECT doc_id, coalesce(text, '') AS t, sha256(concat('1:', coalesce(CAST(doc_id AS VARCHAR), ''))) AS d,
         regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS u
  FROM documents),
c AS (SELECT doc_id, t, u, CAST(len(u) AS BIGINT) AS n, CAST(concat('0x', substr(d, 1, 8)) AS BIGINT) % (len(u) + 1) AS a, CAST(concat('0x', substr(d, 9, 8)) AS BIGINT) % (len(u) + 1) AS b,
             CAST(concat('0x', substr(d, 17, 8)) AS BIGINT) % 100 AS draw, CAST(concat('0x', substr(d, 25, 8)) AS BIGINT) % 100 AS turn FROM h),
f AS (SELECT *, CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR draw >= 90 THEN 'plain' WHEN turn < 20 THEN 'spm' ELSE 'psm' END AS form,
             array_to_string(u[1:least(a, b)], '') AS p, array_to_string(u[least(a, b) + 1:greatest(a, b)], '') AS m, array_to_string(u[greatest(a, b) + 1:], '') AS s FROM c)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN CAST(length(p) AS BIGINT) END AS prefix_chars, CASE WHEN form <> 'plain' THEN CAST(length(m) AS BIGINT) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN concat('<P>', p, '<S>', s, '<M>', m) ELSE concat('<S>', s, '<P>', p, '<M>', m) END) AS output_sha256,
       sha256(t) AS restored_sha256
FROM f
"""

OP13_SQL = r"""
WITH e AS (
  SELECT DISTINCT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.vec_id AS anchor_id, o.vec_id AS other, a.label = o.label AS same, CAST(list_sum(list_transform(list_zip(a.v, o.v), lambda p: p[1] * p[2])) AS BIGINT) AS score
      FROM e a JOIN e o ON a.vec_id % 100 = 0 AND a.vec_id <> o.vec_id),
p AS (SELECT anchor_id, other AS positive_id, score AS positive_score FROM s WHERE same
      QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other) <= 5)
SELECT p.anchor_id, p.positive_id, CAST(row_number() OVER w AS INT) AS rank, s.other AS negative_id, p.positive_score, s.score AS negative_score
FROM p JOIN s ON p.anchor_id = s.anchor_id AND NOT s.same AND 80 * p.positive_score <= 100 * s.score AND s.score <= p.positive_score
WINDOW w AS (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.other)
QUALIFY row_number() OVER w <= 5
"""


def oracle_sql() -> dict[str, str]:
    return {"op5_fair_mix": OP5_SQL, "op10_chat_perspective": OP10_SQL, "op11_fill_middle": OP11_SQL, "op13_hard_negatives": OP13_SQL}
