"""The registered queries of this subpackage, one per operator, and their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from reachmill.llm import best_fit, binary_output, chat, exact_dedup, hard_negatives, language_id, minhash, mixing, nearest, personal_data, quality, sentencepiece_codec, whitening
from reachmill.llm.common import table


def op1_minhash_near_dedup(spark, sf_dir):
    return minhash.near_duplicates(table(spark, sf_dir, "documents"))


def op2_quality_classifier(spark, sf_dir):
    return quality.quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op3_personal_data(spark, sf_dir):
    return personal_data.personal_data(table(spark, sf_dir, "documents"))


def op4_sentencepiece(spark, sf_dir):
    return sentencepiece_codec.encode_digests(table(spark, sf_dir, "documents"))


def op5_nearest_neighbours(spark, sf_dir):
    return nearest.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op6_packed_matrices(spark, sf_dir):
    packed = binary_output.packed_matrices(table(spark, sf_dir, "documents"))
    used = F.element_at("cu_seqlens", -1)
    return packed.select("sequence_id", "doc_ids", "pieces", "cu_seqlens", used.alias("n_tokens"), F.crc32("ids").alias("ids_crc32"), F.crc32("positions").alias("positions_crc32"))


def op7_chat_format(spark, sf_dir):
    turns = chat.render(table(spark, sf_dir, "conversations"))
    return turns.select("conv_id", "n_turns", F.length("text").cast("long").alias("n_chars"), F.sha2("text", 256).alias("text_sha256"))


def op8_best_fit_packing(spark, sf_dir):
    return best_fit.pack_documents(table(spark, sf_dir, "documents"))


def op9_language_id(spark, sf_dir):
    return language_id.identify(table(spark, sf_dir, "documents"))


def op10_exact_dedup(spark, sf_dir):
    return exact_dedup.exact_duplicates(table(spark, sf_dir, "documents"), digest_all=True)


def op11_hard_negatives(spark, sf_dir):
    rows = table(spark, sf_dir, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    whole = F.transform(F.col("embedding").cast("array<double>"), _floored(256))
    return hard_negatives.hard_negatives(rows.select("vec_id", label.alias("label"), whole.alias("embedding")), F.col("vec_id") % 50 == 0)


def op12_source_mixing(spark, sf_dir):
    return mixing.mix(table(spark, sf_dir, "documents"))


def op13_embedding_whitening(spark, sf_dir):
    rows = table(spark, sf_dir, "embeddings")
    whole = F.transform(F.col("embedding").cast("array<double>"), lambda c: _floored(64)(c) + 1_000_000)
    white = whitening.whiten(rows.select("vec_id", whole.alias("embedding")), 32, shift=1e6)
    each = white.select("vec_id", F.posexplode(F.arrays_zip("whitened", "explained")).alias("i", "c"), "n", "deviation", "identity_error")
    return each.select("vec_id", (F.col("i") + 1).alias("component"), "n", "deviation", "c.whitened", "c.explained", "identity_error")


def _floored(times):
    """floor(times c) as a double; null and non-finite entries stay what they are, so that their rows are told."""
    return lambda c: F.when(F.abs(c) < float("inf"), F.floor(times * c).cast("double")).otherwise(c)


def queries():
    return {name: f for name, f in sorted(globals().items()) if name.startswith("op") and name[2].isdigit()}


_CHAT_SQL = """
WITH turns AS (
  SELECT conv_id, role, text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role NULLS FIRST, text NULLS FIRST) AS place
  FROM conversations WHERE conv_id IS NOT NULL
), lines AS (
  SELECT conv_id, place, '<|startoftext|>' || coalesce(role, 'unknown') || chr(10) || coalesce(text, '') || '<|endoftext|>' || chr(10) AS line,
         coalesce(role, '<none>') || chr(1) || coalesce(text, '<none>') AS own
  FROM turns
), whole AS (
  SELECT conv_id, count(*) AS n, list(own ORDER BY place) AS owns, string_agg(line, '' ORDER BY place) AS text
  FROM lines GROUP BY conv_id
), firsts AS (
  SELECT * FROM whole w WHERE conv_id = (SELECT min(conv_id) FROM whole v WHERE v.owns = w.owns)
)
SELECT conv_id, CAST(n AS BIGINT) AS n_turns, CAST(length(text) AS BIGINT) AS n_chars, sha256(text) AS text_sha256
FROM firsts a
WHERE NOT EXISTS (SELECT 1 FROM whole b WHERE b.n > a.n AND b.owns[1] = a.owns[1] AND list_slice(b.owns, 1, a.n) = a.owns)
"""

_EXACT_SQL = """
WITH d AS (
  SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents
), g AS (
  SELECT doc_id, max(doc_id) OVER (PARTITION BY t) AS keep_id, CAST(count(*) OVER (PARTITION BY t) AS BIGINT) AS group_size, sha256(t) AS text_sha256 FROM d
)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM g
"""


_NEGATIVES_SQL = """
WITH e AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, [CAST(floor(256 * CAST(c AS DOUBLE)) AS DOUBLE) for c in embedding] AS x
  FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) = len([c for c in embedding if isfinite(c)])
), s AS (
  SELECT a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS same, CAST(list_dot_product(a.x, c.x) AS BIGINT) AS score
  FROM e a JOIN e c ON a.vec_id <> c.vec_id AND len(a.x) = len(c.x) WHERE a.vec_id % 50 = 0
), p AS (
  SELECT * FROM (SELECT anchor_id, vec_id AS positive_id, score AS positive_score, row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) AS n FROM s WHERE same) t WHERE n <= 5
)
SELECT * FROM (
  SELECT anchor_id, positive_id, CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id AS negative_id, positive_score, score AS negative_score
  FROM p JOIN s USING (anchor_id) WHERE NOT same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
) t WHERE rank <= 3
"""


def oracle_sql():
    return {"op7_chat_format": _CHAT_SQL, "op10_exact_dedup": _EXACT_SQL, "op11_hard_negatives": _NEGATIVES_SQL}
