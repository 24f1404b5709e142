"""The operators' registered queries and the DuckDB statements of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import settle
from . import chat, decontaminate, hard_negatives, jaccard, lm, mixing, neardup_vectors, quality, token_files, toxicity, urls, warc, whitening
from .common import table

TEMPLATE_TEXT = "<|im_end|><|im_start|>assistant ok"


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    grammar = toxicity.learn(docs, labels.where(~toxicity.held_out()))
    scored = toxicity.score_toxicity(docs, grammar)
    predicted = (F.col("score") >= toxicity.CUT).cast("int").alias("predicted")
    return scored.select("doc_id", toxicity.held_out().alias("held_out"), "score", predicted)


def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, items = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    return settle(spark, "op2", lambda: decontaminate.decontaminate(docs, items))


def op3_vector_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return settle(spark, "op3", lambda: neardup_vectors.link_vectors(table(spark, sf_dir, "embeddings")))


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = warc.archive_pages(table(spark, sf_dir, "pages"))
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op5_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return settle(spark, "op5", lambda: jaccard.jaccard_links(table(spark, sf_dir, "documents")))


def op6_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = urls.judge_urls(table(spark, sf_dir, "pages"))
    return judged.select("page_id", "host", "path", "rule", "verdict")


def op7_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    rows = [(-1, 0, "user", TEMPLATE_TEXT), (-1, 1, "assistant", TEMPLATE_TEXT)]
    extra = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    return chat.read_chats(chat.format_chats(turns.unionByName(extra)))


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    graded = quality.grade_documents(docs, quality.learn(docs, labels.where(~quality.held_out())))
    return graded.withColumn("held_out", quality.held_out())


def op9_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    scored = lm.score_texts(docs, lm.train(docs.where(~lm.held_out())))
    return scored.select("doc_id", lm.held_out().alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op10_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    plan = settle(spark, "op10", lambda: mixing.mix_plan(table(spark, sf_dir, "documents")))
    return plan.select("doc_id", "size", "source_size", "target", "taken")


def op11_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    folder = token_files.write_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    return token_files.digests(spark, folder)


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hard_negatives.mine(table(spark, sf_dir, "embeddings"))


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    white = whitening.whiten(table(spark, sf_dir, "embeddings"))
    # beyond a long there is no deviation to return
    return white.withColumn("deviation", F.col("deviation").try_cast("long"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_toxicity, op2_decontaminate, op3_vector_neardup, op4_warc, op5_jaccard,
        op6_url_filter, op7_chat, op8_quality, op9_lm, op10_mix, op11_token_files,
        op12_hard_negatives, op13_whitening,
    )
}

# --- DuckDB statements ------------------------------------------------------------------------

_WORDS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

OP2 = rf"""
WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
b AS (SELECT coalesce(CAST(item_id AS VARCHAR), '') AS item_id, {_WORDS} AS w FROM benchmark),
g AS (
  SELECT DISTINCT item_id, array_to_string(w[i:i + 9], ' ') AS gram, least(len(w), 10) AS n
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM b WHERE len(w) > 0)
),
sizes AS (SELECT DISTINCT n FROM g),
o AS (
  SELECT doc_id, i, n, array_to_string(w[i:i + n - 1], ' ') AS gram
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, sizes WHERE len(w) >= n)
),
hit AS (SELECT o.doc_id, o.i, o.n, g.item_id FROM o JOIN g ON o.gram = g.gram AND o.n = g.n),
covered AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM hit) GROUP BY doc_id),
named AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids
  FROM (SELECT DISTINCT doc_id, item_id FROM hit) GROUP BY doc_id
)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN covered USING (doc_id) LEFT JOIN named USING (doc_id)
"""

OP10 = r"""
WITH d AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
    md5(coalesce(text, '')) AS digest, row_number() OVER (PARTITION BY doc_id, source, md5(coalesce(text, ''))) - 1 AS number
  FROM documents
),
s AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
    [5, 2, 1][CAST((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS INT) + 1] AS weight
  FROM d GROUP BY source
),
l AS (SELECT *, 2 * source_size / weight AS lim, row_number() OVER (ORDER BY 2 * source_size / weight, source NULLS LAST) AS k FROM s),
e AS (
  SELECT a.k, a.lim,
    (1.5 * (SELECT sum(source_size) FROM s) - 2 * coalesce((SELECT sum(source_size) FROM l b WHERE b.k < a.k), 0))
    / ((SELECT sum(weight) FROM s) - coalesce((SELECT sum(weight) FROM l b WHERE b.k < a.k), 0)) AS even
  FROM l a
),
x AS (SELECT CAST(arg_min(even, k) AS DOUBLE) AS even FROM e WHERE even <= lim),
t AS (SELECT source, source_size, least(2.0 * source_size, even * weight) AS target FROM s, x),
r AS (
  SELECT d.doc_id, d.size, d.digest, d.number, t.source_size, CAST(t.target AS DOUBLE) AS target,
    CASE WHEN t.source_size > 0 THEN CAST(t.target AS DOUBLE) / t.source_size ELSE 0.0 END AS rate
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, size, source_size, target,
  size * (CAST(floor(rate) AS BIGINT) + CASE
    WHEN CAST('0x' || substr(md5('mix-1:' || coalesce(CAST(doc_id AS VARCHAR), '') || ':' || digest || ':' || number), 1, 8) AS BIGINT) / 4294967296.0 < rate - floor(rate) THEN 1 ELSE 0 END) AS taken
FROM r
"""

OP12 = r"""
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda c: floor(256 * CAST(c AS DOUBLE))) AS x
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0
),
s AS (
  SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same, CAST(list_inner_product(a.x, b.x) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0
),
p AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
)
SELECT anchor_id, positive_id,
  CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) AS INT) AS rank,
  vec_id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s USING (anchor_id)
WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
QUALIFY rank <= 10
"""

ORACLE = {"op2_decontaminate": OP2, "op10_mix": OP10, "op12_hard_negatives": OP12}
