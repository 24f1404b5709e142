"""A training corpus from raw documents: each stage reads what the one before has kept.

Stages take (spark, docs, sf_dir) and return a frame that is written as Parquet and read again as
the next stage's docs. All but the last keep the columns of documents; the last repeats documents
as the mix asks. Null columns, empty and long texts, repeated rows and further columns are treated as
the docstrings of the operators say; an empty table passes through all stages.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roomtide.llm import decontaminate, jaccard, mixing, quality, toxicity
from roomtide.llm.common import table
from roomtide.session import remove, shared_dir, stage, staging_scope

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose chance of more than the lowest grade is at least one half."""
    model = quality.learn(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return quality.select_documents(docs.select(*COLUMNS), model)


def not_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents under the toxicity cut."""
    labels = table(spark, sf_dir, "labels").where(~toxicity.held_out())
    return toxicity.keep_clean(docs.select(*COLUMNS), toxicity.learn(table(spark, sf_dir, "documents"), labels))


def one_of_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of near copies, once.

    A document is an id with a text: rows of equal id and text are one, texts of a repeated id are
    grouped apart, and so are rows without id, which come last in their group.
    """
    docs = docs.select(*COLUMNS).withColumn("key", F.xxhash64("doc_id", "text"))
    groups = jaccard.jaccard_groups(docs.select(F.col("key").alias("doc_id"), "text"))
    near = groups.where("doc_id <> component_id").select(F.col("doc_id").alias("key"), F.col("component_id").alias("c")).distinct()
    near = stage(near, "near-copies")
    members = near.unionByName(near.select(F.col("c").alias("key"), "c").distinct())
    ranked = members.join(docs.select("key", "doc_id").distinct(), "key")
    first = ranked.groupBy("c").agg(F.min(F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "key")).alias("first"))
    gone = stage(members.join(first.select(F.col("first.key").alias("key")), "key", "left_anti").select("key"), "near-copies-gone")
    kept = docs.join(gone, "key", "left_anti").groupBy("key").agg(F.min(F.struct(*COLUMNS)).alias("row"))
    return kept.select("row.*")


def no_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no window of a benchmark item; a row goes by its id and text, with or without id."""
    docs = docs.select(*COLUMNS)
    judged = decontaminate.judge_rows(docs, table(spark, sf_dir, "benchmark")).where("contaminated")
    marked = stage(judged.select(F.col("doc_id").alias("hit_id"), F.col("h").alias("hit_h")).distinct(), "contaminated")
    hit = F.col("doc_id").eqNullSafe(F.col("hit_id")) & (decontaminate.text_hash() == F.col("hit_h"))
    return docs.join(marked, hit, "left_anti").select(*COLUMNS)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as its source's target weight asks."""
    return mixing.mix(docs.select(*COLUMNS))


STAGES = [
    ("quality", good_quality), ("toxicity", not_toxic), ("near_copies", one_of_group),
    ("decontaminate", no_benchmark), ("mix", mixed),
]

#: The learned stages and the similarity join can't be written in SQL; tests hold the run against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mixed documents. What a stage has staged is removed when its result is written, and the result when the
    next one's is; the last stage's stay for the frame that is returned."""
    docs, before = table(spark, sf_dir, "documents"), None
    folder = f"{shared_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    for name, step in STAGES[:-1]:
        with staging_scope(spark):
            step(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
        if before:
            remove(spark, f"{folder}/{before}")
        before = name
    return STAGES[-1][1](spark, docs, sf_dir)
