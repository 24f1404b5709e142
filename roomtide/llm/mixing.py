"""Mixing sources to target weights.

Tokens are summed per source, targets follow from the weights, and a source's repetition rate is
target / size. Each document is emitted floor(rate) times, plus one copy when its seeded hash,
read as a number in [0, 1), is below the fraction: the same copies on every run, on any partitioning.
The hash is of the id, the text and the row's number among rows equal in id, text and source, so that rows without
id and repeated rows throw their own coins. Only rows that have an equal one are numbered; the others are not shuffled.

A target stops at `cap` times its source's size and the excess is shared again by weight. With
every source's limit l = cap * size / weight in ascending order, the sources up to some place are at
their limits and all others get the same share per weight; one ordered pass over the sources finds
it. Sources are summed before that pass, which sees one row per source, not per document.

Sources are ordered by code point, null last (null is a source of its own). Null texts have size 0;
a source of size 0 gets nothing. An empty table
gives an empty mix. Other columns of the input are kept by `mix`, and may have any names.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import stage
from .common import word_count

WEIGHTS, SHARE, CAP, SEED = (5, 2, 1), 1.5, 2, "mix-1"


def hashed_unit(key: Column, seed: str = SEED) -> Column:
    """Seeded md5 of a key (null counts as empty) as a number in [0, 1)."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit(""))).cast("binary"))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)


def text_digest(text: Column) -> Column:
    return F.md5(F.coalesce(text.cast("string"), F.lit("")).cast("binary"))


def numbered(rows: DataFrame, keys: list[str], order: Column) -> DataFrame:
    """`rows` with `number`, from 0 among rows with equal keys (nulls equal); rows that are alone have 0."""
    names = [f"key_{k}" for k in keys]
    repeats = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("times")).where("times > 1")
    # a written table has a known size: while it is small it is sent to the rows, and no row is shuffled
    repeats = stage(repeats.select(*[F.col(k).alias(n) for k, n in zip(keys, names, strict=True)]), "repeated-rows")
    equal = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(n)) for k, n in zip(keys, names, strict=True)])
    alone = rows.join(repeats, equal, "left_anti").withColumn("number", F.lit(0))
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(order)) - 1
    return alone.unionByName(rows.join(repeats, equal, "left_semi").withColumn("number", place))


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, cap: int = CAP) -> DataFrame:
    """(source, source_size, target) from (source, size) rows."""
    known = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    ordered = Window.orderBy(F.col("source").isNull(), F.col("source"))
    place = (F.row_number().over(ordered) - 1) % len(weights)
    known = known.withColumn("weight", F.get(F.array(*[F.lit(w) for w in weights]), place))
    limit = F.lit(cap) * F.col("source_size") / F.col("weight")
    ascending = Window.orderBy("limit", F.col("source").isNull(), "source")
    before = ascending.rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy()
    known = known.withColumn("limit", limit).withColumn("rank", F.row_number().over(ascending))
    full = F.coalesce(F.lit(cap) * F.sum("source_size").over(before), F.lit(0))
    left = F.sum("weight").over(whole) - F.coalesce(F.sum("weight").over(before), F.lit(0))
    # what each weight would get if all sources before this one were at their limits
    known = known.withColumn("even", (F.lit(share) * F.sum("source_size").over(whole) - full) / left)
    settled = F.when(F.col("even") <= F.col("limit"), F.struct("rank", "even"))
    known = known.withColumn("even", F.min(settled).over(whole)["even"])
    target = F.least(F.lit(float(cap)) * F.col("source_size"), F.coalesce(F.col("even"), F.lit(float("inf"))) * F.col("weight"))
    return known.select("source", "source_size", target.alias("target"))


KEYS = ["doc_id", "source", "digest"]


def _copies(sized: DataFrame, sizes: DataFrame, order: Column, weights: tuple[int, ...], share: float, cap: int, seed: str) -> DataFrame:
    """`sized` (doc_id, source, size, digest and more) with source_size, target and copies."""
    # one row per source; Spark broadcasts it while it is small and else joins by shuffle
    targets = source_targets(sizes, weights, share, cap).withColumnRenamed("source", "s")
    joined = numbered(sized, KEYS, order).join(targets, F.col("source").eqNullSafe(F.col("s")))
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    name = F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("")), "digest", F.col("number").cast("string"))
    extra = hashed_unit(name, seed) < rate - F.floor(rate)
    return joined.withColumn("copies", F.floor(rate) + extra.cast("long"))


def mix_plan(
    docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, cap: int = CAP, seed: str = SEED
) -> DataFrame:
    """doc_id, size, source_size, target, copies, taken of every document. The texts are read once."""
    text = F.col("text")
    sized = docs.select("doc_id", F.col("source").cast("string").alias("source"), word_count(text).alias("size"), text_digest(text).alias("digest"))
    sized = stage(sized, "document-sizes")
    planned = _copies(sized, sized.select("source", "size"), F.col("digest"), weights, share, cap, seed)
    taken = F.col("size") * F.col("copies")
    return planned.select("doc_id", "size", "source_size", "target", "copies", taken.alias("taken"))


def mix(
    docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, cap: int = CAP, seed: str = SEED
) -> DataFrame:
    """Every document as many times as its plan says, with all its columns."""
    row = F.struct(*[F.col(f"`{n}`") for n in docs.columns]).alias("row")
    doc_id, source, text = (F.col(f"`{n}`") for n in ("doc_id", "source", "text"))
    named = docs.select(row, doc_id.alias("doc_id"), source.cast("string").alias("source"), text_digest(text).alias("digest"))
    sizes = docs.select(source.cast("string").alias("source"), word_count(text).alias("size"))
    # of equal rows the one with the smallest hash of all columns comes first, whatever the partitioning
    planned = _copies(named, sizes, F.xxhash64("row"), weights, share, cap, seed).where("copies > 0")
    return planned.select("row", F.explode(F.sequence(F.lit(1).cast("long"), "copies"))).select("row.*")
