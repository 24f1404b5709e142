"""Connected components of an edge table by alternating large-star and small-star steps."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import stage
from .common import batch_of, rows

EDGE = "u long, v long"


def _forest(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The edges of a task as stars around the smallest id of each local component."""
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        at = x
        while (up := parent.setdefault(at, at)) != at:
            at = up
        while parent[x] != at:
            parent[x], x = at, parent[x]
        return at

    def flush() -> pa.RecordBatch:
        stars = [(x, root(x)) for x in list(parent)]
        stars = [(x, r) for x, r in stars if x != r]
        parent.clear()
        return batch_of({"u": (pa.int64(), [x for x, _ in stars]), "v": (pa.int64(), [r for _, r in stars])})

    for u, v in rows(batches, "u", "v"):
        a, b = root(u), root(v)
        if a != b:
            parent[max(a, b)] = min(a, b)
        if len(parent) > 1_000_000:
            yield flush()
    yield flush()


def components(edges: DataFrame, src: str, dst: str) -> DataFrame:
    """(id, component) for every id on an edge; component is the smallest id reachable.

    Edges with a null end are ignored. Each round is written to the shared folder, so a lost
    executor costs one round. Stars make long chains short: the rounds grow with the logarithm
    of the longest chain. A hub of many edges is reduced by min, never gathered.
    """
    e = edges.select(F.col(src).cast("long").alias("u"), F.col(dst).cast("long").alias("v"))
    e = e.where("u is not null and v is not null and u <> v").mapInArrow(_forest, EDGE)
    e = stage(e.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    while True:
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("m", "u"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = stage(large.where("u <> v").distinct(), "large-star")
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        hung = large.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        small = low.withColumnRenamed("m", "v").unionByName(hung)
        e = stage(small.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "small-star")
        # done when each id hangs on one root and no root hangs on anything
        loose = e.join(e.select(F.col("u").alias("v")).distinct(), "v", "left_semi").limit(1).count()
        if not loose and e.count() == e.select("u").distinct().count():
            break
    pairs = e.select(F.col("u").alias("id"), F.col("v").alias("component"))
    roots = e.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct()
    return pairs.unionByName(roots)
