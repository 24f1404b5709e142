"""Embedding near-duplicates by collision-counting projections.

Vectors are projected on many random directions. A table sorts its vectors by the signs of a few
directions and then by one further projection, cut into tiles as wide as the window around a query, so
that two vectors within the window share a tile. Inside a tile, `COUNTED` more projections are sorted
one by one; every vector opens its window in each, and the collisions are counted per pair.
Pairs that reach the calibrated count are verified by cosine in double precision.

Calibration, for a pair exactly at the threshold (angle a, projections differ by a normal variable of
deviation s = sqrt(2 - 2 cos)): signs agree with chance 1 - a / pi each, the window of 2 s holds the pair
with chance 0.954, and the count is the largest that keeps 99 % of such pairs. The number of tables
follows for a recall of 0.97 at the threshold; closer pairs are found more surely. The number of signs
grows with the logarithm of the number of distinct vectors, so tiles stay small.

Equal vectors are one vector with a multiplicity; their pairs are links too. Tiles of more than `BLOCK`
vectors are dealt as pairs of salted blocks, each to a task of its own: no tile is capped. A pair is
counted in the first table, tile and block that holds it, so tasks return sums per vector and the
edges of a local spanning forest, never pairs.

Vectors that are null, empty, zero or hold null or non-finite components, and rows with a null vec_id,
link with nothing. Vectors of different length never link. Repeated vec_ids are separate vectors with
one id. Other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from itertools import groupby

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import stage
from .common import batch_of, rows
from .components import components

COSINE, RECALL, KEPT = 0.9, 0.97, 0.99
COUNTED, LEAF, BLOCK, SEED = 8, 64, 1024, 20


@dataclass(frozen=True)
class Plan:
    """Signs and tables for a number of distinct vectors, window and count for the threshold."""

    n: int
    cosine: float = COSINE

    @property
    def window(self) -> float:
        return 2 * math.sqrt(max(2 - 2 * self.cosine, 1e-12))

    @property
    def signs(self) -> int:
        return min(60, max(0, math.ceil(math.log2(max(self.n, 1) / LEAF))))

    @property
    def count(self) -> int:
        inside = math.erf(math.sqrt(2.0))
        tail = 0.0
        for c in range(COUNTED, 0, -1):
            tail += math.comb(COUNTED, c) * inside**c * (1 - inside) ** (COUNTED - c)
            if tail >= KEPT:
                return c
        return 1

    @property
    def tables(self) -> int:
        agree = (1 - math.acos(self.cosine) / math.pi) ** self.signs
        return math.ceil(math.log(1 - RECALL) / math.log(1 - min(agree * math.erf(math.sqrt(2.0)) * KEPT, 0.999)))

    def project(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Sign codes and sorting projections by table, and the counted projections, of unit vectors."""
        k, t = self.signs, self.tables
        directions = np.random.default_rng([SEED, x.shape[1]]).standard_normal((x.shape[1], t * (k + 1) + COUNTED))
        z = x @ directions
        bits = (z[:, :t * k].reshape(len(x), t, k) > 0) if k else np.zeros((len(x), t, 0), bool)
        codes = (bits << np.arange(k)).sum(axis=2)
        return codes, z[:, t * k:t * (k + 1)], z[:, t * (k + 1):]


def _clean(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Vectors as bytes of doubles; null for those that link with nothing."""
    for batch in batches:
        out: list[bytes | None] = []
        for key, vector in zip(batch.column("vec_id").to_pylist(), batch.column("embedding").to_pylist(), strict=True):
            data = None
            if key is not None and vector and None not in vector:
                x = np.array(vector, np.float64)
                size = np.abs(x).max()
                if np.isfinite(size) and size > 0:
                    data = (x + 0.0).astype(np.float64).tobytes()
            out.append(data)
        yield batch_of({"vec_id": (pa.int64(), batch.column("vec_id")), "data": (pa.binary(), out)})


def _unit(data: list[bytes]) -> np.ndarray:
    x = np.array([np.frombuffer(d) for d in data])
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _deal(plan: Plan):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, data, times = (batch.column(n).to_pylist() for n in ("id", "data", "times"))
            by_size: dict[int, list[int]] = {}
            for i, d in enumerate(data):
                by_size.setdefault(len(d), []).append(i)
            for size, group in by_size.items():
                codes, z, _ = plan.project(_unit([data[i] for i in group]))
                tiles = np.floor(z / plan.window).astype(np.int64)
                for t in range(plan.tables):
                    for step in (0, 1):
                        key = np.stack([np.full(len(group), t), codes[:, t], tiles[:, t] + step, np.full(len(group), size)], axis=1)
                        cell = [xxhash.xxh3_64_intdigest(k.tobytes()) >> 1 for k in key]
                        yield batch_of({
                            "cell": (pa.int64(), cell), "tab": (pa.int32(), np.full(len(group), t, np.int32)), "tile": (pa.int64(), tiles[:, t] + step),
                            "id": (pa.int64(), [ids[i] for i in group]), "times": (pa.int64(), [times[i] for i in group]), "data": (pa.binary(), [data[i] for i in group]),
                        })

    return run


def collisions(z: np.ndarray, window: float, queries: slice) -> np.ndarray:
    """Per query and vector, in how many projections the vector lies in the query's window."""
    n, m = len(range(*queries.indices(len(z)))), len(z)
    counts = np.zeros((n, m), np.uint8)
    for column in z.T:
        order = np.argsort(column, kind="stable")
        ranked = column[order]
        asked = column[queries]
        lo, hi = np.searchsorted(ranked, asked - window), np.searchsorted(ranked, asked + window, side="right")
        width = hi - lo
        who = np.repeat(np.arange(n), width)
        place = np.arange(width.sum()) - np.repeat(np.cumsum(width) - width, width) + np.repeat(lo, width)
        counts[who, order[place]] += 1  # a vector lies once in a window
    return counts


def _link(plan: Plan):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ("cell", "part", "tab", "tile", "side", "id", "times", "data")
        u, v, n = [], [], []
        for (_, _, table, tile), group in groupby(rows(batches, *names), lambda r: r[:4]):
            _, _, _, _, side, ids, times, data = zip(*group, strict=True)
            if len(ids) < 2:
                continue
            x = _unit(list(data))
            codes, sort_by, counted = plan.project(x)
            own = np.floor(sort_by / plan.window)
            side, ids, times = np.array(side), np.array(ids), np.array(times)
            links = np.zeros(len(ids), np.int64)
            parent = np.arange(len(ids))
            for at in range(0, len(ids), 256):
                near = collisions(counted, plan.window, slice(at, at + 256)) >= plan.count
                a, b = np.nonzero(near)
                a = a + at
                fresh = (a < b) & (ids[a] != ids[b])
                # blocks of a dealt tile: pairs across its two sides, or within the one side that meets itself (side 2)
                fresh &= (side[a] != side[b]) | (side[a] == 2)
                a, b = a[fresh], b[fresh]
                good = np.einsum("ij,ij->i", x[a], x[b]) >= plan.cosine
                a, b = a[good], b[good]
                # a pair belongs to the first table that holds it, there to the higher of its tiles
                first = np.maximum(own[a, table], own[b, table]) == tile
                together = (codes[a] == codes[b]) & (np.abs(own[a] - own[b]) <= 1)
                first &= ~together[:, :table].any(axis=1)
                a, b = a[first], b[first]
                np.add.at(links, a, times[b])
                np.add.at(links, b, times[a])
                for i, j in zip(a, b, strict=True):
                    while parent[i] != i:
                        parent[i] = i = parent[parent[i]]
                    while parent[j] != j:
                        parent[j] = j = parent[parent[j]]
                    if i != j:
                        parent[j] = i
            for i in np.flatnonzero(links):
                j = i
                while parent[j] != j:
                    j = parent[j]
                u.append(int(ids[i]))
                v.append(int(ids[j]))
                n.append(int(links[i]))
            if len(u) >= 50_000:
                yield batch_of({"u": (pa.int64(), u), "v": (pa.int64(), v), "n": (pa.int64(), n)})
                u, v, n = [], [], []
        yield batch_of({"u": (pa.int64(), u), "v": (pa.int64(), v), "n": (pa.int64(), n)})

    return run


def link_vectors(vectors: DataFrame, cosine: float = COSINE) -> DataFrame:
    """vec_id, n_links, component_id, kept of every vector."""
    ready = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"))
    clean = stage(ready.mapInArrow(_clean, "vec_id long, data binary"), "vectors")
    usable = clean.where("data is not null")
    # a number for each distinct vector, as equal ids may have different ones
    classes = usable.groupBy("data").agg(F.min("vec_id").alias("low"), F.count(F.lit(1)).alias("times"))
    classes = stage(classes.withColumn("id", F.monotonically_increasing_id()), "vector-classes")
    plan = Plan(classes.count(), cosine)
    dealt = stage(classes.select("id", "times", "data").mapInArrow(_deal(plan), "cell long, tab int, tile long, id long, times long, data binary"), "vector-tiles")
    sizes = dealt.groupBy("cell").agg(F.count(F.lit(1)).alias("n")).where(f"n > {BLOCK}")
    parts = F.ceil(F.col("n") / BLOCK).cast("long")
    large = sizes.select("cell", parts.alias("parts"))
    salted = dealt.join(large, "cell", "left").withColumn("parts", F.coalesce("parts", F.lit(1)))
    salted = salted.withColumn("own", F.pmod(F.xxhash64("id", "data"), F.col("parts"))).withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)))
    low, high = F.least("own", "other"), F.greatest("own", "other")
    side = F.when(F.col("own") == F.col("other"), 2).when(F.col("own") < F.col("other"), 0).otherwise(1)
    blocks = salted.select("cell", (low * F.col("parts") + high).alias("part"), "tab", "tile", side.cast("int").alias("side"), "id", "times", "data")
    order = ["cell", "part", "tab", "tile"]
    found = stage(blocks.repartition("cell", "part").sortWithinPartitions(*order).mapInArrow(_link(plan), "u long, v long, n long"), "vector-links")
    counts = found.groupBy(F.col("u").alias("id")).agg(F.sum("n").alias("others"))
    members = usable.join(classes, "data").select("vec_id", "id", "times", "low")
    lowest = lambda c, name: classes.select(F.col("id").alias(c), F.col("low").alias(name))
    edges = found.select("u", "v").distinct().join(lowest("u", "a"), "u").join(lowest("v", "b"), "v").select("a", "b")
    edges = edges.unionByName(members.select(F.col("vec_id").alias("a"), F.col("low").alias("b")))
    groups = components(edges, "a", "b").withColumnRenamed("id", "vec_id")
    # each row by its own vector, also where an id is repeated
    linked = members.join(counts, "id", "left").select("vec_id", (F.col("times") - 1 + F.coalesce("others", F.lit(0))).alias("n_links"))
    alone = clean.where("data is null").select("vec_id", F.lit(0).cast("long").alias("n_links"))
    out = linked.unionByName(alone).join(groups, "vec_id", "left")
    component = F.coalesce("component", "vec_id")
    return out.select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"),
        F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"),
    )
