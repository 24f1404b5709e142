"""Hard negatives by segment summary filtering.

Each vector is stored with summaries of its segments at several levels (one segment, four, sixteen): the
mean times the root of the length, and the deviation, the norm of what is left without the mean. For two
vectors the inner product of a segment is the product of these means, give or take the product of the
deviations; sums over the segments bound the score from both sides. Pairs whose bounds miss what is
asked are dropped at the coarsest level that shows it, the rest goes on to the next level and last to the exact
score. What is asked tightens while a block is read: once k rows of a list are known, only bounds that
reach the k-th of them stay.

Anchors are a stated set, searched against all rows in blocks of `ANCHORS` by `ROWS`, each a group of its
own; blocks return at most k rows for a list, and the lists of all blocks are merged by rank. Positives are
looked for within a label, dealt in blocks too, so a frequent label spreads; negatives in all rows.

Components x become floor(256 * x), saturated at +-2^26; scores are exact integers. Rows with a null id, a null label, a
null vector or a null or non-finite component take no part. Vectors of different length never meet. Rows with equal ids
are rows of their own: an anchor never meets itself, but may meet an equal row, and an anchor row that
occurs twice returns its rows twice. Scores that tie are ordered by vec_id. Other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import settle, stage
from .common import batch_of

SCALE, LIMIT = 256, float(1 << 26)
ANCHOR_EVERY, RELABEL_EVERY, LABELS = 100, 7, 10
POSITIVES, NEGATIVES, LOW, HIGH = 5, 10, 30, 90
SEGMENTS = (1, 4, 16)
ANCHORS, ROWS, CHUNK, PARTITIONS = 4096, 8192, 1024, 20_000
#: Summaries are stored as 32-bit floats; bounds are widened by this share of the product of the norms.
SLACK, SPARSE = 1e-6, 0.02
#: No list is bounded from above beyond this score.
TOP = 1 << 62


def finite(vector: Column) -> Column:
    return vector.isNotNull() & F.forall(vector, lambda v: v.isNotNull() & (F.abs(v) < F.lit(float("inf"))))


def anchor(vec_id: str = "vec_id") -> Column:
    return F.col(vec_id) % ANCHOR_EVERY == 0


def _level(x: np.ndarray, parts: int) -> tuple[np.ndarray, np.ndarray]:
    """Means times root length and deviations of the segments of each row."""
    cuts = np.unique(x.shape[1] * np.arange(parts + 1) // parts)
    if len(cuts) < 2:
        return np.zeros((len(x), 0)), np.zeros((len(x), 0))
    length = np.diff(cuts)
    mean = np.add.reduceat(x, cuts[:-1], axis=1) / length
    rest = x - np.repeat(mean, length, axis=1)
    return mean * np.sqrt(length), np.sqrt(np.add.reduceat(rest * rest, cuts[:-1], axis=1))


def _lists(column: pa.ListArray, dtype) -> tuple[np.ndarray, np.ndarray]:
    """Values of a list column without nulls, and where each list begins and the last one ends."""
    at = column.offsets.to_numpy()
    return column.values.to_numpy(zero_copy_only=False)[at[0]:at[-1]].astype(dtype, copy=False), at - at[0]


def _summarised(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        values, at = _lists(batch.column("x"), np.float64)
        out: list = [None] * batch.num_rows
        size = np.diff(at)
        for d in np.unique(size):
            mine = np.flatnonzero(size == d)
            x = values[at[mine][:, None] + np.arange(d)]
            flat = np.concatenate([part for s in SEGMENTS for part in _level(x, s)], axis=1).astype(np.float32)
            for i, row in zip(mine, flat, strict=True):
                out[i] = row
        yield batch_of({n: (None, batch.column(n)) for n in ("row", "vec_id", "label", "x")} | {"summary": (pa.list_(pa.float32()), out)})


def summaries(vectors: DataFrame) -> DataFrame:
    """The table that is searched: row (a number of its own), vec_id, label, x, summary."""
    c = F.col("embedding").cast("array<double>")
    ready = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("int").alias("label"), c.alias("c"))
    ready = ready.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & finite(F.col("c")))
    label = F.when(F.col("vec_id") % RELABEL_EVERY == 0, (F.col("label") + 1) % LABELS).otherwise(F.col("label"))
    whole = lambda v: F.floor(F.least(F.greatest(v * SCALE, F.lit(-LIMIT)), F.lit(LIMIT))).cast("int")
    x = F.transform("c", whole)
    table = ready.select(F.monotonically_increasing_id().alias("row"), "vec_id", label.cast("int").alias("label"), x.alias("x"))
    return stage(table.mapInArrow(_summarised, "row long, vec_id long, label int, x array<int>, summary array<float>"), "summaries")


# --- search inside a block ----------------------------------------------------------------------

@dataclass
class Side:
    row: np.ndarray
    vec_id: np.ndarray
    label: np.ndarray
    x: np.ndarray
    summary: np.ndarray

    def take(self, which) -> Side:
        return Side(self.row[which], self.vec_id[which], self.label[which], self.x[which], self.summary[which])

    def level(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        sizes = [len(np.unique(self.x.shape[1] * np.arange(s + 1) // s)) - 1 for s in SEGMENTS]
        at = 2 * sum(sizes[:k])
        return self.summary[:, at:at + sizes[k]], self.summary[:, at + sizes[k]:at + 2 * sizes[k]]


class Best:
    """The best k rows of each list; a list is an anchor and a band of scores."""

    def __init__(self, low: np.ndarray, up: np.ndarray, k: int) -> None:
        self.least, self.up, self.k = low.copy(), up, k
        self.lists = [np.zeros((4, 0), np.int64) for _ in range(low.shape[1])]  # anchor, score, vec_id, row

    def wanted(self, a: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """Which of the bounds (rows of anchors `a`, or one for each) may belong to a list."""
        if low.ndim > 1:
            a = a[:, None]
        out = np.zeros(low.shape, bool)
        for b in range(self.up.shape[1]):
            out |= (high >= self.least[a, b]) & (low <= self.up[a, b])
        return out

    def add(self, a: np.ndarray, score: np.ndarray, vec_id: np.ndarray, row: np.ndarray) -> None:
        for b, known in enumerate(self.lists):
            fits = (score >= self.least[a, b]) & (score <= self.up[a, b])
            if not fits.any():
                continue
            new = np.concatenate([known, np.stack([a[fits], score[fits], vec_id[fits], row[fits]])], axis=1)
            new = new[:, np.lexsort((new[3], new[2], -new[1], new[0]))]
            first = np.flatnonzero(np.concatenate(([True], new[0, 1:] != new[0, :-1])))
            rank = np.arange(new.shape[1]) - np.repeat(first, np.diff(np.append(first, new.shape[1])))
            self.lists[b] = new = new[:, rank < self.k]
            last = rank[rank < self.k] == self.k - 1
            self.least[new[0, last], b] = new[1, last]


def inner(a: np.ndarray, b: np.ndarray, paired: bool) -> np.ndarray:
    """Exact inner products of integer vectors; in floating point while that is exact."""
    size = a.shape[1] * float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0))
    if size < 1 << 53:
        a, b = a.astype(np.float64), b.astype(np.float64)
    return (np.einsum("ij,ij->i", a, b) if paired else a @ b.T).astype(np.int64)


def search(anchors: Side, rows: Side, best: Best, same_label: bool) -> None:
    """Add to `best` what the rows hold for the anchors, level by level."""
    norm = lambda s: np.sqrt((s.summary[:, :2].astype(np.float64) ** 2).sum(axis=1)) if s.x.shape[1] else np.zeros(len(s.row))
    a_norm = norm(anchors)
    for at in range(0, len(rows.row), CHUNK):
        part = rows.take(slice(at, at + CHUNK))
        slack = SLACK * a_norm[:, None] * norm(part) + 0.5
        who, what = np.arange(len(anchors.row)), np.arange(len(part.row))
        alive = (anchors.label[:, None] == part.label) == same_label
        alive &= anchors.row[:, None] != part.row
        i = j = None
        for k in range(len(SEGMENTS)):
            (am, ad), (pm, pd) = anchors.level(k), part.level(k)
            if i is None:
                middle, width = am[who] @ pm[what].T, ad[who] @ pd[what].T + slack[np.ix_(who, what)]
                alive &= best.wanted(who, middle - width, middle + width)
                some_a, some_r = alive.any(axis=1), alive.any(axis=0)
                who, what, alive = who[some_a], what[some_r], alive[np.ix_(some_a, some_r)]
                if alive.sum() < SPARSE * alive.size:
                    i, j = np.nonzero(alive)
                    i, j = who[i], what[j]
            else:
                middle = np.einsum("ij,ij->i", am[i], pm[j])
                width = np.einsum("ij,ij->i", ad[i], pd[j]) + slack[i, j]
                stay = best.wanted(i, middle - width, middle + width)
                i, j = i[stay], j[stay]
        if i is None:
            score = inner(anchors.x[who], part.x[what], False)
            i, j = np.nonzero(alive)
            score, i, j = score[i, j], who[i], what[j]
        else:
            score = inner(anchors.x[i], part.x[j], True)
        best.add(i, score, part.vec_id[j], part.row[j])


# --- blocks -------------------------------------------------------------------------------------

def _blocks(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.Table]:
    """The rows of one block at a time; blocks come in order."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        keys = np.stack([batch.column(n).to_numpy(zero_copy_only=False) for n in ("kind", "group", "ablock", "rblock")], axis=1)
        cuts = [0, *(np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1).tolist(), len(keys)]
        for a, b in zip(cuts, cuts[1:], strict=False):
            if a == b:
                continue
            key = tuple(keys[a])
            if held and key != last:
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(a, b - a))
            last = key
    if held:
        yield pa.Table.from_batches(held)


def _side(block: pa.Table) -> Side:
    block = block.combine_chunks()
    x, at = _lists(block.column("x").combine_chunks(), np.int64)
    summary, _ = _lists(block.column("summary").combine_chunks(), np.float32)
    n = block.num_rows
    whole = [block.column(c).to_numpy() for c in ("row", "vec_id", "label")]
    return Side(*whole, x.reshape(n, -1), summary.reshape(n, -1))


def _found(k: int, same_label: bool):
    """Per list of a block its best k rows."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in _blocks(batches):
            is_anchor = block.column("is_anchor").to_numpy()
            if is_anchor.all() or not is_anchor.any():
                continue
            asked = block.filter(pa.array(is_anchor))
            anchors, rows = _side(asked), _side(block.filter(pa.array(~is_anchor)))
            wanted = asked.column("scores").to_pylist()  # of the positives
            bands = 1 if same_label else max(map(len, wanted), default=0)
            low, up = np.full((len(wanted), bands), -TOP if same_label else TOP), np.full((len(wanted), bands), TOP if same_label else -TOP)
            if not same_label:
                for a, scores in enumerate(wanted):
                    for b, s in enumerate(scores):
                        low[a, b], up[a, b] = -(-LOW * s // 100), HIGH * s // 100
            best = Best(low, up, k)
            search(anchors, rows, best, same_label)
            for b, (a, score, vec_id, row) in enumerate(best.lists):
                yield batch_of({
                    "anchor_row": (pa.int64(), anchors.row[a]), "anchor_id": (pa.int64(), anchors.vec_id[a]), "band": (pa.int32(), np.full(len(a), b, np.int32)),
                    "vec_id": (pa.int64(), vec_id), "score": (pa.int64(), score), "row": (pa.int64(), row),
                })

    return run


FOUND = "anchor_row long, anchor_id long, band int, vec_id long, score long, row long"


def _best_of_blocks(anchors: DataFrame, rows: DataFrame, groups: DataFrame, keys: list[str], k: int, same_label: bool) -> DataFrame:
    """Per list its best k rows. `groups` has the number of anchors and rows per `keys`; all pairs of blocks of a
    group meet, each pair in a task's group of its own."""
    parts = lambda c, size: F.ceil(F.col(c) / size).cast("long")
    groups = groups.where("n_anchors > 0").select(*keys, parts("n_anchors", ANCHORS).alias("ablocks"), parts("n_rows", ROWS).alias("rblocks"))
    total = groups.agg(F.sum(F.col("ablocks") * F.col("rblocks"))).first()[0] or 1
    own = lambda n: F.pmod(F.xxhash64("row"), F.col(n))
    every = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1))
    group = F.col("label") if same_label else F.lit(0)
    none = F.lit(None).cast("array<long>")
    columns = ["kind", group.alias("group"), "ablock", "rblock", "is_anchor", "row", "vec_id", "label", "x", "summary", "scores"]
    asked = anchors.join(groups, keys).withColumn("ablock", own("ablocks")).withColumn("rblock", every("rblocks"))
    asked = asked.withColumn("is_anchor", F.lit(True)).select(*columns)
    given = rows.withColumn("scores", none).join(groups, keys).withColumn("rblock", own("rblocks")).withColumn("ablock", every("ablocks"))
    given = given.withColumn("is_anchor", F.lit(False)).select(*columns)
    order = ["kind", "group", "ablock", "rblock"]
    dealt = asked.unionByName(given).repartition(min(3 * total, PARTITIONS), *order).sortWithinPartitions(*order)
    found = dealt.mapInArrow(_found(k, same_label), FOUND)
    first = Window.partitionBy("anchor_row", "band").orderBy(F.desc("score"), "vec_id", "row")
    return found.withColumn("rank", F.row_number().over(first)).where(F.col("rank") <= k)


def _sizes(table: DataFrame, keys: list[str]) -> DataFrame:
    return table.groupBy(*keys).agg(F.count_if(anchor()).alias("n_anchors"), F.count(F.lit(1)).alias("n_rows"))


def mine(vectors: DataFrame, positives: int = POSITIVES, negatives: int = NEGATIVES) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score."""
    return settle(vectors.sparkSession, "hard-negatives", lambda: _mined(vectors, positives, negatives))


def _mined(vectors: DataFrame, positives: int, negatives: int) -> DataFrame:
    table = summaries(vectors).withColumn("kind", F.size("x"))
    anchors = table.where(anchor())
    sizes = stage(_sizes(table, ["kind", "label"]), "label-sizes")
    none = F.lit(None).cast("array<long>")
    near = _best_of_blocks(anchors.withColumn("scores", none), table, sizes, ["kind", "label"], positives, True)
    # at most `positives` rows an anchor
    listed = near.groupBy("anchor_row").agg(F.array_sort(F.collect_list(F.struct("rank", "vec_id", "score"))).alias("found"))
    listed = stage(listed.select(F.col("anchor_row").alias("row"), F.col("found.vec_id").alias("ids"), F.col("found.score").alias("scores")), "positives")
    whole = sizes.groupBy("kind").agg(F.sum("n_anchors").alias("n_anchors"), F.sum("n_rows").alias("n_rows"))
    far = _best_of_blocks(anchors.join(listed.select("row", "scores"), "row"), table, whole, ["kind"], negatives, False)
    named = far.join(listed.withColumnRenamed("row", "anchor_row"), "anchor_row")
    return named.select(
        "anchor_id", F.get("ids", F.col("band")).alias("positive_id"), F.col("rank").cast("int").alias("rank"),
        F.col("vec_id").alias("negative_id"), F.get("scores", F.col("band")).alias("positive_score"), F.col("score").alias("negative_score"),
    )
