"""Generic row selections on ordered keys: latest, best, islands, suffix minimum, samples."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DateType, NumericType, TimestampType

from ..functions.scalars import col


#: Types whose values an aggregate can replace in place.
FIXED_WIDTH = (NumericType, BooleanType, DateType, TimestampType)


def latest_per(df: DataFrame, keys: list[str], order) -> DataFrame:
    """The row with the largest `order` per key.

    An aggregate rather than a ranking window: it merges before the shuffle, so a key with very
    many rows arrives as one row per map task and never as one sorted partition. Columns of fixed
    width are kept one by one, all of the same row: a struct would have every row sorted by its key.
    """
    rest = [c for c in df.columns if c not in keys]
    if rest and isinstance(order, str) and all(isinstance(df.schema[c].dataType, FIXED_WIDTH) for c in [*rest, order]):
        return df.groupBy(*keys).agg(*[F.max_by(c, order).alias(c) for c in rest])
    best = F.max_by(F.struct(*rest), col(order)).alias("r")
    return df.groupBy(*keys).agg(best).select(*keys, *[F.col(f"r.{c}") for c in rest])


def latest_as_of(df: DataFrame, keys: list[str], order: str, bound) -> DataFrame:
    """The last row per key whose `order` is not after `bound`."""
    return latest_per(df.where(F.col(order) <= bound), keys, order)


def best_per(df: DataFrame, keys: list[str], *order) -> DataFrame:
    """The row with the largest `order` tuple per key."""
    return latest_per(df, keys, F.struct(*[col(o).alias(f"k{i}") for i, o in enumerate(order)]))


def islands(df: DataFrame, keys: list[str], order: str, label: str = "blk") -> DataFrame:
    """Label runs of consecutive integers: `order - row_number()` is constant within a run."""
    w = W.partitionBy(*keys).orderBy(order)
    return df.withColumn(label, F.col(order) - F.row_number().over(w))


#: Ranges of a global order at most, and values that are looked at for the bounds of each.
RANGES, LOOKED_AT = 200, 20


def _ranges(df: DataFrame, order: list[str]) -> Column:
    """Number of a row's range in a global order: how many bounds its place is not before.

    The bounds are literals, taken from a bounded random sample of the places, of which every task sends no more than
    are looked at. Any bounds give the same results; equal places share a range."""
    place = F.struct(*[F.col(c) for c in order])
    n = min(RANGES, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    some = df.select(*order).orderBy(F.rand(7)).limit(n * LOOKED_AT).collect()
    ranked = sorted({tuple(r) for r in some}, key=lambda r: tuple((v is not None, v) for v in r))
    bounds = ranked[len(ranked) // n:: max(1, len(ranked) // n)][: n - 1]
    types = [df.schema[c].dataType for c in order]
    literal = lambda row: F.struct(*[F.lit(v).cast(t).alias(c) for v, t, c in zip(row, types, order, strict=True)])
    if not bounds:
        return F.lit(0)
    return F.size(F.filter(F.array(*map(literal, bounds)), lambda b: b <= place))


def suffix_min(df: DataFrame, order: str, value: str, out: str = "suffix_min") -> DataFrame:
    """For each row the smallest `value` among rows with the same or a larger `order`.

    No global window: rows are dealt into ranges of `order`, each range brings its minimum (one row per range on
    the driver), and each row combines the running minimum inside its range with what the later ranges bring. The rows
    are shuffled once.
    """
    dealt = df.withColumn("rng", _ranges(df, [order]))
    lows = {r.rng: r.low for r in dealt.groupBy("rng").agg(F.min(value).alias("low")).collect()}  # one row per range
    after, least = [], None
    for rng in range(max(lows, default=0), -1, -1):
        after.append(F.lit(least).cast(df.schema[value].dataType))
        known = [v for v in (least, lows.get(rng)) if v is not None]
        least = min(known) if known else None
    # Descending order with a frame that grows from the front: a frame that shrinks towards the
    # end would be evaluated anew for every row.
    inside = W.partitionBy("rng").orderBy(F.desc(order)).rangeBetween(W.unboundedPreceding, W.currentRow)
    later = F.get(F.array(*reversed(after)), F.col("rng"))
    return dealt.withColumn(out, F.least(F.min(value).over(inside), later)).drop("rng")


def stride_sample(df: DataFrame, order: list[str], n: int = 12) -> DataFrame:
    """`n` rows at a fixed stride of the order: rows 0, s, 2s, .. with s = rows div n.

    Ranks come from ranges and their row counts, one row per range on the driver, so no task sees the whole order;
    the rows are shuffled once.
    """
    dealt = df.withColumn("rng", _ranges(df, order))
    sizes = {r.rng: r.size for r in dealt.groupBy("rng").agg(F.count(F.lit(1)).alias("size")).collect()}  # one row per range
    starts, rows = [], 0
    for rng in range(max(sizes, default=0) + 1):
        starts.append(rows)
        rows += sizes.get(rng, 0)
    step = F.lit(max(1, rows // n)).cast("long")
    rank = F.row_number().over(W.partitionBy("rng").orderBy(*order)) - 1
    at = rank + F.get(F.array(*[F.lit(s).cast("long") for s in starts]), F.col("rng"))
    return (
        dealt.withColumn("at", at)
        .where((F.col("at") % step == 0) & (F.call_function("div", F.col("at"), step) < n))
        .drop("rng", "at")
    )


def top_n(df: DataFrame, order: list[Column], n: int) -> DataFrame:
    return df.orderBy(*order).limit(n)


def recent_then_oldest_first(df: DataFrame, order: str, n: int) -> DataFrame:
    """The newest `n` rows, returned oldest first."""
    return df.orderBy(F.desc(order)).limit(n).orderBy(F.asc(order))


def fill_from_dictionary(
    df: DataFrame, dictionary: DataFrame, key: str, value: str, ordinal: str
) -> DataFrame:
    """Fill missing `value` from the first dictionary row (by ordinal) with the same key."""
    names = (
        dictionary.where(F.col(key).isNotNull() & F.col(value).isNotNull())
        .groupBy(key)
        .agg(F.min_by(value, ordinal).alias("found"))
    )
    return (
        df.join(names, key, "left")
        .withColumn(value, F.coalesce(F.col(value), F.col("found")))
        .drop("found")
        .select(*df.columns)
    )
