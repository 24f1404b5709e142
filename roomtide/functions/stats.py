"""Conditional aggregates and exact percentiles that do not gather a group in one task."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .scalars import col, ratio


def sum_where(value, cond: Column | None = None) -> Column:
    v = col(value) if cond is None else F.when(cond, col(value))
    return F.coalesce(F.sum(v), F.lit(0))


def count_distinct_tuple(*cols, cond: Column | None = None) -> Column:
    """Distinct composite values; a NULL member does not drop the tuple."""
    t = F.struct(*[col(c) for c in cols])
    return F.count_distinct(t if cond is None else F.when(cond, t))


def join_on_keys(left: DataFrame, right: DataFrame, keys: list[str], how: str) -> DataFrame:
    """Join on keys that may be NULL: NULL matches NULL, as it does in a group key."""
    r = right.select(*[F.col(c).alias(f"__{c}") if c in keys else F.col(c) for c in right.columns])
    cond = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"__{c}")) for c in keys])
    return left.join(r, cond, how).drop(*[f"__{c}" for c in keys])


@dataclass(frozen=True)
class Pct:
    """One requested order statistic: `value` at percentile `p` (in hundredths), interpolated.

    `scale` is the number of decimals of `value`; `digits` those of the result (half up).
    `upper` asks for element n div 2 of the sorted values instead.
    """

    value: Column
    p: int = 50
    scale: int = 0
    digits: int = 0
    upper: bool = False


_BUCKETS_PER_E = 64


def _bucket(v: Column) -> Column:
    """Monotone coarse class of a whole number; at most some thousands of classes in all."""
    size = F.floor(F.log1p(F.abs(v).cast("double")) * _BUCKETS_PER_E)
    return F.when(v < 0, -size).otherwise(size).cast("int")


def grouped_percentiles(df: DataFrame, keys: list[str], wanted: dict[str, Pct]) -> DataFrame:
    """One row per key with every order statistic of `wanted`, exact to the last decimal.

    The built-in percentile holds all distinct values of a group in the memory of one task, which
    fails where one group owns a large part of the rows. Here equal values are counted first, the
    counts are summed per coarse value class, the few thousand classes of a group are ranked, and
    only the classes that hold a wanted rank are ranked value by value. Each shuffle is keyed
    finer than the group, so a hot group spreads over many tasks; no values are dropped.
    """
    values: list[tuple[str, Column]] = []
    ids: dict[str, int] = {}
    ranks: dict[int, list[Column]] = {}
    for i, (name, want) in enumerate(wanted.items()):
        text = f"{want.value}|{want.scale}"
        if text not in ids:
            ids[text] = len(values)
            unit = (want.value.cast(f"decimal(38,{want.scale})") * 10**want.scale).cast("long")
            values.append((text, unit))
        ranks.setdefault(ids[text], []).append(
            F.struct(F.lit(i).alias("want"), F.lit(want.p).alias("p"), F.lit(want.upper).alias("upper"))
        )

    pairs = F.array(
        *[F.struct(F.lit(m).alias("m"), unit.alias("v")) for m, (_, unit) in enumerate(values)]
    )
    counts = (
        df.select(*keys, F.inline(pairs))
        .where(F.col("v").isNotNull())
        .groupBy(*keys, "m", "v")
        .agg(F.count(F.lit(1)).alias("n"))
        .withColumn("b", _bucket(F.col("v")))
    )
    per_class = counts.groupBy(*keys, "m", "b").agg(F.sum("n").alias("bn"))
    group = W.partitionBy(*keys, "m")
    ranked = per_class.withColumn("total", F.sum("bn").over(group)).withColumn(
        "below", F.sum("bn").over(group.orderBy("b").rowsBetween(W.unboundedPreceding, -1))
    )
    below = F.coalesce(F.col("below"), F.lit(0))

    per_value = F.lit(None)
    for m, structs in ranks.items():
        one = F.array(*structs)
        per_value = F.when(F.col("m") == m, one).otherwise(per_value)
    div = lambda a, b: F.call_function("div", a, b)
    spot = F.col("p").cast("long") * (F.col("total") - 1)
    low = F.when(F.col("upper"), div(F.col("total"), F.lit(2))).otherwise(div(spot, F.lit(100)))
    part = F.when(F.col("upper"), F.lit(0)).otherwise(spot % 100)
    both_ends = F.when(
        F.col("part") > 0, F.array(F.col("low"), F.col("low") + 1)
    ).otherwise(F.array(F.col("low")))
    targets = (
        ranked.select(*keys, "m", "b", "bn", "total", below.alias("below"), F.inline(per_value))
        .withColumn("part", part)
        .withColumn("low", low)
        .withColumn("rank", F.explode(both_ends))
        .where((F.col("below") <= F.col("rank")) & (F.col("rank") < F.col("below") + F.col("bn")))
        .select(
            *keys, "m", "b", F.struct(
                "want", "part", (F.col("rank") - F.col("below")).alias("at"),
                (F.col("rank") == F.col("low")).alias("is_low"),
            ).alias("target"),
        )
    )
    # At most two ranks per request fall into a class. Classes without one are left out here, so
    # only the others are put in order value by value.
    asked = targets.groupBy(*keys, "m", "b").agg(F.collect_list("target").alias("targets"))
    in_class = W.partitionBy(*keys, "m", "b").orderBy("v").rowsBetween(W.unboundedPreceding, 0)
    placed = join_on_keys(counts, asked, [*keys, "m", "b"], "inner").withColumn(
        "upto", F.sum("n").over(in_class)
    )
    hits = placed.select(*keys, "v", "n", "upto", F.inline("targets")).where(
        (F.col("upto") - F.col("n") <= F.col("at")) & (F.col("at") < F.col("upto"))
    )
    # Per key and request one or two values: the lower end, and the upper end of a broken rank.
    ends = []
    for i in range(len(wanted)):
        ends += [
            F.expr(f"max(if(want = {i} AND is_low, v, NULL)) AS low{i}"),
            F.expr(f"max(if(want = {i} AND NOT is_low, v, NULL)) AS high{i}"),
            F.expr(f"max(if(want = {i}, part, NULL)) AS part{i}"),
        ]
    out = []
    for i, (name, want) in enumerate(wanted.items()):
        exact = (
            f"(cast(low{i} AS decimal(20,0)) * 100 + cast(coalesce(high{i}, low{i}) - low{i}"
            f" AS decimal(20,0)) * cast(part{i} AS decimal(3,0)))"
        )
        scaled = f"cast({exact} / cast({10 ** (want.scale + 2)} AS decimal(12,0)) AS decimal(38,10))"
        out.append(F.expr(f"cast(round({scaled}, {want.digits}) AS decimal(18,{want.digits}))").alias(name))
    return hits.groupBy(*keys).agg(*ends).select(*keys, *out)


def aggregate_with_percentiles(
    df: DataFrame, keys: list[str], aggs: list[Column], wanted: dict[str, Pct]
) -> DataFrame:
    """Plain aggregates and percentiles of the same groups; groups without values keep NULLs."""
    if not keys:
        whole = F.lit(0).alias("whole")
        plain = df.agg(*aggs).select("*", whole)
        stats = grouped_percentiles(df.select("*", whole), ["whole"], wanted)
        return plain.join(stats, "whole", "left").drop("whole")
    plain = df.groupBy(*keys).agg(*aggs)
    return join_on_keys(plain, grouped_percentiles(df, keys, wanted), keys, "left")


def bucket_counts(df: DataFrame, conditions: dict[str, Column]) -> DataFrame:
    """Histogram in one row: rows per named condition."""
    return df.agg(
        F.count(F.lit(1)).alias("n"), *[F.count_if(c).alias(name) for name, c in conditions.items()]
    )


def value_share(df: DataFrame, by: str) -> DataFrame:
    """Frequency and share in percent of each value, most frequent first."""
    counts = df.groupBy(by).agg(F.count(F.lit(1)).alias("n"))
    total = df.agg(F.count(F.lit(1))).scalar()
    share = ratio(F.col("n") * 100, total, 1, 6).alias("share_pct")
    return counts.select(by, "n", share).orderBy(F.desc("n"), F.asc_nulls_last(by))


def crosstab_counts(df: DataFrame, rows: str, cols: str, values: list[str]) -> DataFrame:
    """Two-way counts with a row total; the column values are given, so no extra pass is needed."""
    counted = df.where(F.col(cols).isin(values)).groupBy(rows).pivot(cols, values).count().na.fill(0)
    total = reduce(lambda a, b: a + b, [F.col(f"`{v}`") for v in values])
    return counted.withColumn("total", total).orderBy(F.desc("total"), F.asc_nulls_last(rows))
