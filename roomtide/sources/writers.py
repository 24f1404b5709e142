"""Write semantics: keyed upserts, replaced partitions, in-batch deduplication."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import col
from ..session import put_in_place

KEEP_OLD = "keep_old"
NEW, NEW_ELSE_OLD, OLD_ELSE_NEW = "new", "new_else_old", "old_else_new"


def upsert(
    old: DataFrame, new: DataFrame, keys: list[str], policy: dict[str, str] | str,
    ordinal: str | None = None, unique: bool = False,
) -> DataFrame:
    """Old table merged with new rows, unique by `keys` in the old table and in the result.

    Of new rows with equal keys one counts: by `ordinal` (a column of `new`, not of `old`) the first
    for "keep_old" and the last for other policies; without an ordinal any one of them. `unique` says that no key
    without nulls is repeated in `new`.

    `policy` is "keep_old" (first write wins) or names the columns a matched row takes over:
    "new", "new_else_old" (NULL does not erase) or "old_else_new" (first value stays). Columns
    that are not named keep the old value. Rows without a partner pass unchanged.
    """
    if ordinal:
        rest = F.struct(*[c for c in old.columns if c not in keys])
        pick = (F.min_by if policy == KEEP_OLD else F.max_by)(rest, ordinal).alias("r")
        new = new.groupBy(*keys).agg(pick).select(*keys, "r.*").select(*old.columns)
    else:
        new = new.select(*old.columns)
        new = new if unique else new.dropDuplicates(keys)
    if policy == KEEP_OLD:
        return old.unionByName(new.join(old.select(*keys), keys, "left_anti"))
    o = old.select(*keys, F.struct(*[c for c in old.columns if c not in keys]).alias("o"))
    n = new.select(*keys, F.struct(*[c for c in old.columns if c not in keys]).alias("n"))

    def merged(c: str) -> Column:
        was, now = F.col(f"o.{c}"), F.col(f"n.{c}")
        both = {
            NEW: now,
            NEW_ELSE_OLD: F.coalesce(now, was),
            OLD_ELSE_NEW: F.coalesce(was, now),
            None: was,
        }[policy.get(c)]
        return F.when(F.col("o").isNull(), now).when(F.col("n").isNull(), was).otherwise(both).alias(c)

    joined = o.join(n, keys, "full_outer")
    return joined.select(*[c if c in keys else merged(c) for c in old.columns])


def fold(rows: DataFrame, keys: list[str], policy: dict[str, str], ordinal: str) -> DataFrame:
    """Rows of several batches as one: what upserts of the batches into an empty table, one after the other by `ordinal`,
    would leave. Keys are unique within a batch. A key with a null matches none, so its rows stay apart."""
    apart = F.when(reduce(Column.__or__, [F.col(k).isNull() for k in keys]), F.col(ordinal)).alias("apart")
    rest = [c for c in rows.columns if c not in (*keys, ordinal)]
    last = [c for c in rest if policy.get(c) == NEW]
    first = [c for c in rest if c not in policy]
    picked = [agg(F.struct(*cs), ordinal).alias(name) for agg, cs, name in ((F.max_by, last, "last"), (F.min_by, first, "first")) if cs]
    known = lambda c: F.when(F.col(c).isNotNull(), F.col(ordinal))
    for c in rest:
        if policy.get(c) in (NEW_ELSE_OLD, OLD_ELSE_NEW):
            picked.append((F.max_by if policy[c] == NEW_ELSE_OLD else F.min_by)(c, known(c)).alias(c))
    of = lambda c: F.col(f"last.{c}") if c in last else F.col(f"first.{c}") if c in first else F.col(c)
    return rows.groupBy(*keys, apart).agg(*picked).select(*keys, *[of(c).alias(c) for c in rest])


# Column policies of the panel tables.
OBSERVATION_POLICY = dict.fromkeys(
    ["n_slots", "booked_hours", "n_booked", "price", "hour_prices"], NEW
)
PACKAGE_POLICY = dict.fromkeys(["name", "shour", "ehour", "price", "available"], NEW)
HOURS_POLICY = dict.fromkeys(["observed_date", "break_times", "break_days", "break_holidays"], NEW)
UNIT_POLICY = {"min_guest_policy": NEW}
VENUE_POLICY = {
    **dict.fromkeys(["last_seen", "name", "host_id", "is_gone"], NEW),
    **dict.fromkeys(
        [
            "addr", "sido", "sigungu", "eupmyeondong", "sido_code", "sigungu_code", "dong_code",
            "cortar_no", "lat", "lng", "category",
        ],
        NEW_ELSE_OLD,
    ),
    "gone_at": OLD_ELSE_NEW,
}
RUN_POLICY = dict.fromkeys(["spaces_ok", "spaces_gone", "reviews_seen"], NEW)


def dedupe_last(df: DataFrame, keys: list[str], ordinal: str | Column) -> DataFrame:
    """Of rows with equal keys the one with the largest ordinal. An aggregate, so repeats already
    merge before the shuffle."""
    rest = [c for c in df.columns if c not in keys and not (isinstance(ordinal, str) and c == ordinal)]
    best = F.max_by(F.struct(*rest), col(ordinal)).alias("r")
    return df.groupBy(*keys).agg(best).select(*keys, *[F.col(f"r.{c}").alias(c) for c in rest])


def replace_partition(
    df: DataFrame, path: str, partition: str = "observed_date", value: str | None = None,
    sort: list[str] | None = None,
) -> None:
    """Replace one partition (`value`, also by an empty result), or all that occur in `df`.

    The rows are complete in a hidden folder before the old ones are touched, so a rebuild that
    fails leaves the old day readable. Running it twice changes nothing. Rows are not gathered per partition value: each task writes
    its own files, so a day of any size spreads over the cluster. Sorting inside the tasks keeps a
    key's rows together for compression, row-group skipping and map-side aggregation.
    """
    if value is not None:
        out = df.sortWithinPartitions(*sort) if sort else df
        replace_table(out.drop(partition), f"{path.rstrip('/')}/{partition}={value}")
        return
    # The write itself wants the rows by partition value: one sort serves both.
    out = df.sortWithinPartitions(partition, *[c for c in sort if c != partition]) if sort else df
    (
        out.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(partition)
        .parquet(path)
    )


def replace_table(df: DataFrame, path: str) -> None:
    """Replace a whole folder once its new rows are written; `df` may read the old ones."""
    parent, _, name = path.rstrip("/").rpartition("/")
    fresh = f"{parent}/.{name}.{uuid.uuid4().hex}"
    df.write.parquet(fresh)
    put_in_place(df.sparkSession, fresh, path)


def sorted_write(df: DataFrame, path: str, keys: list[str]) -> None:
    """JSON lines in key order: a range shuffle, then each task writes its range sorted."""
    df.orderBy(*keys).write.mode("overwrite").json(path)


def attach_flags(fill: DataFrame, flags: DataFrame, keys: list[str]) -> DataFrame:
    """Left-join flag columns; rows without a partner get NULL, the boolean gets false."""
    joined = fill.join(flags, keys, "left")
    return joined.withColumn(
        "is_blocked_suspect", F.coalesce(F.col("is_blocked_suspect"), F.lit(False))
    )


def pending(units: DataFrame, done: DataFrame, keys: list[str]) -> DataFrame:
    """Units that are not in the done list."""
    return units.join(done.select(*keys), keys, "left_anti")


def run_summary(run_date, listing: DataFrame, snapshots: DataFrame, reviews: DataFrame) -> DataFrame:
    """One row per run: venues listed, read and gone, reviews seen."""
    ok = F.col("detail").isNotNull()
    counts = snapshots.agg(
        F.count_if(ok).alias("spaces_ok"), F.count_if(~ok).alias("spaces_gone")
    )
    one = F.count(F.lit(1))
    return counts.select(
        F.lit(run_date).cast("date").alias("run_date"),
        listing.agg(one).scalar().alias("spaces_listed"),
        "spaces_ok", "spaces_gone",
        F.lit(0).cast("long").alias("spaces_failed"),
        reviews.agg(one).scalar().alias("reviews_seen"),
    )


def union_all(*parts: DataFrame) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), parts)
