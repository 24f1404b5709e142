"""Closed hours as validity intervals: a mask holds from the day it was first seen until the next other one."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..keys import RATE
from ..session import stage
from .occupancy import masks_of_classes

KEYS = list(RATE)
LOG = "space_id long, product_id long, rsv_type_id long, closed_mask int, valid_from date"
COLUMNS = [*KEYS, "closed_mask", "valid_from"]


def masks(classes: DataFrame) -> DataFrame:
    """(rate type, closed_mask, valid_from) of stored hour classes, one row per rate type and day."""
    found = masks_of_classes(classes).withColumnRenamed("observed_date", "valid_from")
    return found.select(*[F.col(k).cast("long").alias(k) for k in KEYS], F.col("closed_mask").cast("int").alias("closed_mask"), "valid_from")


def last_before(log: DataFrame, day: Column) -> DataFrame:
    """(rate type, was): the mask that holds on the eve of a day."""
    return log.where(F.col("valid_from") < day).groupBy(*KEYS).agg(F.max_by("closed_mask", "valid_from").alias("was"))


def changes(today: DataFrame, before: DataFrame) -> DataFrame:
    """Rows of a day whose mask is another than before."""
    joined = today.join(before, KEYS, "left")
    return joined.where(F.col("was").isNull() | (F.col("was") != F.col("closed_mask"))).select(*COLUMNS)


def affected(log: DataFrame, today: DataFrame, before: DataFrame, day: Column) -> DataFrame:
    """Rate types for which the mask as of `day` becomes another by `today`."""
    held = log.where(F.col("valid_from") <= day).groupBy(*KEYS).agg(F.max_by("closed_mask", "valid_from").alias("held"))
    now = before.join(today.select(*KEYS, "closed_mask"), KEYS, "full").select(*KEYS, F.coalesce("closed_mask", "was").alias("now"))
    both = held.join(now, KEYS, "full")
    return stage(both.where(~F.col("held").eqNullSafe(F.col("now"))).select(*KEYS), "affected")


def refold(later: DataFrame, today: DataFrame, before: DataFrame, keys: DataFrame) -> DataFrame:
    """Changes on later days of the given rate types, counted from the mask that holds as of today."""
    start = before.join(today.select(*KEYS, "closed_mask"), KEYS, "full").select(*KEYS, F.coalesce("closed_mask", "was").alias("was"))
    seen = later.join(keys, KEYS, "left_semi").join(start, KEYS, "left")
    # a rate type has one row a day
    earlier = F.coalesce(F.lag("closed_mask").over(W.partitionBy(*KEYS).orderBy("valid_from")), "was")
    return seen.withColumn("earlier", earlier).where(F.col("earlier").isNull() | (F.col("earlier") != F.col("closed_mask"))).select(*COLUMNS)


def stored(rows: DataFrame) -> DataFrame:
    return stage(rows.select(*COLUMNS), "log-days")


def change_log(classes: DataFrame) -> DataFrame:
    """The whole log of stored classes at once; equal to folding their days one by one."""
    rows = masks(classes)
    earlier = F.lag("closed_mask").over(W.partitionBy(*KEYS).orderBy("valid_from"))
    return rows.withColumn("was", earlier).where(F.col("was").isNull() | (F.col("was") != F.col("closed_mask"))).select(*COLUMNS)


def intervals(log: DataFrame) -> DataFrame:
    """(rate type, closed_mask, valid_from, valid_to): valid_to is the first day of the next mask, null for the last."""
    following = F.lead("valid_from").over(W.partitionBy(*KEYS).orderBy("valid_from"))
    return log.select(*COLUMNS, following.alias("valid_to"))


def closed_as_of(rows: DataFrame, log: DataFrame, day: str) -> DataFrame:
    """`rows` (of rate types) with the mask that holds on their own `day`: an equi join on the rate type with the
    interval as its condition; rows before the first classification are dropped."""
    span = intervals(log)
    holds = (F.col(day) >= F.col("valid_from")) & (F.col("valid_to").isNull() | (F.col(day) < F.col("valid_to")))
    return rows.join(span, KEYS).where(holds).drop("valid_from", "valid_to")


def latest_masks(log: DataFrame, as_of: Column) -> DataFrame:
    """(rate type, closed_mask) as of one day."""
    return last_before(log, F.date_add(as_of, 1)).withColumnRenamed("was", "closed_mask")
