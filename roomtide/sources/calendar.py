"""Landed calendar responses -> observation and package rows (narrow, no shuffle)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.hours import HOURS
from ..keys import RATE


def _date(d: str):
    return F.date_format(
        F.make_date(F.col(f"{d}.year"), F.col(f"{d}.month"), F.col(f"{d}.day")), "yyyy-MM-dd"
    ).alias("d")


def flatten_calendar(responses: DataFrame) -> DataFrame:
    """Responses (RATE, observed, days[].times[]) -> one row per day that lists times."""
    day = responses.select(*RATE, "observed", F.explode("days").alias("y")).where(
        F.size("y.times") > 0
    )
    times = F.col("y.times")
    taken = F.filter(times, lambda t: ~F.coalesce(t["available"], F.lit(False)))
    # The first slot of each hour, found by its place. Spelled out, not a lambda in a lambda: stays in generated code.
    by_hour = F.expr("array(" + ", ".join(
        f"get(y.times.price, cast(array_position(y.times.hour, {h}) AS int) - 1)" for h in range(HOURS)
    ) + ")")
    return day.select(
        *RATE, "observed", _date("y"), F.col("y.wday"), F.col("y.hday"),
        F.size(times).alias("n_slots"),
        taken["hour"].cast("array<smallint>").alias("booked"),
        by_hour.alias("hp"),
        F.get(times, F.lit(0))["price"].alias("price"),
    )


def flatten_packages(responses: DataFrame) -> DataFrame:
    """Responses (RATE, observed, days[].packages[]) -> one row per offered package and day."""
    day = responses.select(*RATE, "observed", F.explode("days").alias("y"))
    each = day.select(*RATE, "observed", _date("y"), F.explode("y.packages").alias("p"))
    text = F.lower(F.col("p.available").cast("string"))
    truthy = F.coalesce(~text.isin("false", "0", "", "null"), F.lit(False))
    return each.select(
        *RATE, "observed", "d", F.col("p.id").alias("package_id"), F.col("p.name"),
        F.col("p.shour"), F.col("p.ehour"), F.col("p.price"),
        truthy.cast("string").alias("available"),
    )


def price_variance(responses: DataFrame) -> DataFrame:
    """Per rate type: do prices differ by hour, only by day, or not at all?

    A day's price pattern is compared by its text; the first listed day decides on hours.
    """
    day = (
        responses.select(*RATE, F.posexplode("days").alias("pos", "y"))
        .where(F.size("y.times") > 0)
        .select(*RATE, "pos", F.transform("y.times", lambda t: t["price"]).alias("prices"))
    )
    per = day.groupBy(*RATE).agg(
        F.min_by(F.size(F.array_distinct("prices")), "pos").alias("n_hour_prices"),
        F.count_distinct(F.to_json("prices")).alias("n_day_patterns"),
    )
    kind = (
        F.when(F.col("n_hour_prices") > 1, "by_hour")
        .when(F.col("n_day_patterns") > 1, "by_day")
        .otherwise("flat")
    )
    return per.withColumn("variance", kind)
