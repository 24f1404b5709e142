"""Calendars that are blocked rather than booked: the same hours, day after day."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import hours as H
from ..functions.scalars import ratio
from ..keys import OBSERVED_RATE, UNIT, VENUE_DAY
from ..sources.writers import attach_flags
from .occupancy import future_only, on_day

SUSPECT_SHARE_TENTHS = 8


def booked_patterns(obs: DataFrame, closed: DataFrame, date=None) -> DataFrame:
    """Open booked hours per unit and day, ascending, rate types merged with repeats kept.

    A group holds the rate types of one unit on one day: the observation key bounds it.
    """
    days = future_only(on_day(obs, date)).join(closed, OBSERVED_RATE, "left")
    hours = H.open_booked("booked_hours", F.coalesce(F.col("closed_mask"), F.lit(0)))
    booked = days.select(*UNIT, "observed_date", "target_date", hours.alias("hrs")).where(
        F.size("hrs") > 0
    )
    return booked.groupBy(*UNIT, "observed_date", "target_date").agg(
        F.sort_array(F.flatten(F.collect_list("hrs"))).alias("hrs")
    )


def mode_share(df: DataFrame, group: list[str], pattern: str) -> DataFrame:
    """Rows, distinct patterns and the count of the most frequent pattern per group. Counted per
    pattern first, so a group with very many rows is spread over its patterns."""
    counts = df.groupBy(*group, pattern).agg(F.count(F.lit(1)).alias("n"))
    return counts.groupBy(*group).agg(
        F.sum("n").cast("int").alias("days_with_booking"),
        F.max("n").cast("int").alias("top_n"),
        F.count(F.lit(1)).cast("int").alias("n_pattern"),
    )


def blocking_flags(obs: DataFrame, closed: DataFrame, date=None) -> DataFrame:
    """Venues whose most frequent set of booked hours covers at least 80 % of booked unit-days.
    The test is on the unrounded share."""
    shares = mode_share(booked_patterns(obs, closed, date), VENUE_DAY, "hrs")
    suspect = F.col("top_n") * 10 >= F.col("days_with_booking") * SUSPECT_SHARE_TENTHS
    return shares.select(
        *VENUE_DAY, "days_with_booking", "n_pattern",
        ratio("top_n", "days_with_booking", 3, 5).alias("mode_share"),
        suspect.alias("is_blocked_suspect"),
    )


def flagged_fill(fill: DataFrame, flags: DataFrame) -> DataFrame:
    """Occupancy with blocking flags; venues without bookings are not suspects."""
    return attach_flags(fill, flags, VENUE_DAY)
