"""Counted revenue of past dates, each from the last observation before the day."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import hours as H
from ..functions import scalars as S
from ..functions.stats import sum_where
from ..keys import RATE, RATE_DAY
from .occupancy import future_only, latest_closed_masks, with_masks
from .relational import latest_per
from .revenue import pricing

FINAL_LEAD = 1


def past_seen_before(obs: DataFrame, as_of) -> DataFrame:
    """Past target dates, observed strictly before the day."""
    return future_only(obs).where(F.col("target_date") < F.lit(as_of).cast("date"))


def _seen(obs: DataFrame) -> DataFrame:
    cols = [*RATE_DAY, "observed_date", "is_holiday", "booked_mask", "price", "hour_prices"]
    return with_masks(future_only(obs)).select(*cols)


def last_seen(obs: DataFrame) -> DataFrame:
    """The last observation before the day per rate type and target date."""
    return latest_per(_seen(obs), RATE_DAY, "observed_date")


def roll_last_seen(previous: DataFrame, new_obs: DataFrame) -> DataFrame:
    """`last_seen` brought forward by new observation days, without reading the old panel again.

    Keep the result as a table and each day costs one observation day plus the kept rows, which meet in one grouping.
    """
    return latest_per(previous.unionByName(_seen(new_obs)), RATE_DAY, "observed_date")


def counted_days(
    obs: DataFrame, closed: DataFrame, as_of, seen: DataFrame | None = None
) -> DataFrame:
    """Past days as last seen, with open hours and the booked ones among them."""
    if seen is None:
        picked = last_seen(past_seen_before(obs, as_of))
    else:
        picked = seen.where(F.col("target_date") < F.lit(as_of).cast("date"))
    return picked.join(latest_closed_masks(closed, as_of), RATE).withColumns(
        {
            "open_mask": F.lit(H.FULL_DAY).bitwiseAND(F.bitwise_not(F.col("closed_mask"))),
            "booked_mask": H.without("booked_mask", "closed_mask"),
        }
    )


def venue_settled(
    obs: DataFrame, closed: DataFrame, rates: DataFrame, units: DataFrame, packages: DataFrame,
    as_of, final_lead: int = FINAL_LEAD, mult: int = S.DUMMY_MULTIPLE, cap: int = S.DUMMY_CAP,
    same_observation: bool = True, seen: DataFrame | None = None,
) -> DataFrame:
    """Revenue of the dates before `as_of`, counted, not projected.

    `closed` may cover any observations; the last classification of each rate type counts, also
    for rate types that are no longer offered. `seen` is a kept `last_seen` table.
    """
    day = F.lit(as_of).cast("date")
    days = counted_days(obs, closed, as_of, seen)
    p = pricing(days, obs, rates, units, packages, as_of, mult, cap, same_observation)
    final = F.col("lead_days") <= final_lead
    # One row per venue, date and lead; dates of several leads meet again in the venue sums.
    per_date = p.priced.groupBy("space_id", "target_date").agg(
        F.bool_or(F.col("open_h") > 0).alias("any_open"),
        F.bool_or((F.col("open_h") > 0) & final).alias("any_final"),
        F.sum("open_h").alias("open_h"), F.sum("sold_h").alias("booked_h"),
        F.sum("sold_floor").alias("rev"),
        F.sum(F.col("sold_ceil") + F.col("n_blocks") * F.col("block_add")).alias("rev_ceil"),
        sum_where("sold_floor", final).alias("rev_final"),
    )
    totals = per_date.groupBy("space_id").agg(
        F.min("target_date").alias("from_date"), F.max("target_date").alias("to_date"),
        F.count_if("any_open").alias("n_days"), F.count_if("any_final").alias("n_days_final"),
        *[F.sum(c).alias(c) for c in ("open_h", "booked_h", "rev", "rev_ceil", "rev_final")],
    )
    cuts = p.cuts.groupBy("space_id").agg(
        F.sum("cut").alias("cut"), F.count(F.lit(1)).alias("n_pkg")
    )
    t = totals.join(cuts, "space_id", "left").na.fill(0, ["cut", "n_pkg"])
    net = F.col("rev") - F.col("cut")
    return t.select(
        "space_id", day.alias("as_of"), "from_date", "to_date",
        F.col("n_days").cast("int"), F.col("n_days_final").cast("int"),
        F.col("open_h").cast("int"), F.col("booked_h").cast("int"),
        S.ratio("booked_h", "open_h", 4, 6).alias("fill_rate"),
        net.cast("decimal(14,0)").alias("rev"),
        F.col("rev_ceil").cast("decimal(14,0)"),
        S.ratio(net, "n_days", 1, 12).alias("rev_day"),
        S.ratio("rev_final", "n_days_final", 1, 12).alias("rev_day_final"),
        F.col("n_pkg").cast("int").alias("n_days_pkg"),
    )
