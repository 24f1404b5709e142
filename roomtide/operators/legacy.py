"""Earlier forms of the occupancy views: raw occupancy without learned closed hours."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import hours as H
from ..functions.classify import OTHER
from ..functions.scalars import ratio
from ..functions.stats import Pct, aggregate_with_percentiles
from ..keys import MARKET, VENUE_DAY
from .market import with_snapshot, with_venue
from .occupancy import hour_counts, known_category, with_masks


def _not_past(obs: DataFrame) -> DataFrame:
    return obs.where(F.col("target_date") >= F.col("observed_date"))


def booking_space_raw(obs: DataFrame) -> DataFrame:
    """Booked over listed slots, the observation day itself included."""
    days = _not_past(obs)
    near = F.datediff("target_date", "observed_date") <= 14
    sums = days.groupBy(*VENUE_DAY).agg(
        F.count(F.lit(1)).alias("n_daysproducts"),
        F.sum("n_booked").alias("booked_hours_total"), F.sum("n_slots").alias("slot_hours_total"),
        F.sum(F.when(near, F.col("n_booked"))).alias("booked_14d"),
        F.sum(F.when(near, F.col("n_slots"))).alias("slots_14d"),
    )
    # One distinct count per scan of two narrow columns: no expansion of the rows.
    dates = days.groupBy(*VENUE_DAY).agg(F.count_distinct("target_date").alias("n_days"))
    units = days.groupBy(*VENUE_DAY).agg(F.count_distinct("product_id").alias("n_products"))
    return (
        sums.join(dates, VENUE_DAY).join(units, VENUE_DAY)
        .withColumn("fill_rate_raw", ratio("booked_hours_total", "slot_hours_total", 4, 8))
        .withColumn("fill_rate_14d", ratio("booked_14d", "slots_14d", 4, 8))
    )


def _medians(rows: DataFrame, busy, all_rate: str, open_hours: bool) -> DataFrame:
    rate = lambda c, p: Pct(F.col(c), p, 4, 4)
    wanted = {
        "median_fill_14d": rate("fill_rate_14d", 50), "p25_fill_14d": rate("fill_rate_14d", 25),
        "p75_fill_14d": rate("fill_rate_14d", 75), "median_fill_all": rate(all_rate, 50),
        "median_price": Pct(F.col("median_price")),
        "median_pyeong": Pct(F.col("total_pyeong"), 50, 2, 1),
    }
    if open_hours:
        wanted["median_open_hours"] = Pct(F.col("open_hours_day"), 50, 2, 1)
    aggs = [F.count(F.lit(1)).alias("n_spaces"), F.count_if(busy).alias("n_with_booking")]
    return aggregate_with_percentiles(rows, [*MARKET, "observed_date"], aggs, wanted)


def booking_market_v1(
    raw: DataFrame, venues: DataFrame, snaps: DataFrame, other: str = OTHER
) -> DataFrame:
    rows = known_category(with_snapshot(with_venue(raw, venues), snaps), other)
    return _medians(rows, F.col("booked_hours_total") > 0, "fill_rate_raw", False)


def booking_market_v2(
    fill: DataFrame, venues: DataFrame, snaps: DataFrame, other: str = OTHER
) -> DataFrame:
    rows = known_category(with_snapshot(with_venue(fill, venues), snaps), other)
    return _medians(rows, F.col("booked_hours") > 0, "fill_rate", True)


def booking_heatmap_raw(obs: DataFrame, venues: DataFrame, other: str = OTHER) -> DataFrame:
    """All 24 hours per category, district and weekday, closed or not."""
    days = with_masks(_not_past(obs))
    weekly = days.groupBy(*VENUE_DAY, "wday").agg(
        F.count(F.lit(1)).alias("n"), hour_counts().alias("b")
    )
    places = known_category(venues, other).select("space_id", "category", "sigungu", "dong_code")
    market = ["category", "sigungu", "dong_code", "observed_date", "wday"]
    sums = weekly.join(places, "space_id").groupBy(*market).agg(
        F.sum("n").alias("n_observations"),
        F.expr(f"array({', '.join(f'sum(b[{h}])' for h in range(H.HOURS))})").alias("booked"),
    )
    cells = sums.select(*market, "n_observations", F.posexplode("booked").alias("hour", "n_booked"))
    return cells.withColumn("fill_rate", ratio("n_booked", "n_observations", 4, 6))
