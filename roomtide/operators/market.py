"""Market views: venues in context of category, district and radius."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import scalars as S
from ..functions.classify import OTHER
from ..functions.geo import EARTH_M, METRES_PER_DEGREE, within_radius
from ..functions.stats import Pct, aggregate_with_percentiles
from ..keys import MARKET, MARKET_CODES, VENUE_DAY
from ..session import stage
from .nearby import radius_join
from .occupancy import known_category
from .relational import latest_per


# --- joins --------------------------------------------------------------------------------

def live_venues(venues: DataFrame) -> DataFrame:
    return venues.where(~F.col("is_gone") & F.col("vintage_month").isNotNull())


def latest_snapshot(venues: DataFrame, snaps: DataFrame) -> DataFrame:
    """Venues with their newest snapshot, whatever its status."""
    return venues.join(latest_per(snaps, ["space_id"], "snapshot_date"), "space_id")


def with_venue(df: DataFrame, venues: DataFrame) -> DataFrame:
    return df.join(venues.select("space_id", *MARKET), "space_id")


def with_snapshot(df: DataFrame, snaps: DataFrame, date_col: str = "observed_date") -> DataFrame:
    s = snaps.select(
        "space_id", F.col("snapshot_date").alias(date_col), "median_price", "total_pyeong"
    )
    return df.join(s, ["space_id", date_col], "left")


def with_fill(revenue: DataFrame, fill: DataFrame, *more: str) -> DataFrame:
    return revenue.join(fill.select(*VENUE_DAY, "is_blocked_suspect", *more), VENUE_DAY)


def with_baseline(base: DataFrame, baseline: DataFrame) -> DataFrame:
    return base.join(
        baseline.select("category", "nat_operating_rate", "nat_median_rate"), "category"
    )


def reviews_by_venue(reviews: DataFrame, venues: DataFrame) -> DataFrame:
    return reviews.join(
        venues.select("space_id", "category", "sigungu", "dong_code"), "space_id"
    )


# --- review pace --------------------------------------------------------------------------

def venue_base(venues: DataFrame, snaps: DataFrame, as_of) -> DataFrame:
    """Live venues with age, review pace and activity as of a given day."""
    day = F.lit(as_of).cast("date")
    months = S.months_open(day, "vintage_month")
    joined = latest_snapshot(live_venues(venues), snaps).withColumn("months_open", months)
    return joined.select(
        "space_id", *MARKET_CODES, "lat", "lng", "host_id", "vintage_month", "months_open",
        "snapshot_date", "review_total", "median_price", "total_pyeong",
        S.reviews_per_month("review_total", "months_open").alias("reviews_per_month"),
        S.active_within("latest_review_at", day).alias("active_90d"),
        S.is_newcomer(F.col("months_open")).alias("is_newcomer"),
    )


def _incumbent() -> Column:
    return F.col("active_90d") & ~F.col("is_newcomer")


def _pace(cond: Column, p: int, digits: int = 6) -> Pct:
    return Pct(F.when(cond, F.col("reviews_per_month")), p, 3, digits)


def category_baseline(base: DataFrame, other: str = OTHER) -> DataFrame:
    one = F.count(F.lit(1))
    return aggregate_with_percentiles(
        known_category(base, other), ["category"],
        [
            one.alias("n_spaces"),
            S.ratio(F.count_if("active_90d"), one, 10, 18).alias("nat_operating_rate"),
        ],
        {
            "nat_median_rate": _pace(_incumbent(), 50),
            "nat_median_price": Pct(F.col("median_price"), digits=1),
        },
    )


def market_by_dong(base: DataFrame, baseline: DataFrame, other: str = OTHER) -> DataFrame:
    """Per district and category: supply, hosts, review pace of incumbents and newcomers, and the
    pace relative to the category's."""
    rows = with_baseline(known_category(base, other).where(F.col("dong_code").isNotNull()), baseline)
    new = F.col("is_newcomer")
    m = aggregate_with_percentiles(
        rows, MARKET_CODES,
        [
            F.count(F.lit(1)).alias("n_spaces"),
            F.count_if("active_90d").alias("n_active"),
            F.count_distinct("host_id").alias("n_hosts"),
            F.count_if(_incumbent()).alias("n_incumbent_active"),
            F.count_if(new).alias("n_newcomers"),
            F.count_if(new & (F.col("review_total") == 0)).alias("n_newcomers_zero"),
            F.max("nat_median_rate").alias("nat_median_rate"),
            F.max("nat_operating_rate").alias("nat_operating_rate"),
        ],
        {
            "median_rate": _pace(_incumbent(), 50),
            "p25_rate": _pace(_incumbent(), 25),
            "p75_rate": _pace(_incumbent(), 75),
            "newcomer_median_rate": _pace(new, 50),
            "median_price": Pct(F.col("median_price"), digits=1),
            "median_pyeong": Pct(F.col("total_pyeong"), scale=2, digits=3),
        },
    )
    return m.select(
        "*",
        S.ratio("n_active", "n_spaces", 3, 6).alias("operating_rate"),
        S.ratio("n_newcomers_zero", "n_newcomers", 3, 6).alias("newcomer_fail_rate"),
        S.decimal_ratio("median_rate", "nat_median_rate").alias("demand_index"),
        S.capped_ratio("p25_rate", "median_rate", Decimal("1.0")).alias("homogeneity"),
        S.capped_ratio("newcomer_median_rate", "median_rate", Decimal("1.5")).alias(
            "newcomer_absorption"
        ),
    )


def eligible_markets(
    market: DataFrame, min_n: int = 5, min_active: int = 4, min_new: int = 3, min_hosts: int = 4
) -> DataFrame:
    return market.where(
        (F.col("n_spaces") >= min_n)
        & (F.col("n_incumbent_active") >= min_active)
        & (F.col("n_newcomers") >= min_new)
        & (F.col("n_hosts") >= min_hosts)
        & (F.col("operating_rate") >= F.col("nat_operating_rate"))
    )


def overdemand(market: DataFrame) -> DataFrame:
    """Eligible markets by score: demand x homogeneity x absorption of new supply."""
    score = (
        F.col("demand_index") * F.col("homogeneity")
        * F.coalesce(F.col("newcomer_absorption"), F.lit(Decimal(0)))
    )
    return (
        eligible_markets(market)
        .drop("nat_median_rate", "nat_operating_rate", "newcomer_median_rate", "sido_code", "sigungu_code")
        .withColumn("score", S.rounded(score, 4))
        .orderBy(F.desc_nulls_last("score"))
    )


def demand_trend(reviews: DataFrame, venues: DataFrame, other: str = OTHER) -> DataFrame:
    """Reviews per category, district and month. Reviews are counted per venue and month before
    the join, so a venue with very many reviews is one row per month in it."""
    monthly = reviews.groupBy("space_id", S.month_floor("review_date").alias("month")).agg(
        F.count(F.lit(1)).alias("n")
    )
    return (
        known_category(reviews_by_venue(monthly, venues), other)
        .groupBy("category", "sigungu", "dong_code", "month")
        .agg(F.sum("n").alias("reviews"))
    )


def _competition(near: DataFrame, keys: list[str]) -> DataFrame:
    new, one = F.col("is_newcomer"), F.count(F.lit(1))
    return aggregate_with_percentiles(
        near, keys,
        [
            one.alias("n_spaces"), F.count_if("active_90d").alias("n_active"),
            F.count_distinct("host_id").alias("n_hosts"),
            F.count_if(new).alias("n_newcomers"),
            F.count_if(new & (F.col("review_total") == 0)).alias("n_newcomers_zero"),
            S.ratio(F.count_if("active_90d"), one, 3, 6).alias("operating_rate"),
        ],
        {
            "median_rate": _pace(_incumbent(), 50),
            "p25_rate": _pace(_incumbent(), 25),
            "median_price": Pct(F.col("median_price"), digits=1),
            "median_pyeong": Pct(F.col("total_pyeong"), scale=2, digits=3),
            "newcomer_median_rate": _pace(new, 50),
        },
    )


def market_at(
    base: DataFrame, lat: float, lng: float, radius_m: int = 1000, category: str | None = None
) -> DataFrame:
    """Competition around a point, per category, largest first."""
    near = within_radius(base.where(F.col("lat").isNotNull()), lat, lng, radius_m)
    if category is not None:
        near = near.where(F.col("category") == category)
    return _competition(near, ["category"]).orderBy(F.desc("n_spaces"))


def market_near(points: DataFrame, key: str, base: DataFrame, radius_m: int = 1000) -> DataFrame:
    """Competition around each point of a table, per point and category; `key` names the points."""
    met = radius_join(points, base, radius_m).select(F.col(f"point.{key}").alias(key), "place.*")
    return _competition(stage(met, "near-points"), [key, "category"])


#: Body of the SQL table function; percentiles are taken of whole numbers, so they are exact before they are rounded.
_MARKET_AT = """
CREATE OR REPLACE TEMPORARY FUNCTION {name}(
  at_lat DOUBLE, at_lng DOUBLE, radius_m DOUBLE DEFAULT 1000, only_category STRING DEFAULT NULL
)
RETURNS TABLE (
  category STRING, n_spaces BIGINT, n_active BIGINT, n_hosts BIGINT, n_newcomers BIGINT, n_newcomers_zero BIGINT,
  operating_rate DECIMAL(6,3), median_rate DECIMAL(20,6), p25_rate DECIMAL(20,6), median_price DECIMAL(20,1),
  median_pyeong DECIMAL(20,3), newcomer_median_rate DECIMAL(20,6)
)
RETURN
SELECT category, count(*), count_if(active_90d), count(DISTINCT host_id), count_if(is_newcomer),
  count_if(is_newcomer AND review_total = 0),
  CAST(round(CAST(count_if(active_90d) AS DECIMAL(20,0)) / count(*), 3) AS DECIMAL(6,3)),
  {incumbent_50}, {incumbent_25}, {price_50}, {pyeong_50}, {newcomer_50}
FROM {view}
WHERE lat BETWEEN at_lat - radius_m / {metre} * 1.001 AND at_lat + radius_m / {metre} * 1.001
  AND {distance} <= radius_m AND (only_category IS NULL OR category = only_category)
GROUP BY category
"""


def _sql_percentile(value: str, p: int, scale: int, digits: int) -> str:
    whole = f"CAST(CAST({value} AS DECIMAL(28,{scale})) * {10**scale} AS BIGINT)"
    return f"CAST(round(CAST(percentile({whole}, {p / 100}) AS DECIMAL(28,2)) / {10**scale}, {digits}) AS DECIMAL(20,{digits}))"


def register_market_at(base: DataFrame, name: str = "market_at", view: str = "market_base") -> None:
    """Make `SELECT * FROM market_at(lat, lng[, radius_m[, category]])` available in the session: `base` becomes the
    view, and a temporary SQL table function with defaults reads it. The function is expanded into the query, so
    its conditions reach the scan of the base."""
    base.createOrReplaceTempView(view)
    rate = lambda cond: f"CASE WHEN {cond} THEN reviews_per_month END"
    distance = f"""{2 * EARTH_M} * asin(least(1.0D, sqrt(pow(sin((radians(lat) - radians(at_lat)) / 2), 2)
      + cos(radians(at_lat)) * cos(radians(lat)) * pow(sin(radians(lng - at_lng) / 2), 2))))"""
    base.sparkSession.sql(_MARKET_AT.format(
        name=name, view=view, metre=METRES_PER_DEGREE, distance=distance,
        incumbent_50=_sql_percentile(rate("active_90d AND NOT is_newcomer"), 50, 3, 6),
        incumbent_25=_sql_percentile(rate("active_90d AND NOT is_newcomer"), 25, 3, 6),
        price_50=_sql_percentile("median_price", 50, 0, 1), pyeong_50=_sql_percentile("total_pyeong", 50, 2, 3),
        newcomer_50=_sql_percentile(rate("is_newcomer"), 50, 3, 6),
    ))


# --- occupancy and revenue ----------------------------------------------------------------

def _clean() -> Column:
    return ~F.col("is_blocked_suspect")


def _if_clean(c: str) -> Column:
    return F.when(_clean(), F.col(c))


def booking_market(
    fill: DataFrame, venues: DataFrame, snaps: DataFrame, other: str = OTHER
) -> DataFrame:
    """Occupancy per market. Suspects count as supply but not in the occupancy statistics."""
    rows = known_category(with_snapshot(with_venue(fill, venues), snaps), other)
    busy = F.col("booked_hours") > 0
    rate = lambda c, p: Pct(_if_clean(c), p, 4, 4)
    m = aggregate_with_percentiles(
        rows, [*MARKET, "observed_date"],
        [
            F.count(F.lit(1)).alias("n_spaces"), F.count_if(busy).alias("n_with_booking"),
            F.count_if("is_blocked_suspect").alias("n_blocked_suspect"),
            F.count_if(_clean()).alias("n_clean"),
            F.count_if(_clean() & busy).alias("n_clean_busy"),
        ],
        {
            "median_fill_all": rate("fill_rate", 50), "p25_fill_all": rate("fill_rate", 25),
            "p75_fill_all": rate("fill_rate", 75),
            "median_fill_14d": rate("fill_rate_14d", 50), "p25_fill_14d": rate("fill_rate_14d", 25),
            "p75_fill_14d": rate("fill_rate_14d", 75),
            "median_open_hours": Pct(F.col("open_hours_day"), 50, 2, 1),
            "median_price": Pct(F.col("median_price")),
            "median_pyeong": Pct(F.col("total_pyeong"), 50, 2, 1),
        },
    )
    share = S.ratio("n_clean_busy", "n_clean", 3, 6).alias("share_with_booking")
    return m.select("*", share).drop("n_clean_busy")


def revenue_rows(
    revenue: DataFrame, fill: DataFrame, venues: DataFrame, snaps: DataFrame
) -> DataFrame:
    """Revenue with blocking flag, market and snapshot columns."""
    return with_snapshot(with_venue(with_fill(revenue, fill), venues), snaps)


def revenue_per_area() -> Column:
    return F.when(
        _clean() & (F.col("total_pyeong") > 0), F.col("rev_month_short") / F.col("total_pyeong")
    )


def market_revenue(
    revenue: DataFrame, fill: DataFrame, venues: DataFrame, snaps: DataFrame, other: str = OTHER
) -> DataFrame:
    """Revenue distribution per market, suspects left out of the statistics."""
    rows = known_category(revenue_rows(revenue, fill, venues, snaps), other)
    month = lambda c, p=50: Pct(_if_clean(c), p)
    return aggregate_with_percentiles(
        rows, [*MARKET, "observed_date"],
        [
            F.count(F.lit(1)).alias("n_spaces"),
            F.count_if("is_blocked_suspect").alias("n_blocked"),
            F.count_if(_clean()).alias("n_clean"),
            F.count_if(_clean() & (F.col("short_booked_h") > 0)).alias("n_active"),
        ],
        {
            "rev_median": month("rev_month_short"), "rev_p90": month("rev_month_short", 90),
            "rev_p25": month("rev_month_short", 25),
            "fill_median": Pct(_if_clean("short_fill"), 50, 4, 4),
            "adr_median": Pct(_if_clean("adr"), 50, 1),
            "rev_max_median": month("rev_month_max"),
            "pyeong_median": Pct(F.col("total_pyeong"), 50, 2, 1),
            "price_median": Pct(F.col("median_price")),
            "rev_per_pyeong": Pct(revenue_per_area(), 50, 6),
        },
    )
