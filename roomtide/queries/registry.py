"""Registered queries: each reads the driver's tables, or the panel Spark derives from them."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, DecimalType, ShortType, TimestampType

from ..fixtures import AS_OF, DAY, OBSERVED, OTHER, Panel, panel
from ..functions import hours as H
from ..keys import RATE, RATE_DAY, UNIT
from ..operators import blocking, legacy, market, nearby, occupancy, packages, pricing, settled, validity
from ..operators.relational import latest_as_of
from ..plans import daily, reports
from ..session import shared_dir, staging_scope
from ..sources.writers import replace_partition

Query = Callable[[Panel], DataFrame]
_QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    _QUERIES[fn.__name__] = fn
    return fn


def plain(df: DataFrame) -> DataFrame:
    """Decimals as doubles and dates as text, so that both engines return the same Python values."""
    out = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, DecimalType):
            c = c.cast("double")
        elif isinstance(f.dataType, (DateType, TimestampType)):
            c = c.cast("string")
        elif isinstance(f.dataType, ShortType):
            c = c.cast("int")
        out.append(c.alias(f.name))
    return df.select(*out)


def spark_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def bind(fn: Query):
        return lambda spark, sf_dir: plain(fn(panel(spark, sf_dir)))

    return {name: bind(fn) for name, fn in _QUERIES.items()}


# --- occupancy ----------------------------------------------------------------------------

@query
def observation_panel(p: Panel) -> DataFrame:
    total = F.aggregate(
        F.filter("hour_prices", lambda v: v.isNotNull()), F.lit(0).cast("long"), lambda a, v: a + v
    )
    return p.observations.groupBy("space_id", "observed_date").agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum("n_booked").alias("n_booked"),
        F.sum(total).alias("price_sum"), F.count("price").alias("n_priced"),
        F.min("target_date").alias("from_date"),
    )


@query
def hour_class(p: Panel) -> DataFrame:
    return occupancy.hour_class(p.observations)


@query
def venue_fill(p: Panel) -> DataFrame:
    return occupancy.venue_fill(p.observations)


@query
def blocking_flags(p: Panel) -> DataFrame:
    return blocking.blocking_flags(p.observations, p.closed)


@query
def flagged_fill(p: Panel) -> DataFrame:
    return p.fill


@query
def heatmap(p: Panel) -> DataFrame:
    return occupancy.heatmap(p.observations, p.closed, p.fill, p.venues, other=OTHER)


@query
def lead_curve(p: Panel) -> DataFrame:
    return occupancy.lead_curve(p.observations, p.closed, p.fill, p.venues, other=OTHER)


# --- prices and revenue -------------------------------------------------------------------

@query
def price_baseline(p: Panel) -> DataFrame:
    return pricing.price_baseline(p.observations, DAY)


@query
def guest_terms(p: Panel) -> DataFrame:
    return pricing.guest_terms(p.rates, p.units, DAY)


@query
def price_hours(p: Panel) -> DataFrame:
    hours = pricing.price_hours(p.day_pricing.priced)
    sold = F.col("booked") & ~F.col("dummy")
    return hours.groupBy(*UNIT, "lead_days").agg(
        F.count(F.lit(1)).alias("n"), F.count_if("booked").alias("booked"),
        F.count_if("dummy").alias("dummies"),
        *[F.sum(c).alias(c) for c in ("price", "floor_amt", "ceil_amt", "block_add")],
        F.sum(F.when(sold, F.col("hour"))).alias("sold_hour_sum"),
    )


@query
def booking_blocks(p: Panel) -> DataFrame:
    return p.day_pricing.blocks.select(
        *RATE_DAY, "lead_days", "blk", "h0", "h1", "blk_floor", "block_add", "is_holiday"
    )


def _seen(p: Panel, snap: str) -> DataFrame:
    guest = pricing.guest_terms(p.rates, p.units, snap)
    return packages.seen_windows(packages.package_floors(p.packages, guest, snap))


def _catalog(p: Panel, snap: str) -> DataFrame:
    return packages.package_catalog(_seen(p, snap), packages.holiday_calendar(p.observations, snap))


def _windows(p: Panel, priced: DataFrame, snap: str) -> DataFrame:
    sold = packages.sold_unit_days(priced)
    return packages.day_windows(sold, _seen(p, snap), _catalog(p, snap))


@query
def package_catalog(p: Panel) -> DataFrame:
    return packages.catalog_rows(_catalog(p, AS_OF))


@query
def package_windows(p: Panel) -> DataFrame:
    return packages.window_rows(_windows(p, p.past_pricing.priced, AS_OF))


def _offered(p: Panel) -> DataFrame:
    priced = p.day_pricing.priced
    return packages.offered_days(priced, _windows(p, priced, DAY))


@query
def package_hits(p: Panel) -> DataFrame:
    return packages.package_hits(_offered(p)).drop("observed_date")


@query
def overnight_hits(p: Panel) -> DataFrame:
    return packages.overnight_hits(_offered(p), p.day_pricing.priced).drop("observed_date", "head_observed_date")


@query
def package_cuts(p: Panel) -> DataFrame:
    return p.day_pricing.cuts


@query
def package_cuts_settled(p: Panel) -> DataFrame:
    return p.past_pricing.cuts


@query
def package_cuts_any_observation(p: Panel) -> DataFrame:
    """Windows over midnight may end in a morning that was last seen in another observation."""
    return p.counted_pricing(same_observation=False).cuts


@query
def venue_revenue(p: Panel) -> DataFrame:
    return p.venue_revenue(DAY)


@query
def venue_revenue_as_of(p: Panel) -> DataFrame:
    return p.venue_revenue(AS_OF)


@query
def venue_settled(p: Panel) -> DataFrame:
    return p.venue_settled()


@query
def venue_settled_rolled(p: Panel) -> DataFrame:
    """Counted revenue from a kept table that is brought forward one observation day at a time."""
    on = lambda d: p.observations.where(F.col("observed_date") == F.lit(d).cast("date"))
    seen = settled.last_seen(on(OBSERVED[0]))
    for day in OBSERVED[1:]:
        seen = settled.roll_last_seen(seen, on(day))
    return p.venue_settled(seen=seen)


def _landed_late(p: Panel) -> daily.Tables:
    """Tables whose days land out of order; after each landing the kept tables are brought up to the newest day."""
    t = daily.Tables(p.spark, f"{shared_dir(p.spark)}/late-{uuid.uuid4().hex}")
    on = lambda df, d: df.where(F.col("observed_date") == F.lit(d).cast("date"))
    newest = ""
    for day in (OBSERVED[1], OBSERVED[3], OBSERVED[0], OBSERVED[2]):
        for name, table in ((daily.OBSERVATIONS, p.observations), (daily.PACKAGES, p.packages), (daily.CLASSES, p.classes)):
            replace_partition(on(table, day), t.path(name), value=day)
        newest = max(newest, day)
        daily.kept_seen(t).as_of(newest)
        daily.kept_prices(t, newest).as_of(newest)
        with staging_scope(p.spark):
            daily.closed_log(t).as_of(newest)
    return t


@query
def venue_settled_late(p: Panel) -> DataFrame:
    """Counted revenue from kept tables, after days have landed late."""
    t = _landed_late(p)
    closed = daily.closed_as_of(t, AS_OF)
    seen, prices = daily.kept_seen(t).as_of(AS_OF), daily.latest_prices(t, AS_OF)
    return settled.venue_settled(p.observations, closed, p.rates, p.units, prices, AS_OF, seen=seen)


@query
def latest_hour_class_logged(p: Panel) -> DataFrame:
    """Closed hours as of a day, from the log of changes."""
    log = daily.closed_log(_landed_late(p)).as_of(AS_OF)
    hours = validity.latest_masks(log, F.lit(AS_OF).cast("date")).withColumn("hour", F.explode(F.sequence(F.lit(0), F.lit(23))))
    return hours.select(*RATE, "hour", H.has_hour("closed_mask", F.col("hour")).alias("is_closed"))


@query
def closed_changes(p: Panel) -> DataFrame:
    """Days on which the closed hours of a rate type became other ones."""
    return validity.change_log(p.classes).select(*RATE, "valid_from", F.bit_count("closed_mask").alias("n_closed"))


@query
def last_seen(p: Panel) -> DataFrame:
    total = F.aggregate(
        F.filter("hour_prices", lambda v: v.isNotNull()), F.lit(0).cast("long"), lambda a, v: a + v
    )
    picked = settled.last_seen(settled.past_seen_before(p.observations, AS_OF))
    return picked.select(
        *RATE_DAY, "observed_date", F.bit_count("booked_mask").alias("n_booked"),
        total.alias("price_sum"),
    )


@query
def latest_hour_class(p: Panel) -> DataFrame:
    latest = latest_as_of(p.classes, [*RATE, "hour"], "observed_date", F.lit(AS_OF).cast("date"))
    return latest.select(*RATE, "hour", "observed_date", "is_closed")


@query
def latest_packages(p: Panel) -> DataFrame:
    return packages.latest_packages(p.packages, AS_OF).select(
        *UNIT, "package_id", "target_date", "observed_date", "price"
    )


@query
def latest_packages_rolled(p: Panel) -> DataFrame:
    """The same from a kept table that is brought forward one observation day at a time."""
    on = lambda d: p.packages.where(F.col("observed_date") == F.lit(d).cast("date"))
    kept = packages.latest_packages(on(OBSERVED[0]), OBSERVED[0])
    for day in OBSERVED[1:]:
        kept = packages.roll_latest_packages(kept, on(day), day)
    return kept.select(*UNIT, "package_id", "target_date", "observed_date", "price")


# --- markets ------------------------------------------------------------------------------

@query
def venue_base(p: Panel) -> DataFrame:
    return p.base.select(
        "space_id", "category", "dong_code", "months_open", "snapshot_date", "reviews_per_month",
        "active_90d", "is_newcomer",
    )


@query
def category_baseline(p: Panel) -> DataFrame:
    return market.category_baseline(p.base, OTHER)


@query
def market_by_dong(p: Panel) -> DataFrame:
    return market.market_by_dong(p.base, market.category_baseline(p.base, OTHER), OTHER)


@query
def overdemand(p: Panel) -> DataFrame:
    return market.overdemand(market_by_dong(p))


@query
def demand_trend(p: Panel) -> DataFrame:
    return market.demand_trend(p.reviews, p.venues, OTHER)


@query
def market_at(p: Panel) -> DataFrame:
    return market.market_at(p.base, 37.53, 127.0, 2500)


@query
def market_at_category(p: Panel) -> DataFrame:
    return market.market_at(p.base, 37.53, 127.0, 2500, "studio")


@query
def market_at_sql(p: Panel) -> DataFrame:
    """Through the session's SQL table function, with its defaults and with a category."""
    market.register_market_at(p.base)
    return p.spark.sql("""
        SELECT 'all' AS asked, * FROM market_at(37.53D, 127.0D, 2500)
        UNION ALL SELECT 'default', * FROM market_at(37.53D, 127.0D)
        UNION ALL SELECT 'studio', * FROM market_at(37.53D, 127.0D, only_category => 'studio', radius_m => 2500)""")


@query
def venues_near_points(p: Panel) -> DataFrame:
    met = nearby.radius_join(p.places, p.venues, 300)
    return met.select("point.point_id", "place.space_id", F.round("distance_m").cast("int").alias("metres"))


@query
def market_near_points(p: Panel) -> DataFrame:
    return market.market_near(p.places, "point_id", p.base, 400)


@query
def booking_market(p: Panel) -> DataFrame:
    return market.booking_market(p.fill, p.venues, p.snapshots, OTHER)


@query
def market_revenue(p: Panel) -> DataFrame:
    return market.market_revenue(p.revenue, p.fill, p.venues, p.snapshots, OTHER)


@query
def booking_space_raw(p: Panel) -> DataFrame:
    return legacy.booking_space_raw(p.observations)


@query
def booking_market_v1(p: Panel) -> DataFrame:
    raw = legacy.booking_space_raw(p.observations)
    return legacy.booking_market_v1(raw, p.venues, p.snapshots, OTHER)


@query
def booking_market_v2(p: Panel) -> DataFrame:
    return legacy.booking_market_v2(p.fill, p.venues, p.snapshots, OTHER)


@query
def booking_heatmap_raw(p: Panel) -> DataFrame:
    return legacy.booking_heatmap_raw(p.observations, p.venues, OTHER)


# --- reports ------------------------------------------------------------------------------

@query
def fill_summary(p: Panel) -> DataFrame:
    return reports.fill_summary(p.fill, DAY)


@query
def dummy_summary(p: Panel) -> DataFrame:
    return reports.dummy_summary(p.revenue, DAY)


@query
def revenue_summary(p: Panel) -> DataFrame:
    return reports.revenue_summary(p.revenue, p.fill, DAY)


@query
def package_summary(p: Panel) -> DataFrame:
    return reports.package_summary(p.revenue, DAY)


@query
def package_list_summary(p: Panel) -> DataFrame:
    return reports.package_list_summary(p.packages, DAY)


@query
def interval_summary(p: Panel) -> DataFrame:
    return reports.interval_summary(p.revenue, p.fill, DAY)


@query
def settled_summary(p: Panel) -> DataFrame:
    return reports.settled_summary(p.settled, p.revenue, p.fill, AS_OF)


@query
def load_summary(p: Panel) -> DataFrame:
    return reports.load_summary(p.observations, DAY)


@query
def overview(p: Panel) -> DataFrame:
    return reports.overview(p.revenue, p.fill, p.venues, OTHER)


@query
def occupancy_buckets(p: Panel) -> DataFrame:
    return reports.occupancy_buckets(p.revenue, p.fill, p.venues)


@query
def category_table(p: Panel) -> DataFrame:
    return reports.category_table(p.revenue, p.fill, p.venues, other=OTHER)


@query
def market_candidates(p: Panel) -> DataFrame:
    return reports.market_candidates(p.revenue, p.fill, p.venues, p.snapshots, other=OTHER)


@query
def market_candidate_counts(p: Panel) -> DataFrame:
    return reports.market_candidate_counts(p.revenue, p.fill, p.venues, p.snapshots, other=OTHER)


@query
def blocking_audit(p: Panel) -> DataFrame:
    return reports.blocking_audit(p.observations, p.closed, p.fill, p.venues)


@query
def blocking_audit_counts(p: Panel) -> DataFrame:
    return reports.blocking_audit_counts(p.observations, p.closed, p.fill)


@query
def observation_days(p: Panel) -> DataFrame:
    return reports.observation_days(p.observations)


@query
def target_coverage(p: Panel) -> DataFrame:
    return reports.target_coverage(p.observations, AS_OF)
