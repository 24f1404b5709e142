"""Reports over the derived tables, each one DataFrame."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import hours as H
from ..functions import scalars as S
from ..functions.arrays import hourly_prices, upper_median, venue_totals
from ..functions.classify import OTHER, RULES, venue_category
from ..functions.region import parse_region, split_address
from ..functions.stats import (
    Pct, aggregate_with_percentiles, bucket_counts, crosstab_counts,
    sum_where, value_share,
)
from ..keys import OBSERVED_RATE, UNIT, VENUE_DAY
from ..operators.blocking import mode_share
from ..operators.market import revenue_per_area, revenue_rows, with_fill
from ..operators.occupancy import future_only, hour_counts, known_category, with_masks
from ..operators.relational import top_n

WIDE = ["sigungu", "eupmyeondong", "category"]


def _on(df: DataFrame, date, name: str = "observed_date") -> DataFrame:
    return df.where(F.col(name) == F.lit(date).cast("date"))


def _n() -> Column:
    return F.count(F.lit(1))


def _clean() -> Column:
    return ~F.col("is_blocked_suspect")


def _mean(c: str, scale: int, digits: int, times: int = 1) -> Column:
    """Rounded mean of a decimal column with `scale` digits."""
    units = F.sum((F.col(c) * 10**scale).cast("long"))
    return S.ratio(units * times, F.count(c) * 10**scale, digits, 12)


def fill_summary(fill: DataFrame, date) -> DataFrame:
    percent = F.col("fill_rate") * 100
    busy = F.col("booked_hours") > 0
    return aggregate_with_percentiles(
        _on(fill, date), [],
        [
            _n().alias("spaces"), F.sum("booked_hours").alias("booked"),
            F.sum("open_slot_hours").alias("open_h"),
            _mean("open_hours_day", 2, 1).alias("avg_open_day"),
            _mean("fill_rate", 4, 1, 100).alias("avg_fill"),
            F.count_if("is_blocked_suspect").alias("suspect"), F.count_if(busy).alias("with_any"),
            F.count_if(busy & F.col("is_blocked_suspect")).alias("any_suspect"),
        ],
        {"med_fill": Pct(percent, 50, 2, 1), "med_clean": Pct(F.when(_clean(), percent), 50, 2, 2)},
    )


def dummy_summary(revenue: DataFrame, date) -> DataFrame:
    return _on(revenue, date).agg(
        sum_where("dummy_h").alias("dummy_hours"), sum_where("dummy_rev").alias("dummy_revenue"),
        F.count_if(F.col("dummy_h") > 0).alias("spaces"),
    )


def revenue_summary(revenue: DataFrame, fill: DataFrame, date) -> DataFrame:
    clean = lambda c: F.when(_clean(), F.col(c))
    return aggregate_with_percentiles(
        with_fill(_on(revenue, date), fill), [],
        [_n().alias("n"), F.count_if(F.col("short_booked_h") > 0).alias("active")],
        {
            "med": Pct(clean("rev_month_short")), "p90": Pct(clean("rev_month_short"), 90),
            "max_med": Pct(clean("rev_month_max")), "adr": Pct(clean("adr"), 50, 1),
        },
    )


def package_summary(revenue: DataFrame, date) -> DataFrame:
    cut, rev = F.col("pkg_cut_all"), F.col("rev_month_all")
    share = F.when((F.col("n_pkg_blocks") > 0) & (rev > 0), cut / (rev + cut))
    return aggregate_with_percentiles(
        _on(revenue, date), [],
        [
            F.count_if(F.col("n_pkg_blocks") > 0).alias("spaces"),
            sum_where("n_pkg_blocks").alias("blocks"), sum_where("pkg_cut_all").alias("cut"),
        ],
        {"share": Pct(share, 50, 8, 3)},
    )


def package_list_summary(packages: DataFrame, date) -> DataFrame:
    return _on(packages, date).agg(
        _n().alias("n_rows"), F.count_distinct("space_id").alias("spaces"),
        F.count_if(F.col("shour") >= F.col("ehour")).alias("wrap"),
    )


def interval_summary(revenue: DataFrame, fill: DataFrame, date) -> DataFrame:
    low, high = F.col("rev_month_all"), F.col("rev_month_all_ceil")
    counts = _clean() & (low > 0)
    return aggregate_with_percentiles(
        with_fill(_on(revenue, date), fill), [],
        [F.sum("n_rsv_blocks").alias("blocks")],
        {
            "lo": Pct(F.when(counts, low)), "hi": Pct(F.when(counts, high)),
            "mult": Pct(F.when(counts, high / low), 50, 8, 2),
        },
    )


def settled_vs_short(
    settled: DataFrame, revenue: DataFrame, fill: DataFrame, as_of
) -> DataFrame:
    """Counted venues with their projected figures of the same day, suspects out."""
    s = _on(settled, as_of, "as_of").where(F.col("booked_h") > 0)
    s = s.select("space_id", F.col("as_of").alias("observed_date"), "rev_day")
    r = revenue.select(*VENUE_DAY, "short_rev_day")
    return with_fill(s.join(r, VENUE_DAY), fill).where(_clean())


def settled_summary(settled: DataFrame, revenue: DataFrame, fill: DataFrame, as_of) -> DataFrame:
    day = _on(settled, as_of, "as_of")
    head = day.agg(
        _n().alias("n"), F.max("n_days").alias("max_days"),
        S.ratio(F.sum("n_days"), F.count("n_days"), 1, 6).alias("avg_days"),
        S.ratio(F.sum("n_days_final"), F.count("n_days_final"), 1, 6).alias("avg_final"),
        F.min("from_date").alias("from_d"), F.max("to_date").alias("to_d"),
        F.count_if(F.col("booked_h") > 0).alias("active"), F.lit(1).alias("one"),
    )
    pairs = settled_vs_short(settled, revenue, fill, as_of)
    both = aggregate_with_percentiles(
        pairs, [], [_n().alias("n_compared"), F.lit(1).alias("one")],
        {
            "settled_day": Pct(F.col("rev_day"), 50, 1), "short_day": Pct(F.col("short_rev_day"), 50, 1)
        },
    )
    return head.join(both, "one").drop("one")


def load_summary(obs: DataFrame, date) -> DataFrame:
    return _on(obs, date).agg(
        F.count_distinct("space_id").alias("spaces"), _n().alias("n_rows"),
        F.min("target_date").alias("from_d"), F.max("target_date").alias("to_d"),
        F.sum("n_booked").alias("booked"), F.sum("n_slots").alias("slots"),
        S.ratio(F.sum("n_booked") * 100, F.sum("n_slots"), 1, 6).alias("pct"),
    )


def overview(revenue: DataFrame, fill: DataFrame, venues: DataFrame, other: str = OTHER) -> DataFrame:
    rows = with_fill(revenue, fill).join(
        known_category(venues, other).select("space_id"), "space_id"
    )
    return rows.agg(
        _n().alias("n"), F.count_if(_clean()).alias("clean"),
        F.count_if("is_blocked_suspect").alias("blocked"),
        F.count_if(_clean() & (F.col("short_booked_h") > 0)).alias("active"),
    )


def occupancy_buckets(revenue: DataFrame, fill: DataFrame, venues: DataFrame) -> DataFrame:
    rows = with_fill(revenue, fill).where(_clean()).join(venues.select("space_id"), "space_id")
    f = F.col("all_fill")
    span = lambda a, b: (f >= a) & (f < b)
    return bucket_counts(
        rows,
        {
            "zero": F.col("all_booked_h") == 0,
            "to_2": (f > 0) & (f < 0.02), "to_5": span(0.02, 0.05),
            "to_10": span(0.05, 0.10), "to_20": span(0.10, 0.20), "over_20": f >= 0.20,
        },
    )


def category_table(
    revenue: DataFrame, fill: DataFrame, venues: DataFrame, min_n: int = 30, other: str = OTHER
) -> DataFrame:
    """Per category, ordered by the share of clean venues with near bookings."""
    rows = with_fill(revenue, fill).join(
        known_category(venues, other).select("space_id", "category"), "space_id"
    )
    active = _clean() & (F.col("short_booked_h") > 0)
    clean = lambda c: F.when(_clean(), F.col(c))
    table = aggregate_with_percentiles(
        rows, ["category"],
        [
            _n().alias("n"), F.count_if(_clean()).alias("clean"),
            F.count_if(active).alias("active"),
        ],
        {
            "med_active": Pct(F.when(active, F.col("rev_month_short"))),
            "p90": Pct(clean("rev_month_short"), 90), "max_med": Pct(clean("rev_month_max")),
            "adr": Pct(clean("adr"), 50, 1),
        },
    )
    share = F.col("active") / F.nullif("clean", F.lit(0).cast("long"))
    return table.where(F.col("n") >= min_n).orderBy(F.desc_nulls_first(share), "category")


def market_table(
    revenue: DataFrame, fill: DataFrame, venues: DataFrame, snaps: DataFrame, min_clean: int = 5,
    other: str = OTHER,
) -> DataFrame:
    """Districts by category with at least `min_clean` clean venues."""
    rows = known_category(revenue_rows(revenue, fill, venues, snaps), other)
    clean = lambda c: F.when(_clean(), F.col(c))
    table = aggregate_with_percentiles(
        rows, WIDE,
        [
            F.count_if(_clean()).alias("n_clean"),
            F.count_if(_clean() & (F.col("short_booked_h") > 0)).alias("n_active"),
        ],
        {
            "med": Pct(clean("rev_month_short"), 50, 0, 1),
            "p25": Pct(clean("rev_month_short"), 25, 0, 2),
            "fill": Pct(clean("short_fill"), 50, 4, 5),
            "rpp": Pct(revenue_per_area(), 50, 6, 2),
            "pyeong": Pct(F.col("total_pyeong"), 50, 2, 3),
        },
    )
    return table.where(F.col("n_clean") >= min_clean)


def market_candidates(
    revenue: DataFrame, fill: DataFrame, venues: DataFrame, snaps: DataFrame, min_clean: int = 5,
    n: int = 15, other: str = OTHER,
) -> DataFrame:
    """Markets where even the lower quartile earns something: the top `n`."""
    table = market_table(revenue, fill, venues, snaps, min_clean, other)
    order = [F.desc("p25"), F.desc("med"), *[F.asc_nulls_last(c) for c in WIDE]]
    return top_n(table.where(F.col("p25") > 0), order, n)


def market_candidate_counts(
    revenue: DataFrame, fill: DataFrame, venues: DataFrame, snaps: DataFrame, min_clean: int = 5,
    other: str = OTHER,
) -> DataFrame:
    table = market_table(revenue, fill, venues, snaps, min_clean, other)
    return table.agg(F.count_if(F.col("p25") > 0).alias("n_above_zero"), _n().alias("n_all"))


def pattern_shares(obs: DataFrame, closed: DataFrame) -> DataFrame:
    """Pattern statistics over all observation days at once. A pattern is the count of each open
    booked hour; 24 sums stand for the merged list of hours."""
    days = with_masks(future_only(obs)).join(closed, OBSERVED_RATE)
    days = days.withColumn("m", H.without("booked_mask", "closed_mask"))
    patterns = days.groupBy(*UNIT, "target_date").agg(
        hour_counts("m").alias("hours"), F.sum(H.n_hours("m")).alias("n_hours")
    )
    shares = mode_share(patterns.where(F.col("n_hours") > 0), ["space_id"], "hours")
    return shares.select(
        "space_id", "days_with_booking", F.col("n_pattern").alias("n_distinct"), "top_n",
        S.ratio("top_n", "days_with_booking", 3, 5).alias("mode_share"),
    )


def blocking_audit(
    obs: DataFrame, closed: DataFrame, fill: DataFrame, venues: DataFrame, min_fill: float = 0.3,
    n: int = 15,
) -> DataFrame:
    """Fullest venues with their pattern statistics, joined by venue alone."""
    rows = (
        pattern_shares(obs, closed)
        .join(fill.select(*VENUE_DAY, "fill_rate").where(F.col("fill_rate") >= min_fill), "space_id")
        .join(venues.select("space_id", "name"), "space_id")
    )
    top = top_n(rows, [F.desc("fill_rate"), F.asc("space_id"), F.asc("observed_date")], n)
    return top.withColumn("pct", S.rounded(F.col("fill_rate") * 100, 1, 6)).drop("fill_rate")


def blocking_audit_counts(
    obs: DataFrame, closed: DataFrame, fill: DataFrame, min_fill: float = 0.05
) -> DataFrame:
    rows = pattern_shares(obs, closed).join(fill.select("space_id", "fill_rate"), "space_id")
    suspect = F.col("mode_share") >= 0.8
    full = F.col("fill_rate") >= min_fill
    return rows.agg(
        F.count_if(full).alias("n_full"), F.count_if(full & suspect).alias("suspect_full"),
        F.count_if(full & (F.col("n_distinct") == 1)).alias("identical_full"),
        _n().alias("n_all"), F.count_if(suspect).alias("suspect_all"),
    )


def supply_rows(snapshots: DataFrame, rules=RULES, default: str = OTHER) -> DataFrame:
    """Place, category, price and floor area of each listed venue, as posted."""
    d = snapshots.where(F.col("detail").isNotNull())
    region = parse_region("detail.location.addr", "detail.location.cortar_no")
    plain = split_address("detail.location.addr")
    products = F.col("detail.products")
    return d.select(
        F.col("id").alias("space_id"), region["sido"].alias("sido"),
        region["sigungu"].alias("sigungu"), plain["sido"].alias("sido_raw"),
        venue_category("detail", rules, default).alias("category"),
        upper_median(hourly_prices(products)).alias("price"),
        venue_totals(products)["total_pyeong"].alias("pyeong"),
        F.coalesce(F.col("detail.reviews.page.total"), F.lit(0)).alias("reviews"),
    )


def supply_crosstab(
    rows: DataFrame, categories: list[str], sido: str | None = None, n: int = 15
) -> DataFrame:
    """Venues per district and category for the districts with the largest supply."""
    place = rows.where(F.col("sigungu").isNotNull())
    place = place if sido is None else place.where(F.col("sido") == sido)
    return crosstab_counts(place, "sigungu", "category", categories).limit(n)


def supply_medians(
    rows: DataFrame, categories: list[str], sido: str | None = None, n: int = 5, min_n: int = 5
) -> DataFrame:
    """Upper medians of posted price and area per category in the `n` largest districts."""
    top = supply_crosstab(rows, categories, sido, n).select("sigungu")  # at most n rows
    place = rows if sido is None else rows.where(F.col("sido") == sido)
    chosen = place.where(F.col("category").isin(categories)).join(F.broadcast(top), "sigungu")
    table = aggregate_with_percentiles(
        chosen, ["sigungu", "category"], [_n().alias("n")],
        {
            "price": Pct(F.col("price"), upper=True),
            "pyeong": Pct(F.col("pyeong"), scale=2, digits=2, upper=True),
        },
    )
    return table.where(F.col("n") >= min_n)


# Fixed value: milliseconds of a mean month.
MONTH_MS = 2_630_000_000


def snapshot_medians(rows: DataFrame, vintage: DataFrame, as_of) -> DataFrame:
    """Per category the upper medians of age, reviews, review pace, price and area."""
    aged = rows.join(vintage.select("space_id", "registered"), "space_id", "left")
    ms = F.datediff(F.lit(as_of).cast("date"), F.col("registered").cast("date")) * F.lit(86_400_000).cast("long")
    months = F.greatest(F.lit(1), F.floor(ms / MONTH_MS + 0.5)).cast("int")
    aged = aged.withColumn("months", F.when(F.col("registered").isNotNull(), months))
    aged = aged.withColumn("pace", S.ratio("reviews", "months", 2, 12))
    some = lambda c: F.when(F.col(c) != 0, F.col(c))
    return aggregate_with_percentiles(
        aged, ["category"], [_n().alias("n")],
        {
            "months": Pct(F.col("months"), upper=True), "reviews": Pct(F.col("reviews"), upper=True),
            "pace": Pct(F.col("pace"), scale=2, digits=2, upper=True),
            "price": Pct(some("price"), upper=True),
            "pyeong": Pct(some("pyeong"), scale=2, digits=2, upper=True),
        },
    ).orderBy("category")


def category_share(rows: DataFrame) -> DataFrame:
    return value_share(rows, "category")


def region_share(rows: DataFrame, n: int = 8) -> DataFrame:
    return value_share(rows, "sido_raw").limit(n)


def observation_days(obs: DataFrame) -> DataFrame:
    """Rows, venues and last target date of each observation day."""
    return obs.groupBy("observed_date").agg(
        _n().alias("n_rows"), F.count_distinct("space_id").alias("spaces"),
        F.max("target_date").alias("last_target"),
    )


def target_coverage(obs: DataFrame, as_of) -> DataFrame:
    """Per past target date: nearest lead and number of observation days."""
    past = obs.where(F.col("target_date") < F.lit(as_of).cast("date"))
    return past.groupBy("target_date").agg(
        F.min(S.lead_days()).alias("nearest_lead"),
        F.count_distinct("observed_date").alias("n_observed"),
    )


