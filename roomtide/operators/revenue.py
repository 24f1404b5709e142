"""Revenue per venue from future bookings, as a lower and an upper bound."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import scalars as S
from ..functions.stats import sum_where
from ..keys import VENUE_DAY
from ..session import stage
from .occupancy import open_days
from .packages import package_adjustment
from .pricing import booking_blocks, guest_terms, price_baseline, price_terms, priced_days

SHORT_DAYS = 3


@dataclass(frozen=True)
class Pricing:
    """Priced days, their blocks of sold hours and the package cuts.

    The cuts stage days with their windows; that is done when they are first asked for."""

    priced: DataFrame
    blocks: DataFrame
    make_cuts: Callable[[], DataFrame]

    @cached_property
    def cuts(self) -> DataFrame:
        return self.make_cuts()


def pricing(
    days: DataFrame, obs: DataFrame, rates: DataFrame, units: DataFrame, packages: DataFrame,
    snap, mult: int = S.DUMMY_MULTIPLE, cap: int = S.DUMMY_CAP, same_observation: bool = True,
) -> Pricing:
    """The price rules shared by projected and counted revenue.

    The priced days feed five branches; they are written once to the shared folder, so that the
    joins below them run once and a lost executor costs only its own tasks.
    """
    guest = guest_terms(rates, units, snap)
    terms = price_terms(price_baseline(obs, snap), guest)
    priced = stage(priced_days(days, terms, mult, cap), "priced-days")
    blocks = booking_blocks(priced)
    return Pricing(priced, blocks, lambda: package_adjustment(priced, packages, obs, guest, snap, same_observation))


def venue_revenue(
    obs: DataFrame, closed: DataFrame, rates: DataFrame, units: DataFrame, packages: DataFrame,
    date, short: int = SHORT_DAYS, mult: int = S.DUMMY_MULTIPLE, cap: int = S.DUMMY_CAP,
) -> DataFrame:
    """Monthly revenue of one observation day: near days (lead <= short) and the whole window.

    Lower bounds are reduced by package cuts, upper bounds and the mean hourly price are not.
    Sums run per venue and target date first; that also counts the dates.
    """
    p = pricing(open_days(obs, closed, date), obs, rates, units, packages, date, mult, cap)
    near = F.col("lead_days") <= short
    sums = [
        "open_h", "open_floor", "dummy_h", "dummy_rev", "sold_h", "sold_known_h", "sold_floor",
        "sold_ceil", "n_blocks",
    ]
    per_date = p.priced.groupBy(*VENUE_DAY, "target_date", "lead_days").agg(
        *[F.sum(c).alias(c) for c in sums],
        F.sum(F.col("n_blocks") * F.col("block_add")).alias("surcharge"),
    )
    has_open = F.col("open_h") > 0
    ceil = F.col("sold_ceil") + F.col("surcharge")
    totals = per_date.groupBy(*VENUE_DAY).agg(
        F.count_if(near & has_open).alias("short_days"),
        sum_where("open_h", near).alias("short_open_h"),
        sum_where("sold_h", near).alias("short_booked_h"),
        sum_where("sold_floor", near).alias("short_rev"),
        sum_where(ceil, near).alias("short_ceil"),
        F.count_if(has_open).alias("all_days"),
        F.sum("open_h").alias("all_open_h"),
        F.sum("sold_h").alias("all_booked_h"),
        F.sum("sold_known_h").alias("all_known_h"),
        F.sum("sold_floor").alias("all_rev"),
        F.sum(ceil).alias("all_ceil"),
        F.sum("open_floor").alias("max_rev"),
        F.sum("dummy_h").alias("dummy_h"),
        F.sum("dummy_rev").alias("dummy_rev"),
        F.sum("n_blocks").alias("n_rsv_blocks"),
    )
    cuts = p.cuts.groupBy(*VENUE_DAY).agg(
        sum_where("cut", near).alias("cut_short"), F.sum("cut").alias("cut_all"),
        F.count(F.lit(1)).alias("n_pkg"),
    )
    t = totals.join(cuts, VENUE_DAY, "left").na.fill(0, ["cut_short", "cut_all", "n_pkg"])
    short_net, all_net = F.col("short_rev") - F.col("cut_short"), F.col("all_rev") - F.col("cut_all")
    return t.select(
        *VENUE_DAY,
        F.col("short_days").cast("int"), F.col("short_open_h").cast("int"),
        F.col("short_booked_h").cast("int"),
        S.ratio("short_booked_h", "short_open_h", 4, 6).alias("short_fill"),
        S.ratio(short_net, "short_days", 1, 12).alias("short_rev_day"),
        S.monthly(short_net, "short_days").alias("rev_month_short"),
        F.col("all_days").cast("int"), F.col("all_booked_h").cast("int"),
        S.ratio("all_booked_h", "all_open_h", 4, 6).alias("all_fill"),
        S.monthly(all_net, "all_days").alias("rev_month_all"),
        S.monthly("max_rev", "all_days").alias("rev_month_max"),
        S.ratio("all_rev", "all_known_h", 1, 10).alias("adr"),
        F.col("dummy_h").cast("int"), F.col("dummy_rev").cast("decimal(14,0)"),
        S.monthly("short_ceil", "short_days").alias("rev_month_short_ceil"),
        S.monthly("all_ceil", "all_days").alias("rev_month_all_ceil"),
        F.col("n_rsv_blocks").cast("int"), F.col("n_pkg").cast("int").alias("n_pkg_blocks"),
        S.monthly("cut_short", "short_days").alias("pkg_cut_short"),
        S.monthly("cut_all", "all_days").alias("pkg_cut_all"),
    )
