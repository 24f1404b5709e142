"""Price rules: usual price, party-size terms, dummy prices, bookings as runs of sold hours.

Floor and ceiling amounts are linear in the price with coefficients fixed per rate type, so a day
is priced in one row: hour masks say which hours are open, sold or dummies, and the 24 prices are
summed under those masks. Nothing here shuffles days; only the per-rate-type terms are joined.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import hours as H
from ..functions import scalars as S
from ..keys import OBSERVATION, RATE


def price_baseline(obs: DataFrame, snap) -> DataFrame:
    """Lower-quartile positive hourly price per rate type on the snapshot day; closed hours and
    the day itself count too. Equal prices are counted first: a rate type has few distinct ones,
    and never more than 24 per calendar day, so the percentile's value table stays small."""
    day = obs.where(F.col("observed_date") == F.lit(snap).cast("date"))
    prices = day.select(*RATE, F.explode("hour_prices").alias("p")).where(F.col("p") > 0)
    counts = prices.groupBy(*RATE, "p").agg(F.count(F.lit(1)).alias("n"))
    return counts.groupBy(*RATE).agg(F.percentile(F.col("p"), 0.25, F.col("n")).alias("base_price"))


def guest_terms(rates: DataFrame, units: DataFrame, snap) -> DataFrame:
    """Party-size terms per rate type of one snapshot, with defaults for what is not stated."""
    day = F.col("snapshot_date") == F.lit(snap).cast("date")
    u = units.where(day).select("space_id", "product_id", "min_guest_policy", "max_guest_capacity")
    at_least_one = lambda c: F.greatest(F.coalesce(F.col(c), F.lit(1)), F.lit(1))
    return (
        rates.where(day)
        .join(u, ["space_id", "product_id"], "left")
        .select(
            *RATE,
            F.coalesce(F.col("charging_per_person") == "Y", F.lit(False)).alias("per_person"),
            at_least_one("min_guest_policy").alias("min_guest"),
            at_least_one("max_guest_capacity").alias("max_guest"),
            F.coalesce("person_ceiling", F.lit(0)).alias("ceil_n"),
            F.coalesce("extra_person_price", F.lit(0)).alias("extra"),
            F.coalesce("extra_per_hour", F.lit("N")).alias("extra_per_hour"),
        )
    )


_TERMS = ["per_person", "min_guest", "max_guest", "ceil_n", "extra", "extra_per_hour"]


def price_terms(baseline: DataFrame, guest: DataFrame) -> DataFrame:
    """Everything a day needs from its rate type, one row per rate type. Unknown terms stay NULL."""
    return baseline.join(guest, RATE, "full_outer")


def priced_days(
    days: DataFrame, terms: DataFrame, mult: int = S.DUMMY_MULTIPLE, cap: int = S.DUMMY_CAP
) -> DataFrame:
    """Open days with their price facts.

    `days` has OBSERVATION, is_holiday, open_mask, booked_mask (open hours only), hour_prices and
    price. Added: masks of dummy and sold hours, the 24 prices, the coefficients
    floor = price * unit_floor and ceil = price * unit_ceil + hour_extra, and the sums of a day.
    """
    d = days.where(F.col("open_mask") != 0).join(terms, RATE, "left")
    d = d.withColumn("prices", H.day_prices("hour_prices", "price"))
    dummies = F.aggregate(
        F.transform(
            F.col("prices"),
            lambda p, h: F.when(
                F.coalesce(S.is_dummy(p, "base_price", mult, cap), F.lit(False)), H.bit(h)
            ).otherwise(F.lit(0)),
        ),
        F.lit(0),
        lambda acc, b: acc.bitwiseOR(b),
    )
    # No price of the day reaches either bound: no need to look at the hours one by one.
    reach = F.coalesce(S.is_dummy(F.array_max("prices"), "base_price", mult, cap), F.lit(False))
    per = F.coalesce(F.col("per_person"), F.lit(False))
    hourly = ~per & F.coalesce(F.col("extra_per_hour") == "Y", F.lit(False))
    over = F.greatest(F.col("max_guest") - F.col("ceil_n"), F.lit(0)) * F.col("extra")
    d = d.withColumn(
        "dummy_mask", F.when(reach, H.both(dummies, "open_mask")).otherwise(F.lit(0))
    ).withColumns(
        {
            "sold_mask": H.without("booked_mask", "dummy_mask"),
            "dummy_booked": H.both("booked_mask", "dummy_mask"),
            "known_mask": H.known_hours("prices"),
            "unit_floor": F.when(per, F.col("min_guest")).otherwise(F.lit(1)).cast("long"),
            "unit_ceil": F.when(per, F.col("max_guest")).otherwise(F.lit(1)).cast("long"),
            "hour_extra": F.when(hourly, over).otherwise(F.lit(0)).cast("long"),
            "block_add": S.block_add().cast("long"),
        }
    )
    d = d.withColumns(
        {
            "sold_amt": H.price_sum("prices", "sold_mask"),
            "free_mask": H.without("open_mask", "dummy_mask"),
        }
    )
    sold_known = H.n_hours(H.both("sold_mask", "known_mask"))
    return d.select(
        *OBSERVATION, S.lead_days().alias("lead_days"), "is_holiday",
        "open_mask", "booked_mask", "dummy_mask", "sold_mask", "known_mask", "prices",
        "unit_floor", "unit_ceil", "hour_extra", "block_add",
        H.n_hours("free_mask").alias("open_h"),
        (H.price_sum("prices", "free_mask") * F.col("unit_floor")).alias("open_floor"),
        H.n_hours("dummy_booked").alias("dummy_h"),
        H.price_sum("prices", "dummy_booked").alias("dummy_rev"),
        H.n_hours("sold_mask").alias("sold_h"),
        sold_known.alias("sold_known_h"),
        (F.col("sold_amt") * F.col("unit_floor")).alias("sold_floor"),
        (F.col("sold_amt") * F.col("unit_ceil") + sold_known * F.col("hour_extra")).alias("sold_ceil"),
        H.n_hours(H.run_starts("sold_mask")).alias("n_blocks"),
    )


def price_hours(priced: DataFrame) -> DataFrame:
    """One row per open hour: booked, dummy, lower and upper amount, surcharge per booking."""
    hours = priced.withColumn("hour", F.explode(H.mask_hours("open_mask")))
    price = F.get("prices", F.col("hour"))
    return hours.select(
        *OBSERVATION, "lead_days", "is_holiday", "hour",
        H.has_hour("booked_mask", F.col("hour")).alias("booked"),
        price.alias("price"),
        H.has_hour("dummy_mask", F.col("hour")).alias("dummy"),
        (price * F.col("unit_floor")).alias("floor_amt"),
        (price * F.col("unit_ceil") + F.col("hour_extra")).alias("ceil_amt"),
        "block_add",
    )


def sold_only(hours: DataFrame) -> DataFrame:
    return hours.where(F.col("booked") & ~F.coalesce(F.col("dummy"), F.lit(False)))


def booking_blocks(priced: DataFrame) -> DataFrame:
    """Runs of consecutive sold hours of a day, found in its mask: no sort, no window.

    `blk` is the run's label hour - row_number(); `h0`..`h1` its first and last hour. The prices
    stay attached, so that sums over any part of a block need no join back to the hours.
    """
    runs = priced.where(F.col("sold_mask") != 0).withColumn(
        "h0", F.explode(H.mask_hours(H.run_starts("sold_mask")))
    )
    h1 = F.col("h0") + H.run_length("sold_mask", "h0") - 1
    return runs.select(
        *OBSERVATION, "lead_days", H.run_label("sold_mask", "h0").alias("blk"), "h0",
        h1.alias("h1"),
        (H.span_sum("prices", "h0", h1 + 1) * F.col("unit_floor")).alias("blk_floor"),
        "block_add", F.coalesce("is_holiday", F.lit(False)).alias("is_holiday"),
        "prices", "unit_floor",
    )
