"""Closed hours, occupancy per venue, heat map and lead curve.

All of it works on hour masks. Per rate type and observation the booked days of each hour are
24 sums in one hash aggregate; closed hours, open hours and booked hours follow from those sums,
so the panel is never multiplied by 24.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import hours as H
from ..functions.classify import OTHER
from ..functions.scalars import lead_days, ratio
from ..keys import OBSERVED_RATE, RATE, VENUE_DAY

MIN_DAYS = 14
NEAR_DAYS = 14


def drop_past(slots: DataFrame, target: str, observed: str) -> tuple[DataFrame, DataFrame]:
    """(rows whose target is not before the observation, one-row count of the others)."""
    past = F.col(target) < F.col(observed)
    return slots.where(~past), slots.agg(F.count_if(past).alias("n_skipped"))


def future_only(obs: DataFrame) -> DataFrame:
    """Target strictly after the observation: on the day itself elapsed hours look booked."""
    return obs.where(F.col("target_date") > F.col("observed_date"))


def on_day(obs: DataFrame, date) -> DataFrame:
    """One observation day, or all of them for None; prunes partitions."""
    return obs if date is None else obs.where(F.col("observed_date") == F.lit(date).cast("date"))


def on_or_before(obs: DataFrame, date) -> DataFrame:
    """Observation days up to a date; prunes partitions."""
    return obs.where(F.col("observed_date") <= F.lit(date).cast("date"))


def with_masks(obs: DataFrame) -> DataFrame:
    """Adds `booked_mask`; a table that stores it is used as it is."""
    if "booked_mask" in obs.columns:
        return obs
    return obs.withColumn("booked_mask", H.hour_mask("booked_hours"))


def _hour_sums(mask: str = "booked_mask", where: str = "true") -> list[str]:
    """SQL texts of 24 sums: rows whose mask has the hour."""
    return [f"count_if({where} AND getbit({mask}, {h}) = 1)" for h in range(H.HOURS)]


def _named(sums: list[str], prefix: str) -> list[Column]:
    return [F.expr(f"{text} AS {prefix}{h}") for h, text in enumerate(sums)]


def hour_counts(mask: str = "booked_mask") -> Column:
    """Array of the 24 sums, one aggregate without expanding rows."""
    return F.expr(f"array({', '.join(_hour_sums(mask))})")


def _closed_mask(min_days: int) -> Column:
    """Never seen open on any of at least `min_days` future days."""
    return F.when(F.count(F.lit(1)) >= min_days, F.bit_and("booked_mask")).otherwise(F.lit(0))


def hour_class(obs: DataFrame, date=None, min_days: int = MIN_DAYS) -> DataFrame:
    """Per rate type and hour: days seen, days blocked, closed or not. All 24 hours appear."""
    days = with_masks(future_only(on_day(obs, date)))
    sums = days.groupBy(*OBSERVED_RATE).agg(
        F.count(F.lit(1)).cast("int").alias("n_days"),
        hour_counts().alias("blocked"),
    )
    n_blocked = F.col("n_blocked")
    return sums.select(
        *OBSERVED_RATE, "n_days", F.posexplode("blocked").alias("hour", "n_blocked")
    ).select(
        *OBSERVED_RATE, "hour", "n_days", n_blocked.cast("int").alias("n_blocked"),
        ((F.col("n_days") >= min_days) & (n_blocked == F.col("n_days"))).alias("is_closed"),
    )


def closed_masks(obs: DataFrame, date=None, min_days: int = MIN_DAYS) -> DataFrame:
    """Closed hours per rate type and observation as one mask; same rule as `hour_class`."""
    days = with_masks(future_only(on_day(obs, date)))
    return days.groupBy(*OBSERVED_RATE).agg(_closed_mask(min_days).alias("closed_mask"))


def masks_of_classes(classes: DataFrame) -> DataFrame:
    """Fold a stored hour classification into masks."""
    bits = F.when(F.col("is_closed"), H.bit("hour")).otherwise(F.lit(0))
    return classes.groupBy(*OBSERVED_RATE).agg(F.bit_or(bits).alias("closed_mask"))


def open_only(hours: DataFrame) -> DataFrame:
    return hours.where(~F.col("is_closed"))


def with_day_classes(days: DataFrame, classes: DataFrame) -> DataFrame:
    """Days with the classification of their observation as two masks, `known_mask` and `closed_mask`: unfolded into
    hours, each finds its class in its row, so that days and not hours are joined. A class occurs once per hour."""
    masks = classes.groupBy(*OBSERVED_RATE).agg(
        F.bit_or(H.bit("hour")).alias("known_mask"),
        F.bit_or(F.when(F.col("is_closed"), H.bit("hour")).otherwise(F.lit(0))).alias("closed_mask"),
    )
    return days.join(masks, OBSERVED_RATE)


def with_hour_class(hours: DataFrame, classes: DataFrame) -> DataFrame:
    """Rows per hour with their classification of the same observation: looked up in the row, if the days
    carried it, else joined."""
    if "known_mask" in hours.columns:
        known = hours.where(H.has_hour("known_mask", F.col("hour")))
        return known.withColumn("is_closed", H.has_hour("closed_mask", F.col("hour"))).drop("known_mask", "closed_mask")
    return hours.join(
        classes.select(*OBSERVED_RATE, "hour", "is_closed"), [*OBSERVED_RATE, "hour"]
    )


def open_days(obs: DataFrame, closed: DataFrame, date=None) -> DataFrame:
    """Future days with `open_mask` and `booked_mask` reduced to open hours."""
    days = with_masks(future_only(on_day(obs, date)))
    return days.join(closed, OBSERVED_RATE).withColumns(
        {
            "open_mask": F.lit(H.FULL_DAY).bitwiseAND(F.bitwise_not(F.col("closed_mask"))),
            "booked_mask": H.without("booked_mask", "closed_mask"),
        }
    )


def venue_fill(obs: DataFrame, date=None, min_days: int = MIN_DAYS) -> DataFrame:
    """Occupancy per venue and observation over the hours the venue is really open.

    First one hash aggregate per rate type, which also yields the closed hours, so occupancy needs
    no second pass over the days; then the venue sums. Distinct dates are counted on a scan of the
    keys alone.
    """
    days = with_masks(future_only(on_day(obs, date)))
    near = F.datediff("target_date", "observed_date") <= NEAR_DAYS
    rates = days.groupBy(*OBSERVED_RATE).agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(near).alias("n_near"),
        _closed_mask(min_days).alias("closed_mask"),
        *_named(_hour_sums(), "b"),
        *_named(_hour_sums(where=f"datediff(target_date, observed_date) <= {NEAR_DAYS}"), "s"),
    )
    closed_n = H.n_hours("closed_mask")
    still = lambda prefix: F.expr(
        " + ".join(f"if(getbit(closed_mask, {h}) = 1, 0, {prefix}{h})" for h in range(H.HOURS))
    )
    slim = rates.select(
        *OBSERVED_RATE, closed_n.alias("closed_n"),
        (F.col("n") * (H.HOURS - closed_n)).alias("open_h"), still("b").alias("booked_h"),
        (F.col("n_near") * (H.HOURS - closed_n)).alias("open_near"), still("s").alias("booked_near"),
    )
    venues = slim.groupBy(*VENUE_DAY).agg(
        F.count_distinct("product_id").cast("int").alias("n_products"),
        F.count(F.lit(1)).alias("n_rates"),
        *[F.sum(c).cast("int").alias(c)
          for c in ("closed_n", "open_h", "booked_h", "open_near", "booked_near")],
    )
    dates = days.groupBy(*VENUE_DAY).agg(F.count_distinct("target_date").cast("int").alias("n_days"))
    return venues.join(dates, VENUE_DAY).select(
        *VENUE_DAY, "n_products", "n_days",
        ratio("open_h", F.col("n_days") * F.col("n_rates"), 2, 5).alias("open_hours_day"),
        F.col("closed_n").alias("closed_hours"),
        F.col("open_h").alias("open_slot_hours"),
        F.col("booked_h").alias("booked_hours"),
        ratio("booked_h", "open_h", 4, 6).alias("fill_rate"),
        F.col("open_near").alias("open_14d"),
        F.col("booked_near").alias("booked_14d"),
        ratio("booked_near", "open_near", 4, 6).alias("fill_rate_14d"),
    )


def clean_only(df: DataFrame) -> DataFrame:
    """Without venues whose calendar looks blocked."""
    return df.where(~F.col("is_blocked_suspect"))


def known_category(df: DataFrame, other: str = OTHER) -> DataFrame:
    return df.where(F.col("category") != other)


def market_venues(fill: DataFrame, venues: DataFrame, other: str) -> DataFrame:
    """Venue-days that count for market curves, with category and district."""
    clean = clean_only(fill).select(*VENUE_DAY)
    places = known_category(venues, other).select("space_id", "category", "sigungu")
    return clean.join(places, "space_id")


def heatmap(
    obs: DataFrame, closed: DataFrame, fill: DataFrame, venues: DataFrame, date=None,
    other: str = OTHER,
) -> DataFrame:
    """Open and booked hours per category, district, weekday and hour.

    Days are summed per rate type and weekday, then per venue, then per market; the venue's
    category and district join one row per venue and weekday, however many units a venue has. The
    24 hours are unfolded only after the sums per market.
    """
    days = with_masks(future_only(on_day(obs, date)))
    weekly = days.groupBy(*OBSERVED_RATE, "wday").agg(
        F.count(F.lit(1)).alias("n"), *_named(_hour_sums(), "b")
    )
    hours = range(H.HOURS)
    opened = lambda value, h: f"sum(if(getbit(closed_mask, {h}) = 0, {value}, NULL))"
    per_venue = weekly.join(closed, OBSERVED_RATE).groupBy(*VENUE_DAY, "wday").agg(
        *[F.expr(f"{opened('n', h)} AS o{h}") for h in hours],
        *[F.expr(f"{opened(f'b{h}', h)} AS k{h}") for h in hours],
    )
    market = ["category", "sigungu", "observed_date", "wday"]
    sums = per_venue.join(market_venues(fill, venues, other), VENUE_DAY).groupBy(*market).agg(
        *[F.expr(f"sum({c}{h}) AS {c}{h}") for c in "ok" for h in hours]
    )
    cells = ", ".join(f"struct({h} AS hour, o{h} AS n_open, k{h} AS n_booked)" for h in hours)
    return (
        sums.select(*market, F.expr(f"inline(array({cells}))"))
        .where(F.col("n_open").isNotNull())
        .select("*", ratio("n_booked", "n_open", 4, 6).alias("fill_rate"))
    )


def lead_curve(
    obs: DataFrame, closed: DataFrame, fill: DataFrame, venues: DataFrame, date=None,
    other: str = OTHER,
) -> DataFrame:
    """Open and booked hours per category, district and days ahead; districts must be known."""
    places = market_venues(fill, venues, other).where(F.col("sigungu").isNotNull())
    n_open, n_booked = H.n_hours("open_mask"), H.n_hours("booked_mask")
    per_venue = (
        open_days(obs, closed, date)
        .groupBy(*VENUE_DAY, lead_days().alias("lead_days"))
        .agg(F.sum(n_open).alias("n_open"), F.sum(n_booked).alias("n_booked"))
    )
    keys = ["category", "sigungu", "observed_date", "lead_days"]
    return (
        per_venue.join(places, VENUE_DAY)
        .groupBy(*keys)
        .agg(F.sum("n_open").alias("n_open"), F.sum("n_booked").alias("n_booked"))
        .where(F.col("n_open") > 0)
        .select("*", ratio("n_booked", "n_open", 4, 6).alias("fill_rate"))
    )


def latest_closed_masks(closed: DataFrame, as_of) -> DataFrame:
    """Closed hours by the last classification of each rate type up to `as_of`.

    Every classification lists all 24 hours, so the last one per hour is the last one.
    """
    known = closed.where(F.col("observed_date") <= F.lit(as_of).cast("date"))
    return known.groupBy(*RATE).agg(F.max_by("closed_mask", "observed_date").alias("closed_mask"))
