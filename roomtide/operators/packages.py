"""Package windows: fixed spans of hours sold below the sum of their hourly prices.

Which way a span was sold is not observable, so the lower revenue bound takes the cheaper one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import hours as H
from ..functions.scalars import HOLIDAY_CLASS, day_class, floor_amt
from ..keys import OBSERVATION, RATE, UNIT
from ..session import stage
from .relational import best_per, latest_per

WINDOW = ["shour", "ehour"]
BLOCK = [*OBSERVATION, "blk"]


def _seen_prices(packages: DataFrame, snap) -> DataFrame:
    seen = packages.where(
        (F.col("observed_date") <= F.lit(snap).cast("date"))
        & (F.col("observed_date") < F.col("target_date"))
        & (F.col("price") > 0)
    )
    return seen.select(*RATE, "package_id", "target_date", "observed_date", *WINDOW, "price")


def latest_packages(packages: DataFrame, snap) -> DataFrame:
    """Last positive price of each package and day seen before that day. The rate type is not
    part of the key."""
    return latest_per(_seen_prices(packages, snap), [*UNIT, "package_id", "target_date"], "observed_date")


def roll_latest_packages(previous: DataFrame, new: DataFrame, snap) -> DataFrame:
    """`latest_packages` brought forward by new observation days, in one grouping. The result can stand in for the
    whole price history wherever `packages` is asked for."""
    merged = previous.unionByName(_seen_prices(new, snap))
    return latest_per(merged, [*UNIT, "package_id", "target_date"], "observed_date")


def holiday_calendar(obs: DataFrame, snap) -> DataFrame:
    """Public holidays as the snapshot day lists them; past days are therefore never holidays."""
    day = obs.where(F.col("observed_date") == F.lit(snap).cast("date"))
    return day.groupBy("target_date").agg(
        F.bool_or(F.coalesce("is_holiday", F.lit(False))).alias("day_is_holiday")
    )


def package_floors(packages: DataFrame, guest: DataFrame, snap) -> DataFrame:
    """Latest packages with their lower amount (smallest party where charged per person)."""
    terms = guest.select(*RATE, "per_person", "min_guest")
    return (
        latest_packages(packages, snap)
        .join(terms, RATE, "left")
        .select(*UNIT, "target_date", *WINDOW, floor_amt("price").cast("long").alias("pkg_floor"))
    )


def seen_windows(floors: DataFrame) -> DataFrame:
    """Cheapest amount per unit, day and window."""
    return floors.groupBy(*UNIT, "target_date", *WINDOW).agg(F.min("pkg_floor").alias("pkg_floor"))


def package_catalog(seen: DataFrame, calendar: DataFrame) -> DataFrame:
    """Cheapest amount per unit and window for each day class, with the cheapest of any day.

    Two levels of minima. All classes of a window are one row with a small map (8 classes), so a
    day that needs prices finds its own class and the fallback in one place.
    """
    dclass = day_class("target_date", "day_is_holiday").alias("dclass")
    fine = (
        seen.join(F.broadcast(calendar), "target_date", "left")  # one row per date of the calendar
        .groupBy(*UNIT, *WINDOW, dclass)
        .agg(F.min("pkg_floor").alias("pkg_floor"))
    )
    return fine.groupBy(*UNIT, *WINDOW).agg(
        F.map_from_entries(F.collect_list(F.struct("dclass", "pkg_floor"))).alias("by_class"),
        F.min("pkg_floor").alias("any_floor"),
    )


def catalog_rows(catalog: DataFrame) -> DataFrame:
    """The catalog as one row per window and day class."""
    return catalog.select(
        *UNIT, *WINDOW, F.explode("by_class").alias("dclass", "pkg_floor"), "any_floor"
    )


def sold_unit_days(priced: DataFrame) -> DataFrame:
    """Units and days with sold hours and the day classes their rate types claim: two if they
    disagree on the holiday flag."""
    holiday = F.coalesce("is_holiday", F.lit(False))
    days = priced.where(F.col("sold_mask") != 0).groupBy(*UNIT, "target_date").agg(
        F.bool_or(holiday).alias("some"), F.bool_and(holiday).alias("all")
    )
    classes = F.array_compact(
        F.array(
            F.when(F.col("some"), F.lit(HOLIDAY_CLASS)),
            F.when(~F.col("all"), F.dayofweek("target_date") - 1),
        )
    )
    return days.select(*UNIT, "target_date", classes.alias("classes"))


def day_windows(sold_days: DataFrame, seen: DataFrame, catalog: DataFrame) -> DataFrame:
    """Package windows of each sold unit-day as one array.

    Windows seen for the day itself; without any, every window of the unit at the price of the
    day's class, else at its cheapest. A unit has at most 24 x 24 different windows, which bounds
    the arrays. Equal fillings of a day with two classes count as `copies` of one window.
    """
    entry = F.struct(*WINDOW, "pkg_floor", F.lit(1).alias("copies"))
    by_day = seen.groupBy(*UNIT, "target_date").agg(F.collect_list(entry).alias("listed"))
    by_unit = catalog.groupBy(*UNIT).agg(
        F.collect_list(F.struct(*WINDOW, "by_class", "any_floor")).alias("known")
    )

    def priced_for(w, dclass):
        return F.coalesce(F.try_element_at(w["by_class"], dclass), w["any_floor"])

    def filled(w):
        first = priced_for(w, F.get("classes", F.lit(0)))
        second = priced_for(w, F.coalesce(F.get("classes", F.lit(1)), F.get("classes", F.lit(0))))
        two = F.size("classes") == 2
        make = lambda amount, n: F.struct(
            w["shour"].alias("shour"), w["ehour"].alias("ehour"), amount.alias("pkg_floor"),
            F.lit(n).alias("copies"),
        )
        return (
            F.when(~two, F.array(make(first, 1)))
            .when(first == second, F.array(make(first, 2)))
            .otherwise(F.array(make(first, 1), make(second, 1)))
        )

    substitute = F.flatten(F.transform("known", filled))
    return (
        sold_days.join(by_day, [*UNIT, "target_date"], "left")
        .join(by_unit, UNIT, "left")
        .select(*UNIT, "target_date", F.coalesce("listed", substitute).alias("windows"))
        .where(F.col("windows").isNotNull())
    )


def window_rows(windows: DataFrame) -> DataFrame:
    return windows.select(*UNIT, "target_date", F.inline("windows"))


def offered_days(priced: DataFrame, windows: DataFrame) -> DataFrame:
    """Days with sold hours together with their windows."""
    cols = ["lead_days", "sold_mask", "prices", "unit_floor"]
    sold = priced.where(F.col("sold_mask") != 0).select(*OBSERVATION, *cols)
    return sold.join(windows, [*UNIT, "target_date"])


def _runs(days: DataFrame) -> DataFrame:
    """One row per block of sold hours of a day."""
    runs = days.withColumn("h0", F.explode(H.mask_hours(H.run_starts("sold_mask"))))
    return runs.withColumns(
        {
            "h1": F.col("h0") + H.run_length("sold_mask", "h0") - 1,
            "blk": H.run_label("sold_mask", "h0"),
        }
    )


def package_hits(offered: DataFrame) -> DataFrame:
    """Windows of one day that lie inside a block of the day, with their hourly sum. Days carry
    their prices and windows, so nothing is joined."""
    inside = F.filter(
        "windows",
        lambda w: (w["shour"] < w["ehour"]) & (w["shour"] >= F.col("h0"))
        & (w["ehour"] - 1 <= F.col("h1")),
    )
    hits = _runs(offered).select(
        *BLOCK, "lead_days", "prices", "unit_floor", F.inline(inside)
    )
    total = H.span_sum("prices", "shour", "ehour") * F.col("unit_floor") * F.col("copies")
    return hits.select(*BLOCK, "lead_days", *WINDOW, "pkg_floor", total.alias("win_floor"))


def overnight_hits(
    offered: DataFrame, priced: DataFrame, same_observation: bool = True
) -> DataFrame:
    """Windows over midnight whose evening lies in the last block of a day and whose morning lies
    in the first block of the next day, both from the same observation unless told otherwise.

    A window that ends at hour 0 is neither kind. One equi join of days that are sold at 23 h and
    have such a window with days that are sold at 0 h.
    """
    last_start = F.array_max(H.mask_hours(H.run_starts("sold_mask")))
    over = F.filter(
        "windows",
        lambda w: (w["shour"] >= w["ehour"]) & (w["ehour"] > 0) & (w["shour"] >= F.col("h0")),
    )
    tail = (
        offered.where(H.has_hour("sold_mask", 23))
        .withColumn("h0", last_start)
        .select(
            *OBSERVATION, "lead_days", "prices", "unit_floor",
            H.run_label("sold_mask", "h0").alias("blk"),
            F.date_add("target_date", 1).alias("next_date"), F.inline(over),
        )
    )
    evening = H.span_sum("prices", "shour", F.lit(H.HOURS)) * F.col("unit_floor")
    tail = tail.withColumn("evening", evening).drop("prices")
    head = priced.where(H.has_hour("sold_mask", 0)).select(
        *[F.col(c).alias(f"head_{c}") for c in [*RATE, "observed_date", "target_date"]],
        H.run_length("sold_mask", F.lit(0)).alias("head_hours"),
        F.col("prices").alias("head_prices"), F.col("unit_floor").alias("head_floor"),
    )
    on = [F.col(c) == F.col(f"head_{c}") for c in RATE]
    on.append(F.col("next_date") == F.col("head_target_date"))
    if same_observation:
        on.append(F.col("observed_date") == F.col("head_observed_date"))
    both = tail.join(head, on).where(F.col("head_hours") >= F.col("ehour"))
    morning = H.span_sum("head_prices", F.lit(0), "ehour") * F.col("head_floor")
    return both.select(
        *BLOCK, "lead_days", "head_observed_date", H.run_label(F.lit(1), F.lit(0)).alias("blk_next"), *WINDOW,
        "pkg_floor", ((F.col("evening") + morning) * F.col("copies")).alias("win_floor"),
    )


def _with_cut(hits: DataFrame) -> DataFrame:
    cut = F.col("win_floor") - F.col("pkg_floor")
    return hits.withColumn("cut", cut).where(F.col("cut") > 0)


def _best(hits: DataFrame) -> DataFrame:
    """Largest cut per block; ties go to the earlier and then the shorter window."""
    return best_per(hits, BLOCK, "cut", -F.col("shour"), -F.col("ehour"))


def choose_packages(day_hits: DataFrame, over_hits: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(chosen same-day windows, chosen overnight windows): at most one overnight window per last
    block, then at most one same-day window per block that does not touch the hours an overnight
    window took at either end of the day.

    The claims of overnight windows are one row per day: from which hour its last block and up to
    which hour its first block is taken. A morning is claimed in the observation it was read from,
    which may differ from the evening's. Both claims and the result read the chosen windows, so they are
    written once: the days are joined with the next ones once.
    """
    over = stage(_best(_with_cut(over_hits)), "overnight")
    day = [*RATE, "observed_date", "target_date"]
    evening = over.select(
        *day, F.col("blk").alias("late_blk"), F.col("shour").alias("late_from"),
        F.lit(None).cast("int").alias("early_blk"), F.lit(None).cast("int").alias("early_to"),
    )
    morning = over.select(
        *RATE, F.col("head_observed_date").alias("observed_date"),
        F.date_add("target_date", 1).alias("target_date"), F.lit(None).cast("int").alias("late_blk"), F.lit(None).cast("int").alias("late_from"),
        F.col("blk_next").alias("early_blk"), F.col("ehour").alias("early_to"),
    )
    claims = evening.unionByName(morning).groupBy(*day).agg(
        *[F.max(c).alias(c) for c in ("late_blk", "late_from", "early_blk", "early_to")]
    )
    late = (F.col("blk") == F.col("late_blk")) & (F.col("ehour") - 1 >= F.col("late_from"))
    early = (F.col("blk") == F.col("early_blk")) & (F.col("shour") < F.col("early_to"))
    taken = F.coalesce(late, F.lit(False)) | F.coalesce(early, F.lit(False))
    free = _with_cut(day_hits).join(claims, day, "left").where(~taken)
    return _best(free.drop("late_blk", "late_from", "early_blk", "early_to")), over


def package_cuts(chosen_day: DataFrame, chosen_over: DataFrame) -> DataFrame:
    """Amounts by which the lower bound falls; an overnight cut is booked on its first day."""
    cols = ["space_id", "observed_date", "target_date", "lead_days", "cut"]
    return chosen_over.select(*cols).unionByName(chosen_day.select(*cols))


def package_windows(
    priced: DataFrame, packages: DataFrame, obs: DataFrame, guest: DataFrame, snap
) -> DataFrame:
    """Windows of every sold unit-day, from the price list."""
    seen = seen_windows(package_floors(packages, guest, snap))
    catalog = package_catalog(seen, holiday_calendar(obs, snap))
    return day_windows(sold_unit_days(priced), seen, catalog)


def package_adjustment(
    priced: DataFrame, packages: DataFrame, obs: DataFrame, guest: DataFrame, snap,
    same_observation: bool = True,
) -> DataFrame:
    """All cuts of the priced days, from price list to chosen windows. The days with windows feed
    the same-day and the overnight branch, so they are written once."""
    windows = package_windows(priced, packages, obs, guest, snap)
    offered = stage(offered_days(priced, windows), "offered-days")
    over = overnight_hits(offered, priced, same_observation)
    return package_cuts(*choose_packages(package_hits(offered), over))
