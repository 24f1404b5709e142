"""A booking panel derived from the driver's star-schema tables.

Suppliers act as venues and line items as bookings; every formula is integer or date arithmetic,
so that SQL can derive the same panel. What the observations are made of is written once per session
and scale factor, a row per rate type; rows per day unfold from it when they are read, in tasks that hold a bounded
number of venues, so that an operator pays for the days and columns it asks for.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions import hours as H
from .operators import blocking, market, occupancy, revenue, settled
from .session import stage

OBSERVED = ["2026-01-02", "2026-01-09", "2026-01-16", "2026-01-17"]
FIRST_DAY, LAST_DAY = "2026-01-01", "2026-02-14"
DAY, AS_OF = "2026-01-16", "2026-01-17"
HOLIDAY = "2026-01-20"
OTHER = "other"
UNITS = 6
#: Venues whose rows one task derives: more venues make more tasks, not larger ones.
VENUES_EACH = 500


def _d(text: str) -> Column:
    return F.lit(text).cast("date")


def _div(a, b) -> Column:
    return F.call_function("div", a, F.lit(b))


def _listed_hours(mask: str) -> Column:
    """Ascending array of the hours of a mask, NULL having none: looked up six hours at a time, in generated code, so that
    a mask that is computed on the way is computed once a row."""
    parts = []
    for low in range(0, H.HOURS, 6):
        sets = [", ".join(f"{low + h}S" for h in range(6) if bits >> h & 1) for bits in range(64)]
        parts.append(f"get(array({', '.join(f'array({hours})' for hours in sets)}), shiftright({mask}, {low}) & 63)")
    return F.expr(f"coalesce(concat({', '.join(parts)}), cast(array() AS array<smallint>))")


class Panel:
    """Lazily derived tables; what several operators read is written once."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.dir = spark, sf_dir
        self._raw: dict[str, DataFrame] = {}

    def raw(self, name: str) -> DataFrame:
        if name not in self._raw:
            self._raw[name] = self.spark.read.parquet(f"{self.dir}/{name}.parquet")
        return self._raw[name]

    # --- base tables ----------------------------------------------------------------------

    @cached_property
    def _spread(self) -> int:
        """Partitions of ids, each of which expands to hundreds or thousands of rows."""
        return max(self.spark.sparkContext.defaultParallelism, -(-self.raw("supplier").count() // VENUES_EACH))

    @property
    def _ids(self) -> DataFrame:
        # A small file of few ids that each expand to hundreds of rows: spread the ids first. In their order,
        # rows unfold in the order of their keys.
        ids = self.raw("supplier").select(F.col("s_suppkey").alias("space_id"))
        return ids.repartition(self._spread, "space_id").sortWithinPartitions("space_id")

    @cached_property
    def venues(self) -> DataFrame:
        return stage(self._venues_rows(), "venues")

    def _venues_rows(self) -> DataFrame:
        s = F.col("space_id")
        kind = F.element_at(
            F.array(F.lit("studio"), F.lit("practice"), F.lit("party")),
            (_div(s, 2) % 3 + 1).cast("int"),
        )
        half = (s % 2).cast("string")
        gone = s % 50 == 49
        return self._ids.select(
            "space_id",
            _d(OBSERVED[0]).alias("first_seen"), _d(AS_OF).alias("last_seen"),
            F.add_months(_d(FIRST_DAY), (-(s * 7 % 36) - 1).cast("int")).alias("vintage_month"),
            F.concat(F.lit("venue "), s.cast("string")).alias("name"),
            _div(s, 2).cast("string").alias("host_id"),
            F.lit("11").alias("sido"), half.alias("sigungu"), half.alias("eupmyeondong"),
            F.lit("11").alias("sido_code"), half.alias("sigungu_code"), half.alias("dong_code"),
            (F.lit(37.5) + (s % 100) * F.lit(0.001)).alias("lat"),
            (F.lit(127.0) + _div(s, 100) * F.lit(0.001)).alias("lng"),
            F.when(s % 20 == 19, F.lit(OTHER)).otherwise(kind).alias("category"),
            gone.alias("is_gone"), F.when(gone, _d(AS_OF)).alias("gone_at"),
        )

    @cached_property
    def places(self) -> DataFrame:
        """Customers as points on the map; a third of them stands at one place."""
        k = F.col("c_custkey")
        crowd = k % 3 == 0
        lat = F.when(crowd, 37.5412).otherwise(F.lit(37.5) + (k % 97) * F.lit(0.00103))
        lng = F.when(crowd, 127.0007).otherwise(F.lit(127.0) + _div(k, 97) % 11 * F.lit(0.00091))
        return self.raw("customer").select(k.alias("point_id"), lat.alias("lat"), lng.alias("lng"))

    def _per_day(self, df: DataFrame, days: list[str], name: str) -> DataFrame:
        return df.withColumn(name, F.explode(F.array(*[_d(d) for d in days])))

    @cached_property
    def snapshots(self) -> DataFrame:
        return stage(self._snapshots_rows(), "snapshots")

    def _snapshots_rows(self) -> DataFrame:
        s = F.col("space_id")
        rows = self._per_day(self._ids, OBSERVED, "snapshot_date")
        ago = (s * 11 % 120).cast("int")
        return rows.select(
            "space_id", "snapshot_date", F.lit(200).alias("http_status"),
            (s * 13 % 50).cast("int").alias("review_total"),
            (F.lit(10000) + s % 20 * 1000).cast("int").alias("median_price"),
            (F.lit(5) + s % 40).cast("decimal(10,2)").alias("total_pyeong"),
            F.date_sub(_d(AS_OF), ago).cast("timestamp").alias("latest_review_at"),
        )

    def _units_of(self, venues: DataFrame) -> DataFrame:
        return venues.withColumn("product_id", F.explode(F.sequence(F.lit(0), F.lit(UNITS - 1))))

    @property
    def _units(self) -> DataFrame:
        return self._units_of(self._ids)

    @property
    def _rate_types(self) -> DataFrame:
        return self._types_of(self._ids)

    def _types_of(self, venues: DataFrame) -> DataFrame:
        """Units of the venues with their rate types. Unit 1 has a second one: charged per person, dearer, without the
        holiday flag, with an hour of its own that is always taken."""
        types = F.when(F.col("product_id") == 1, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1))).cast("array<bigint>")
        return self._units_of(venues).withColumn("rsv_type_id", F.explode(types))

    @cached_property
    def units(self) -> DataFrame:
        return stage(self._units_rows(), "units")

    def _units_rows(self) -> DataFrame:
        rows = self._per_day(self._units, OBSERVED, "snapshot_date")
        return rows.select(
            "space_id", F.col("product_id").cast("long"), "snapshot_date",
            (F.col("space_id") % 2 + 1).cast("int").alias("min_guest_policy"),
            F.lit(8).alias("max_guest_capacity"),
        )

    @cached_property
    def rates(self) -> DataFrame:
        return stage(self._rates_rows(), "rates")

    def _rates_rows(self) -> DataFrame:
        p = F.col("product_id")
        yes = lambda c: F.when(c, F.lit("Y")).otherwise(F.lit("N"))
        return self._per_day(self._rate_types, OBSERVED, "snapshot_date").select(
            "space_id", p.cast("long").alias("product_id"), "rsv_type_id",
            "snapshot_date", yes((p == 2) | (F.col("rsv_type_id") == 2)).alias("charging_per_person"),
            F.lit(4).alias("person_ceiling"), F.lit(5000).alias("extra_person_price"),
            yes(p % 2 == 0).alias("extra_per_hour"),
        )

    @property
    def _runs(self) -> DataFrame:
        """Bookings visible at each observation: per venue a map from unit to a map from target date to one hour mask
        per observation. Bookings are dealt by venue once; what no observation sees is not."""
        day = F.unix_date(F.to_date("l_shipdate"))
        first = (F.col("l_orderkey") % 24).cast("int")
        ones = F.call_function("shiftleft", F.lit(1), (F.col("l_linenumber") % 4 + 1).cast("int")) - 1
        run = F.call_function("shiftleft", ones, first).bitwiseAND(F.lit(H.FULL_DAY))
        booked = self.raw("lineitem").select(
            F.col("l_suppkey").alias("space_id"), (F.col("l_partkey") % UNITS).cast("int").alias("product_id"),
            F.date_add(_d(FIRST_DAY), (day % 45).cast("int")).alias("target_date"),
            F.col("l_quantity").cast("int").alias("ahead"), run.alias("run"),
        )
        since = F.date_sub("target_date", F.col("ahead"))
        seen = lambda d: (F.col("target_date") >= _d(d)) & (since <= _d(d))
        masks = [f"m{i}" for i in range(len(OBSERVED))]
        known = booked.select("space_id", "product_id", "target_date", *[F.when(seen(d), F.col("run")).alias(m) for m, d in zip(masks, OBSERVED, strict=True)])
        known = known.where(F.coalesce(*masks).isNotNull() & F.col("space_id").isNotNull() & F.col("product_id").isNotNull())
        days = known.repartition(self._spread, "space_id").groupBy("space_id", "product_id", "target_date").agg(
            *[F.bit_or(m).alias(m) for m in masks]
        )
        # a unit has at most one entry per date of the calendar
        entry = F.struct("target_date", F.array(*masks))
        units = days.groupBy("space_id", "product_id").agg(F.map_from_entries(F.collect_list(entry)).alias("runs"))
        return units.groupBy("space_id").agg(F.map_from_entries(F.collect_list(F.struct("product_id", "runs"))).alias("unit_runs"))

    @cached_property
    def _booked_rates(self) -> DataFrame:
        """Rate types with their bookings: a map from target date to one hour mask per observation."""
        types = self._types_of(self._ids.join(self._runs, "space_id", "left"))
        runs = F.try_element_at("unit_runs", F.col("product_id"))
        return stage(types.select("space_id", "product_id", "rsv_type_id", runs.alias("runs")), "booked-rates")

    def _calendar(self, df: DataFrame, days: list[str]) -> DataFrame:
        rows = self._per_day(df, days, "observed_date")
        return rows.withColumn(
            "target_date", F.explode(F.sequence(F.col("observed_date"), _d(LAST_DAY)))
        )

    def _observations(self) -> DataFrame:
        s, p = F.col("space_id"), F.col("product_id")
        closed = F.call_function("shiftleft", F.lit(1), (s % 4 * 3).cast("int")) - 1
        suspect = s % 10 == 9
        nth = F.datediff("target_date", _d(FIRST_DAY))
        block = F.when(nth % 5 != 0, F.lit(0x3FC00)).otherwise(F.lit(0))  # hours 10..17
        second = F.col("rsv_type_id") == 2
        base = (F.lit(10000) + s % 20 * 1000 + F.when(second, 2000).otherwise(0)).cast("int")
        noon = F.when(s % 7 == 3, F.lit(999900)).otherwise(base)
        evening = _div(base * 3, 2).cast("int")
        prices = F.concat(
            F.array_repeat(base, 12), F.array_repeat(noon, 2), F.array_repeat(base, 4),
            F.array_repeat(evening, 5), F.array(F.when(s % 11 != 5, evening)),
        )
        # What is the same on all days of a rate type is computed before the days are unfolded.
        types = self._booked_rates.repartition(self._spread, "space_id")
        rates = types.sortWithinPartitions("space_id", "product_id", "rsv_type_id").select(
            "*", second.alias("second"), closed.bitwiseOR(F.when(second, F.lit(1 << 9)).otherwise(F.lit(0))).alias("always"),
            F.when(s % 22 != 5, base).alias("price"), prices.alias("hour_prices"),
        )
        at = F.array_position(F.array(*[_d(d) for d in OBSERVED]), F.col("observed_date")).cast("int") - 1
        runs = F.get(F.try_element_at("runs", "target_date"), at)
        booked = F.when(suspect, block).otherwise(F.coalesce(runs, F.lit(0)))
        full = self._calendar(rates, OBSERVED).withColumn("mask", F.col("always").bitwiseOR(booked))
        hours = _listed_hours("mask")
        return full.select(
            "space_id", p.cast("long").alias("product_id"), "rsv_type_id", "observed_date", "target_date",
            (F.dayofweek("target_date") - 1).cast("string").alias("wday"),
            ((F.col("target_date") == _d(HOLIDAY)) & ~F.col("second")).alias("is_holiday"),
            F.lit(24).alias("n_slots"), hours.alias("booked_hours"),
            F.bit_count("mask").cast("int").alias("n_booked"), "price", "hour_prices",
        )

    def _packages(self) -> DataFrame:
        """Four windows on units 0..3, seen from the second observation on; the last one ends at
        midnight and never matches. Unit 1 sells them under its second rate type."""
        s = F.col("space_id")
        base = F.lit(10000) + s % 20 * 1000
        windows = [(1, 10, 14, 4), (2, 18, 22, 6), (3, 22, 2, 5), (4, 20, 0, 6)]
        each = F.inline(F.array(*[
            F.struct(F.lit(i).cast("long").alias("package_id"), F.lit(a).alias("shour"),
                     F.lit(b).alias("ehour"), F.lit(k).alias("k")) for i, a, b, k in windows
        ]))
        rows = self._calendar(self._units.where(F.col("product_id") < 4), OBSERVED[1:])
        amount = _div(base * F.col("k") * 7, 10)
        weekend = F.dayofweek("target_date").isin(1, 7)
        return rows.select("*", each).select(
            "space_id", F.col("product_id").cast("long"),
            F.when(F.col("product_id") == 1, 2).otherwise(1).cast("long").alias("rsv_type_id"), "package_id", "observed_date", "target_date",
            F.concat(F.lit("package "), F.col("package_id").cast("string")).alias("name"),
            "shour", "ehour",
            F.when(weekend, _div(amount * 6, 5)).otherwise(amount).cast("int").alias("price"),
            F.lit(True).alias("available"),
        )

    @cached_property
    def observations(self) -> DataFrame:
        return self._observations()

    @cached_property
    def packages(self) -> DataFrame:
        return self._packages()

    @property
    def reviews(self) -> DataFrame:
        return self.raw("lineitem").select(
            (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("review_id"),
            F.col("l_suppkey").alias("space_id"), F.to_date("l_shipdate").alias("review_date"),
        )

    @property
    def listing(self) -> DataFrame:
        """Orders act as a listing: id and change date."""
        return self.raw("orders").select(
            F.col("o_orderkey").alias("space_id"),
            F.date_format("o_orderdate", "yyyy-MM-dd").alias("lastmod"),
        )

    @property
    def attempts(self) -> DataFrame:
        return self.raw("events").select(
            F.to_date("ts").alias("run_date"), (F.col("event_type") == "error").alias("failed")
        )

    # --- derived tables -------------------------------------------------------------------

    @cached_property
    def classes(self) -> DataFrame:
        return stage(occupancy.hour_class(self.observations), "hour-class")

    @cached_property
    def closed(self) -> DataFrame:
        return stage(occupancy.masks_of_classes(self.classes), "closed")

    @cached_property
    def fill(self) -> DataFrame:
        plain = occupancy.venue_fill(self.observations)
        flags = blocking.blocking_flags(self.observations, self.closed)
        return stage(blocking.flagged_fill(plain, flags), "fill")

    def venue_revenue(self, date: str) -> DataFrame:
        return revenue.venue_revenue(
            self.observations, self.closed, self.rates, self.units, self.packages, date
        )

    def venue_settled(self, as_of: str = AS_OF, **options) -> DataFrame:
        return settled.venue_settled(
            self.observations, self.closed, self.rates, self.units, self.packages, as_of, **options
        )

    def pricing(self, date: str = DAY) -> revenue.Pricing:
        days = occupancy.open_days(self.observations, self.closed, date)
        return revenue.pricing(
            days, self.observations, self.rates, self.units, self.packages, date
        )

    @cached_property
    def day_pricing(self) -> revenue.Pricing:
        return self.pricing()

    def counted_pricing(self, **options) -> revenue.Pricing:
        days = settled.counted_days(self.observations, self.closed, AS_OF)
        return revenue.pricing(
            days, self.observations, self.rates, self.units, self.packages, AS_OF, **options
        )

    @cached_property
    def past_pricing(self) -> revenue.Pricing:
        return self.counted_pricing()

    @cached_property
    def base(self) -> DataFrame:
        return stage(market.venue_base(self.venues, self.snapshots, AS_OF), "venue-base")

    @cached_property
    def revenue(self) -> DataFrame:
        return stage(
            self.venue_revenue(DAY).unionByName(self.venue_revenue(AS_OF)), "revenue"
        )

    @cached_property
    def settled(self) -> DataFrame:
        return stage(self.venue_settled(), "settled")


_panels: dict[tuple[str, str], Panel] = {}


def panel(spark: SparkSession, sf_dir: str) -> Panel:
    """The panel of a scale factor; one per session, so its tables are written once."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _panels:
        _panels[key] = Panel(spark, sf_dir)
    return _panels[key]
