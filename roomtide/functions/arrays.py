"""In-record aggregates over nested arrays."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .scalars import col, num_or_null


def array_median(values) -> Column:
    """Middle value; for an even count the mean of the two middle ones, rounded half up."""
    ordered = F.sort_array(F.filter(col(values), lambda v: v.isNotNull()))
    n = F.size(ordered)
    half = F.call_function("div", n, F.lit(2)).cast("int")
    low, high = F.get(ordered, half - 1), F.get(ordered, half)
    even = F.floor((low + high) / 2 + F.lit(0.5)).cast("long")
    return F.when(n == 0, None).when(n % 2 == 1, high.cast("long")).otherwise(even)


def upper_median(values) -> Column:
    """Element n div 2 of the ascending non-NULL values."""
    ordered = F.sort_array(F.filter(col(values), lambda v: v.isNotNull()))
    return F.get(ordered, F.call_function("div", F.size(ordered), F.lit(2)).cast("int"))


def hourly_prices(products) -> Column:
    """Positive prices of the units sold by the hour."""
    by_hour = F.filter(
        col(products),
        lambda p: (p["info"]["RSV_TP_CD"] == "TIME") & (p["info"]["price"] > 0),
    )
    return F.transform(by_hour, lambda p: p["info"]["price"])


def price_stats(products) -> Column:
    """Lowest, median and highest hourly price of a venue."""
    prices = hourly_prices(products)
    return F.struct(
        F.array_min(prices).alias("min_price"),
        array_median(prices).cast("int").alias("median_price"),
        F.array_max(prices).alias("max_price"),
    )


def venue_totals(products) -> Column:
    """Summed floor area and largest capacity over all units; nothing known is NULL."""
    zero = F.lit(0.0)
    area = F.aggregate(
        F.transform(
            col(products), lambda p: F.coalesce(num_or_null(p["info"]["area_size_pyeong"]), zero)
        ),
        zero,
        lambda acc, v: acc + v,
    )
    seats = F.array_max(
        F.transform(col(products), lambda p: num_or_null(p["info"]["max_guest_capacity"], "int"))
    )
    return F.struct(
        F.nullif(area, zero).cast("decimal(10,2)").alias("total_pyeong"),
        F.when(seats > 0, seats).alias("max_capacity"),
    )
