"""Hour sets as 24-bit masks.

A set of hours of one day is an integer whose bit h stands for hour h. Set algebra on closed,
booked and priced hours is then bit arithmetic inside generated code, and a day never has to be
expanded into 24 rows to be counted.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .scalars import col

HOURS = 24
FULL_DAY = (1 << HOURS) - 1


def _shl(one, n) -> Column:
    return F.call_function("shiftleft", one, n)


def bit(hour) -> Column:
    return _shl(F.lit(1), col(hour).cast("int"))


def has_hour(mask, hour) -> Column:
    return F.getbit(col(mask), hour if isinstance(hour, Column) else F.lit(hour)) == 1


def hour_mask(hours) -> Column:
    """Array of hours -> mask. Hours outside 0..23 and repeats do not count; NULL is empty."""
    inside = lambda h: F.when(h.between(0, HOURS - 1), bit(h)).otherwise(F.lit(0))
    mask = F.aggregate(col(hours), F.lit(0), lambda acc, h: acc.bitwiseOR(inside(h)))
    return F.when(F.size(col(hours)) > 0, mask).otherwise(F.lit(0))


def mask_hours(mask) -> Column:
    """Mask -> ascending array of hours."""
    return F.filter(F.sequence(F.lit(0), F.lit(HOURS - 1)), lambda h: has_hour(mask, h))


def without(mask, other) -> Column:
    return col(mask).bitwiseAND(F.bitwise_not(col(other)))


def both(mask, other) -> Column:
    return col(mask).bitwiseAND(col(other))


def n_hours(mask) -> Column:
    return F.bit_count(col(mask))


def run_starts(mask) -> Column:
    """Hours that open a run of consecutive hours."""
    m = col(mask)
    return m.bitwiseAND(F.bitwise_not(_shl(m, F.lit(1))))


def run_length(mask, start) -> Column:
    """Length of the run that begins at hour `start`: the trailing ones above that bit."""
    rest = F.call_function("shiftrightunsigned", col(mask), col(start))
    first_gap = F.bitwise_not(rest).bitwiseAND(rest + 1)
    return F.bit_count(first_gap - 1)


def run_label(mask, start) -> Column:
    """hour - row_number() of the run's hours among all set hours of the day."""
    before = col(mask).bitwiseAND(bit(start) - 1)
    return col(start) - 1 - F.bit_count(before)


def is_booked(hours, hour) -> Column:
    return F.array_contains(col(hours), col(hour).cast("short"))


def day_prices(hour_prices: str, price: str) -> Column:
    """The 24 prices of a day, each falling back to the day's price. Spelled out, not a lambda,
    so that it stays in generated code."""
    return F.expr(
        "array(" + ", ".join(f"coalesce(get({hour_prices}, {h}), {price})" for h in range(HOURS)) + ")"
    )


def price_sum(prices, mask) -> Column:
    """Sum of the known prices of the hours in `mask`."""
    chosen = F.filter(col(prices), lambda p, h: has_hour(mask, h) & p.isNotNull())
    total = F.aggregate(chosen, F.lit(0).cast("long"), lambda acc, p: acc + p)
    return F.when(col(mask) != 0, total).otherwise(F.lit(0).cast("long"))


def span_sum(prices, first, end) -> Column:
    """Sum of the known prices of hours first <= h < end."""
    part = F.slice(col(prices), col(first) + 1, F.greatest(col(end) - col(first), F.lit(0)))
    return F.aggregate(
        part, F.lit(0).cast("long"), lambda acc, p: acc + F.coalesce(p, F.lit(0))
    )


def known_hours(prices) -> Column:
    """Mask of the hours that have a price."""
    bits = F.transform(col(prices), lambda p, h: F.when(p.isNotNull(), bit(h)).otherwise(F.lit(0)))
    all_known = F.size(F.filter(col(prices), lambda p: p.isNull())) == 0
    return F.when(all_known, F.lit(FULL_DAY)).otherwise(
        F.aggregate(bits, F.lit(0), lambda acc, b: acc.bitwiseOR(b))
    )


def open_booked(hours, closed_mask) -> Column:
    """Booked hours that are not closed, repeats and out-of-range hours kept."""
    closed = lambda h: h.between(0, HOURS - 1) & has_hour(closed_mask, h.cast("int"))
    return F.filter(col(hours), lambda h: ~closed(h))


def explode_hours(df: DataFrame, hours: int = HOURS) -> DataFrame:
    """Rows x hours 0..hours-1, without a shuffle."""
    return df.withColumn("hour", F.explode(F.sequence(F.lit(0), F.lit(hours - 1))))
