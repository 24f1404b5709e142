"""Scalar column expressions. All dates are arguments; nothing reads the clock."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

DAYS_PER_MONTH = Decimal("30.4")
NEWCOMER_MONTHS = 18
ACTIVE_DAYS = 90
DUMMY_MULTIPLE = 10
DUMMY_CAP = 500_000
HOLIDAY_CLASS = 7


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _unscale(units: Column, scale: int, precision: int) -> Column:
    """Whole number of 10^-scale units -> decimal."""
    exact = units.cast("decimal(20,0)") * F.lit(Decimal(1).scaleb(-scale))
    return exact.cast(f"decimal({precision},{scale})")


def _div(a: Column, b: Column) -> Column:
    return F.call_function("div", a, b)


def ratio(num, den, scale: int, precision: int = 18, times: Decimal = Decimal(1)) -> Column:
    """`num / den * times` of whole numbers, rounded half away from zero; NULL for den = 0.

    Worked out in integers, so that the rounding does not depend on a floating-point quotient; with
    many digits in decimals, where twice the scaled numerator could pass a long.
    """
    up, down = times.as_integer_ratio()
    n = col(num).cast("long") * F.lit(up)
    d = F.nullif(col(den).cast("long"), F.lit(0).cast("long")) * F.lit(down)
    twice = F.abs(n) * F.lit(2 * 10**scale)
    if scale > 6:
        twice, d = F.abs(n).cast("decimal(20,0)") * F.lit(Decimal(2 * 10**scale)), d.cast("decimal(20,0)")
    units = _div(twice + d, d * 2)
    return _unscale(F.signum(n).cast("long") * units, scale, precision)


def monthly(amount, days, scale: int = 0, precision: int = 14) -> Column:
    """Amount over `days` counted days, projected to a month of 30.4 days."""
    return ratio(amount, days, scale, precision, times=DAYS_PER_MONTH)


def rounded(value, scale: int, precision: int = 18) -> Column:
    return F.round(col(value), scale).cast(f"decimal({precision},{scale})")


def capped_ratio(num, den, cap: Decimal, scale: int = 3) -> Column:
    """least(cap, num / den) of decimals. An undefined ratio yields the cap: `least` skips NULL."""
    d = F.nullif(col(den), F.lit(0).cast("decimal(18,6)"))
    quotient = col(num).cast("decimal(18,6)") / d.cast("decimal(18,6)")
    return rounded(F.least(F.lit(cap), quotient), scale, 10)


def decimal_ratio(num, den, scale: int = 3, precision: int = 12) -> Column:
    d = F.nullif(col(den).cast("decimal(18,6)"), F.lit(0).cast("decimal(18,6)"))
    return rounded(col(num).cast("decimal(18,6)") / d, scale, precision)


def num_or_null(c, to: str = "double") -> Column:
    """Number, or NULL where the field is missing, not numeric or zero."""
    return F.nullif(col(c).try_cast(to), F.lit(0).cast(to))


def month_floor(c) -> Column:
    return F.trunc(col(c).cast("date"), "MM")


def review_ts(c) -> Column:
    """Local wall-clock text of a review (UTC+9) -> timestamp."""
    return F.to_timestamp(F.concat(F.replace(col(c), F.lit(" "), F.lit("T")), F.lit("+09:00")))


def months_open(as_of, vintage) -> Column:
    """Whole months since the opening month, at least 1."""
    whole = F.floor(F.months_between(col(as_of), col(vintage))).cast("int")
    return F.when(col(vintage).isNotNull(), F.greatest(F.lit(1), whole))


def reviews_per_month(total, months) -> Column:
    return ratio(total, months, 3, 12)


def active_within(ts, as_of, days: int = ACTIVE_DAYS) -> Column:
    since = col(as_of).cast("timestamp") - F.make_dt_interval(F.lit(days))
    return F.coalesce(col(ts) > since, F.lit(False))


def is_newcomer(months, limit: int = NEWCOMER_MONTHS) -> Column:
    return col(months) <= F.lit(limit)


def lead_days(target="target_date", observed="observed_date") -> Column:
    return F.datediff(col(target), col(observed))


def day_class(date, is_holiday) -> Column:
    """0 = Sunday .. 6 = Saturday, 7 = public holiday."""
    return F.when(F.coalesce(col(is_holiday), F.lit(False)), F.lit(HOLIDAY_CLASS)).otherwise(
        F.dayofweek(col(date)) - 1
    )


def is_dummy(price, base, mult: int = DUMMY_MULTIPLE, cap: int | None = DUMMY_CAP) -> Column:
    """A price nobody is meant to pay. Three-valued, as either bound may be unknown."""
    far = (col(base) > 0) & (col(price) >= col(base) * mult)
    return far if cap is None else far | (col(price) >= F.lit(cap))


def _surcharge(guest) -> Column:
    over = F.greatest(guest("max_guest") - guest("ceil_n"), F.lit(0))
    return over * guest("extra")


def floor_amt(price, guest=F.col) -> Column:
    """Lower bound of one hour: the smallest admitted party."""
    return F.when(guest("per_person"), col(price) * guest("min_guest")).otherwise(col(price))


def ceil_amt(price, guest=F.col) -> Column:
    """Upper bound of one hour: a full house, with hourly surcharges."""
    return (
        F.when(guest("per_person"), col(price) * guest("max_guest"))
        .when(guest("extra_per_hour") == "Y", col(price) + _surcharge(guest))
        .otherwise(col(price))
    )


def block_add(guest=F.col) -> Column:
    """Upper-bound surcharge charged once per booking."""
    once = ~F.coalesce(guest("per_person"), F.lit(False)) & (guest("extra_per_hour") == "N")
    return F.when(once, _surcharge(guest)).otherwise(F.lit(0))


def yes_no(c) -> Column:
    """true/false in text or boolean form -> 'Y'/'N'; other texts and NULL stay as they are."""
    text = col(c).cast("string")
    return F.when(text == "true", F.lit("Y")).when(text == "false", F.lit("N")).otherwise(text)
