"""Small hand-written panel frames."""

import datetime as dt

from roomtide import schemas

OBSERVED = dt.date(2026, 1, 1)


def day(n: int) -> dt.date:
    return OBSERVED + dt.timedelta(days=n)


def observation(target, booked, prices=None, price=1000, space=1, unit=1, rate=1, observed=0, holiday=False):
    target, observed = day(target), day(observed)
    return (space, unit, rate, observed, target, str(target.isoweekday() % 7), holiday, 24, list(booked),
            len(booked), price, [price] * 24 if prices is None else prices)


def observations(spark, rows):
    return spark.createDataFrame(rows, schemas.OBSERVATION)


def package(target, shour, ehour, price, package_id=1, space=1, unit=1, rate=1, observed=0):
    return (space, unit, rate, package_id, day(observed), day(target), "p", shour, ehour, price, True)


def packages(spark, rows):
    return spark.createDataFrame(rows, schemas.PACKAGE)


def rates(spark, rows):
    """(space, unit, rate, per_person, ceiling, extra, per_hour) on the first day."""
    full = [(s, u, r, OBSERVED, "TIME", 1000, pp, c, x, ph) for s, u, r, pp, c, x, ph in rows]
    return spark.createDataFrame(full, schemas.RATE_SNAPSHOT)


def units(spark, rows):
    """(space, unit, min_guest, max_guest) on the first day."""
    full = [(s, u, OBSERVED, "u", 1000, "TIME", "N", 1, mx, None, None, mn) for s, u, mn, mx in rows]
    return spark.createDataFrame(full, schemas.UNIT_SNAPSHOT)
