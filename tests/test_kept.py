"""Kept tables against the whole history, in any order of landing."""

import datetime as dt
import itertools
import os
import random

import pytest
from pyspark.sql import functions as F

from roomtide.operators import occupancy, settled, validity
from roomtide.plans import daily, kept
from roomtide.sources.writers import replace_partition

from frames import day, observation, observations, package, packages, rates, units

DAYS = [0, 1, 2, 3]


def land(t, spark, rows, n, name=daily.OBSERVATIONS):
    replace_partition(observations(spark, rows), t.path(name), value=day(n).isoformat())


def seen_rows(df):
    return sorted((r.space_id, r.target_date, r.observed_date, r.booked_mask) for r in df.collect())


def day_rows(n, seed=0):
    r = random.Random(f"{n} {seed}")
    return [observation(t, [r.randrange(24)], observed=n, space=s) for s in range(1, 6) for t in range(n + 1, 9) if r.random() < 0.6]


@pytest.mark.parametrize("order", list(itertools.permutations(DAYS))[3::9])
def test_last_seen_in_any_order(spark, tmp_path, order):
    t, newest = daily.Tables(spark, str(tmp_path)), 0
    for n in order:
        land(t, spark, day_rows(n), n)
        newest = max(newest, n)
        state = daily.kept_seen(t).as_of(day(newest).isoformat())
        assert seen_rows(state) == seen_rows(settled.last_seen(t.read(daily.OBSERVATIONS)))


def test_late_day_counts_after_later_ones(spark, tmp_path):
    """Days 0 and 2 are kept, day 1 lands, day 3 follows: the target keeps what day 1 saw of it."""
    t = daily.Tables(spark, str(tmp_path))
    land(t, spark, [observation(5, [1], observed=0)], 0)
    land(t, spark, [observation(6, [2], observed=2)], 2)
    daily.kept_seen(t).as_of(day(2).isoformat())
    land(t, spark, [observation(5, [9], observed=1)], 1)
    land(t, spark, [observation(7, [3], observed=3)], 3)
    state = daily.kept_seen(t).as_of(day(3).isoformat())
    assert [(r.target_date, r.booked_mask) for r in state.orderBy("target_date").collect()] == [(day(5), 1 << 9), (day(6), 4), (day(7), 8)]


def test_only_lacking_days_are_read(spark, tmp_path, monkeypatch):
    t = daily.Tables(spark, str(tmp_path))
    for n in (0, 1, 2):
        land(t, spark, day_rows(n), n)
    read = []
    spy = kept.Kept(t, daily.SEEN, daily.OBSERVATIONS, lambda rows: (read.append(rows), settled.last_seen(rows))[1],
                    lambda s, rows: (read.append(rows), settled.roll_last_seen(s, rows))[1], ["target_date"])
    spy.as_of(day(1).isoformat())
    spy.as_of(day(2).isoformat())
    assert [sorted(r[0] for r in x.select("observed_date").distinct().collect()) for x in read] == [[day(0), day(1)], [day(2)]]
    spy.as_of(day(2).isoformat())
    assert len(read) == 2


def test_a_day_in_another_form(spark, tmp_path):
    """A day that lands again loses what its old form held, also in states kept before."""
    t = daily.Tables(spark, str(tmp_path))
    for n in DAYS:
        land(t, spark, day_rows(n), n)
        daily.kept_seen(t).as_of(day(n).isoformat())
    land(t, spark, day_rows(2, seed=7), 2)
    state = daily.kept_seen(t).as_of(day(3).isoformat())
    assert seen_rows(state) == seen_rows(settled.last_seen(t.read(daily.OBSERVATIONS)))


def test_old_states_are_removed(spark, tmp_path):
    t = daily.Tables(spark, str(tmp_path))
    for n in range(6):
        land(t, spark, day_rows(n), n)
        daily.kept_seen(t).as_of(day(n).isoformat())
    left = [x for x in os.listdir(tmp_path / daily.SEEN) if x.startswith("kept_on=")]
    assert len(left) == kept.KEEP == len([x for x in os.listdir(tmp_path / f"{daily.SEEN}_ledger") if x.startswith("kept_on=")])


def test_broken_ledger_is_not_believed(spark, tmp_path):
    """A run that ended between state and ledger: the state is made again."""
    t = daily.Tables(spark, str(tmp_path))
    land(t, spark, day_rows(0), 0)
    daily.kept_seen(t).as_of(day(0).isoformat())
    replace_partition(settled.last_seen(observations(spark, day_rows(5))), t.path(daily.SEEN), "kept_on", value=day(0).isoformat())
    state = daily.kept_seen(t).as_of(day(0).isoformat())
    assert seen_rows(state) == seen_rows(settled.last_seen(t.read(daily.OBSERVATIONS)))


# --- log of closed hours ------------------------------------------------------------------------

def classes(spark, n, masks):
    rows = [(s, 1, 1, day(n), h, 20, 20, bool(m >> h & 1)) for s, m in masks.items() for h in range(24)]
    schema = "space_id long, product_id long, rsv_type_id long, observed_date date, hour int, n_days int, n_blocked int, is_closed boolean"
    return spark.createDataFrame(rows, schema)


def log_rows(df):
    return sorted((r.space_id, r.valid_from, r.closed_mask) for r in df.collect())


HISTORY = {0: {1: 3, 2: 5, 3: 0}, 1: {1: 3, 2: 6}, 2: {1: 7, 2: 6, 4: 1}, 3: {1: 3, 2: 5, 3: 0, 4: 1}}


@pytest.mark.parametrize("order", list(itertools.permutations(DAYS))[2::8])
def test_log_in_any_order(spark, tmp_path, order):
    t = daily.Tables(spark, str(tmp_path))
    for i, n in enumerate(order):
        replace_partition(classes(spark, n, HISTORY[n]), t.path(daily.CLASSES), value=day(n).isoformat())
        got = daily.closed_log(t).as_of(day(3).isoformat())
        assert log_rows(got) == log_rows(validity.change_log(t.read(daily.CLASSES)))
    # the day in the middle lands again
    replace_partition(classes(spark, 1, {2: 5, 3: 8}), t.path(daily.CLASSES), value=day(1).isoformat())
    got = daily.closed_log(t).as_of(day(3).isoformat())
    assert log_rows(got) == log_rows(validity.change_log(t.read(daily.CLASSES)))
    for n in DAYS:
        as_of = F.lit(day(n))
        want = occupancy.latest_closed_masks(occupancy.masks_of_classes(t.read(daily.CLASSES)), as_of)
        assert sorted(map(tuple, validity.latest_masks(got, as_of).collect())) == sorted(map(tuple, want.collect()))


def test_interval_join(spark):
    log = validity.change_log(classes(spark, 0, {1: 3, 2: 5}).union(classes(spark, 2, {1: 4})).union(classes(spark, 3, {1: 4})))
    rows = spark.createDataFrame([(s, 1, 1, day(n)) for s in (1, 2, 9) for n in (-1, 0, 1, 2, 5)], "space_id long, product_id long, rsv_type_id long, seen date")
    got = sorted((r.space_id, r.seen, r.closed_mask) for r in validity.closed_as_of(rows, log, "seen").collect())
    assert got == [(1, day(0), 3), (1, day(1), 3), (1, day(2), 4), (1, day(5), 4), (2, day(0), 5), (2, day(1), 5), (2, day(2), 5), (2, day(5), 5)]


def test_counted_revenue_reads_no_old_class(spark, tmp_path):
    """The chain's counted revenue reads the log alone once days are folded, and late days count in it."""
    t = daily.Tables(spark, str(tmp_path))
    base = lambda n: [observation(x, [x % 24], observed=n) for x in range(n + 1, 20)]
    packages(spark, [package(3, 3, 4, 1)]).write.parquet(t.path(daily.PACKAGES))
    rates(spark, [(1, 1, 1, "N", 4, 5, "N")]).write.parquet(t.path(daily.RATES))
    units(spark, [(1, 1, 1, 8)]).write.parquet(t.path(daily.UNITS))
    spark.createDataFrame([(1, "studio", "x")], "space_id long, category string, sigungu string").write.parquet(t.path(daily.VENUES))
    for n in (0, 5, 3):
        land(t, spark, base(n), n)
        daily.backfill(t)
    closed = daily.closed_as_of(t, day(5).isoformat())
    assert daily.CLASSES not in closed._jdf.queryExecution().executedPlan().toString()
    got = t.read(daily.SETTLED).where(F.col("as_of") == F.lit(day(5))).drop("as_of").collect()
    obs, classes_ = t.read(daily.OBSERVATIONS), t.read(daily.CLASSES)
    want = settled.venue_settled(obs, occupancy.masks_of_classes(classes_), t.read(daily.RATES), t.read(daily.UNITS), t.read(daily.PACKAGES), day(5).isoformat()).drop("as_of")
    assert got == want.collect() and len(got) == 1
    assert isinstance(got[0].to_date, dt.date) and got[0].to_date == day(4)
