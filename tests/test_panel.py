import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from frames import OBSERVED, day, observation, observations, package, packages, rates, units
from roomtide.functions import hours as H
from roomtide.keys import OBSERVED_RATE
from roomtide.operators import blocking, occupancy, pricing, relational, revenue, settled
from roomtide.operators import packages as pk
from roomtide.operators.vintage import venue_vintage
from roomtide.plans import quality

D0 = OBSERVED.isoformat()
GUEST = (1, 1, 1, "N", 4, 5000, "N")


def run_pricing(spark, obs, packs=(), guest=GUEST, seats=(1, 1, 1, 8), min_days=99, **options):
    obs = observations(spark, obs)
    closed = occupancy.closed_masks(obs, D0, min_days)
    return revenue.pricing(
        occupancy.open_days(obs, closed, D0), obs, rates(spark, [guest]), units(spark, [seats]),
        packages(spark, list(packs)), D0, **options
    )


def cuts(spark, *args, **kwargs):
    rows = run_pricing(spark, *args, **kwargs).cuts.collect()
    return sorted((r.target_date, r.cut) for r in rows)


def test_thirteen_blocked_days_are_not_closed_but_fourteen_are(spark):
    for n, closed in ((13, False), (14, True)):
        obs = observations(spark, [observation(i, [3]) for i in range(1, n + 1)])
        rows = occupancy.hour_class(obs, D0).collect()
        assert len(rows) == 24
        assert [r.is_closed for r in rows if r.hour == 3] == [closed]
        assert (occupancy.closed_masks(obs, D0).collect()[0].closed_mask == 8) is closed


def test_observation_day_itself_does_not_count(spark):
    obs = observations(spark, [observation(0, range(24)), observation(1, [])])
    row = occupancy.venue_fill(obs, D0).collect()[0]
    assert (row.n_days, row.open_slot_hours, row.booked_hours) == (1, 24, 0)


def test_mask_fill_equals_expanded_fill(spark):
    rows = [
        observation(t, [h for h in range(24) if h < 3 or (h * 7 + t * 5 + u * 3) % 9 == 0], space=s, unit=u, rate=r)
        for s in (1, 2) for u in (1, 2) for r in (1, 2) for t in range(1, 20)
    ]
    obs = observations(spark, rows)
    classes = occupancy.hour_class(obs)
    hours = occupancy.with_hour_class(H.explode_hours(occupancy.future_only(obs)), classes)
    opened = occupancy.open_only(hours)
    slow = opened.groupBy("space_id").agg(
        F.count(F.lit(1)).alias("o"), F.count_if(H.is_booked("booked_hours", "hour")).alias("b")
    )
    want = {r.space_id: (r.o, r.b) for r in slow.collect()}
    got = {r.space_id: (r.open_slot_hours, r.booked_hours) for r in occupancy.venue_fill(obs).collect()}
    assert got == want
    same = quality.same_rows(
        occupancy.masks_of_classes(classes).select(*OBSERVED_RATE, "closed_mask"),
        occupancy.closed_masks(obs).select(*OBSERVED_RATE, "closed_mask"),
    ).collect()[0]
    assert (same.only_left, same.only_right) == (0, 0)


def test_single_booked_unit_day_is_suspect(spark):
    obs = observations(spark, [observation(1, [10]), observation(2, [])])
    flags = blocking.blocking_flags(obs, occupancy.closed_masks(obs)).collect()[0]
    assert (flags.days_with_booking, flags.mode_share, flags.is_blocked_suspect) == (1, 1, True)


def test_share_just_below_the_limit_prints_as_the_limit(spark):
    shares = spark.createDataFrame([(1, 2500, 1999)], "space_id long, n int, top int")
    rows = shares.select(F.explode(F.expr("transform(sequence(1, n), i -> if(i <= top, 0, i))")).alias("p"), "space_id")
    s = blocking.mode_share(rows, ["space_id"], "p").collect()[0]
    assert (s.days_with_booking, s.top_n) == (2500, 1999) and s.top_n * 10 < s.days_with_booking * 8


def test_pattern_keeps_repeats_and_hours_out_of_range(spark):
    obs = observations(spark, [observation(1, [5, 30, 5], rate=1), observation(1, [5], rate=2)])
    closed = occupancy.closed_masks(obs)
    assert [r.hrs for r in blocking.booked_patterns(obs, closed).collect()] == [[5, 5, 5, 30]]


def test_baseline_with_dummy_majority(spark):
    prices = [29_000] * 198 + [39_000] * 120 + [1_000_000] * 954
    rows = [observation(i, [], prices[i * 24:(i + 1) * 24]) for i in range(53)]
    base = pricing.price_baseline(observations(spark, rows), D0).collect()[0].base_price
    assert base == 759_750.0
    p = run_pricing(spark, rows).priced
    assert p.agg(F.sum(F.bit_count("dummy_mask"))).collect()[0][0] == 954 - 24 * 0 - sum(x == 1_000_000 for x in prices[:24])
    assert run_pricing(spark, rows, cap=10**9).priced.agg(F.sum("dummy_mask")).collect()[0][0] == 0


def test_baseline_with_dummy_minority_uses_the_multiple(spark):
    prices = [20_000] * 14 + [1_000_000] * 10
    p = run_pricing(spark, [observation(0, [], prices), observation(1, [], prices)], cap=10**9).priced.collect()
    assert [bin(r.dummy_mask).count("1") for r in p] == [10]


def test_package_with_an_extra_hour(spark):
    """Hours 11..17 sold, window 11-17: six hours at the package price, the seventh by the hour."""
    assert cuts(spark, [observation(1, range(11, 18))], [package(1, 11, 17, 4000)]) == [(day(1), 2000)]
    assert cuts(spark, [observation(1, range(11, 18))], [package(1, 11, 17, 6000)]) == []
    assert cuts(spark, [observation(1, range(12, 18))], [package(1, 11, 17, 4000)]) == []


def test_best_of_several_windows(spark):
    packs = [package(1, 10, 12, 100, 1), package(1, 10, 14, 1500, 2), package(1, 14, 24, 1, 3)]
    assert cuts(spark, [observation(1, range(10, 14))], packs) == [(day(1), 2500)]


def test_overnight_window_over_two_days(spark):
    obs = [observation(1, range(19, 24)), observation(2, range(0, 9))]
    assert cuts(spark, obs, [package(1, 19, 9, 6000)]) == [(day(1), 8000)]
    assert cuts(spark, obs, [package(1, 19, 10, 6000)]) == []
    assert cuts(spark, obs, [package(1, 19, 0, 1)]) == []


def test_overnight_hours_are_not_sold_twice(spark):
    obs = [observation(1, range(12, 24)), observation(2, range(0, 12))]
    night = package(1, 19, 9, 1000, 1)
    late, early = package(1, 18, 22, 1, 2), package(1, 12, 18, 1, 3)
    next_early, next_late = package(2, 8, 12, 1, 4), package(2, 9, 12, 1, 5)
    assert cuts(spark, obs, [night, late, next_early]) == [(day(1), 13000)]
    assert cuts(spark, obs, [night, early, next_late]) == [(day(1), 5999), (day(1), 13000), (day(2), 2999)]


def test_unseen_day_is_filled_from_the_same_day_class(spark):
    obs = [observation(8, range(10, 14)), observation(9, range(10, 14))]
    packs = [package(1, 10, 14, 3000), package(3, 10, 14, 1000, 2)]  # day 8 has the class of day 1
    assert cuts(spark, obs, packs) == [(day(8), 1000), (day(9), 3000)]


def test_disagreeing_holiday_flags_double_an_equal_filling(spark):
    obs = [observation(8, range(10, 14), rate=1), observation(8, [20], rate=2, holiday=True)]
    packs = [package(3, 10, 14, 3000)]
    assert cuts(spark, obs, packs) == [(day(8), 2 * 4000 - 3000)]


def test_party_size_bounds(spark):
    obs = [observation(1, [1, 2, 5])]
    hourly = run_pricing(spark, obs, guest=(1, 1, 1, "N", 4, 500, "Y")).priced.collect()[0]
    assert (hourly.sold_floor, hourly.sold_ceil, hourly.block_add) == (3000, 3 * (1000 + 4 * 500), 0)
    once = run_pricing(spark, obs, guest=(1, 1, 1, "N", 4, 500, "N")).priced.collect()[0]
    assert (once.sold_ceil, once.block_add, once.n_blocks) == (3000, 2000, 2)
    person = run_pricing(spark, obs, guest=(1, 1, 1, "Y", 4, 500, "N"), seats=(1, 1, 2, 8)).priced.collect()[0]
    assert (person.sold_floor, person.sold_ceil, person.block_add) == (6000, 24000, 0)
    unknown = run_pricing(spark, obs, guest=(9, 9, 9, "Y", 4, 500, "N")).priced.collect()[0]
    assert (unknown.sold_floor, unknown.sold_ceil, unknown.block_add) == (3000, 3000, 0)


def test_unknown_price_counts_the_hour_but_adds_nothing(spark):
    obs = [observation(1, [1, 2], [None] * 2 + [500] + [None] * 21, price=None)]
    r = run_pricing(spark, obs).priced.collect()[0]
    assert (r.sold_h, r.sold_known_h, r.sold_floor, r.open_h) == (2, 1, 500, 24)


def test_revenue_bounds_and_blocks(spark):
    obs = [observation(t, range(t, t + 4)) for t in range(1, 6)]
    frames = observations(spark, obs)
    rev = revenue.venue_revenue(
        frames, occupancy.closed_masks(frames), rates(spark, [GUEST]), units(spark, [(1, 1, 1, 8)]),
        packages(spark, [package(1, 1, 5, 1000)]), D0,
    ).collect()[0]
    assert rev.short_days == 3 and rev.short_booked_h == 12 and rev.all_booked_h == 20
    assert rev.short_rev_day == Decimal("3000.0") and rev.rev_month_short == 91200
    assert rev.n_rsv_blocks == 5 and rev.n_pkg_blocks == 1 and rev.rev_month_all <= rev.rev_month_all_ceil
    assert rev.adr == Decimal("1000.0")


def test_settled_takes_the_last_observation_before_the_day(spark):
    rows = [
        observation(3, [1], observed=0), observation(3, [1, 2], observed=2), observation(3, range(24), observed=3),
        observation(4, [5], observed=0), observation(9, [1], observed=0),
    ]
    obs = observations(spark, rows)
    closed = occupancy.closed_masks(obs)
    as_of = day(5).isoformat()
    args = (obs, closed, rates(spark, [GUEST]), units(spark, [(1, 1, 1, 8)]), packages(spark, []), as_of)
    r = settled.venue_settled(*args).collect()[0]
    assert (r.n_days, r.n_days_final, r.booked_h) == (2, 1, 3)
    assert (r.rev, r.rev_day, r.rev_day_final) == (3000, Decimal("1500.0"), Decimal("2000.0"))
    first = settled.last_seen(obs.where(F.col("observed_date") < day(2)))
    rolled = settled.roll_last_seen(first, obs.where(F.col("observed_date") >= day(2)))
    assert settled.venue_settled(*args, seen=rolled).collect()[0] == r


def test_islands_by_window_and_suffix_minimum(spark):
    df = spark.createDataFrame([(1, h) for h in (3, 4, 5, 9, 10)], "k int, hour int")
    runs = relational.islands(df, ["k"], "hour").groupBy("blk").count().collect()
    assert sorted(r["count"] for r in runs) == [2, 3]
    listing = spark.createDataFrame(
        [(1, "2024-02-01"), (2, "2024-03-09"), (3, "2024-01-05"), (4, "2024-04-01")], "space_id long, lastmod string"
    )
    got = {r.space_id: (r.registered, r.vintage_month) for r in venue_vintage(listing).collect()}
    early, jan = "2024-01-05", dt.date(2024, 1, 1)
    assert got == {1: (early, jan), 2: (early, jan), 3: (early, jan), 4: ("2024-04-01", dt.date(2024, 4, 1))}


def test_suffix_minimum_over_many_ranges(spark):
    rows = [(i, f"2024-{(i * 37) % 12 + 1:02d}-{(i * 11) % 28 + 1:02d}") for i in range(3000)]
    df = spark.createDataFrame(rows, "space_id long, lastmod string")
    got = {r.space_id: r.s for r in relational.suffix_min(df, "space_id", "lastmod", "s").collect()}
    low, want = "9999", {}
    for i, d in reversed(rows):
        low = min(low, d)
        want[i] = low
    assert got == want


def test_global_orders_take_one_shuffle(spark):
    """Ties, nulls, a hot place, two columns; the rows are exchanged once."""
    rows = [(5, i) for i in range(300)] + [(i % 40, -i) for i in range(200)] + [(None, 7), (None, 900)]
    df = spark.createDataFrame(rows, "x int, y int").repartition(5)
    made = relational.suffix_min(df, "x", "y", "s")
    known = lambda v: (v is not None, v)
    want = sorted((known(x), y, min(b for a, b in rows if known(a) >= known(x))) for x, y in rows)
    assert sorted((known(r.x), r.y, r.s) for r in made.collect()) == want
    sample = relational.stride_sample(df, ["x", "y"], 9)
    ranked = sorted(rows, key=lambda r: (known(r[0]), r[1]))
    assert sorted((known(r.x), r.y) for r in sample.collect()) == [(known(ranked[i * 55][0]), ranked[i * 55][1]) for i in range(9)]
    for plan in (made, sample):
        text = plan._jdf.queryExecution().executedPlan().toString()
        text = text.split("== Initial Plan ==")[-1]
        assert text.count("Exchange hashpartitioning") == 1 and "Exchange rangepartitioning" not in text
    assert relational.suffix_min(df.limit(0), "x", "y").collect() == [] == relational.stride_sample(df.limit(0), ["x"]).collect()


def test_stride_sample_and_recent_gaps(spark):
    df = spark.range(100).withColumnRenamed("id", "x")
    assert sorted(r.x for r in relational.stride_sample(df, ["x"], 12).collect()) == [i * 8 for i in range(12)]
    assert [r.x for r in relational.recent_then_oldest_first(df, "x", 3).collect()] == [97, 98, 99]


def test_expectations_and_missing_days(spark):
    measures = spark.createDataFrame(
        [(day(0), "observation_rows", Decimal(5)), (day(0), "attempts_failed_share", Decimal("0.04"))],
        "day date, rule string, value decimal(20,4)",
    )
    got = {r.rule: (r.value, r.ok) for r in quality.daily_expectations(measures).collect()}
    assert got.keys() == quality.RULES.keys()
    assert got.pop("attempts_failed_share") == (Decimal("0.04"), True)
    assert got.pop("observation_rows") == (Decimal(5), False)
    assert set(got.values()) == {(None, False)}  # nothing was measured: the tables are missing
    d = lambda ns, c: spark.createDataFrame([(day(n),) for n in ns], f"{c} date")
    rows = quality.missing_days(
        d([1, 2, 3, 4], "observed_date"), d([1, 2, 4], "observed_date"), d([2, 4], "observed_date"), d([], "as_of"), 2
    ).collect()
    assert [(r.day, r.need_fill, r.need_revenue, r.need_settled) for r in rows] == [
        (day(3), True, True, False), (day(4), False, False, True),
    ]


def test_package_windows_module_lists_both_kinds(spark):
    seen = pk.seen_windows(spark.createDataFrame(
        [(1, 1, day(1), 10, 14, 5), (1, 1, day(1), 10, 14, 3)],
        "space_id long, product_id long, target_date date, shour int, ehour int, pkg_floor long",
    ))
    assert [r.pkg_floor for r in seen.collect()] == [3]
