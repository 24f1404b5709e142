import datetime as dt
from decimal import Decimal

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from roomtide.functions import hours as H
from roomtide.functions import scalars as S
from roomtide.functions.arrays import array_median, upper_median
from roomtide.functions.classify import classify
from roomtide.functions.geo import haversine_m, within_radius
from roomtide.functions.region import is_road_address, parse_region, split_address
from roomtide.functions.stats import Pct, count_distinct_tuple, grouped_percentiles


def one(spark, *cols):
    return spark.range(1).select(*[c.alias(f"c{i}") for i, c in enumerate(cols)]).collect()[0]


def runs_of(hours):
    out = []
    for h in sorted(set(hours)):
        if out and out[-1][1] == h - 1:
            out[-1][1] = h
        else:
            out.append([h, h])
    return [tuple(r) for r in out]


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.lists(st.integers(-2, 26), max_size=30), min_size=1, max_size=20))
def test_masks_and_runs_agree_with_sets(spark, days):
    df = spark.createDataFrame([(i, d) for i, d in enumerate(days)], "i int, hours array<smallint>")
    df = df.withColumn("m", H.hour_mask("hours"))
    rows = df.select("i", H.mask_hours("m").alias("back")).collect()
    blocks = df.select("i", "m", F.explode(H.mask_hours(H.run_starts("m"))).alias("h0")).select(
        "i", "h0", (F.col("h0") + H.run_length("m", "h0") - 1).alias("h1"), H.run_label("m", "h0").alias("blk")
    ).collect()
    for r in rows:
        inside = sorted({h for h in days[r.i] if 0 <= h < 24})
        assert r.back == inside
        assert sorted((b.h0, b.h1) for b in blocks if b.i == r.i) == runs_of(inside)
        for b in (b for b in blocks if b.i == r.i):
            assert b.blk == b.h0 - (inside.index(b.h0) + 1)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.integers(0, 2), st.one_of(st.none(), st.integers(-5000, 5000))), max_size=60))
def test_grouped_percentiles_match_the_builtin(spark, rows):
    df = spark.createDataFrame(rows, "k int, v int").withColumn("x", (F.col("v") / 10).cast("decimal(8,1)"))
    wanted = {f"p{p}": Pct(F.col("x"), p, 1, 3) for p in (25, 50, 75, 90)}
    got = {r.k: r for r in grouped_percentiles(df, ["k"], wanted).collect()}
    builtin = df.groupBy("k").agg(*[F.percentile("x", p / 100).alias(f"p{p}") for p in (25, 50, 75, 90)])
    for r in builtin.collect():
        if r.p50 is None:
            assert r.k not in got
        else:
            assert all(abs(float(got[r.k][c]) - r[c]) < 1e-9 for c in wanted)


def test_percentiles_keep_null_groups_and_upper_median(spark):
    df = spark.createDataFrame([(None, 1), (None, 2), ("a", 4), ("a", 1), ("a", 2), ("a", 3)], "k string, v int")
    wanted = {"mid": Pct(F.col("v"), 50, 0, 1), "up": Pct(F.col("v"), upper=True)}
    got = {r.k: (r.mid, r.up) for r in grouped_percentiles(df, ["k"], wanted).collect()}
    assert got == {None: (Decimal("1.5"), 2), "a": (Decimal("2.5"), 3)}


def test_one_hot_group_spreads_over_partitions(spark):
    """No shuffle of the percentile plan is keyed by the group alone before values are counted."""
    df = spark.range(5000).select(F.lit(1).alias("k"), (F.col("id") * 7919 % 5000).alias("v"))
    row = grouped_percentiles(df, ["k"], {"m": Pct(F.col("v"), 50, 0, 1), "p": Pct(F.col("v"), 90, 0, 1)}).collect()[0]
    assert (row.m, row.p) == (Decimal("2499.5"), Decimal("4499.1"))


def test_three_medians(spark):
    four, two = F.array(*[F.lit(i) for i in (4, 1, 3, 2)]), F.array(F.lit(1), F.lit(2))
    assert tuple(one(spark, array_median(four), upper_median(four))) == (3, 3)
    assert tuple(one(spark, array_median(two), upper_median(two))) == (2, 2)


@pytest.mark.parametrize("num,den,scale,want", [
    (2, 3, 4, "0.6667"), (1, 8, 2, "0.13"), (-1, 8, 2, "-0.13"), (5, 0, 2, None), (57, 200, 2, "0.29"),
    (1999, 2500, 3, "0.800"),
])
def test_ratio_rounds_half_away_from_zero(spark, num, den, scale, want):
    got = one(spark, S.ratio(F.lit(num), F.lit(den), scale))[0]
    assert got == (None if want is None else Decimal(want))


def test_monthly_uses_thirty_point_four_days(spark):
    assert one(spark, S.monthly(F.lit(100), F.lit(3)))[0] == 1013


def test_undefined_ratio_yields_the_cap(spark):
    null = F.lit(None).cast("decimal(18,6)")
    zero, half = F.lit(Decimal("0")), F.lit(Decimal("0.5"))
    got = one(spark, S.capped_ratio(null, half, Decimal("1.5")), S.capped_ratio(half, zero, Decimal("1.0")))
    assert tuple(got) == (Decimal("1.500"), Decimal("1.000"))


def test_scalar_coercions(spark):
    got = one(
        spark, S.num_or_null(F.lit("x")), S.num_or_null(F.lit("0")), S.num_or_null(F.lit("7.5")),
        S.yes_no(F.lit(True)), S.yes_no(F.lit("N")), S.yes_no(F.lit(None).cast("boolean")),
        S.months_open(F.lit(dt.date(2026, 1, 17)), F.lit(dt.date(2026, 1, 1))),
        S.months_open(F.lit(dt.date(2026, 1, 17)), F.lit(dt.date(2024, 12, 1))),
        S.day_class(F.lit(dt.date(2026, 1, 4)), F.lit(False)), S.day_class(F.lit(dt.date(2026, 1, 4)), F.lit(True)),
        F.unix_seconds(S.review_ts(F.lit("2026-01-10 08:30:00"))),
    )
    assert tuple(got) == (None, None, 7.5, "Y", "N", None, 1, 13, 0, 7, 1768001400)


@pytest.mark.parametrize("price,base,cap,want", [
    (100, 10.0, None, True), (99, 10.0, None, False), (600_000, None, 500_000, True), (600_000, 759750.0, 500_000, True),
    (1_000_000, 759750.0, None, False), (None, 10.0, 500_000, None),
])
def test_dummy_prices(spark, price, base, cap, want):
    p, b = F.lit(price).cast("int"), F.lit(base).cast("double")
    assert one(spark, S.is_dummy(p, b, 10, cap))[0] is want


@pytest.mark.parametrize("addr,want", [
    ("서울 강남구 역삼동 12-3", ("서울특별시", "강남구", "역삼동")),
    (" 서울특별시  강남구 테헤란로 12", ("서울특별시", "강남구", None)),
    ("경기 고양시 일산동구 정발산동 7", ("경기도", "고양시 일산동구", "정발산동")),
    ("경남 창원시 의창군 북면 1", ("경상남도", "창원시 의창군", None)),
    ("어딘가", ("어딘가", None, None)), (None, (None, None, None)), ("", (None, None, None)),
])
def test_parse_region(spark, addr, want):
    r = one(spark, parse_region(F.lit(addr).cast("string"), F.lit("1168010100")))[0]
    assert (r.sido, r.sigungu, r.dong) == want
    assert (r.sido_code, r.sigungu_code, r.dong_code) == ("11", "11680", "1168010100")


def test_plain_split_and_road_test(spark):
    r = one(spark, split_address(F.lit("경남 창원시 의창군 북면 1")), is_road_address(F.lit("토정로17길 11")))
    assert (r[0].sido, r[0].sigungu, r[0].dong) == ("경남", "창원시", "의창군") and r[1]


@pytest.mark.parametrize("strong,weak,want", [
    ("홍대 댄스 연습실", "파티룸", "연습실"), ("공간", "생일 파티", "파티룸"), ("쿠킹 스튜디오 촬영", None, "공유주방"),
    ("공간", "아무것도", "기타"),
])
def test_classify(spark, strong, weak, want):
    assert one(spark, classify(F.lit(strong), F.lit(weak).cast("string")))[0] == want


def test_tuples_with_null_members_count(spark):
    df = spark.createDataFrame([(1, None), (1, None), (1, 2)], "a int, b int")
    assert df.agg(count_distinct_tuple("a", "b")).collect()[0][0] == 2


def test_radius(spark):
    got = one(spark, haversine_m(F.lit(37.5), F.lit(127.0), F.lit(37.509), F.lit(127.0)))[0]
    assert abs(got - 1000.75) < 1
    df = spark.createDataFrame([(1, 37.5085, 127.0), (2, 37.5095, 127.0), (3, 37.5, 127.0112)], "i int, lat double, lng double")
    assert sorted(r.i for r in within_radius(df, 37.5, 127.0, 1000).collect()) == [1, 3]
