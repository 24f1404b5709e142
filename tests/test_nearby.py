"""Radius joins between tables against all pairs: borders of cells, the date line, the poles, hot cells, missing positions."""

import math
import random

import pytest

from roomtide.operators import market, nearby


def metres(a, b, c, d):
    p, q = math.radians(a), math.radians(c)
    h = math.sin((q - p) / 2) ** 2 + math.cos(p) * math.cos(q) * math.sin(math.radians(d - b) / 2) ** 2
    return 2 * 6_371_008.8 * math.asin(min(1.0, math.sqrt(h)))


def pairs(spark, points, places, radius, **more):
    schema = "id long, lat double, lng double"
    met = nearby.radius_join(spark.createDataFrame(points, schema), spark.createDataFrame(places, schema), radius, **more)
    return met


def brute(points, places, radius):
    known = lambda r: None not in r and not any(map(math.isnan, r[1:])) and abs(r[1]) <= 90 and abs(r[2]) < math.inf
    return sorted((p[0], q[0]) for p in points for q in places if known(p) and known(q) and metres(*p[1:], *q[1:]) <= radius)


def ids(met):
    return sorted((r.point.id, r.place.id) for r in met.select("point", "place").collect())


SPOTS = {
    "city": lambda r: (r.uniform(37.4, 37.6), r.uniform(126.9, 127.1)),
    "date line": lambda r: (r.uniform(-1, 1), r.choice([179.99, -179.99, 180.0, -180.0, 179.5, 540.0]) + r.uniform(-0.2, 0.2)),
    "poles": lambda r: (r.choice([-90.0, 90.0, 89.9, -89.99, 89.5]), r.uniform(-180, 180)),
    "world": lambda r: (r.uniform(-90, 90), r.uniform(-180, 180)),
}


@pytest.mark.parametrize(("where", "radius"), [("city", 900), ("city", 30_000), ("date line", 15_000), ("poles", 40_000), ("world", 2_000_000), ("world", 2e7), ("poles", 0)])
def test_equals_all_pairs(spark, where, radius):
    r = random.Random(1)
    points = [(i, *SPOTS[where](r)) for i in range(150)]
    places = [(i, *SPOTS[where](r)) for i in range(120)] + [(200, *points[3][1:]), (200, *points[3][1:])]
    met = pairs(spark, points, places, radius)
    assert ids(met) == brute(points, places, radius)
    plan = met._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_hot_cells_and_missing_positions(spark):
    points = [(i, 10.0, 20.0) for i in range(60)] + [(99, None, 1.0), (98, math.nan, 1.0), (97, 91.0, 0.0), (96, 5.0, math.inf)]
    places = [(i % 30, 10.0, 20.0 + i % 2 / 1000) for i in range(90)] + [(99, None, None), (95, 10.0, 21.0)]
    assert ids(pairs(spark, points, places, 50, hot=7)) == brute(points, places, 50)
    dealt = pairs(spark, points, places, 50, hot=7)
    assert max(r.distance_m for r in dealt.collect()) == 0


def test_empty_tables(spark):
    assert ids(pairs(spark, [], [(1, 1.0, 1.0)], 10)) == ids(pairs(spark, [(1, 1.0, 1.0)], [], 10)) == []


def test_sql_function_reads_only_what_it_needs(spark, tmp_path):
    rows = [(i, "studio" if i % 2 else "party", i / 100, 0.0, str(i), True, False, 3, i * 100, None, None) for i in range(200)]
    schema = ("space_id long, category string, lat double, lng double, host_id string, active_90d boolean, is_newcomer boolean, "
              "review_total int, median_price int, total_pyeong decimal(10,2), reviews_per_month decimal(10,3)")
    spark.createDataFrame(rows, schema).write.parquet(str(tmp_path / "base"))
    base = spark.read.parquet(str(tmp_path / "base"))
    market.register_market_at(base, "around", "around_base")
    got = spark.sql("SELECT * FROM around(1.0D, 0.0D, 5000)")
    assert [tuple(r)[:2] for r in got.orderBy("category").collect()] == [
        tuple(r)[:2] for r in market.market_at(base, 1.0, 0.0, 5000).orderBy("category").collect()
    ]
    scan = got._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(lat" in scan and "space_id" not in scan
