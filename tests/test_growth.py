"""Work that has to grow with the tables and no faster: small frames, and what is done to them."""

import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F

from frames import day, observation, observations, package, packages, rates, units
from roomtide import fixtures, landed, schemas, session
from roomtide.functions import hours as H
from roomtide.keys import OBSERVATION
from roomtide.operators import occupancy, relational, revenue, settled
from roomtide.operators import packages as pk
from roomtide.sources import calendar, published, writers
from roomtide.streaming import landing

LINE = ("l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, "
        "l_discount double, l_tax double, l_shipdate timestamp")


@pytest.fixture
def panel(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(fixtures, "VENUES_EACH", 2)
    spark.range(24).select(F.col("id").alias("s_suppkey")).write.parquet(str(tmp_path / "supplier.parquet"))
    shipped = dt.datetime(1970, 1, 1) + dt.timedelta(days=45 * 10 + 20)  # target date 2026-01-21
    lines = [(29, 2, 1, 2, 7.0, 0.0, 0.0, 0.0, shipped), (30, 2, 1, 1, 20.0, 0.0, 0.0, 0.0, shipped),
             (None, 2, 1, 1, 7.0, 0.0, 0.0, 0.0, shipped), (29, 2, None, 2, 7.0, 0.0, 0.0, 0.0, shipped)]
    spark.createDataFrame(lines, LINE).write.parquet(str(tmp_path / "lineitem.parquet"))
    return fixtures.Panel(spark, str(tmp_path))


def test_tasks_that_derive_the_panel_grow_in_number_not_in_size(panel):
    assert panel._packages().rdd.getNumPartitions() == 12
    assert panel._observations().rdd.getNumPartitions() == 12


def plan(df, kind="executedPlan"):
    return getattr(df._jdf.queryExecution(), kind)().toString()


def test_bookings_are_dealt_by_venue_once(panel):
    assert plan(panel._runs).count("Exchange") == 1


def test_days_unfold_when_they_are_read(panel):
    assert "Generate explode" in plan(panel.observations, "optimizedPlan") and "Generate" in plan(panel.packages, "optimizedPlan")
    keys = plan(panel.observations.where("observed_date = '2026-01-16'").select("space_id", "target_date"), "optimizedPlan")
    assert "runs" not in keys.split("Generate explode(sequence")[0]
    by_rate = panel.observations.groupBy("space_id", "observed_date").count()
    assert plan(by_rate).count("Exchange") == 1


def test_listed_hours(spark):
    masks = spark.createDataFrame([(None,), (0,), (1,), (0xFFFFFF,), (0x820801,), (0x3FC00,)], "mask int")
    rows = masks.select(fixtures._listed_hours("mask").alias("a"), H.mask_hours("mask").cast("array<smallint>").alias("b")).collect()
    assert [r.a for r in rows] == [r.b for r in rows] and rows[4].a == [0, 11, 17, 23]


def test_bookings_of_the_panel_by_observation(panel):
    rows = panel.observations.where("space_id = 1 AND product_id = 2 AND target_date = '2026-01-21'").collect()
    closed = [0, 1, 2]  # venue 1: the first three hours
    assert {str(r.observed_date): r.booked_hours for r in rows} == {
        "2026-01-02": [*closed, 6, 7], "2026-01-09": [*closed, 6, 7], "2026-01-16": [*closed, 5, 6, 7], "2026-01-17": [*closed, 5, 6, 7]}
    assert panel.observations.count() == 24 * 7 * (44 + 37 + 30 + 29)


def test_folded_batches_are_upserts_one_after_the_other(spark):
    make = lambda rows: spark.createDataFrame(rows, "k long, a string, b string, c string, d string")
    batches = [make([(1, "a1", "b1", None, "d1"), (None, "x1", "x", "x", "x"), (2, "p", "p", "p", "p")]),
               make([(1, "a2", "b2", "c2", None), (None, "x2", "x", "x", "x")]), make([(1, "a3", "b3", None, "d3"), (3, "q", "q", "q", "q")])]
    policy = {"a": writers.NEW, "c": writers.NEW_ELSE_OLD, "d": writers.OLD_ELSE_NEW}
    one_by_one = batches[0]
    for b in batches[1:]:
        one_by_one = writers.upsert(one_by_one, b, ["k"], policy)
    numbered = writers.union_all(*[b.withColumn("batch", F.lit(i)) for i, b in enumerate(batches)])
    got = writers.fold(numbered, ["k"], policy, "batch")
    order = lambda df: sorted(map(tuple, df.collect()), key=str)
    assert order(got) == order(one_by_one) and (1, "a3", "b1", "c2", "d1") in order(got) and got.count() == 5


def slots(folder, n):
    """Files that land one after the other; all tell of one key, each also of one of its own."""
    folder.mkdir()
    for i in range(n):
        row = {"space_id": 1, "product_id": 1, "rsv_type_id": 1, "observed": "2026-01-01", "wday": str(i), "hday": "N", "n_slots": 24, "price": 100, "hp": []}
        rows = [{**row, "d": "2026-02-01", "booked": list(range(i + 1))}, {**row, "d": f"2026-01-1{i}", "booked": [i]}]
        (folder / f"{i}.json").write_text("\n".join(map(json.dumps, rows)))
        os.utime(folder / f"{i}.json", (1_770_000_000 + i, 1_770_000_000 + i))


def expected(n):
    return sorted([("2026-02-01", n), *((f"2026-01-1{i}", 1) for i in range(n))])


def test_a_run_of_many_batches_rewrites_the_stored_days_once(spark, tmp_path, monkeypatch):
    slots(tmp_path / "in", 4)
    real, replaced, batches = landing.replace_partition, [], []
    monkeypatch.setattr(landing, "replace_partition", lambda df, path, **o: (replaced.append(path), real(df, path, **o)))
    kept = landing.keep_batch
    monkeypatch.setattr(landing, "keep_batch", lambda b, n, at: (batches.append(n), kept(b, n, at)))
    table = str(tmp_path / "table")
    landing.run_ingest(spark, str(tmp_path / "in"), table, str(tmp_path / "cp"), files_per_batch=1)
    assert batches == [0, 1, 2, 3] and len(replaced) == 2
    rows = spark.read.schema(schemas.OBSERVATION).parquet(table).collect()
    assert sorted((str(r.target_date), r.n_booked) for r in rows) == expected(4)


def test_a_run_that_died_is_merged_by_the_next_one_first(spark, tmp_path, monkeypatch):
    slots(tmp_path / "in", 3)
    table, cp = str(tmp_path / "table"), str(tmp_path / "cp")
    kept = landing.keep_batch

    def dies(batch, n, at):
        kept(batch, n, at)
        if n == 1:
            raise RuntimeError("killed")

    with monkeypatch.context() as m:
        m.setattr(landing, "keep_batch", dies)
        with pytest.raises(Exception, match="killed"):
            landing.run_ingest(spark, str(tmp_path / "in"), table, cp, files_per_batch=1)
    landing.run_ingest(spark, str(tmp_path / "in"), table, cp, files_per_batch=1)
    rows = spark.read.schema(schemas.OBSERVATION).parquet(table).collect()
    assert sorted((str(r.target_date), r.n_booked) for r in rows) == expected(3)


def test_the_batches_of_a_run_are_published_together(spark, tmp_path):
    slots(tmp_path / "in", 3)
    store = published.Published(spark, str(tmp_path / "tables"))
    landing.publish_ingest(store, str(tmp_path / "in"), str(tmp_path / "cp"), "observation", "package", files_per_batch=1)
    assert store.manifest().number == 1
    assert sorted((str(r.target_date), r.n_booked) for r in store.read("observation").collect()) == expected(3)


def test_a_batch_is_kept_in_one_pass_without_a_shuffle(spark, tmp_path, monkeypatch):
    slots(tmp_path / "in", 2)
    staged, plans, real = [], [], landing.shaped
    monkeypatch.setattr(landing, "stage", lambda df, label: staged.append(label))
    monkeypatch.setattr(landing, "shaped", lambda df, schema: (plans.append(plan(df)), real(df, schema))[1])
    batch = landing.ingest_stream(spark, str(tmp_path / "in"))
    assert batch.isStreaming
    landed = spark.read.schema(schemas.SLOT).json(str(tmp_path / "in")).select(
        "*", F.col("_metadata.file_modification_time").alias("landed_at"), F.col("_metadata.file_path").alias("landed_in"))
    landing.keep_batch(landed, 0, str(tmp_path / "kept"))
    assert not staged and len(plans) == 1 and "Exchange" not in plans[0] and "Sort" not in plans[0]


def test_days_that_are_not_stored_yet_are_not_merged(spark, tmp_path, monkeypatch):
    slots(tmp_path / "in", 2)

    def merged(*_, **__):
        raise AssertionError("merged")

    monkeypatch.setattr(landing, "upsert", merged)
    store, table = published.Published(spark, str(tmp_path / "tables")), str(tmp_path / "table")
    landing.publish_ingest(store, str(tmp_path / "in"), str(tmp_path / "cp"), "observation", "package")
    landing.run_ingest(spark, str(tmp_path / "in"), table, str(tmp_path / "cp2"))
    assert store.read("observation").count() == spark.read.schema(schemas.OBSERVATION).parquet(table).count() == 3
    (tmp_path / "in" / "late.json").write_text((tmp_path / "in" / "0.json").read_text())
    with pytest.raises(AssertionError, match="merged"):
        landing.run_ingest(spark, str(tmp_path / "in"), table, str(tmp_path / "cp2"))


def test_new_days_whose_writing_died_are_written_again_not_merged_with(spark, tmp_path, monkeypatch):
    slots(tmp_path / "in", 2)
    lost = json.loads((tmp_path / "in" / "0.json").read_text().split("\n")[0]) | {"space_id": None}
    (tmp_path / "in" / "lost.json").write_text(json.dumps(lost))
    real = landing.replace_partition

    def dies(df, path, **o):
        real(df, path, **o)
        raise RuntimeError("killed")

    table, cp = str(tmp_path / "table"), str(tmp_path / "cp")
    with monkeypatch.context() as m:
        m.setattr(landing, "replace_partition", dies)
        with pytest.raises(Exception, match="killed"):
            landing.run_ingest(spark, str(tmp_path / "in"), table, cp)
    landing.run_ingest(spark, str(tmp_path / "in"), table, cp)
    rows = spark.read.schema(schemas.OBSERVATION).parquet(table).collect()
    assert sorted((r.space_id or 0, str(r.target_date)) for r in rows) == [(0, "2026-02-01"), (1, "2026-01-10"), (1, "2026-01-11"), (1, "2026-02-01")]
    assert session.names_in(spark, f"{cp}-merged") == []


def test_repeats_within_and_between_batches_are_folded_as_if_merged_one_by_one(spark, tmp_path):
    folder = tmp_path / "in"
    slots(folder, 3)
    row = json.loads((folder / "0.json").read_text().split("\n")[0])
    offer = {**row, "kind": "pkg", "package_id": 4, "name": "n", "shour": 1, "ehour": 2, "available": "true"}
    for i in range(3):
        more = [{**row, "space_id": None, "price": i}, {**row, "space_id": None, "price": 10 + i}, {**offer, "price": i}, {**offer, "price": 20 + i}]
        with open(folder / f"{i}.json", "a") as f:
            f.write("\n" + "\n".join(map(json.dumps, more)))
        os.utime(folder / f"{i}.json", (1_770_000_000 + i, 1_770_000_000 + i))
    table = str(tmp_path / "table")
    landing.run_ingest(spark, str(folder), table, str(tmp_path / "cp"), files_per_batch=1)
    rows = spark.read.schema(schemas.OBSERVATION).parquet(table).collect()
    assert sorted(r.price for r in rows if r.space_id is None) == [10, 11, 12]  # a key with a null matches none of another batch
    assert [(r.n_booked, r.wday) for r in rows if r.space_id and str(r.target_date) == "2026-02-01"] == [(3, "0")]
    assert [r.price for r in spark.read.schema(schemas.PACKAGE).parquet(f"{table}-packages").collect()] == [22]


def test_scans_have_tasks_by_the_size_of_what_was_kept(spark, tmp_path):
    spark.range(200_000).repartition(1).write.parquet(str(tmp_path / "t"))
    before = spark.conf.get("spark.sql.files.minPartitionNum", None)
    with session.scan_tasks(spark, 7):
        assert spark.conf.get("spark.sql.files.minPartitionNum") == "7"
    assert spark.conf.get("spark.sql.files.minPartitionNum", None) == before
    assert session.stored_bytes(spark, str(tmp_path / "t")) == sum(f.stat().st_size for f in (tmp_path / "t").glob("part*"))


def test_hours_of_a_calendar_day_are_found_without_a_lambda_in_a_lambda(spark):
    schema = "space_id long, product_id long, rsv_type_id long, observed string, days array<struct<year: int, month: int, day: int, wday: string, hday: string, times: array<struct<hour: int, price: int, available: boolean>>>>"
    times = [(3, 30, True), (1, 10, False), (3, 31, False), (None, 5, True), None, (24, 9, None), (2, None, True), (2, 20, True)]
    days = [(2026, 1, 20, "2", "N", times), (2026, 1, 21, "3", "N", []), (2026, 1, 22, "4", "N", None)]
    flat = calendar.flatten_calendar(spark.createDataFrame([(1, 1, 1, "2026-01-02", days)], schema))
    r, = flat.collect()
    assert r.hp == [None, 10, None, 30, *[None] * 20] and (r.n_slots, r.price, r.d) == (8, 30, "2026-01-20")
    assert r.booked == [1, 3, None, 24]
    assert dict(flat.dtypes)["booked"] == "array<smallint>" and dict(flat.dtypes)["hp"] == "array<int>"
    assert "sequence" not in plan(flat.select("hp"), "analyzed")


def test_responses_list_the_hours_of_whole_and_of_other_days(spark):
    obs = observations(spark, [observation(1, [0, 23], prices=[*range(23), None]), observation(2, [1], prices=[7, 8]), observation(3, [], prices=[])])
    r, = landed.calendar_responses(obs).collect()
    whole, two, none = (y.times for y in r.days)
    assert [tuple(t) for t in whole] == [(h, h if h < 23 else None, h not in (0, 23)) for h in range(24)]
    assert [tuple(t) for t in two] == [(0, 7, True), (1, 8, False)] and none == []


def test_kept_rows_and_those_of_new_days_meet_in_one_grouping(spark):
    obs = observations(spark, [observation(n, [o], observed=o, price=100 + o) for o in (0, 1, 2) for n in range(o + 1, 6)])
    on = lambda df, cond: df.where(cond)
    first, new = settled.last_seen(on(obs, F.col("observed_date") == day(0))), on(obs, F.col("observed_date") > day(0))
    kept = spark.createDataFrame(first.collect(), first.schema)
    rolled = settled.roll_last_seen(kept, new)
    assert plan(rolled).count("Exchange") == 1
    assert sorted((r.target_date, r.observed_date, r.price) for r in rolled.collect()) == sorted(
        (r.target_date, r.observed_date, r.price) for r in settled.last_seen(obs).collect())
    offers = packages(spark, [package(5, 1, 2, 10 + o, observed=o) for o in (0, 1, 2)] + [package(6, 1, 2, 0, observed=2), package(6, 1, 2, 7, observed=0)])
    old = pk.latest_packages(on(offers, F.col("observed_date") == day(0)), day(0).isoformat())
    held = spark.createDataFrame(old.collect(), old.schema)
    prices = pk.roll_latest_packages(held, on(offers, F.col("observed_date") > day(0)), day(2).isoformat())
    assert plan(prices).count("Exchange") == 1
    assert sorted((r.target_date, r.price) for r in prices.collect()) == [(day(5), 12), (day(6), 7)]


def test_days_carry_their_classes_before_they_are_unfolded(spark):
    obs = observations(spark, [observation(n, [n % 3, 5], observed=o) for o in (0, 1) for n in range(o + 1, 20)])
    days = occupancy.future_only(obs)
    classes = occupancy.hour_class(obs).where("hour <> 7")
    joined = occupancy.with_hour_class(H.explode_hours(days), classes).select(*OBSERVATION, "hour", "is_closed")
    carried = occupancy.with_hour_class(H.explode_hours(occupancy.with_day_classes(days, classes)), classes).select(*joined.columns)
    assert carried.exceptAll(joined).count() == joined.exceptAll(carried).count() == 0 and joined.count() == 23 * 37
    plan = carried._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Generate") < plan.index("Join")


def test_priced_days_alone_ask_for_no_package(spark, monkeypatch):
    def asked(*_):
        raise AssertionError("cuts were made")

    monkeypatch.setattr(revenue, "package_adjustment", asked)
    obs = observations(spark, [observation(n, [5]) for n in range(1, 4)])
    days = occupancy.open_days(obs, occupancy.closed_masks(obs))
    p = revenue.pricing(days, obs, rates(spark, [(1, 1, 1, "N", 4, 5, "N")]), units(spark, [(1, 1, 1, 8)]), packages(spark, []), day(0).isoformat())
    assert p.priced.count() == 3 and p.blocks.count() == 3
    with pytest.raises(AssertionError, match="cuts were made"):
        _ = p.cuts


def test_days_are_written_in_key_order_with_one_sort(spark, tmp_path):
    obs = observations(spark, [observation(n, [1], observed=o, space=s) for s in (2, 1) for n in (9, 8) for o in (1, 0)]).coalesce(1)
    writers.replace_partition(obs, str(tmp_path / "t"), sort=["space_id", "target_date"])
    for name in ("observed_date=2026-01-01", "observed_date=2026-01-02"):
        rows = spark.read.parquet(str(tmp_path / "t" / name)).select("space_id", "target_date").collect()
        assert [tuple(r) for r in rows] == [(s, day(n)) for s in (1, 2) for n in (8, 9)]


def test_last_rows_of_fixed_width_are_found_without_a_sort(spark):
    rows = spark.createDataFrame([(1, 1, 9, None), (1, 3, None, 0.5), (1, None, 7, 1.5), (2, None, 4, 2.5), (None, 2, 5, None), (None, 1, 6, 3.5)],
                                 "k long, day int, a int, b double")
    last = relational.latest_per(rows, ["k"], "day")
    assert "Sort" not in plan(last) and last.columns == ["k", "day", "a", "b"]
    assert sorted(map(tuple, last.collect()), key=str) == [(1, 3, None, 0.5), (2, None, None, None), (None, 2, 5, None)]
    texts = relational.latest_per(rows.withColumn("b", F.col("b").cast("string")), ["k"], "day")
    assert sorted(map(tuple, texts.collect()), key=str) == [(1, 3, None, "0.5"), (2, None, None, None), (None, 2, 5, None)]


def test_overnight_windows_are_chosen_once_for_claims_and_cuts(spark, monkeypatch):
    staged, real = [], pk.stage
    monkeypatch.setattr(pk, "stage", lambda df, label: (staged.append(label), real(df, label))[1])
    hit = "space_id long, product_id long, rsv_type_id long, observed_date date, target_date date, blk int, lead_days int"
    win = "shour int, ehour int, pkg_floor long, win_floor long"
    over = spark.createDataFrame([(1, 1, 1, day(0), day(1), 3, 1, day(0), -1, 22, 2, 10, 30)], f"{hit}, head_observed_date date, blk_next int, {win}")
    days = spark.createDataFrame([(1, 1, 1, day(0), day(1), 3, 1, 20, 24, 10, 90), (1, 1, 1, day(0), day(2), -1, 2, 1, 4, 10, 90),
                                  (1, 1, 1, day(0), day(2), -1, 2, 2, 5, 10, 15)], f"{hit}, {win}")
    chosen_day, chosen_over = pk.choose_packages(days, over)
    assert staged == ["overnight"]
    assert [(r.target_date, r.cut) for r in chosen_day.collect()] == [(day(2), 5)]
    assert [(r.target_date, r.cut) for r in chosen_over.collect()] == [(day(1), 20)]
