import gzip
import json
import os
import shutil

import pytest
from pyspark.sql import functions as F

from frames import day, observation, observations, package, packages, rates, units
from roomtide import schemas, session
from roomtide.keys import OBSERVATION
from roomtide.operators import ingest
from roomtide.plans import daily
from roomtide.sources import pages, readers, writers
from roomtide.streaming import landing
from roomtide.streaming.landing import run_ingest


def lines(path, rows, cut=False, members=1):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    text = [json.dumps(r) if not isinstance(r, str) else r for r in rows]
    data = b""
    step = max(1, len(text) // members)
    for i in range(0, len(text), step):
        data += gzip.compress(("\n".join(text[i:i + step]) + "\n").encode())
    with open(path, "wb") as f:
        f.write(data[: len(data) * 2 // 3] if cut else data)
    return path


def slot(d, booked=(), observed="2026-01-01", **more):
    return {"space_id": 1, "product_id": 1, "rsv_type_id": 1, "observed": observed, "d": d, "wday": "1", "hday": "N",
            "n_slots": 24, "booked": list(booked), "hp": [100] * 24, "price": 100, **more}


def test_malformed_lines_fail_or_are_skipped(spark, tmp_path):
    path = lines(str(tmp_path / "s" / "a.json.gz"), [{"id": 1, "status": 200}, "", "{broken", {"id": 2, "status": 404}])
    assert sorted(r.id for r in readers.read_snapshots(spark, path, readers.SKIP).collect()) == [1, 2]
    with pytest.raises(Exception, match="FAILFAST|MALFORMED"):
        readers.read_snapshots(spark, path).collect()


def test_truncated_and_multi_member_gzip(spark, tmp_path):
    rows = [slot(f"2026-02-{i % 28 + 1:02d}", [i % 24], price=i) for i in range(4000)]
    whole = lines(str(tmp_path / "w" / "a.json.gz"), rows, members=5)
    time, _ = readers.read_slots(spark, whole)
    assert time.count() == 4000
    cut = lines(str(tmp_path / "c" / "a.json.gz"), rows, cut=True)
    with readers.truncated_files_allowed(spark):
        time, _ = readers.read_slots(spark, cut)
        kept = sorted(r.price for r in time.select("price").collect())
    assert 0 < len(kept) < 4000 and kept == list(range(len(kept)))


def test_slots_dedupe_drop_past_and_flags(spark, tmp_path):
    path = lines(str(tmp_path / "s" / "a.json.gz"), [
        slot("2025-12-31"), slot("2026-01-02", [1]), slot("2026-01-02", [1, 2], hday="Y"),
        {"kind": "pkg", **slot("2026-01-03"), "package_id": 7, "shour": 22, "ehour": 2, "available": True},
    ])
    time, package_rows = readers.read_slots(spark, path)
    rows, skipped = ingest.load_observations(time)
    got = rows.collect()
    assert [(r.booked_hours, r.n_booked, r.is_holiday) for r in got] == [([1, 2], 2, True)]
    assert skipped.collect()[0].n_skipped == 1
    packs, wrap = ingest.load_packages(package_rows)
    assert [(r.package_id, r.available) for r in packs.collect()] == [(7, True)] and wrap.collect()[0].n_wrap == 1


def test_venue_meta_and_sitemap(spark, tmp_path):
    (tmp_path / "meta.json").write_text(json.dumps({"5": {"name": "a", "break_days": [{"d": 1}]}, "6": {"name": "b"}}))
    got = {r.space_id: r.break_days for r in readers.read_venue_meta(spark, str(tmp_path / "meta.json")).collect()}
    assert got == {5: ['{"d":1}'], 6: []}
    url = "<url><loc>https://x.example/{}</loc><lastmod>2026-01-0{}</lastmod></url>"
    (tmp_path / "map.xml").write_text(
        "<urlset>" + url.format("space/3", 1) + url.format("space/3/review/9", 2) + url.format("about", 3) + "</urlset>"
    )
    assert [tuple(r) for r in readers.read_sitemap_venues(spark, str(tmp_path / "map.xml")).collect()] == [(3, "2026-01-01")]
    assert [tuple(r) for r in readers.read_sitemap_reviews(spark, str(tmp_path / "map.xml")).collect()] == [(3, 9, "2026-01-02")]


def push(text):
    return f"<script>self.__next_f.push([1,{json.dumps(text)}])</script>"


def test_page_state_detail(spark):
    detail = {"info": {"id": 7, "name": 'a "quoted" } name', "spc_tp_cd": "MEET"}, "products": [
        {"info": {"id": 1, "rsv_tp_cd": "TIME", "charging_per_person": True},
         "reservation_types": [{"id": 2, "RSV_TP_CD": "PKG", "rsv_tp_cd": "X", "is_extra_person_price_per_hour": False}]}]}
    text = '1:{"detail":{"info":{}},"detail":' + json.dumps(detail, separators=(",", ":")) + ',"x":1}'
    split = text.index('tail":{"info":{"id"')
    html = push(text[:split]) + '<script>self.__next_f.push([1,"bad \\x"])</script>' + push(text[split:])
    df = spark.createDataFrame([(1, html), (2, "<p>none</p>")], "page_id int, html string")
    rows = pages.parse_pages(df).collect()
    assert [r.page_id for r in rows] == [1]
    d = rows[0].detail
    assert (d.info.id, d.info.name, d.info.SPC_TP_CD) == (7, 'a "quoted" } name', "MEET")
    unit = d.products[0]
    assert (unit.info.RSV_TP_CD, unit.info.charging_per_person) == ("TIME", "Y")
    rate = unit.reservation_types[0]
    assert (rate.RSV_TP_CD, rate.charging_per_person, rate.is_extra_person_price_per_hour) == ("PKG", None, "N")


def test_very_long_page_state(spark):
    body = json.dumps({"info": {"id": 7, "desc": 'say "x" \\ ' * 200_000}, "products": []})
    df = spark.createDataFrame([(1, push('"detail":'.replace(" ", "") + body.replace(': {"id"', ':{"id"')))],
                               "page_id int, html string")
    assert [(r.detail.info.id, len(r.detail.info.desc)) for r in pages.parse_pages(df).collect()] == [(7, 2_000_000)]


def test_upsert_policies_and_idempotence(spark):
    old = observations(spark, [observation(1, [1])]).withColumn("wday", F.lit("old"))
    new = observations(spark, [observation(1, [1, 2], price=5), observation(2, [3])]).withColumn("wday", F.lit("new"))
    once = writers.upsert(old, new, OBSERVATION, writers.OBSERVATION_POLICY)
    twice = writers.upsert(once, new, OBSERVATION, writers.OBSERVATION_POLICY)
    rows = sorted((r.target_date, r.wday, r.n_booked, r.price) for r in once.collect())
    assert rows == [(day(1), "old", 2, 5), (day(2), "new", 1, 1000)]
    assert once.exceptAll(twice).count() == 0
    ids = "space_id long, gone_at string, addr string, is_gone boolean"
    was = spark.createDataFrame([(1, "d1", "a", True)], ids)
    again = spark.createDataFrame([(1, "d2", None, True)], ids)
    got = writers.upsert(was, again, ["space_id"], writers.VENUE_POLICY).collect()
    assert [(r.gone_at, r.addr, r.is_gone) for r in got] == [("d1", "a", True)]


def test_replace_partition_is_idempotent_and_clears_an_empty_day(spark, tmp_path):
    path = str(tmp_path / "t")
    obs = observations(spark, [observation(1, [1], observed=0), observation(2, [1], observed=1)])
    writers.replace_partition(obs, path, sort=OBSERVATION)
    writers.replace_partition(obs.where(F.col("observed_date") == day(0)), path)
    assert spark.read.parquet(path).count() == 2
    writers.replace_partition(obs.limit(0), path, value=day(0).isoformat())
    assert [r.observed_date for r in spark.read.parquet(path).select("observed_date").collect()] == [day(1)]


def test_stream_resumes_and_upserts(spark, tmp_path):
    folder, table, cp = (str(tmp_path / n) for n in ("in", "table", "cp"))
    lines(folder + "/a.json.gz", [slot("2026-01-02", [1]), slot("2026-01-03", [1]), "{cut"])
    run_ingest(spark, folder, table, cp)
    lines(folder + "/b.json.gz", [slot("2026-01-03", [1, 2]), slot("2026-01-04", [3], observed="2026-01-02")])
    run_ingest(spark, folder, table, cp)
    run_ingest(spark, folder, table, cp)
    rows = spark.read.schema(schemas.OBSERVATION).parquet(table).collect()
    assert sorted((str(r.observed_date), str(r.target_date), r.n_booked) for r in rows) == [
        ("2026-01-01", "2026-01-02", 1), ("2026-01-01", "2026-01-03", 2), ("2026-01-02", "2026-01-04", 1),
    ]


def test_stream_keeps_package_rows_of_mixed_files(spark, tmp_path):
    folder, table, cp = (str(tmp_path / n) for n in ("in", "table", "cp"))
    offer = {"kind": "pkg", "package_id": 9, "name": "night", "shour": 20, "ehour": 2, "available": "true"}
    lines(folder + "/a.json.gz", [slot("2026-01-02", [1]), slot("2026-01-03", [1], price=500, **offer)])
    run_ingest(spark, folder, table, cp)
    lines(folder + "/b.json.gz", [slot("2026-01-03", [1], price=700, **offer)])
    run_ingest(spark, folder, table, cp)
    assert spark.read.schema(schemas.OBSERVATION).parquet(table).count() == 1
    offers = spark.read.schema(schemas.PACKAGE).parquet(table + "-packages").collect()
    assert [(r.package_id, r.price, r.available) for r in offers] == [(9, 700, True)]


def test_batch_killed_while_it_replaces_days_is_replayed_whole(spark, tmp_path, monkeypatch):
    folder, table, cp = (str(tmp_path / n) for n in ("in", "table", "cp"))
    lines(folder + "/a.json.gz", [slot("2026-01-02", [1]), slot("2026-01-03", [1])])
    run_ingest(spark, folder, table, cp)
    lines(folder + "/b.json.gz", [slot("2026-01-03", [1, 2])])

    def killed(df, path, **_):
        shutil.rmtree(f"{path}/observed_date=2026-01-01")
        raise RuntimeError("killed")

    with monkeypatch.context() as m:
        m.setattr(landing, "replace_partition", killed)
        with pytest.raises(Exception, match="killed"):
            run_ingest(spark, folder, table, cp)
    run_ingest(spark, folder, table, cp)
    rows = spark.read.schema(schemas.OBSERVATION).parquet(table).collect()
    assert sorted((str(r.target_date), r.n_booked) for r in rows) == [("2026-01-02", 1), ("2026-01-03", 2)]


def test_failed_rebuild_leaves_the_old_day(spark, tmp_path):
    path = str(tmp_path / "t")
    day = lambda values: spark.createDataFrame([(v,) for v in values], "v int").withColumn("d", F.lit("2026-01-01"))
    stored = lambda: sorted(r.v for r in spark.read.parquet(path).collect())
    writers.replace_partition(day([1, 2]), path, "d", value="2026-01-01")
    bad = day([3]).withColumn("v", F.raise_error(F.lit("no")).cast("int"))
    with pytest.raises(Exception):
        writers.replace_partition(bad, path, "d", value="2026-01-01")
    assert stored() == [1, 2]
    # A driver that dies between the two renames leaves the day set aside.
    os.rename(f"{path}/d=2026-01-01", f"{path}/.d=2026-01-01.old")
    with pytest.raises(Exception):
        writers.replace_table(bad.drop("d"), f"{path}/d=2026-01-01")
    session.restore(spark, f"{path}/d=2026-01-01")
    assert stored() == [1, 2]
    writers.replace_partition(day([4]), path, "d", value="2026-01-01")
    assert stored() == [4]


def test_upsert_resolves_repeats_within_the_new_rows(spark):
    old = spark.createDataFrame([(1, "old")], "k long, v string")
    new = spark.createDataFrame([(2, "a", 1), (2, "b", 2), (1, "c", 3)], "k long, v string, at long")
    got = lambda policy, **o: sorted(tuple(r) for r in writers.upsert(old, new, ["k"], policy, **o).collect())
    assert got(writers.KEEP_OLD, ordinal="at") == [(1, "old"), (2, "a")]
    assert got({"v": writers.NEW}, ordinal="at") == [(1, "c"), (2, "b")]
    assert len(got(writers.KEEP_OLD)) == 2
    last = writers.dedupe_last(new, ["k"], F.col("at") * 2).collect()
    assert {(r.k, r.v) for r in last} == {(1, "c"), (2, "b")}


def test_file_that_landed_later_wins_within_a_batch(spark, tmp_path):
    folder, table, cp = (str(tmp_path / n) for n in ("in", "table", "cp"))
    for name, hours, age in (("a", [1, 2, 3], 10), ("b", [1], 500), ("c", [1, 2], 100)):
        path = lines(f"{folder}/{name}.json.gz", [slot("2026-01-03", hours)])
        os.utime(path, (1_770_000_000 - age, 1_770_000_000 - age))
    run_ingest(spark, folder, table, cp)
    assert [r.n_booked for r in spark.read.schema(schemas.OBSERVATION).parquet(table).collect()] == [3]


def test_daily_chain_and_backfill(spark, tmp_path):
    t = daily.Tables(spark, str(tmp_path))
    obs = observations(spark, [observation(n, [n % 24], observed=o) for o in (0, 1) for n in range(o + 1, 20)])
    writers.replace_partition(obs, t.path(daily.OBSERVATIONS))
    packages(spark, [package(3, 3, 4, 1)]).write.parquet(t.path(daily.PACKAGES))
    rates(spark, [(1, 1, 1, "N", 4, 5, "N")]).write.parquet(t.path(daily.RATES))
    units(spark, [(1, 1, 1, 8)]).write.parquet(t.path(daily.UNITS))
    venue = spark.createDataFrame([(1, "studio", "x")], "space_id long, category string, sigungu string")
    venue.write.parquet(t.path(daily.VENUES))
    assert daily.backfill(t) == [day(0).isoformat(), day(1).isoformat()]
    left = [(r.day, r.need_fill, r.need_revenue, r.need_settled) for r in daily.gaps(t).collect()]
    assert left == [(day(1), False, False, True)]  # counted revenue of the newest day has no rows yet
    assert t.read(daily.REVENUE).count() == 2 and t.read(daily.HEAT).count() > 0 and t.read(daily.LEAD).count() > 0
    settled = t.read(daily.SETTLED).collect()
    assert [r.as_of for r in settled] == []  # no day before the newest observation was seen in advance
    late = observations(spark, [observation(n, [5], observed=5) for n in range(6, 20)])
    writers.replace_partition(late, t.path(daily.OBSERVATIONS))
    assert daily.backfill(t) == [day(5).isoformat()]
    row = t.read(daily.SETTLED).collect()[0]
    assert (row.n_days, row.booked_h, row.as_of) == (4, 4, day(5))


