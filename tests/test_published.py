"""Publication of several partitions and tables at once: a run that ends at any step leaves readers on one state."""

import os

import pytest
from pyspark.sql.types import StructType

from roomtide import session
from roomtide.sources import published as P
from roomtide.sources.shards import Sharded

DAYS = ["2026-01-01", "2026-01-02", "2026-01-03"]
ROWS = StructType().add("k", "long").add("v", "string").add("observed_date", "date")
VENUE = StructType().add("k", "long").add("v", "string")


def rows(spark, tag, days=DAYS):
    import datetime as dt

    return spark.createDataFrame([(i, f"{tag}{d}", dt.date.fromisoformat(d)) for d in days for i in range(3)], ROWS)


def change_all(spark, store, tag, days):
    change = store.begin()
    change.put("observation", rows(spark, tag, days), "observed_date", ["k"])
    change.put("package", rows(spark, tag, days[:1]), "observed_date")
    change.put("venue", spark.createDataFrame([(1, tag)], "k long, v string"))
    change.publish()


def state(store):
    at = store.manifest()
    both = [sorted(map(tuple, store.read(t, ROWS, "observed_date", at=at).collect())) for t in ("observation", "package")]
    return (*both, [tuple(r) for r in store.read("venue", VENUE, at=at).collect()])


class Ended(Exception):
    pass


def test_a_run_that_ends_at_any_step(spark, tmp_path, monkeypatch):
    """Every step that touches files may be the last one, before it or after it."""
    store = P.Published(spark, str(tmp_path / "s"))
    change_all(spark, store, "a", DAYS)
    old = state(store)
    other = P.Published(spark, str(tmp_path / "o"))
    change_all(spark, other, "a", DAYS)
    change_all(spark, other, "b", DAYS[1:])
    new = state(other)
    assert old != new
    real = {"write_text": session.write_text, "rename_new": session.rename_new, "names_in": session.names_in}
    seen = set()
    for last in range(30):
        for after in (False, True):
            steps = {"n": 0}

            def step(name, last=last, after=after, steps=steps):
                def run(*args):
                    at = steps["n"]
                    steps["n"] += 1
                    if at == last and not after:
                        raise Ended
                    out = real[name](*args)
                    if at == last:
                        raise Ended
                    return out

                return run

            for name in real:
                monkeypatch.setattr(P, name, step(name))
            ended = False
            try:
                change_all(spark, store, "b", DAYS[1:])
            except Ended:
                ended = True
            for name, call in real.items():
                monkeypatch.setattr(P, name, call)
            got = state(store)
            assert got in (old, new)
            seen.add((ended, got == new))
            if got == new:
                store.sweep_lost()
                assert state(store) == new
                break
        else:
            continue
        break
    assert (True, False) in seen and any(n for _, n in seen)


def test_conflict_sweep_and_old_readers(spark, tmp_path):
    store = P.Published(spark, str(tmp_path))
    change_all(spark, store, "a", DAYS)
    first, second = store.begin(), store.begin()
    for c, tag in ((first, "b"), (second, "c")):
        c.put("observation", rows(spark, tag, DAYS[:1]), "observed_date")
    at = store.manifest()
    first.publish()
    with pytest.raises(P.Conflict):
        second.publish()
    # who resolved the older manifest goes on reading it
    assert {r.v[0] for r in store.read("observation", ROWS, "observed_date", at=at).collect()} == {"a"}
    assert {r.v[0] for r in store.read("observation", ROWS, "observed_date", DAYS[:1]).collect()} == {"b"}
    for tag in "def":
        change_all(spark, store, tag, DAYS)
    store.sweep()
    store.sweep_lost()
    assert len(os.listdir(tmp_path / "observation")) == 2 and {r.v[0] for r in store.read("observation", ROWS, "observed_date").collect()} == {"f"}
    gone = store.begin()
    gone.drop("observation", DAYS[:2])
    gone.put("package", rows(spark, "g", []), "observed_date", values=DAYS[:1])
    gone.publish()
    assert store.values("observation") == DAYS[2:] and store.read("package", ROWS, "observed_date").count() == 0


def test_a_stream_batch_is_published_once(spark, tmp_path, monkeypatch):
    """Days of a batch appear together; a batch that failed before its publication, or is played again after it, changes nothing twice."""
    from roomtide import schemas
    from roomtide.streaming import landing

    folder = tmp_path / "in"
    folder.mkdir()

    def slot(space, observed, target, booked):
        return (f'{{"kind": "time", "space_id": {space}, "product_id": 1, "rsv_type_id": 1, "observed": "{observed}", "d": "{target}", '
                f'"wday": "1", "hday": "N", "n_slots": 24, "booked": {booked}, "price": 1000, "hp": []}}')

    store = P.Published(spark, str(tmp_path / "tables"))
    lines = [slot(s, f"2026-01-0{d}", "2026-01-20", [s]) for s in range(4) for d in (1, 2, 3)]
    (folder / "a.jsonl").write_text("\n".join(lines))
    real, steps = P.rename_new, []
    monkeypatch.setattr(P, "rename_new", lambda *a: steps.append(store.values("observation")) or (_ for _ in ()).throw(Ended()) if not steps else real(*a))
    with pytest.raises(Exception):  # noqa: B017
        landing.publish_ingest(store, str(folder), str(tmp_path / "cp"), "observation", "package")
    assert store.values("observation") == []
    landing.publish_ingest(store, str(folder), str(tmp_path / "cp"), "observation", "package")
    number = store.manifest().number
    assert store.values("observation") == ["2026-01-01", "2026-01-02", "2026-01-03"] and number == 1
    assert store.read("observation").count() == 12
    batch = spark.read.schema(schemas.SLOT).json(str(folder)).selectExpr("*", "current_timestamp() AS landed_at", "'x' AS landed_in")
    landing.publish_batch(batch, 0, store, "observation", "package")
    assert store.manifest().number == number


def test_a_load_of_one_key_touches_one_shard(spark, tmp_path):
    store = P.Published(spark, str(tmp_path))
    schema = StructType().add("review_id", "long").add("v", "string")
    table = Sharded(store, "review", schema, ["review_id"], rows_each=100)
    change = store.begin()
    table.merge(change, spark.createDataFrame([(i, "a") for i in range(1000)], schema), "keep_old")
    change.publish()
    assert table.n_shards(store.begin()) == 10 and table.read().count() == 1000
    files = lambda: {p: r.tables["review"] for p, r in (("now", store.manifest()),)}["now"]
    before = files()
    change = store.begin()
    touched = table.merge(change, spark.createDataFrame([(5, "b"), (5_000, "n"), (5_000, "n")], schema), {"v": "new"})
    change.publish()
    after = files()
    assert {s for s in before if before[s] != after[s]} == set(touched) and 1 <= len(touched) <= 2
    assert sorted(map(tuple, table.find(spark.createDataFrame([(5,), (5_000,), (7,)], "review_id long")).collect())) == [(5, "b"), (7, "a"), (5_000, "n")]
    assert table.merge(store.begin(), spark.createDataFrame([], schema), "keep_old") == []
    change = store.begin()
    table.reshard(change, 3)
    change.publish()
    assert table.read().count() == 1001 and len(store.values("review")) == 3
