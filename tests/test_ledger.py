"""Accounts of landed gzip files: cut, of several members, empty, plain, absent."""

import gzip
import os

import pytest

from roomtide.sources import ledger


def lines(a, b):
    return "".join(f'{{"n": {i}, "text": "some words of line {i}"}}\n' for i in range(a, b)).encode()


@pytest.fixture
def folder(tmp_path):
    whole, many = gzip.compress(lines(0, 5000)), gzip.compress(lines(0, 300)) + gzip.compress(lines(300, 900))
    for name, data in {
        "whole.json.gz": whole, "many.json.gz": many, "cut.json.gz": whole[: len(whole) // 2], "tail.json.gz": whole[:-4],
        "second.json.gz": many[:-30], "none.json.gz": gzip.compress(b""), "plain.json": lines(0, 10),
    }.items():
        (tmp_path / name).write_bytes(data)
    return tmp_path


def test_ledger(spark, folder):
    told = {"whole.json.gz": 5000, "many.json.gz": 900, "cut.json.gz": 5000, "gone.json.gz": 7, "plain.json": 10}
    manifest = spark.createDataFrame(list(told.items()), "file string, n_rows int")
    got = {r.file: r for r in ledger.landing_ledger(spark, str(folder), manifest).collect()}
    assert {f for f, r in got.items() if r.is_cut} == {"cut.json.gz", "tail.json.gz", "second.json.gz"}
    for name, rows, members in (("whole.json.gz", 5000, 1), ("many.json.gz", 900, 2), ("plain.json", 10, 0), ("none.json.gz", 0, 1)):
        r = got[name]
        assert (r.n_rows, r.n_members, r.is_cut) == (rows, members, False) and r.plain_bytes == r.read_bytes
        assert r.stored_bytes == os.path.getsize(folder / name)
    cut = got["cut.json.gz"]
    assert 0 < cut.n_rows < 5000 and cut.lost_rows == 5000 - cut.n_rows and cut.n_members == 0
    assert got["gone.json.gz"].lost_rows == 7 and got["gone.json.gz"].stored_bytes is None
    assert got["tail.json.gz"].lost_rows is None and got["second.json.gz"].n_members == 1
    assert {r.file for r in ledger.shortened(ledger.landing_ledger(spark, str(folder), manifest)).collect()} == {"cut.json.gz", "tail.json.gz", "second.json.gz", "gone.json.gz"}


def test_allowed_share(spark, folder):
    report = ledger.landing_ledger(spark, str(folder))
    with pytest.raises(ledger.TooMuchLost, match="3 of 7 files are shortened: cut.json.gz"):
        ledger.require_whole(report, 0.2)
    assert ledger.require_whole(report, 0.5) is report


def test_blocks_of_a_large_file(monkeypatch):
    monkeypatch.setattr(ledger, "BLOCK", 7)
    data = gzip.compress(lines(0, 50)) + gzip.compress(lines(50, 80))
    assert ledger.inspect(data) == (2, len(lines(0, 80)), False)
    assert ledger.inspect(data[:-1])[2] and ledger.inspect(b"")[2] and ledger.inspect(b"no gzip")[2]
