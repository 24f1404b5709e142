"""The registered queries against DuckDB at the smallest scale, and the driver contract."""

import os

import pytest

import __spark_entry__ as driver
from tools.compare import compare, duck

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables are absent")

CHECKED = [
    "hour_class", "venue_fill", "flagged_fill", "heatmap", "lead_curve", "booking_blocks", "package_windows",
    "overnight_hits", "package_cuts", "package_cuts_any_observation", "venue_revenue", "venue_settled", "market_by_dong", "booking_market", "blocking_audit",
    "load_observations", "load_venues", "embedded_detail", "upsert_observations", "streamed_observations", "streamed_packages", "loaded_tags",
    "loaded_venues", "drop_past_count", "same_rows",
]


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", CHECKED)
def test_query_equals_duckdb(spark, con, name):
    assert compare(spark, con, SF, name).startswith("ok")


def test_every_query_has_a_statement():
    missing = driver.queries().keys() - driver.oracle_sql().keys()
    assert all(name == "pipeline" or name.startswith("op") for name in missing)


def test_entry(spark):
    assert driver.entry(spark).count() == 40
