"""Time the headline queries and print one JSON line.

Environment: BENCH_SF_DIR (tables), BENCH_CPUS (threads). The panel's base tables are derived from
the given tables and written once before the clock of the queries starts; that time is reported
as `panel_setup`. Every query then runs in full and writes its rows to Spark's no-op sink.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from roomtide.fixtures import DAY, OTHER, panel  # noqa: E402
from roomtide.plans import daily  # noqa: E402
from roomtide.queries.registry import spark_queries  # noqa: E402
from roomtide.session import build_session, shared_dir  # noqa: E402
from roomtide.sources.writers import replace_partition  # noqa: E402

HEADLINE = [
    "hour_class", "venue_fill", "blocking_flags", "heatmap", "lead_curve", "price_baseline",
    "venue_revenue", "venue_settled", "booking_market", "market_revenue", "market_by_dong",
    "demand_trend", "blocking_audit", "observation_days", "target_coverage",
]


def daily_tables(spark, p) -> daily.Tables:
    """The panel's base tables in a folder, as a day's landing leaves them."""
    t = daily.Tables(spark, f"{shared_dir(spark)}/bench-tables")
    replace_partition(p.observations, t.path(daily.OBSERVATIONS))
    replace_partition(p.packages, t.path(daily.PACKAGES))
    for name, table in ((daily.RATES, p.rates), (daily.UNITS, p.units), (daily.VENUES, p.venues)):
        table.write.parquet(t.path(name))
    return t


def daily_chain(t: daily.Tables) -> None:
    """Occupancy, revenue and counted revenue of one day, from the stored tables to the stored results."""
    daily.derive_fill(t, DAY, OTHER)
    daily.derive_revenue(t, DAY)
    daily.derive_settled(t, DAY)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench", f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": "16g",
            "spark.ui.enabled": "false",
            # Small files: cut scans finer than a cluster would, so that all threads have work.
            "spark.sql.files.openCostInBytes": "262144",
            "spark.sql.adaptive.coalescePartitions.minPartitionSize": "64k",
            "spark.python.sql.dataFrameDebugging.enabled": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    p = panel(spark, sf_dir)
    start = time.time()
    for table in (p.observations, p.packages, p.venues, p.snapshots, p.units, p.rates):
        table.schema  # noqa: B018  the property writes the table
    setup = time.time() - start
    start = time.time()
    _ = p.closed, p.fill, p.revenue
    derive = time.time() - start
    queries, times = spark_queries(), {}
    for name in HEADLINE:
        start = time.time()
        queries[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.time() - start, 3)
    tables = daily_tables(spark, p)
    start = time.time()
    daily_chain(tables)
    times["daily_chain"] = round(time.time() - start, 3)
    print(json.dumps({
        "metric": "headline_queries_total", "value": round(sum(times.values()), 3), "unit": "sec",
        "queries": times, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
        "panel_setup": round(setup, 3), "derived_setup": round(derive, 3),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
