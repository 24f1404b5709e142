"""The daily chain over a folder of date-partitioned tables."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.classify import OTHER
from ..keys import OBSERVED_RATE, RATE_DAY, VENUE_DAY
from ..operators import blocking, occupancy, packages, revenue, settled, validity
from ..session import fingerprints, staging_scope
from ..sources.published import Published
from ..sources.shards import SHARD
from ..sources.writers import replace_partition
from .kept import ClosedLog, Kept
from .quality import MAX_DAYS, missing_days

OBSERVATIONS, PACKAGES, RATES, UNITS = "observation", "package", "rate_snapshot", "unit_snapshot"
VENUES = "venue"
CLASSES, FILL, HEAT, LEAD = "hour_class", "venue_fill", "heatmap", "lead_curve"
REVENUE, SETTLED = "venue_revenue", "venue_settled"
SEEN, PRICES, CLOSED_LOG = "last_seen", "latest_packages", "closed_log"


class Tables:
    """Parquet tables below one folder, partitioned by observation or counting day."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    @property
    def store(self) -> Published:
        """The tables of the folder that are published together: those that the load step and the stream write."""
        return Published(self.spark, self.root)

    def read(self, name: str) -> DataFrame:
        if self.store.holds(name):
            rows = self.store.read(name)
            return rows.drop(SHARD) if SHARD in rows.columns else rows
        return self.spark.read.parquet(self.path(name))

    def versions(self, name: str, day: str) -> dict[str, str]:
        """Days of a table, and for each the form it is in: another one after each rewrite."""
        parts = self.store.manifest().tables.get(name)
        return dict(parts) if parts is not None else fingerprints(self.spark, self.path(name), day)

    def days_of(self, name: str, day: str) -> DataFrame:
        """Distinct days of a table; an absent table has none."""
        try:
            table = self.read(name)
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], f"{day} date")
        return table.select(day).distinct()


def derive_fill(t: Tables, date: str, other: str = OTHER) -> None:
    """Hour classes, occupancy with blocking flags, heat map and lead curve of one day. Each table
    is written and read back, so later steps start from columnar files."""
    obs, venues = t.read(OBSERVATIONS), t.read(VENUES)
    replace_partition(occupancy.hour_class(obs, date), t.path(CLASSES), value=date, sort=OBSERVED_RATE)
    classes = occupancy.on_day(t.read(CLASSES), date)
    closed = occupancy.masks_of_classes(classes)
    flags = blocking.blocking_flags(obs, closed, date)
    filled = blocking.flagged_fill(occupancy.venue_fill(obs, date), flags)
    replace_partition(filled, t.path(FILL), value=date, sort=VENUE_DAY)
    fill = occupancy.on_day(t.read(FILL), date)
    heat = occupancy.heatmap(obs, closed, fill, venues, date, other)
    replace_partition(heat, t.path(HEAT), value=date)
    lead = occupancy.lead_curve(obs, closed, fill, venues, date, other)
    replace_partition(lead, t.path(LEAD), value=date)


def kept_prices(t: Tables, date: str) -> Kept:
    """Latest prices as of a day. Rows beyond `date` are of later source days, which a state does not hold."""
    return Kept(
        t, PRICES, PACKAGES,
        lambda rows: packages.latest_packages(rows, date),
        lambda kept, rows: packages.roll_latest_packages(kept, rows, date),
        RATE_DAY,
    )


def kept_seen(t: Tables) -> Kept:
    return Kept(t, SEEN, OBSERVATIONS, settled.last_seen, settled.roll_last_seen, RATE_DAY)


def closed_log(t: Tables) -> ClosedLog:
    return ClosedLog(t, CLOSED_LOG, CLASSES)


def closed_as_of(t: Tables, date: str) -> DataFrame:
    """Closed hours by the last classification of each rate type up to a day."""
    day = F.lit(date).cast("date")
    with staging_scope(t.spark):
        log = closed_log(t).as_of(date)
    return validity.latest_masks(log, day).withColumn("observed_date", day)


def latest_prices(t: Tables, date: str) -> DataFrame:
    return kept_prices(t, date).as_of(date)


def derive_revenue(t: Tables, date: str) -> None:
    closed = occupancy.masks_of_classes(occupancy.on_day(t.read(CLASSES), date))
    prices = latest_prices(t, date)
    with staging_scope(t.spark):
        result = revenue.venue_revenue(
            t.read(OBSERVATIONS), closed, t.read(RATES), t.read(UNITS), prices, date
        )
        replace_partition(result, t.path(REVENUE), value=date, sort=["space_id"])


def derive_settled(t: Tables, as_of: str) -> None:
    """Counted revenue, from the kept tables of last observations and of latest package prices and from the log of
    closed hours; of the history only days are read that these do not hold yet."""
    obs = t.read(OBSERVATIONS)
    seen = kept_seen(t).as_of(as_of)
    closed = closed_as_of(t, as_of)
    prices = latest_prices(t, as_of)
    with staging_scope(t.spark):
        result = settled.venue_settled(
            obs, closed, t.read(RATES), t.read(UNITS), prices, as_of, seen=seen
        )
        replace_partition(result, t.path(SETTLED), "as_of", value=as_of, sort=["space_id"])


def gaps(t: Tables, max_days: int = MAX_DAYS) -> DataFrame:
    return missing_days(
        t.read(OBSERVATIONS), t.days_of(FILL, "observed_date"), t.days_of(REVENUE, "observed_date"),
        t.days_of(SETTLED, "as_of"), max_days,
    )


def backfill(t: Tables, max_days: int = MAX_DAYS, other: str = OTHER) -> list[str]:
    """Derive what is missing, oldest day first, occupancy before revenue. The gap list has at
    most `max_days` rows. Counted revenue of the newest day is derived again when an older day has been filled, which it did not know."""
    done: list[str] = []
    found = gaps(t, max_days).collect()
    newest = t.days_of(OBSERVATIONS, "observed_date").agg(F.max("observed_date")).first()[0]
    late = any(g["day"] < newest for g in found)
    counted: set[str] = set()
    for gap in found:
        day = gap["day"].isoformat()
        if gap["need_fill"]:
            derive_fill(t, day, other)
        if gap["need_revenue"]:
            derive_revenue(t, day)
        if gap["need_settled"]:
            derive_settled(t, day)
            counted.add(day)
        done.append(day)
    if late and newest.isoformat() not in counted:
        derive_settled(t, newest.isoformat())
    return done
