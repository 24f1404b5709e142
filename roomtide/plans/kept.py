"""Tables that are kept from day to day, with a ledger of the source days they hold.

A kept state is the newest row per key over all source days up to one day. The ledger names these days and the
files each of them had, so a day that lands late, or lands again in another form, is seen: a late day is merged into
the newest state that holds nothing but days as they are now, by the same maximum that merged all others; a day
whose files have changed makes the states that hold its old form unusable, and the newest one from before it (or none) is
taken instead. The result is that of reading the whole history in whatever order days have landed, while each
call reads only the days its state lacks.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import validity
from ..session import exists, fingerprint, fingerprints, remove
from ..sources.writers import replace_partition

KEPT, SOURCE_DAY = "kept_on", "observed_date"
LEDGER = "day string, version string, state string"
#: So many newest states stay; older ones are removed when a new one is written.
KEEP = 3


def folder(table: str, column: str, day: str) -> str:
    return f"{table.rstrip('/')}/{column}={day}"


@dataclass(frozen=True)
class Kept:
    """A state table at `path` over the days of a source table."""

    tables: object
    name: str
    source: str
    first: Callable[[DataFrame], DataFrame]
    merge: Callable[[DataFrame, DataFrame], DataFrame]
    sort: list[str]

    @property
    def path(self) -> str:
        return self.tables.path(self.name)

    @property
    def ledger_path(self) -> str:
        return f"{self.path}_ledger"

    def _ledgers(self) -> dict[str, dict[str, str]]:
        """Per kept state the days it holds, where state and ledger belong together."""
        spark = self.tables.spark
        if not exists(spark, self.ledger_path):
            return {}
        rows = spark.read.schema(f"{LEDGER}, {KEPT} string").parquet(self.ledger_path).collect()  # days of at most KEEP states
        states = fingerprints(spark, self.path, KEPT)
        found: dict[str, dict[str, str]] = {}
        for r in rows:
            if states.get(r[KEPT]) == r.state:
                found.setdefault(r[KEPT], {})[r.day] = r.version
        return found

    def _source_days(self) -> dict[str, str]:
        """Days of the source and the form they are in; without partitions all days have the form of the whole table."""
        days = self.tables.versions(self.source, SOURCE_DAY)
        if not days:
            whole = fingerprint(self.tables.spark, self.tables.path(self.source))
            days = {r[0].isoformat(): whole for r in self.tables.days_of(self.source, SOURCE_DAY).collect()}
        return days

    def state(self, day: str) -> DataFrame:
        return self.tables.spark.read.parquet(folder(self.path, KEPT, day))

    def as_of(self, date: str) -> DataFrame:
        """The state over all source days up to `date` as they are now; brought up to date and kept."""
        spark = self.tables.spark
        now = {d: v for d, v in self._source_days().items() if d <= date}
        usable = {k: days for k, days in self._ledgers().items() if days.items() <= now.items()}
        best = max(usable, key=lambda k: (len(usable[k]), k), default=None)
        held = usable.get(best, {})
        lacking = sorted(now.keys() - held.keys())
        if best == date and not lacking:
            return self.state(date)
        rows = self.tables.read(self.source).where(F.col(SOURCE_DAY).isin([F.lit(d).cast("date") for d in lacking]))
        fresh = self.first(rows) if best is None else self.merge(self.state(best), rows) if lacking else self.state(best)
        remove(spark, folder(self.ledger_path, KEPT, date))
        replace_partition(fresh, self.path, KEPT, value=date, sort=self.sort)
        self._note(date, now)
        self._sweep(date)
        return self.state(date)

    def _note(self, date: str, days: dict[str, str]) -> None:
        state = fingerprints(self.tables.spark, self.path, KEPT).get(date)
        rows = [(d, v, state) for d, v in sorted(days.items())]
        replace_partition(self.tables.spark.createDataFrame(rows, LEDGER).coalesce(1), self.ledger_path, KEPT, value=date)

    def _sweep(self, date: str) -> None:
        spark = self.tables.spark
        old = sorted(d for d in fingerprints(spark, self.path, KEPT) if d != date)[: -KEEP + 1 or None]
        for day in old:
            remove(spark, folder(self.ledger_path, KEPT, day))
            remove(spark, folder(self.path, KEPT, day))


@dataclass(frozen=True)
class ClosedLog:
    """Closed hours as a log of changes: one row per rate type and day on which its mask is another than before.

    Days are folded one by one, in any order. A day that lands between days already folded, or in another form,
    changes the rows of later days for the rate types whose mask it changes, and for these alone.
    """

    tables: object
    name: str
    classes: str

    @property
    def path(self) -> str:
        return self.tables.path(self.name)

    @property
    def ledger_path(self) -> str:
        return f"{self.path}_ledger"

    def _folded(self) -> dict[str, str]:
        spark = self.tables.spark
        if not exists(spark, self.ledger_path):
            return {}
        return {r.day: r.version for r in spark.read.parquet(self.ledger_path).select("day", "version").collect()}  # one row a day

    def read(self) -> DataFrame:
        spark = self.tables.spark
        if not exists(spark, self.path):
            return spark.createDataFrame([], validity.LOG)
        return spark.read.schema(validity.LOG).parquet(self.path)

    def _masks(self, days: list[str]) -> DataFrame:
        """Masks of these days alone; the filter is on the partition column."""
        rows = self.tables.read(self.classes)
        return validity.masks(rows.where(F.col(SOURCE_DAY).isin([F.lit(d).cast("date") for d in days])))

    def as_of(self, date: str) -> DataFrame:
        """The log up to `date`, after folding what the classes hold and the log does not."""
        spark = self.tables.spark
        now = self.tables.versions(self.classes, SOURCE_DAY)
        folded = self._folded()
        for day in sorted(d for d, v in now.items() if d <= date and folded.get(d) != v):
            self._fold(day, sorted(d for d in folded if d > day and d in now))
            folded[day] = now[day]
            replace_partition(spark.createDataFrame([(day, now[day])], "day string, version string").coalesce(1), self.ledger_path, "folded", value=day)
        return self.read().where(F.col("valid_from") <= F.lit(date).cast("date"))

    def _fold(self, day: str, later: list[str]) -> None:
        at = F.lit(day).cast("date")
        log = self.read()
        today = self._masks([day])
        before = validity.last_before(log, at)
        changed = validity.changes(today, before)
        if later:
            # rate types whose mask as of this day is another now
            affected = validity.affected(log, today, before, at)
            rows = validity.refold(self._masks(later), today, before, affected)
            kept = log.where(F.col("valid_from") > at).join(affected, validity.KEYS, "left_anti")
            after = validity.stored(kept.unionByName(rows))
            for d in later:
                replace_partition(after.where(F.col("valid_from") == F.lit(d).cast("date")), self.path, "valid_from", value=d)
        replace_partition(changed, self.path, "valid_from", value=day)
