"""The load step: landed pages, listings and slot files into the stored tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import schemas
from ..functions.classify import OTHER, RULES
from ..operators.ingest import load_reviews, load_venues
from ..session import stage, staging_scope
from ..sources import readers
from ..sources.published import Change
from ..sources.shards import Sharded
from ..sources.writers import HOURS_POLICY, KEEP_OLD, RUN_POLICY, VENUE_POLICY, dedupe_last, run_summary
from ..streaming.landing import publish_ingest
from .daily import OBSERVATIONS, PACKAGES, RATES, UNITS, VENUES, Tables

SNAPSHOTS, TAGS, REVIEWS = "venue_snapshot", "venue_tag", "review"
HOURS, RUNS = "venue_hours", "run"


def merge_table(
    t: Tables, change: Change, name: str, new: DataFrame, keys: list[str], policy: dict[str, str] | str, route: list[str] | None = None
) -> list[str]:
    """Upsert into a table without a date, as part of a change: the shards that hold keys of `new` are written anew, the
    others are not read. Returns them. The keys of `new` may repeat; without an order among them any one record counts."""
    return Sharded(t.store, name, new.schema, keys, route).merge(change, new, policy)


def load_pages(
    t: Tables, pages: DataFrame, vintage: DataFrame, date: str, rules=RULES, default: str = OTHER
) -> None:
    """Venues, their daily figures, units, rate types and tags of one day's pages.

    The landed files are parsed once, into a columnar copy that all five tables read; a gzip file
    is one task only for that step. Of a page that landed more than once the last copy counts.
    All tables change at once; loading a day again changes nothing.
    """
    with staging_scope(t.spark):
        once = stage(dedupe_last(readers.with_file_order(pages), ["id"], F.col("ordinal")), "pages")
        rows = load_venues(once, vintage, date, rules, default)
        change = t.store.begin()
        merge_table(t, change, VENUES, rows.venues, ["space_id"], VENUE_POLICY)
        merge_table(t, change, TAGS, rows.tags, ["space_id", "tag"], KEEP_OLD, ["space_id"])
        for name, daily, keys in (
            (SNAPSHOTS, rows.snapshots, ["space_id"]),
            (UNITS, rows.units, ["space_id", "product_id"]),
            (RATES, rows.rates, ["space_id", "product_id", "rsv_type_id"]),
        ):
            change.put(name, daily, "snapshot_date", keys, [date])
        change.publish()


def load_listing(t: Tables, reviews: DataFrame, date: str) -> None:
    """Reviews by id; the first day a review was seen stays."""
    change = t.store.begin()
    if merge_table(t, change, REVIEWS, load_reviews(reviews, date), ["review_id"], KEEP_OLD):
        change.publish()


def load_hours(t: Tables, meta: DataFrame, date: str) -> None:
    change = t.store.begin()
    merge_table(t, change, HOURS, readers.venue_hours(meta, date), ["space_id"], HOURS_POLICY)
    change.publish()


def load_run(t: Tables, date: str, listing: DataFrame, pages: DataFrame, reviews: DataFrame) -> None:
    change = t.store.begin()
    merge_table(t, change, RUNS, run_summary(date, listing, pages, reviews), ["run_date"], RUN_POLICY)
    change.publish()


def load_slots(t: Tables, folder: str, checkpoint: str) -> None:
    """Observation and package rows of all slot files that landed since the last call; the days and both tables
    of a batch become visible together."""
    publish_ingest(t.store, folder, checkpoint, OBSERVATIONS, PACKAGES)


def skipped_past(slots: DataFrame) -> DataFrame:
    """How many landed records of each kind lie before their day of observation."""
    kind = F.when(F.col("kind") == "pkg", F.lit("package")).otherwise(F.lit("time")).alias("kind")
    past = F.col("d").cast("date") < F.col("observed").cast("date")
    return slots.groupBy(kind).agg(F.count_if(past).alias("n_skipped"))
