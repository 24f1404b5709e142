"""Registered queries of the ingestion side: readers, page parsing, loaders, write semantics."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .. import landed, schemas
from ..fixtures import AS_OF, DAY, OTHER, Panel
from ..functions import hours as H
from ..functions.classify import classify as classify_text
from ..functions.scalars import month_floor
from ..functions.stats import value_share
from ..keys import OBSERVED_RATE, RATE, RATE_DAY, UNIT
from ..operators import ingest, occupancy, pricing, relational, vintage
from ..plans import load, quality, reports
from ..plans.daily import Tables
from ..session import shared_dir
from ..sources import calendar, ledger, pages, readers, writers
from ..sources.published import Published
from ..sources.shards import Sharded
from ..streaming.landing import publish_ingest, run_ingest
from .registry import query

# English rules for the driver's documents; the oracle repeats them.
DOCUMENT_RULES = [
    ("license", ["[Ll]icense", "[Cc]opyright"]),
    ("contact", ["@", r"[0-9]{3}-[0-9]{4}"]),
    ("english", [" the ", " and "]),
    ("german", [" der ", " und "]),
]


def _total(c: str) -> Column:
    return F.aggregate(c, F.lit(0).cast("long"), lambda a, v: a + F.coalesce(v, F.lit(0)))


def _digest(obs: DataFrame) -> DataFrame:
    """Observation rows with their arrays as text and sum."""
    return obs.select(
        *RATE, "observed_date", "target_date", "wday", "is_holiday", "n_slots", "n_booked", "price",
        F.array_join("booked_hours", ",").alias("booked"), _total("hour_prices").alias("price_sum"),
    )


# --- sources ------------------------------------------------------------------------------

@query
def load_observations(p: Panel) -> DataFrame:
    """Landed slot lines (gzip) -> time rows -> observation rows."""
    path = landed.land(landed.slots(p.observations, p.packages), "slots", "json")
    time, _ = readers.read_slots(p.spark, path)
    return _digest(ingest.load_observations(time)[0])


@query
def load_packages(p: Panel) -> DataFrame:
    path = landed.land(landed.slots(p.observations, p.packages), "slots", "json")
    _, package = readers.read_slots(p.spark, path)
    rows, _ = ingest.load_packages(package)
    return rows.select(
        *RATE, "package_id", "observed_date", "target_date", "name", "shour", "ehour", "price", "available"
    )


@query
def dedupe_last(p: Panel) -> DataFrame:
    """Repeated landing of the same keys: the last record counts, past targets are dropped."""
    rows = landed.slot_versions(p)
    return _digest(ingest.load_observations(rows.where("kind IS NULL").drop("kind"))[0])


@query
def dedupe_last_packages(p: Panel) -> DataFrame:
    rows = ingest.load_packages(landed.slot_versions(p).where("kind = 'pkg'"))[0]
    return rows.select(*RATE, "package_id", "observed_date", "target_date", "shour", "ehour", "price")


@query
def drop_past_count(p: Panel) -> DataFrame:
    """Rows of both kinds whose target lies before the day of observation, counted."""
    shifted = landed.slots(p.observations, p.packages).withColumn("observed", F.lit(AS_OF))
    return occupancy.drop_past(shifted, "d", "observed")[1]


@query
def flatten_calendar(p: Panel) -> DataFrame:
    """Calendar responses -> slot rows -> observation rows; the day price is the first slot's."""
    rows = calendar.flatten_calendar(landed.calendar_responses(p.observations))
    return _digest(ingest.load_observations(rows, F.col("observed"))[0])


@query
def flatten_packages(p: Panel) -> DataFrame:
    rows = calendar.flatten_packages(landed.package_responses(p.packages))
    return ingest.load_packages(rows, F.col("observed"))[0].select(
        *RATE, "package_id", "observed_date", "target_date", "name", "shour", "ehour", "price", "available"
    )


@query
def price_variance(p: Panel) -> DataFrame:
    return calendar.price_variance(landed.calendar_responses(p.observations)).select(
        *RATE, "n_hour_prices", "n_day_patterns", "variance"
    )


@query
def sitemap_venues(p: Panel) -> DataFrame:
    return readers.read_sitemap_venues(p.spark, landed.land(landed.sitemap_urls(p), "sitemap", "xml"))


@query
def sitemap_reviews(p: Panel) -> DataFrame:
    return readers.read_sitemap_reviews(p.spark, landed.land(landed.sitemap_urls(p), "sitemap", "xml"))


@query
def listing_jsonl(p: Panel) -> DataFrame:
    """Listing landed as JSON lines in id order and read back."""
    path = f"{shared_dir(p.spark)}/listing-{uuid.uuid4().hex}"
    writers.sorted_write(p.listing, path, ["space_id"])
    return readers.read_listing_venues(p.spark, path)


@query
def venue_meta(p: Panel) -> DataFrame:
    path = landed.land(landed.meta_lines(p), "meta", "text")
    rows = readers.read_venue_meta(p.spark, path, whole_files=False)
    hours = readers.venue_hours(rows, DAY)
    return rows.select("space_id", "name", "sigungu", "category").join(
        hours.select("space_id", "break_days", "break_times"), "space_id"
    )


@query
def latest_partition(p: Panel) -> DataFrame:
    """Rows per venue in the newest observation partition."""
    newest = readers.latest_partition(p.observations, "observed_date")
    return newest.groupBy("space_id", "observed_date").agg(F.count(F.lit(1)).alias("n"))


@query
def embedded_detail(p: Panel) -> DataFrame:
    """Page state out of HTML, with the lower-case field names normalised."""
    parsed = pages.parse_pages(landed.page_state_pages(p))
    unit = F.get("detail.products", F.lit(0))["info"]
    return parsed.select(
        "page_id", F.col("detail.info.id").alias("id"), F.col("detail.info.name").alias("name"),
        F.col("detail.info.SPC_TP_CD").alias("kind"), unit["id"].alias("unit_id"),
        unit["RSV_TP_CD"].alias("unit_kind"), unit["charging_per_person"].alias("per_person"),
    )


@query
def ld_json_block(p: Panel) -> DataFrame:
    block = pages.extract_ld_json("html")
    return landed.page_state_pages(p).select(
        "page_id", F.get_json_object(block, "$.name").alias("name")
    )


@query
def classify_documents(p: Panel) -> DataFrame:
    """Ordered keyword rules over whole documents: the source counts first, the text second."""
    docs = p.raw("documents")
    return docs.select(
        "doc_id", classify_text("source", "text", DOCUMENT_RULES, OTHER).alias("category")
    )


# --- venues -------------------------------------------------------------------------------

def _snapshots(p: Panel) -> DataFrame:
    return readers.read_snapshots(p.spark, landed.land(landed.venue_pages(p), "pages", "json"))


def _rows(p: Panel) -> ingest.VenueRows:
    return ingest.load_venues(_snapshots(p), vintage.venue_vintage(p.listing), AS_OF)


@query
def venue_vintage(p: Panel) -> DataFrame:
    return vintage.venue_vintage(p.listing)


@query
def vintage_by_bucket(p: Panel) -> DataFrame:
    return vintage.vintage_by_bucket(vintage.venue_vintage(p.listing), 1000)


@query
def load_venues(p: Panel) -> DataFrame:
    return _rows(p).venues.select(
        "space_id", "vintage_month", "name", "host_id", "sido", "sigungu", "eupmyeondong", "sido_code",
        "sigungu_code", "dong_code", "spc_tp_cd", "category", "is_gone", "gone_at", "lat", "lng",
    )


@query
def load_venue_snapshots(p: Panel) -> DataFrame:
    return _rows(p).snapshots.select(
        "space_id", "http_status", "review_total", "zzim_cnt", "min_price", "median_price", "max_price",
        "n_products", "total_pyeong", "max_capacity", "break_days",
        F.unix_seconds("latest_review_at").alias("latest_review_s"),
    )


@query
def load_units(p: Panel) -> DataFrame:
    return _rows(p).units.select(
        *UNIT, "name", "price", "rsv_tp_cd", "charging_per_person", "max_guest_capacity",
        "min_guest_policy", "area_pyeong", "area_sqm",
    )


@query
def load_rates(p: Panel) -> DataFrame:
    return _rows(p).rates.select(
        *RATE, "rsv_tp_cd", "price", "charging_per_person", "person_ceiling", "extra_per_hour"
    )


@query
def load_tags(p: Panel) -> DataFrame:
    return _rows(p).tags


@query
def load_reviews(p: Panel) -> DataFrame:
    """Reviews per venue and month as loaded from the sitemap."""
    path = landed.land(landed.sitemap_urls(p), "sitemap", "xml")
    loaded = ingest.load_reviews(readers.read_sitemap_reviews(p.spark, path), AS_OF)
    return loaded.groupBy("space_id", month_floor("review_date").alias("month")).agg(
        F.count(F.lit(1)).alias("n")
    )


@query
def collection_targets(p: Panel) -> DataFrame:
    return ingest.collection_targets(_snapshots(p), "2026-12-05", code="11")


@query
def pending_targets(p: Panel) -> DataFrame:
    """Targets without those in the done list (the province's other half is done)."""
    snaps = _snapshots(p)
    done = ingest.collection_targets(snaps, "2026-12-05", districts=["고양시 일산동구"], months=1)
    return ingest.collection_targets(snaps, "2026-12-05", ["고양시 일산동구", "강남구"], done=done)


@query
def run_summary(p: Panel) -> DataFrame:
    return writers.run_summary(AS_OF, p.listing, _snapshots(p), p.reviews)


# The categories whose supply is compared.
SUPPLY = {"촬영스튜디오": "studio", "연습실": "practice", "파티룸": "party", "회의실": "meeting", "공유주방": "kitchen"}


@query
def supply_crosstab(p: Panel) -> DataFrame:
    rows = reports.supply_rows(_snapshots(p))
    return reports.supply_crosstab(rows, list(SUPPLY)).withColumnsRenamed(SUPPLY)


@query
def supply_medians(p: Panel) -> DataFrame:
    return reports.supply_medians(reports.supply_rows(_snapshots(p)), list(SUPPLY))


@query
def category_share(p: Panel) -> DataFrame:
    return reports.category_share(reports.supply_rows(_snapshots(p)))


@query
def region_share(p: Panel) -> DataFrame:
    return reports.region_share(reports.supply_rows(_snapshots(p)))


@query
def snapshot_medians(p: Panel) -> DataFrame:
    rows = reports.supply_rows(_snapshots(p))
    return reports.snapshot_medians(rows, vintage.venue_vintage(p.listing), AS_OF)


@query
def event_share(p: Panel) -> DataFrame:
    return value_share(p.raw("events"), "event_type")


# --- write semantics ----------------------------------------------------------------------

def _two_days(p: Panel) -> tuple[DataFrame, DataFrame]:
    """The last two observation days under the same keys (rate type and target date)."""
    on = lambda d: p.observations.where(F.col("observed_date") == F.lit(d).cast("date"))
    mark = F.concat(F.col("wday"), F.lit("!"))
    return on(DAY), on(AS_OF).withColumn("wday", mark)


def _state(df: DataFrame) -> DataFrame:
    return df.select(*RATE_DAY, "wday", "n_booked", "price", "observed_date")


@query
def upsert_observations(p: Panel) -> DataFrame:
    """Listed columns are overwritten; weekday and observation day keep their first value."""
    old, new = _two_days(p)
    return _state(writers.upsert(old, new, RATE_DAY, writers.OBSERVATION_POLICY))


@query
def insert_ignore(p: Panel) -> DataFrame:
    old, new = _two_days(p)
    return _state(writers.upsert(old, new, RATE_DAY, writers.KEEP_OLD))


@query
def upsert_mixed(p: Panel) -> DataFrame:
    """New, new-else-old, old-else-new and untouched columns: suppliers updated by customers."""
    def shape(df: DataFrame, prefix: str) -> DataFrame:
        bad = F.col(f"{prefix}_acctbal") < 0
        name = F.col(f"{prefix}_name")
        return df.select(
            F.col(f"{prefix}_{'supp' if prefix == 's' else 'cust'}key").alias("space_id"),
            name.alias("name"), F.when(~bad, name).alias("addr"),
            F.when(bad, name).alias("gone_at"), name.alias("spc_tp_cd"),
        )

    old, new = shape(p.raw("supplier"), "s"), shape(p.raw("customer"), "c")
    return writers.upsert(old, new, ["space_id"], writers.VENUE_POLICY)


@query
def upsert_partial(p: Panel) -> DataFrame:
    """Back-fill of one column; the rest of a matched row stays."""
    on = lambda d: p.units.where(F.col("snapshot_date") == F.lit(d).cast("date"))
    old = on(DAY).withColumn("min_guest_policy", F.lit(None).cast("int"))
    new = on(AS_OF).withColumn("max_guest_capacity", F.lit(99))
    merged = writers.upsert(old, new, UNIT, writers.UNIT_POLICY)
    return merged.select(*UNIT, "min_guest_policy", "max_guest_capacity")


@query
def replaced_partitions(p: Panel) -> DataFrame:
    """A derived table after one day was derived twice: days and rows as if once."""
    path = f"{shared_dir(p.spark)}/replaced-{uuid.uuid4().hex}"
    fill = p.fill.select("space_id", "observed_date", "booked_hours")
    writers.replace_partition(fill, path)
    day = fill.where(F.col("observed_date") == F.lit(DAY).cast("date"))
    writers.replace_partition(day, path)
    writers.replace_partition(day, path, value=DAY)
    table = p.spark.read.parquet(path)
    return table.groupBy("observed_date").agg(
        F.count(F.lit(1)).alias("n"), F.sum("booked_hours").alias("booked_hours")
    )


@query
def landed_files(p: Panel) -> DataFrame:
    """What the ledger of a landing folder says of whole files: all rows read, nothing cut."""
    files = ledger.landing_ledger(p.spark, landed.land(landed.slots(p.observations, p.packages), "slots", "json"))
    return files.agg(
        F.sum("n_rows").alias("n_rows"), F.count_if("is_cut").alias("n_cut"),
        F.bool_and(F.col("plain_bytes") == F.col("read_bytes")).alias("all_read"),
    )


@query
def streamed_observations(p: Panel) -> DataFrame:
    """Slot files ingested by a restartable stream, in several batches, upserted by key."""
    path = landed.land(landed.slots(p.observations, p.packages), "slots", "json")
    root = f"{shared_dir(p.spark)}/stream-{uuid.uuid4().hex}"
    run_ingest(p.spark, path, f"{root}/table", f"{root}/checkpoint", files_per_batch=8)
    table = p.spark.read.schema(schemas.OBSERVATION).parquet(f"{root}/table")
    return _digest(table)


@query
def streamed_packages(p: Panel) -> DataFrame:
    """The package rows of the same mixed files."""
    path = landed.land(landed.slots(p.observations, p.packages), "slots", "json")
    root = f"{shared_dir(p.spark)}/stream-{uuid.uuid4().hex}"
    run_ingest(p.spark, path, f"{root}/table", f"{root}/checkpoint", files_per_batch=8, package_path=f"{root}/offers")
    table = p.spark.read.schema(schemas.PACKAGE).parquet(f"{root}/offers")
    return table.select(
        *RATE, "package_id", "observed_date", "target_date", "name", "shour", "ehour", "price", "available"
    )


@query
def published_observations(p: Panel) -> DataFrame:
    """The same files ingested into published tables, where the days of a batch become visible together."""
    return _digest(_published(p).read("observation"))


@query
def published_packages(p: Panel) -> DataFrame:
    return _published(p).read("package").select(
        *RATE, "package_id", "observed_date", "target_date", "name", "shour", "ehour", "price", "available"
    )


def _published(p: Panel) -> Published:
    path = landed.land(landed.slots(p.observations, p.packages), "slots", "json")
    root = f"{shared_dir(p.spark)}/published-{uuid.uuid4().hex}"
    store = Published(p.spark, f"{root}/tables")
    publish_ingest(store, path, f"{root}/checkpoint", "observation", "package", files_per_batch=8)
    return store


@query
def loaded_reviews(p: Panel) -> DataFrame:
    """Reviews loaded in two overlapping parts into shards; of each the first day it was seen stays."""
    t = Tables(p.spark, f"{shared_dir(p.spark)}/reviews-{uuid.uuid4().hex}")
    schema = StructType().add("review_id", "long").add("space_id", "long").add("first_seen", "date")
    table = Sharded(t.store, load.REVIEWS, schema, ["review_id"], rows_each=20_000)
    for day, parts in ((DAY, (0, 1)), (AS_OF, (1, 2))):
        rows = p.reviews.where((F.col("review_id") % 3).isin(*parts)).select("review_id", "space_id", F.lit(day).cast("date").alias("first_seen"))
        change = t.store.begin()
        table.merge(change, rows, "keep_old")
        change.publish()
    return table.read().select("review_id", "first_seen")  # of rows with equal ids any one is stored


@query
def loaded_tags(p: Panel) -> DataFrame:
    """Tags stored by the load plan from pages that landed twice, loaded on two days."""
    return _loaded(p).read(load.TAGS).select("space_id", "tag", "rank")


@query
def loaded_venues(p: Panel) -> DataFrame:
    """The venue table after the same two loads: first and last day seen, and the day it was gone."""
    return _loaded(p).read(load.VENUES).select(
        "space_id", "first_seen", "last_seen", "is_gone", "gone_at", "category"
    )


def _loaded(p: Panel) -> Tables:
    tables = Tables(p.spark, f"{shared_dir(p.spark)}/loaded-{uuid.uuid4().hex}")
    rows = landed.venue_pages(p)
    pages = readers.read_snapshots(p.spark, landed.land(rows.unionByName(rows), "pages", "json"), readers.SKIP)
    for day in (DAY, AS_OF):
        load.load_pages(tables, pages, vintage.venue_vintage(p.listing), day)
    return tables


# --- generic operators --------------------------------------------------------------------

@query
def islands(p: Panel) -> DataFrame:
    """Runs of sold hours by row numbers on the hour rows, the other way to find blocks."""
    sold = pricing.sold_only(pricing.price_hours(p.day_pricing.priced))
    runs = relational.islands(sold, RATE_DAY, "hour")
    return runs.groupBy(*RATE_DAY, "blk").agg(F.min("hour").alias("h0"), F.max("hour").alias("h1"))


def _expanded_classes(p: Panel) -> DataFrame:
    """Hour classes by 24-fold expansion of the days: the slow formulation."""
    hours = H.explode_hours(occupancy.future_only(p.observations))
    booked = F.count_if(H.is_booked("booked_hours", "hour"))
    n = F.count(F.lit(1))
    return hours.groupBy(*OBSERVED_RATE, "hour").agg(
        n.cast("int").alias("n_days"), booked.cast("int").alias("n_blocked"),
        ((n >= occupancy.MIN_DAYS) & (booked == n)).alias("is_closed"),
    )


@query
def same_rows(p: Panel) -> DataFrame:
    """Mask-based and expanded hour classes hold the same rows."""
    return quality.same_rows(p.classes, _expanded_classes(p))


@query
def open_hours_expanded(p: Panel) -> DataFrame:
    """Open and booked hours per venue by joining every hour with its class."""
    hours = H.explode_hours(occupancy.with_day_classes(occupancy.future_only(p.observations), p.classes))
    opened = occupancy.open_only(occupancy.with_hour_class(hours, p.classes))
    return opened.groupBy("space_id", "observed_date").agg(
        F.count(F.lit(1)).alias("open_h"), F.count_if(H.is_booked("booked_hours", "hour")).alias("booked_h")
    )


@query
def stride_sample(p: Panel) -> DataFrame:
    return relational.stride_sample(p.raw("orders").select("o_orderkey", "o_custkey"), ["o_orderkey"])


@query
def missing_days(p: Panel) -> DataFrame:
    return quality.missing_days(p.observations, p.fill, p.revenue, p.settled)


@query
def daily_expectations(p: Panel) -> DataFrame:
    measures = writers.union_all(
        quality.daily_counts(p.observations, "observed_date", "observation", rows=True, units=True),
        quality.daily_counts(p.fill, "observed_date", "fill"),
        quality.daily_counts(p.revenue, "observed_date", "revenue"),
        quality.daily_counts(p.settled, "as_of", "settled"),
        quality.attempt_shares(p.attempts),
    )
    return quality.daily_expectations(measures)


