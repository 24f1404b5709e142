"""Readers of landed files. Every reader takes an explicit schema and stays lazy."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .. import schemas

FAIL, SKIP = "FAILFAST", "DROPMALFORMED"
_IGNORE_CORRUPT = "spark.sql.files.ignoreCorruptFiles"

# The two address shapes of a listing entry.
VENUE_URL = r"^https?://[^/]+/space/(\d+)$"
REVIEW_URL = r"^https?://[^/]+/space/(\d+)/review/(\d+)$"


@contextmanager
def truncated_files_allowed(spark: SparkSession) -> Iterator[None]:
    """Inside this block a gzip file that ends early yields the rows before the cut.

    The setting belongs to the session and is read when a scan runs, so actions on the frame must
    run inside the block, too.
    """
    before = spark.conf.get(_IGNORE_CORRUPT)
    spark.conf.set(_IGNORE_CORRUPT, "true")
    try:
        yield
    finally:
        spark.conf.set(_IGNORE_CORRUPT, before)


def read_jsonl(
    spark: SparkSession, path: str, schema: StructType, mode: str = FAIL,
    tolerate_truncated: bool = False,
) -> DataFrame:
    """One JSON object per line. Blank lines do not count; `mode` decides on malformed ones."""
    reader = spark.read.schema(schema).option("mode", mode)
    if tolerate_truncated:
        reader = reader.option("ignoreCorruptFiles", "true")
    return reader.json(path)


def read_snapshots(spark, path: str, mode: str = FAIL, tolerate_truncated: bool = False) -> DataFrame:
    return read_jsonl(spark, path, schemas.SNAPSHOT_PAGE, mode, tolerate_truncated)


def read_listing_venues(spark, path: str) -> DataFrame:
    return read_jsonl(spark, path, schemas.LISTING_VENUE)


def read_listing_reviews(spark, path: str) -> DataFrame:
    return read_jsonl(spark, path, schemas.LISTING_REVIEW)


def with_file_order(df: DataFrame) -> DataFrame:
    """`ordinal`: sorts rows as they follow each other in the files. A split is read from front to
    back by one task, so file, start of the split and running id order its rows."""
    return df.withColumn(
        "ordinal",
        F.struct(
            F.input_file_name().alias("file"), F.input_file_block_start().alias("start"),
            F.monotonically_increasing_id().alias("row"),
        ),
    )


def split_slots(slots: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(time rows, package rows) of a mixed file, both from the same scan."""
    is_package = F.coalesce(F.col("kind") == "pkg", F.lit(False))
    time_cols = ["wday", "hday", "n_slots", "booked", "hp"]
    package_cols = ["package_id", "name", "shour", "ehour", "available"]
    return (
        slots.where(~is_package).drop("kind", *package_cols),
        slots.where(is_package).drop("kind", *time_cols),
    )


def read_slots(
    spark, path: str, tolerate_truncated: bool = False
) -> tuple[DataFrame, DataFrame]:
    slots = read_jsonl(spark, path, schemas.SLOT, SKIP, tolerate_truncated)
    return split_slots(with_file_order(slots))


def read_venue_meta(spark, path: str, whole_files: bool = True) -> DataFrame:
    """JSON object {id: properties} -> one row per id; missing lists become empty. One object per
    file, or one per line; the second form splits a large listing over tasks."""
    whole = spark.read.text(path, wholetext=whole_files)
    rows = whole.select(F.explode(F.from_json("value", schemas.VENUE_META)).alias("id", "m"))
    lists = ("break_times", "break_days", "break_holidays")
    none = F.array().cast("array<string>")
    plain = [f.name for f in schemas.VENUE_META.valueType.fields if f.name not in lists]
    return rows.select(
        F.col("id").cast("long").alias("space_id"),
        *[F.col(f"m.{c}") for c in plain],
        *[F.coalesce(F.col(f"m.{c}"), none).alias(c) for c in lists],
    )


def venue_hours(meta: DataFrame, observed) -> DataFrame:
    """Stated closing times per venue, kept as JSON texts."""
    lists = ("break_times", "break_days", "break_holidays")
    return meta.select("space_id", F.lit(observed).cast("date").alias("observed_date"),
                       *[F.to_json(c).alias(c) for c in lists])


def read_sitemap(spark, path: str) -> DataFrame:
    return (
        spark.read.format("xml").schema(schemas.SITEMAP_URL).option("rowTag", "url").load(path)
    )


def sitemap_venues(urls: DataFrame) -> DataFrame:
    return urls.where(F.col("loc").rlike(VENUE_URL)).select(
        F.regexp_extract("loc", VENUE_URL, 1).cast("long").alias("space_id"), "lastmod"
    )


def sitemap_reviews(urls: DataFrame) -> DataFrame:
    return urls.where(F.col("loc").rlike(REVIEW_URL)).select(
        F.regexp_extract("loc", REVIEW_URL, 1).cast("long").alias("space_id"),
        F.regexp_extract("loc", REVIEW_URL, 2).cast("long").alias("review_id"),
        F.col("lastmod").alias("review_date"),
    )


def read_sitemap_venues(spark, path: str) -> DataFrame:
    return sitemap_venues(read_sitemap(spark, path))


def read_sitemap_reviews(spark, path: str) -> DataFrame:
    return sitemap_reviews(read_sitemap(spark, path))


def latest_partition(df: DataFrame, column: str) -> DataFrame:
    """Rows of the newest partition. The maximum is a scalar subquery over the partition column
    alone, and its result prunes the partitions of the outer scan."""
    newest = df.agg(F.max(column)).scalar()
    return df.where(F.col(column) == newest)
