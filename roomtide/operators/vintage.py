"""Opening month of a venue, estimated from its id and the listing's change dates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import month_floor
from .relational import suffix_min


def venue_vintage(listing: DataFrame) -> DataFrame:
    """Ids grow with registration and a change date is never before it, so the smallest change
    date among the same and all later ids bounds the registration from above. Dates compare as
    texts."""
    bounds = suffix_min(listing.select("space_id", "lastmod"), "space_id", "lastmod", "registered")
    return bounds.select("space_id", "registered", month_floor("registered").alias("vintage_month"))


def with_vintage(venues: DataFrame, vintage: DataFrame) -> DataFrame:
    return venues.join(vintage.select("space_id", "vintage_month"), "space_id", "left")


def vintage_by_bucket(vintage: DataFrame, width: int = 10_000) -> DataFrame:
    """Earliest and latest estimate per range of ids."""
    bucket = F.call_function("div", F.col("space_id"), F.lit(width)) * width
    known = vintage.where(F.col("registered").isNotNull())
    return known.groupBy(bucket.alias("id_from")).agg(
        F.min("registered").alias("first"), F.max("registered").alias("last"),
        F.count(F.lit(1)).alias("n"),
    )
