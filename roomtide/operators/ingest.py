"""From landed pages and slots to the rows of the panel tables."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .. import schemas
from ..functions.arrays import price_stats, venue_totals
from ..functions.classify import OTHER, RULES, venue_category
from ..functions.region import parse_region
from ..functions.scalars import col, num_or_null, review_ts
from ..keys import OBSERVATION, PACKAGE, RATE
from ..sources.readers import with_file_order
from ..sources.writers import dedupe_last, pending
from .occupancy import drop_past
from .relational import fill_from_dictionary
from .vintage import with_vintage


@dataclass(frozen=True)
class VenueRows:
    venues: DataFrame
    snapshots: DataFrame
    units: DataFrame
    rates: DataFrame
    tags: DataFrame


def shaped(df: DataFrame, schema: StructType) -> DataFrame:
    """Columns of the table in its order and types; what the input lacks is NULL."""
    have = set(df.columns)
    return df.select(
        *[(F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name)
          for f in schema.fields]
    )


def gone_venues(snapshots: DataFrame) -> DataFrame:
    return snapshots.where(F.col("detail").isNull())


def _number(c: str) -> Column:
    return F.col(c).try_cast("double")


def load_venues(
    snapshots: DataFrame, vintage: DataFrame, date: str, rules=RULES, default: str = OTHER
) -> VenueRows:
    """Venue, snapshot, unit, rate-type and tag rows of one day's pages. A page without detail is
    a venue that is gone. A missing district name is borrowed from the first lot-style address
    with the same district code."""
    day = F.lit(date).cast("date")
    pages = snapshots if "ordinal" in snapshots.columns else with_file_order(snapshots)
    d = F.col("detail")
    ok = d.isNotNull()
    region = parse_region("detail.location.addr", "detail.location.cortar_no")
    head = pages.select(
        F.col("id").alias("space_id"), "ordinal",
        day.alias("first_seen"), day.alias("last_seen"),
        F.col("detail.info.name").alias("name"), F.col("detail.host.id").alias("host_id"),
        F.col("detail.location.addr").alias("addr"),
        F.col("detail.location.addr_detail").alias("addr_detail"),
        F.col("detail.location.cortar_no").alias("cortar_no"),
        F.col("detail.location.floor").alias("floor_raw"),
        F.nullif(_number("detail.location.latitude"), F.lit(0.0)).alias("lat"),
        F.nullif(_number("detail.location.longitude"), F.lit(0.0)).alias("lng"),
        F.col("detail.info.SPC_TP_CD").alias("spc_tp_cd"),
        F.when(ok, venue_category("detail", rules, default)).alias("category"),
        (~ok).alias("is_gone"), F.when(~ok, day).alias("gone_at"),
        region.alias("region"),
    )
    flat = head.select(
        "*", "region.sido", "region.sigungu", F.col("region.dong").alias("eupmyeondong"),
        "region.sido_code", "region.sigungu_code", "region.dong_code",
    ).drop("region")
    named = fill_from_dictionary(flat, flat, "dong_code", "eupmyeondong", "ordinal")
    venues = shaped(with_vintage(named, vintage), schemas.VENUE)

    products = F.col("detail.products")
    prices, totals = price_stats(products), venue_totals(products)
    latest = F.get(F.col("detail.reviews.reviews"), F.lit(0))["created_at"]
    metrics = pages.select(
        F.col("id").alias("space_id"), day.alias("snapshot_date"),
        F.col("status").alias("http_status"),
        F.when(ok, F.coalesce(F.col("detail.reviews.page.total"), F.lit(0))).alias("review_total"),
        F.col("detail.reviews.avg_rate").alias("review_avg_rate"),
        F.col("detail.info.zzim_cnt").alias("zzim_cnt"),
        prices["min_price"].alias("min_price"), prices["median_price"].alias("median_price"),
        prices["max_price"].alias("max_price"),
        F.when(ok, F.coalesce(F.array_size(products), F.lit(0))).alias("n_products"),
        F.when(ok, totals["total_pyeong"]).alias("total_pyeong"),
        F.when(ok, totals["max_capacity"]).alias("max_capacity"),
        F.when(ok, F.to_json(
            F.coalesce(F.col("detail.break_days"), F.array().cast("array<string>"))
        )).alias("break_days"),
        review_ts(latest).alias("latest_review_at"),
    )
    unit = (
        pages.where(ok)
        .select(F.col("id").alias("space_id"), F.explode("detail.products").alias("p"))
        .where(F.coalesce(F.col("p.info.id"), F.lit(0)) != 0)
    )
    i = "p.info."
    units = unit.select(
        "space_id", F.col(i + "id").alias("product_id"), day.alias("snapshot_date"),
        F.col(i + "name").alias("name"), F.col(i + "price").alias("price"),
        F.col(i + "RSV_TP_CD").alias("rsv_tp_cd"),
        F.col(i + "charging_per_person").alias("charging_per_person"),
        F.col(i + "min_time_policy").alias("min_time_policy"),
        F.col(i + "max_guest_capacity").alias("max_guest_capacity"),
        num_or_null(i + "area_size_pyeong").alias("area_pyeong"),
        num_or_null(i + "area_size_square_meter").alias("area_sqm"),
        F.col(i + "min_guest_policy").alias("min_guest_policy"),
    )
    rate = unit.select(
        "space_id", "p.info", F.explode("p.reservation_types").alias("r")
    ).where(F.coalesce(F.col("r.id"), F.lit(0)) != 0)
    rates = rate.select(
        "space_id", F.col("info.id").alias("product_id"), F.col("r.id").alias("rsv_type_id"),
        day.alias("snapshot_date"), F.col("r.RSV_TP_CD").alias("rsv_tp_cd"),
        F.col("r.price").alias("price"),
        F.coalesce("r.charging_per_person", "info.charging_per_person").alias("charging_per_person"),
        F.col("r.person_ceiling").alias("person_ceiling"),
        F.col("r.extra_person_price").alias("extra_person_price"),
        F.col("r.is_extra_person_price_per_hour").alias("extra_per_hour"),
    )
    tags = pages.select(
        F.col("id").alias("space_id"), F.inline("detail.tags").alias("tag", "rank")
    )
    return VenueRows(
        venues,
        shaped(metrics, schemas.VENUE_SNAPSHOT),
        shaped(units, schemas.UNIT_SNAPSHOT),
        shaped(rates, schemas.RATE_SNAPSHOT),
        shaped(tags, schemas.VENUE_TAG),
    )


def load_reviews(reviews: DataFrame, date: str) -> DataFrame:
    return shaped(
        reviews.select(
            "review_id", "space_id", F.col("review_date").cast("date").alias("review_date"),
            F.lit(date).cast("date").alias("first_seen"),
        ),
        schemas.REVIEW,
    )


def in_region(df: DataFrame, districts: list[str] | None = None, code: str = "11") -> DataFrame:
    """Rows of the named districts, or else of the province with this code."""
    if districts:
        return df.where(F.col("sigungu").isin(districts))
    return df.where(F.col("sido_code") == code)


def rate_kind(df: DataFrame, kinds: tuple[str, ...] = ("TIME", "PKG")) -> DataFrame:
    return df.where(F.col("rsv_tp_cd").isin(*kinds))


def expand_months(targets: DataFrame, start, n: int = 2) -> DataFrame:
    """Each target for the month of `start` and the following ones; the year rolls over."""
    first = F.trunc(F.lit(start).cast("date"), "MM")
    month = F.explode(F.transform(F.sequence(F.lit(0), F.lit(n - 1)), lambda i: F.add_months(first, i)))
    return (
        targets.withColumn("m", month)
        .withColumns({"year": F.year("m"), "month": F.lpad(F.month("m").cast("string"), 2, "0")})
        .drop("m")
    )


def collection_targets(
    snapshots: DataFrame, start, districts: list[str] | None = None, code: str = "11",
    months: int = 2, done: DataFrame | None = None,
) -> DataFrame:
    """Rate types to look up per month: hourly ones and packages, of venues in the region."""
    pages = snapshots.where(F.col("detail").isNotNull()).select(
        F.col("id").alias("space_id"), "detail.products",
        parse_region("detail.location.addr", "detail.location.cortar_no").alias("region"),
    )
    placed = pages.select("space_id", "products", "region.sigungu", "region.sido_code")
    unit = in_region(placed, districts, code).select("space_id", F.explode("products").alias("p"))
    rate = unit.where(F.coalesce(F.col("p.info.id"), F.lit(0)) != 0).select(
        "space_id", "p.info", F.explode("p.reservation_types").alias("r")
    )
    listed = rate.select(
        "space_id", F.col("info.id").alias("product_id"), F.col("r.id").alias("rsv_type_id"),
        F.col("r.RSV_TP_CD").alias("rsv_tp_cd"), F.col("info.name").alias("product_name"),
        num_or_null("info.area_size_pyeong").alias("pyeong"),
        F.col("info.max_guest_capacity").alias("max_guest"), F.col("r.price").alias("price"),
    )
    kind = F.when(F.col("rsv_tp_cd") == "PKG", "pkg").otherwise("time")
    units = expand_months(rate_kind(listed).withColumn("kind", kind).drop("rsv_tp_cd"), start, months)
    return units if done is None else pending(units, done, ["product_id", "rsv_type_id", "year", "month"])


def observation_columns() -> list[Column]:
    """The columns of an observation row, of a landed time row."""
    return [
        *map(F.col, RATE),
        F.col("observed").cast("date").alias("observed_date"),
        F.col("d").cast("date").alias("target_date"),
        F.col("wday"), F.coalesce(F.col("hday") == "Y", F.lit(False)).alias("is_holiday"), F.col("n_slots"),
        F.col("booked").alias("booked_hours"), F.size("booked").alias("n_booked"), F.col("price"),
        F.col("hp").alias("hour_prices"),
    ]


def package_columns() -> list[Column]:
    """The columns of a package row, of a landed package row."""
    return [
        *map(F.col, RATE), F.col("package_id"),
        F.col("observed").cast("date").alias("observed_date"),
        F.col("d").cast("date").alias("target_date"),
        *map(F.col, ("name", "shour", "ehour", "price")),
        F.coalesce(F.lower("available") == "true", F.lit(False)).alias("available"),
    ]


def load_observations(slots: DataFrame, ordinal="ordinal") -> tuple[DataFrame, DataFrame]:
    """(observation rows, one-row count of dropped past targets) of landed time rows. Of repeated
    keys the last row in file order counts."""
    kept, skipped = drop_past(slots, "d", "observed")
    rows = kept.select(*observation_columns(), col(ordinal).alias("ordinal"))
    return shaped(dedupe_last(rows, OBSERVATION, "ordinal"), schemas.OBSERVATION), skipped


def load_packages(slots: DataFrame, ordinal="ordinal") -> tuple[DataFrame, DataFrame]:
    """(package rows, one-row count of windows over midnight) of landed package rows."""
    kept, _ = drop_past(slots, "d", "observed")
    rows = kept.select(*package_columns(), col(ordinal).alias("ordinal"))
    unique = shaped(dedupe_last(rows, PACKAGE, "ordinal"), schemas.PACKAGE)
    return unique, unique.agg(F.count_if(F.col("shour") >= F.col("ehour")).alias("n_wrap"))
