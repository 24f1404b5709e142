"""Explicit schemas of landed inputs and of the panel tables; readers never infer."""

from __future__ import annotations

from pyspark.sql.types import (
    ArrayType, BooleanType, DataType, DateType, DecimalType, DoubleType, IntegerType, LongType,
    MapType, ShortType, StringType, StructField, StructType, TimestampType,
)

LONG, INT, SHORT, TEXT = LongType(), IntegerType(), ShortType(), StringType()
FLAG, DATE, TS, DOUBLE = BooleanType(), DateType(), TimestampType(), DoubleType()


def table(**fields: DataType) -> StructType:
    return StructType([StructField(name, kind, True) for name, kind in fields.items()])


def many(kind: DataType) -> ArrayType:
    return ArrayType(kind, True)


# --- landed files -------------------------------------------------------------------------

LISTING_VENUE = table(space_id=LONG, lastmod=TEXT)
LISTING_REVIEW = table(space_id=LONG, review_id=LONG, review_date=TEXT)
SITEMAP_URL = table(loc=TEXT, lastmod=TEXT)


def detail_schema(page_state: bool = False) -> StructType:
    """A venue's detail object. `page_state` adds the lower-case spellings found in pages; they
    carry a suffix because struct fields that differ only in case cannot be told apart."""
    low = {"rsv_tp_cd_low": TEXT} if page_state else {}
    info_low = {"spc_tp_cd_low": TEXT} if page_state else {}
    rate = table(
        id=LONG, RSV_TP_CD=TEXT, **low, price=INT, charging_per_person=TEXT, person_ceiling=INT,
        extra_person_price=INT, is_extra_person_price_per_hour=TEXT,
    )
    unit = table(
        id=LONG, name=TEXT, price=INT, RSV_TP_CD=TEXT, **low, charging_per_person=TEXT,
        min_time_policy=INT, max_guest_capacity=INT, min_guest_policy=INT,
        area_size_pyeong=TEXT, area_size_square_meter=TEXT,
    )
    return table(
        info=table(
            id=LONG, name=TEXT, sub_title=TEXT, desc=TEXT, SPC_TP_CD=TEXT, **info_low, zzim_cnt=INT
        ),
        host=table(id=TEXT),
        location=table(
            addr=TEXT, addr_detail=TEXT, cortar_no=TEXT, floor=TEXT, latitude=TEXT, longitude=TEXT
        ),
        tags=many(table(tag=TEXT, rank=INT)),
        break_days=many(TEXT), break_times=many(TEXT), break_holidays=many(TEXT),
        reviews=table(
            page=table(total=INT), avg_rate=DecimalType(5, 4), reviews=many(table(created_at=TEXT))
        ),
        products=many(table(info=unit, reservation_types=many(rate))),
    )


SNAPSHOT_PAGE = table(id=LONG, fetched_at=TEXT, status=INT, detail=detail_schema())

SLOT = table(
    kind=TEXT, space_id=LONG, product_id=LONG, rsv_type_id=LONG, observed=TEXT, d=TEXT,
    wday=TEXT, hday=TEXT, n_slots=INT, booked=many(SHORT), hp=many(INT), price=INT,
    package_id=LONG, name=TEXT, shour=INT, ehour=INT, available=TEXT,
)

VENUE_META = MapType(
    TEXT,
    table(
        name=TEXT, sigungu=TEXT, dong=TEXT, dong_code=TEXT, category=TEXT, lat=DOUBLE, lng=DOUBLE,
        break_times=many(TEXT), break_days=many(TEXT), break_holidays=many(TEXT),
    ),
)

CALENDAR_DAY = table(
    year=INT, month=INT, day=INT, wday=TEXT, hday=TEXT,
    times=many(table(hour=INT, price=INT, available=FLAG)),
)
PACKAGE_DAY = table(
    year=INT, month=INT, day=INT,
    packages=many(
        table(id=LONG, name=TEXT, shour=INT, ehour=INT, price=INT, available=TEXT)
    ),
)

# --- panel tables -------------------------------------------------------------------------

VENUE = table(
    space_id=LONG, first_seen=DATE, last_seen=DATE, vintage_month=DATE, name=TEXT, host_id=TEXT,
    addr=TEXT, addr_detail=TEXT, sido=TEXT, sigungu=TEXT, eupmyeondong=TEXT, sido_code=TEXT,
    sigungu_code=TEXT, dong_code=TEXT, cortar_no=TEXT, floor_raw=TEXT, lat=DOUBLE, lng=DOUBLE,
    spc_tp_cd=TEXT, category=TEXT, is_gone=FLAG, gone_at=DATE,
)
VENUE_SNAPSHOT = table(
    space_id=LONG, snapshot_date=DATE, http_status=INT, review_total=INT,
    review_avg_rate=DecimalType(5, 4), zzim_cnt=INT, min_price=INT, median_price=INT,
    max_price=INT, n_products=INT, total_pyeong=DecimalType(10, 2), max_capacity=INT,
    break_days=TEXT, latest_review_at=TS,
)
UNIT_SNAPSHOT = table(
    space_id=LONG, product_id=LONG, snapshot_date=DATE, name=TEXT, price=INT, rsv_tp_cd=TEXT,
    charging_per_person=TEXT, min_time_policy=INT, max_guest_capacity=INT, area_pyeong=INT,
    area_sqm=DecimalType(10, 2), min_guest_policy=INT,
)
RATE_SNAPSHOT = table(
    space_id=LONG, product_id=LONG, rsv_type_id=LONG, snapshot_date=DATE, rsv_tp_cd=TEXT,
    price=INT, charging_per_person=TEXT, person_ceiling=INT, extra_person_price=INT,
    extra_per_hour=TEXT,
)
OBSERVATION = table(
    space_id=LONG, product_id=LONG, rsv_type_id=LONG, observed_date=DATE, target_date=DATE,
    wday=TEXT, is_holiday=FLAG, n_slots=INT, booked_hours=many(SHORT), n_booked=INT, price=INT,
    hour_prices=many(INT),
)
PACKAGE = table(
    space_id=LONG, product_id=LONG, rsv_type_id=LONG, package_id=LONG, observed_date=DATE,
    target_date=DATE, name=TEXT, shour=INT, ehour=INT, price=INT, available=FLAG,
)
REVIEW = table(review_id=LONG, space_id=LONG, review_date=DATE, first_seen=DATE)
VENUE_TAG = table(space_id=LONG, tag=TEXT, rank=INT)
VENUE_HOURS = table(
    space_id=LONG, observed_date=DATE, break_times=TEXT, break_days=TEXT, break_holidays=TEXT
)
RUN_LOG = table(
    run_date=DATE, stage=TEXT, seq=INT, status=TEXT, started_at=TS, updated_at=TS, done=LONG,
    base=LONG, total=LONG, fail_n=LONG, note=TEXT, err=TEXT,
)
