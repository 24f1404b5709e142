"""The panel in the shapes in which collectors land it: responses, slot lines, pages, listings.

Used to drive the ingestion operators over whole derived tables.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .fixtures import AS_OF, Panel
from .functions import hours as H
from .keys import RATE
from .session import shared_dir


def land(df: DataFrame, label: str, kind: str) -> str:
    """Write landed files below the shared folder and return their folder."""
    path = f"{shared_dir(df.sparkSession)}/{label}-{uuid.uuid4().hex}"
    writer = df.write.format(kind)
    if kind == "json":
        writer = writer.option("compression", "gzip")
    if kind == "xml":
        writer = writer.option("rootTag", "urlset").option("rowTag", "url")
    writer.save(path)
    return path


def _day(c: str) -> Column:
    return F.date_format(c, "yyyy-MM-dd")


def slots(obs: DataFrame, packages: DataFrame) -> DataFrame:
    """Slot records of both kinds."""
    time = obs.select(
        *RATE, _day("observed_date").alias("observed"), _day("target_date").alias("d"), "wday",
        F.when(F.col("is_holiday"), "Y").otherwise("N").alias("hday"), "n_slots",
        F.col("booked_hours").alias("booked"), F.col("hour_prices").alias("hp"), "price",
    )
    package = packages.select(
        F.lit("pkg").alias("kind"), *RATE, _day("observed_date").alias("observed"),
        _day("target_date").alias("d"), "package_id", "name", "shour", "ehour", "price", "available",
    )
    return time.unionByName(package, allowMissingColumns=True)


def _ymd() -> list[Column]:
    t = F.col("target_date")
    return [F.year(t).alias("year"), F.month(t).alias("month"), F.day(t).alias("day")]


def calendar_responses(obs: DataFrame) -> DataFrame:
    """One response per rate type and observation: its days, each with 24 time slots."""
    hours = range(H.HOURS)
    # Days of 24 prices, as all are, in generated code; hours are looked up one by one only in others.
    listed = F.expr(
        f"arrays_zip(array({', '.join(map(str, hours))}), hour_prices, "
        f"array({', '.join(f'NOT array_contains(booked_hours, {h}S)' for h in hours)}))"
    ).cast("array<struct<hour: int, price: int, available: boolean>>")
    each = F.transform(
        "hour_prices",
        lambda p, h: F.struct(
            h.alias("hour"), p.alias("price"),
            (~F.array_contains("booked_hours", h.cast("short"))).alias("available"),
        ),
    )
    times = F.when(F.size("hour_prices") == H.HOURS, listed).otherwise(each)
    hday = F.when(F.col("is_holiday"), "Y").otherwise("N").alias("hday")
    days = F.struct("target_date", *_ymd(), "wday", hday, times.alias("times"))
    grouped = obs.groupBy(*RATE, "observed_date").agg(F.sort_array(F.collect_list(days)).alias("days"))
    return grouped.select(*RATE, _day("observed_date").alias("observed"), "days")


def package_responses(packages: DataFrame) -> DataFrame:
    offer = F.struct(
        F.col("package_id").alias("id"), "name", "shour", "ehour", "price",
        F.col("available").cast("string").alias("available"),
    )
    daily = packages.groupBy(*RATE, "observed_date", "target_date").agg(
        F.sort_array(F.collect_list(offer)).alias("packages")
    )
    day = F.struct("target_date", *_ymd(), "packages")
    grouped = daily.groupBy(*RATE, "observed_date").agg(F.sort_array(F.collect_list(day)).alias("days"))
    return grouped.select(*RATE, _day("observed_date").alias("observed"), "days")


# Four name styles, three address styles; see the matching statement in the oracle.
NAMES = ["댄스 연습실", "생일 파티 룸", "세미나 공간", "작업실"]
ADDRESSES = ["서울 강남구 역삼동 12-3", "서울 강남구 테헤란로 12", "경기 고양시 일산동구 정발산동 7"]


def _pick(values: list[str], index: Column) -> Column:
    return F.get(F.array(*[F.lit(v) for v in values]), index.cast("int"))


def venue_pages(p: Panel) -> DataFrame:
    """One landed page per supplier; every fiftieth venue is gone and has no detail."""
    s = F.col("space_id")
    product = lambda i: F.struct(
        F.struct(
            (s * 10 + i).alias("id"), F.lit(f"룸 {i}").alias("name"),
            (F.lit(10000) + s % 20 * 1000 + i * 500).cast("int").alias("price"),
            F.lit("TIME" if i < 3 else "DAY").alias("RSV_TP_CD"),
            F.when(s % 2 == 0, "Y").otherwise("N").alias("charging_per_person"),
            F.lit(1).alias("min_time_policy"), (s % 9 + i).cast("int").alias("max_guest_capacity"),
            F.lit(2).alias("min_guest_policy"),
            (s % 40 + i).cast("string").alias("area_size_pyeong"),
            F.lit("33.3").alias("area_size_square_meter"),
        ).alias("info"),
        F.array(
            F.struct(
                (s * 100 + i * 10).alias("id"), F.lit("TIME" if i < 3 else "DAY").alias("RSV_TP_CD"),
                F.lit(10000).alias("price"), F.when(s % 3 == 0, "N").alias("charging_per_person"),
                F.lit(4).alias("person_ceiling"), F.lit(5000).alias("extra_person_price"),
                F.lit("Y").alias("is_extra_person_price_per_hour"),
            )
        ).alias("reservation_types"),
    )
    detail = F.struct(
        F.struct(
            s.alias("id"), _pick(NAMES, s % 4).alias("name"), F.lit("sub").alias("sub_title"),
            F.when(s % 8 == 3, "촬영 장소").otherwise("공간").alias("desc"),
            F.lit("MEET").alias("SPC_TP_CD"), (s % 7).cast("int").alias("zzim_cnt"),
        ).alias("info"),
        F.struct(F.call_function("div", s, F.lit(2)).cast("string").alias("id")).alias("host"),
        F.struct(
            _pick(ADDRESSES, s % 3).alias("addr"), F.lit("B1").alias("addr_detail"),
            F.concat(
                F.when(s % 3 == 2, "41").otherwise("11"), F.lit("68010"),
                F.lpad((F.call_function("div", s, F.lit(6)) % 5).cast("string"), 3, "0"),
            ).alias("cortar_no"),
            F.lit("1").alias("floor"), F.lit("37.5").alias("latitude"), F.lit("127.0").alias("longitude"),
        ).alias("location"),
        F.array(
            F.struct(F.lit("tag a").alias("tag"), F.lit(1).alias("rank")),
            F.struct(F.lit("tag b").alias("tag"), F.lit(2).alias("rank")),
        ).alias("tags"),
        F.array(F.lit("mon")).alias("break_days"),
        F.struct(
            F.struct((s * 13 % 50).cast("int").alias("total")).alias("page"),
            F.array(F.struct(F.lit("2026-01-10 08:30:00").alias("created_at"))).alias("reviews"),
        ).alias("reviews"),
        F.array(product(1), product(2), product(3)).alias("products"),
    )
    return p.venues.select(
        s.alias("id"), F.lit(f"{AS_OF}T00:00:00").alias("fetched_at"),
        F.when(F.col("is_gone"), 404).otherwise(200).alias("status"),
        F.when(~F.col("is_gone"), detail).alias("detail"),
    )


def sitemap_urls(p: Panel) -> DataFrame:
    """Listing entries of venues (order ids and dates) and reviews (line items)."""
    def entry(path: Column, day: str) -> list[Column]:
        loc = F.concat(F.lit("https://www.example.com/space/"), path).alias("loc")
        return [loc, F.date_format(day, "yyyy-MM-dd").alias("lastmod")]

    orders = p.raw("orders").select(*entry(F.col("o_orderkey").cast("string"), "o_orderdate"))
    review = F.concat_ws(
        "/", F.col("space_id").cast("string"), F.lit("review"), F.col("review_id").cast("string")
    )
    return orders.unionByName(p.reviews.select(*entry(review, "review_date")))


def _json_text(c: Column) -> Column:
    """Text -> JSON string literal."""
    wrapped = F.to_json(F.struct(c.alias("t")))
    return F.substring(wrapped, F.lit(6), F.length(wrapped) - 6)


def page_state_pages(p: Panel) -> DataFrame:
    """The given pages with page state appended: a decoy under the same key, a broken fragment,
    and the detail cut in two in the middle of its key; plus ld+json blocks of which the first
    does not parse and the second has another type."""
    info = F.struct(
        F.col("page_id").alias("id"), F.col("url").alias("name"), F.lit("X").alias("spc_tp_cd")
    )
    unit = F.struct(
        F.struct(
            (F.col("page_id") * 10).alias("id"), F.lit("TIME").alias("rsv_tp_cd"),
            (F.col("page_id") % 2 == 0).alias("charging_per_person"),
        ).alias("info")
    )
    body = F.to_json(F.struct(info.alias("info"), F.array(unit).alias("products")))
    push = lambda text: F.concat(
        F.lit("<script>self.__next_f.push([1,"), text, F.lit("])</script>")
    )
    decoy = '0:{"detail":{"info":{"name":"not a venue"}},'
    ld = lambda text: F.concat(
        F.lit('<script type="application/ld+json">'), text, F.lit("</script>")
    )
    name = F.to_json(F.struct(F.lit("LocalBusiness").alias("@type"), F.col("url").alias("name")))
    html = F.concat(
        F.col("html"),
        push(_json_text(F.lit(decoy + '"det'))), push(F.lit('"bad \\x"')),
        push(_json_text(F.concat(F.lit('ail":'), body, F.lit(',"more":1}')))),
        ld(F.lit("{not json")), ld(F.lit('{"@type":"Organization"}')), ld(name),
    )
    return p.raw("pages").select("page_id", html.alias("html"))


def slot_versions(p: Panel) -> DataFrame:
    """All slot lines as if observed on the first day and landed again and again: `ordinal` tells
    which record of a key is the last."""
    rows = slots(p.observations, p.packages)
    return rows.withColumn("ordinal", F.col("observed")).withColumn("observed", F.lit("2026-01-02"))


def meta_lines(p: Panel) -> DataFrame:
    """Venue properties as JSON objects keyed by id, one object per line."""
    s = F.col("space_id")
    entry = F.struct(
        s.cast("string").alias("key"),
        F.struct(
            "name", "sigungu", "category", F.when(s % 2 == 0, F.array(F.lit("mon"))).alias("break_days")
        ).alias("value"),
    )
    chunk = F.call_function("div", s, F.lit(50))
    return p.venues.groupBy(chunk.alias("c")).agg(
        F.to_json(F.map_from_entries(F.collect_list(entry))).alias("value")
    ).select("value")

