"""Korean postal addresses and legal-district codes as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .scalars import col

# Short province name -> official name.
PROVINCES = {
    "서울": "서울특별시",
    "서울시": "서울특별시",
    "부산": "부산광역시",
    "대구": "대구광역시",
    "인천": "인천광역시",
    "광주": "광주광역시",
    "대전": "대전광역시",
    "울산": "울산광역시",
    "세종": "세종특별자치시",
    "세종시": "세종특별자치시",
    "경기": "경기도",
    "강원": "강원특별자치도",
    "강원도": "강원특별자치도",
    "충북": "충청북도",
    "충남": "충청남도",
    "전북": "전북특별자치도",
    "전라북도": "전북특별자치도",
    "전남": "전라남도",
    "경북": "경상북도",
    "경남": "경상남도",
    "제주": "제주특별자치도",
    "제주도": "제주특별자치도",
}
# A street name followed by a building number; endings of district names.
ROAD_STYLE = r"(로|길)\s*\d"
DISTRICT_NAME = r"[동리가]$"
CITY, WARD, COUNTY = "시", "구", "군"


def _tokens(addr) -> Column:
    return F.split(F.regexp_replace(col(addr), r"^\s+|\s+$", ""), r"\s+")


def _present(addr) -> Column:
    return F.length(col(addr)) > 0


def is_road_address(addr) -> Column:
    return col(addr).rlike(ROAD_STYLE)


def region_codes(code) -> Column:
    c = F.nullif(col(code).cast("string"), F.lit(""))
    return F.struct(
        F.substring(c, 1, 2).alias("sido_code"),
        F.substring(c, 1, 5).alias("sigungu_code"),
        c.alias("dong_code"),
    )


def _district(addr, second_parts: tuple[str, ...]) -> tuple[Column, Column]:
    """(district, third-level token). A city followed by one of its parts is one district."""
    t = _tokens(addr)
    city, part = F.get(t, F.lit(1)), F.get(t, F.lit(2))
    is_part = F.lit(False)
    for ending in second_parts:
        is_part = is_part | F.endswith(part, F.lit(ending))
    two = F.coalesce(F.endswith(city, F.lit(CITY)) & is_part, F.lit(False))
    district = F.when(two, F.concat_ws(" ", city, part)).otherwise(city)
    return district, F.when(two, F.get(t, F.lit(3))).otherwise(part)


def parse_region(addr, code) -> Column:
    """sido, sigungu, dong and the code prefixes. Only lot-style addresses name the dong."""
    first = F.get(_tokens(addr), F.lit(0))
    names = F.create_map(*[F.lit(x) for kv in PROVINCES.items() for x in kv])
    district, third = _district(addr, (WARD, COUNTY))
    codes = region_codes(code)
    return F.struct(
        F.when(_present(addr), F.coalesce(F.try_element_at(names, first), first)).alias("sido"),
        F.when(_present(addr), district).alias("sigungu"),
        F.when(_present(addr) & ~is_road_address(addr) & third.rlike(DISTRICT_NAME), third).alias(
            "dong"
        ),
        codes["sido_code"].alias("sido_code"),
        codes["sigungu_code"].alias("sigungu_code"),
        codes["dong_code"].alias("dong_code"),
    )


def split_address(addr) -> Column:
    """Plain token split: no official names, every address names its third level."""
    district, third = _district(addr, (WARD,))
    return F.struct(
        F.when(_present(addr), F.get(_tokens(addr), F.lit(0))).alias("sido"),
        F.when(_present(addr), district).alias("sigungu"),
        F.when(_present(addr), third).alias("dong"),
    )
