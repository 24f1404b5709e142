"""Ordered keyword rules -> category."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .scalars import col

OTHER = "기타"

# Categories from the most specific to the least, each with its patterns.
RULES: list[tuple[str, list[str]]] = [
    ("공유주방", [r"공유\s*주방", r"쿠킹\s*스튜디오", r"베이킹\s*(?:룸|스튜디오)", r"주방\s*대여"]),
    (
        "촬영스튜디오",
        [
            r"호리존", r"렌탈\s*스튜디오", r"촬영\s*스튜디오", r"촬영\s*(?:공간|장소|스튜디오)",
            r"스튜디오\s*대관", r"제품\s*촬영", r"영상\s*촬영", r"화보", r"룩북",
        ],
    ),
    (
        "연습실",
        [r"연습실", r"합주실", r"댄스\s*(?:연습|스튜디오)", r"보컬", r"무용", r"안무", r"피아노\s*연습"],
    ),
    (
        "파티룸",
        [r"파티룸", r"파티\s*공간", r"모임\s*공간", r"브라이덜", r"생일\s*파티", r"루프탑\s*파티"],
    ),
    (
        "회의실",
        [
            r"회의실", r"세미나", r"컨퍼런스", r"강의실", r"스터디\s*룸", r"미팅\s*룸", r"교육장",
            r"공유\s*오피스",
        ],
    ),
    ("팝업", [r"팝업", r"전시\s*공간", r"갤러리\s*대관", r"쇼룸"]),
    ("녹음실", [r"녹음실", r"레코딩", r"보이스\s*룸"]),
    ("스포츠", [r"골프", r"필라테스", r"요가", r"클라이밍", r"탁구", r"당구"]),
    ("숙박", [r"숙박", r"게스트하우스", r"독채", r"펜션"]),
]


def _first_hit(text: Column, rules) -> list[Column]:
    return [F.when(text.rlike("|".join(f"(?:{p})" for p in ps)), F.lit(c)) for c, ps in rules]


def classify(strong, weak, rules=RULES, default: str = OTHER) -> Column:
    """First category any of whose patterns occurs in `strong`; failing that, in `weak`."""
    s, w = F.coalesce(col(strong), F.lit("")), F.coalesce(col(weak), F.lit(""))
    return F.coalesce(*_first_hit(s, rules), *_first_hit(w, rules), F.lit(default))


def venue_category(detail, rules=RULES, default: str = OTHER, weak_chars: int | None = None) -> Column:
    """Category of a venue page: names and tags count first, the description last. The whole
    description counts unless `weak_chars` names how many of its first characters do."""
    d = col(detail)
    text = lambda c: F.coalesce(c, F.lit(""))
    none = F.array().cast("array<string>")
    strong = F.array_join(
        F.concat(
            F.array(text(d["info"]["name"]), text(d["info"]["sub_title"])),
            F.coalesce(F.transform(d["tags"], lambda t: text(t["tag"])), none),
            F.coalesce(F.transform(d["products"], lambda p: text(p["info"]["name"])), none),
        ),
        " ",
    )
    weak = d["info"]["desc"]
    return classify(strong, weak if weak_chars is None else F.substring(weak, 1, weak_chars), rules, default)
