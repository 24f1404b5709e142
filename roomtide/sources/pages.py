"""Page-state JSON inside HTML, as column expressions over a table of pages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType

from .. import schemas
from ..functions.scalars import col, yes_no

# Script fragment carrying a JSON string literal; ld+json block; detail key.
# The quantifiers are possessive: a fragment may be megabytes long, and a backtracking group would
# exhaust the stack.
FRAGMENT = r'self\.__next_f\.push\(\[1,("(?:[^"\\]++|\\.)*+")\]\)'
LD_JSON = r'(?s)application/ld\+json"?>(.*?)</script>'
DETAIL_KEY = '"detail":{'


def _joined_fragments(html, fragment: str) -> Column:
    parts = F.regexp_extract_all(col(html), F.lit(fragment), F.lit(1))
    texts = F.transform(
        parts,
        lambda p: F.get_json_object(F.concat(F.lit('{"t":'), p, F.lit("}")), "$.t"),
    )
    return F.array_join(texts, "")  # skips NULL, that is broken fragments


def page_state(html, fragment: str = FRAGMENT) -> Column:
    """All script fragments, unescaped and joined, so that a key cut in two is whole again.
    Broken fragments are skipped; NULL where a page has none."""
    return F.nullif(_joined_fragments(html, fragment), F.lit(""))


def embedded_objects(
    html, schema: DataType, accept, key: str = DETAIL_KEY, fragment: str = FRAGMENT,
    rewrite=lambda text: text,
) -> Column:
    """All objects after `key` that parse and that `accept` takes, in page order.

    Each text after a key begins with the object, and the JSON parser stops at its end, so no
    matching of braces is needed.
    """
    pieces = F.split(_joined_fragments(html, fragment), _quoted(key))
    tails = F.filter(pieces, lambda t, i: i > 0)
    objects = F.transform(tails, lambda t: F.from_json(rewrite(F.concat(F.lit("{"), t)), schema))
    return F.filter(objects, lambda o: F.coalesce(accept(o), F.lit(False)))


def extract_embedded_json(html, schema: DataType, accept, **options) -> Column:
    """First object after the key that `accept` takes; else NULL."""
    return F.get(embedded_objects(html, schema, accept, **options), F.lit(0))


def _quoted(text: str) -> str:
    return "\\Q" + text + "\\E"


def _low_keys(text: Column) -> Column:
    """Give the lower-case spellings names of their own (see `schemas.detail_schema`)."""
    return F.regexp_replace(text, r'"(rsv_tp_cd|spc_tp_cd)"(\s*:)', r'"$1_low"$2')


def is_venue_detail(d: Column) -> Column:
    return d["info"]["id"].isNotNull() & d["products"].isNotNull()


def normalize_detail(detail) -> Column:
    """Lower-case spellings fill missing fields and booleans become 'Y'/'N'."""
    d = col(detail)

    def kind(s: Column) -> Column:
        return s.withField("RSV_TP_CD", F.coalesce(s["RSV_TP_CD"], s["rsv_tp_cd_low"]))

    def rate(r: Column) -> Column:
        return (
            kind(r)
            .withField("charging_per_person", yes_no(r["charging_per_person"]))
            .withField("is_extra_person_price_per_hour", yes_no(r["is_extra_person_price_per_hour"]))
            .dropFields("rsv_tp_cd_low")
        )

    def product(p: Column) -> Column:
        info = p["info"]
        unit = kind(info).withField("charging_per_person", yes_no(info["charging_per_person"]))
        return p.withField("info", unit.dropFields("rsv_tp_cd_low")).withField(
            "reservation_types", F.transform(p["reservation_types"], rate)
        )

    head = d["info"].withField(
        "SPC_TP_CD", F.coalesce(d["info"]["SPC_TP_CD"], d["info"]["spc_tp_cd_low"])
    )
    return d.withField("info", head.dropFields("spc_tp_cd_low")).withField(
        "products", F.transform(d["products"], product)
    )


def extract_ld_json(html, type_name: str = "LocalBusiness") -> Column:
    """Text of the first ld+json block of the given @type; blocks that do not parse are skipped."""
    blocks = F.regexp_extract_all(col(html), F.lit(LD_JSON), F.lit(1))
    fits = lambda b: F.coalesce(
        F.get_json_object(b, "$['@type']") == type_name, F.lit(False)
    )
    return F.get(F.filter(blocks, fits), F.lit(0))


def parse_pages(pages: DataFrame, html: str = "html") -> DataFrame:
    """Pages with `detail` and the business block; pages without a detail are dropped.

    The detail is generated, not projected: a generator is evaluated once per page, while a
    projected expression would be repeated in the NULL test and in every field access.
    """
    details = embedded_objects(
        html, schemas.detail_schema(True), is_venue_detail, rewrite=_low_keys
    )
    found = pages.select("*", F.explode(F.slice(details, 1, 1)).alias("raw"))
    return found.select(
        *pages.columns, normalize_detail("raw").alias("detail"),
        extract_ld_json(html).alias("local_business"),
    )
