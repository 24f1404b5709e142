"""DuckDB statements of the ingestion side."""

from __future__ import annotations

from ..fixtures import AS_OF, DAY
from ..landed import ADDRESSES, NAMES
from ..plans.quality import RULES
from .oracle import K3, C
from .sqltext import ratio, sorted_list, units, upper

DIGEST = f"""{K3}, observed_date::VARCHAR AS observed_date, target_date::VARCHAR AS target_date, wday,
    is_holiday, n_slots, n_booked, price, array_to_string(booked_hours, ',') AS booked,
    list_sum(hour_prices)::BIGINT AS price_sum"""


def _list(values: list[str]) -> str:
    return "[" + ", ".join(f"'{v}'" for v in values) + "]"


def add_landing(put) -> None:
    put("load_observations", f"SELECT {DIGEST} FROM obs")
    for name in ("streamed_observations", "published_observations"):
        put(name, f"SELECT {DIGEST} FROM obs")
    put("landed_files", "SELECT (SELECT count(*) FROM obs) + (SELECT count(*) FROM pkg) AS n_rows, 0::BIGINT AS n_cut, true AS all_read")
    put("loaded_reviews", f"""
        SELECT DISTINCT l_orderkey * 8 + l_linenumber AS review_id,
          CASE WHEN (l_orderkey * 8 + l_linenumber) % 3 = 2 THEN '{AS_OF}' ELSE '{DAY}' END AS first_seen FROM lineitem""")
    put("flatten_calendar", f"SELECT {DIGEST} FROM (SELECT * REPLACE (hour_prices[1] AS price) FROM obs)")
    package = f"""SELECT {K3}, package_id, observed_date::VARCHAR AS observed_date,
        target_date::VARCHAR AS target_date, 'package ' || package_id AS name, shour, ehour, price,
        true AS available FROM pkg"""
    put("load_packages", package)
    put("flatten_packages", package)
    put("streamed_packages", package)
    put("published_packages", package)
    put("dedupe_last", f"""
        SELECT {DIGEST.replace("observed_date::VARCHAR AS observed_date", "'2026-01-02' AS observed_date")}
        FROM (FROM obs WHERE target_date >= DATE '2026-01-02'
              QUALIFY row_number() OVER (PARTITION BY {K3}, target_date ORDER BY observed_date DESC) = 1)""")
    put("dedupe_last_packages", f"""
        SELECT {K3}, package_id, '2026-01-02' AS observed_date, target_date::VARCHAR AS target_date, shour, ehour, price
        FROM pkg WHERE target_date >= DATE '2026-01-02'
        QUALIFY row_number() OVER (PARTITION BY {K3}, package_id, target_date ORDER BY observed_date DESC) = 1""")
    put("drop_past_count", f"""
        SELECT count_if(target_date < DATE '{AS_OF}') AS n_skipped
        FROM (SELECT target_date FROM obs UNION ALL SELECT target_date FROM pkg)""")
    put("price_variance", f"""
        SELECT {K3}, max(n) AS n_hour_prices, count(DISTINCT hour_prices) AS n_day_patterns,
          CASE WHEN max(n) > 1 THEN 'by_hour' WHEN count(DISTINCT hour_prices) > 1 THEN 'by_day'
               ELSE 'flat' END AS variance
        FROM (SELECT *, len(list_distinct(hour_prices)) + CASE WHEN list_contains(
                list_transform(hour_prices, lambda v: v IS NULL), true) THEN 1 ELSE 0 END AS n FROM obs)
        GROUP BY {K3}""")
    C.add("reviews_", """
        SELECT DISTINCT l_orderkey * 8 + l_linenumber AS review_id, l_shipdate::DATE AS review_date
        FROM lineitem""")
    put("sitemap_venues", "SELECT o_orderkey AS space_id, o_orderdate::DATE::VARCHAR AS lastmod FROM orders")
    put("listing_jsonl", "SELECT o_orderkey AS space_id, o_orderdate::DATE::VARCHAR AS lastmod FROM orders")
    put("sitemap_reviews", "SELECT space_id, review_id, review_date::VARCHAR AS review_date FROM reviews_")
    put("load_reviews", """
        SELECT space_id, date_trunc('month', review_date)::DATE::VARCHAR AS month, count(*) AS n
        FROM reviews_ GROUP BY ALL""")
    put("venue_meta", """
        SELECT space_id, name, sigungu, category, '[]' AS break_times,
          CASE WHEN space_id % 2 = 0 THEN '["mon"]' ELSE '[]' END AS break_days FROM venue""")
    put("latest_partition", """
        SELECT space_id, observed_date::VARCHAR AS observed_date, count(*) AS n FROM obs
        WHERE observed_date = (SELECT max(observed_date) FROM obs) GROUP BY obs.space_id, obs.observed_date""")
    put("embedded_detail", """
        SELECT page_id, page_id AS id, url AS name, 'X' AS kind, page_id * 10 AS unit_id, 'TIME' AS unit_kind,
          CASE WHEN page_id % 2 = 0 THEN 'Y' ELSE 'N' END AS per_person FROM pages""")
    put("ld_json_block", "SELECT page_id, url AS name FROM pages")
    rules = [
        ("license", r"[Ll]icense|[Cc]opyright"), ("contact", "@|[0-9]{3}-[0-9]{4}"),
        ("english", " the | and "), ("german", " der | und "),
    ]
    whens = " ".join(
        f"WHEN regexp_matches({c}, '{p}') THEN '{name}'" for c in ("source", "text") for name, p in rules
    )
    put("classify_documents", f"SELECT doc_id, CASE {whens} ELSE 'other' END AS category FROM documents")

    # --- venues ---------------------------------------------------------------------------
    C.add("vint", """
        SELECT o_orderkey AS space_id, strftime(min(o_orderdate) OVER (ORDER BY o_orderkey DESC), '%Y-%m-%d')
          AS registered FROM orders""")
    put("venue_vintage", """
        SELECT space_id, registered, registered[1:7] || '-01' AS vintage_month FROM vint""")
    put("vintage_by_bucket", """
        SELECT space_id // 1000 * 1000 AS id_from, min(registered) AS first, max(registered) AS last,
          count(*) AS n FROM vint GROUP BY ALL""")
    C.add("page", f"""
        SELECT v.space_id, v.is_gone, {_list(NAMES)}[v.space_id % 4 + 1] AS name,
          {_list(ADDRESSES)}[v.space_id % 3 + 1] AS addr, v.space_id % 3 AS style,
          (CASE WHEN v.space_id % 3 = 2 THEN '41' ELSE '11' END) || '68010' ||
            lpad((v.space_id // 6 % 5)::VARCHAR, 3, '0') AS code,
          CASE v.space_id % 4 WHEN 0 THEN '연습실' WHEN 1 THEN '파티룸' WHEN 2 THEN '회의실'
            ELSE CASE WHEN v.space_id % 8 = 3 THEN '촬영스튜디오' ELSE '기타' END END AS category,
          v.space_id // 2 AS host, registered,
          CASE v.space_id % 3 WHEN 2 THEN '경기도' ELSE '서울특별시' END AS sido,
          CASE v.space_id % 3 WHEN 2 THEN '고양시 일산동구' ELSE '강남구' END AS sigungu,
          CASE v.space_id % 3 WHEN 2 THEN '정발산동' WHEN 0 THEN '역삼동' END AS dong
        FROM venue v LEFT JOIN vint USING (space_id)""")
    live = lambda c: f"CASE WHEN NOT is_gone THEN {c} END"
    put("load_venues", f"""
        SELECT space_id, registered[1:7] || '-01' AS vintage_month, {live('name')} AS name,
          {live('host::VARCHAR')} AS host_id, {live('sido')} AS sido, {live('sigungu')} AS sigungu,
          {live('coalesce(dong, borrowed)')} AS eupmyeondong, {live('code[1:2]')} AS sido_code,
          {live('code[1:5]')} AS sigungu_code, {live('code')} AS dong_code, {live("'MEET'")} AS spc_tp_cd,
          {live('category')} AS category, is_gone, CASE WHEN is_gone THEN '{AS_OF}' END AS gone_at,
          {live('37.5::DOUBLE')} AS lat, {live('127.0::DOUBLE')} AS lng
        FROM page LEFT JOIN (SELECT code, min(dong) AS borrowed FROM page
          WHERE dong IS NOT NULL AND NOT is_gone GROUP BY ALL) USING (code)""")
    put("load_venue_snapshots", f"""
        SELECT space_id, CASE WHEN is_gone THEN 404 ELSE 200 END AS http_status,
          {live('space_id * 13 % 50')} AS review_total, {live('space_id % 7')} AS zzim_cnt,
          {live('base + 500')} AS min_price, {live('base + 750')} AS median_price,
          {live('base + 1000')} AS max_price, {live('3')} AS n_products,
          {live('(space_id % 40 * 3 + 6)::DOUBLE')} AS total_pyeong,
          {live('space_id % 9 + 3')} AS max_capacity, {live("'[" + chr(34) + "mon" + chr(34) + "]'")} AS break_days,
          {live("epoch(TIMESTAMP '2026-01-09 23:30:00')::BIGINT")} AS latest_review_s
        FROM (SELECT *, 10000 + space_id % 20 * 1000 AS base FROM page)""")
    C.add("page_unit", """
        SELECT *, space_id * 10 + i AS product_id, CASE WHEN i < 3 THEN 'TIME' ELSE 'DAY' END AS kind,
          CASE WHEN space_id % 2 = 0 THEN 'Y' ELSE 'N' END AS per_person
        FROM page, (SELECT unnest([1, 2, 3]) AS i) WHERE NOT is_gone""")
    put("load_units", """
        SELECT space_id, product_id, '룸 ' || i AS name, 10000 + space_id % 20 * 1000 + i * 500 AS price,
          kind AS rsv_tp_cd, per_person AS charging_per_person, space_id % 9 + i AS max_guest_capacity,
          2 AS min_guest_policy, NULLIF(space_id % 40 + i, 0) AS area_pyeong, 33.3::DOUBLE AS area_sqm
        FROM page_unit""")
    put("load_rates", """
        SELECT space_id, product_id, space_id * 100 + i * 10 AS rsv_type_id, kind AS rsv_tp_cd, 10000 AS price,
          CASE WHEN space_id % 3 = 0 THEN 'N' ELSE per_person END AS charging_per_person,
          4 AS person_ceiling, 'Y' AS extra_per_hour FROM page_unit""")
    put("load_tags", """
        SELECT space_id, tag, rank FROM page, (VALUES ('tag a', 1), ('tag b', 2)) t(tag, rank)
        WHERE NOT is_gone""")
    put("loaded_tags", """
        SELECT space_id, tag, rank FROM page, (VALUES ('tag a', 1), ('tag b', 2)) t(tag, rank)
        WHERE NOT is_gone""")
    put("loaded_venues", f"""
        SELECT space_id, '{DAY}' AS first_seen, '{AS_OF}' AS last_seen, is_gone,
          CASE WHEN is_gone THEN '{DAY}' END AS gone_at, {live('category')} AS category FROM page""")
    C.add("target", """
        SELECT space_id, product_id, space_id * 100 + i * 10 AS rsv_type_id, '룸 ' || i AS product_name,
          NULLIF(space_id % 40 + i, 0)::DOUBLE AS pyeong, space_id % 9 + i AS max_guest, 10000 AS price,
          'time' AS kind, year, month, sigungu, code
        FROM page_unit, (VALUES (2026, '12'), (2027, '01')) m(year, month) WHERE i < 3""")
    put("collection_targets", "SELECT * EXCLUDE (sigungu, code) FROM target WHERE code[1:2] = '11'")
    put("pending_targets", """
        SELECT * EXCLUDE (sigungu, code) FROM target WHERE NOT (sigungu = '고양시 일산동구' AND year = 2026)""")
    put("run_summary", f"""
        SELECT '{AS_OF}' AS run_date, (SELECT count(*) FROM orders) AS spaces_listed,
          count_if(NOT is_gone) AS spaces_ok, count_if(is_gone) AS spaces_gone, 0 AS spaces_failed,
          (SELECT count(*) FROM lineitem) AS reviews_seen FROM page""")
    five = "('촬영스튜디오', '연습실', '파티룸', '회의실', '공유주방')"
    C.add("crosstab", f"""
        SELECT sigungu, count_if(category = '연습실') AS practice, count_if(category = '파티룸') AS party,
          count_if(category = '회의실') AS meeting, count_if(category = '촬영스튜디오') AS studio,
          count_if(category = '공유주방') AS kitchen, count(*) AS total
        FROM page WHERE NOT is_gone AND category IN {five} GROUP BY ALL""")
    put("supply_crosstab", "FROM crosstab ORDER BY total DESC, sigungu LIMIT 15")
    put("supply_medians", f"""
        SELECT sigungu, category, n, {upper('p')}::DOUBLE AS price, {upper('a')}::DOUBLE AS pyeong
        FROM (SELECT sigungu, category, count(*) AS n,
                list_sort(list(10000 + space_id % 20 * 1000 + 1000)) AS p,
                list_sort(list(space_id % 40 * 3 + 6)) AS a
              FROM page JOIN (SELECT sigungu FROM crosstab ORDER BY total DESC, sigungu LIMIT 5) USING (sigungu)
              WHERE NOT is_gone AND category IN {five} GROUP BY ALL) WHERE n >= 5""")
    share = lambda source, c: f"""
        SELECT {c}, count(*) AS n, {ratio('count(*) * 100', f'(SELECT count(*) FROM {source})', 1)} AS share_pct
        FROM {source} GROUP BY {c}"""  # noqa: E731
    C.add("page_live", "SELECT *, addr.split(' ')[1] AS sido_raw FROM page WHERE NOT is_gone")
    put("category_share", share("page_live", "category"))
    put("region_share", share("page_live", "sido_raw") + " ORDER BY n DESC, sido_raw LIMIT 8")
    put("event_share", share("events", "event_type"))
    put("snapshot_medians", f"""
        SELECT category, n, {upper('m')}::DOUBLE AS months, {upper('r')}::DOUBLE AS reviews,
          ({upper('c')})::DOUBLE / 100.0 AS pace, {upper('p')}::DOUBLE AS price, {upper('a')}::DOUBLE AS pyeong
        FROM (SELECT category, count(*) AS n, {sorted_list('months')} AS m, {sorted_list('rv')} AS r,
                {sorted_list(units('rv', 'months', 2))} AS c,
                {sorted_list('10000 + space_id % 20 * 1000 + 1000')} AS p,
                {sorted_list('space_id % 40 * 3 + 6')} AS a
              FROM (SELECT *, space_id * 13 % 50 AS rv, greatest(1, ((DATE '{AS_OF}' - registered::DATE)::BIGINT
                      * 86400000 * 2 + 2630000000) // 5260000000) AS months FROM page_live)
              GROUP BY ALL)""")

    # --- write semantics ------------------------------------------------------------------
    C.add("two", f"""
        SELECT o.*, n.space_id IS NOT NULL AS matched, n.n_booked AS new_n, n.price AS new_price, false AS fresh
        FROM (FROM obs WHERE observed_date = DATE '{DAY}') o
        LEFT JOIN (FROM obs WHERE observed_date = DATE '{AS_OF}') n USING ({K3}, target_date)
        UNION ALL
        SELECT n.*, false, NULL, NULL, true FROM (FROM obs WHERE observed_date = DATE '{AS_OF}') n
        ANTI JOIN (FROM obs WHERE observed_date = DATE '{DAY}') o USING ({K3}, target_date)""")
    state = f"""{K3}, target_date::VARCHAR AS target_date, observed_date::VARCHAR AS observed_date,
        wday || CASE WHEN fresh THEN '!' ELSE '' END AS wday"""
    put("upsert_observations", f"""
        SELECT {state}, CASE WHEN matched THEN new_n ELSE n_booked END AS n_booked,
          CASE WHEN matched THEN new_price ELSE price END AS price FROM two""")
    put("insert_ignore", f"SELECT {state}, n_booked, price FROM two")
    put("upsert_mixed", """
        SELECT coalesce(s_suppkey, c_custkey) AS space_id, coalesce(c_name, s_name) AS name,
          coalesce(CASE WHEN c_acctbal >= 0 THEN c_name END, CASE WHEN s_acctbal >= 0 THEN s_name END) AS addr,
          coalesce(CASE WHEN s_acctbal < 0 THEN s_name END, CASE WHEN c_acctbal < 0 THEN c_name END) AS gone_at,
          coalesce(s_name, c_name) AS spc_tp_cd
        FROM supplier FULL JOIN customer ON s_suppkey = c_custkey""")
    put("upsert_partial", """
        SELECT space_id, product_id, 1 + space_id % 2 AS min_guest_policy, 8 AS max_guest_capacity FROM unit_""")
    put("replaced_partitions", """
        SELECT observed_date::VARCHAR AS observed_date, count(*) AS n, sum(booked_h)::BIGINT AS booked_hours
        FROM fill0 GROUP BY fill0.observed_date""")

    # --- generic --------------------------------------------------------------------------
    put("islands", f"SELECT {K3}, target_date::VARCHAR AS target_date, blk, h0, h1 FROM blk_day")
    put("same_rows", "SELECT 0::BIGINT AS only_left, 0::BIGINT AS only_right")
    put("open_hours_expanded", """
        SELECT space_id, observed_date::VARCHAR AS observed_date, open_h, booked_h FROM fill0""")
    put("stride_sample", """
        SELECT o_orderkey, o_custkey FROM (SELECT *, row_number() OVER (ORDER BY o_orderkey) - 1 AS pos FROM orders),
          (SELECT greatest(1, count(*) // 12) AS step FROM orders) WHERE pos % step = 0 AND pos // step < 12""")
    put("missing_days", f"""
        SELECT observed_date::VARCHAR AS day, false AS need_fill, true AS need_revenue, false AS need_settled
        FROM obs_day WHERE observed_date NOT IN (DATE '{DAY}', DATE '{AS_OF}')""")
    bounds = ", ".join(f"('{n}', {b}::DOUBLE, '{k}')" for n, (b, k) in RULES.items())
    measure = lambda table, name, agg, day="observed_date": (
        f"SELECT {day} AS day, '{name}' AS rule, ({agg})::DOUBLE AS value FROM {table} GROUP BY {day}"
    )
    parts = [
        measure("obs", "observation_venues", "count(DISTINCT space_id)"),
        measure("obs", "observation_rows", "count(*)"),
        measure("fill", "fill_venues", "count(DISTINCT space_id)"),
        measure("revenue", "revenue_venues", "count(DISTINCT space_id)"),
        f"SELECT DATE '{AS_OF}', 'settled_venues', count(DISTINCT space_id)::DOUBLE FROM settled_u",
        measure("events", "attempts_failed_share", ratio("count_if(event_type = 'error')", "count(*)", 4), "ts::DATE"),
        measure("events", "attempts_done_share", ratio("count_if(event_type <> 'error')", "count(*)", 4), "ts::DATE"),
    ]
    put("daily_expectations", f"""
        SELECT day::VARCHAR AS day, rule, value, bound,
          coalesce(CASE WHEN kind = 'min' THEN value >= bound ELSE value <= bound END, false) AS ok
        FROM (SELECT DISTINCT day FROM ({' UNION ALL '.join(parts)}))
        CROSS JOIN (VALUES {bounds}) r(rule, bound, kind)
        LEFT JOIN ({' UNION ALL '.join(parts)}) m USING (day, rule)""")
