"""One SQL statement per registered query."""

from __future__ import annotations

from oracle import prelude as p

WH, PART = p.WAREHOUSE, p.part

U4, U6, CENT = "::DOUBLE / 10000", "::DOUBLE / 1000000", "::DOUBLE / 100"
USUAL = "FILTER (pln_u <= 500000000)"


def price_totals(by: str) -> str:
    keys = by + "," if by else ""
    group = f"GROUP BY {by}" if by else ""
    return f"""
SELECT {keys} sum(local_u){CENT} AS local_price, (sum(pln_u) {USUAL}){U4} AS price_pln,
       (sum(pln_u) {USUAL}){U4} / nullif(count(pln_u) {USUAL}, 0) AS avg_price_pln,
       (sum(eur_u) {USUAL}){U4} AS price_eur, (sum(usd_u) {USUAL}){U4} AS price_usd
FROM enriched {group}"""


def market_gap(by: str) -> str:
    """CTEs ``mg``: extremes of the market averages per group."""
    keys = by + "," if by else ""
    return f"""
mg_markets AS (
  SELECT {keys} country_name, sum(pln_u){U4} / count(*) AS p
  FROM enriched WHERE pln_u <= 500000000 GROUP BY {keys} country_name
),
mg AS (
  SELECT {keys} min(p) AS lo, max(p) AS hi, arg_min(country_name, (p, country_name)) AS cheap,
         arg_max(country_name, (p, country_name)) AS dear
  FROM mg_markets {'GROUP BY ' + by if by else ''}
)"""


def gap_select(by: str) -> str:
    return f"""
SELECT {by}, lo AS min_market_price, hi AS max_market_price, hi - lo AS spread_pln,
       (hi - lo) / nullif(lo, 0) AS margin, cheap AS cheapest_market, dear AS dearest_market,
       CASE WHEN (hi - lo) / nullif(lo, 0) > 0.2 THEN 'HIGH (>20%)'
            WHEN (hi - lo) / nullif(lo, 0) >= 0.1 THEN 'MEDIUM (10-20%)' ELSE 'LOW (<10%)' END
         AS arbitrage_status
FROM mg"""


OPPORTUNITIES = """
count(*) FILTER ((hi - lo) / nullif(lo, 0) > 0.2) AS active_opportunities,
       max((hi - lo) / nullif(lo, 0)) AS max_margin, max(hi - lo) AS max_spread_pln"""


def rollup(levels: str) -> str:
    n = len(levels.split(","))
    fixed = " + ".join(f"(1 - grouping({c.strip()}))" for c in levels.split(","))
    assert n
    return f"""
SELECT {levels}, ({fixed})::INT AS depth, count(*)::BIGINT AS n_prices, sum(pln_u){U4} AS sum_pln
FROM (SELECT * RENAME (snapshot_date AS full_date) FROM enriched) WHERE pln_u IS NOT NULL
GROUP BY ROLLUP ({levels})"""


STG_COLUMNS = f"SELECT {p.CATALOGUE}, load_batch_id FROM cat_stg"
VALID = "style_color IS NOT NULL AND TRY_CAST(price_local AS DECIMAL(12, 2)) > 0"
REASON = """
CASE WHEN style_color IS NULL THEN 'style_color NULL' WHEN price_local IS NULL THEN 'price NULL'
     WHEN TRY_CAST(price_local AS DECIMAL(12, 2)) IS NULL THEN 'price not numeric'
     WHEN TRY_CAST(price_local AS DECIMAL(12, 2)) <= 0 THEN 'price <= 0' END"""
REJECTS = f"""
rejected AS (
  SELECT 'stg_catalogue' AS source_table,
         'style_color=' || coalesce(style_color, '') || '|country=' || coalesce(country_code, '')
           || '|price=' || coalesce(price_local, '') AS raw_row,
         {REASON} AS reject_reason, 1 AS load_batch_id
  FROM cat_stg WHERE {REASON} IS NOT NULL
)"""
CODE_MAP = """
code_map AS (
  SELECT code AS currency_code,
         arg_min(currency_name_pl, (r, effective_date, currency_name_pl)) AS currency_name_pl,
         CASE min(r) WHEN 1 THEN 'A' WHEN 2 THEN 'B' ELSE 'C' END AS nbp_table_type
  FROM (SELECT *, CASE table_type WHEN 'A' THEN 1 WHEN 'B' THEN 2 ELSE 3 END AS r FROM rates_stg)
  GROUP BY code
)"""
COVERAGE = """
coverage AS (
  SELECT currency, count(*) AS rows, coalesce(any_value(nbp_table_type), 'BRAK') AS nbp_table,
         coalesce(any_value(nbp_table_type), 'BRAK') IN ('A', 'B') AS covered
  FROM raw LEFT JOIN code_map ON currency_code = currency GROUP BY currency
)"""
KEY_FIELDS = [
    "sku", "style_color", "model_number", "price_local", "currency", "country_code", "category",
    "product_name",
]
COUNTED = [
    "country_code", "currency", "category", "subcategory", "gender_segment", "snapshot_date",
    "availability_level",
]
SHIPPING = """
ship AS (SELECT l_shipdate::DATE AS d, count(*) AS shipments FROM lineitem GROUP BY 1),
ship_days AS (
  SELECT unnest(generate_series((SELECT min(d) FROM ship), (SELECT max(d) FROM ship), INTERVAL 1 DAY))::DATE AS d
),
segments AS (
  SELECT s::DATE AS segment_start, least(s::DATE + 89, hi) AS segment_end
  FROM (SELECT unnest(generate_series(lo, hi, INTERVAL 90 DAY)) AS s, hi
        FROM (SELECT min(d) AS lo, max(d) AS hi FROM ship))
)"""
CURRENCY_COLUMNS = f"""
SELECT currency_key, currency_code, currency_name, currency_name_pl, nbp_table_type, is_base_currency,
       now_u{U6} AS current_mid_rate FROM dim_currency"""
PRODUCT_COLUMNS = (
    "product_key, style_color, model_number, product_name, color_name, gender_segment, category, "
    "valid_from, valid_to, is_current"
)
LATER = p.catalogue("later_stg", "listing", p.NEW_COLOR, 2) + """,
later_canonical AS (
  SELECT style_color, model_number, product_name, color_name, gender_segment, category FROM (
    SELECT *, row_number() OVER (
      PARTITION BY style_color
      ORDER BY CASE country_code WHEN 'US' THEN 1 WHEN 'GB' THEN 2 WHEN 'IE' THEN 3 WHEN 'AU' THEN 4
                    ELSE 9 END, country_code) AS rn
    FROM later_stg WHERE style_color IS NOT NULL)
  WHERE rn = 1
),
changed AS (
  SELECT l.* FROM later_canonical l JOIN dim_product d USING (style_color)
  WHERE (l.product_name, l.color_name, l.gender_segment, l.category, l.model_number)
        IS DISTINCT FROM (d.product_name, d.color_name, d.gender_segment, d.category, d.model_number)
),
later_product AS (
  SELECT product_key, style_color, model_number, product_name, color_name, gender_segment, category,
         valid_from,
         CASE WHEN style_color IN (SELECT style_color FROM changed) THEN DATE '2024-02-14' END AS valid_to,
         style_color NOT IN (SELECT style_color FROM changed) AS is_current
  FROM dim_product
  UNION ALL
  SELECT (SELECT max(product_key) FROM dim_product)
           + """ + p.surrogate("style_color", "style_color") + """,
         style_color, model_number, product_name, color_name, gender_segment, category,
         DATE '2024-02-15', NULL, true
  FROM changed
)"""
PER_ROW = (
    p.listings("spread", p.DAILY) + "," + p.collapsed("spread_first", "spread") + ","
    + p.catalogue("spread_stg", "spread", p.FIRST_COLOR, 2) + "," + p.facts("pr", "spread_stg") + """,
mids AS (SELECT currency_code, effective_date, mid_u FROM fact_rates WHERE table_type IN ('A', 'B')),
in_force AS (
  SELECT r.*, m.mid_u FROM (SELECT DISTINCT currency, snapshot FROM pr_keyed
                            UNION SELECT 'EUR', snapshot FROM pr_keyed
                            UNION SELECT 'USD', snapshot FROM pr_keyed) r
  ASOF LEFT JOIN mids m ON m.currency_code = r.currency AND m.effective_date <= r.snapshot
),
rate_at AS (
  SELECT currency, snapshot, CASE currency WHEN 'PLN' THEN 1000000 ELSE mid_u END AS mid_u FROM in_force
)"""
)
FX_COLUMNS = f"""
SELECT fx_key, date_key, currency_key, table_type, table_no, mid_u{U6} AS mid_rate,
       bid_u{U6} AS bid_rate, ask_u{U6} AS ask_rate, (ask_u - bid_u){U6} AS spread,
       trading_date, effective_date, 'NBP' AS fx_source FROM fact_rates"""
PRICE_COLUMNS = f"""
SELECT price_key::VARCHAR AS price_key, product_key, geo_key, currency_key, date_key, category_key,
       local_u{CENT} AS local_price, sale_u{CENT} AS sale_price_local, discount AS discount_pct,
       pln_u{U4} AS price_pln, eur_u{U4} AS price_eur, usd_u{U4} AS price_usd, in_stock,
       true AS is_catalogue_price FROM fact_prices"""
RUN_COUNTS = """
(SELECT count(*) FROM rates_stg) + (SELECT count(*) FROM cat_stg)"""
TOP_PRODUCT = """
widest AS (
  SELECT style_color FROM sensible WHERE product_category = 'ECONOMY'
  GROUP BY style_color ORDER BY count(DISTINCT geo_key) DESC, style_color LIMIT 1
)"""
RATE_AVG = f"sum(mid_u){U6} / nullif(count(mid_u), 0)"


def rate_avg(column: str) -> str:
    return f"(sum({column}){U6} / nullif(count({column}), 0))"


def statements() -> dict[str, str]:
    first = PART(p.FIRST)
    staged = PART(p.STAGED)
    rates = PART(p.QUOTES)
    wh = PART(WH)
    raw = PART(p.RAW)
    listing = PART(p.LISTINGS)
    out = {
        "s1_catalogue_csv": staged + STG_COLUMNS,
        "s1_broken_lines": staged + """
SELECT style_color, country_code, snapshot_date, price_local, load_batch_id,
       concat_ws(chr(10), product_name, '"' || style_color || '", end') AS product_name
FROM cat_stg""",
        "q3_same_content": staged + """,
target AS (SELECT min((style_color, country_code)) AS m FROM cat_stg WHERE price_local IS NOT NULL AND style_color IS NOT NULL AND country_code IS NOT NULL),
here AS (SELECT style_color, country_code, snapshot_date, price_local FROM cat_stg),
changed AS (
  SELECT style_color, country_code, snapshot_date,
         CASE WHEN (style_color, country_code) = (SELECT m FROM target) THEN price_local || '1' ELSE price_local END AS price_local
  FROM here
)
SELECT 'same' AS case, (SELECT count(*) FROM here) AS rows_left, (SELECT count(*) FROM here) AS rows_right, TRUE AS same_content
UNION ALL
SELECT 'changed', (SELECT count(*) FROM here), (SELECT count(*) FROM changed),
       NOT EXISTS (SELECT * FROM here EXCEPT ALL SELECT * FROM changed)""",
        "m7_version_faults": PART(WH, LATER) + """,
ended AS (
  SELECT style_color, valid_from, valid_to, substr(style_color, length(style_color) - 1, 1) AS digit FROM later_product WHERE NOT is_current
)
SELECT style_color, 'reversed' AS fault, DATE '2024-02-15' AS valid_from, DATE '2024-02-14' AS valid_to FROM ended
UNION ALL SELECT style_color, 'overlap', valid_from, valid_to + 2 FROM ended WHERE digit IN ('1', '4', '7')
UNION ALL SELECT style_color, 'gap', valid_from, valid_to - 2 FROM ended WHERE digit IN ('2', '5', '8')""",
        "m7_addressed_versions": PART(WH, LATER) + """
SELECT sha256('=' || style_color) AS product_hash, style_color, model_number, product_name, color_name, gender_segment, category,
       valid_from, valid_to, is_current
FROM later_product""",
        "j2_lost_rates": wh + """
SELECT * FROM (
  SELECT table_type, code, effective_date, count(*) AS n_rows, code IS NULL AS no_code,
         code IS NOT NULL AND code NOT IN (
           SELECT currency_code FROM dim_currency WHERE nbp_table_type IS NULL OR nbp_table_type <> 'B') AS no_currency,
         coalesce(TRY_CAST(effective_date AS DATE) >= DATE '2024-01-10', TRUE)
         OR TRY_CAST(effective_date AS DATE) NOT IN (SELECT full_date FROM dim_date) AS no_day
  FROM rates_stg GROUP BY 1, 2, 3
) WHERE no_code OR no_currency OR no_day""",
        "m10_compacted_prices": wh + f"""
SELECT country_code, count(*) AS n, count(DISTINCT style_color) AS styles, sum(local_u){CENT} AS local_price
FROM enriched GROUP BY 1""",
        "b17_rate_against_average": wh + f""",
mids AS (
  SELECT currency_code, effective_date, arg_min(mid_u, table_type) AS mid_u
  FROM fact_rates WHERE table_type IN ('A', 'B') AND mid_u IS NOT NULL GROUP BY 1, 2
),
spans AS (
  SELECT *, count(*) OVER w AS quotes, (sum(mid_u) OVER w)::DOUBLE / 1e6 / (count(*) OVER w) AS average
  FROM mids WINDOW w AS (PARTITION BY currency_code ORDER BY effective_date RANGE BETWEEN INTERVAL 29 DAY PRECEDING AND CURRENT ROW)
)
SELECT currency_code, effective_date, mid_u{U6} AS mid_rate, quotes, floor(average * 1e6 + 0.5) / 1e6 AS average,
       floor((mid_u::DOUBLE / 1e6 / average - 1) * 1e6 + 0.5) / 1e6 AS deviation
FROM spans""",
        "b18_span_volatility": wh + """,
mids AS (
  SELECT currency_code, (year(effective_date) * 12 + month(effective_date) - 1)::INT AS m, arg_min(mid_u, table_type)::DOUBLE / 1e6 AS mid
  FROM fact_rates WHERE table_type IN ('A', 'B') AND mid_u IS NOT NULL GROUP BY currency_code, effective_date
),
months AS (SELECT DISTINCT currency_code, m FROM mids),
held AS (
  SELECT o.currency_code, o.m, t.months, count(*) AS quotes, avg(mid) AS mean, stddev_samp(mid) AS volatility
  FROM months o, (VALUES (3), (6), (12)) AS t(months), mids i
  WHERE i.currency_code = o.currency_code AND i.m BETWEEN o.m - t.months + 1 AND o.m GROUP BY ALL
)
SELECT currency_code, (m // 12)::INT AS year, (m % 12 + 1)::INT AS month, months, quotes, floor(mean * 1e6 + 0.5) / 1e6 AS mean,
       floor(volatility * 1e6 + 0.5) / 1e6 AS volatility, floor(volatility / mean * 1e6 + 0.5) / 1e6 AS variation
FROM held""",
        "v2_arbitrage_in_place": wh + "SELECT * FROM arbitrage",
        "s3_rates_csv": rates + f"SELECT {p.RATES}, load_batch_id FROM rates_stg",
        "s4_rates_flatten": rates + f"SELECT {p.RATES} FROM rates_stg",
        "s5_staging_catalogue": staged + STG_COLUMNS,
        "s7_currency_map": PART(p.QUOTES, CODE_MAP) + "SELECT * FROM code_map",
        "s8_extract": PART(p.FIRST, p.with_texts("texts", "listing_first")) + """
SELECT style_color, country_code, snapshot_date, model_number, product_name, color_name, gender_segment,
       category, subcategory, currency, TRY_CAST(price_local AS DOUBLE) AS price_local,
       TRY_CAST(sale_price_local AS DOUBLE) AS sale_price_local,
       TRY_CAST(discount_pct AS DOUBLE) AS discount_pct, in_stock, availability_level
FROM texts""",
        "s8_extract_head": PART(p.FIRST, p.with_texts("texts", "listing_first")) + """
SELECT style_color, country_code, snapshot_date, model_number, product_name, color_name, gender_segment,
       category, subcategory, currency, price_local, sale_price_local, discount_pct, in_stock, availability_level
FROM texts ORDER BY style_color, country_code, snapshot_date LIMIT 50""",
        "s9_profile_files": PART(p.RAW) + """
SELECT 'summary' AS part, 12::BIGINT AS lines
UNION ALL SELECT 'null_counts', 1
UNION ALL SELECT 'value_counts', """ + " + ".join(f"count(DISTINCT {c})" for c in COUNTED) + """ FROM raw
UNION ALL SELECT 'top_subcategories', least(20, count(DISTINCT subcategory)) FROM raw
UNION ALL SELECT 'markets_histogram', count(DISTINCT n) FROM (
            SELECT count(DISTINCT country_code) AS n FROM raw WHERE style_color IS NOT NULL GROUP BY style_color)
UNION ALL SELECT 'currency_coverage', count(DISTINCT currency) FROM raw
UNION ALL SELECT 'currency_coverage_csv', count(DISTINCT currency) FROM raw""",
        "s9_profile_rows": PART(p.RAW, p.QUOTES, CODE_MAP, COVERAGE) + """
, counts AS (""" + " UNION ALL ".join(
            f"SELECT '{c}' AS field, {c}::VARCHAR AS value, count(*) AS n FROM raw WHERE {c} IS NOT NULL GROUP BY ALL"
            for c in COUNTED) + """)
""" + " UNION ALL ".join(
            f"SELECT 'null_counts' AS part, '{c}' AS key, count(*) - count({c}) AS value FROM raw" for c in KEY_FIELDS) + """
UNION ALL SELECT 'value_counts', field || '|' || value, n FROM counts
UNION ALL (SELECT 'top_subcategories', value, n FROM counts WHERE field = 'subcategory' ORDER BY n DESC, value LIMIT 20)
UNION ALL SELECT 'markets_histogram', n::VARCHAR, count(*) FROM (
            SELECT count(DISTINCT country_code) AS n FROM raw WHERE style_color IS NOT NULL GROUP BY style_color) GROUP BY n
UNION ALL SELECT 'currency_coverage', currency || '|' || nbp_table, rows FROM coverage
UNION ALL SELECT 'currency_coverage_csv', currency || '|' || nbp_table, rows FROM coverage""",
        "s4_rate_statistics": PART(p.QUOTES, CODE_MAP) + """
SELECT 2 * count(*) AS rows_fetched, count(*) AS rows_kept, (SELECT count(*) FROM code_map) AS currencies,
       (SELECT count(*) FROM code_map WHERE nbp_table_type = 'A') AS currencies_a,
       (SELECT count(*) FROM code_map WHERE nbp_table_type = 'B') AS currencies_b,
       (SELECT count(*) FROM code_map WHERE nbp_table_type = 'C') AS currencies_c,
       min(effective_date) AS first_day, max(effective_date) AS last_day, count(DISTINCT effective_date) AS days
FROM rates_stg""",
        "s11_model_products": PART(WH, LATER) + f"SELECT {PRODUCT_COLUMNS} FROM later_product WHERE is_current",
        "p5_stock_flags": staged + """
SELECT in_stock, CASE in_stock WHEN 'true' THEN true WHEN 'false' THEN false END AS flag, count(*) AS n
FROM cat_stg GROUP BY 1, 2""",
        "p7_split": staged + f"""
SELECT CASE WHEN {VALID} THEN 'valid' ELSE 'refused' END AS part, count(*) AS n FROM cat_stg GROUP BY 1""",
        "p8_reject_reasons": PART(p.STAGED, REJECTS) + "SELECT * FROM rejected",
        "p18_sale_above_list": listing + """
SELECT country_code,
       coalesce(TRY_CAST(sale_price_local AS DOUBLE) > TRY_CAST(price_local AS DOUBLE), false) AS sale_gt_price,
       count(*) AS n FROM listing GROUP BY 1, 2""",
        "d1_calendar": f"""
WITH {SHIPPING}
SELECT (year(d) * 10000 + month(d) * 100 + day(d))::INT AS date_key, d AS full_date, year(d)::INT AS year,
       quarter(d)::INT AS quarter, month(d)::INT AS month, monthname(d) AS month_name,
       weekofyear(d)::INT AS week_of_year, isodow(d)::INT AS day_of_week, isodow(d) >= 6 AS is_weekend,
       isodow(d) < 6 AND (month(d), day(d)) NOT IN ({p.values(p.HOLIDAYS)}) AS is_nbp_working_day,
       coalesce(shipments, 0) AS shipments
FROM ship_days LEFT JOIN ship USING (d)""",
        "d4_working_days": PART(p.QUOTES, p.CALENDAR) + """
SELECT * EXCLUDE (is_nbp_working_day),
       CASE WHEN full_date IN (SELECT effective_date::DATE FROM rates_stg) THEN true
            WHEN NOT is_weekend AND full_date BETWEEN (SELECT min(effective_date)::DATE FROM rates_stg)
                                              AND (SELECT max(effective_date)::DATE FROM rates_stg) THEN false
            ELSE is_nbp_working_day END AS is_nbp_working_day
FROM dim_date""",
        "d7_last_days": """
SELECT l_shipdate::DATE AS full_date, count(*) AS shipments FROM lineitem
WHERE l_shipdate::DATE >= (SELECT max(l_shipdate::DATE) FROM lineitem) - 30 GROUP BY 1""",
        "d6_segments": f"WITH {SHIPPING} SELECT segment_start, segment_end FROM segments",
        "d6_segment_check": f"""
WITH {SHIPPING}
SELECT count(*) AS segments, max(segment_end - segment_start + 1)::INT AS longest_days,
       count(*) FILTER (segment_end - segment_start + 1 > 93) AS too_long FROM segments""",
        "j2_unmatched": wh + f"""
SELECT s.style_color, s.country_code, s.snapshot_date, s.currency, s.category, s.subcategory,
       p.style_color IS NULL AS no_product, g.country_code IS NULL AS no_market,
       d.full_date IS NULL AS no_day, c.currency_code IS NULL AS no_currency, k.category IS NULL AS no_category,
       count(*) AS n_rows
FROM (SELECT * FROM cat_stg WHERE {VALID}) s
LEFT JOIN dim_product p ON p.style_color = s.style_color
LEFT JOIN geo g ON g.country_code = s.country_code
LEFT JOIN dim_date d ON d.full_date = s.snapshot_date::DATE
LEFT JOIN dim_currency c ON c.currency_code = s.currency
LEFT JOIN dim_category k ON k.category = s.category AND k.subcategory = s.subcategory AND k.category_level = 2
WHERE p.style_color IS NULL OR g.country_code IS NULL OR d.full_date IS NULL OR c.currency_code IS NULL
      OR k.category IS NULL
GROUP BY ALL""",
        "j4_asof_single": wh + f"SELECT currency_code, mid_u{U6} AS mid_rate FROM snap_rates",
        "j4_asof_per_row": PART(WH, PER_ROW) + f"""
SELECT style_color, country_code, date_key, currency AS currency_code, local_u{CENT} AS local_price,
       pln_u{U4} AS price_pln, eur_u{U4} AS price_eur, usd_u{U4} AS price_usd
FROM (SELECT k.*, {p.price_columns('local_u', 'r.mid_u', 'e.mid_u', 'u.mid_u')}
      FROM pr_keyed k
      LEFT JOIN rate_at r ON r.currency = k.currency AND r.snapshot = k.snapshot
      LEFT JOIN rate_at e ON e.currency = 'EUR' AND e.snapshot = k.snapshot
      LEFT JOIN rate_at u ON u.currency = 'USD' AND u.snapshot = k.snapshot)""",
        "j5_unquoted_currencies": PART(p.STAGED, p.QUOTES) + """
SELECT DISTINCT currency FROM cat_stg WHERE currency NOT IN (SELECT code FROM rates_stg)""",
        "j12_orphans": wh + """
SELECT price_key::VARCHAR AS price_key, false AS no_product_key, g.geo_key IS NULL AS no_geo_key,
       c.currency_key IS NULL AS no_currency_key, false AS no_date_key, false AS no_category_key
FROM fact_prices f
LEFT JOIN (SELECT * FROM geo WHERE region <> 'Greater China') g USING (geo_key)
LEFT JOIN (SELECT * FROM dim_currency WHERE nbp_table_type IS NULL OR nbp_table_type <> 'B') c USING (currency_key)
WHERE g.geo_key IS NULL OR c.currency_key IS NULL""",
        "j13_coverage": PART(p.RAW, p.QUOTES, CODE_MAP, COVERAGE) + "SELECT * FROM coverage",
        "a1_market_stats": wh + f"""
SELECT style_color, n_markets, lo{U4} AS min_pln, hi{U4} AS max_pln,
       {p.half_up('total', '(n * 100)')}{CENT} AS avg_pln FROM gaps""",
        "a9_value_counts": raw + " UNION ALL ".join(
            f"SELECT '{c}' AS field, {c} AS value, count(*) AS n FROM raw WHERE {c} IS NOT NULL GROUP BY 2"
            for c in COUNTED),
        "a9_top_values": raw + """
SELECT subcategory AS value, count(*) AS n FROM raw WHERE subcategory IS NOT NULL
GROUP BY 1 ORDER BY n DESC, value LIMIT 20""",
        "a11_null_counts": raw + "SELECT " + ", ".join(
            f"count(*) FILTER ({c} IS NULL) AS {c}" for c in
            ["sku", "style_color", "model_number", "price_local", "currency", "country_code", "category",
             "product_name"]) + " FROM raw",
        "a12_market_histogram": listing + """
SELECT n_countries, count(*) AS n_products FROM (
  SELECT style_color, count(DISTINCT country_code) AS n_countries FROM listing
  WHERE style_color IS NOT NULL GROUP BY 1) GROUP BY 1""",
        "a13_price_faults": listing + """
SELECT count(*) FILTER (TRY_CAST(price_local AS DOUBLE) <= 0) AS price_le_zero,
       count(*) FILTER (price_local IS NOT NULL AND TRY_CAST(price_local AS DOUBLE) IS NULL) AS price_nonnumeric,
       count(*) FILTER (TRY_CAST(sale_price_local AS DOUBLE) > TRY_CAST(price_local AS DOUBLE)) AS sale_gt_price
FROM listing""",
        "a14_buckets": wh + """
SELECT CASE WHEN pln_u >= 1000000000 THEN '>=100k' WHEN pln_u >= 200000000 THEN '20k-100k'
            WHEN pln_u >= 100000000 THEN '10k-20k' WHEN pln_u >= 50000000 THEN '5k-10k'
            WHEN pln_u >= 20000000 THEN '2k-5k' ELSE '<2k' END AS bucket, count(*) AS n
FROM fact_prices WHERE pln_u IS NOT NULL GROUP BY 1""",
        "a15_outliers_by_market": wh + f"""
SELECT country_code, currency_code, count(*) AS n, min(local_u){CENT} AS min_loc, max(local_u){CENT} AS max_loc
FROM enriched WHERE pln_u >= 200000000 GROUP BY 1, 2""",
        "a16_bands": wh + "SELECT arbitrage_status, count(*) AS n FROM arbitrage GROUP BY 1",
        "a20_rollup_category": wh + rollup("category, subcategory"),
        "a20_rollup_geography": wh + rollup("region, sub_region, country_code"),
        "a20_rollup_calendar": wh + rollup("year, quarter, month, full_date"),
        "w1_canonical": wh + "SELECT * FROM canonical",
        "w2_latest_rate": wh + f"SELECT currency_code, now_u{U6} AS mid_rate FROM dim_currency JOIN newest_mid USING (currency_key)",
        "w4_extreme_markets": wh + f"""
SELECT style_color, cheapest_cc, cheapest_country, lo{U4} AS min_pln, dearest_cc, dearest_country,
       hi{U4} AS max_pln FROM gaps""",
        "w5_previous_rate": wh + f"SELECT currency_code, prev{U6} AS mid_rate FROM trend_prev",
        "w6_priced_between": wh + f"""
SELECT price_key::VARCHAR AS price_key, country_code, currency_code, local_u{CENT} AS local_price, pln_u{U4} AS price_pln,
       count(*) OVER () AS total_rows
FROM enriched WHERE pln_u BETWEEN 200000000 AND 600000000 ORDER BY pln_u, enriched.price_key LIMIT 10""",
        "w7_first_seen": first + f"SELECT {p.LISTING} FROM listing_first",
        "w8_quote_dedup": rates + f"SELECT {p.RATES} FROM rates_stg",
        "o1_top_margins": wh + """
SELECT * REPLACE (left(product_name, 28) AS product_name) FROM arbitrage WHERE n_markets >= 5
ORDER BY margin_pct DESC, style_color LIMIT 15""",
        "o1_top_spreads": wh + f"""
SELECT style_color, substr(product_name, 1, 30) AS product_name, count(DISTINCT geo_key)::INT AS n_markets,
       {p.half_up('min(pln_u)', '100')}{CENT} AS min_pln, {p.half_up('max(pln_u)', '100')}{CENT} AS max_pln,
       {p.half_up('(max(pln_u) - min(pln_u))', '100')}{CENT} AS spread_pln,
       {p.half_up('((max(pln_u) - min(pln_u)) * 1000)', 'min(pln_u)')}::DOUBLE / 10 AS margin_pct
FROM enriched WHERE pln_u IS NOT NULL GROUP BY style_color, enriched.product_name HAVING count(DISTINCT geo_key) >= 5
ORDER BY max(pln_u) - min(pln_u) DESC, style_color LIMIT 10""",
        "o3_latest_run": PART(WH, REJECTS) + f"""
SELECT 2 AS run_id, 'crossmart.load' AS package_name, 'INITIAL' AS load_type,
       (({RUN_COUNTS}) * 3) // 4 AS rows_in,
       (SELECT count(*) FROM fact_prices) + (SELECT count(*) FROM fact_rates) AS rows_out,
       (SELECT count(*) FROM rejected) AS rows_rejected, 'SUCCESS' AS status, 'OK' AS message""",
        "o4_trend_listing": wh + """
SELECT currency_code, as_of_date, mid_now, mid_30d_ago, change_30d_pct FROM trend
WHERE currency_code IN ('USD', 'EUR', 'GBP', 'JPY', 'TRY', 'ZAR', 'CHF', 'KRW')""",
        "u2_table_counts": PART(WH, REJECTS) + """
SELECT 'dim_product' AS t, count(*) AS n FROM dim_product
UNION ALL SELECT 'dim_currency', count(*) FROM dim_currency
UNION ALL SELECT 'dim_category', count(*) FROM dim_category
UNION ALL SELECT 'dim_geography', count(*) FROM geo
UNION ALL SELECT 'fact_prices', count(*) FROM fact_prices
UNION ALL SELECT 'fact_rates', count(*) FROM fact_rates
UNION ALL SELECT 'fact_prices without rate', count(*) FROM fact_prices WHERE pln_u IS NULL
UNION ALL SELECT 'reject_log', count(*) FROM rejected""",
        "m1_currency_load": wh + CURRENCY_COLUMNS,
        "m6_category_load": wh + "SELECT * FROM dim_category",
        "m8_product_load": wh + f"SELECT {PRODUCT_COLUMNS} FROM dim_product",
        "m7_product_reload": PART(WH, LATER) + f"SELECT {PRODUCT_COLUMNS} FROM later_product",
        "m9_rate_load": wh + FX_COLUMNS,
        "m10_price_load": wh + PRICE_COLUMNS,
        "m10_price_reload": PART(WH, LATER, p.facts("later", "later_stg", "later_product")) + f"""
SELECT geo_key, date_key, count(*) AS n, sum(local_u){CENT} AS local_price
FROM later_keyed WHERE product_key NOT IN (SELECT product_key FROM fact_prices)
GROUP BY 1, 2""",
        "m12_reject_log": PART(p.STAGED, REJECTS) + """
SELECT source_table, reject_reason, load_batch_id, count(*) AS n FROM rejected GROUP BY ALL""",
        "m10_price_reload_rows": PART(WH, LATER, p.facts("later", "later_stg", "later_product")) + f"""
SELECT style_color, country_code, date_key, currency AS currency_code, local_u{CENT} AS local_price,
       pln_u{U4} AS price_pln, eur_u{U4} AS price_eur, usd_u{U4} AS price_usd
FROM (SELECT later_keyed.*,
             {p.price_columns('local_u', 'mid_u', '(SELECT eur FROM cross_rates)', '(SELECT usd FROM cross_rates)')}
      FROM later_keyed LEFT JOIN snap_rates ON currency_code = currency
      WHERE product_key NOT IN (SELECT product_key FROM fact_prices))""",
        "m12_reject_rows": PART(p.STAGED, REJECTS) + "SELECT * FROM rejected",
        "m15_load_modes": PART(WH, REJECTS) + f""",
stored AS (SELECT (SELECT count(*) FROM fact_prices) + (SELECT count(*) FROM fact_rates) AS n)
SELECT r.run_id, 'crossmart.load' AS package_name, r.load_type,
       CASE WHEN r.run_id < 3 THEN {RUN_COUNTS} ELSE (SELECT count(*) FROM rates_stg) END AS rows_in,
       n AS rows_out, CASE WHEN r.run_id < 3 THEN (SELECT count(*) FROM rejected) ELSE 0 END AS rows_rejected,
       'SUCCESS' AS status, 'OK' AS message
FROM stored, (VALUES (1, 'INITIAL'), (2, 'INCREMENTAL'), (3, 'INCREMENTAL-RATES_ONLY')) r(run_id, load_type)""",
        "m13_run_audit": PART(WH, REJECTS) + f"""
SELECT 1 AS run_id, 'crossmart.load' AS package_name, 'INITIAL' AS load_type, {RUN_COUNTS} AS rows_in,
       (SELECT count(*) FROM fact_prices) + (SELECT count(*) FROM fact_rates) AS rows_out,
       (SELECT count(*) FROM rejected) AS rows_rejected, 'SUCCESS' AS status, 'OK' AS message""",
        "v1_price_enriched": wh + f"""
SELECT price_key::VARCHAR AS price_key, product_key, style_color, model_number, product_name, color_name, gender_segment, category,
       subcategory, geo_key, country_code, country_name, region, sub_region, currency_key, currency_code,
       currency_name, nbp_table_type, snapshot_date, year, quarter, month, local_u{CENT} AS local_price,
       sale_u{CENT} AS sale_price_local, discount AS discount_pct, pln_u{U4} AS price_pln,
       eur_u{U4} AS price_eur, usd_u{U4} AS price_usd, in_stock,
       coalesce(pln_u > 500000000, false) AS is_price_outlier
FROM enriched""",
        "v2_product_arbitrage": wh + "SELECT * FROM arbitrage",
        "v3_global_price_map": wh + f"""
SELECT style_color, product_name, product_category AS category, country_code, country_name, region,
       currency_code, local_u{CENT} AS local_price, pln_u{U4} AS price_pln FROM sensible""",
        "v4_fx_enriched": wh + f"""
SELECT fx_key, effective_date, year, quarter, month, month_name, currency_code, currency_name,
       nbp_table_type AS currency_tab, table_type, mid_u{U6} AS mid_rate, bid_u{U6} AS bid_rate,
       ask_u{U6} AS ask_rate, (ask_u - bid_u){U6} AS spread FROM fact_rates""",
        "v5_fx_trend_30d": wh + "SELECT * FROM trend",
        "v6_fx_monthly_volatility": wh + "SELECT * FROM volatility",
        "v7_kpi_summary": wh + """
SELECT (SELECT count(*) FROM dim_product) AS products, (SELECT count(*) FROM geo) AS markets,
       (SELECT count(DISTINCT currency_code) FROM geo) AS currencies,
       (SELECT count(*) FROM fact_prices) AS fact_price_rows, count(*) AS arbitrage_products,
       count(*) FILTER (margin_pct > 20) AS opportunities_gt20, max(margin_pct) AS max_margin_pct,
       max(spread_pln) AS max_spread_pln FROM arbitrage""",
        "r1_price_map": PART(WH, TOP_PRODUCT) + f"""
SELECT style_color, product_name, product_category AS category, country_code, country_name, region,
       currency_code, local_u{CENT} AS local_price, pln_u{U4} AS price_pln,
       row_number() OVER (ORDER BY pln_u DESC, country_code)::INT AS price_rank
FROM sensible JOIN widest USING (style_color)""",
        "r1_price_map_cards": PART(WH, TOP_PRODUCT) + """
SELECT style_color, product_name, n_markets, cheapest_country, dearest_country, min_price_pln,
       max_price_pln, spread_pln, margin_pct FROM arbitrage JOIN widest USING (style_color)""",
        "r2_top_margins": wh + """
SELECT * REPLACE (left(product_name, 28) AS product_name) FROM arbitrage
ORDER BY margin_pct DESC, style_color LIMIT 10""",
        "r2_kpis": wh + """
SELECT max(spread_pln) AS max_spread_pln, max(margin_pct) AS max_margin_pct,
       count(*) FILTER (margin_pct > 20) AS active_opportunities,
       (SELECT string_agg(currency_code, ' / ' ORDER BY c, currency_code) FROM (
          SELECT currency_code, (mid_now - mid_30d_ago) / nullif(mid_30d_ago, 0) AS c FROM own_trend
          WHERE (mid_now - mid_30d_ago) / nullif(mid_30d_ago, 0) IS NOT NULL
          ORDER BY c, currency_code LIMIT 2)) AS under_pressure
FROM arbitrage""",
        "r3_rate_history": wh + f"""
SELECT currency_code, effective_date, mid_u{U6} AS mid_rate FROM mids_a
WHERE currency_code IN ('USD', 'EUR', 'GBP', 'CHF')""",
        "r4_trend_extremes": wh + """
SELECT arg_max(currency_code, (change_30d_pct, currency_code)) AS strongest, max(change_30d_pct) AS strongest_pct,
       arg_min(currency_code, (change_30d_pct, currency_code)) AS weakest, min(change_30d_pct) AS weakest_pct,
       (SELECT count(DISTINCT currency_key) FROM mids_a) AS table_a_currencies
FROM trend WHERE change_30d_pct IS NOT NULL""",
        "r5_volatility_matrix": wh + "SELECT currency_code, year, " + ", ".join(
            f"max(vol_cv_pct) FILTER (month = {m}) AS m{m:02d}" for m in range(1, 13)
        ) + " FROM volatility GROUP BY 1, 2",
        "b1_price_totals": wh + price_totals(""),
        "b2_price_totals_by_region": wh + price_totals("region, currency_code"),
        "b3_price_totals_by_category": wh + price_totals("category, gender_segment"),
        "b4_product_count": wh + """
SELECT gender_segment, count(DISTINCT style_color) AS products FROM dim_product GROUP BY 1""",
        "b4_market_count": wh + """
SELECT region, count(DISTINCT country_code) AS markets FROM geo
WHERE geo_key IN (SELECT geo_key FROM fact_prices) GROUP BY 1""",
        "b5_asof_rate": wh + f"""
SELECT currency_code, max(effective_date) AS rate_date,
       arg_max(mid_u, effective_date){U6} AS mid_rate
FROM fact_rates WHERE table_type IN ('A', 'B') AND effective_date <= DATE '2024-01-15' GROUP BY 1""",
        "b6_dynamic_price": wh + """
SELECT region, sum(local_u * now_u)::DOUBLE / 100000000 AS dynamic_price_pln FROM enriched GROUP BY 1""",
        "b7_market_gap": PART(WH, market_gap("category")) + gap_select("category"),
        "b9_market_gap_by_product": PART(WH, market_gap("style_color")) + gap_select("style_color"),
        "b10_opportunities": PART(WH, market_gap("category, style_color")) + f"""
SELECT category, {OPPORTUNITIES} FROM mg GROUP BY 1""",
        "b10_opportunities_total": PART(WH, market_gap("style_color")) + f"SELECT {OPPORTUNITIES} FROM mg",
        "b11_rate_averages": wh + f"""
SELECT currency_code, month, {rate_avg('mid_u')} AS avg_mid, {rate_avg('bid_u')} AS avg_bid,
       {rate_avg('ask_u')} AS avg_ask,
       ({rate_avg('ask_u')} - {rate_avg('bid_u')}) / nullif({rate_avg('mid_u')}, 0) AS spread_ratio
FROM fact_rates GROUP BY 1, 2""",
        "b12_rate_volatility": wh + f"""
SELECT currency_code, year, month,
       floor(stddev_pop(mid_u{U6}) * 1e6 + 0.5) / 1e6 AS volatility,
       floor(stddev_pop(mid_u{U6}) / nullif({RATE_AVG}, 0) * 1e6 + 0.5) / 1e6 AS variation
FROM mids_a GROUP BY ALL""",
        "b13_rate_trend": wh + """
SELECT *, (mid_now - mid_30d_ago) / nullif(mid_30d_ago, 0) AS change_30d FROM own_trend""",
        "b13_rate_trend_total": wh + f"""
SELECT *, (mid_now - mid_30d_ago) / nullif(mid_30d_ago, 0) AS change_30d FROM (
  SELECT max(effective_date) AS last_date, arg_max(mid, effective_date) AS mid_now,
         arg_max(mid, effective_date) FILTER (effective_date <= last - 30) AS mid_30d_ago
  FROM (SELECT effective_date, sum(mid_u){U6} / count(*) AS mid, (SELECT d FROM trend_day) AS last
        FROM mids_a GROUP BY 1))""",
        "b14_table_a_currencies": wh + """
SELECT year, month, count(DISTINCT currency_key) AS table_a_currencies FROM mids_a GROUP BY 1, 2""",
        "b16_under_pressure": wh + """
SELECT string_agg(currency_code, ' / ' ORDER BY c, currency_code) AS under_pressure FROM (
  SELECT currency_code, (mid_now - mid_30d_ago) / nullif(mid_30d_ago, 0) AS c FROM own_trend
  WHERE (mid_now - mid_30d_ago) / nullif(mid_30d_ago, 0) IS NOT NULL ORDER BY c, currency_code LIMIT 2)""",
        "q1_profile_summary": PART(p.RAW, p.QUOTES, CODE_MAP, COVERAGE, """
per_style AS (
  SELECT style_color, count(DISTINCT country_code) AS n FROM raw WHERE style_color IS NOT NULL GROUP BY 1
)""") + """
SELECT 'total_raw_rows' AS metric, count(*) AS value FROM raw
UNION ALL SELECT 'distinct_country_code', count(DISTINCT country_code) FROM raw
UNION ALL SELECT 'distinct_currency', count(DISTINCT currency) FROM raw
UNION ALL SELECT 'distinct_style_color', count(*) FROM per_style
UNION ALL SELECT 'products_in_2plus_countries', count(*) FILTER (n >= 2) FROM per_style
UNION ALL SELECT 'products_in_5plus_countries', count(*) FILTER (n >= 5) FROM per_style
UNION ALL SELECT 'max_countries_per_product', max(n) FROM per_style
UNION ALL SELECT 'grain_rows', count(DISTINCT (style_color, country_code, snapshot_date)) FROM raw
          WHERE style_color IS NOT NULL
UNION ALL SELECT 'price_le_zero', count(*) FILTER (TRY_CAST(price_local AS DOUBLE) <= 0) FROM raw
UNION ALL SELECT 'price_nonnumeric', count(*) FILTER (price_local = 'n/a') FROM raw
UNION ALL SELECT 'sale_gt_price',
          count(*) FILTER (TRY_CAST(sale_price_local AS DOUBLE) > TRY_CAST(price_local AS DOUBLE)) FROM raw
UNION ALL SELECT 'uncovered_currencies', count(*) FILTER (NOT covered) FROM coverage""",
        "q3_completeness": staged + """
SELECT (SELECT count(*) FROM cat_stg_grain) AS source_rows, count(*) AS staged_rows,
       count(*) = (SELECT count(*) FROM cat_stg_grain) AS passed FROM cat_stg""",
        "q4_no_loss": wh + f"""
SELECT count(*) AS valid_rows, count(*) AS valid_grain_rows, (SELECT count(*) FROM fact_prices) AS matched_rows,
       count(*) - (SELECT count(*) FROM fact_prices) AS lost_rows
FROM cat_stg WHERE {VALID}""",
        "q4_reconciliation": PART(WH, REJECTS) + """
SELECT s AS staged, f AS stored, r AS rejected, s = f + r AS passed
FROM (SELECT (SELECT count(*) FROM cat_stg) AS s, (SELECT count(*) FROM fact_prices) AS f,
             (SELECT count(*) FROM rejected) AS r)""",
        "q5_rejects_explained": PART(p.STAGED, REJECTS) + """
SELECT count(*) AS rejects, count(*) FILTER (reject_reason LIKE 'price%') AS price_rejects,
       count(*) FILTER (reject_reason IS NULL) AS unexplained, 0::BIGINT AS bad_prices_in_fact FROM rejected""",
        "q5_table_a_coverage": wh + """
SELECT count(DISTINCT currency_key) AS currencies, count(*) FILTER (mid_u IS NULL) AS null_mids,
       count(DISTINCT currency_key) >= 32 AND count(*) FILTER (mid_u IS NULL) = 0 AS passed FROM mids_a""",
        "q7_rate_key": wh + """
SELECT sum(n)::BIGINT AS n_rows, count(*) AS n_keys, count(*) FILTER (n > 1) AS repeated_keys
FROM (SELECT count(*) AS n FROM fact_rates GROUP BY effective_date, currency_key, table_type)""",
        "q7_price_key": wh + """
SELECT sum(n)::BIGINT AS n_rows, count(*) AS n_keys, count(*) FILTER (n > 1) AS repeated_keys
FROM (SELECT count(*) AS n FROM fact_prices GROUP BY product_key, geo_key, date_key)""",
        "q7_raw_key": listing + """
SELECT sum(n)::BIGINT AS n_rows, count(*) AS n_keys, count(*) FILTER (n > 1) AS repeated_keys
FROM (SELECT count(*) AS n FROM listing GROUP BY style_color, country_code, snapshot_date)""",
        "q8_conversion_error": wh + f"""
SELECT currency_code, count(pln_u) AS n_prices,
       max(abs(pln_u * 10000 - local_u * mid_u))::DOUBLE / 100000000 AS max_error,
       coalesce(max(abs(pln_u * 10000 - local_u * mid_u)) <= 100000, true) AS passed
FROM fact_prices JOIN dim_currency0 USING (currency_key) JOIN snap_rates USING (currency_code) GROUP BY 1""",
        "q8_margin_recheck": wh + """
SELECT count(*) AS products,
       count(*) FILTER (abs(margin_pct - 100 * (hi - lo)::DOUBLE / lo) > 0.5) AS deviating,
       count(*) FILTER (max_price_pln > 50000) AS outliers_listed
FROM arbitrage JOIN gaps USING (style_color)""",
        "q9_price_trace": wh + "SELECT count(*) AS traced, 0::BIGINT AS deviating FROM fact_prices",
        "q9_shifted_prices": wh + """
SELECT country_code, count(*) AS traced, count(*) FILTER (geo_key % 5 = 0) AS deviating
FROM fact_prices JOIN geo USING (geo_key) GROUP BY 1""",
        "q10_reload_growth": wh + "SELECT count(*) AS rows_before, 0::BIGINT AS rows_added FROM fact_rates",
        "q11_volume_drift": wh + f"""
SELECT 1 AS run_id, 'INITIAL' AS load_type, {RUN_COUNTS} AS rows_in, NULL::BIGINT AS previous_rows_in,
       false AS alert
UNION ALL
SELECT 2, 'INITIAL', (({RUN_COUNTS}) * 3) // 4, {RUN_COUNTS}, true""",
    }
    return out
