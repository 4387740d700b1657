"""Common table expressions that rebuild the warehouse from the given tables in SQL.

Written apart from the library: decimals are whole numbers of their last place (cents,
1e-4 prices, 1e-6 rates) and every rounding is integer arithmetic.
"""

from __future__ import annotations

from crossmart.plans.calendar import HOLIDAYS
from crossmart.sources import demo, seeds


def values(rows) -> str:
    def literal(v):
        return str(v) if isinstance(v, int) else "'" + v + "'"

    return ", ".join("(" + ", ".join(literal(v) for v in row) + ")" for row in rows)


def half_up(num: str, den: str) -> str:
    """Whole-number quotient rounded half away from zero; ``den`` is positive."""
    return f"(sign({num}) * ((2 * abs({num}) + ({den})) // (2 * ({den}))))"


def surrogate(natural: str, order: str) -> str:
    """Key numbering: the n-th row of MD5 bucket b gets 4096 (n - 1) + b + 1."""
    bucket = f"('0x' || substr(md5({natural}), 1, 3))::BIGINT"
    return f"((row_number() OVER (PARTITION BY {bucket} ORDER BY {order}) - 1) * 4096 + {bucket} + 1)"


def money(cents: str) -> str:
    return f"(({cents}) // 100)::VARCHAR || '.' || lpad((({cents}) % 100)::VARCHAR, 2, '0')"


LISTING = (
    "sku, product_id, style_color, country_code, snapshot_date, currency, price_local, "
    "sale_price_local, discount_pct, in_stock, available, availability_level"
)
CATALOGUE = (
    "style_color, country_code, snapshot_date, model_number, product_name, color_name, "
    "gender_segment, category, subcategory, currency, price_local, sale_price_local, discount_pct, "
    "in_stock, availability_level"
)
RATES = (
    "table_type, table_no, effective_date, trading_date, code, currency_name_pl, mid, bid, ask"
)
FIRST_SEEN = (
    "sku NULLS FIRST, product_id NULLS FIRST, currency NULLS FIRST, price_local NULLS FIRST, "
    "sale_price_local NULLS FIRST, discount_pct NULLS FIRST, in_stock NULLS FIRST, "
    "available NULLS FIRST, availability_level NULLS FIRST"
)


def slots():
    rows = [(c, "A") for c in demo.TABLE_A.split()] + [(c, "B") for c in demo.TABLE_B.split()]
    rows += [(c, "C") for c in demo.TABLE_C.split()]
    return [(i, c, t) for i, (c, t) in enumerate(rows)]


def listings(name: str, day: str) -> str:
    return f"""
{name}_cents AS (
  SELECT l.*, g.country_code, g.currency_code AS lead,
         CASE WHEN l_partkey % 4 = 0
              THEN (100 + l_partkey % 400)
                   * (100 + (l_partkey * 7 + (g.geo_key - 1) * 13) % (5 + 5 * (l_partkey % 6)))
              ELSE CAST(floor(l_extendedprice / l_quantity) AS BIGINT) * 100 + 99 END AS cents,
         CAST(floor(l_discount * 100 + 0.5) AS INT) AS percent
  FROM lineitem l JOIN geo g ON g.geo_key - 1 = l_suppkey % 45
),
{name}_sale AS (
  SELECT *, CASE WHEN l_linenumber = 7 AND l_orderkey % 50 = 0 THEN cents + 500
                 WHEN percent > 0 THEN cents * (100 - percent) // 100 END AS sale_cents
  FROM {name}_cents
),
{name} AS (
  SELECT concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey) AS sku,
         l_partkey::VARCHAR AS product_id,
         CASE WHEN l_orderkey % 107 <> 0 THEN 'STY-' || l_partkey END AS style_color,
         country_code,
         {day} AS snapshot_date,
         CASE WHEN l_partkey % 4 = 0 THEN 'PLN'
              WHEN country_code = 'BG' AND l_partkey % 2 = 1 THEN 'BGN' ELSE lead END AS currency,
         CASE WHEN l_orderkey % 101 = 0 THEN NULL WHEN l_orderkey % 103 = 0 THEN 'n/a'
              WHEN l_orderkey % 97 = 0 THEN '0' ELSE {money('cents')} END AS price_local,
         {money('sale_cents')} AS sale_price_local,
         percent::VARCHAR AS discount_pct,
         CASE WHEN l_linenumber = 6 THEN 'unknown' WHEN l_linestatus = 'O' THEN 'true' ELSE 'false' END
           AS in_stock,
         CASE WHEN l_linestatus = 'O' THEN 'true' ELSE 'false' END AS available,
         CASE l_returnflag WHEN 'A' THEN 'HIGH' WHEN 'N' THEN 'MEDIUM' WHEN 'R' THEN 'LOW'
              ELSE 'OOS' END AS availability_level
  FROM {name}_sale
)"""


def with_texts(name: str, source: str, color: str = "split_part(p_name, ' ', 1)") -> str:
    return f"""
{name} AS (
  SELECT r.* EXCLUDE (style_color, country_code), r.style_color, r.country_code,
         p_brand AS model_number,
         CASE WHEN r.country_code IN ('US', 'GB', 'IE', 'AU') THEN p_name
              ELSE p_name || ' [' || r.country_code || ']' END AS product_name,
         {color} AS color_name,
         (['MEN', 'WOMEN', 'MEN|WOMEN', 'KIDS'])[p_size % 4 + 1] AS gender_segment,
         p_type AS category,
         CASE WHEN p_size % 10 = 0 THEN ''
              WHEN p_size % 10 = 1 AND r.country_code = 'JP' THEN p_type
              ELSE concat_ws(' ', p_brand, r.country_code) END AS subcategory
  FROM {source} r LEFT JOIN part ON p_partkey = r.product_id::BIGINT
)"""


def collapsed(name: str, source: str) -> str:
    return f"""
{name} AS (
  SELECT {LISTING} FROM (
    SELECT *, row_number() OVER (PARTITION BY style_color, country_code, snapshot_date
                                 ORDER BY {FIRST_SEEN}) AS rn
    FROM {source} WHERE style_color IS NOT NULL)
  WHERE rn = 1
)"""


def staged(name: str, source: str, batch: int) -> str:
    return f"""
{name} AS (
  SELECT style_color, country_code, snapshot_date, model_number, product_name, color_name,
         gender_segment, category,
         CASE WHEN trim(coalesce(subcategory, '')) = '' THEN '(Unspecified)' ELSE subcategory END
           AS subcategory,
         currency, price_local, sale_price_local, discount_pct, in_stock, availability_level,
         {batch} AS load_batch_id
  FROM {source}
)"""


def catalogue(prefix: str, listing: str, color: str, batch: int) -> str:
    """Collapsed listing plus rows without key, with texts, staged: ``{prefix}``."""
    grain = f"""
{prefix}_grain AS (
  SELECT {LISTING} FROM {listing}_first UNION ALL SELECT {LISTING} FROM {listing} WHERE style_color IS NULL
)"""
    return ",".join(
        [grain, with_texts(f"{prefix}_texts", f"{prefix}_grain", color), staged(prefix, f"{prefix}_texts", batch)]
    )


FIRST_COLOR = "split_part(p_name, ' ', 1)"
NEW_COLOR = "CASE WHEN p_partkey % 10 = 0 THEN 'recolored' ELSE split_part(p_name, ' ', 1) END"

QUOTES = f"""
slots(slot, code, table_type) AS (VALUES {values(slots())}),
quote_days AS (
  SELECT event_id, value, code, table_type,
         CASE WHEN day(d0) % 13 = 0 THEN d0 - 1 ELSE d0 END AS d1
  FROM (SELECT *, ts::DATE - 30 * (event_id % 4)::INT AS d0 FROM events) e
  JOIN slots ON slot = user_id % 48
),
picked AS (
  SELECT table_type, code,
         CASE WHEN table_type = 'B' THEN date_trunc('week', d1)::DATE + 2
              ELSE d1 - greatest(isodow(d1) - 5, 0)::INT END AS day,
         arg_max(value, event_id)::DECIMAL(12, 2) AS value
  FROM quote_days GROUP BY 1, 2, 3
),
rates_stg AS (
  SELECT table_type,
         lpad(dayofyear(day)::VARCHAR, 3, '0') || '/' || table_type || '/' || year(day)::VARCHAR AS table_no,
         day::VARCHAR AS effective_date,
         CASE WHEN table_type = 'C' THEN (day - 1)::VARCHAR END AS trading_date,
         code,
         CASE WHEN table_type = 'C' THEN 'kurs ' ELSE 'waluta ' END || code AS currency_name_pl,
         CASE WHEN table_type <> 'C' THEN (value * 0.1)::DECIMAL(18, 6)::VARCHAR END AS mid,
         CASE WHEN table_type = 'C' THEN (value * 0.1 * 0.99)::DECIMAL(18, 6)::VARCHAR END AS bid,
         CASE WHEN table_type = 'C' THEN (value * 0.1 * 1.01)::DECIMAL(18, 6)::VARCHAR END AS ask,
         1 AS load_batch_id
  FROM picked
)"""

CALENDAR = f"""
cal_days AS (SELECT unnest(generate_series(DATE '2002-01-01', DATE '2027-12-31', INTERVAL 1 DAY))::DATE AS d),
dim_date AS (
  SELECT (year(d) * 10000 + month(d) * 100 + day(d))::INT AS date_key, d AS full_date,
         year(d)::INT AS year, quarter(d)::INT AS quarter, month(d)::INT AS month,
         monthname(d) AS month_name, weekofyear(d)::INT AS week_of_year, isodow(d)::INT AS day_of_week,
         isodow(d) >= 6 AS is_weekend,
         isodow(d) < 6 AND (month(d), day(d)) NOT IN ({values(HOLIDAYS)}) AS is_nbp_working_day
  FROM cal_days
)"""

DIMS = f"""
names(currency_code, english) AS (VALUES {values(seeds.table_rows(seeds.CURRENCY_NAMES))}),
quoted AS (
  SELECT code, max(currency_name_pl) AS pl,
         min(CASE table_type WHEN 'A' THEN 1 WHEN 'B' THEN 2 ELSE 3 END) AS rank
  FROM rates_stg GROUP BY code
),
codes AS (SELECT code FROM quoted UNION SELECT currency FROM cat_stg UNION SELECT 'PLN'),
dim_currency0 AS (
  SELECT {surrogate('code', 'code')} AS currency_key,
         code AS currency_code,
         CASE WHEN code = 'PLN' THEN 'Polish zloty' ELSE coalesce(english, pl, code) END AS currency_name,
         CASE WHEN code = 'PLN' THEN 'złoty polski' ELSE pl END AS currency_name_pl,
         CASE rank WHEN 1 THEN 'A' WHEN 2 THEN 'B' WHEN 3 THEN 'C' END AS nbp_table_type,
         code = 'PLN' AS is_base_currency
  FROM codes LEFT JOIN quoted USING (code) LEFT JOIN names ON names.currency_code = code
),
fact_rates AS (
  SELECT (currency_key * 131072 + (effective_date::DATE - DATE '2000-01-01')) * 4
           + CASE table_type WHEN 'A' THEN 1 WHEN 'B' THEN 2 ELSE 3 END AS fx_key,
         date_key, currency_key, currency_code, currency_name, nbp_table_type, table_type, table_no,
         (mid::DECIMAL(18, 6) * 1000000)::HUGEINT AS mid_u,
         (bid::DECIMAL(18, 6) * 1000000)::HUGEINT AS bid_u,
         (ask::DECIMAL(18, 6) * 1000000)::HUGEINT AS ask_u,
         trading_date::DATE AS trading_date, effective_date::DATE AS effective_date,
         d.year, d.quarter, d.month, d.month_name
  FROM rates_stg JOIN dim_currency0 ON currency_code = code
  JOIN dim_date d ON d.full_date = effective_date::DATE
),
newest_mid AS (
  SELECT currency_key, arg_max(mid_u, effective_date) AS mid_u
  FROM fact_rates WHERE table_type IN ('A', 'B') AND mid_u IS NOT NULL GROUP BY currency_key
),
dim_currency AS (
  SELECT c.*, CASE WHEN m.mid_u IS NOT NULL THEN m.mid_u WHEN is_base_currency THEN 1000000 END AS now_u
  FROM dim_currency0 c LEFT JOIN newest_mid m USING (currency_key)
),
tops AS (
  SELECT {surrogate('category', 'category')} AS category_key, category
  FROM (SELECT DISTINCT category FROM cat_stg WHERE category IS NOT NULL)
),
dim_category AS (
  SELECT category_key, category, category AS subcategory, 1 AS category_level,
         NULL::BIGINT AS parent_category_key FROM tops
  UNION ALL
  SELECT (SELECT max(category_key) FROM tops)
           + {surrogate("category || '|' || subcategory", 'category, subcategory')},
         category, subcategory, 2, tops.category_key
  FROM (SELECT DISTINCT category, subcategory FROM cat_stg WHERE subcategory <> category)
  JOIN tops USING (category)
),
canonical AS (
  SELECT style_color, model_number, product_name, color_name, gender_segment, category FROM (
    SELECT *, row_number() OVER (
      PARTITION BY style_color
      ORDER BY CASE country_code WHEN 'US' THEN 1 WHEN 'GB' THEN 2 WHEN 'IE' THEN 3 WHEN 'AU' THEN 4
                    ELSE 9 END, country_code, snapshot_date DESC) AS rn
    FROM cat_stg WHERE style_color IS NOT NULL)
  WHERE rn = 1
),
dim_product AS (
  SELECT {surrogate('style_color', 'style_color')} AS product_key, *,
         DATE '2024-01-15' AS valid_from, NULL::DATE AS valid_to, true AS is_current
  FROM canonical
)"""


def facts(name: str, stg: str, product: str = "dim_product") -> str:
    product_bits = f"""
{name}_keyed AS (
  SELECT s.*, p.product_key, g.geo_key, c.currency_key, d.date_key, k.category_key,
         d.full_date AS snapshot,
         (TRY_CAST(s.price_local AS DECIMAL(12, 2)) * 100)::HUGEINT AS local_u,
         (TRY_CAST(s.sale_price_local AS DECIMAL(12, 2)) * 100)::HUGEINT AS sale_u,
         TRY_CAST(s.discount_pct AS DECIMAL(6, 2))::DOUBLE AS discount
  FROM {stg} s
  JOIN {product} p ON p.style_color = s.style_color AND p.is_current
  JOIN geo g ON g.country_code = s.country_code
  JOIN dim_currency c ON c.currency_code = s.currency
  JOIN dim_date d ON d.full_date = s.snapshot_date::DATE
  JOIN dim_category k ON k.category = s.category AND k.subcategory = s.subcategory AND k.category_level = 2
  WHERE TRY_CAST(s.price_local AS DECIMAL(12, 2)) > 0
)"""
    return product_bits


def price_columns(local: str, mid: str, eur: str, usd: str) -> str:
    """1e-4 units of the three converted prices."""
    product = f"({local} * {mid})"
    return f"""
         {half_up(product, '10000')} AS pln_u,
         CASE WHEN {eur} > 0 THEN {half_up(f'({product} * 100)', eur)} END AS eur_u,
         CASE WHEN {usd} > 0 THEN {half_up(f'({product} * 100)', usd)} END AS usd_u"""


FACT_PRICES = facts("fp", "cat_stg") + f""",
snap_rates AS (
  SELECT currency_code, arg_max(mid_u, effective_date) AS mid_u FROM fact_rates
  WHERE table_type IN ('A', 'B') AND effective_date <= (SELECT max(snapshot_date)::DATE FROM cat_stg)
  GROUP BY currency_code
  UNION ALL SELECT 'PLN', 1000000
),
cross_rates AS (
  SELECT max(mid_u) FILTER (currency_code = 'EUR') AS eur, max(mid_u) FILTER (currency_code = 'USD') AS usd
  FROM snap_rates
),
fact_prices AS (
  SELECT (product_key::HUGEINT * 2147483648 + geo_key) * 4194304 + (snapshot - DATE '0001-01-01') AS price_key,
         product_key, geo_key, currency_key, date_key, category_key, local_u, sale_u, discount,
         {price_columns('local_u', 'mid_u', '(SELECT eur FROM cross_rates)', '(SELECT usd FROM cross_rates)')},
         CASE in_stock WHEN 'true' THEN true WHEN 'false' THEN false END AS in_stock
  FROM fp_keyed LEFT JOIN snap_rates ON currency_code = currency
)"""

MARTS = f"""
enriched AS (
  SELECT f.*, p.style_color, p.model_number, p.product_name, p.color_name, p.gender_segment,
         p.category AS product_category, p.is_current,
         k.category, k.subcategory, g.country_code, g.country_name, g.region, g.sub_region,
         c.currency_code, c.currency_name, c.nbp_table_type, c.now_u,
         d.full_date AS snapshot_date, d.year, d.quarter, d.month
  FROM fact_prices f JOIN dim_product p USING (product_key) JOIN geo g USING (geo_key)
  JOIN dim_currency c USING (currency_key) JOIN dim_date d USING (date_key)
  JOIN dim_category k USING (category_key)
),
sensible AS (SELECT * FROM enriched WHERE pln_u BETWEEN 10000 AND 500000000),
gaps AS (
  SELECT style_color, product_name, product_category AS category, count(DISTINCT geo_key)::INT AS n_markets,
         min(pln_u) AS lo, max(pln_u) AS hi, sum(pln_u) AS total, count(*) AS n,
         arg_min(country_name, (pln_u, country_code)) AS cheapest_country,
         arg_min(country_code, (pln_u, country_code)) AS cheapest_cc,
         arg_min(country_name, (-pln_u, country_code)) AS dearest_country,
         arg_min(country_code, (-pln_u, country_code)) AS dearest_cc
  FROM sensible GROUP BY 1, 2, 3
),
arbitrage AS (
  SELECT style_color, product_name, category, n_markets, cheapest_country, cheapest_cc,
         dearest_country, dearest_cc,
         {half_up('lo', '100')}::DOUBLE / 100 AS min_price_pln,
         {half_up('hi', '100')}::DOUBLE / 100 AS max_price_pln,
         {half_up('total', '(n * 100)')}::DOUBLE / 100 AS avg_price_pln,
         {half_up('(hi - lo)', '100')}::DOUBLE / 100 AS spread_pln,
         {half_up('((hi - lo) * 1000)', 'lo')}::DOUBLE / 10 AS margin_pct,
         CASE WHEN 100 * (hi - lo) > 20 * lo THEN 'HIGH (>20%)'
              WHEN 100 * (hi - lo) >= 10 * lo THEN 'MEDIUM (10-20%)' ELSE 'LOW (<10%)' END AS arbitrage_status
  FROM gaps WHERE n_markets >= 2
),
mids_a AS (SELECT * FROM fact_rates WHERE table_type = 'A'),
trend_day AS (SELECT max(effective_date) AS d FROM mids_a),
trend_prev AS (
  SELECT currency_code, arg_max(mid_u, effective_date) AS prev FROM mids_a
  WHERE effective_date <= (SELECT d - 30 FROM trend_day) GROUP BY 1
),
trend AS (
  SELECT currency_code, currency_name, effective_date AS as_of_date,
         mid_u::DOUBLE / 1000000 AS mid_now, prev::DOUBLE / 1000000 AS mid_30d_ago,
         CASE WHEN prev > 0 THEN {half_up('((mid_u - prev) * 100000)', 'prev')}::DOUBLE / 1000 END
           AS change_30d_pct
  FROM mids_a LEFT JOIN trend_prev USING (currency_code)
  WHERE effective_date = (SELECT d FROM trend_day)
),
volatility AS (
  SELECT currency_code, year, month, month_name,
         stddev_samp(mid_u::DOUBLE / 1000000)::DECIMAL(18, 6)::DOUBLE AS vol_stdev,
         {half_up('sum(mid_u)', 'count(*)')}::DOUBLE / 1000000 AS vol_avg,
         CASE WHEN sum(mid_u) > 0 THEN
           (100 * stddev_samp(mid_u::DOUBLE / 1000000) / (sum(mid_u)::DOUBLE / 1000000 / count(*)))
             ::DECIMAL(8, 3)::DOUBLE END AS vol_cv_pct
  FROM mids_a GROUP BY ALL
),
own_days AS (
  SELECT currency_code, effective_date, sum(mid_u)::DOUBLE / 1000000 / count(*) AS mid,
         max(effective_date) OVER (PARTITION BY currency_code) AS last_date
  FROM mids_a GROUP BY 1, 2
),
own_trend AS (
  SELECT currency_code, max(last_date) AS last_date, arg_max(mid, effective_date) AS mid_now,
         arg_max(mid, effective_date) FILTER (effective_date <= last_date - 30) AS mid_30d_ago
  FROM own_days GROUP BY 1
)"""


def part(*blocks: str) -> str:
    """Statement prefix holding the wanted blocks, geography first."""
    geo = (
        "geo(geo_key, country_code, country_name, region, sub_region, currency_code) AS (VALUES "
        + values([(i, *row) for i, row in enumerate(seeds.table_rows(seeds.GEOGRAPHY), start=1)])
        + ")"
    )
    return "WITH " + ",".join([geo, *blocks]) + "\n"


SINGLE = "'2024-01-15'"
DAILY = "(DATE '2024-01-01' + (l_orderkey % 30)::INT)::VARCHAR"

LISTINGS = listings("listing", SINGLE)
FIRST = LISTINGS + "," + collapsed("listing_first", "listing")
STAGED = FIRST + "," + catalogue("cat_stg", "listing", FIRST_COLOR, 1)
RAW = LISTINGS + "," + with_texts("raw", "listing")
WAREHOUSE = ",".join([STAGED, QUOTES, CALENDAR, DIMS, FACT_PRICES, MARTS])
