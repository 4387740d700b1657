"""Declared schemas: text staging tables, rate documents, logs and warehouse tables."""

from __future__ import annotations

from pyspark.sql import types as T

# --- fixed values: column order of the staging files and tables -------------------
CATALOGUE_COLUMNS = [
    "style_color", "country_code", "snapshot_date", "model_number", "product_name",
    "color_name", "gender_segment", "category", "subcategory", "currency",
    "price_local", "sale_price_local", "discount_pct", "in_stock", "availability_level",
]
RAW_ONLY_COLUMNS = ["sku", "product_id", "available"]
RATE_COLUMNS = [
    "table_type", "table_no", "effective_date", "trading_date", "code",
    "currency_name_pl", "mid", "bid", "ask",
]
# -----------------------------------------------------------------------------------


def text_schema(columns: list[str]) -> T.StructType:
    return T.StructType([T.StructField(name, T.StringType()) for name in columns])


PRICE_LOCAL = T.DecimalType(12, 2)
PRICE = T.DecimalType(14, 4)
RATE = T.DecimalType(18, 6)
DISCOUNT = T.DecimalType(6, 2)



def table(columns: str) -> T.StructType:
    """A schema from "name type" pairs; type names as Spark's schema JSON writes them."""
    schema = T.StructType()
    for column in columns.split(", "):
        name, kind = column.split()
        schema.add(name, kind)
    return schema


# The bank answers with an array of publications, each holding an array of quotes.
QUOTE = text_schema(["code", "currency", "mid", "bid", "ask"])
RATE_DOCUMENT = text_schema(["no", "effectiveDate", "tradingDate"]).add("rates", T.ArrayType(QUOTE))

DIM_DATE = table(
    "date_key integer, full_date date, year integer, quarter integer, month integer, "
    "month_name string, week_of_year integer, day_of_week integer, is_weekend boolean, "
    "is_nbp_working_day boolean"
)
DIM_CURRENCY = table(
    "currency_key long, currency_code string, currency_name string, currency_name_pl string, "
    "nbp_table_type string, is_base_currency boolean, current_mid_rate decimal(18,6)"
)
DIM_GEOGRAPHY = table(
    "geo_key integer, country_code string, country_name string, region string, "
    "sub_region string, currency_code string"
)
DIM_CATEGORY = table(
    "category_key long, category string, subcategory string, category_level integer, "
    "parent_category_key long"
)
DIM_PRODUCT = table(
    "product_key long, style_color string, model_number string, product_name string, "
    "color_name string, gender_segment string, category string, valid_from date, valid_to date, "
    "is_current boolean, etl_load_date timestamp"
)
FACT_RATES = table(
    "fx_key long, date_key integer, currency_key long, table_type string, table_no string, "
    "mid_rate decimal(18,6), bid_rate decimal(18,6), ask_rate decimal(18,6), spread decimal(19,6), "
    "trading_date date, effective_date date, fx_source string, load_timestamp timestamp"
)
FACT_PRICES = table(
    "price_key decimal(38,0), product_key long, geo_key integer, currency_key long, date_key integer, "
    "category_key long, local_price decimal(12,2), sale_price_local decimal(12,2), "
    "discount_pct decimal(6,2), price_pln decimal(14,4), price_eur decimal(14,4), "
    "price_usd decimal(14,4), in_stock boolean, is_catalogue_price boolean, "
    "etl_load_date timestamp"
)
REJECT_LOG = table(
    "source_table string, raw_row string, reject_reason string, load_batch_id integer, "
    "logged_at timestamp"
)
RUN_LOG = table(
    "run_id integer, package_name string, load_type string, event_time timestamp, rows_in long, "
    "rows_out long, rows_rejected long, status string, message string"
)
