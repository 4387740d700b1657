"""Data profile of the raw catalogue, as a few grouped aggregates over one column set."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crossmart.functions import to_float
from crossmart.operators.pick import first_row

# --- fixed values: profiled columns --------------------------------------------------------
PROFILED = [
    "snapshot_date", "country_code", "product_name", "model_number", "currency", "price_local",
    "sale_price_local", "gender_segment", "category", "subcategory", "product_id", "sku",
    "style_color", "color_name", "discount_pct", "in_stock", "available", "availability_level",
]
KEY_FIELDS = [
    "sku", "style_color", "model_number", "price_local", "currency", "country_code", "category",
    "product_name",
]
COUNTED = [
    "country_code", "currency", "category", "subcategory", "gender_segment", "snapshot_date",
    "availability_level",
]
NOT_COVERED = "BRAK"
TOP_LABELS = 20
# ---------------------------------------------------------------------------------------------


def null_counts(raw: DataFrame) -> DataFrame:
    """Missing values per key field: one row, one scan."""
    return raw.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in KEY_FIELDS])


def value_counts(raw: DataFrame, columns: list[str] = COUNTED) -> DataFrame:
    """Frequencies of several columns in one scan.

    Rows are combined on the map side, so the shuffle carries distinct values only.
    """
    cells = raw.select(
        F.inline(F.array(*[F.struct(F.lit(c).alias("field"), F.col(c).alias("value")) for c in columns]))
    )
    return cells.where(F.col("value").isNotNull()).groupBy("field", "value").agg(F.count("*").alias("n"))


def top_values(raw: DataFrame, column: str = "subcategory", count: int = TOP_LABELS) -> DataFrame:
    """Most frequent values of a column; equal counts in value order."""
    counted = value_counts(raw, [column])
    return counted.orderBy(F.desc("n"), "value").limit(count).select("value", "n")


def comparable(c: Column) -> Column:
    """A number that orders like one: NaN is above and below nothing, so it becomes NULL."""
    number = to_float(c)
    return F.when(~F.isnan(number), number)


def fault_flags() -> dict[str, Column]:
    """Prices that are no number, not above zero, or below their sale price."""
    price, sale = comparable(F.col("price_local")), comparable(F.col("sale_price_local"))
    return {
        "price_le_zero": price <= 0,
        "price_nonnumeric": F.col("price_local").isNotNull() & to_float(F.col("price_local")).isNull(),
        "sale_gt_price": sale > price,
    }


def fault_counts() -> list[Column]:
    return [F.count_if(flag).alias(name) for name, flag in fault_flags().items()]


def price_faults(raw: DataFrame) -> DataFrame:
    return raw.agg(*fault_counts())


def sale_above_list(raw: DataFrame) -> DataFrame:
    """Every row with a flag for a sale price above the list price; nothing is rejected."""
    flag = comparable(F.col("sale_price_local")) > comparable(F.col("price_local"))
    return raw.withColumn("sale_gt_price", F.coalesce(flag, F.lit(False)))


def keyed(raw: DataFrame) -> DataFrame:
    """Rows with both parts of the natural key."""
    filled = [F.coalesce(c, F.lit("")) != "" for c in ("style_color", "country_code")]
    return raw.where(filled[0] & filled[1])


def markets_per_product(raw: DataFrame) -> DataFrame:
    """Distinct markets per style; equal (style, market) pairs are combined first."""
    pairs = keyed(raw).select("style_color", "country_code").distinct()
    return pairs.groupBy("style_color").agg(F.count("*").alias("n_countries"))


def market_histogram(raw: DataFrame) -> DataFrame:
    """Products per number of markets."""
    return markets_per_product(raw).groupBy("n_countries").agg(F.count("*").alias("n_products"))


def extract_rows(raw: DataFrame) -> DataFrame:
    """The collapsed extract with tolerant numbers, one row per style, market, snapshot."""
    return extract_columns(first_row(keyed(raw), ["style_color", "country_code", "snapshot_date"], ["sku"]))


def extract_columns(collapsed: DataFrame) -> DataFrame:
    """The extract's columns, with tolerant numbers, of rows that are collapsed already."""
    return collapsed.select(
        "style_color", "country_code", "snapshot_date", "model_number", "product_name", "color_name", "gender_segment", "category",
        "subcategory", "currency",
        to_float(F.col("price_local")).alias("price_local"),
        to_float(F.col("sale_price_local")).alias("sale_price_local"),
        to_float(F.col("discount_pct")).alias("discount_pct"), "in_stock", "availability_level",
    )


def currency_coverage(raw: DataFrame, codes: DataFrame) -> DataFrame:
    """Catalogue currencies, their rows, and whether a mid-rate table quotes them.

    ``codes`` is the code map of the rate ingestion (currency_code, nbp_table_type).
    """
    counted = value_counts(raw, ["currency"]).select(F.col("value").alias("currency"), "n")
    table = F.coalesce("nbp_table_type", F.lit(NOT_COVERED))
    return (
        counted.join(codes.select(F.col("currency_code").alias("currency"), "nbp_table_type"), "currency", "left")
        .select(
            "currency", F.col("n").alias("rows"), table.alias("nbp_table"),
            table.isin("A", "B").alias("covered"),
        )
    )


def as_metrics(row: DataFrame) -> DataFrame:
    """A one-row frame of counts as (metric, value) rows."""
    return row.unpivot([], row.columns, "metric", "value")


def expanded(raw: DataFrame) -> DataFrame:
    """One scan of the raw rows as grouped counts: (part, k1, k2, k3, n).

    Part ``rows`` counts rows by their faults (a bit each), ``country_code`` and ``currency``
    count values, and ``grain`` counts rows per style, market and snapshot. Rows are combined
    before the shuffle, which carries different keys only.
    """
    faults = F.lit(0)
    for bit, flag in enumerate(fault_flags().values()):
        faults = faults + F.when(flag, 1 << bit).otherwise(0)
    none = F.lit(None).cast("string")
    cell = lambda part, *keys: F.struct(
        F.lit(part).alias("part"), *[(keys[i] if i < len(keys) else none).alias(f"k{i + 1}") for i in range(3)])
    filled = [F.coalesce(c, F.lit("")) != "" for c in ("style_color", "country_code")]
    grain = cell("grain", F.when(filled[0] & filled[1], F.col("style_color")), F.col("country_code"), F.col("snapshot_date"))
    values = [cell(c, F.col(c)) for c in ("country_code", "currency")]
    cells = F.array(cell("rows", faults.cast("string")), *values, grain)
    return raw.select(F.inline(cells)).where("k1 IS NOT NULL").groupBy("part", "k1", "k2", "k3").agg(F.count("*").alias("n"))


def summary(raw: DataFrame, codes: DataFrame) -> DataFrame:
    """The profile's totals as (metric, value) rows, from one scan of the raw rows.

    The grouped counts run through one chain of groups: snapshots per style and market,
    markets per style, totals. No branch reads the raw rows again.
    """
    part, key = F.col("part"), F.col("k1")
    by_market = expanded(raw).groupBy("part", "k1", "k2").agg(F.sum("n").alias("n"), F.count("*").alias("days"))
    by_key = by_market.groupBy("part", "k1").agg(
        F.sum("n").alias("n"), F.count("*").alias("markets"), F.sum("days").alias("grains"))
    quoted = codes.where(F.col("nbp_table_type").isin("A", "B")).select(
        F.lit("currency").alias("part"), F.col("currency_code").alias("k1"), F.lit(True).alias("quoted")).distinct()
    known = by_key.join(quoted, ["part", "k1"], "left")
    style = part == "grain"
    total = lambda c, value: F.coalesce(F.sum(F.when(c, value)), F.lit(0)).cast("long")
    rows = part == "rows"
    bits = F.when(rows, key.cast("int"))
    row = known.agg(
        total(rows, F.col("n")).alias("total_raw_rows"),
        *[total(rows & (bits.bitwiseAND(1 << bit) != 0), F.col("n")).alias(name) for bit, name in enumerate(fault_flags())],
        F.count_if(part == "country_code").alias("distinct_country_code"),
        F.count_if(part == "currency").alias("distinct_currency"),
        F.count_if(style).alias("distinct_style_color"),
        F.count_if(style & (F.col("markets") >= 2)).alias("products_in_2plus_countries"),
        F.count_if(style & (F.col("markets") >= 5)).alias("products_in_5plus_countries"),
        F.max(F.when(style, F.col("markets"))).alias("max_countries_per_product"),
        total(style, F.col("grains")).alias("grain_rows"),
        F.count_if((part == "currency") & F.col("quoted").isNull()).alias("uncovered_currencies"),
    )
    return as_metrics(row)


def profile(raw: DataFrame, codes: DataFrame) -> dict[str, DataFrame]:
    """Every part of the profile by name; each is one job over the needed columns only."""
    rows = raw.select(*PROFILED)
    return {
        "summary": summary(rows, codes),
        "null_counts": null_counts(rows),
        "value_counts": value_counts(rows),
        "top_subcategories": top_values(rows),
        "markets_histogram": market_histogram(rows),
        "currency_coverage": currency_coverage(rows, codes),
    }
