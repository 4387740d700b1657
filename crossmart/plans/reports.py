"""Report queries over the views, and the ad-hoc analysis listings."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from crossmart.functions import is_sensible, price_bucket
from crossmart.functions.markets import per_market
from crossmart.functions.pricing import percent_gap
from crossmart.plans import marts, measures

Tables = dict[str, DataFrame]

# --- fixed values: currencies of the history chart and of the trend listing ------------------
NAME_CHARS = 30
CHART_CURRENCIES = ["USD", "EUR", "GBP", "CHF"]
TREND_CURRENCIES = ["USD", "EUR", "GBP", "JPY", "TRY", "ZAR", "CHF", "KRW"]
# -----------------------------------------------------------------------------------------------


# --- price map of the most widely sold product ---------------------------------------------------


def widest_product(t: Tables, category: str):
    """Scalar subquery: key of the current product of a category sold in most markets."""
    products = t["dim_product"].where(F.col("is_current") & (F.col("category") == category))
    sold = t["fact_prices"].where(is_sensible(F.col("price_pln"))).select("product_key", "geo_key")
    counts = sold.distinct().groupBy("product_key").agg(F.count("*").alias("n"))
    widest = counts.join(products, "product_key").orderBy(F.desc("n"), "style_color").limit(1)
    return widest.select("product_key").scalar()


def price_map(t: Tables, category: str) -> DataFrame:
    """Markets of the category's most widely sold product, ranked from dear to cheap."""
    one = {**t, "fact_prices": t["fact_prices"].where(F.col("product_key") == widest_product(t, category))}
    rows = marts.global_price_map(one)
    # one product: at most markets x snapshots rows are ranked
    dear_first = Window.partitionBy("style_color").orderBy(F.desc("price_pln"), "country_code")
    return rows.withColumn("price_rank", F.row_number().over(dear_first))


def price_map_cards(t: Tables, category: str) -> DataFrame:
    """Cheapest and dearest market, spread and margin of the mapped product."""
    key = widest_product(t, category)
    one = {**t, "fact_prices": t["fact_prices"].where(F.col("product_key") == key)}
    return marts.product_arbitrage(one).select(
        "style_color", "product_name", "n_markets", "cheapest_country", "dearest_country",
        "min_price_pln", "max_price_pln", "spread_pln", "margin_pct",
    )


# --- arbitrage page --------------------------------------------------------------------------------


def top_margins(t: Tables, count: int = 10, min_markets: int = 2) -> DataFrame:
    """The products with the largest margins; equal margins by style."""
    return (
        marts.product_arbitrage(t).where(F.col("n_markets") >= min_markets)
        .withColumn("product_name", F.left("product_name", F.lit(28)))
        .orderBy(F.desc("margin_pct"), "style_color").limit(count)
    )


def arbitrage_kpis(t: Tables) -> DataFrame:
    """Largest spread and margin, active opportunities, currencies under pressure."""
    pressure = measures.under_pressure(t).scalar()
    return marts.product_arbitrage(t).agg(
        F.max("spread_pln").alias("max_spread_pln"), F.max("margin_pct").alias("max_margin_pct"),
        F.count_if(F.col("margin_pct") > 20).alias("active_opportunities"),
    ).withColumn("under_pressure", pressure)


def band_distribution(t: Tables) -> DataFrame:
    return marts.product_arbitrage(t).groupBy("arbitrage_status").agg(F.count("*").alias("n"))


# --- rates page -----------------------------------------------------------------------------------


def rate_history(t: Tables, codes: list[str] = CHART_CURRENCIES) -> DataFrame:
    """Mid rates over time of the charted currencies, table A."""
    dims = {**t, "dim_currency": t["dim_currency"].where(F.col("currency_code").isin(codes))}
    rows = marts.fx_enriched({**dims, "fact_rates": marts.table_a(t)})
    return rows.select("currency_code", "effective_date", "mid_rate").orderBy(
        "currency_code", "effective_date"
    )


def trend_extremes(t: Tables) -> DataFrame:
    """Strongest and weakest 30-day trend and the number of table A currencies."""
    trend = marts.fx_trend_30d(t).where(F.col("change_30d_pct").isNotNull())
    covered = measures.table_a_currencies(t).scalar()
    up = F.max(F.struct("change_30d_pct", "currency_code"))
    down = F.min(F.struct("change_30d_pct", "currency_code"))
    return trend.agg(up.alias("up"), down.alias("down")).select(
        F.col("up.currency_code").alias("strongest"), F.col("up.change_30d_pct").alias("strongest_pct"),
        F.col("down.currency_code").alias("weakest"), F.col("down.change_30d_pct").alias("weakest_pct"),
        covered.alias("table_a_currencies"),
    )


def trend_listing(t: Tables, codes: list[str] = TREND_CURRENCIES) -> DataFrame:
    return marts.fx_trend_30d(t).where(F.col("currency_code").isin(codes)).drop("currency_name").orderBy(
        F.desc("change_30d_pct"), "currency_code"
    )


def volatility_matrix(t: Tables) -> DataFrame:
    """Coefficient of variation, currencies and years down, months across."""
    months = marts.fx_monthly_volatility(t).withColumn(
        "m", F.concat(F.lit("m"), F.lpad(F.col("month").cast("string"), 2, "0"))
    )
    labels = [f"m{month:02d}" for month in range(1, 13)]
    return months.groupBy("currency_code", "year").pivot("m", labels).agg(F.max("vol_cv_pct"))


# --- ad-hoc listings -----------------------------------------------------------------------------


def bucket_histogram(t: Tables) -> DataFrame:
    """Rows per range of the converted price."""
    rows = t["fact_prices"].where(F.col("price_pln").isNotNull())
    return rows.groupBy(price_bucket(F.col("price_pln")).alias("bucket")).agg(F.count("*").alias("n"))


def priced_between(t: Tables, low: float, high: float, count: int = 10) -> DataFrame:
    """First rows of a price range together with the number of rows in all."""
    found = t["fact_prices"].where(F.col("price_pln").between(F.lit(low).cast("decimal(14,4)"), F.lit(high).cast("decimal(14,4)")))
    total = found.select(F.count("*").alias("n")).scalar()
    listed = found.orderBy("price_pln", "price_key").limit(count)
    named = measures.with_attributes(listed, t, ["country_code", "currency_code"])
    return named.select(
        "price_key", "country_code", "currency_code", "local_price", "price_pln", total.alias("total_rows")
    )


def outliers_by_market(t: Tables, limit: int = 20000) -> DataFrame:
    """Per market and currency: number and local price range of very high prices."""
    high = t["fact_prices"].where(F.col("price_pln") >= limit)
    # combined on the keys first, named afterwards: a few rows meet the dimensions
    groups = high.groupBy("geo_key", "currency_key").agg(
        F.count("*").alias("n"), F.min("local_price").alias("min_loc"), F.max("local_price").alias("max_loc")
    )
    return measures.with_attributes(groups, t, ["country_code", "currency_code"]).select(
        "country_code", "currency_code", "n", "min_loc", "max_loc"
    )


def top_spreads(t: Tables, count: int = 10, min_markets: int = 5) -> DataFrame:
    """Largest price spreads among products in many markets, outliers included.

    Prices are listed with two decimals, the margin with one, names up to ``NAME_CHARS``.
    """
    gaps = (
        per_market(t["fact_prices"].where(F.col("price_pln").isNotNull()))
        .groupBy("product_key")
        .agg(
            F.count("geo_key").cast("int").alias("n_markets"),
            F.min("lo").alias("min_pln"), F.max("hi").alias("max_pln"),
        )
        .where(F.col("n_markets") >= min_markets)
        .withColumn("spread_pln", F.col("max_pln") - F.col("min_pln"))
    )
    products = t["dim_product"].select("product_key", "style_color", "product_name")
    first = gaps.join(products, "product_key").orderBy(F.desc("spread_pln"), "style_color").limit(count)
    money = "decimal(14,2)"
    return first.select(
        "style_color", F.substring("product_name", 1, NAME_CHARS).alias("product_name"), "n_markets",
        F.col("min_pln").cast(money).alias("min_pln"), F.col("max_pln").cast(money).alias("max_pln"),
        F.col("spread_pln").cast(money).alias("spread_pln"),
        percent_gap(F.col("max_pln"), F.col("min_pln")).cast("decimal(18,1)").alias("margin_pct"),
    )


def table_counts(t: Tables) -> DataFrame:
    """Row counts of the warehouse tables and of the prices without conversion."""
    def counted(label: str, df: DataFrame) -> DataFrame:
        return df.agg(F.count("*").alias("n")).select(F.lit(label).alias("t"), "n")

    names = [
        "dim_product", "dim_currency", "dim_category", "dim_geography", "fact_prices", "fact_rates",
    ]
    out = counted("fact_prices without rate", t["fact_prices"].where(F.col("price_pln").isNull()))
    for name in names:
        out = out.unionByName(counted(name, t[name]))
    return out.unionByName(counted("reject_log", t["reject_log"]))


def drill_down(t: Tables, levels: list[str]) -> DataFrame:
    """Totals along a drill path; the depth says how many of its levels a row fixes.

    Prices are combined per dimension key before the attributes are joined and the rollup
    repeats rows once per level.
    """
    rows = t["fact_prices"].where(F.col("price_pln").isNotNull())
    keyed = rows.groupBy(*measures.keys_of(levels)).agg(
        F.count("*").alias("_n"), F.sum("price_pln").alias("_s")
    )
    depth = F.lit(len(levels)) - F.bit_count(F.grouping_id())
    return measures.with_attributes(keyed, t, levels).rollup(*levels).agg(
        depth.cast("int").alias("depth"), F.sum("_n").alias("n_prices"),
        F.sum("_s").cast("double").alias("sum_pln"),
    )


DRILL_PATHS = {
    "category": ["category", "subcategory"],
    "geography": ["region", "sub_region", "country_code"],
    "calendar": ["year", "quarter", "month", "full_date"],
}
