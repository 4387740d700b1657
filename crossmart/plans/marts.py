"""The analytical views, each a function from warehouse tables to a DataFrame."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from crossmart import schemas
from crossmart.functions import arbitrage_band, is_outlier, is_sensible, percent_gap
from crossmart.functions.markets import average, per_market
from crossmart.operators.joins import lookup_join
from crossmart.operators.pick import latest_value

Tables = dict[str, DataFrame]

TREND_DAYS = 30


def price_enriched(t: Tables) -> DataFrame:
    """Denormalized price fact with an outlier flag; outliers stay in.

    The calendar has a bounded size. Markets, currencies and categories may hold a large part
    of the rows each and go through the lookup for hot keys; a product has few rows.
    """
    days = F.broadcast(
        t["dim_date"].select("date_key", F.col("full_date").alias("snapshot_date"), "year", "quarter", "month")
    )
    markets = t["dim_geography"].drop("currency_code")
    products = t["dim_product"].select(
        "product_key", "style_color", "model_number", "product_name", "color_name", "gender_segment"
    )
    currencies = t["dim_currency"].select(
        "currency_key", "currency_code", "currency_name", "nbp_table_type"
    )
    labels = t["dim_category"].select("category_key", "category", "subcategory")
    joined = t["fact_prices"].join(products, "product_key").join(days, "date_key")
    joined = lookup_join(joined, markets, ["geo_key"])
    joined = lookup_join(joined, currencies, ["currency_key"])
    joined = lookup_join(joined, labels, ["category_key"])
    return joined.select(
        "price_key", "product_key", "style_color", "model_number", "product_name", "color_name",
        "gender_segment", "category", "subcategory", "geo_key", "country_code", "country_name",
        "region", "sub_region", "currency_key", "currency_code", "currency_name", "nbp_table_type",
        "snapshot_date", "year", "quarter", "month", "local_price", "sale_price_local", "discount_pct",
        "price_pln", "price_eur", "price_usd", "in_stock",
        is_outlier(F.col("price_pln")).alias("is_price_outlier"),
    )


def market_extremes(t: Tables) -> DataFrame:
    """Per product over sensible prices: markets, min, max, avg and both extreme markets.

    One scan of the fact. Rows are combined per product and market before the markets'
    names are looked up; both ties go to the first country code.
    """
    base = t["fact_prices"].where(is_sensible(F.col("price_pln")))
    markets = t["dim_geography"].select("geo_key", "country_code", "country_name")
    named = lookup_join(per_market(base), markets, ["geo_key"])
    lowest = F.min(F.struct("lo", "country_code", "country_name"))
    highest = F.min(F.struct((-F.col("hi")).alias("hi"), "country_code", "country_name"))
    extremes = named.groupBy("product_key").agg(
        F.count("*").cast("int").alias("n_markets"), lowest.alias("low"), highest.alias("high"),
        average(F.col("total"), F.col("n")).alias("avg_pln"),
    )
    return extremes.select(
        "product_key", "n_markets", F.col("low.lo").alias("min_pln"),
        (-F.col("high.hi")).cast(schemas.PRICE).alias("max_pln"), "avg_pln",
        F.col("low.country_name").alias("cheapest_country"), F.col("low.country_code").alias("cheapest_cc"),
        F.col("high.country_name").alias("dearest_country"), F.col("high.country_code").alias("dearest_cc"),
    )


def product_arbitrage(t: Tables) -> DataFrame:
    """Cross-market price gap of every current product sold in at least two markets."""
    current = t["dim_product"].where("is_current").select(
        "product_key", "style_color", "product_name", "category"
    )
    margin = percent_gap(F.col("max_pln"), F.col("min_pln"))
    money = "decimal(12,2)"
    return (
        market_extremes(t).where("n_markets >= 2").join(current, "product_key")
        .select(
            "style_color", "product_name", "category", "n_markets",
            "cheapest_country", "cheapest_cc", "dearest_country", "dearest_cc",
            F.col("min_pln").cast(money).alias("min_price_pln"),
            F.col("max_pln").cast(money).alias("max_price_pln"),
            F.col("avg_pln").cast(money).alias("avg_price_pln"),
            (F.col("max_pln") - F.col("min_pln")).cast(money).alias("spread_pln"),
            margin.cast("decimal(8,1)").alias("margin_pct"),
            arbitrage_band(margin).alias("arbitrage_status"),
        )
    )


def global_price_map(t: Tables) -> DataFrame:
    """Sensible prices per product and country, all product versions."""
    markets = t["dim_geography"].select("geo_key", "country_code", "country_name", "region")
    currencies = t["dim_currency"].select("currency_key", "currency_code")
    products = t["dim_product"].select("product_key", "style_color", "product_name", "category")
    rows = t["fact_prices"].where(is_sensible(F.col("price_pln"))).join(products, "product_key")
    rows = lookup_join(rows, markets, ["geo_key"])
    return lookup_join(rows, currencies, ["currency_key"]).select(
        "style_color", "product_name", "category", "country_code", "country_name", "region",
        "currency_code", "local_price", "price_pln",
    )


def fx_enriched(t: Tables) -> DataFrame:
    """Rates with calendar and currency attributes."""
    days = F.broadcast(
        t["dim_date"].select("date_key", "full_date", "year", "quarter", "month", "month_name")
    )
    currencies = t["dim_currency"].select(
        "currency_key", "currency_code", "currency_name", F.col("nbp_table_type").alias("currency_tab")
    )
    return (
        t["fact_rates"].drop("effective_date").join(days, "date_key").join(currencies, "currency_key")
        .select(
            "fx_key", F.col("full_date").alias("effective_date"), "year", "quarter", "month",
            "month_name", "currency_code", "currency_name", "currency_tab", "table_type",
            "mid_rate", "bid_rate", "ask_rate", "spread",
        )
    )


def table_a(t: Tables) -> DataFrame:
    return t["fact_rates"].where((F.col("table_type") == "A") & F.col("mid_rate").isNotNull())


def fx_trend_30d(t: Tables) -> DataFrame:
    """Rate on the newest published day against the newest one at least 30 days older.

    A currency not quoted on the newest day is absent; without an older quote the
    change is NULL.
    """
    rates = table_a(t)
    newest = rates.select(F.max("effective_date").alias("d")).scalar()
    now = rates.where(F.col("effective_date") == newest).select(
        "currency_key", F.col("effective_date").alias("as_of_date"), F.col("mid_rate").alias("mid_now")
    )
    before = latest_value(
        rates.where(F.col("effective_date") <= F.date_sub(newest, TREND_DAYS)),
        ["currency_key"], "mid_rate", "effective_date", "mid_30d_ago",
    )
    names = t["dim_currency"].select("currency_key", "currency_code", "currency_name")
    change = percent_gap(F.col("mid_now"), F.col("mid_30d_ago"))
    return (
        now.join(names, "currency_key").join(before, "currency_key", "left")
        .select(
            "currency_code", "currency_name", "as_of_date", "mid_now", "mid_30d_ago",
            change.cast("decimal(8,3)").alias("change_30d_pct"),
        )
    )


def fx_monthly_volatility(t: Tables) -> DataFrame:
    """Sample deviation, mean and coefficient of variation per currency and month."""
    days = F.broadcast(t["dim_date"].select("date_key", "year", "month", "month_name"))
    names = t["dim_currency"].select("currency_key", "currency_code")
    per_month = (
        table_a(t).join(days, "date_key")
        .groupBy("currency_key", "year", "month", "month_name")
        .agg(F.stddev_samp(F.col("mid_rate").cast("double")).alias("sd"), F.avg("mid_rate").alias("mean"))
    )
    mean = F.col("mean").cast("double")
    return per_month.join(names, "currency_key").select(
        "currency_code", "year", "month", "month_name",
        F.col("sd").cast("decimal(18,6)").alias("vol_stdev"),
        F.col("mean").cast("decimal(18,6)").alias("vol_avg"),
        F.when(mean != 0, 100 * F.col("sd") / mean).cast("decimal(8,3)").alias("vol_cv_pct"),
    )


def kpi_summary(t: Tables) -> DataFrame:
    """One row of eight metrics; the arbitrage view is aggregated once for four of them."""
    gaps = product_arbitrage(t).agg(
        F.count("*").alias("arbitrage_products"),
        F.count_if(F.col("margin_pct") > 20).alias("opportunities_gt20"),
        F.max("margin_pct").alias("max_margin_pct"),
        F.max("spread_pln").alias("max_spread_pln"),
    )

    def one(df: DataFrame, value) -> Column:
        return df.select(value.alias("v")).scalar()

    everything = F.count("*")
    return gaps.select(
        one(t["dim_product"].where("is_current"), everything).alias("products"),
        one(t["dim_geography"], everything).alias("markets"),
        one(t["dim_geography"], F.countDistinct("currency_code")).alias("currencies"),
        one(t["fact_prices"], everything).alias("fact_price_rows"),
        "arbitrage_products", "opportunities_gt20", "max_margin_pct", "max_spread_pln",
    )


VIEWS = {
    "v_price_enriched": price_enriched,
    "v_product_arbitrage": product_arbitrage,
    "v_global_price_map": global_price_map,
    "v_fx_enriched": fx_enriched,
    "v_fx_trend_30d": fx_trend_30d,
    "v_fx_monthly_volatility": fx_monthly_volatility,
    "v_kpi_summary": kpi_summary,
}


def model_tables(t: Tables) -> Tables:
    """Tables as the reporting model imports them: products in their current version only."""
    return {**t, "dim_product": t["dim_product"].where("is_current")}


def register_views(spark: SparkSession, t: Tables) -> None:
    """Temp views for SQL users: every table under its name and the seven views."""
    for name, df in t.items():
        df.createOrReplaceTempView(name)
    for name, build in VIEWS.items():
        build(t).createOrReplaceTempView(name)
