"""Fact loads: incremental rate and price rows, the reject log, unmatched rows."""

from __future__ import annotations

import uuid
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crossmart import schemas
from crossmart.functions import (
    convert,
    convert_cross,
    raw_row_text,
    reject_reason,
    table_rank,
    to_boolean,
    to_date_or_null,
    to_decimal,
)
from crossmart.functions.cleaning import local_price
from crossmart.functions.pricing import MID_TABLES
from crossmart.operators.joins import lookup_join, rates_in_force
from crossmart.operators.pick import first_row, latest_value
from crossmart.plans.calendar import date_key
from crossmart.session import work_dir
from crossmart.sources.seeds import BASE_CODE, inline_table

# --- fixed values ------------------------------------------------------------------------
CATALOGUE_SOURCE = "stg_catalogue"
RATE_SOURCE = "NBP"
EUR, USD = "EUR", "USD"
# --------------------------------------------------------------------------------------------

EPOCH, FIRST_DAY = "2000-01-01", "0001-01-01"
#: Room for any market key (an int) and for any day up to the year 9999.
MARKET_KEYS, DAYS = 1 << 31, 1 << 22


def day_number(day: Column, first: str = EPOCH) -> Column:
    return F.datediff(day, F.lit(first).cast("date")).cast("bigint")


def price_key(product: Column, geo: Column, day: Column) -> Column:
    """Row key packed from the grain: product, market (31 bits), day (22 bits).

    Unique and repeatable with neither a shuffle nor a counter, for every key and day.
    """
    market = product.cast("decimal(19,0)") * F.lit(MARKET_KEYS).cast("decimal(10,0)") + geo.cast("decimal(10,0)")
    packed = market * F.lit(DAYS).cast("decimal(7,0)") + day_number(day, FIRST_DAY).cast("decimal(7,0)")
    return packed.cast("decimal(38,0)")


def rate_key(currency: Column, table_type: Column, day: Column) -> Column:
    """Row key packed from the grain: currency, day (17 bits), table (2 bits)."""
    return (currency * 131072 + day_number(day)) * 4 + table_rank(table_type)


# --- rates ---------------------------------------------------------------------------------


def new_rates(fact: DataFrame, rates_stg: DataFrame, dim_currency: DataFrame, dim_date: DataFrame) -> DataFrame:
    """Rows of the staged quotes that the rate fact does not hold yet."""
    staged = rates_stg.where(F.col("code").isNotNull()).withColumn(
        "effective_day", to_date_or_null(F.col("effective_date"))
    )
    unique = first_row(
        staged.drop("effective_date", "load_batch_id"),
        ["effective_day", "code", "table_type"], ["table_no"],
    )
    bid, ask = to_decimal(F.col("bid"), 18, 6), to_decimal(F.col("ask"), 18, 6)
    days = F.broadcast(dim_date.select("date_key", "full_date"))  # one row per calendar day
    codes = dim_currency.select("currency_key", F.col("currency_code").alias("code"))
    rows = (
        unique.join(codes, "code")
        .join(days, F.col("effective_day") == F.col("full_date"))
        .select(
            rate_key(F.col("currency_key"), F.col("table_type"), F.col("full_date")).alias("fx_key"),
            "date_key", "currency_key", "table_type", "table_no",
            to_decimal(F.col("mid"), 18, 6).alias("mid_rate"),
            bid.alias("bid_rate"), ask.alias("ask_rate"),
            (ask - bid).alias("spread"),
            to_date_or_null(F.col("trading_date")).alias("trading_date"),
            F.col("effective_day").alias("effective_date"),
            F.lit(RATE_SOURCE).alias("fx_source"),
            F.current_timestamp().alias("load_timestamp"),
        )
    )
    return rows.join(fact, ["effective_date", "currency_key", "table_type"], "left_anti").select(
        *schemas.FACT_RATES.names
    )


def usable_mids(fact_rates: DataFrame, dim_currency: DataFrame) -> DataFrame:
    """(code, day, mid) of the tables that carry mids; table A wins on a shared day."""
    return (
        fact_rates.where(F.col("table_type").isin(MID_TABLES) & F.col("mid_rate").isNotNull())
        .join(dim_currency.select("currency_key", "currency_code"), "currency_key")
        .groupBy("currency_code", "effective_date")
        .agg(F.min_by("mid_rate", table_rank(F.col("table_type"))).alias("mid_rate"))
    )


def snapshot_day(catalogue_stg: DataFrame) -> Column:
    """Scalar subquery: the snapshot of the batch, the largest staged text as a date."""
    return catalogue_stg.select(to_date_or_null(F.max("snapshot_date")).alias("d")).scalar()


def rates_on(fact_rates: DataFrame, dim_currency: DataFrame, day: Column) -> DataFrame:
    """As-of for one date: newest mid per currency not after ``day``, base currency 1."""
    past = usable_mids(fact_rates.where(F.col("effective_date") <= day), dim_currency)
    newest = latest_value(past, ["currency_code"], "mid_rate", "effective_date")
    return with_base(newest)


def with_base(rates: DataFrame) -> DataFrame:
    base = inline_table(rates.sparkSession, [(BASE_CODE,)], "currency_code")
    return rates.unionByName(base.withColumn("mid_rate", F.lit(1).cast(schemas.RATE)))


# --- prices --------------------------------------------------------------------------------


def valid_rows(catalogue_stg: DataFrame) -> DataFrame:
    return catalogue_stg.where(F.col("style_color").isNotNull() & (local_price(F.col("price_local")) > 0))


def unique_rows(catalogue_stg: DataFrame) -> DataFrame:
    """First valid row per (style, country, snapshot day) of a batch: the lowest price, as a number."""
    dated = valid_rows(catalogue_stg).withColumn(
        "snapshot_day", to_date_or_null(F.col("snapshot_date"))
    ).drop("snapshot_date", "load_batch_id")
    number = local_price(F.col("price_local"))
    return first_row(dated, ["style_color", "country_code", "snapshot_day"], [number, "price_local"])


def category_labels(dim_category: DataFrame) -> DataFrame:
    return dim_category.where("category_level = 2").select("category", "subcategory", "category_key")


def keyed_prices(
    catalogue_stg: DataFrame, dims: dict[str, DataFrame], unique: bool = False
) -> DataFrame:
    """Valid staged rows with the keys of all five dimensions (inner joins).

    ``unique`` says the batch already holds one row per style, country and snapshot.
    Collapsing comes first, so afterwards a style has at most markets x days rows and the
    product join meets no hot key; categories may stay hot and use the salted lookup.
    """
    if unique:
        rows = valid_rows(catalogue_stg).withColumn(
            "snapshot_day", to_date_or_null(F.col("snapshot_date"))
        )
    else:
        rows = unique_rows(catalogue_stg)
    products = dims["dim_product"].where("is_current").select("product_key", "style_color")
    markets = dims["dim_geography"].select("geo_key", "country_code")
    days = F.broadcast(dims["dim_date"].select("date_key", F.col("full_date").alias("snapshot_day")))
    currencies = dims["dim_currency"].select("currency_key", F.col("currency_code").alias("currency"))
    rows = rows.join(days, "snapshot_day").join(products, "style_color")
    rows = lookup_join(rows, markets, ["country_code"])
    rows = lookup_join(rows, currencies, ["currency"])
    return lookup_join(rows, category_labels(dims["dim_category"]), ["category", "subcategory"])


def priced(keyed: DataFrame, rates: DataFrame) -> DataFrame:
    """Fact rows from keyed rows; a currency without rate keeps its row, prices are NULL.

    ``rates`` is (currency_code, mid_rate), one row per currency.
    """
    eur = rates.where(F.col("currency_code") == EUR).select("mid_rate").scalar()
    usd = rates.where(F.col("currency_code") == USD).select("mid_rate").scalar()
    by_code = rates.withColumnRenamed("currency_code", "currency")
    return fact_columns(lookup_join(keyed, by_code, ["currency"], "left"), eur, usd)


def fitting(price: Column, local: Column, *rates: Column) -> Column:
    """A converted price; one that exists but does not fit its column fails the load."""
    asked = local.isNotNull()
    for rate in rates:
        asked = asked & (rate > 0)
    message = F.concat(F.lit("converted price out of range: "), local.cast("string"))
    return F.when(asked & price.isNull(), F.raise_error(message)).otherwise(price)


def fact_columns(rows: DataFrame, eur: Column, usd: Column) -> DataFrame:
    """Fact rows from rows with keys and rates. A price is read and converted once a row, as columns of their own."""
    local, mid = F.col("_local"), F.col("mid_rate")
    read = rows.withColumn("_local", local_price(F.col("price_local")))
    converted = read.withColumns({
        "_pln": convert(local, mid), "_eur": convert_cross(local, mid, eur), "_usd": convert_cross(local, mid, usd)})
    return converted.select(
        price_key(F.col("product_key"), F.col("geo_key"), F.col("snapshot_day")).alias("price_key"),
        "product_key", "geo_key", "currency_key", "date_key", "category_key",
        local.alias("local_price"),
        local_price(F.col("sale_price_local")).alias("sale_price_local"),
        to_decimal(F.col("discount_pct"), 6, 2).alias("discount_pct"),
        fitting(F.col("_pln"), local, mid).alias("price_pln"),
        fitting(F.col("_eur"), local, mid, eur).alias("price_eur"),
        fitting(F.col("_usd"), local, mid, usd).alias("price_usd"),
        to_boolean(F.col("in_stock")).alias("in_stock"),
        F.lit(True).alias("is_catalogue_price"),
        F.current_timestamp().alias("etl_load_date"),
    )


def batch_days(catalogue_stg: DataFrame) -> tuple[date | None, date | None, date | None]:
    """(snapshot, first day, last day) of a written batch, in one scan of one column."""
    text, day = F.col("snapshot_date"), to_date_or_null(F.col("snapshot_date"))
    return tuple(catalogue_stg.agg(to_date_or_null(F.max(text)), F.min(day), F.max(day)).head())


def not_loaded_yet(rows: DataFrame, fact: DataFrame, first: date, last: date) -> DataFrame:
    """Guard of the incremental load: drop rows whose grain the fact already holds.

    Only the fact's days between the batch's first and last snapshot matter; the literal
    bounds prune the fact's day folders before the anti join.
    """
    held = fact.where(F.col("date_key").between(date_key(F.lit(first)), date_key(F.lit(last))))
    keys = ["product_key", "geo_key", "date_key"]
    return rows.join(held.select(*keys), keys, "left_anti").select(*rows.columns)


def new_prices(
    fact: DataFrame, catalogue_stg: DataFrame, dims: dict[str, DataFrame], fact_rates: DataFrame,
    unique: bool = False, rates: DataFrame | None = None,
) -> DataFrame:
    """Price rows to append for a written batch: keys, conversion, guard.

    The whole batch converts at the rates of its newest snapshot; a load passes them as
    ``rates`` where it has written them already. A batch without a readable snapshot
    loads nothing.
    """
    snapshot, first, last = batch_days(catalogue_stg)
    if first is None:
        return fact.where(F.lit(False))
    if rates is None:
        rates = rates_on(fact_rates, dims["dim_currency"], F.lit(snapshot).cast("date"))
    rows = priced(keyed_prices(catalogue_stg, dims, unique), rates)
    return not_loaded_yet(rows, fact, first, last)


def daily_rates(
    fact_rates: DataFrame, dim_currency: DataFrame, dim_date: DataFrame, first: Column, last: Column
) -> DataFrame:
    """Rate in force per currency and day, with the day's EUR and USD rates beside it."""
    mids = usable_mids(fact_rates.where(F.col("effective_date") <= last), dim_currency)
    quoted = rates_in_force(mids, "currency_code", "effective_date", "mid_rate", first, last)
    base = dim_date.where(F.col("full_date").between(first, last)).select(
        F.lit(BASE_CODE).alias("currency_code"),
        F.col("full_date").alias("day"),
        F.lit(1).cast(schemas.RATE).alias("mid_rate"),
        F.col("full_date").alias("quoted_on"),
    )
    daily = quoted.unionByName(base)
    crosses = daily.groupBy("day").agg(
        F.max(F.when(F.col("currency_code") == EUR, F.col("mid_rate"))).alias("eur"),
        F.max(F.when(F.col("currency_code") == USD, F.col("mid_rate"))).alias("usd"),
    )
    return daily.join(crosses, "day")


def priced_per_row(
    catalogue_stg: DataFrame, dims: dict[str, DataFrame], fact_rates: DataFrame, unique: bool = False
) -> DataFrame:
    """As-of per row: every row converts at the rates in force on its own snapshot day."""
    first, last = (F.lit(day).cast("date") for day in batch_days(catalogue_stg)[1:])
    daily = daily_rates(fact_rates, dims["dim_currency"], dims["dim_date"], first, last)
    # written once: the lookup then judges its size by its files, and nothing is planned twice
    path = f"{work_dir(fact_rates.sparkSession)}/daily-rates-{uuid.uuid4().hex}"
    daily.withColumnsRenamed({"currency_code": "currency", "day": "snapshot_day"}).write.parquet(path)
    table = fact_rates.sparkSession.read.parquet(path)
    keyed = keyed_prices(catalogue_stg, dims, unique)
    rows = lookup_join(keyed, table, ["currency", "snapshot_day"], "left")
    return fact_columns(rows, F.col("eur"), F.col("usd"))


# --- rejects and unmatched rows -------------------------------------------------------------


def rejects(catalogue_stg: DataFrame, batch_id: int | None) -> DataFrame:
    """Reject records of a batch with their reason; the first rule that applies wins."""
    key, price = F.col("style_color"), F.col("price_local")
    return (
        catalogue_stg.withColumn("reject_reason", reject_reason(key, price))
        .where(F.col("reject_reason").isNotNull())
        .select(
            F.lit(CATALOGUE_SOURCE).alias("source_table"),
            raw_row_text(key, F.col("country_code"), price).alias("raw_row"),
            "reject_reason",
            F.lit(batch_id).cast("int").alias("load_batch_id"),
            F.current_timestamp().alias("logged_at"),
        )
    )


def refresh_reject_log(log: DataFrame, catalogue_stg: DataFrame, batch_id: int | None) -> DataFrame:
    """The log after a load: old records of this source replaced, other sources kept."""
    kept = log.where(F.col("source_table") != CATALOGUE_SOURCE)
    return kept.unionByName(rejects(catalogue_stg, batch_id))


def split_valid(catalogue_stg: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(valid, rejected) before staging: a blank style or a price not above zero is refused."""
    key = F.coalesce(F.trim("style_color"), F.lit(""))
    bad = (key == "") | F.coalesce(local_price(F.col("price_local")) <= 0, F.lit(True))
    flagged = catalogue_stg.withColumn("_bad", bad)
    return flagged.where(~F.col("_bad")).drop("_bad"), flagged.where("_bad").drop("_bad")


def unmatched_rows(catalogue_stg: DataFrame, dims: dict[str, DataFrame]) -> DataFrame:
    """Valid staged rows that the inner lookups lose, with one flag per missing dimension.

    Equal rows are counted first, so copies do not travel through the lookups.
    """
    names = ["style_color", "country_code", "snapshot_date", "currency", "category", "subcategory"]
    rows = (
        valid_rows(catalogue_stg).groupBy(*names).agg(F.count("*").alias("n_rows"))
        .withColumn("snapshot_day", to_date_or_null(F.col("snapshot_date")))
    )
    yes = F.lit(True)
    products = dims["dim_product"].where("is_current").select("style_color", yes.alias("_p"))
    markets = dims["dim_geography"].select("country_code", yes.alias("_g"))
    days = F.broadcast(
        dims["dim_date"].select(F.col("full_date").alias("snapshot_day"), yes.alias("_d"))
    )
    currencies = dims["dim_currency"].select(F.col("currency_code").alias("currency"), yes.alias("_c"))
    labels = category_labels(dims["dim_category"]).select("category", "subcategory", yes.alias("_k"))
    rows = rows.join(days, "snapshot_day", "left").join(products, "style_color", "left")
    rows = lookup_join(rows, markets, ["country_code"], "left")
    rows = lookup_join(rows, currencies, ["currency"], "left")
    rows = lookup_join(rows, labels, ["category", "subcategory"], "left")
    flags = {
        "_p": "no_product", "_g": "no_market", "_d": "no_day", "_c": "no_currency", "_k": "no_category",
    }
    lost = F.lit(False)
    for f in flags:
        lost = lost | F.col(f).isNull()
    return rows.where(lost).select(
        *names, *[F.col(f).isNull().alias(name) for f, name in flags.items()], "n_rows"
    )


def unmatched_rates(rates_stg: DataFrame, dims: dict[str, DataFrame]) -> DataFrame:
    """Staged quotes that the rate load loses, with one flag per missing dimension and the rows concerned.

    Quotes without a code are not loaded either and have their own flag. A date that is none
    has no day. Equal quotes are counted first.
    """
    rows = (
        rates_stg.groupBy("table_type", "code", "effective_date").agg(F.count("*").alias("n_rows"))
        .withColumn("effective_day", to_date_or_null(F.col("effective_date")))
    )
    yes = F.lit(True)
    days = F.broadcast(dims["dim_date"].select(F.col("full_date").alias("effective_day"), yes.alias("_d")))
    codes = dims["dim_currency"].select(F.col("currency_code").alias("code"), yes.alias("_c"))
    known = lookup_join(rows.join(days, "effective_day", "left"), codes, ["code"], "left")
    flags = {"no_code": F.col("code").isNull(), "no_currency": F.col("code").isNotNull() & F.col("_c").isNull(), "no_day": F.col("_d").isNull()}
    return known.where(flags["no_code"] | flags["no_currency"] | flags["no_day"]).select(
        "table_type", "code", "effective_date", "n_rows", *[flag.alias(name) for name, flag in flags.items()])
