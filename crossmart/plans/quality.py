"""Checks over staging, facts and views; each returns figures, not just a verdict."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from crossmart.functions import to_date_or_null
from crossmart.functions.cleaning import local_price
from crossmart.operators.joins import lookup_join
from crossmart.plans import facts, marts
from crossmart.session import work_dir

Tables = dict[str, DataFrame]

MIN_TABLE_A = 32
DRIFT_LIMIT = 0.20
MAX_REQUEST_DAYS = 93


def completeness(source: DataFrame, staged: DataFrame) -> DataFrame:
    """Staged rows against source rows."""
    rows = source.select(F.count("*").alias("n")).scalar()
    return staged.agg(F.count("*").alias("staged_rows")).select(
        rows.alias("source_rows"), "staged_rows", (F.col("staged_rows") == rows).alias("passed")
    )


def no_loss(catalogue_stg: DataFrame, t: Tables) -> DataFrame:
    """Valid staged rows against those found in the fact by their natural keys.

    Staged rows are counted per natural key first; the keys then look for their fact row.
    """
    day = to_date_or_null(F.col("snapshot_date")).alias("snapshot_day")
    grain = facts.valid_rows(catalogue_stg).groupBy("style_color", "country_code", day).agg(
        F.count("*").alias("_rows")
    )
    products = t["dim_product"].where("is_current").select("product_key", "style_color")
    markets = t["dim_geography"].select("geo_key", "country_code")
    days = F.broadcast(t["dim_date"].select("date_key", F.col("full_date").alias("snapshot_day")))
    keys = ["product_key", "geo_key", "date_key"]
    stored = t["fact_prices"].select(*keys, F.lit(1).alias("_stored"))
    looked_up = (
        lookup_join(grain.join(days, "snapshot_day", "left"), markets, ["country_code"], "left")
        .join(products, "style_color", "left").join(stored, keys, "left")
    )
    return looked_up.agg(
        F.coalesce(F.sum("_rows"), F.lit(0)).alias("valid_rows"),
        F.count("*").alias("valid_grain_rows"),
        F.count("_stored").alias("matched_rows"),
        F.count_if(F.col("_stored").isNull()).alias("lost_rows"),
    )


def reconciliation(catalogue_stg: DataFrame, t: Tables) -> DataFrame:
    """Staged rows against stored prices plus logged rejects, by count alone."""
    prices = t["fact_prices"].select(F.count("*").alias("n")).scalar()
    refused = t["reject_log"].select(F.count("*").alias("n")).scalar()
    return catalogue_stg.agg(F.count("*").alias("staged")).select(
        "staged", prices.alias("stored"), refused.alias("rejected"),
        (F.col("staged") == prices + refused).alias("passed"),
    )


def rejects_explained(t: Tables) -> DataFrame:
    """Bad prices in the fact, and rejects by kind of reason."""
    bad = t["fact_prices"].where("local_price <= 0").select(F.count("*").alias("n")).scalar()
    return t["reject_log"].agg(
        F.count("*").alias("rejects"),
        F.count_if(F.col("reject_reason").startswith("price")).alias("price_rejects"),
        F.count_if(F.col("reject_reason").isNull() | (F.col("reject_reason") == "unknown"))
        .alias("unexplained"),
    ).withColumn("bad_prices_in_fact", bad)


def table_a_coverage(t: Tables, minimum: int = MIN_TABLE_A) -> DataFrame:
    """Currencies of table A and missing mids among its rows."""
    rows = t["fact_rates"].where(F.col("table_type") == "A")
    return rows.agg(
        F.countDistinct("currency_key").alias("currencies"),
        F.count_if(F.col("mid_rate").isNull()).alias("null_mids"),
    ).withColumn("passed", (F.col("currencies") >= minimum) & (F.col("null_mids") == 0))


def long_segments(segments: DataFrame, limit: int = MAX_REQUEST_DAYS) -> DataFrame:
    days = F.datediff("segment_end", "segment_start") + 1
    return segments.agg(
        F.count("*").alias("segments"), F.max(days).alias("longest_days"),
        F.count_if(days > limit).alias("too_long"),
    )


def missing_keys(prices: DataFrame, t: Tables, names: dict[str, str]) -> DataFrame:
    """(field, key) pairs of price rows without a dimension row, from one scan of the prices."""
    cells = [F.struct(F.lit(key).alias("field"), F.col(key).cast("long").alias("key")) for key in names.values()]
    used = prices.select(F.inline(F.array(*cells))).where("key IS NOT NULL").distinct()
    known = None
    for name, key in names.items():
        keys = t[name].select(F.lit(key).alias("field"), F.col(key).cast("long").alias("key"))
        known = keys if known is None else known.unionByName(keys)
    return used.join(known, ["field", "key"], "left_anti")


def orphans(t: Tables) -> DataFrame:
    """Price rows whose key is missing in some dimension, with one flag per dimension.

    The different keys of all columns are looked up first and the missing ones written
    once; raw rows meet only the lists that are not empty.
    """
    names = {
        "dim_product": "product_key", "dim_geography": "geo_key", "dim_currency": "currency_key",
        "dim_date": "date_key", "dim_category": "category_key",
    }
    prices = t["fact_prices"].select("price_key", *names.values())
    scratch = f"{work_dir(prices.sparkSession)}/missing-{uuid.uuid4().hex}"
    missing_keys(prices, t, names).write.partitionBy("field").parquet(scratch)
    missing = prices.sparkSession.read.schema("key long, field string").parquet(scratch)
    found = {r.field for r in missing.select("field").distinct().collect()}  # five at most
    rows = prices
    for key in names.values():
        flag = F.lit(None).cast("boolean") if key not in found else None
        if flag is None:
            gone = missing.where(F.col("field") == key).select(F.col("key").alias(key), F.lit(True).alias(f"_no_{key}"))
            rows = lookup_join(rows, gone, [key], "left")
        else:
            rows = rows.withColumn(f"_no_{key}", flag)
    no = {key: F.col(f"_no_{key}").isNotNull() | F.col(key).isNull() for key in names.values()}
    lost = F.lit(False)
    for flag in no.values():
        lost = lost | flag
    return rows.where(lost).select("price_key", *[flag.alias(f"no_{key}") for key, flag in no.items()])


def content_digest(rows: DataFrame, columns: list[str]) -> DataFrame:
    """One row that stands for a multiset of rows, whatever their order: their number and two sums of hashes.

    Equal rows count as often as they stand there, so a row swapped for a copy of another
    one changes the sums; nulls and empty texts differ. Partial sums are all that moves.
    """
    cells = [F.col(c).cast("string") for c in columns]
    marked = F.concat_ws("\x1f", *[F.coalesce(F.concat(F.lit("="), c), F.lit("-")) for c in cells])
    hashes = [F.xxhash64(F.lit(seed), marked).cast("decimal(20,0)") for seed in (1, 2)]
    return rows.agg(F.count("*").alias("rows"), *[F.coalesce(F.sum(h), F.lit(0)).alias(f"digest_{i}") for i, h in enumerate(hashes, 1)])


def same_content(left: DataFrame, right: DataFrame, columns: list[str]) -> DataFrame:
    """(rows_left, rows_right, same_content) of two tables, compared as multisets of rows."""
    a, b = content_digest(left, columns), content_digest(right, columns)
    whole = lambda df: df.select(F.struct("*").alias("d")).scalar()
    row = left.sparkSession.range(1).select(whole(a).alias("a"), whole(b).alias("b"))
    return row.select(F.col("a.rows").alias("rows_left"), F.col("b.rows").alias("rows_right"), (F.col("a") == F.col("b")).alias("same_content"))


def duplicate_keys(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Rows, distinct keys and the verdict; keys are combined before they are counted."""
    groups = rows.groupBy(*keys).agg(F.count("*").alias("_n"))
    return groups.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("n_rows"), F.count("*").alias("n_keys"),
        F.count_if(F.col("_n") > 1).alias("repeated_keys"),
    )


def conversion_error(t: Tables, catalogue_stg: DataFrame) -> DataFrame:
    """Largest deviation of the stored price from local price times rate, per currency."""
    day = F.lit(facts.batch_days(catalogue_stg)[0]).cast("date")
    rates = facts.rates_on(t["fact_rates"], t["dim_currency"], day)
    codes = t["dim_currency"].select("currency_key", "currency_code").join(rates, "currency_code")
    error = F.abs(F.col("price_pln") - F.col("local_price") * F.col("mid_rate"))
    return (
        t["fact_prices"].select("currency_key", "local_price", "price_pln").join(codes, "currency_key")
        .groupBy("currency_code")
        .agg(F.count("price_pln").alias("n_prices"), F.max(error).alias("max_error"))
        .withColumn("passed", F.coalesce(F.col("max_error") <= F.lit("0.001").cast("decimal(4,3)"), F.lit(True)))
    )


def margin_recheck(t: Tables) -> DataFrame:
    """Published margins against the ones recomputed from the fact's extremes."""
    sensible = t["fact_prices"].where(F.col("price_pln").between(1, 50000))
    current = t["dim_product"].where("is_current").select("product_key", "style_color")
    manual = (
        sensible.groupBy("product_key").agg(F.min("price_pln").alias("lo"), F.max("price_pln").alias("hi"))
        .join(current, "product_key")
    )
    lo, hi = F.col("lo").cast("double"), F.col("hi").cast("double")
    both = marts.product_arbitrage(t).join(manual, "style_color")
    error = F.abs(F.col("margin_pct").cast("double") - 100 * (hi - lo) / lo)
    return both.agg(
        F.count("*").alias("products"), F.count_if(error > 0.5).alias("deviating"),
        F.count_if(F.col("max_price_pln") > 50000).alias("outliers_listed"),
    )


def price_trace(catalogue_stg: DataFrame, t: Tables, by: list[str] | None = None) -> DataFrame:
    """Every loaded price followed from staging through the fact to the view, per group of ``by``."""
    staged = facts.unique_rows(catalogue_stg).select(
        "style_color", "country_code", F.col("snapshot_day").alias("snapshot_date"),
        local_price(F.col("price_local")).alias("staged_price"),
    )
    keys = ["style_color", "country_code", "snapshot_date"]
    seen = marts.price_enriched(t).select(*keys, "price_key", F.col("local_price").alias("view_price"))
    stored = t["fact_prices"].select("price_key", F.col("local_price").alias("fact_price"))
    traced = staged.join(seen, keys).join(stored, "price_key")
    gap = F.greatest("staged_price", "fact_price", "view_price") - F.least(
        "staged_price", "fact_price", "view_price"
    )
    return traced.groupBy(*(by or [])).agg(
        F.count("*").alias("traced"),
        F.count_if(gap >= F.lit("0.01").cast("decimal(3,2)")).alias("deviating"),
    )


def reload_growth(t: Tables, rates_stg: DataFrame) -> DataFrame:
    """Rate rows before and after loading the same staging again."""
    again = facts.new_rates(t["fact_rates"], rates_stg, t["dim_currency"], t["dim_date"])
    added = again.select(F.count("*").alias("n")).scalar()
    return t["fact_rates"].agg(F.count("*").alias("rows_before")).withColumn("rows_added", added)


def volume_drift(audit: DataFrame, limit: float = DRIFT_LIMIT) -> DataFrame:
    """Runs whose input differs from the previous successful run's by more than the limit."""
    done = audit.where("status = 'SUCCESS'")
    # the audit holds one row per load ever run, so one ordered pass over it is small
    previous = F.lag("rows_in").over(Window.partitionBy("package_name").orderBy("run_id"))
    change = F.abs(F.col("rows_in") - previous) / F.nullif(previous, F.lit(0))
    return done.select(
        "run_id", "load_type", "rows_in", previous.alias("previous_rows_in"),
        F.coalesce(change > limit, F.lit(False)).alias("alert"),
    )


def latest_run(audit: DataFrame) -> DataFrame:
    return audit.orderBy(F.desc("run_id")).limit(1)


def snapshot_dates(catalogue_stg: DataFrame) -> DataFrame:
    """Snapshots of a batch with their rows; unreadable dates are listed as NULL."""
    return catalogue_stg.groupBy(to_date_or_null(F.col("snapshot_date")).alias("snapshot")).agg(
        F.count("*").alias("n")
    )
