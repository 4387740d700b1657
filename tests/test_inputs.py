"""Queries load what they read: rates or staging alone where no price is asked for."""

import os
import re

import __spark_entry__ as entry
import pytest
from pyspark.sql import functions as F

from crossmart.plans import facts
from crossmart.sources import demo
from tools.compare import connect, sorted_rows

ALONE = {
    "a9_value_counts": {"lineitem", "part"}, "a11_null_counts": {"lineitem", "part"}, "s8_extract": {"lineitem", "part"},
    "s9_profile_rows": {"lineitem", "part", "events"}, "j13_coverage": {"lineitem", "events"},
    "w5_previous_rate": {"events"}, "b13_rate_trend_total": {"events"}, "v5_fx_trend_30d": {"events"},
    "d4_working_days": {"events"}, "s1_catalogue_csv": {"lineitem", "part"}, "m10_compacted_prices": {"lineitem", "part", "events"},
    "m15_load_modes": {"lineitem", "part", "events"}, "m7_version_faults": {"lineitem", "part"},
}


@pytest.mark.parametrize("name", sorted(ALONE))
def test_a_query_loads_only_what_it_reads(spark, sf_dir, tmp_path, name):
    for table in ALONE[name]:
        os.symlink(f"{sf_dir}/{table}.parquet", tmp_path / f"{table}.parquet")
    df = entry.queries()[name](spark, str(tmp_path))
    got = sorted_rows(df.columns, [tuple(r) for r in df.collect()])
    cursor = connect(sf_dir).execute(entry.oracle_sql()[name])
    assert got == sorted_rows([d[0] for d in cursor.description], cursor.fetchall())
    assert demo.loaded(spark, str(tmp_path)) is None


def test_the_markets_of_a_fact_are_combined_before_they_meet_the_dimension(spark, sf_dir):
    """Raw price rows do not travel by their market, of which there are few."""
    plan = entry.BUILDERS["b4_market_count"](entry.inputs(spark, spark.sparkContext.applicationId, sf_dir))._jdf.queryExecution().optimizedPlan()
    semi = plan.toString().split("LeftSemi")[1]
    assert semi.index("Aggregate [geo_key") < semi.index("Relation [price_key")


@pytest.mark.parametrize("name", ["m7_version_faults", "m7_product_reload"])
def test_products_are_made_without_staging_a_delivery(spark, sf_dir, tmp_path, name):
    """The history of products needs no price, so no delivery is collapsed, staged and read again for it."""
    for table in ("lineitem", "part"):
        os.symlink(f"{sf_dir}/{table}.parquet", tmp_path / f"{table}.parquet")
    i = entry.Inputs(spark, str(tmp_path))
    entry.BUILDERS[name](i).count()
    assert not {"wh", "catalogue_batch", "recolored"} & set(vars(i))


def test_a_price_is_read_and_converted_once_a_row(spark):
    """Text is parsed and the product with the rate divided once a row, however many columns use them."""
    rows = spark.sql(
        "SELECT id AS product_key, id AS geo_key, id AS currency_key, 20240115 AS date_key, id AS category_key, current_date() AS snapshot_day, "
        "string(id) AS price_local, string(id) AS sale_price_local, '1' AS discount_pct, 'true' AS in_stock, "
        "CAST(rand(1) AS DECIMAL(18,6)) AS mid_rate, CAST(rand(2) AS DECIMAL(18,6)) AS eur, CAST(rand(3) AS DECIMAL(18,6)) AS usd FROM range(9)")
    plan = facts.fact_columns(rows, F.col("eur"), F.col("usd"))._jdf.queryExecution().optimizedPlan().toString()
    assert len(re.findall(r"cast\(price_local#\d+ as decimal", plan)) == 1
    assert len(re.findall(r"/ ", plan)) == 2
