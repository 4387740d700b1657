"""Profile in one scan, spans over days and months, content-addressed history, lost quotes."""

import statistics
from datetime import date, timedelta

from pyspark.sql import functions as F

from crossmart.operators import joins
from crossmart.plans import dims, facts, measures, profile, quality
from tests import builders

DAY = date(2026, 3, 19)


def scans(df):
    return df._jdf.queryExecution().executedPlan().toString().count("FileScan parquet")


def test_the_profile_summary_reads_its_file_once(spark, tmp_path):
    columns = {c: None for c in profile.PROFILED}
    rows = [
        {**columns, "style_color": s, "country_code": c, "snapshot_date": d, "currency": "USD" if c == "US" else "XXX", "price_local": p, "sale_price_local": q}
        for s, c, d, p, q in [("a", "US", "1", "5", "6"), ("a", "US", "1", "5", None), ("a", "GB", "2", "x", None), ("b", "US", "1", "0", "nan"),
                              ("", "US", "1", "nan", "1"), (None, None, None, None, None)]
    ]
    path = str(tmp_path / "raw-rows")
    spark.createDataFrame([tuple(r.values()) for r in rows], ", ".join(f"{c} string" for c in profile.PROFILED)).write.parquet(path)
    codes = spark.createDataFrame([("USD", "A"), ("XXX", "C")], "currency_code string, nbp_table_type string")
    found = profile.summary(spark.read.parquet(path), codes)
    assert scans(found) == 1
    assert dict(found.collect()) == {
        "total_raw_rows": 6, "price_le_zero": 1, "price_nonnumeric": 1, "sale_gt_price": 1, "distinct_country_code": 2, "distinct_currency": 2,
        "distinct_style_color": 2, "products_in_2plus_countries": 1, "products_in_5plus_countries": 0, "max_countries_per_product": 2,
        "grain_rows": 3, "uncovered_currencies": 1}
    empty = dict(profile.summary(spark.read.parquet(path).where("false"), codes).collect())
    assert empty["total_raw_rows"] == 0 and empty["max_countries_per_product"] is None


def rate_tables(spark, quotes):
    fact = spark.createDataFrame([(1, "A", d, m) for d, m in quotes], "currency_key long, table_type string, effective_date date, m double").select(
        "currency_key", "table_type", "effective_date", F.col("m").cast("decimal(18,6)").alias("mid_rate"))
    return {"fact_rates": fact, "dim_currency": spark.createDataFrame([(1, "USD")], "currency_key long, currency_code string")}


def test_the_average_spans_days_not_rows(spark):
    quotes = [(DAY, 4.0), (DAY + timedelta(29), 2.0), (DAY + timedelta(30), 3.0), (DAY + timedelta(90), 9.0)]
    got = {r.effective_date: r for r in measures.against_average(rate_tables(spark, quotes)).collect()}
    assert [got[d].quotes for d, _ in quotes] == [1, 2, 2, 1]
    assert [got[d].average for d, _ in quotes] == [4.0, 3.0, 2.5, 9.0]
    assert got[DAY + timedelta(90)].deviation == 0


def test_merged_moments_equal_plain_deviations(spark):
    quotes = [(DAY + timedelta(11 * i), 3.5 + (i * 37 % 17) / 10) for i in range(60) if not 20 < i < 35]
    got = measures.span_volatility(rate_tables(spark, quotes)).collect()
    assert len(got) == 3 * len({(d.year, d.month) for d, _ in quotes})
    for r in got:
        end = r.year * 12 + r.month
        span = [m for d, m in quotes if 0 <= end - (d.year * 12 + d.month) < r.months]
        assert r.quotes == len(span) and abs(r["mean"] - statistics.fmean(span)) < 1e-9
        assert (r.volatility is None) == (len(span) == 1)
        assert len(span) == 1 or abs(r.volatility - statistics.stdev(span)) < 1e-9


def test_a_content_addressed_history_needs_no_numbers(spark):
    def products(*rows):
        return spark.createDataFrame(rows, "style_color string, product_name string, color_name string, gender_segment string, category string, model_number string")

    first = products(("S1", "a", None, "m", "c", "1"), ("S2", "a", "", "m", "c", "1"))
    one = dims.load_addressed(dims.no_addressed(spark), first, DAY)
    assert one.count() == 2 and len({r.change_digest for r in one.collect()}) == 2  # null and empty differ
    assert sorted(map(str, dims.load_addressed(one, first, date(2026, 4, 1)).collect())) == sorted(map(str, one.collect()))
    two = dims.load_addressed(one, products(("S1", "a", "red", "m", "c", "1"), ("S3", "x", "y", "m", "c", "1")), date(2026, 4, 1))
    rows = {(r.style_color, r.is_current): r for r in two.collect()}
    assert len(rows) == 4 and rows["S1", False].valid_to == date(2026, 3, 31) and rows["S1", True].valid_from == date(2026, 4, 1)
    assert rows["S1", False].version_hash != rows["S1", True].version_hash and rows["S2", True].valid_from == DAY
    assert dims.version_faults(two.withColumn("product_key", F.xxhash64("version_hash"))).count() == 0


def test_lost_quotes_have_their_reasons(spark):
    rates = builders.rates(spark, {}, {}, {"code": "ZZZ"}, {"code": None}, {"effective_date": "soon"}, {"effective_date": "2031-01-01"})
    tables = {
        "dim_date": spark.createDataFrame([(date(2026, 3, 18),)], "full_date date"),
        "dim_currency": spark.createDataFrame([("USD",)], "currency_code string")}
    got = {(r.code, r.effective_date): (r.n_rows, r.no_code, r.no_currency, r.no_day) for r in facts.unmatched_rates(rates, tables).collect()}
    assert got == {
        ("ZZZ", "2026-03-18"): (1, False, True, False), (None, "2026-03-18"): (1, True, False, False),
        ("USD", "soon"): (1, False, False, True), ("USD", "2031-01-01"): (1, False, False, True)}


def test_stored_dimensions_are_judged_without_a_job(spark, tmp_path):
    path = str(tmp_path / "dim")
    spark.range(50).selectExpr("id AS k", "id * 2 AS v").write.parquet(path)
    stored = spark.read.parquet(path)
    assert 0 < joins.stored_bytes(stored.where("k > 3").select("v")) < joins.BROADCAST_BYTES
    assert joins.stored_bytes(stored.groupBy("k").count()) is None
    assert joins.stored_bytes(stored.selectExpr("explode(sequence(0, 1000000)) AS x")) is None


def test_orphans_of_null_and_missing_keys(spark):
    rows = [(1, 1, 1, 1, 1, 1), (2, 9, 1, 1, 1, 1), (3, 1, None, 1, 8, 1), (4, None, 1, 1, 1, 1)]
    one = {"dim_product": "product_key", "dim_geography": "geo_key", "dim_currency": "currency_key", "dim_date": "date_key", "dim_category": "category_key"}
    t = {name: spark.createDataFrame([(1,)], f"{key} {'int' if key in ('geo_key', 'date_key') else 'long'}") for name, key in one.items()}
    t["fact_prices"] = spark.createDataFrame(rows, "price_key long, product_key long, geo_key int, currency_key long, date_key int, category_key long")
    got = {r.price_key: (r.no_product_key, r.no_geo_key, r.no_date_key) for r in quality.orphans(t).collect()}
    assert got == {2: (True, False, False), 3: (False, True, True), 4: (True, False, False)}
    assert quality.orphans({**t, "fact_prices": t["fact_prices"].where("price_key = 1")}).count() == 0
