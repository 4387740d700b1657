from datetime import date, timedelta

from pyspark.sql import functions as F

from crossmart.operators.joins import fits_broadcast, lookup_join, missing_in, rates_in_force
from crossmart.operators.keys import assign_keys, highest_key
from crossmart.operators.pick import first_row, latest_value
from crossmart.plans import calendar as cal


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_first_row_is_independent_of_partitioning(spark):
    rows = spark.range(4000).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("k"), F.col("id") % 50)).alias("k"),
        F.concat(F.lit("sku"), 9999 - F.col("id")).alias("sku"), (F.col("id") % 7).alias("v"),
    )
    one = {tuple(r) for r in first_row(rows.repartition(1), ["k"], ["sku"]).collect()}
    many = {tuple(r) for r in first_row(rows.repartition(13, "sku"), ["k"], ["sku"]).collect()}
    assert one == many and len(one) == rows.select("k").distinct().count()


def test_first_row_cuts_hot_keys_before_the_shuffle(spark):
    rows = spark.range(1000).select((F.col("id") % 2).alias("k"), F.col("id").alias("o"))
    assert plan(first_row(rows, ["k"], ["o"])).count("WindowGroupLimit") >= 1


def test_latest_value(spark):
    rows = spark.createDataFrame(
        [("a", date(2026, 1, 1), 1), ("a", date(2026, 1, 3), 2), ("b", date(2026, 1, 2), 3)], "k string, d date, v int"
    )
    assert dict(latest_value(rows, ["k"], "v", "d").collect()) == {"a": 2, "b": 3}


def test_keys_are_unique_repeatable_and_above_the_start(spark):
    names = spark.range(20000).select(F.concat(F.lit("n"), "id").alias("n"))
    first = assign_keys(names.repartition(7), ["n"], "key", 100)
    again = assign_keys(names.repartition(3), ["n"], "key", 100)
    assert first.exceptAll(again).isEmpty()
    low, high, distinct = first.agg(F.min("key"), F.max("key"), F.countDistinct("key")).head()
    assert low > 100 and distinct == 20000 and high < 100 + 3 * 20000
    assert first.select(highest_key(first, "key")).head()[0] == high


def test_salted_lookup_equals_plain_join(spark):
    facts = spark.range(5000).select(
        "id", F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 40).alias("k")
    )
    dim = spark.range(30).select(F.col("id").alias("k"), (F.col("id") * 10).alias("name"))
    for how in ("inner", "left"):
        salted = lookup_join(facts, dim, ["k"], how, rows=5)
        assert not fits_broadcast(dim, 5)
        plain = facts.join(dim, "k", how)
        assert salted.exceptAll(plain).isEmpty() and plain.exceptAll(salted).isEmpty()
    assert {r.k for r in missing_in(facts, dim, "k").collect()} == set(range(30, 40))


def test_rates_in_force_fill_the_days_between_quotes(spark):
    quotes = spark.createDataFrame(
        [("USD", date(2026, 1, 2), 1.0), ("USD", date(2026, 1, 5), 2.0), ("EUR", date(2026, 1, 6), 3.0)],
        "code string, at date, rate double",
    )
    first, last = F.lit(date(2026, 1, 1)), F.lit(date(2026, 1, 7))
    got = {(r.code, r.day): r.rate for r in rates_in_force(quotes, "code", "at", "rate", first, last).collect()}
    want = {}
    for code, history in {"USD": [(2, 1.0), (5, 2.0)], "EUR": [(6, 3.0)]}.items():
        for day in range(1, 8):
            known = [rate for d, rate in history if d <= day]
            if known:
                want[code, date(2026, 1, day)] = known[-1]
    assert got == want


def test_calendar_golden_values(spark):
    days = cal.calendar(spark)
    assert days.count() == 9496
    by_key = {r.date_key: r for r in days.where("date_key IN (20240101, 20240106, 20260503, 20241230)").collect()}
    new_year, monday = by_key[20240101], by_key[20241230]
    assert (new_year.week_of_year, new_year.day_of_week, new_year.is_nbp_working_day) == (1, 1, False)
    assert by_key[20240106].is_weekend and not by_key[20260503].is_nbp_working_day
    assert (monday.week_of_year, monday.month_name, monday.is_nbp_working_day) == (1, "December", True)


def test_working_days_follow_publications(spark):
    days = cal.calendar(spark, date(2026, 3, 2), date(2026, 3, 15))
    published = spark.createDataFrame(
        [(20260303, date(2026, 3, 3)), (20260307, date(2026, 3, 7)), (20260310, date(2026, 3, 10))],
        "date_key int, effective_date date",
    )
    flags = {r.date_key: r.is_nbp_working_day for r in cal.refresh_working_days(days, published).collect()}
    assert flags[20260303] and flags[20260307] and flags[20260310]  # a published Saturday counts
    assert not flags[20260304] and not flags[20260309]  # weekdays without publication
    assert flags[20260302] and flags[20260311]  # outside the published range


def test_no_publications_leave_the_calendar_alone(spark):
    days = cal.calendar(spark, date(2026, 3, 2), date(2026, 3, 8))
    none = spark.createDataFrame([], "date_key int, effective_date date")
    assert cal.refresh_working_days(days, none).exceptAll(days).isEmpty()


def test_segments(spark):
    first, last = date(2026, 1, 1), date(2026, 6, 29)
    got = [tuple(r) for r in cal.date_segments(spark, first, last).orderBy("segment_start").collect()]
    assert got == [(first, date(2026, 3, 31)), (date(2026, 4, 1), last)]
    covered = sum((hi - lo).days + 1 for lo, hi in got)
    assert covered == (last - first).days + 1 and max(hi - lo for lo, hi in got) <= timedelta(days=89)
    assert cal.date_segments(spark, last, first).isEmpty()
    single = cal.date_segments(spark, first, first).collect()
    assert [tuple(r) for r in single] == [(first, first)]


def test_relative_range(spark):
    lo, hi = spark.range(1).select(*[c.alias(n) for c, n in zip(cal.last_days(7), "ab")]).head()
    assert (hi - lo).days == 7
