from decimal import ROUND_HALF_UP, Decimal

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from crossmart import functions as fn
from crossmart.functions.cleaning import local_price
from crossmart.plans import facts, marts


def column(spark, values, build, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r.out for r in df.select("i", build(F.col("v")).alias("out")).orderBy("i").collect()]


def test_cleaning(spark):
    assert column(spark, ["", "NA", None, " "], fn.blank_to_null) == [None, "NA", None, " "]
    assert column(spark, ["", "  ", None, "x"], fn.default_label) == ["(Unspecified)"] * 3 + ["x"]
    assert column(spark, ["True", "true", "1", "False", "false", "0", "yes", None], fn.to_boolean) == [
        True, True, True, False, False, False, None, None,
    ]
    assert column(spark, ["2026-03-19", "soon", "", None], fn.to_date_or_null)[1:] == [None] * 3
    assert column(spark, ["1.5", "x", None], fn.to_float) == [1.5, None, None]


def test_text_to_decimal(spark):
    texts = ["12.5", " 12.5 ", "1.005", "1e3", "1E3", "abc", "", None, "99999999999.99", "-3"]
    assert column(spark, texts, local_price) == [
        Decimal("12.50"), Decimal("12.50"), Decimal("1.01"), None, None, None, None, None, None,
        Decimal("-3.00"),
    ]


def test_reject_reasons_first_rule_wins(spark):
    rows = [(None, None), ("S", None), ("S", "n/a"), ("S", "0"), ("S", "-1"), ("S", "5")]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, k string, p string")
    got = [r.w for r in df.select("i", fn.reject_reason(F.col("k"), F.col("p")).alias("w")).orderBy("i").collect()]
    assert got == ["style_color NULL", "price NULL", "price not numeric", "price <= 0", "price <= 0", None]
    text = df.select(fn.raw_row_text(F.col("k"), F.lit(None).cast("string"), F.col("p")).alias("t")).head()[0]
    assert text == "style_color=|country=|price="


def test_null_and_blank_are_the_same_value(spark):
    df = spark.createDataFrame([(None, ""), (None, None), ("a", None), ("a", "a")], "a string, b string")
    assert [r[0] for r in df.select(fn.differs(F.col("a"), F.col("b"))).collect()] == [False, False, True, False]


def test_bands_use_the_unrounded_margin(spark):
    margins = [Decimal("20.04"), Decimal("20.00"), Decimal("10.00"), Decimal("9.99"), None]
    got = column(spark, margins, fn.arbitrage_band, "decimal(8,2)")
    assert got == ["HIGH (>20%)", "MEDIUM (10-20%)", "MEDIUM (10-20%)", "LOW (<10%)", "LOW (<10%)"]


def test_price_rules(spark):
    prices = [None, Decimal("0.99"), Decimal("1"), Decimal("50000"), Decimal("50000.01"), Decimal("100000")]
    assert column(spark, prices, fn.is_sensible, "decimal(14,4)") == [False, False, True, True, False, False]
    assert column(spark, prices, fn.is_outlier, "decimal(14,4)") == [False, False, False, False, True, True]
    buckets = column(
        spark, [Decimal(x) for x in ("1999.99", "2000", "5000", "10000", "20000", "100000")],
        fn.price_bucket, "decimal(14,4)",
    )
    assert buckets == ["<2k", "2k-5k", "5k-10k", "10k-20k", "20k-100k", ">=100k"]


money = st.decimals(min_value="0.01", max_value="99999999.99", places=2)
rate = st.decimals(min_value="0.000001", max_value="99.999999", places=6)


@settings(max_examples=15, deadline=None)
@given(st.lists(st.tuples(money, rate, rate), min_size=1, max_size=40))
def test_conversion_rounds_half_up_once(spark, rows):
    df = spark.createDataFrame(
        [(i, *r) for i, r in enumerate(rows)],
        "i int, local decimal(12,2), mid decimal(18,6), cross decimal(18,6)",
    )
    local, mid, cross = F.col("local"), F.col("mid"), F.col("cross")
    got = df.select(
        "i", fn.convert(local, mid).alias("a"), fn.convert_cross(local, mid, cross).alias("b")
    ).orderBy("i").collect()
    limit = Decimal(10) ** 10
    for row, (p, m, c) in zip(got, rows):
        exact = Decimal(p) * Decimal(m)
        place = Decimal("0.0001")
        want = exact.quantize(place, ROUND_HALF_UP)
        assert row.a == (want if want < limit else None)
        num, den = exact.as_integer_ratio()
        cn, cd = Decimal(c).as_integer_ratio()
        scaled = (2 * num * cd * 10000 + den * cn) // (2 * den * cn)
        assert row.b == (Decimal(scaled).scaleb(-4) if scaled < 10**14 else None)


def test_conversion_example_and_missing_rates(spark):
    df = spark.sql(
        "SELECT cast('110' AS decimal(12,2)) AS p, cast('3.727' AS decimal(18,6)) AS m, "
        "cast(0 AS decimal(18,6)) AS zero, cast(NULL AS decimal(18,6)) AS gone"
    )
    row = df.select(
        fn.convert(F.col("p"), F.col("m")), fn.convert(F.col("p"), F.col("gone")),
        fn.convert_cross(F.col("p"), F.col("m"), F.col("zero")),
        fn.convert_cross(F.col("p"), F.col("m"), F.col("gone")),
    ).head()
    assert row[0] == Decimal("409.9700") and row[1] is None and row[2] is None and row[3] is None


def test_extremes_of_many_markets(spark):
    """600 markets, ties in price, keys beyond any small layout."""
    geo = [(n * 1_000_003 % 2**31, f"c{n:03d}", f"name{n}") for n in range(600)]
    rows = [(p, geo[n][0], Decimal(100 + (n * 7 + p) % 40)) for p in (1, 2**40) for n in range(600 if p == 1 else 3) for _ in range(2)]
    t = {
        "dim_geography": spark.createDataFrame(geo, "geo_key int, country_code string, country_name string"),
        "fact_prices": spark.createDataFrame(rows, "product_key long, geo_key int, price_pln decimal(14,4)"),
    }
    got = {r.product_key: r for r in marts.market_extremes(t).collect()}
    codes = {key: code for key, code, _ in geo}
    for product in (1, 2**40):
        mine = [(price, codes[g]) for p, g, price in rows if p == product]
        low, high = min(mine), min((-price, code) for price, code in mine)
        row = got[product]
        assert row.n_markets == len({c for _, c in mine})
        assert (row.min_pln, row.cheapest_cc) == low and (-row.max_pln, row.dearest_cc) == high
        assert abs(row.avg_pln - sum(p for p, _ in mine) / len(mine)) < Decimal("0.0000001")


def test_price_keys_of_any_grain_differ(spark):
    grains = [(p, g, d) for p in (0, 1, 2**62) for g in (0, 511, 512, 2**31 - 1) for d in ("0001-01-01", "1999-12-31", "2026-01-01", "9999-12-31")]
    df = spark.createDataFrame(grains, "p long, g int, d string")
    keys = df.select(facts.price_key(F.col("p"), F.col("g"), F.col("d").cast("date")).alias("k"))
    assert keys.where("k IS NOT NULL").distinct().count() == len(grains)


def test_lookup_join_refuses_other_kinds(spark):
    from crossmart.operators.joins import lookup_join

    one = spark.range(1)
    with pytest.raises(ValueError):
        lookup_join(one, one, ["id"], "full")
