import json

from pyspark.sql import functions as F

from crossmart import schemas
from crossmart.sources import files, seeds
from tests import builders


def test_catalogue_csv_keeps_text_and_line_breaks(spark, tmp_path):
    path = tmp_path / "catalogue.csv"
    columns = [*schemas.CATALOGUE_COLUMNS, "sku"]
    lines = [",".join(columns)]
    row = {**builders.CATALOGUE, "sku": "1", "product_name": '"Air ""Max""\nTwo, lines"', "color_name": "NA",
           "price_local": "00110.50", "subcategory": ""}
    lines.append(",".join(row[c] or "" for c in columns))
    path.write_text("\n".join(lines) + "\n", encoding="utf-8")
    read = files.read_catalogue_csv(spark, str(path))
    got = read.collect()
    assert len(got) == 1
    assert got[0].product_name == 'Air "Max"\nTwo, lines'
    assert got[0].color_name == "NA" and got[0].price_local == "00110.50"
    assert got[0].sale_price_local is None
    staged = files.stage_catalogue(read, 3).head()
    assert staged.subcategory == "(Unspecified)" and staged.load_batch_id == 3


def test_rate_documents_flatten(spark, tmp_path):
    folder = tmp_path / "docs"
    folder.mkdir()
    answer = [
        {"no": "1/A", "effectiveDate": "2026-01-02", "rates": [
            {"code": "USD", "currency": "dolar", "mid": 3.7}, {"code": "EUR", "currency": "euro", "mid": 4.2}]},
        {"no": "2/A", "effectiveDate": "2026-01-05", "tradingDate": "2026-01-04", "rates": [
            {"code": "USD", "currency": "dolar", "bid": 3.6, "ask": 3.8}]},
        {"no": "3/A", "effectiveDate": "2026-01-06", "rates": []},
    ]
    (folder / "a.json").write_text(json.dumps(answer, indent=1), encoding="utf-8")
    flat = files.flatten_rates(files.read_rate_documents(spark, str(folder)), "A")
    rows = {(r.table_no, r.code): r for r in flat.collect()}
    assert len(rows) == 3
    assert rows["1/A", "USD"].mid == "3.7" and rows["1/A", "USD"].bid is None
    assert rows["2/A", "USD"].trading_date == "2026-01-04" and rows["2/A", "USD"].ask == "3.8"
    texts = spark.createDataFrame([("A", json.dumps(answer))], "table_type string, body string")
    parsed = files.flatten_rates(files.parse_rate_documents(texts, "body"), F.col("table_type"))
    assert parsed.exceptAll(flat).isEmpty() and parsed.count() == 3
    assert files.distinct_quotes(flat.unionByName(flat)).count() == 3


def test_currency_map_prefers_table_a(spark, tmp_path):
    rates = builders.rates(
        spark, {"table_type": "C", "currency_name_pl": "c"}, {"table_type": "A", "currency_name_pl": "a"},
        {"table_type": "B", "code": "VND", "currency_name_pl": "b"}, {"code": None},
    )
    got = {r.currency_code: (r.currency_name_pl, r.nbp_table_type) for r in files.currency_map(rates).collect()}
    assert got == {"USD": ("a", "A"), "VND": ("b", "B")}
    files.write_currency_map(rates, str(tmp_path / "map"))
    seed = spark.read.option("header", True).csv(str(tmp_path / "map" / "seed"))
    assert [r.currency_code for r in seed.collect()] == ["USD", "VND"]
    assert spark.read.json(str(tmp_path / "map" / "codes")).count() == 2


def test_rates_csv_is_ordered_and_round_trips(spark, tmp_path):
    rates = builders.rates(
        spark, {"effective_date": "2026-01-05"}, {"effective_date": "2026-01-02", "code": "EUR"},
        {"effective_date": "2026-01-02", "table_type": "B", "mid": None},
    )
    path = str(tmp_path / "rates")
    files.write_rates_csv(rates, path)
    text = "".join(p.read_text() for p in sorted((tmp_path / "rates").glob("part-*.csv")))
    dates = [line.split(",")[2] for line in text.splitlines() if not line.startswith("table_type")]
    assert dates == sorted(dates)
    assert files.read_rates_csv(spark, path).exceptAll(rates).isEmpty()


def test_collapse_keeps_the_first_size_and_unkeyed_rows_apart(spark):
    raw = builders.catalogue(
        spark, {"price_local": "2"}, {"price_local": "1"}, {"country_code": "GB"}, {"style_color": None},
        {"style_color": ""},
    ).withColumn("sku", F.concat("price_local", F.lit("-sku")))
    kept = files.collapse_sizes(raw)
    assert {(r.country_code, r.price_local) for r in kept.collect()} == {("US", "1"), ("GB", "110.00")}
    assert files.without_key(raw).count() == 2
    assert files.product_country_extract(kept, 1).head().country_code == "GB"
    assert files.product_country_extract(kept).count() == 2


def test_geography_seed(spark):
    markets = seeds.geography(spark)
    assert markets.count() == 45 and markets.select("currency_code").distinct().count() == 28
    assert markets.where("country_code = 'PL'").head().currency_code == "PLN"
    assert seeds.currency_names(spark).count() == 28
