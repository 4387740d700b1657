from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from crossmart import schemas
from crossmart.plans import dims, facts, marts, quality
from crossmart.plans.warehouse import Warehouse, run_load
from crossmart.sources.files import stage_catalogue, stage_rates
from tests import builders

DAY = date(2026, 3, 19)
RATES = [
    {}, {"effective_date": "2026-03-10", "mid": "3.5"}, {"effective_date": "2026-03-20", "mid": "9"},
    {"code": "EUR", "mid": "4.2"}, {"code": "GBP", "mid": "5.0"},
    {"table_type": "C", "mid": None, "bid": "3.6", "ask": "3.8", "trading_date": "2026-03-17"},
]
ROWS = [
    {}, {"country_code": "GB", "currency": "GBP", "price_local": "90"},
    {"country_code": "BG", "currency": "BGN", "price_local": "200"},
    {"style_color": "S2", "price_local": "n/a"}, {"style_color": None}, {"style_color": "S3", "price_local": "0"},
    {"style_color": "S4", "price_local": None}, {"style_color": "S5", "country_code": "XX"},
    {"style_color": "S6", "subcategory": "SHOES"}, {"style_color": "S7", "subcategory": None},
    {"style_color": "S8", "currency": "PLN", "price_local": "100000"},
]


@pytest.fixture(scope="module")
def loaded(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("warehouse"))
    catalogue, rates = builders.catalogue(spark, *ROWS), builders.rates(spark, *RATES)
    return run_load(spark, root, catalogue, rates, "initial", DAY)


def test_prices_convert_at_the_snapshot_rate(loaded):
    rows = {
        (r.style_color, r.country_code): r for r in marts.price_enriched(loaded.tables()).collect()
    }
    us = rows["S1", "US"]
    assert us.price_pln == Decimal("409.9700")  # the newest rate on or before the snapshot
    assert us.price_eur == Decimal("97.6119") and us.price_usd == Decimal("110.0000")
    assert rows["S1", "BG"].price_pln is None and rows["S1", "BG"].local_price == 200
    assert rows["S7", "US"].subcategory == "(Unspecified)"
    assert rows["S8", "US"].is_price_outlier and not us.is_price_outlier
    assert set(rows) == {("S1", "US"), ("S1", "GB"), ("S1", "BG"), ("S7", "US"), ("S8", "US")}


def test_rejects_are_explained_and_losses_are_listed(loaded):
    log = {r.reject_reason: r.raw_row for r in loaded.table("reject_log").collect()}
    assert set(log) == {"style_color NULL", "price NULL", "price not numeric", "price <= 0"}
    assert log["price <= 0"] == "style_color=S3|country=US|price=0"
    lost = facts.unmatched_rows(loaded.table("staging_catalogue"), loaded.tables()).collect()
    assert {(r.style_color, r.no_market, r.no_category) for r in lost} == {
        ("S5", True, False), ("S6", False, True),
    }


def test_currency_dimension(loaded):
    rows = {r.currency_code: r for r in loaded.table("dim_currency").collect()}
    assert rows["PLN"].is_base_currency and rows["PLN"].current_mid_rate == 1
    assert rows["USD"].current_mid_rate == 9 and rows["USD"].currency_name == "US Dollar"
    assert rows["USD"].nbp_table_type == "A" and rows["USD"].currency_name_pl == "dolar"
    assert rows["BGN"].nbp_table_type is None and rows["BGN"].currency_name == "Bulgarian Lev"


def test_known_currency_keeps_key_and_gets_new_texts(spark, loaded):
    again = builders.rates(spark, {"code": "GBP", "table_type": "B", "currency_name_pl": "funt"}, {"code": "SEK"})
    now = dims.load_currency(loaded.table("dim_currency"), again, None)
    before = {r.currency_code: r for r in loaded.table("dim_currency").collect()}
    after = {r.currency_code: r for r in now.collect()}
    assert after["GBP"].currency_key == before["GBP"].currency_key
    assert (after["GBP"].currency_name_pl, after["GBP"].nbp_table_type) == ("funt", "B")
    assert after["USD"].currency_name_pl == "dolar" and len(after) == len(before) + 1
    assert after["SEK"].currency_key > max(r.currency_key for r in before.values())


def test_category_hierarchy(loaded):
    rows = loaded.table("dim_category").collect()
    top = [r for r in rows if r.category_level == 1]
    assert [(r.category, r.subcategory) for r in top] == [("SHOES", "SHOES")]
    assert {r.subcategory for r in rows if r.category_level == 2} == {"Road", "(Unspecified)"}
    assert {r.parent_category_key for r in rows if r.category_level == 2} == {top[0].category_key}


def test_reload_adds_nothing(spark, loaded, tmp_path):
    root = str(tmp_path / "again")
    catalogue, rates = builders.catalogue(spark, *ROWS), builders.rates(spark, *RATES)
    one = run_load(spark, root, catalogue, rates, "initial", DAY).tables()
    counts = {name: df.count() for name, df in one.items()}
    two = run_load(spark, root, catalogue, rates, "incremental", DAY)
    assert {name: df.count() for name, df in two.tables().items()} == counts
    for name in ("fact_prices", "fact_rates"):
        keys = [c for c in two.table(name).columns if "load" not in c]
        assert two.table(name).select(keys).exceptAll(one[name].select(keys)).isEmpty()
    growth = quality.reload_growth(two.tables(), two.table("staging_rates")).head()
    assert growth.rows_added == 0
    audit = two.run_audit().orderBy("run_id").collect()
    assert [(r.load_type, r.status) for r in audit] == [("INITIAL", "SUCCESS"), ("INCREMENTAL", "SUCCESS")]
    assert audit[0].rows_in == 17 and audit[0].rows_rejected == 4
    assert audit[0].rows_out == counts["fact_prices"] + counts["fact_rates"]
    assert not any(r.alert for r in quality.volume_drift(two.run_audit()).collect())


def test_changed_attribute_opens_a_new_version(spark, loaded, tmp_path):
    root = str(tmp_path / "scd")
    rates = builders.rates(spark, *RATES)
    run_load(spark, root, builders.catalogue(spark, {}, {"style_color": "S9"}), rates, "initial", DAY)
    changed = builders.catalogue(spark, {"color_name": "blue"}, {"style_color": "S10"})
    wh = run_load(spark, root, changed, rates, "incremental", date(2026, 3, 20))
    versions = {(r.style_color, r.color_name): r for r in wh.table("dim_product").collect()}
    old, new = versions["S1", "red"], versions["S1", "blue"]
    assert not old.is_current and old.valid_to == date(2026, 3, 19)
    assert new.is_current and new.valid_from == date(2026, 3, 20) and new.valid_to is None
    assert versions["S9", "red"].is_current  # missing from the source, stays current
    assert versions["S10", "red"].valid_from == date(2026, 3, 20)
    assert len({r.product_key for r in versions.values()}) == len(versions) == 4
    # the same style, market and day enters again under the new version's key
    styles = marts.price_enriched(wh.tables()).groupBy("style_color").count()
    assert dict(styles.collect()) == {"S1": 2, "S9": 1, "S10": 1}
    assert marts.model_tables(wh.tables())["dim_product"].count() == 3


def test_canonical_product_prefers_listed_markets(spark):
    rows = builders.catalogue(
        spark, {"country_code": "DE", "product_name": "Laufschuh"}, {"country_code": "AU", "product_name": "au"},
        {"country_code": "GB", "product_name": "gb"}, {"style_color": "S2", "country_code": "FR", "product_name": "fr"},
        {"style_color": "S2", "country_code": "DE", "product_name": "de"},
    )
    got = {r.style_color: r.product_name for r in dims.canonical_products(rows).collect()}
    assert got == {"S1": "gb", "S2": "de"}


def test_failed_run_is_logged_and_leaves_nothing_visible(spark, tmp_path):
    root = str(tmp_path / "failing")
    good = run_load(spark, root, builders.catalogue(spark, {}), builders.rates(spark, {}), "initial", DAY)
    broken = builders.catalogue(spark, {"style_color": "S2"}).withColumn(
        "price_local", F.raise_error(F.lit("no such file"))
    )
    with pytest.raises(Exception, match="no such file"):
        run_load(spark, root, broken, builders.rates(spark, {}), "incremental", DAY)
    seen = Warehouse(spark, root)
    assert seen.runs == good.runs and seen.table("fact_prices").count() == 1
    last = quality.latest_run(seen.run_audit()).head()
    assert last.status == "FAILED" and "no such file" in last.message
    later = run_load(spark, root, builders.catalogue(spark, {"style_color": "S3"}), builders.rates(spark, {}), "incremental", DAY)
    assert later.runs == [1, 3] and later.table("fact_prices").count() == 2


def test_rates_only_run_keeps_prices_and_catalogue(spark, tmp_path):
    root = str(tmp_path / "rates-only")
    run_load(spark, root, builders.catalogue(spark, {}), builders.rates(spark, {}), "initial", DAY)
    more = builders.rates(spark, {"effective_date": "2026-03-25", "mid": "4.0"})
    wh = run_load(spark, root, None, more, "incremental", DAY, rates_only=True)
    assert wh.table("fact_rates").count() == 2 and wh.table("fact_prices").count() == 1
    assert wh.table("staging_catalogue").count() == 1 and wh.table("dim_product").count() == 1
    usd = wh.table("dim_currency").where("currency_code = 'USD'").head()
    assert usd.current_mid_rate == 4
    with pytest.raises(ValueError):
        run_load(spark, root, None, more, "sometimes")


def test_in_batch_duplicates_are_loaded_once(spark, tmp_path):
    rows = builders.catalogue(spark, {"price_local": "7"}, {"price_local": "5"}, {"price_local": "n/a"})
    rates = builders.rates(spark, {}, {}, {"table_no": "2/A"})
    wh = run_load(spark, str(tmp_path / "dup"), rows, rates, "initial", DAY)
    assert [r.local_price for r in wh.table("fact_prices").collect()] == [5]
    assert wh.table("fact_rates").count() == 1


def test_many_snapshots_in_one_batch(spark, tmp_path):
    days = [{"snapshot_date": f"2026-03-{d:02d}", "price_local": str(d)} for d in range(9, 23)]
    wh = run_load(spark, str(tmp_path / "many"), builders.catalogue(spark, *days), builders.rates(spark, *RATES), "initial", DAY)
    t = wh.tables()
    assert t["fact_prices"].count() == 14
    # one rate for the whole batch: the one valid on its newest snapshot
    assert t["fact_prices"].agg(F.max(F.abs(F.col("price_pln") - 9 * F.col("local_price")))).head()[0] == 0
    per_row = facts.priced_per_row(
        wh.table("staging_catalogue"), {**t}, t["fact_rates"]
    ).select("date_key", (F.col("price_pln") / F.col("local_price")).alias("rate"))
    rate = {r.date_key: r.rate and float(r.rate) for r in per_row.collect()}
    assert rate[20260309] is None and rate[20260310] == 3.5 and rate[20260318] == 3.727
    assert rate[20260319] == 3.727 and rate[20260322] == 9.0


def test_salted_lookups_load_the_same_facts(spark, loaded, monkeypatch):
    from crossmart.operators import joins

    t, stg = loaded.tables(), loaded.table("staging_catalogue")
    empty = dims.empty(spark, schemas.FACT_PRICES)
    want = facts.new_prices(empty, stg, t, t["fact_rates"]).drop("etl_load_date")
    monkeypatch.setattr(joins, "fits_broadcast", lambda df, rows=0: False)
    got = facts.new_prices(empty, stg, t, t["fact_rates"]).drop("etl_load_date")
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()


def test_split_refuses_blank_styles_and_bad_prices(spark):
    staged = stage_catalogue(
        builders.catalogue(spark, {}, {"style_color": "  "}, {"price_local": "x"}, {"price_local": "-1"}), 1
    )
    valid, refused = facts.split_valid(staged)
    assert valid.count() == 1 and refused.count() == 3


def test_spread_needs_both_sides(spark, loaded):
    stg = stage_rates(builders.rates(spark, {"effective_date": "2026-02-02", "table_type": "C", "mid": None, "bid": "3"}), 1)
    t = loaded.tables()
    row = facts.new_rates(t["fact_rates"], stg, t["dim_currency"], t["dim_date"]).head()
    assert row.spread is None and row.bid_rate == 3
    c = t["fact_rates"].where("table_type = 'C'").head()
    assert c.spread == Decimal("0.200000") and c.trading_date == date(2026, 3, 17)


def test_checks_pass_on_a_clean_load(loaded):
    t, stg = loaded.tables(), loaded.table("staging_catalogue")
    loss = quality.no_loss(stg, t).head()
    assert loss.matched_rows == t["fact_prices"].count() and loss.lost_rows == 2
    assert quality.orphans(t).isEmpty()
    assert quality.rejects_explained(t).head().asDict() == {
        "rejects": 4, "price_rejects": 3, "unexplained": 0, "bad_prices_in_fact": 0,
    }
    assert all(r.passed for r in quality.conversion_error(t, stg).collect())
    assert quality.price_trace(stg, t).head().deviating == 0
    keys = quality.duplicate_keys(t["fact_rates"], ["effective_date", "currency_key", "table_type"]).head()
    assert keys.n_rows == keys.n_keys and keys.repeated_keys == 0
    broken = {**t, "dim_geography": t["dim_geography"].where("country_code <> 'GB'")}
    assert [r.no_geo_key for r in quality.orphans(broken).collect()] == [True]


def test_views_are_registered_for_sql(spark, loaded):
    marts.register_views(spark, loaded.tables())
    assert spark.sql("SELECT count(*) FROM v_price_enriched").head()[0] == 5
    row = spark.sql("SELECT * FROM v_product_arbitrage").head()
    assert (row.style_color, row.n_markets, row.cheapest_cc, row.dearest_cc) == ("S1", 2, "US", "GB")
    assert row.margin_pct == Decimal("9.8") and row.arbitrage_status == "LOW (<10%)"
    assert spark.sql("SELECT * FROM v_kpi_summary").head().arbitrage_products == 1


def test_a_price_too_large_for_its_column_fails_the_load(spark, tmp_path):
    huge = builders.catalogue(spark, {"price_local": "9999999999"})
    with pytest.raises(Exception, match="out of range"):
        run_load(spark, str(tmp_path), huge, builders.rates(spark, *RATES), "initial", DAY)
    assert Warehouse(spark, str(tmp_path)).runs == []


def test_a_false_promise_of_unique_rows_fails_the_load(spark, tmp_path):
    twice = builders.catalogue(spark, {}, {"price_local": "120"})
    with pytest.raises(ValueError, match="repeats"):
        run_load(spark, str(tmp_path), twice, builders.rates(spark, *RATES), "initial", DAY, unique=True)
    assert Warehouse(spark, str(tmp_path)).runs == []


def test_duplicates_are_ordered_as_numbers(spark):
    staged = stage_catalogue(builders.catalogue(spark, {"price_local": "1000.00"}, {"price_local": "99.00"}), 1)
    assert [r.price_local for r in facts.unique_rows(staged).collect()] == ["99.00"]


def test_old_staging_and_dimension_folders_are_removed(spark, tmp_path):
    root, rates = str(tmp_path), builders.rates(spark, *RATES)
    for mode in ("initial", "incremental"):
        wh = run_load(spark, root, builders.catalogue(spark, *ROWS), rates, mode, DAY, keep=1)
    left = {p.name: sorted(r.name for r in p.glob("run=*")) for p in tmp_path.iterdir() if p.is_dir()}
    assert left["staging_catalogue"] == left["dim_product"] == ["run=2"]
    assert left["fact_prices"] == ["run=1", "run=2"]
    assert not any(runs for name, runs in left.items() if name.startswith("work_"))
    assert wh.table("fact_prices").count() == 5 and wh.table("dim_product").count() > 0


def test_two_loads_cannot_share_a_run(spark, tmp_path, monkeypatch):
    from crossmart.plans import warehouse

    write = warehouse.log_event

    def both(*args, **figures):
        write(*args, **figures)
        write(*args, **figures)

    monkeypatch.setattr(warehouse, "log_event", both)
    with pytest.raises(RuntimeError, match="another load"):
        run_load(spark, str(tmp_path), builders.catalogue(spark, {}), builders.rates(spark, *RATES), "initial", DAY)
