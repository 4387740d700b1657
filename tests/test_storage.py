"""Manifest, compaction and the layout that needs no shuffle."""

import random

import pytest
from pyspark.sql import functions as F

from crossmart.plans import dims, marts, quality, storage, warehouse
from crossmart.plans.warehouse import Warehouse, compact, run_load
from tests import builders
from tests.test_warehouse import DAY, RATES, ROWS


def folder(run, rows, name="fact_prices"):
    return storage.Folder(name, run, rows, rows * 50, 4, 20240101 + run, 20240101 + run, 4)


def exchanges(df):
    return df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")


@pytest.fixture(scope="module")
def daily(spark, tmp_path_factory):
    """Three daily loads, compacted in pairs."""
    root = str(tmp_path_factory.mktemp("daily"))
    for day in range(3):
        rows = builders.catalogue(
            spark, *[{"style_color": f"S{i}", "country_code": c} for i in range(9) for c in ("US", "GB")],
            snapshot_date=f"2026-03-{19 + day}")
        run_load(spark, root, rows, builders.rates(spark, *RATES), "incremental", DAY, buckets=4, keep=2)
    return root


def test_thirty_loads_leave_few_folders():
    rng = random.Random(1)
    folders, run, rewritten = [], 0, 0
    for _ in range(300):
        run += 1
        folders.append(folder(run, rng.randrange(900, 1100)))
        group = storage.due(folders, 4)
        if group:
            run += 1
            rewritten += sum(f.rows for f in group)
            folders = [f for f in folders if f not in group] + [folder(run, sum(f.rows for f in group))]
        assert len(folders) <= 3 * 6
    assert sum(f.rows for f in folders) > 290_000
    assert rewritten < 6 * 300_000
    assert storage.due([folder(1, 10), folder(2, 10)], 4) == [] == storage.due([], 4)


def test_compaction_keeps_rows_and_open_readers(spark, daily):
    before = Warehouse(spark, daily)
    rows = {name: before.table(name).drop("etl_load_date", "load_timestamp") for name in ("fact_prices", "fact_rates")}
    want = {name: sorted(map(str, df.collect())) for name, df in rows.items()}
    assert len(want["fact_prices"]) == 54 and len(before.folders_of("fact_prices")) == 3
    after = compact(spark, daily, fan=2, keep=2)
    assert len(after.folders_of("fact_prices")) == 1 and after.buckets == 4
    for name in want:
        assert sorted(map(str, after.table(name).drop("etl_load_date", "load_timestamp").collect())) == want[name]
        assert sorted(map(str, rows[name].collect())) == want[name]  # the reader opened before still finds its folders
    audit = after.run_audit().orderBy("run_id").collect()
    assert [(r.load_type, r.status) for r in audit][-1] == ("COMPACTION", "SUCCESS")
    assert audit[-1].rows_in == audit[-1].rows_out and compact(spark, daily, fan=9).committed == after.committed
    assert after.table("dim_product").count() == 9  # dimensions come from the newest load
    again = run_load(
        spark, daily, builders.catalogue(spark, {"style_color": "S1"}, {"style_color": "S77"}), builders.rates(spark, *RATES),
        "incremental", DAY)
    assert again.rows_of("fact_prices") == 55 and again.table("fact_prices").count() == 55
    assert quality.reload_growth(again.tables(), again.table("staging_rates")).head().rows_added == 0


def test_a_failed_compaction_leaves_nothing_visible(spark, tmp_path, monkeypatch):
    root = str(tmp_path)
    for day in ("2026-03-19", "2026-03-20"):
        run_load(spark, root, builders.catalogue(spark, *ROWS, snapshot_date=day), builders.rates(spark, *RATES), "incremental", DAY, buckets=2)
    seen = Warehouse(spark, root)
    prices = seen.table("fact_prices").count()

    def broken(*args):
        raise OSError("disk full")

    monkeypatch.setattr(warehouse, "commit", broken)
    with pytest.raises(OSError, match="disk full"):
        compact(spark, root, fan=2)
    monkeypatch.undo()
    now = Warehouse(spark, root)
    assert now.folders == seen.folders and now.table("fact_prices").count() == prices
    assert quality.latest_run(now.run_audit()).head().status == "FAILED"
    after = compact(spark, root, fan=2, buckets=3, keep=1)
    assert after.buckets == 3 and after.table("fact_prices").count() == prices
    kept = sorted(p.name for p in (tmp_path / "fact_prices").glob("run=*"))
    assert "run=1" not in kept and "run=2" not in kept  # replaced, and no kept run needs them


def test_a_run_that_was_overtaken_is_refused(spark, tmp_path, monkeypatch):
    root, rows, rates = str(tmp_path), builders.catalogue(spark, *ROWS), builders.rates(spark, *RATES)
    run_load(spark, root, rows, rates, "initial", DAY, buckets=2)
    load = warehouse.load_warehouse

    def slow(state, run, *rest):
        monkeypatch.setattr(warehouse, "load_warehouse", load)
        run_load(spark, root, rows, rates, "incremental", DAY)
        return load(state, run, *rest)

    monkeypatch.setattr(warehouse, "load_warehouse", slow)
    with pytest.raises(RuntimeError, match="was committed while"):
        run_load(spark, root, rows, rates, "incremental", DAY)
    assert Warehouse(spark, root).committed == [1, 3]


def test_prices_are_grouped_joined_and_guarded_in_place(spark, daily):
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        wh = Warehouse(spark, daily)
        t = wh.tables_in_place()
        view = marts.product_arbitrage(t)
        assert exchanges(view) == 0 < exchanges(marts.product_arbitrage(wh.tables()))
        assert sorted(map(str, view.collect())) == sorted(map(str, marts.product_arbitrage(wh.tables()).collect()))
        held = wh.held_prices(DAY, DAY)
        rows = wh.table("fact_prices")
        guarded = storage.not_held(rows, held, wh.buckets)
        assert exchanges(guarded) == 1  # the new rows only
        assert held.count() > 0 and guarded.count() == rows.count() - held.count()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)


def test_version_faults(spark):
    rows = [
        ("ok", 1, "2024-01-01", "2024-01-31", False), ("ok", 2, "2024-02-01", None, True),
        ("gap", 3, "2024-01-01", "2024-01-20", False), ("gap", 4, "2024-02-01", None, True),
        ("over", 5, "2024-01-01", "2024-02-05", False), ("over", 6, "2024-02-01", None, True),
        ("day", 7, "2024-01-01", "2024-01-31", False), ("day", 8, "2024-02-01", "2024-01-31", False), ("day", 9, "2024-02-01", None, True),
        ("open", 10, "2024-01-01", None, True), ("open", 11, "2024-02-01", None, True), ("lost", 12, "2024-01-01", "2024-01-31", False),
    ]
    dim = spark.createDataFrame(rows, "style_color string, product_key long, a string, b string, is_current boolean").select(
        "style_color", "product_key", F.to_date("a").alias("valid_from"), F.to_date("b").alias("valid_to"), "is_current")
    got = sorted((r.style_color, r.fault) for r in dims.version_faults(dim).collect())
    assert got == [("day", "reversed"), ("gap", "gap"), ("lost", "unmarked"), ("open", "overlap"), ("open", "twice"), ("over", "overlap")]
    assert dims.version_faults(dims.settled(dim).where("style_color = 'day'")).count() == 0
    assert dims.version_faults(dim.where("false")).count() == 0


def test_content_digests_find_swapped_copies(spark):
    rows = [("a", "1"), ("a", "1"), ("b", None), ("b", ""), ("c", "2")]
    frame = lambda r: spark.createDataFrame(r, "k string, v string").repartition(3)
    same = lambda r: quality.same_content(frame(rows), frame(r), ["k", "v"]).head().same_content
    assert same(rows[::-1])
    assert not same([("a", "1"), ("c", "2"), ("b", None), ("b", ""), ("c", "2")])
    assert not same([("a", "1"), ("a", "1"), ("b", ""), ("b", ""), ("c", "2")])
    assert not same(rows[:-1]) and quality.same_content(frame(rows).where("false"), frame(rows).where("false"), ["k"]).head().same_content
