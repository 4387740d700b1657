import json

from crossmart import jobs, schemas
from crossmart.plans import profile
from crossmart.plans.warehouse import Warehouse
from tests import builders


def csv_file(path, columns, rows):
    lines = [",".join(columns)] + [",".join(row.get(c) or "" for c in columns) for row in rows]
    path.write_text("\n".join(lines) + "\n", encoding="utf-8")
    return str(path)


def test_jobs_from_documents_to_warehouse(spark, tmp_path):
    for letter, body in {
        "A": {"no": "1/A", "effectiveDate": "2026-03-18", "rates": [{"code": "USD", "currency": "dolar", "mid": 3.727}]},
        "B": {"no": "1/B", "effectiveDate": "2025-12-30", "rates": [{"code": "VND", "currency": "dong", "mid": 0.1}]},
    }.items():
        folder = tmp_path / "landed" / letter
        folder.mkdir(parents=True)
        (folder / "1.json").write_text(json.dumps([body]))
    out = str(tmp_path / "rates")
    jobs.main(["rates", "--landed", str(tmp_path / "landed"), "--out", out,
               "--start", "2026-01-01", "--end", "2026-06-29"], spark)
    assert spark.read.option("header", True).csv(f"{out}/segments").count() == 2
    assert spark.read.option("header", True).csv(f"{out}/rates").count() == 1

    sizes = [{**builders.CATALOGUE, "sku": s, "product_id": "p", "available": "true"} for s in ("2", "1")]
    sizes.append({**sizes[0], "country_code": "GB", "currency": "GBP", "price_local": "oops"})
    raw = csv_file(tmp_path / "raw.csv", profile.PROFILED, sizes)
    shown = str(tmp_path / "profile")
    jobs.main(["profile", "--catalogue", raw, "--codes", f"{out}/currency_map/codes", "--out", shown], spark)
    totals = {r.metric: r.value for r in spark.read.json(f"{shown}/summary").collect()}
    assert totals["total_raw_rows"] == 3 and totals["grain_rows"] == 2
    assert totals["price_nonnumeric"] == 1 and totals["uncovered_currencies"] == 1
    assert totals["products_in_2plus_countries"] == 1

    root = str(tmp_path / "warehouse")
    jobs.main(["load", "--root", root, "--catalogue", f"{shown}/product_country", "--rates", f"{out}/rates",
               "--load-date", "2026-03-19"], spark)
    jobs.main(["load", "--root", root, "--mode", "incremental", "--rates", f"{out}/rates", "--skip-catalogue"], spark)
    wh = Warehouse(spark, root)
    assert wh.runs == [1, 2]
    row = wh.table("fact_prices").head()
    assert row.local_price == 110 and float(row.price_pln) == 409.97
    assert [r.reject_reason for r in wh.table("reject_log").collect()] == ["price not numeric"]
    assert set(schemas.FACT_PRICES.names) == set(wh.table("fact_prices").columns)
