import json
from datetime import date

from crossmart.plans.warehouse import Warehouse, run_load
from crossmart.streaming.rate_feed import load_arrivals
from tests import builders


def answer(day, mid):
    return json.dumps([{"no": "1", "effectiveDate": day, "rates": [{"code": "USD", "currency": "dolar", "mid": mid}]}])


def test_arriving_documents_are_loaded_once(spark, tmp_path):
    root, checkpoint = str(tmp_path / "wh"), str(tmp_path / "cp")
    landed = tmp_path / "landed"
    for letter in "AC":
        (landed / letter).mkdir(parents=True)
    run_load(spark, root, builders.catalogue(spark, {}), builders.rates(spark, {}), "initial", date(2026, 3, 19))
    (landed / "A" / "1.json").write_text(answer("2026-03-20", 3.8))
    assert load_arrivals(spark, str(landed), root, checkpoint, date(2026, 3, 20)).awaitTermination(120)
    (landed / "A" / "2.json").write_text(answer("2026-03-23", 3.9))
    (landed / "A" / "3.json").write_text(answer("2026-03-20", 3.8))
    assert load_arrivals(spark, str(landed), root, checkpoint, date(2026, 3, 23)).awaitTermination(120)
    wh = Warehouse(spark, root)
    rows = wh.table("fact_rates").orderBy("effective_date").collect()
    assert [(str(r.effective_date), r.table_type) for r in rows] == [
        ("2026-03-18", "A"), ("2026-03-20", "A"), ("2026-03-23", "A"),
    ]
    assert wh.table("fact_prices").count() == 1 and len(wh.runs) == 3
