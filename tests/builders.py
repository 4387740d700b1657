"""Small catalogue and rate rows for the tests."""

from __future__ import annotations

from crossmart import schemas

CATALOGUE = {
    "style_color": "S1", "country_code": "US", "snapshot_date": "2026-03-19", "model_number": "M1",
    "product_name": "Runner", "color_name": "red", "gender_segment": "MEN", "category": "SHOES",
    "subcategory": "Road", "currency": "USD", "price_local": "110.00", "sale_price_local": None,
    "discount_pct": None, "in_stock": "True", "availability_level": "HIGH",
}
RATE = {
    "table_type": "A", "table_no": "1/A/2026", "effective_date": "2026-03-18", "trading_date": None,
    "code": "USD", "currency_name_pl": "dolar", "mid": "3.727", "bid": None, "ask": None,
}


def catalogue(spark, *rows: dict, **common):
    full = [{**CATALOGUE, **common, **row} for row in rows]
    return spark.createDataFrame(
        [tuple(r[c] for c in schemas.CATALOGUE_COLUMNS) for r in full],
        schemas.text_schema(schemas.CATALOGUE_COLUMNS),
    )


def rates(spark, *rows: dict):
    full = [{**RATE, **row} for row in rows]
    return spark.createDataFrame(
        [tuple(r[c] for c in schemas.RATE_COLUMNS) for r in full],
        schemas.text_schema(schemas.RATE_COLUMNS),
    )
