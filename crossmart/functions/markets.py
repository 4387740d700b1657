"""Aggregates over the markets of a product, in two steps that need no bound on market keys.

The first step combines the rows of each product and market into fixed-width numbers, below
the shuffle. The second meets one row per product and market only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def per_market(prices: DataFrame) -> DataFrame:
    """(product_key, geo_key, lo, hi, total, n) over ``price_pln``."""
    price = F.col("price_pln")
    return prices.groupBy("product_key", "geo_key").agg(
        F.min(price).alias("lo"), F.max(price).alias("hi"), F.sum(price).alias("total"), F.count(price).alias("n")
    )


def average(total: Column, n: Column) -> Column:
    """Mean of sums of prices, with the digits of Spark's own average of a price."""
    mean = F.sum(total).cast("decimal(24,4)") / F.sum(n).cast("decimal(14,0)")
    return mean.cast("decimal(18,8)")
