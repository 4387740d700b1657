"""Surrogate keys without a single-task window and without a second pass."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BUCKETS = 4096


def key_bucket(natural: list[str]) -> Column:
    """Bucket number of a natural key: the leading three hex digits of its MD5."""
    parts = [F.coalesce(F.col(c), F.lit("")) for c in natural]
    digits = F.substring(F.md5(F.concat_ws("|", *parts)), 1, 3)
    return F.conv(digits, 16, 10).cast("int")


def assign_keys(
    new_rows: DataFrame, natural: list[str], key: str, start: Column | int = 0
) -> DataFrame:
    """Number rows above ``start``: the n-th row of bucket b gets ``start + 4096 (n - 1) + b + 1``.

    ``natural`` must be unique in ``new_rows``, so the buckets are even and every one is
    numbered by itself, in parallel and in natural-key order. Keys are unique, depend on
    the data alone (a recomputed partition gets the same ones), and leave gaps only where
    buckets differ in size.
    """
    base = F.lit(start) if isinstance(start, int) else start
    inside = Window.partitionBy("_bucket").orderBy(*natural)
    return (
        new_rows.withColumn("_bucket", key_bucket(natural))
        .withColumn("_n", F.row_number().over(inside).cast("bigint"))
        .withColumn(key, base + (F.col("_n") - 1) * BUCKETS + F.col("_bucket") + 1)
        .drop("_bucket", "_n")
    )


def highest_key(dim: DataFrame, key: str) -> Column:
    """Scalar subquery: the largest key handed out so far, 0 for an empty dimension."""
    return dim.select(F.coalesce(F.max(key), F.lit(0)).cast("bigint").alias("k")).scalar()
