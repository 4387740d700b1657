"""One-row-per-key operators.

Both limit every key on the map side before the shuffle: the ranking window turns into
a group limit below the exchange, the aggregate into a partial aggregate. A key that
holds a large share of the rows sends one row per map task, not its whole group.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def first_row(df: DataFrame, keys: list[str], order: list[str | Column]) -> DataFrame:
    """The row of every key that comes first in ``order`` (NULLs first).

    Remaining ties are broken by the other columns from left to right, so the result
    does not depend on how the input is split into partitions.
    """
    named = [o for o in order if isinstance(o, str)]
    rest = [c for c in df.columns if c not in keys and c not in named]
    ranking = Window.partitionBy(*keys).orderBy(*order, *rest)
    return df.withColumn("_rn", F.row_number().over(ranking)).where("_rn = 1").drop("_rn")


def latest_value(
    df: DataFrame, keys: list[str], value: str, at: str, alias: str | None = None
) -> DataFrame:
    """``value`` on the newest ``at`` per key; equal dates resolve to the largest value."""
    return df.groupBy(*keys).agg(
        F.max_by(F.col(value), F.struct(F.col(at), F.col(value))).alias(alias or value)
    )
