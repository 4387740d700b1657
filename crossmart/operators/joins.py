"""Lookup and as-of joins that stay whole under hot keys and growing dimensions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BROADCAST_ROWS = 200_000
SALTS = 16


#: Stored bytes a dimension read from files may have to be broadcast.
BROADCAST_BYTES = 8 << 20
#: Operators that make a frame no larger than the files it reads.
NARROWING = {"Project", "Filter", "LogicalRelation", "SubqueryAlias", "LocalRelation", "View"}


def stored_bytes(df: DataFrame) -> int | None:
    """Bytes of the files a frame reads if it only selects from them, else None. Runs no job."""
    plan = df._jdf.queryExecution().optimizedPlan()
    node = plan
    while node.getClass().getSimpleName() in NARROWING:
        if node.children().isEmpty():
            return int(str(plan.stats().sizeInBytes()))
        node = node.children().head()
    return None


def fits_broadcast(df: DataFrame, rows: int = BROADCAST_ROWS) -> bool:
    """Whether a frame is small: by the size of its files, or by at most ``rows`` rows.

    A frame that only selects from stored tables is judged without a job; others are counted,
    and the count stops once it sees more.
    """
    if rows == BROADCAST_ROWS and (size := stored_bytes(df)) is not None:
        return size <= BROADCAST_BYTES
    return df.limit(rows + 1).count() <= rows


def lookup_join(
    facts: DataFrame,
    dim: DataFrame,
    on: list[str],
    how: str = "inner",
    rows: int = BROADCAST_ROWS,
    salts: int = SALTS,
) -> DataFrame:
    """Equi-join a large frame with a dimension whose keys may be hot in the facts.

    A dimension of checked size is broadcast. A larger one is joined by shuffle on
    (key, salt): the salt is a hash of the fact row, the dimension is repeated once per
    salt, so one hot key spreads over ``salts`` tasks and no row is dropped. Facts should
    be free of full copies (collapse or count them first): copies share one salt. ``how``
    is ``inner`` or ``left``.
    """
    if how not in ("inner", "left"):
        raise ValueError("lookup_join keeps fact rows: use inner or left")
    if fits_broadcast(dim, rows):
        return facts.join(F.broadcast(dim), on, how)
    salted_facts = facts.withColumn(
        "_salt", F.pmod(F.xxhash64(*[F.col(c) for c in facts.columns]), F.lit(salts)).cast("int")
    )
    salted_dim = dim.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return salted_facts.join(salted_dim, [*on, "_salt"], how).drop("_salt")


def rates_in_force(
    rates: DataFrame, key: str, at: str, value: str, first: Column, last: Column
) -> DataFrame:
    """One row per key and calendar day in [first, last] with the rate valid that day.

    A quote holds until the day before the next quote of its key. Densifying turns the
    as-of condition into an equality on (key, day): the big side then needs no range
    predicate and no sort by date. The size is keys x days, independent of the facts.
    """
    nxt = F.lead(at).over(Window.partitionBy(key).orderBy(at))
    begin = F.greatest(F.col(at), first)
    end = F.least(F.coalesce(F.date_sub(nxt, 1), last), last)
    spans = rates.select(key, value, begin.alias("_from"), end.alias("_to"), F.col(at).alias("_quoted"))
    return spans.where(F.col("_from") <= F.col("_to")).select(
        key,
        F.explode(F.sequence("_from", "_to")).alias("day"),
        F.col(value),
        F.col("_quoted").alias("quoted_on"),
    )


def missing_in(facts: DataFrame, dim: DataFrame, key: str) -> DataFrame:
    """Distinct key values of ``facts`` without a row in ``dim``."""
    return facts.select(key).distinct().join(dim.select(key), key, "left_anti")
