"""Price expressions: currency conversion, outlier rules, gap percentages and bands."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from crossmart.schemas import PRICE

# --- fixed values: thresholds and labels ---------------------------------------------
SENSIBLE_LOW = 1
OUTLIER_LIMIT = 50000
HIGH_ABOVE = 20
MEDIUM_FROM = 10
BAND_HIGH = "HIGH (>20%)"
BAND_MEDIUM = "MEDIUM (10-20%)"
BAND_LOW = "LOW (<10%)"
BUCKETS = [
    (100000, ">=100k"),
    (20000, "20k-100k"),
    (10000, "10k-20k"),
    (5000, "5k-10k"),
    (2000, "2k-5k"),
]
BUCKET_REST = "<2k"
MID_TABLES = ["A", "B"]
# -----------------------------------------------------------------------------------


def convert(local: Column, mid: Column) -> Column:
    """Base-currency price, four decimals, rounded half up; NULL without a rate."""
    return (local * mid).try_cast(PRICE)


def convert_cross(local: Column, mid: Column, cross: Column) -> Column:
    """Price in a third currency, taken from the unrounded base-currency product.

    The operands are narrowed before the division, which leaves 18 decimals for the
    quotient: with a divisor of at most 13 digits a quotient that is no tie at the
    fourth decimal stays at least 5e-18 away from one, so rounding twice is exact.
    """
    product = (local * mid).try_cast("decimal(22,8)")
    return F.when(cross > 0, (product / cross.try_cast("decimal(13,6)")).try_cast(PRICE))


def is_sensible(price: Column) -> Column:
    return price.isNotNull() & price.between(SENSIBLE_LOW, OUTLIER_LIMIT)


def is_outlier(price: Column) -> Column:
    return F.coalesce(price > OUTLIER_LIMIT, F.lit(False))


def safe_ratio(part: Column, whole: Column) -> Column:
    return part / F.nullif(whole, F.lit(0).cast("double"))


def percent_gap(high: Column, low: Column) -> Column:
    """``100 * (high - low) / low`` on decimals, NULL for a zero base, not rounded."""
    base = F.when(low != 0, low)
    return F.lit(100).cast("decimal(3,0)") * (high - low) / base


def arbitrage_band(margin: Column, unit: float = 1) -> Column:
    """Band of an unrounded margin; ``unit`` is 1 for percent and 0.01 for a fraction."""
    high, medium = HIGH_ABOVE * unit, MEDIUM_FROM * unit
    return (
        F.when(margin > high, F.lit(BAND_HIGH))
        .when(margin >= medium, F.lit(BAND_MEDIUM))
        .otherwise(F.lit(BAND_LOW))
    )


def price_bucket(price: Column) -> Column:
    rest = F.lit(BUCKET_REST)
    for bound, label in reversed(BUCKETS):
        rest = F.when(price >= bound, F.lit(label)).otherwise(rest)
    return rest


def table_rank(table_type: Column) -> Column:
    """Preference of the bank's rate tables: A before B before anything else."""
    return F.when(table_type == "A", 1).when(table_type == "B", 2).otherwise(3)


def table_label(rank: Column) -> Column:
    return F.when(rank == 1, F.lit("A")).when(rank == 2, F.lit("B")).otherwise(F.lit("C"))
