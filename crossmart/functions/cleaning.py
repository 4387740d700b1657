"""Text cleaning and fault-tolerant casts for the all-text staging tables."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from crossmart.schemas import PRICE_LOCAL

# --- fixed values: labels and reasons that appear in results ------------------------
UNSPECIFIED = "(Unspecified)"
TRUE_TEXTS = ["True", "true", "1"]
FALSE_TEXTS = ["False", "false", "0"]
REASON_NO_KEY = "style_color NULL"
REASON_NO_PRICE = "price NULL"
REASON_NOT_NUMERIC = "price not numeric"
REASON_NOT_POSITIVE = "price <= 0"
REASON_UNKNOWN = "unknown"
# -----------------------------------------------------------------------------------


def blank_to_null(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def default_label(c: Column, label: str = UNSPECIFIED) -> Column:
    """Replace a missing or whitespace-only text by a label, keep other text as it is."""
    return F.when(F.coalesce(F.trim(c), F.lit("")) == "", F.lit(label)).otherwise(c)


def to_decimal(c: Column, precision: int, scale: int) -> Column:
    """Text to decimal, NULL when it is no plain decimal number (exponents are refused)."""
    plain = ~(c.contains("e") | c.contains("E"))
    return F.when(plain, c.try_cast(f"decimal({precision},{scale})"))


def to_date_or_null(c: Column) -> Column:
    return c.try_cast("date")


def to_float(c: Column) -> Column:
    return c.try_cast("double")


def to_boolean(c: Column) -> Column:
    """Three-valued flag: known true texts, known false texts, otherwise NULL."""
    return F.when(c.isin(TRUE_TEXTS), F.lit(True)).when(c.isin(FALSE_TEXTS), F.lit(False))


def local_price(c: Column) -> Column:
    return to_decimal(c, PRICE_LOCAL.precision, PRICE_LOCAL.scale)


def reject_reason(key: Column, price: Column) -> Column:
    """Why a catalogue row cannot be loaded; NULL for a loadable row."""
    amount = local_price(price)
    return (
        F.when(key.isNull(), F.lit(REASON_NO_KEY))
        .when(price.isNull(), F.lit(REASON_NO_PRICE))
        .when(amount.isNull(), F.lit(REASON_NOT_NUMERIC))
        .when(amount <= 0, F.lit(REASON_NOT_POSITIVE))
        .when(amount > 0, F.lit(None).cast("string"))
        .otherwise(F.lit(REASON_UNKNOWN))
    )


def raw_row_text(key: Column, country: Column, price: Column) -> Column:
    """One-line image of a rejected row; missing parts print as nothing."""
    blank = F.lit("")
    return F.concat(
        F.lit("style_color="), F.coalesce(key, blank),
        F.lit("|country="), F.coalesce(country, blank),
        F.lit("|price="), F.coalesce(price, blank),
    )


def differs(left: Column, right: Column) -> Column:
    """Inequality in which NULL and the empty text count as the same value."""
    return F.coalesce(left, F.lit("")) != F.coalesce(right, F.lit(""))
