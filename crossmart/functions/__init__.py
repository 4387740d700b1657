"""Column expressions: cleaning, safe casts, flags, bands, ratios and conversion."""

from crossmart.functions.cleaning import (  # noqa: F401
    blank_to_null,
    default_label,
    differs,
    raw_row_text,
    reject_reason,
    to_boolean,
    to_date_or_null,
    to_decimal,
    to_float,
)
from crossmart.functions.pricing import (  # noqa: F401
    OUTLIER_LIMIT,
    arbitrage_band,
    convert,
    convert_cross,
    is_outlier,
    is_sensible,
    percent_gap,
    price_bucket,
    safe_ratio,
    table_label,
    table_rank,
)
