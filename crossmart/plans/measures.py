"""Measures: aggregates over the model, grouped by any of its attributes.

``by`` plays the part of the filter context: every measure returns one row per
combination of the listed attributes, or one row in all for an empty list. Facts are
combined per dimension key first; only then are the dimensions that carry a listed
attribute joined to the combined rows, and the parts are combined again per attribute.
A hot attribute value thus never travels as raw rows.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from crossmart.functions import OUTLIER_LIMIT, arbitrage_band, safe_ratio
from crossmart.plans.facts import usable_mids

Tables = dict[str, DataFrame]

ATTRIBUTES = {
    "dim_geography": ("geo_key", ["country_code", "country_name", "region", "sub_region"]),
    "dim_date": ("date_key", ["full_date", "year", "quarter", "month", "month_name"]),
    "dim_category": ("category_key", ["category", "subcategory"]),
    "dim_currency": ("currency_key", ["currency_code", "currency_name"]),
    "dim_product": (
        "product_key", ["style_color", "model_number", "product_name", "color_name", "gender_segment"],
    ),
}
BOUNDED = {"dim_geography", "dim_date"}
TREND_DAYS = 30
HIGH_MARGIN = 0.20


def with_attributes(fact: DataFrame, t: Tables, wanted: list[str]) -> DataFrame:
    """The fact with the wanted attributes; a key without dimension row gives NULLs."""
    out = fact
    for name, (key, columns) in ATTRIBUTES.items():
        used = [c for c in columns if c in wanted and c not in fact.columns]
        if used:
            dim = t[name].where("is_current") if name == "dim_product" else t[name]
            dim = dim.select(key, *used)
            out = out.join(F.broadcast(dim) if name in BOUNDED else dim, key, "left")
    return out


def keys_of(wanted: list[str]) -> list[str]:
    """Fact keys of the dimensions that carry the wanted attributes."""
    return [key for key, columns in ATTRIBUTES.values() if set(columns) & set(wanted)]


def combined(
    fact: DataFrame, t: Tables, by: list[str], sums: dict[str, Column], also: list[str] = ()
) -> DataFrame:
    """Sum and count of every listed expression per attribute group (``x`` and ``n_x``).

    Sums are decimal and therefore exact: combining them in two steps changes nothing.
    """
    wanted = [*by, *also]
    parts = [F.sum(c).alias(name) for name, c in sums.items()]
    parts += [F.count(c).alias(f"n_{name}") for name, c in sums.items()]
    keyed = fact.groupBy(*keys_of(wanted)).agg(*parts)
    if not wanted:
        return keyed
    names = [*sums, *[f"n_{name}" for name in sums]]
    return with_attributes(keyed, t, wanted).groupBy(*wanted).agg(
        *[F.sum(name).alias(name) for name in names]
    )


def ratio(name: str) -> Column:
    """Average from a combined sum and count."""
    count = F.nullif(F.col(f"n_{name}"), F.lit(0).cast("bigint"))
    return F.col(name).cast("double") / count


def mean(c: Column) -> Column:
    """Average from the exact decimal sum, so it does not depend on the row order."""
    return F.sum(c).cast("double") / F.count(c)


def usual(c: Column) -> Column:
    """The value where the row's price is no outlier, otherwise NULL."""
    return F.when(F.col("price_pln") <= OUTLIER_LIMIT, c)


# --- prices --------------------------------------------------------------------------------


def price_totals(t: Tables, by: list[str] = ()) -> DataFrame:
    """Sum of local prices, and sums and average of converted prices without outliers."""
    found = combined(t["fact_prices"], t, list(by), {
        "local": F.col("local_price"), "pln": usual(F.col("price_pln")),
        "eur": usual(F.col("price_eur")), "usd": usual(F.col("price_usd")),
    })
    return found.select(
        *by,
        F.col("local").cast("double").alias("local_price"),
        F.col("pln").cast("double").alias("price_pln"),
        ratio("pln").alias("avg_price_pln"),
        F.col("eur").cast("double").alias("price_eur"),
        F.col("usd").cast("double").alias("price_usd"),
    )


def product_count(t: Tables, by: list[str] = ()) -> DataFrame:
    """Distinct current products, by attributes of the product itself."""
    current = t["dim_product"].where("is_current")
    return current.groupBy(*by).agg(F.countDistinct("style_color").alias("products"))


def market_count(t: Tables, by: list[str] = ()) -> DataFrame:
    """Distinct markets, by attributes of the market itself."""
    return t["dim_geography"].groupBy(*by).agg(F.countDistinct("country_code").alias("markets"))


def dynamic_price(t: Tables, by: list[str] = ()) -> DataFrame:
    """Local prices at today's rate of their currency, instead of the snapshot's rate."""
    keys = list(dict.fromkeys([*keys_of(list(by)), "currency_key"]))
    local = t["fact_prices"].groupBy(*keys).agg(F.sum("local_price").alias("_local"))
    rates = t["dim_currency"].select("currency_key", "current_mid_rate")
    rows = with_attributes(local.join(rates, "currency_key", "left"), t, list(by))
    now = F.col("_local").cast("decimal(19,2)") * F.col("current_mid_rate")
    return rows.groupBy(*by).agg(F.sum(now).cast("double").alias("dynamic_price_pln"))


def market_gap(t: Tables, by: list[str] = ()) -> DataFrame:
    """Average price per market, then its extremes: range, margin, market names, band.

    A group's rows are combined per market first; the second level meets at most one row
    per market and group.
    """
    usual_rows = t["fact_prices"].where(F.col("price_pln") <= OUTLIER_LIMIT)
    markets = combined(
        usual_rows, t, list(by), {"pln": F.col("price_pln")}, also=["country_name"]
    ).select(*by, "country_name", ratio("pln").alias("p"))
    extremes = markets.groupBy(*by).agg(
        F.min(F.struct("p", "country_name")).alias("lo"), F.max(F.struct("p", "country_name")).alias("hi")
    )
    low, high = F.col("lo.p"), F.col("hi.p")
    margin = safe_ratio(high - low, low)
    return extremes.select(
        *by,
        low.alias("min_market_price"), high.alias("max_market_price"), (high - low).alias("spread_pln"),
        margin.alias("margin"),
        F.col("lo.country_name").alias("cheapest_market"), F.col("hi.country_name").alias("dearest_market"),
        arbitrage_band(margin, 0.01).alias("arbitrage_status"),
    )


def opportunities(t: Tables, by: list[str] = ()) -> DataFrame:
    """Products with a margin above 20 %, the largest margin and the largest spread."""
    per_product = market_gap(t, [*by, "style_color"]).where(F.col("style_color").isNotNull())
    return per_product.groupBy(*by).agg(
        F.count_if(F.col("margin") > HIGH_MARGIN).alias("active_opportunities"),
        F.max("margin").alias("max_margin"),
        F.max("spread_pln").alias("max_spread_pln"),
    )


# --- rates ---------------------------------------------------------------------------------


def rate_averages(t: Tables, by: list[str] = ()) -> DataFrame:
    """Average mid, bid and ask, and the relative bid-ask spread."""
    found = combined(t["fact_rates"], t, list(by), {
        "mid": F.col("mid_rate"), "bid": F.col("bid_rate"), "ask": F.col("ask_rate"),
    })
    return found.select(
        *by, ratio("mid").alias("avg_mid"), ratio("bid").alias("avg_bid"), ratio("ask").alias("avg_ask"),
        safe_ratio(ratio("ask") - ratio("bid"), ratio("mid")).alias("spread_ratio"),
    )


def table_a_rates(t: Tables, by: list[str]) -> DataFrame:
    return with_attributes(t["fact_rates"].where(F.col("table_type") == "A"), t, list(by))


def rate_volatility(t: Tables, by: list[str] = ()) -> DataFrame:
    """Population deviation of the mid and its ratio to the mean, table A."""
    found = table_a_rates(t, by).groupBy(*by).agg(
        F.stddev_pop(F.col("mid_rate").cast("double")).alias("volatility"),
        mean(F.col("mid_rate")).alias("_mean"),
    )
    return found.withColumn("variation", safe_ratio(F.col("volatility"), F.col("_mean"))).drop("_mean")


def table_a_currencies(t: Tables, by: list[str] = ()) -> DataFrame:
    return table_a_rates(t, by).groupBy(*by).agg(
        F.countDistinct("currency_key").alias("table_a_currencies")
    )


def daily_mids(rows: DataFrame, by: list[str]) -> DataFrame:
    """Average mid per group and day: at most one row per calendar day and group."""
    return rows.groupBy(*by, "effective_date").agg(mean(F.col("mid_rate")).alias("mid"))


def asof_rate(t: Tables, day: date, by: list[str] = ("currency_code",)) -> DataFrame:
    """Average mid of tables A and B on the newest published day not after ``day``."""
    usable = t["fact_rates"].where(
        F.col("table_type").isin("A", "B") & (F.col("effective_date") <= F.lit(day))
    )
    daily = daily_mids(with_attributes(usable, t, list(by)), list(by))
    return daily.groupBy(*by).agg(
        F.max("effective_date").alias("rate_date"), F.max_by("mid", "effective_date").alias("mid_rate")
    )


def rate_trend(t: Tables, by: list[str] = ("currency_code",)) -> DataFrame:
    """Newest mid of each group against the newest one at least 30 days before it.

    The last day is the group's own, unlike the trend view's common last day.
    """
    daily = daily_mids(table_a_rates(t, by), list(by))
    group = Window.partitionBy(*by) if by else Window.partitionBy(F.lit(0))
    dated = daily.withColumn("last_date", F.max("effective_date").over(group))
    old = F.col("effective_date") <= F.date_sub("last_date", TREND_DAYS)
    found = dated.groupBy(*by).agg(
        F.max("last_date").alias("last_date"),
        F.max_by("mid", "effective_date").alias("mid_now"),
        F.max_by(F.when(old, F.col("mid")), F.when(old, F.col("effective_date"))).alias("mid_30d_ago"),
    )
    return found.withColumn(
        "change_30d", safe_ratio(F.col("mid_now") - F.col("mid_30d_ago"), F.col("mid_30d_ago"))
    )


def against_average(t: Tables, days: int = TREND_DAYS) -> DataFrame:
    """Every quote against the average of its currency's quotes of the last ``days`` days, its own included.

    The frame spans days, not rows, so days without a quote shorten it and a gap longer than
    the span leaves the quote alone with itself. A currency has one row a day.
    """
    mids = usable_mids(t["fact_rates"], t["dim_currency"])
    span = Window.partitionBy("currency_code").orderBy(F.unix_date("effective_date")).rangeBetween(1 - days, 0)
    found = mids.select(
        "currency_code", "effective_date", "mid_rate",
        F.count("*").over(span).alias("quotes"),
        (F.sum("mid_rate").over(span).cast("double") / F.count("*").over(span)).alias("average"),
    )
    return found.withColumn("deviation", F.col("mid_rate").cast("double") / F.col("average") - 1)


def monthly_moments(t: Tables) -> DataFrame:
    """(currency_code, month, n, mean, m2): count, mean and squared deviations of a month's quotes.

    ``month`` counts months, twelve a year. Moments of months can be merged, so no span needs
    the quotes again.
    """
    mids = usable_mids(t["fact_rates"], t["dim_currency"]).withColumn("mid", F.col("mid_rate").cast("double"))
    month = F.year("effective_date") * 12 + F.month("effective_date") - 1
    return mids.groupBy("currency_code", month.alias("month")).agg(
        F.count("*").alias("n"), F.avg("mid").alias("mean"), (F.var_pop("mid") * F.count("*")).alias("m2"))


def merged(a: Column, b: Column) -> Column:
    """Moments of two sets of values together."""
    n = a["n"] + b["n"]
    apart = b["mean"] - a["mean"]
    return F.struct(
        n.alias("n"), (a["mean"] + apart * b["n"] / n).alias("mean"),
        (a["m2"] + b["m2"] + apart * apart * a["n"] * b["n"] / n).alias("m2"))


def span_volatility(t: Tables, spans: tuple[int, ...] = (3, 6, 12)) -> DataFrame:
    """Deviation and variation of each currency's quotes over the last 3, 6 and 12 months, month by month.

    The moments of at most twelve months are merged a row; months without quotes count nothing,
    a span of a single quote has no deviation.
    """
    moments = monthly_moments(t)
    out = None
    for months in spans:
        span = Window.partitionBy("currency_code").orderBy("month").rangeBetween(1 - months, 0)
        held = moments.select("currency_code", "month", F.collect_list(F.struct("n", "mean", "m2")).over(span).alias("held"))
        whole = F.aggregate(F.slice("held", 2, months), F.element_at("held", 1), merged)
        one = held.select("currency_code", "month", F.lit(months).alias("months"), whole.alias("w")).select(
            "currency_code", F.floor(F.col("month") / 12).cast("int").alias("year"), (F.col("month") % 12 + 1).alias("month"),
            "months", F.col("w.n").alias("quotes"), F.col("w.mean").alias("mean"),
            F.when(F.col("w.n") > 1, F.sqrt(F.col("w.m2") / (F.col("w.n") - 1))).alias("volatility"))
        out = one if out is None else out.unionByName(one)
    return out.withColumn("variation", safe_ratio(F.col("volatility"), F.col("mean")))


def under_pressure(t: Tables, count: int = 2) -> DataFrame:
    """The currencies that fell most over 30 days, as one text, strongest fall first."""
    falls = (
        rate_trend(t, ["currency_code"]).where(F.col("change_30d").isNotNull())
        .orderBy("change_30d", "currency_code").limit(count)
    )
    ordered = F.sort_array(F.collect_list(F.struct("change_30d", "currency_code")))
    return falls.agg(
        F.array_join(F.transform(ordered, lambda s: s["currency_code"]), " / ").alias("under_pressure")
    )
