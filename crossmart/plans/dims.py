"""Dimension loads as pure functions: (current dimension, staging) -> new dimension.

Parquet has no MERGE, so a load computes the next state of a dimension and the caller
writes it as a new version. Every function scans its staging input through a grouped
aggregate, so hot categories, currencies or products are combined before the shuffle.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from crossmart import schemas
from crossmart.functions import differs, table_label, table_rank
from crossmart.operators.keys import assign_keys, highest_key
from crossmart.operators.pick import first_row, latest_value
from crossmart.sources import seeds

# --- fixed values: markets whose product texts are preferred, in order ---------------------
PREFERRED_MARKETS = ["US", "GB", "IE", "AU"]
OTHER_MARKET_RANK = 9
TRACKED = ["product_name", "color_name", "gender_segment", "category", "model_number"]
# -----------------------------------------------------------------------------------------------


def empty(spark: SparkSession, schema: StructType) -> DataFrame:
    """No rows, in a form the optimizer sees as empty: joins against it are planned away."""
    columns = ", ".join(f"CAST(NULL AS {f.dataType.simpleString()}) AS {f.name}" for f in schema.fields)
    return spark.sql(f"SELECT {columns} WHERE false")


def quoted_currencies(rates_stg: DataFrame) -> DataFrame:
    """Currencies of the staged quotes: largest name, best table."""
    return (
        rates_stg.where(F.col("code").isNotNull())
        .groupBy(F.col("code").alias("currency_code"))
        .agg(
            F.max("currency_name_pl").alias("s_name"),
            F.min(table_rank(F.col("table_type"))).alias("s_rank"),
        )
        .withColumn("s_table", table_label(F.col("s_rank")))
        .drop("s_rank")
    )


def load_currency(dim: DataFrame, rates_stg: DataFrame, catalogue_stg: DataFrame | None) -> DataFrame:
    """Upsert of quoted currencies, catalogue-only currencies, base currency, names.

    A known code gets the quoted name and table and keeps its English name; an unknown one
    starts with both names equal. Catalogue codes nobody quotes are named by their code.
    """
    spark = dim.sparkSession
    quoted = quoted_currencies(rates_stg)
    merged = dim.join(quoted, "currency_code", "full").select(
        "currency_key",
        "currency_code",
        F.when(F.col("currency_key").isNull(), F.col("s_name"))
        .otherwise(F.col("currency_name")).alias("currency_name"),
        F.when(F.col("s_table").isNotNull(), F.col("s_name"))
        .otherwise(F.col("currency_name_pl")).alias("currency_name_pl"),
        F.coalesce("s_table", "nbp_table_type").alias("nbp_table_type"),
        F.coalesce("is_base_currency", F.lit(False)).alias("is_base_currency"),
        "current_mid_rate",
    )
    extra = seeds.inline_table(spark, [(seeds.BASE_CODE,)], "currency_code")
    if catalogue_stg is not None:
        traded = catalogue_stg.where(F.col("currency").isNotNull())
        extra = extra.unionByName(traded.select(F.col("currency").alias("currency_code")).distinct())
    unknown = extra.distinct().join(merged.select("currency_code"), "currency_code", "left_anti")
    added = unknown.select(
        F.lit(None).cast("bigint").alias("currency_key"),
        "currency_code",
        F.col("currency_code").alias("currency_name"),
        F.lit(None).cast("string").alias("currency_name_pl"),
        F.lit(None).cast("string").alias("nbp_table_type"),
        F.lit(False).alias("is_base_currency"),
        F.lit(None).cast("decimal(18,6)").alias("current_mid_rate"),
    )
    everything = merged.unionByName(added)
    known = everything.where(F.col("currency_key").isNotNull())
    numbered = assign_keys(
        everything.where(F.col("currency_key").isNull()).drop("currency_key"),
        ["currency_code"], "currency_key", highest_key(dim, "currency_key"),
    )
    return named_currencies(known.unionByName(numbered))


def named_currencies(dim: DataFrame) -> DataFrame:
    """Readable English names for listed codes and the fixed facts of the base currency."""
    base = F.col("currency_code") == seeds.BASE_CODE
    names = F.broadcast(seeds.currency_names(dim.sparkSession))  # a fixed list of 28 rows
    return dim.join(names, "currency_code", "left").select(
        "currency_key",
        "currency_code",
        F.when(base, F.lit(seeds.BASE_NAME))
        .otherwise(F.coalesce("english", "currency_name")).alias("currency_name"),
        F.when(base, F.lit(seeds.BASE_NAME_PL))
        .otherwise(F.col("currency_name_pl")).alias("currency_name_pl"),
        "nbp_table_type",
        (base | F.col("is_base_currency")).alias("is_base_currency"),
        F.when(base, F.lit(1).cast(schemas.RATE))
        .otherwise(F.col("current_mid_rate")).alias("current_mid_rate"),
    )


def latest_mids(fact_rates: DataFrame) -> DataFrame:
    """Newest quoted mid per currency over the tables that carry mids."""
    usable = fact_rates.where(
        F.col("table_type").isin("A", "B") & F.col("mid_rate").isNotNull()
    )
    return latest_value(usable, ["currency_key"], "mid_rate", "effective_date")


def refresh_current_rate(dim: DataFrame, fact_rates: DataFrame) -> DataFrame:
    """Overwrite the current rate (no history) by the newest quoted mid."""
    newest = latest_mids(fact_rates).withColumnRenamed("mid_rate", "_mid")
    return (
        dim.join(newest, "currency_key", "left")
        .withColumn("current_mid_rate", F.coalesce("_mid", "current_mid_rate"))
        .select(*dim.columns)
    )


def category_pairs(catalogue_stg: DataFrame) -> DataFrame:
    """Distinct (category, label) pairs of the staged catalogue."""
    return (
        catalogue_stg.where(F.col("category").isNotNull())
        .select("category", "subcategory").distinct()
    )


def load_category(
    dim: DataFrame, catalogue_stg: DataFrame, found: DataFrame | None = None
) -> DataFrame:
    """Two-level hierarchy: top categories, then labels below them with the parent's key.

    A label equal to its category (or missing) makes no second-level row. ``found`` are
    the catalogue's pairs where a load has written them already.
    """
    pairs = found if found is not None else category_pairs(catalogue_stg)
    tops = dim.where("category_level = 1")
    new_tops = pairs.select("category").distinct().join(tops, "category", "left_anti")
    numbered_tops = assign_keys(
        new_tops, ["category"], "category_key", highest_key(dim, "category_key")
    ).select(
        "category_key", "category", F.col("category").alias("subcategory"),
        F.lit(1).alias("category_level"), F.lit(None).cast("bigint").alias("parent_category_key"),
    )
    with_tops = dim.unionByName(numbered_tops)
    parents = with_tops.where("category_level = 1").select(
        "category", F.col("category_key").alias("parent_category_key")
    )
    labels = dim.where("category_level = 2")
    new_labels = (
        pairs.where(F.col("subcategory").isNotNull() & (F.col("subcategory") != F.col("category")))
        .join(labels, ["category", "subcategory"], "left_anti")
        .join(parents, "category")
    )
    numbered_labels = assign_keys(
        new_labels, ["category", "subcategory"], "category_key",
        highest_key(with_tops, "category_key"),
    ).withColumn("category_level", F.lit(2))
    return with_tops.unionByName(numbered_labels).select(*schemas.DIM_CATEGORY.names)


def canonical_products(catalogue_stg: DataFrame) -> DataFrame:
    """One attribute row per style: preferred market first, then country, newest snapshot.

    The ranking is cut to one row per style on the map side, so a style with a third of
    all rows still sends one row per map task to the shuffle.
    """
    rank = F.lit(OTHER_MARKET_RANK)
    for position, market in reversed(list(enumerate(PREFERRED_MARKETS, start=1))):
        rank = F.when(F.col("country_code") == market, position).otherwise(rank)
    attributes = ["model_number", "product_name", "color_name", "gender_segment", "category"]
    newest = F.coalesce(F.unix_date(F.col("snapshot_date").try_cast("date")), F.lit(-999999)).desc()
    keyed = catalogue_stg.where(F.col("style_color").isNotNull()).select(
        "style_color", "country_code", "snapshot_date", *attributes
    )
    ranked = first_row(keyed, ["style_color"], [rank, "country_code", newest])
    return ranked.select("style_color", *attributes)


def load_product_scd2(
    dim: DataFrame, catalogue_stg: DataFrame | None, load_date: date, products: DataFrame | None = None
) -> DataFrame:
    """Type-2 history: close changed current versions, open new ones from ``load_date``.

    Products missing from the source stay current. The current versions and the source
    meet in one full outer join; closed versions pass through untouched.
    """
    source = products if products is not None else canonical_products(catalogue_stg)
    current = dim.where("is_current")
    names = [c for c in source.columns if c != "style_color"]
    incoming = source.select(
        "style_color", F.lit(True).alias("_seen"), *[F.col(c).alias(f"s_{c}") for c in names]
    )
    pairs = current.withColumn("_known", F.lit(True)).join(incoming, "style_color", "full")
    changed = F.lit(False)
    for c in TRACKED:
        changed = changed | differs(F.col(c), F.col(f"s_{c}"))
    closes = F.col("_known").isNotNull() & F.col("_seen").isNotNull() & changed
    opens = F.col("_seen").isNotNull() & (F.col("_known").isNull() | changed)
    after = (
        pairs.where(F.col("_known").isNotNull())
        .withColumn("_close", closes)
        .withColumn("valid_to", F.when(F.col("_close"), F.date_sub(F.lit(load_date), 1))
                    .otherwise(F.col("valid_to")))
        .withColumn("is_current", ~F.col("_close"))
        .select(*dim.columns)
    )
    opened = pairs.where(opens).select("style_color", *[F.col(f"s_{c}").alias(c) for c in names])
    numbered = assign_keys(
        opened, ["style_color"], "product_key", highest_key(dim, "product_key")
    ).select(
        "product_key", "style_color", *names,
        F.lit(load_date).alias("valid_from"),
        F.lit(None).cast("date").alias("valid_to"),
        F.lit(True).alias("is_current"),
        F.current_timestamp().alias("etl_load_date"),
    )
    return dim.where("NOT is_current").unionByName(after).unionByName(numbered)


def settled(dim: DataFrame) -> DataFrame:
    """The history without versions that a second change on their own day replaced.

    Such a version ends before it begins, so no day ever showed it.
    """
    return dim.where(F.col("valid_to").isNull() | (F.col("valid_to") >= F.col("valid_from")))


def version_faults(dim: DataFrame) -> DataFrame:
    """(style_color, fault, valid_from, valid_to) of versions that do not fit the next one of their product.

    ``reversed`` ends before it begins, as a version does that is replaced on its first day.
    The others are swept in order of their days: ``overlap`` goes on when the next begins,
    ``gap`` leaves days without a version, ``unmarked`` is the last one without the current
    mark, ``twice`` carries the mark and is not the last.
    """
    begin, end = F.col("valid_from"), F.col("valid_to")
    reversed_ = dim.where(end < begin).select("style_color", F.lit("reversed").alias("fault"), "valid_from", "valid_to")
    order = Window.partitionBy("style_color").orderBy("valid_from", F.col("valid_to").asc_nulls_last(), "product_key")
    following = F.lead("valid_from").over(order)
    swept = settled(dim).withColumn("next_from", following)
    last = F.col("next_from").isNull()
    faults = F.array_compact(F.array(
        F.when(~last & (end.isNull() | (F.col("next_from") <= end)), F.lit("overlap")),
        F.when(F.col("next_from") > F.date_add(end, 1), F.lit("gap")),
        F.when(last & ~F.col("is_current"), F.lit("unmarked")),
        F.when(~last & F.col("is_current"), F.lit("twice")),
    ))
    return swept.select("style_color", F.explode(faults).alias("fault"), "valid_from", "valid_to").unionByName(reversed_)


# --- content-addressed products --------------------------------------------------------------


def content_hash(*columns: str) -> Column:
    """SHA-256 of some columns in order; a null differs from an empty text, and no two cells run together."""
    cells = [F.col(c).cast("string") for c in columns]
    return F.sha2(F.concat_ws("\x1f", *[F.coalesce(F.concat(F.lit("="), c), F.lit("-")) for c in cells]), 256)


def addressed(products: DataFrame) -> DataFrame:
    """Products with a key made of their grain and a digest of the attributes whose change opens a version."""
    return products.withColumns({
        "product_hash": content_hash("style_color"), "change_digest": content_hash(*TRACKED)})


def load_addressed(dim: DataFrame, source: DataFrame, load_date: date) -> DataFrame:
    """Type-2 history of :func:`addressed` products without comparing columns or numbering keys.

    A source row whose (key, digest) no current version has is new or changed: its product's
    current version closes, and a version opens whose key is a hash of grain, content and
    day, so any run of the same load gives the same keys. Loading a source again adds nothing.
    """
    incoming = addressed(source)
    current = dim.where("is_current")
    fresh = incoming.join(current.select("product_hash", "change_digest"), ["product_hash", "change_digest"], "left_anti")
    closing = fresh.select("product_hash", F.lit(True).alias("_close"))
    open_now = current.join(closing, "product_hash", "left").withColumn("_close", F.coalesce("_close", F.lit(False)))
    kept = open_now.withColumns({
        "valid_to": F.when(F.col("_close"), F.date_sub(F.lit(load_date), 1)).otherwise(F.col("valid_to")),
        "is_current": ~F.col("_close")}).select(*dim.columns)
    opened = fresh.withColumns({
        "valid_from": F.lit(load_date), "valid_to": F.lit(None).cast("date"), "is_current": F.lit(True),
    }).withColumn("version_hash", content_hash("product_hash", "change_digest", "valid_from")).select(*dim.columns)
    return dim.where("NOT is_current").unionByName(kept).unionByName(opened)


def no_addressed(spark: SparkSession) -> DataFrame:
    """The empty history that :func:`load_addressed` starts from."""
    names = ["version_hash", "product_hash", "change_digest", "style_color", "model_number", "product_name", "color_name",
             "gender_segment", "category"]
    return empty(spark, schemas.text_schema(names).add("valid_from", "date").add("valid_to", "date").add("is_current", "boolean"))
