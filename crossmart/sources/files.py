"""File sources and sinks: catalogue and rate CSV, rate documents, extracts and listings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from crossmart import schemas
from crossmart.functions import blank_to_null, default_label, table_label, table_rank
from crossmart.operators.pick import first_row
from crossmart.sources.split_csv import read_split_csv, splittable


def read_text_csv(
    spark: SparkSession, path: str, columns: list[str], multi_line: bool = True
) -> DataFrame:
    """All-text CSV with a header; only the empty field is NULL, ``NA`` stays text.

    Quoted fields may hold line breaks, which takes one task a file here: use
    :func:`crossmart.sources.split_csv.read_split_csv` for large files, or pass
    ``multi_line=False`` where no field holds a break.
    The file may hold its columns in any order and more of them than asked for.
    """
    reader = spark.read.options(
        header=True, quote='"', escape='"', nullValue="", emptyValue="", encoding="UTF-8",
        multiLine=multi_line, inferSchema=False,
    )
    return reader.csv(path).select(*[F.col(c).cast("string").alias(c) for c in columns])


def read_catalogue_csv(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """Catalogue files; quoted line breaks keep no large file from being read by many tasks.

    Files that fit one task anyway are read file by file, with the same result.
    """
    if multi_line and splittable(spark, path):
        return read_split_csv(spark, path, schemas.CATALOGUE_COLUMNS)
    return read_text_csv(spark, path, schemas.CATALOGUE_COLUMNS, multi_line)


def read_rates_csv(spark: SparkSession, path: str) -> DataFrame:
    return read_text_csv(spark, path, schemas.RATE_COLUMNS, multi_line=False)


def stage(df: DataFrame, columns: list[str], batch_id: int) -> DataFrame:
    """Text mirror of a source: blanks become NULL, the batch id is appended."""
    return df.select(
        *[blank_to_null(F.col(c).cast("string")).alias(c) for c in columns],
        F.lit(batch_id).cast("int").alias("load_batch_id"),
    )


def stage_catalogue(df: DataFrame, batch_id: int) -> DataFrame:
    """Catalogue staging; a missing subcategory gets the default label first."""
    labelled = df.withColumn("subcategory", default_label(F.col("subcategory")))
    return stage(labelled, schemas.CATALOGUE_COLUMNS, batch_id)


def stage_rates(df: DataFrame, batch_id: int) -> DataFrame:
    return stage(df, schemas.RATE_COLUMNS, batch_id)


def collapse_sizes(raw: DataFrame, order: tuple[str, ...] = ("sku",)) -> DataFrame:
    """First-seen row per (style, country, snapshot); rows without a key have no place here."""
    keys = ["style_color", "country_code", "snapshot_date"]
    keyed = raw.where(
        (F.coalesce("style_color", F.lit("")) != "") & (F.coalesce("country_code", F.lit("")) != "")
    )
    return first_row(keyed, keys, list(order))


def without_key(raw: DataFrame) -> DataFrame:
    """Rows that cannot be collapsed; staged as they are so that the reject log explains them."""
    return raw.where(
        (F.coalesce("style_color", F.lit("")) == "") | (F.coalesce("country_code", F.lit("")) == "")
    )


def read_rate_documents(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """Landed answers of the rate service, each one a JSON array of publications.

    One answer per file by default; with ``multi_line=False`` one answer per line, which
    keeps large archives splittable.
    """
    return spark.read.schema(schemas.RATE_DOCUMENT).json(path, multiLine=multi_line)


def parse_rate_documents(texts: DataFrame, column: str) -> DataFrame:
    """Publications out of a text column holding one JSON array per row."""
    document = F.from_json(column, T.ArrayType(schemas.RATE_DOCUMENT))
    kept = [c for c in texts.columns if c != column]
    return texts.select(*kept, F.inline(document))


def flatten_rates(documents: DataFrame, table_type: str | Column) -> DataFrame:
    """One row per quote, publication fields repeated; absent fields are NULL.

    The table letter is part of the request, not of the answer.
    """
    letter = F.lit(table_type) if isinstance(table_type, str) else table_type
    quotes = documents.select(
        letter.alias("table_type"),
        F.col("no").alias("table_no"),
        F.col("effectiveDate").alias("effective_date"),
        F.col("tradingDate").alias("trading_date"),
        F.explode("rates").alias("q"),
    )
    return quotes.select(
        "table_type", "table_no", "effective_date", "trading_date",
        F.col("q.code").alias("code"),
        F.col("q.currency").alias("currency_name_pl"),
        F.col("q.mid").alias("mid"), F.col("q.bid").alias("bid"), F.col("q.ask").alias("ask"),
    )


def distinct_quotes(rates: DataFrame) -> DataFrame:
    """One row per (date, code, table): overlapping requests return the same quote again."""
    return first_row(rates, ["effective_date", "code", "table_type"], ["table_no"])


def rate_statistics(fetched: DataFrame, kept: DataFrame) -> DataFrame:
    """One row about an ingestion: rows before and after dedup, codes per table, quoted days."""
    best = currency_map(kept).agg(
        F.count("*").alias("currencies"),
        *[F.count_if(F.col("nbp_table_type") == t).alias(f"currencies_{t.lower()}") for t in "ABC"],
    )
    # days are grouped first, so no task gathers the quotes of all days
    days = kept.where(F.col("effective_date").isNotNull()).groupBy("effective_date").agg(F.count("*")).agg(
        F.min("effective_date").alias("first_day"), F.max("effective_date").alias("last_day"),
        F.count("*").alias("days"),
    )
    rows = lambda df: df.select(F.count("*").alias("n")).scalar()
    span = days.select(F.struct("first_day", "last_day", "days").alias("s")).scalar()
    return best.select(
        rows(fetched).alias("rows_fetched"), rows(kept).alias("rows_kept"), "*",
        span["first_day"].alias("first_day"), span["last_day"].alias("last_day"), span["days"].alias("days"),
    )


def currency_map(rates: DataFrame) -> DataFrame:
    """Best table per code (A over B over C) and the name seen first in that order."""
    seen = F.struct(
        table_rank(F.col("table_type")).alias("rank"),
        F.col("effective_date"),
        F.col("currency_name_pl").alias("name"),
    )
    return (
        rates.where(F.col("code").isNotNull())
        .groupBy("code")
        .agg(F.min(seen).alias("s"))
        .select(
            F.col("code").alias("currency_code"),
            F.col("s.name").alias("currency_name_pl"),
            table_label(F.col("s.rank")).alias("nbp_table_type"),
        )
    )


def write_csv(df: DataFrame, path: str, order: list[Column | str] | None = None) -> None:
    """CSV listing, NULL as an empty field; ``order`` is a total sort over all part files."""
    listed = df.orderBy(*order) if order else df
    listed.write.mode("overwrite").option("header", True).option("nullValue", "").option(
        "emptyValue", ""
    ).option("escape", '"').csv(path)


def write_rates_csv(rates: DataFrame, path: str) -> None:
    """Staging file of the flattened quotes, by date, table and code."""
    blank = F.lit("")
    order = [F.coalesce("effective_date", blank), F.col("table_type"), F.coalesce("code", blank)]
    write_csv(rates.select(*schemas.RATE_COLUMNS), path, order)


def write_currency_map(rates: DataFrame, path: str) -> None:
    """The code map twice: JSON lines for the profiler, CSV as the currency seed."""
    codes = currency_map(rates)
    codes.orderBy("currency_code").write.mode("overwrite").json(f"{path}/codes")
    write_csv(codes, f"{path}/seed", ["currency_code"])


def write_profile(parts: dict[str, DataFrame], path: str) -> None:
    """Profile parts as JSON lines; the currency coverage also as CSV, most rows first."""
    for name, part in parts.items():
        part.write.mode("overwrite").json(f"{path}/{name}")
    write_csv(
        parts["currency_coverage"], f"{path}/currency_coverage_csv", [F.desc("rows"), F.col("currency")]
    )


def product_country_extract(collapsed: DataFrame, limit: int = 0) -> DataFrame:
    """Product x country extract, whole or the first ``limit`` rows by style and country."""
    listed = collapsed.select(*schemas.CATALOGUE_COLUMNS)
    order = ["style_color", "country_code", "snapshot_date"]
    return listed.orderBy(*order).limit(limit) if limit else listed
