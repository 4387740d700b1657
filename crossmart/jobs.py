"""Command line jobs for ``spark-submit``: load, compact, rates, profile.

    python -m crossmart.jobs load --root DIR --mode initial --catalogue FILES --rates FILES
    python -m crossmart.jobs compact --root DIR [--fan N] [--buckets N]
    python -m crossmart.jobs rates --landed DIR --tables A B --out DIR [--start D --end D | --last-days N]
    python -m crossmart.jobs profile --catalogue FILES --codes DIR --out DIR

The session is the submitting cluster's; nothing is configured here.
"""

from __future__ import annotations

import argparse
from datetime import date

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from crossmart.plans import calendar, profile, storage
from crossmart.plans.warehouse import MODES, compact, run_load
from crossmart.sources import files
from crossmart.sources.split_csv import read_split_csv


def arguments(argv: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="crossmart.jobs")
    jobs = parser.add_subparsers(dest="job", required=True)

    load = jobs.add_parser("load", help="load one batch into the warehouse")
    load.add_argument("--root", required=True)
    load.add_argument("--mode", choices=MODES, default="initial")
    load.add_argument("--catalogue", help="catalogue CSV files (product x country)")
    load.add_argument("--rates", required=True, help="rate CSV files")
    load.add_argument("--skip-catalogue", action="store_true", help="load rates only")
    load.add_argument("--load-date", type=date.fromisoformat, default=None)

    merge = jobs.add_parser("compact", help="merge small fact folders")
    merge.add_argument("--root", required=True)
    merge.add_argument("--fan", type=int, default=storage.FAN, help="folders of about one size that are merged")
    merge.add_argument("--buckets", type=int, help="rewrite the price folders in that many buckets")

    rates = jobs.add_parser("rates", help="flatten landed rate documents")
    rates.add_argument("--landed", required=True, help="folder with one sub-folder per table letter")
    rates.add_argument("--tables", nargs="+", default=["A", "B"])
    rates.add_argument("--start", type=date.fromisoformat)
    rates.add_argument("--end", type=date.fromisoformat)
    rates.add_argument("--last-days", type=int)
    rates.add_argument("--out", required=True)

    check = jobs.add_parser("profile", help="profile a raw catalogue")
    check.add_argument("--catalogue", required=True, help="raw catalogue CSV files (per size)")
    check.add_argument("--codes", help="code map written by the rates job")
    check.add_argument("--extract-rows", type=int, default=0, help="0 writes the whole extract")
    check.add_argument("--out", required=True)
    return parser.parse_args(argv)


def load_job(spark: SparkSession, args: argparse.Namespace) -> None:
    catalogue = None if args.skip_catalogue else files.read_catalogue_csv(spark, args.catalogue)
    run_load(
        spark, args.root, catalogue, files.read_rates_csv(spark, args.rates), args.mode,
        args.load_date, rates_only=args.skip_catalogue,
    )


def rates_job(spark: SparkSession, args: argparse.Namespace) -> None:
    """Flattened quotes, the code map, and the request segments of the asked range."""
    parts = [
        files.flatten_rates(files.read_rate_documents(spark, f"{args.landed}/{letter}"), letter)
        for letter in args.tables
    ]
    quotes = parts[0]
    for part in parts[1:]:
        quotes = quotes.unionByName(part)
    bounds = None
    if args.last_days is not None:
        bounds = calendar.last_days(args.last_days)
    elif args.start and args.end:
        bounds = F.lit(args.start), F.lit(args.end)
    if bounds:
        quotes = quotes.where(F.col("effective_date").try_cast("date").between(*bounds))
        segments = calendar.date_segments(spark, *bounds)
        files.write_csv(segments, f"{args.out}/segments", ["segment_start"])
    unique = files.distinct_quotes(quotes)
    files.write_rates_csv(unique, f"{args.out}/rates")
    files.write_currency_map(unique, f"{args.out}/currency_map")
    files.rate_statistics(quotes, unique).write.mode("overwrite").json(f"{args.out}/statistics")


def profile_job(spark: SparkSession, args: argparse.Namespace) -> None:
    raw = read_split_csv(spark, args.catalogue, profile.PROFILED)
    if args.codes:
        codes = spark.read.schema("currency_code string, nbp_table_type string").json(args.codes)
    else:
        codes = spark.sql("SELECT '' AS currency_code, '' AS nbp_table_type WHERE false")
    files.write_profile(profile.profile(raw, codes), args.out)
    extract = files.product_country_extract(files.collapse_sizes(raw), args.extract_rows)
    files.write_csv(extract, f"{args.out}/product_country")


def compact_job(spark: SparkSession, args: argparse.Namespace) -> None:
    compact(spark, args.root, args.fan, args.buckets)


JOBS = {"load": load_job, "compact": compact_job, "rates": rates_job, "profile": profile_job}


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> None:
    args = arguments(argv)
    JOBS[args.job](spark or SparkSession.builder.getOrCreate(), args)


if __name__ == "__main__":
    main()
