"""The stored warehouse: load order, load modes, run audit and versioned tables.

Layout under one root folder::

    run_log/                       one small row per run event (RUNNING, SUCCESS, FAILED)
    staging_rates/run=7/           text mirror of the batch (last one counts)
    staging_catalogue/run=7/
    dim_*/run=7/                   dimension as of run 7
    reject_log/run=7/
    fact_rates/run=7/              rows appended by run 7, or what compaction 7 merged
    fact_prices/run=7/             the same, bucketed by product key
    manifest/run=7/                the fact folders that make up the tables as of run 7

The audit log is the commit record. A reader takes the dimensions and the manifest of the
newest successful run, so a failed run leaves nothing visible, and a load never rewrites
facts that are already stored. Compactions do, into new folders (see ``storage``).
"""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from datetime import date
from functools import cached_property

from pyspark import inheritable_thread_target
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from crossmart import schemas
from crossmart.plans import dims, facts, storage
from crossmart.plans.calendar import calendar, refresh_working_days
from crossmart.sources import seeds
from crossmart.sources.files import stage_catalogue, stage_rates

DIMENSIONS = {
    "dim_date": schemas.DIM_DATE,
    "dim_currency": schemas.DIM_CURRENCY,
    "dim_geography": schemas.DIM_GEOGRAPHY,
    "dim_category": schemas.DIM_CATEGORY,
    "dim_product": schemas.DIM_PRODUCT,
    "reject_log": schemas.REJECT_LOG,
}
FACTS = {"fact_rates": schemas.FACT_RATES, "fact_prices": schemas.FACT_PRICES}
STAGING = {
    "staging_rates": schemas.text_schema(schemas.RATE_COLUMNS).add("load_batch_id", "integer"),
    "staging_catalogue": schemas.text_schema(schemas.CATALOGUE_COLUMNS).add("load_batch_id", "integer"),
}
WORK = ["currency", "pairs", "products", "rates"]
PACKAGE = "crossmart.load"
COMPACTION = "COMPACTION"
#: Successful runs whose staging and dimension tables stay readable.
KEPT_RUNS = 3


class Warehouse:
    """Read side of a stored warehouse, fixed to the runs committed when it was opened."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        committed = (
            self.run_events().where("status = 'SUCCESS'").select("run_id", "load_type").distinct()
        )
        rows = committed.orderBy("run_id").collect()  # one short row per load ever run
        self.committed = [r.run_id for r in rows]
        loads = [r for r in rows if r.load_type != COMPACTION]
        self.runs = [r.run_id for r in loads]
        self.price_runs = [r.run_id for r in loads if not r.load_type.endswith(RATES_ONLY)]

    @cached_property
    def folders(self) -> list[storage.Folder]:
        """The newest manifest as of when the warehouse was opened."""
        return storage.read_manifest(self.spark, self.root, self.committed[-1]) if self.committed else []

    def path(self, table: str, run: int | None = None) -> str:
        return f"{self.root}/{table}" + (f"/run={run}" if run is not None else "")

    def run_events(self) -> DataFrame:
        return read_or_empty(self.spark, f"{self.root}/run_log", schemas.RUN_LOG)

    def table(self, name: str) -> DataFrame:
        """Current content of a table; before the first run an empty (or seed) table."""
        if name in FACTS:
            return self._fact(name)
        schema = DIMENSIONS.get(name) or STAGING[name]
        runs = self.price_runs if name == "staging_catalogue" else self.runs
        run = runs[-1] if runs else None
        if run is not None:
            return self.spark.read.schema(schema).parquet(self.path(name, run))
        if name == "dim_date":
            return calendar(self.spark)
        if name == "dim_geography":
            return seeds.geography(self.spark)
        return dims.empty(self.spark, schema)

    def folders_of(self, name: str) -> list[storage.Folder]:
        return [f for f in self.folders if f.table == name and f.rows]

    def _fact(self, name: str) -> DataFrame:
        paths = [self.path(name, f.run) for f in self.folders_of(name)]
        if not paths:
            return dims.empty(self.spark, FACTS[name])
        return self.spark.read.schema(FACTS[name]).parquet(*paths)

    def rows_of(self, name: str) -> int:
        return sum(f.rows for f in self.folders_of(name))

    @property
    def buckets(self) -> int | None:
        """Buckets of the price folders; None without any, or while a compaction has yet to bring them together."""
        used = {f.buckets for f in self.folders_of("fact_prices")}
        return used.pop() if len(used) == 1 else None

    def tables(self) -> dict[str, DataFrame]:
        return {name: self.table(name) for name in [*DIMENSIONS, *FACTS]}

    def _placed(self, name: str, folders: list[storage.Folder]) -> DataFrame:
        schema = FACTS.get(name) or DIMENSIONS[name]
        return storage.registered(
            self.spark, self.root, name, schema, [f.run for f in folders], folders[0].buckets, SORTED[name])

    def held_prices(self, first: date, last: date) -> DataFrame | None:
        """Stored prices of folders that meet the days, bucketed by product; None if there are none."""
        days = [int(d.strftime("%Y%m%d")) for d in (first, last)]
        folders = [f for f in self.folders_of("fact_prices") if f.meets(*days)]
        if not folders:
            return None
        rows = self.table("fact_prices") if self.buckets is None else self._placed("fact_prices", folders)
        return rows.where(F.col("date_key").between(*days))

    def tables_in_place(self) -> dict[str, DataFrame]:
        """As :meth:`tables`, with prices and products as bucketed tables of the session's catalogue.

        Grouping by product and joining products to prices then needs no shuffle.
        """
        found = self.tables()
        products = [f for f in self.folders if f.table == "dim_product"]
        if self.buckets and products:
            found["fact_prices"] = self._placed("fact_prices", self.folders_of("fact_prices"))
            if products[0].buckets == self.buckets:
                found["dim_product"] = self._placed("dim_product", products)
        return found

    def run_audit(self) -> DataFrame:
        """One row per run: first event's time as the start, the last event's state."""
        last = F.struct("event_time", "rows_in", "rows_out", "rows_rejected", "status", "message")
        return (
            self.run_events().groupBy("run_id", "package_name", "load_type")
            .agg(F.min("event_time").alias("start_time"), F.max(last).alias("l"))
            .select(
                "run_id", "package_name", "load_type", "start_time",
                F.when(F.col("l.status") != "RUNNING", F.col("l.event_time")).alias("end_time"),
                "l.rows_in", "l.rows_out", "l.rows_rejected", "l.status", "l.message",
            )
        )


RATES_ONLY = "RATES_ONLY"
MODES = ("initial", "incremental")
SORTED = {"fact_prices": "date_key", "dim_product": "style_color"}


def read_or_empty(spark: SparkSession, path: str, schema) -> DataFrame:
    """A parquet folder, or an empty frame while nobody has written it yet."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return dims.empty(spark, schema)


def log_event(
    spark: SparkSession, root: str, run: int, load_type: str, status: str, message: str | None = None,
    rows_in: int | None = None, rows_out: int | None = None, rows_rejected: int | None = None,
    package: str = PACKAGE,
) -> None:
    values = {
        "run_id": run, "package_name": package, "load_type": load_type, "rows_in": rows_in,
        "rows_out": rows_out, "rows_rejected": rows_rejected, "status": status,
        "message": message,
    }
    row = spark.range(1).select(
        *[
            (F.current_timestamp() if f.name == "event_time" else F.lit(values[f.name]))
            .cast(f.dataType).alias(f.name)
            for f in schemas.RUN_LOG.fields
        ]
    )
    row.coalesce(1).write.mode("append").parquet(f"{root}/run_log")


def write_table(df: DataFrame, path: str) -> DataFrame:
    """Write and read back: later steps start from files, not from this step's lineage."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def together(spark: SparkSession, *steps: Callable[[], None]) -> None:
    """Submit independent load steps at once, so small ones do not leave executors idle."""
    with ThreadPoolExecutor(len(steps)) as pool:
        for outcome in [pool.submit(inheritable_thread_target(spark)(step)) for step in steps]:
            outcome.result()


def run_load(
    spark: SparkSession,
    root: str,
    catalogue: DataFrame | None,
    rates: DataFrame,
    mode: str = "initial",
    load_date: date | None = None,
    rates_only: bool = False,
    unique: bool = False,
    keep: int = KEPT_RUNS,
    buckets: int | None = None,
) -> Warehouse:
    """One warehouse load with its audit trail; returns the warehouse after the load.

    Modes only label the run: the load logic is the same and repeatable. ``rates_only``
    leaves the staged catalogue of earlier runs alone and loads no prices. ``unique``
    says that ``catalogue`` holds one row per style, country and snapshot; the load fails
    if that is not so. Staging and dimension folders of the last ``keep`` successful runs
    stay, older ones are removed after a successful load; fact folders go once a compaction
    has replaced them and none of those runs' readers needs them. ``buckets`` is the number of
    buckets of a new warehouse's price folders.
    """
    if mode not in MODES:
        raise ValueError(f"mode is one of {MODES}")
    label = mode.upper() + (f"-{RATES_ONLY}" if rates_only else "")
    before, run = started_run(spark, root, label, PACKAGE)
    try:
        staged, rows_in = stage_batch(before, run, None if rates_only else catalogue, rates)
        counts, added = load_warehouse(before, run, staged, load_date or date.today(), unique, before.buckets or buckets or storage.BUCKETS)
        kept = [f for f in before.folders if f.table != "dim_product"]
        commit(before, run, kept, added)
    except Exception as error:
        log_event(spark, before.root, run, label, "FAILED", str(error))
        raise
    log_event(spark, before.root, run, label, "SUCCESS", "OK", rows_in=rows_in, **counts)
    after = Warehouse(spark, root)
    remove_old_folders(after, run, keep)
    return after


def started_run(spark: SparkSession, root: str, label: str, package: str) -> tuple[Warehouse, int]:
    """The warehouse and the number of a new run, whose first event is logged."""
    # an empty log on the very first run; nothing happens where one exists
    dims.empty(spark, schemas.RUN_LOG).write.mode("ignore").parquet(f"{root}/run_log")
    before = Warehouse(spark, root)
    highest = before.run_events().agg(F.max("run_id")).head()[0]
    run = (highest or 0) + 1
    log_event(spark, before.root, run, label, "RUNNING", package=package)
    started = before.run_events().where(F.col("run_id") == run).count()
    if started != 1:  # both loads write before they look, so at most one of them goes on
        message = f"another load has taken run {run} of {root}"
        log_event(spark, before.root, run, label, "FAILED", message, package=package)
        raise RuntimeError(message)
    return before, run


def commit(before: Warehouse, run: int, kept: list[storage.Folder], added: list[storage.Folder]) -> None:
    """Write the run's manifest; refuses if another run was committed since this one began."""
    newest = before.run_events().where("status = 'SUCCESS'").agg(F.max("run_id")).head()[0]
    if newest != (before.committed[-1] if before.committed else None):
        raise RuntimeError(f"run {newest} was committed while run {run} was at work; repeat it")
    storage.write_manifest(before.spark, before.root, run, [*kept, *added])


def compact(
    spark: SparkSession, root: str, fan: int = storage.FAN, buckets: int | None = None, keep: int = KEPT_RUNS
) -> Warehouse:
    """Merge small fact folders into larger ones, as a run of its own; returns the warehouse after it.

    Folders of about one size are merged as soon as ``fan`` of them are there, so the number
    of folders grows with the logarithm of the rows and a row is rewritten as often. A new
    number of ``buckets`` rewrites all price folders. Rows stay the same, and readers that are
    open go on with the old folders; a run that fails leaves nothing visible. With nothing to
    merge no run is logged.
    """
    seen = Warehouse(spark, root)
    groups = {name: storage.due(seen.folders_of(name), fan) for name in FACTS}
    if buckets and buckets != seen.buckets:
        groups["fact_prices"] = seen.folders_of("fact_prices")
    if not any(groups.values()):
        return seen
    before, run = started_run(spark, root, COMPACTION, f"{PACKAGE}.{COMPACTION.lower()}")
    try:
        merged = []
        for name, group in groups.items():
            if not group:
                continue
            rows = spark.read.schema(FACTS[name]).parquet(*[before.path(name, f.run) for f in group])
            total, path = sum(f.rows for f in group), before.path(name, run)
            if name == "fact_prices":
                count = buckets or before.buckets or storage.BUCKETS
                figures = storage.write_bucketed(rows, path, count, SORTED[name], "date_key")
            else:
                count = 0
                seen_rows, figures = storage.observed(rows.repartition(-(-total // storage.RATE_ROWS)), "date_key")
                seen_rows.write.mode("overwrite").parquet(path)
                figures = figures.get
            if figures["rows"] != total:
                raise RuntimeError(f"compaction of {name} read {figures['rows']} rows of {total}")
            merged.append(storage.folder_of(spark, before.root, name, run, figures, count))
        gone = {(f.table, f.run) for group in groups.values() for f in group}
        commit(before, run, [f for f in before.folders if (f.table, f.run) not in gone], merged)
    except Exception as error:
        log_event(spark, before.root, run, COMPACTION, "FAILED", str(error), package=f"{PACKAGE}.{COMPACTION.lower()}")
        raise
    total = sum(f.rows for f in merged)
    log_event(
        spark, before.root, run, COMPACTION, "SUCCESS", "OK", rows_in=total, rows_out=total, rows_rejected=0,
        package=f"{PACKAGE}.{COMPACTION.lower()}")
    after = Warehouse(spark, root)
    remove_old_folders(after, run, keep)
    return after


def remove_old_folders(state: Warehouse, run: int, keep: int) -> None:
    """Drop the work tables of this run, and tables of runs that none of the last ``keep`` needs.

    Readers that opened the warehouse up to ``keep - 1`` runs ago still find their tables.
    Fact folders go if a manifest that falls away names them and none that stays does.
    """
    fs, paths = storage.file_system(state.spark, state.root)

    def remove(name: str, old: int) -> None:
        fs.delete(paths(state.path(name, old)), True)

    for name in WORK:
        remove(f"work_{name}", run)
    for name in [*STAGING, *DIMENSIONS]:
        runs = state.price_runs if name == "staging_catalogue" else state.runs
        for old in runs[: -max(keep, 1)]:
            remove(name, old)
    falling = [r for r in state.committed[: -max(keep, 1)] if fs.exists(paths(state.path("manifest", r)))]
    staying = state.committed[-max(keep, 1):] if falling else []
    needed = {(f.table, f.run) for r in staying for f in storage.read_manifest(state.spark, state.root, r)}
    for old in falling:
        for f in storage.read_manifest(state.spark, state.root, old):
            if f.table in FACTS and (f.table, f.run) not in needed:
                remove(f.table, f.run)
        remove("manifest", old)


def stage_batch(
    state: Warehouse, run: int, catalogue: DataFrame | None, rates: DataFrame
) -> tuple[dict[str, DataFrame | None], int]:
    """Replace the staging tables by the text mirror of this batch; also its number of rows."""
    staged: dict[str, DataFrame | None] = {"catalogue": None}
    rows: list[int] = []

    def stage_one(name: str, df: DataFrame) -> None:
        counted, seen = storage.observed(df)
        staged[name] = write_table(counted, state.path(f"staging_{name}", run))
        rows.append(seen.get["rows"])

    steps = [lambda: stage_one("rates", stage_rates(rates, run))]
    if catalogue is not None:
        steps.append(lambda: stage_one("catalogue", stage_catalogue(catalogue, run)))
    together(state.spark, *steps)
    return staged, sum(rows)


def load_warehouse(
    state: Warehouse, run: int, staged: dict[str, DataFrame | None], load_date: date, unique: bool, buckets: int
) -> tuple[dict[str, int], list[storage.Folder]]:
    """Load order: currencies, categories, products, rates, prices, working days.

    Currencies with their rates, categories, products and rejects do not depend on each
    other and are loaded together; prices need all of them. Returns the figures of the run,
    which are observed on the frames being written, and the folders it adds.
    """
    rates_stg, catalogue_stg = staged["rates"], staged["catalogue"]
    old = state.tables()
    now: dict[str, DataFrame] = {}
    added: list[storage.Folder] = []
    rejected: list[int] = []

    def save(name: str, df: DataFrame) -> None:
        now[name] = write_table(df.select(*DIMENSIONS[name].names), state.path(name, run))

    def work(name: str, df: DataFrame) -> DataFrame:
        return write_table(df, state.path(f"work_{name}", run))

    def currencies_and_rates() -> None:
        codes = work("currency", dims.load_currency(old["dim_currency"], rates_stg, catalogue_stg))
        new, seen = storage.observed(facts.new_rates(old["fact_rates"], rates_stg, codes, old["dim_date"]), "date_key")
        stored = write_table(new, state.path("fact_rates", run))
        added.append(storage.folder_of(state.spark, state.root, "fact_rates", run, seen.get, 0))
        now["fact_rates"] = old["fact_rates"].unionByName(stored)
        together(
            state.spark,
            lambda: save("dim_currency", dims.refresh_current_rate(codes, now["fact_rates"])),
            lambda: save("dim_date", refresh_working_days(old["dim_date"], now["fact_rates"])),
        )

    def categories() -> None:
        found = catalogue_stg and work("pairs", dims.category_pairs(catalogue_stg))
        before = old["dim_category"]
        save("dim_category", dims.load_category(before, catalogue_stg, found) if found else before)

    def products() -> None:
        found = catalogue_stg and work("products", dims.canonical_products(catalogue_stg))
        before, path = old["dim_product"], state.path("dim_product", run)
        after = dims.load_product_scd2(before, catalogue_stg, load_date, found) if found else before
        figures = storage.write_bucketed(after.select(*DIMENSIONS["dim_product"].names), path, buckets, SORTED["dim_product"])
        now["dim_product"] = state.spark.read.schema(DIMENSIONS["dim_product"]).parquet(path)
        added.append(storage.folder_of(state.spark, state.root, "dim_product", run, figures, buckets))

    def markets_and_rejects() -> None:
        save("dim_geography", old["dim_geography"])
        before = old["reject_log"]
        if not catalogue_stg:
            return save("reject_log", before)
        own, seen = F.count_if(F.col("load_batch_id") == run), Observation()
        save("reject_log", facts.refresh_reject_log(before, catalogue_stg, run).observe(seen, own.alias("rows")))
        rejected.append(seen.get["rows"])

    together(state.spark, currencies_and_rates, categories, products, markets_and_rejects)
    rows_out = state.rows_of("fact_prices") + state.rows_of("fact_rates") + sum(f.rows for f in added if f.table in FACTS)
    if catalogue_stg is None:
        return {"rows_out": rows_out, "rows_rejected": 0}, added
    snapshot, first, last = facts.batch_days(catalogue_stg)
    if first is None:  # no readable snapshot
        return {"rows_out": rows_out, "rows_rejected": sum(rejected)}, added
    rates = work("rates", facts.rates_on(now["fact_rates"], now["dim_currency"], F.lit(snapshot).cast("date")))
    rows, held = facts.priced(facts.keyed_prices(catalogue_stg, now, unique), rates), state.held_prices(first, last)
    new = rows.repartition(buckets, storage.KEY) if held is None else storage.not_held(rows, held, buckets)
    path = state.path("fact_prices", run)
    figures = storage.write_bucketed(new, path, buckets, SORTED["fact_prices"], "date_key", placed=True)
    added.append(storage.folder_of(state.spark, state.root, "fact_prices", run, figures, buckets))
    if unique:
        stored = state.spark.read.schema(FACTS["fact_prices"]).parquet(path)
        if stored.groupBy("price_key").count().where("count > 1").limit(1).count():
            raise ValueError("the catalogue repeats a style, country and snapshot; load it without unique")
    return {"rows_out": rows_out + added[-1].rows, "rows_rejected": sum(rejected)}, added
