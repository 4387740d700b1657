"""How facts lie on disk: a manifest per run, folders bucketed by product, compaction.

Every successful run leaves a manifest, one short row per fact folder that makes up the
tables as of that run. Readers follow the manifest of the newest successful run, so folders
that a failed run or a failed compaction wrote are never seen, and a compaction can replace
many small folders by one while earlier readers still find theirs.

Price folders are bucketed by product key. Registered as one table, a partition a folder,
they can be grouped by and joined on the product where they lie, without a shuffle.
"""

from __future__ import annotations

import hashlib
import math
import uuid
from dataclasses import asdict, dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from crossmart.schemas import table

#: Buckets of a new warehouse; a compaction may choose another number.
BUCKETS = 16
#: Folders of about the same size that a compaction merges.
FAN = 8
#: Rows a file of a merged rate folder has at most.
RATE_ROWS = 2_000_000
KEY = "product_key"

MANIFEST = table(
    "table string, run integer, rows long, bytes long, files integer, first_day integer, last_day integer, buckets integer"
)


@dataclass(frozen=True)
class Folder:
    """One fact folder: its rows, its size, the days it spans and its number of buckets (0: none)."""

    table: str
    run: int
    rows: int
    bytes: int
    files: int
    first_day: int | None
    last_day: int | None
    buckets: int

    def meets(self, first: int, last: int) -> bool:
        return self.first_day is None or (self.first_day <= last and self.last_day >= first)


def read_manifest(spark: SparkSession, root: str, run: int) -> list[Folder]:
    """The folders as of a run; compaction keeps their number logarithmic in the rows."""
    rows = spark.read.schema(MANIFEST).parquet(f"{root}/manifest/run={run}").collect()
    return [Folder(**r.asDict()) for r in rows]


def write_manifest(spark: SparkSession, root: str, run: int, folders: list[Folder]) -> None:
    rows = [tuple(asdict(f).values()) for f in folders]
    spark.createDataFrame(rows, MANIFEST).coalesce(1).write.mode("overwrite").parquet(f"{root}/manifest/run={run}")


def file_system(spark: SparkSession, root: str):
    """(file system, path class) of a warehouse's root."""
    paths = spark._jvm.org.apache.hadoop.fs.Path
    return paths(root).getFileSystem(spark._jsc.hadoopConfiguration()), paths


def folder_of(spark: SparkSession, root: str, name: str, run: int, figures: dict, buckets: int) -> Folder:
    """The manifest row of a folder just written; ``figures`` were observed while it was written."""
    fs, paths = file_system(spark, root)
    summary = fs.getContentSummary(paths(f"{root}/{name}/run={run}"))
    return Folder(
        name, run, figures["rows"] or 0, summary.getLength(), summary.getFileCount(), figures["first_day"], figures["last_day"], buckets)


def observed(df: DataFrame, day: str | None = None) -> tuple[DataFrame, Observation]:
    """The frame, and an observation of its rows and days that is filled when it is written."""
    seen = Observation()
    days = [F.lit(None).cast("int"), F.lit(None).cast("int")] if day is None else [F.min(day), F.max(day)]
    return df.observe(seen, F.count(F.lit(1)).alias("rows"), days[0].alias("first_day"), days[1].alias("last_day")), seen


def write_bucketed(df: DataFrame, path: str, buckets: int, sort: str, day: str | None = None, placed: bool = False) -> dict:
    """Write a frame in buckets of :data:`KEY`, a file a bucket, and return its figures.

    ``placed`` says that the frame is partitioned by the key into that many parts already.
    """
    laid_out, seen = observed(df if placed else df.repartition(buckets, KEY), day)
    name = f"crossmart_write_{uuid.uuid4().hex}"
    laid_out.write.mode("overwrite").format("parquet").bucketBy(buckets, KEY).sortBy(sort).option("path", path).saveAsTable(name)
    df.sparkSession.sql(f"DROP TABLE {name}")  # an external table: the files stay
    return seen.get


def registered(spark: SparkSession, root: str, name: str, schema: T.StructType, runs: list[int], buckets: int, sort: str) -> DataFrame:
    """Bucketed folders as one table of the session's catalogue, a partition a folder."""
    version = hashlib.md5(f"{root}|{runs}|{buckets}".encode()).hexdigest()
    known = f"crossmart_{name}_{version}"
    if not spark.catalog.tableExists(known):
        columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schema.fields)
        spark.sql(
            f"CREATE TABLE {known} ({columns}, run INT) USING parquet PARTITIONED BY (run) "
            f"CLUSTERED BY ({KEY}) SORTED BY ({sort}) INTO {buckets} BUCKETS LOCATION '{root}/{name}'")
        added = " ".join(f"PARTITION (run={run}) LOCATION '{root}/{name}/run={run}'" for run in runs)
        spark.sql(f"ALTER TABLE {known} ADD IF NOT EXISTS {added}")
    return spark.table(known).select(*schema.names)


def not_held(rows: DataFrame, held: DataFrame, buckets: int) -> DataFrame:
    """Rows whose grain is not among the bucketed ``held`` rows; leaves them partitioned by product.

    Only the new rows move. What is held is grouped and joined where it lies: a product has
    a grain for each of its markets and days in the batch's span.
    """
    grain = F.struct("geo_key", "date_key")
    grains = held.groupBy(KEY).agg(F.collect_set(grain).alias("_held"))
    met = rows.repartition(buckets, KEY).join(grains.hint("merge"), KEY, "left")
    new = F.coalesce(~F.array_contains("_held", grain), F.lit(True))
    return met.where(new).select(*rows.columns)


def tier(rows: int, fan: int) -> int:
    return int(math.log(max(rows, 1), fan) + 1e-9)


def due(folders: list[Folder], fan: int) -> list[Folder]:
    """The folders one compaction merges: the smallest tier that is full, and each next one that the result fills.

    Afterwards no tier up to the result's own has ``fan`` folders, so repeated compaction
    leaves fewer than ``fan`` folders a tier, and a row is rewritten once a tier.
    """
    left = sorted(folders, key=lambda f: (f.rows, f.run))
    tiers = sorted({tier(f.rows, fan) for f in left})
    for start in tiers:
        group = [f for f in left if tier(f.rows, fan) == start]
        if len(group) < fan:
            continue
        while True:
            size = tier(sum(f.rows for f in group), fan)
            more = [f for f in left if f not in group and tier(f.rows, fan) <= size]
            if len([f for f in more if tier(f.rows, fan) == size]) + 1 < fan:
                return group
            group += more
    return []
