"""Helpers shared by the text operators: words, hashes, staged tables, lookups on hot keys."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from crossmart.session import work_dir

#: Characters that separate words; everything else belongs to a word.
SPACES = r"[\x20\x09-\x0D]+"
SALTS = 64
NUMBERING_BUCKETS = 4096


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write a frame to the shared work folder and read it back: cuts lineage, survives lost executors."""
    path = f"{work_dir(df.sparkSession)}/llm-{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    back = df.sparkSession.read.schema(df.schema).parquet(path)
    back.staged_at = path
    return back


def drop_staged(df: DataFrame) -> None:
    """Remove a staged table that nothing reads any more."""
    spark = df.sparkSession
    path = spark._jvm.org.apache.hadoop.fs.Path(df.staged_at)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def words(text: Column) -> Column:
    """The words of a text in order; none for a null or blank text."""
    parts = F.split(F.coalesce(text, F.lit("")), SPACES, -1)
    return F.filter(parts, lambda w: w != "")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often ``body`` uses it inside lambdas."""
    return F.element_at(F.transform(F.array(value), body), 1)


def unit_hash(*parts: Column) -> Column:
    """A number in (0, 1) that depends on the parts alone (52 bits of an MD5; SQL engines agree on it)."""
    digest = F.md5(F.concat_ws(":", *[F.coalesce(p.cast("string"), F.lit("null")) for p in parts]))
    return (F.conv(F.substring(digest, 1, 13), 16, 10).cast("long") + F.lit(0.5)) / F.lit(float(2**52))


def salted_lookup(left: DataFrame, key: str, right: DataFrame, salt_from: list[str], how: str = "left", pinned: bool = False) -> DataFrame:
    """Join ``right`` (one row a key) to ``left`` although a key may hold a large part of ``left``.

    ``left`` is dealt by (key, salt); ``right`` is repeated only for the salts its key has there,
    so a cold key costs one row and a hot one ``SALTS`` rows. Null keys find nothing.
    ``pinned`` asks for a merge join, which cannot turn into a broadcast of a small ``left``
    with the rows of a key streaming through one task.
    """
    salted = left.withColumn("_salt", F.pmod(F.xxhash64(*salt_from), F.lit(SALTS)))
    present = salted.select(key, "_salt").where(F.col(key).isNotNull()).distinct()
    found = present.join(right, key)
    return salted.join(found.hint("merge") if pinned else found, [key, "_salt"], how).drop("_salt")


def numbered(df: DataFrame, group: list[str], bucket: Column, order: list[Column], name: str) -> DataFrame:
    """Gapless numbers from 0 in each group without sorting a group in one task.

    Rows are numbered inside (group, bucket), and each bucket starts after the rows of the
    buckets before it. ``bucket`` is below ``NUMBERING_BUCKETS`` and must be a function of the
    row, so the counts table has at most groups x buckets rows. Groups must not be null: rows
    then meet their bucket's start where the numbering left them.
    """
    dealt = df.withColumn("_bucket", bucket.cast("int"))
    keys = [*group, "_bucket"]
    counts = dealt.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(*(group or [F.lit(0)])).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(*keys, F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    inside = dealt.withColumn("_row", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    same = F.lit(True)
    for k in keys:
        same = same & (F.col(f"l.{k}") == F.col(f"r.{k}"))
    joined = inside.alias("l").join(starts.alias("r"), same)
    return joined.select(
        *[F.col(f"l.{c}") for c in df.columns],
        (F.col("r._start") + F.col("l._row") - 1).cast("long").alias(name),
    )
