"""CSV with quoted line breaks, read by many tasks a file.

A reader that follows quotes from the first byte to the last needs one task a file. Here the
file is cut into blocks as any text file is, and quotes are only counted:

1. every line counts its quotes, and every block adds them up;
2. the sums of whole blocks are added up over a file, which is a table of one row a block,
   and say whether a block starts inside a quoted field;
3. a block that starts outside of one and has no line with an odd number of quotes holds whole
   records only, which stay where they are;
4. the lines of other blocks move once, by their block, and become records there; only lines
   that end a record of an earlier block move to that one;
5. records become columns with ``from_csv``.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from crossmart.session import work_dir

#: Different header lines that one call reads; each is a branch of the plan.
MOST_HEADERS = 16
OPTIONS = {"quote": '"', "escape": '"', "nullValue": "", "emptyValue": "", "multiLine": "true", "mode": "PERMISSIVE"}


def splittable(spark: SparkSession, path: str) -> bool:
    """Whether some file is larger than what one task reads."""
    block = int(spark._jsparkSession.sessionState().conf().filesMaxPartitionBytes())
    largest = spark.read.format("binaryFile").load(path).agg(F.max("length")).first()[0]  # the contents are not read
    return (largest or 0) > block


def text_lines(spark: SparkSession, path: str) -> DataFrame:
    """(file, block, at, line): lines in the order of ``at`` inside a block, quotes not looked at.

    Lines end at a line feed only, so a carriage return inside a quoted field survives.
    """
    text = spark.read.option("lineSep", "\n").text(path)
    return text.select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("at"), F.col("value").alias("line"),
    )


def counted_lines(lines: DataFrame) -> DataFrame:
    """Adds ``quotes`` of the line and whether it is ``blank``."""
    return lines.withColumns({
        "quotes": (F.length("line") - F.length(F.replace("line", F.lit('"'), F.lit("")))).cast("long"),
        "blank": F.col("line").isin("", "\r"),
    })


def block_states(lines: DataFrame) -> DataFrame:
    """One row a block: how it starts and what its lines need.

    ``start`` is its first line and stands for the block, ``first_odd`` its first line with an odd
    number of quotes, ``opening`` whether it starts inside a quoted field, ``carried`` the last
    earlier block in which a record begins, ``mixed`` whether a line of it may be a part of a
    record. ``file_start`` stands for the file, ``head`` is the file's first line that is not blank.
    """
    blocks = lines.groupBy("file", "block").agg(
        F.sum("quotes").alias("quotes"), F.min("at").alias("start"), F.max("at").alias("last"),
        F.min(F.when(F.col("quotes") % 2 == 1, F.col("at"))).alias("first_odd"),
        F.min(F.when(~F.col("blank"), F.col("at"))).alias("first_text"))
    ordered = Window.partitionBy("file").orderBy("block")
    earlier, whole = ordered.rowsBetween(Window.unboundedPreceding, -1), ordered.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    opened = blocks.withColumn("opening", F.coalesce(F.sum("quotes").over(earlier), F.lit(0)) % 2)
    begins = (F.col("opening") == 0) | (F.col("first_odd") < F.col("last"))
    return opened.select(
        "file", "block", "start", "first_odd", "opening",
        F.last(F.when(begins, F.col("start")), ignorenulls=True).over(earlier).alias("carried"),
        ((F.col("opening") == 1) | F.col("first_odd").isNotNull()).alias("mixed"),
        F.min("start").over(whole).alias("file_start"), F.first("first_text", ignorenulls=True).over(whole).alias("head"))


def stitched(lines: DataFrame) -> DataFrame:
    """(file_start, is_head, line) of the records that begin in mixed blocks.

    A block that starts inside a field closes it at its first line with an odd number of quotes;
    the lines up to there go to the block in which that record begins. The others begin outside
    of a field, so the quotes before a line say whether it begins a record.
    """
    carried = (F.col("opening") == 1) & (F.col("first_odd").isNull() | (F.col("at") <= F.col("first_odd")))
    joined = lambda rows: F.array_join(F.transform(F.array_sort(rows), lambda r: r["line"]), "\n")
    ends = lines.where(carried).groupBy(F.col("carried").alias("_to")).agg(
        joined(F.collect_list(F.struct("block", "at", "line"))).alias("end"))
    own = lines.where(~carried).select("start", "at", "line", "quotes", "file_start", "is_head")
    inside = Window.partitionBy("start").orderBy("at")
    before = F.coalesce(F.sum("quotes").over(inside.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    begun = own.withColumn("before", before).withColumn(
        "first", F.last(F.when(F.col("before") % 2 == 0, F.col("at")), ignorenulls=True).over(inside.rowsBetween(Window.unboundedPreceding, 0)))
    found = begun.groupBy("start", "first").agg(
        joined(F.collect_list(F.struct("at", "line"))).alias("line"), F.sum("quotes").alias("quotes"),
        F.max("file_start").alias("file_start"), F.max("is_head").alias("is_head"))
    # only the last record of a block is open; it ends in later blocks, or with its file
    whole = found.join(ends.hint("shuffle_hash"), (F.col("start") == F.col("_to")) & (F.col("quotes") % 2 == 1), "left")
    text = F.when(F.col("end").isNull(), F.col("line")).otherwise(F.concat("line", F.lit("\n"), "end"))
    return whole.select("file_start", "is_head", text.alias("line"))


def records(spark: SparkSession, path: str, scratch: str) -> tuple[DataFrame, DataFrame]:
    """(header, record) of all records but headers, and (file_start, header, returns) of every file.

    Counted lines are written to ``scratch`` once, because several passes use them and must see
    the same blocks. A record of several lines is put together in one task; a quote that is never
    closed makes one record of the rest of its file, as it does for a reader that follows quotes.
    """
    counted_lines(text_lines(spark, path)).write.mode("overwrite").parquet(f"{scratch}/lines")
    lines = spark.read.parquet(f"{scratch}/lines")
    block_states(lines).write.mode("overwrite").parquet(f"{scratch}/blocks")
    blocks = F.broadcast(spark.read.parquet(f"{scratch}/blocks"))  # a row a block
    known = lines.join(blocks, ["file", "block"]).withColumn("is_head", F.coalesce(F.col("at") == F.col("head"), F.lit(False)))
    mixed = stitched(known.where("mixed"))
    filled = known.where("NOT mixed").select("file_start", "is_head", "line").unionByName(mixed).where(~F.col("line").isin("", "\r"))
    heads = known.where("is_head")
    broken = heads.where("quotes % 2 = 1").limit(1).count()  # a header over several lines is a record like any other
    first = (filled if broken else heads).where("is_head")
    returns = F.endswith("line", F.lit("\r"))  # a file that ends its lines in CR LF has them all read as line feeds
    first.select(
        "file_start", returns.alias("returns"), F.regexp_replace("line", "^\ufeff|\r$", "").alias("header")
    ).write.mode("overwrite").parquet(f"{scratch}/headers")
    headers = spark.read.parquet(f"{scratch}/headers")
    body = filled.where("NOT is_head").join(F.broadcast(headers), "file_start")  # a row a file
    plain = F.replace(F.regexp_replace("line", "\r$", ""), F.lit("\r\n"), F.lit("\n"))
    record = F.when(F.col("returns"), plain).otherwise(F.col("line"))
    return body.select("header", record.alias("record")), headers


def read_split_csv(spark: SparkSession, path: str, columns: list[str], scratch: str | None = None) -> DataFrame:
    """All-text CSV with a header a file, in many tasks although quoted fields hold line breaks.

    Gives the same rows as :func:`crossmart.sources.files.read_text_csv` for files whose
    quotes are balanced (RFC 4180). Files may differ in their header, up to ``MOST_HEADERS``
    different ones; a missing column is an error. Lines count as in the file: ``\\n`` or
    ``\\r\\n`` ends a record outside quotes. Empty files and files of a header only give no rows.
    """
    scratch = scratch or f"{work_dir(spark)}/csv-{uuid.uuid4().hex}"
    body, headers = records(spark, path, scratch)
    kinds = [r[0] for r in headers.select("header").distinct().limit(MOST_HEADERS + 1).collect()]
    if len(kinds) > MOST_HEADERS:
        raise ValueError(f"the files of {path} have more than {MOST_HEADERS} different headers")
    out = None
    for header in sorted(kinds):
        names = header_names(spark, header)
        missing = [c for c in columns if c not in names]
        if missing:
            raise ValueError(f"no column {missing} in the header {header!r}")
        parsed = body.where(F.col("header") == header).select(F.from_csv("record", ddl(len(names)), OPTIONS).alias("r"))
        rows = parsed.select(*[F.col(f"r.c{names.index(c)}").alias(c) for c in columns])
        out = rows if out is None else out.unionByName(rows)
    if out is None:
        return spark.createDataFrame([], T.StructType([T.StructField(c, T.StringType()) for c in columns]))
    return out


def ddl(n: int) -> str:
    return ", ".join(f"c{i} string" for i in range(n))


def header_names(spark: SparkSession, header: str) -> list[str | None]:
    """The fields of one header line, quoted ones included; no more than its commas allow."""
    n = header.count(",") + 1
    return list(spark.range(1).select(F.from_csv(F.lit(header), ddl(n), OPTIONS).alias("h")).select("h.*").first())
