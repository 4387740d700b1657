"""The scheduled daily rate load as a Structured Streaming file source.

Landed rate documents are picked up once each; every micro-batch is one incremental,
rates-only warehouse load. With ``availableNow`` the query handles what has arrived and
stops, which is what the scheduled job needs. Loading a batch twice after a failure adds
nothing, because the rate load skips quotes the fact already holds.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from crossmart import schemas
from crossmart.plans.warehouse import run_load
from crossmart.sources.files import distinct_quotes, flatten_rates


def arriving_rates(spark: SparkSession, folder: str, files_per_batch: int = 1000) -> DataFrame:
    """Quotes of arriving documents; the table letter is the name of the file's folder."""
    documents = (
        spark.readStream.schema(schemas.RATE_DOCUMENT)
        .option("multiLine", True).option("maxFilesPerTrigger", files_per_batch)
        .option("recursiveFileLookup", True).json(folder)
        .withColumn("_file", F.input_file_name())
    )
    letter = F.regexp_extract("_file", r"/([ABC])/[^/]*$", 1)
    return flatten_rates(documents, letter)


def load_arrivals(
    spark: SparkSession, folder: str, root: str, checkpoint: str, load_date: date | None = None
) -> StreamingQuery:
    """Load everything that has arrived into the warehouse under ``root``."""

    def load(batch: DataFrame, _: int) -> None:
        run_load(
            spark, root, None, distinct_quotes(batch), "incremental", load_date, rates_only=True
        )

    return (
        arriving_rates(spark, folder).writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )
