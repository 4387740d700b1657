"""Mixing sources to target weights by Poisson replication.

Each source gets a repetition rate that brings its share of the size to its target weight.
A document is repeated a Poisson number of times with that mean, drawn by inverting the
distribution at a number hashed from its id and text, so a rerun or a lost task draws the same
and documents without an id, or with one and the same, are drawn each for itself.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crossmart.llm.common import NUMBERING_BUCKETS, let, numbered, salted_lookup, unit_hash

SEED = "mix"
#: A larger mean is drawn as a sum of equal parts, so exp(-mean) never underflows.
LARGEST_PART = 64.0
#: Sources are broadcast up to this number of rows (three numbers and a name each).
BROADCAST_SOURCES = 20_000


def rates(df: DataFrame, source: str, size: Column, weights: dict[str, float] | None = None) -> DataFrame:
    """Repetition rate of every source: (name, rate). A null source is a source of its own.

    Without weights all sources weigh the same; sources that weights leave out get nothing.
    """
    per_source = df.groupBy(F.col(source).alias("_source")).agg(F.sum(size).cast("double").alias("_size"))
    weight = F.lit(1.0)
    if weights is not None:
        weight = F.lit(0.0)
        for name, value in weights.items():
            weight = F.when(F.col("_source").eqNullSafe(F.lit(name)), F.lit(float(value))).otherwise(weight)
    weighed = per_source.withColumn("_weight", weight)
    whole = weighed.agg(F.sum("_size").alias("_all"), F.sum("_weight").alias("_weights"))
    return weighed.join(F.broadcast(whole)).select(  # one row
        "_source", F.coalesce(F.col("_weight") / F.col("_weights") * F.col("_all") / F.col("_size"), F.lit(0.0)).alias("_rate")
    )


def poisson(u: Column, mean: Column) -> Column:
    """The Poisson quantile of u: how many cumulated probabilities are at most u."""
    steps = F.ceil(mean + 12 * F.sqrt(mean) + 30).cast("int")
    p0 = F.exp(-mean)
    start = F.struct(p0.alias("p"), p0.alias("c"), F.lit(0).alias("n"))

    def step(acc, k):
        p = acc["p"] * mean / k
        return F.struct(p.alias("p"), (acc["c"] + p).alias("c"), (acc["n"] + F.when(u >= acc["c"], 1).otherwise(0)).alias("n"))

    return F.aggregate(F.sequence(F.lit(1), steps), start, step, lambda acc: acc["n"])


def repetitions(rate: Column, *key: Column, seed: str = SEED) -> Column:
    """How often a document enters the mixture; 0 for a rate of 0."""
    parts = F.greatest(F.lit(1), F.ceil(rate / LARGEST_PART)).cast("int")
    mean = rate / parts
    draws = F.transform(F.sequence(F.lit(1), parts), lambda i: let(unit_hash(F.lit(seed), i, *key), lambda u: poisson(u, mean)))
    return F.aggregate(draws, F.lit(0), lambda a, n: a + n)


def mixed(
    df: DataFrame, key: str = "doc_id", source: str = "source", text: str = "text",
    weights: dict[str, float] | None = None, seed: str = SEED,
) -> DataFrame:
    """The mixture in a global random order: all columns, then copy, n_copies, rate and position.

    Size is UTF-8 bytes plus 1 (null text: 1), so empty documents still count. Rows of one id and text
    are drawn alike. An empty table gives an empty mixture. Columns of the input that have
    the name of an added one are replaced.
    """
    added = ["copy", "n_copies", "rate", "position"]
    own = [c for c in df.columns if c not in added]
    size = (F.octet_length(F.coalesce(F.col(text), F.lit(""))) + 1).cast("long")
    per_source = rates(df.select(source, text), source, size, weights)
    keyed = df.select(*own, F.col(source).alias("_source")).withColumn("_known", F.col("_source").isNull())
    named = per_source.withColumn("_known", F.col("_source").isNull()).select(
        F.coalesce("_source", F.lit("")).alias("_source"), "_known", "_rate")
    keyed = keyed.withColumn("_source", F.struct(F.coalesce("_source", F.lit("")).alias("name"), F.col("_known").alias("none"))).drop("_known")
    named = named.select(F.struct(F.col("_source").alias("name"), F.col("_known").alias("none")).alias("_source"), "_rate")
    if named.limit(BROADCAST_SOURCES + 1).count() <= BROADCAST_SOURCES:
        rated = keyed.join(F.broadcast(named), "_source")
    else:
        rated = salted_lookup(keyed, "_source", named, [key], "inner")
    digest = F.md5(F.encode(F.coalesce(F.col(text), F.lit("")), "UTF-8"))  # once a document, not once a step of its draw
    drawn = rated.withColumn("n_copies", let(digest, lambda d: repetitions(F.col("_rate"), F.col(key), d, seed=seed))).where("n_copies > 0")
    copies = drawn.select(
        *own, F.explode(F.sequence(F.lit(0), F.col("n_copies") - 1)).alias("copy"), "n_copies", F.col("_rate").alias("rate"),
        digest.alias("_digest"),
    )
    keyed = copies.withColumn("_order", F.md5(F.concat_ws(
        ":", F.lit(seed + "-order"), F.coalesce(F.col(key).cast("string"), F.lit("null")), "_digest", F.col("copy").cast("string")))).drop("_digest")
    bucket = F.conv(F.substring("_order", 1, 3), 16, 10).cast("int")
    assert NUMBERING_BUCKETS == 16**3
    return numbered(keyed, [], bucket, [F.col("_order"), F.col(text)], "position").drop("_order")
