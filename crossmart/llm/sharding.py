"""Sharding by rendezvous hashing: every key scores every shard, the best weighted score wins.

A new shard takes only the keys it wins; no key moves between old shards, and a changed
weight moves keys only to or from the shard concerned.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crossmart.llm.common import NUMBERING_BUCKETS, numbered, unit_hash

SEED = "shard"


def rendezvous(key: Column, weights: list[float], seed: str = SEED) -> Column:
    """The shard of a key: the smallest ``-ln(u) / weight`` over the shards, ties to the lower number.

    ``u`` is a hash of (seed, shard, key), so a shard of weight w gets a share of w over the
    sum of weights. A null key is a key like any other. Weights must be positive.
    """
    if not weights or min(weights) <= 0:
        raise ValueError("weights must be positive")
    scores = [
        F.struct((-F.ln(unit_hash(F.lit(seed), F.lit(i), key)) / F.lit(float(w))).alias("score"), F.lit(i).alias("shard"))
        for i, w in enumerate(weights)
    ]
    return F.array_min(F.array(*scores))["shard"] if len(scores) > 1 else scores[0]["shard"]


def with_shards(df: DataFrame, key: str, weights: list[float], shard: str = "shard", seed: str = SEED) -> DataFrame:
    """Every row with its shard; other columns stay. Rows with one key share a shard."""
    return df.withColumn(shard, rendezvous(F.col(key), weights, seed))


def with_slots(df: DataFrame, key: str, shard: str = "shard", slot: str = "slot", scattered: bool = False) -> DataFrame:
    """Gapless places from 0 inside each shard, ordered by a hash bucket and then the key.

    Repeated keys get different places, in the order of their remaining columns. A key that
    fills many rows is spread over buckets by those columns. A column named like ``slot`` is
    replaced. ``scattered`` gives places by a hash of where a row stands in the table, which
    must be a stored one: copies of a row are then neighbours by chance only and share no bucket.
    """
    df = df.drop(slot)
    if scattered:
        placed = df.withColumn("_place", F.xxhash64(F.monotonically_increasing_id()))
        return numbered(placed, [shard], F.pmod("_place", F.lit(NUMBERING_BUCKETS)), [F.col("_place")], slot).drop("_place")
    rest = [c for c in df.columns if c not in (key, shard)]
    bucket = F.pmod(F.xxhash64(key, *rest), F.lit(NUMBERING_BUCKETS))
    order = [F.col(key), *[F.col(c) for c in rest if not df.schema[c].dataType.typeName().startswith("map")]]
    return numbered(df, [shard], bucket, order, slot)


def sharded(df: DataFrame, key: str = "doc_id", text: str = "text", shards: int = 8) -> DataFrame:
    """The shard sheet of a table: size, checksum, shard, place and the shard with one shard more.

    A null text has size 1 and checksum 0, as an empty one. An empty table gives no rows.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    base = df.select(
        F.col(key).alias("doc_id"),
        (F.octet_length(body) + 1).cast("long").alias("size"),
        F.crc32(F.encode(body, "UTF-8")).alias("text_crc32"),
    )
    placed = with_shards(base, "doc_id", [1.0] * shards)
    placed = with_shards(placed, "doc_id", [1.0] * (shards + 1), "grown_shard")
    out = with_slots(placed, "doc_id")
    return out.select(
        "doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard"
    )
