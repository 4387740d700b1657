"""Near-duplicates by SimHash: fingerprints, links up to two differing bits, components.

Search: a fingerprint is embedded as the bit counts of its 32 two-bit segments. Manhattan
distance between embeddings is a lower bound of the bit distance, because a bit changes one
count by one. At most two counts differ within distance two, so of six groups of segments
four at least agree: the 15 choices of four groups are grids over the embedding, and points
in range share a cell in one of them. Cells are joined on their key, candidates pass the
Manhattan bound, and the fingerprints themselves settle the link.

A cell may gather more fingerprints than ``CELL``, as one family of near copies does. Such
fingerprints are linked through the 65 values within one bit of each: two fingerprints are
at most two bits apart exactly if they share such a value, and no value has over 65 of them.
That costs 65 rows a fingerprint and never pairs a cell with itself.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from crossmart.llm.common import drop_staged, salted_lookup, stage
from crossmart.llm.components import components

DISTANCE = 2
SHINGLE = 3
SEED = 42
#: Cells up to this number of distinct fingerprints are joined with themselves.
CELL = 64
#: Bits of the six groups of two-bit segments.
GROUPS = ((0, 10), (10, 20), (20, 30), (30, 40), (40, 52), (52, 64))
BLOCK = 1 << 14


def fingerprint(text: str | None) -> int:
    """SimHash of a text: a bit is set if set in over half of the shingles' XXH64 hashes.

    A-Z become a-z, words are runs without ASCII white space, shingles are three words (the
    whole sequence if there are fewer). A text without words gets 0.
    """
    tokens = text.encode().lower().split() if text else []
    if not tokens:
        return 0
    line = b" ".join(tokens)
    ends = np.cumsum([len(t) + 1 for t in tokens]) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    k = min(SHINGLE, len(tokens))
    first, last = starts[: len(tokens) - k + 1].tolist(), ends[k - 1 :].tolist()
    digest, counts = xxhash.xxh64_digest, np.zeros(64, dtype=np.int64)
    for at in range(0, len(first), BLOCK):
        hashes = b"".join([digest(line[a:b], SEED) for a, b in zip(first[at : at + BLOCK], last[at : at + BLOCK], strict=True)])
        bits = np.unpackbits(np.frombuffer(hashes, dtype=np.uint8)).reshape(-1, 64)
        for part in range(0, len(bits), 255):  # sums of at most 255 bits fit one byte, which adds fastest
            counts += bits[part : part + 255].sum(axis=0, dtype=np.uint8)
    return int.from_bytes(np.packbits(counts * 2 > len(first)).tobytes(), "big")


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, fp) a row, fp as a signed long. Texts never leave the task that read them."""

    @F.pandas_udf("long")
    def simhash(batch: pd.Series) -> pd.Series:
        return pd.Series(np.array([fingerprint(t) for t in batch], dtype=np.uint64).view(np.int64), dtype="int64")

    return docs.select(F.col(key).alias("doc_id"), simhash(F.col(text)).alias("fp"))


def signed(value: int) -> int:
    return value - (1 << 64) if value >= 1 << 63 else value


def embedding(fp: Column) -> Column:
    """Bit counts of the 32 two-bit segments, each written as 00, 01 or 11.

    In this code the Manhattan distance of two embeddings is the number of differing bits.
    """
    low = F.lit(signed(0x5555555555555555))
    upper = F.shiftrightunsigned(fp, 1)
    return fp.bitwiseOR(upper).bitwiseAND(low).bitwiseOR(F.shiftleft(fp.bitwiseAND(upper).bitwiseAND(low), 1))


def differing(a: Column, b: Column) -> Column:
    return F.bit_count(a.bitwiseXOR(b))


def cells(fp: Column) -> Column:
    """Keys of the 15 grid cells a fingerprint lies in."""
    point, keys = embedding(fp), []
    for i, chosen in enumerate(combinations(GROUPS, len(GROUPS) - DISTANCE)):
        mask = sum((1 << hi) - (1 << lo) for lo, hi in chosen)
        keys.append(F.xxhash64(F.lit(i), point.bitwiseAND(F.lit(signed(mask)))))
    return F.array(*keys)


def links(nodes: DataFrame, cell: int = CELL) -> DataFrame:
    """Edges (a, b) whose components are those of all pairs of fingerprints in range.

    ``nodes`` has distinct ``fp``. Pairs in small cells are all emitted (each fingerprint has
    at most 2,080 in range); in crowded cells everyone around a value is tied to its smallest.
    """
    keyed = nodes.select("fp", F.explode(cells(F.col("fp"))).alias("cell"))
    crowd = stage(
        keyed.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), F.min("fp").alias("lo"), F.max("fp").alias("hi")).where("n > 1"),
        "cells",
    )
    in_range = (differing(embedding(F.col("a")), embedding(F.col("b"))) <= DISTANCE) & (
        differing(F.col("a"), F.col("b")) <= DISTANCE)
    pairs = crowd.where("n = 2").select(F.col("lo").alias("a"), F.col("hi").alias("b")).where(in_range)
    members = stage(keyed.join(crowd.where("n > 2").select("cell", "n"), "cell"), "members")
    small = members.where(F.col("n") <= cell)
    left, right = small.select("cell", F.col("fp").alias("a")), small.select("cell", F.col("fp").alias("b"))
    met = left.join(right, (left["cell"] == right["cell"]) & (F.col("a") < F.col("b")) & in_range).select("a", "b")
    flips = [F.col("fp"), *[F.col("fp").bitwiseXOR(F.lit(signed(1 << i))) for i in range(64)]]
    near = members.where(F.col("n") > cell).select("fp").distinct().select("fp", F.explode(F.array(*flips)).alias("value"))
    around = near.groupBy("value").agg(F.collect_set("fp").alias("fps")).where(F.size("fps") > 1)
    tied = around.select(F.array_min("fps").alias("a"), F.explode("fps").alias("b")).where("a <> b")
    out = stage(pairs.unionByName(met).unionByName(tied).distinct(), "links")
    drop_staged(members)
    drop_staged(crowd)
    return out


def with_components(prints: DataFrame, cell: int = CELL) -> DataFrame:
    """(doc_id, fp, component_id) for a written table of (doc_id, fp).

    Equal fingerprints are one node, found by an aggregate that combines before the shuffle,
    so a group of copies costs one row a task. component_id is the smallest id reachable.
    Rows with a null id take part; only an all-null component has a null component_id.
    """
    nodes = stage(prints.groupBy("fp").agg(F.min("doc_id").alias("id")), "nodes")
    edges = links(nodes, cell)
    roots = components(edges)
    linked = nodes.join(roots.select(F.col("node").alias("fp"), "root"), "fp")
    smallest = linked.groupBy("root").agg(F.min("id").alias("component_id"))
    found = salted_lookup(linked, "root", smallest, ["fp"], "inner").select("fp", "component_id")
    all_nodes = nodes.join(found, "fp", "left").select("fp", F.coalesce("component_id", "id").alias("component_id"))
    return salted_lookup(prints, "fp", all_nodes, ["doc_id"], "inner").select("doc_id", "fp", "component_id")


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", cell: int = CELL) -> DataFrame:
    """A row per document: doc_id, fingerprint (16 hex digits), component_id.

    Null and blank texts share fingerprint zero and hence one component. Repeated rows give
    repeated rows. An empty table gives no rows. Other columns are not read.
    """
    prints = stage(fingerprints(docs, key, text), "prints")
    found = with_components(prints, cell)
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def deduplicated(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One document of each component stays: the one with the smallest id; all columns are kept.

    Of repeated ids one row stays. Rows with a null id have no identity to keep them apart
    and stay as they are.
    """
    keep = near_duplicates(docs, key, text).where("doc_id = component_id").select(F.col("doc_id").alias("_keep")).distinct()
    rows = docs.join(keep, F.col(key) == F.col("_keep")).drop("_keep")
    first = rows.withColumn("_first", F.row_number().over(Window.partitionBy(key).orderBy(text)))
    return first.where("_first = 1").drop("_first").unionByName(docs.where(F.col(key).isNull()))
