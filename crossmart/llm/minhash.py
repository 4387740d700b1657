"""Near-duplicates by circulant MinHash: signatures, bands, exact Jaccard checks, components.

A document is the set of its three-word shingles. Two permutations give the whole signature:
the first scatters a shingle over 32-bit positions, the second orders positions; coordinate k
is the least value of the second one, shifted by k positions along the circle, over the set.
``ROWS`` coordinates form a band; documents that share a band are candidates if ``AGREE`` of
their coordinates, kept as a byte each, agree. At a similarity of 0.85 all bands miss with a
probability of 1.2e-5 and the bytes with one below 1e-7. A link counts only after the shingles
themselves, not their hashes, were compared.

Equal word sequences are one node. A family of near copies never becomes all of its pairs.
First every node meets the smallest pivot of its buckets. The nodes of buckets that this leaves
in several components are dealt into cells, one for each of their rarest shingles: in any common
order two similar sets meet in a shingle that leaves both enough to reach the similarity, and a
set with more shingles of its own than the similarity allows meets nobody. Cells are settled in
rounds, by one pivot, then about 16, then 256 and so on, until all members of a cell were pivots
or share a component. Pairs inside a component are never looked at, and none between components
that could be similar is skipped.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from crossmart.llm.common import drop_staged, salted_lookup, stage
from crossmart.llm.components import components

SHINGLE = 3
LEAST_PERCENT = 85
BANDS, ROWS = 24, 6
#: Pivots of a cell grow by this factor a round.
PIVOT_GROWTH = 16
#: Shingles of a text whose coordinates are computed at once.
BLOCK = 2048
#: Texts whose rows are built and handed back at once.
SLICE = 512
#: Coordinates of a pair that agree at least, of BANDS * ROWS; 5.3 deviations below what 0.85 gives.
AGREE = 100
KNOWN_WORDS = 1 << 19
#: Row numbers that are broadcast to fetch candidates' texts; more of them are joined by a shuffle.
BROADCAST_ROWS = 500_000
ODD = tuple(np.uint64(x | 1) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9))


class WordHashes(dict):
    """XXH64 of words as bytes, remembered up to a fixed number of words."""

    def __missing__(self, word: bytes) -> bytes:
        if len(self) >= KNOWN_WORDS:
            self.clear()
        self[word] = found = xxhash.xxh64_digest(word)
        return found


def words_of(text: bytes | None) -> list[bytes]:
    """Words of a text in UTF-8: A-Z lower-cased, cut at ASCII white space."""
    return text.lower().split() if text else []  # on bytes both know ASCII only


def shingles(words: list[bytes]) -> set:
    """Distinct shingles; the whole sequence if there are fewer words, nothing if there are none."""
    if len(words) < SHINGLE:
        return {tuple(words)} if words else set()
    return set(zip(words, words[1:], words[2:], strict=False))


def numbers(words: list[bytes], hashes: WordHashes) -> np.ndarray:
    """A 64-bit number for every shingle, repeats included."""
    codes = np.frombuffer(b"".join([hashes[w] for w in words]), dtype="<u8")
    if len(words) < SHINGLE:
        codes = np.concatenate([codes, np.zeros(SHINGLE - len(words), dtype=np.uint64)])
    mixed = codes[:-2] * ODD[0] + codes[1:-1] * ODD[1] + codes[2:] * ODD[2]
    mixed ^= mixed >> np.uint64(31)
    mixed *= ODD[0]
    return mixed


def scattered(words: list[bytes], hashes: WordHashes) -> np.ndarray:
    """First permutation: the 32-bit position of every shingle."""
    return (numbers(words, hashes) >> np.uint64(32)).astype(np.uint32)


def ordered(x: np.ndarray) -> np.ndarray:
    """Second permutation, a bijection of 32-bit numbers; works in place."""
    x ^= x >> np.uint32(16)
    x *= np.uint32(0x7FEB352D)
    x ^= x >> np.uint32(15)
    x *= np.uint32(0x846CA68B)
    x ^= x >> np.uint32(16)
    return x


def signature(positions: np.ndarray, size: int = BANDS * ROWS) -> np.ndarray:
    """All coordinates: the second permutation after circular shifts by 0, 1, 2, ... positions."""
    shifts = np.arange(size, dtype=np.uint32)[:, None]
    least = np.full(size, 0xFFFFFFFF, dtype=np.uint32)
    for at in range(0, len(positions), BLOCK):
        np.minimum(least, ordered(positions[None, at : at + BLOCK] - shifts).min(axis=1), out=least)
    return least


def band_keys(coordinates: np.ndarray) -> list[int]:
    """One signed 64-bit key a band, of its number and its coordinates."""
    whole = coordinates.astype("<u4").tobytes()
    width = 4 * ROWS
    keys = [xxhash.xxh64_intdigest(whole[i * width : (i + 1) * width], i) for i in range(BANDS)]
    return np.array(keys, dtype=np.uint64).view(np.int64).tolist()


def signed_rows(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, node, n_shingles, bands, bytes, line) a row: line has the words, node is a digest of it."""
    chosen = docs.select(F.col(key).alias("id"), F.col(text).alias("text"))

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, seen = WordHashes(), {}
        for batch in (whole.slice(at, SLICE) for whole in batches for at in range(0, len(whole), SLICE)):
            nodes, counts, bands, short, lines = [], [], [], [], []
            for value in batch.column("text").cast(pa.binary()):
                words = words_of(value.as_py())
                line = b" ".join(words)
                node = blake2b(line, digest_size=16).digest()
                if node not in seen:
                    if len(seen) >= 4096:
                        seen.clear()
                    all_of = signature(scattered(words, hashes)) if words else np.zeros(0, dtype=np.uint32)
                    seen[node] = len(shingles(words)), band_keys(all_of) if words else [], all_of.astype(np.uint8).tobytes()
                n, found, low = seen[node]
                nodes.append(node)
                counts.append(n)
                bands.append(found)
                short.append(low)
                lines.append(line)
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(nodes, pa.binary()), pa.array(counts, pa.int64()),
                 pa.array(bands, pa.list_(pa.int64())), pa.array(short, pa.binary()), pa.array(lines, pa.binary())],
                names=["id", "node", "n_shingles", "bands", "bytes", "line"])

    schema = T.StructType([
        T.StructField("id", chosen.schema["id"].dataType), T.StructField("node", T.BinaryType()),
        T.StructField("n_shingles", T.LongType()), T.StructField("bands", T.ArrayType(T.LongType())),
        T.StructField("bytes", T.BinaryType()), T.StructField("line", T.BinaryType())])
    return chosen.mapInArrow(sign, schema)


@F.arrow_udf(T.BooleanType())
def agreeing(a: pa.Array, b: pa.Array) -> pa.Array:
    """Whether enough coordinates of two signatures, a byte each, are equal."""
    x, y = (np.frombuffer(b"".join(s.to_pylist()), dtype=np.uint8).reshape(len(s), -1) for s in (a, b))
    return pa.array((x == y).sum(axis=1) >= AGREE)


@F.arrow_udf(T.BooleanType())
def similar(a: pa.Array, b: pa.Array) -> pa.Array:
    """Whether the shingle sets of two lines reach the similarity, compared word by word."""
    last, left, out = None, set(), []
    for x, y in ((x.as_py(), y.as_py()) for x, y in zip(a, b, strict=True)):
        if x != last:
            last, left = x, shingles(x.split())
        right = shingles(y.split())
        both = len(left & right)
        out.append(100 * both >= LEAST_PERCENT * (len(left) + len(right) - both))
    return pa.array(out, pa.bool_())


@F.arrow_udf(T.ArrayType(T.LongType()))
def shingle_numbers(lines: pa.Array) -> pa.Array:
    """The number of every distinct shingle; shingles that share a number are listed one by one."""
    hashes, out = WordHashes(), []
    for line in lines:
        words = line.as_py().split()
        places = {x: i for i, x in enumerate(zip(words, words[1:], words[2:], strict=False))}.values() if len(words) >= SHINGLE else [0]
        out.append(numbers(words, hashes)[list(places)].view(np.int64))
    return pa.array(out, pa.list_(pa.int64()))


def lines_of(who: DataFrame, rows: DataFrame) -> DataFrame:
    """The lines of some row numbers."""
    if who.count() <= BROADCAST_ROWS:  # eight bytes each
        who = F.broadcast(who)
    return rows.join(who, "row")


def confirmed(pairs: DataFrame, nodes: DataFrame, rows: DataFrame) -> DataFrame:
    """(a, b) of the pairs (node, row, p, p_row) whose sets are similar, written.

    Signatures settle most pairs before any text moves. A pivot may have very many partners,
    so it is looked up with salts; a node has at most as many pairs as its buckets have pivots.
    """
    ours = nodes.select("row", F.col("bytes").alias("a"))
    theirs = nodes.select(F.col("row").alias("p_row"), F.col("bytes").alias("b"))
    known = salted_lookup(pairs.join(ours, "row"), "p_row", theirs, ["node"], "inner", pinned=True)
    asked = stage(known.where(agreeing("a", "b")).select("node", "row", "p", "p_row"), "asked")
    lines = stage(lines_of(asked.select("row").union(asked.select("p_row")).distinct(), rows), "lines")
    mine = asked.join(lines, "row").select("node", "p", "p_row", F.col("line").alias("a_line"))
    their_lines = lines.select(F.col("row").alias("p_row"), F.col("line").alias("b_line"))
    both = salted_lookup(mine, "p_row", their_lines, ["node"], "inner", pinned=True)
    out = stage(both.where(similar("b_line", "a_line")).select(F.col("node").alias("a"), F.col("p").alias("b")), "similar")
    drop_staged(asked)
    drop_staged(lines)
    return out


class Links:
    """Links found so far and the components they make."""

    def __init__(self, nodes: DataFrame, rows: DataFrame):
        self.nodes, self.rows, self.found, self.roots = nodes, rows, None, None

    def check(self, pairs: DataFrame) -> None:
        """Take in the links among (node, row, p, p_row)."""
        pairs = stage(pairs.select("node", "row", "p", "p_row"), "pairs")
        new = confirmed(pairs, self.nodes, self.rows)
        drop_staged(pairs)
        if new.limit(1).count():
            self.found = new if self.found is None else self.found.unionByName(new)
            self.roots = components(self.found)

    def named(self, df: DataFrame) -> DataFrame:
        """Adds the component of a node, which is the node itself as long as it has no link."""
        if self.roots is None:
            return df.withColumn("root", F.col("node"))
        return df.join(self.roots, "node", "left").withColumn("root", F.coalesce("root", "node"))


def cells(crowd: DataFrame, rows: DataFrame) -> DataFrame:
    """(cell, node, row, n_shingles, left) for the rarest shingles of every node (row, node, n_shingles) of a crowd.

    A node's shingles are ordered by the number of nodes that hold them, shared ones after its
    own, and ``left`` counts a shingle and those after it. The first shingle that two nodes have
    in common leaves both at least the shingles they have in common, so those after the first
    15 % need no cell, and a pair is similar only if ``left`` suffices on both sides.
    """
    lines = lines_of(crowd.select("row"), rows)
    held = F.count(F.lit(1)).over(Window.partitionBy("cell"))
    shared = lines.select("row", F.explode(shingle_numbers("line")).alias("cell")).withColumn("held", held).where("held > 1")
    own = shared.groupBy("row").agg(F.array_sort(F.collect_list(F.struct("held", "cell"))).alias("s"))  # of one text
    most = F.floor((100 - LEAST_PERCENT) * F.col("n_shingles") / 100) + 1 - F.col("n_shingles") + F.size("s")
    first = own.join(crowd, "row").withColumn("size", F.size("s")).withColumn(
        "s", F.slice("s", F.lit(1), F.greatest(most, F.lit(0)).cast("int")))
    return first.select("node", "row", "n_shingles", "size", F.posexplode("s").alias("at", "s")).select(
        F.col("s.cell").alias("cell"), "node", "row", "n_shingles", (F.col("size") - F.col("at")).alias("left"))


def linked(nodes: DataFrame, rows: DataFrame) -> DataFrame | None:
    """(node, root) of all nodes that have a link, or None if there is none."""
    keyed = nodes.select("node", "row", "n_shingles", F.explode("bands").alias("bucket"))
    pivot = F.min(F.struct(F.col("node").alias("p"), F.col("row").alias("p_row"), F.col("n_shingles").alias("p_n")))
    crowds = keyed.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"), pivot.alias("pivot")).where("n > 1")
    met = salted_lookup(keyed, "bucket", crowds, ["node"], "inner", pinned=True)
    members = stage(met.select("bucket", "node", "row", "n_shingles", "pivot.*"), "members")
    fits = 100 * F.least("n_shingles", "p_n") >= LEAST_PERCENT * F.greatest("n_shingles", "p_n")
    links, others = Links(nodes, rows), members.where(fits & (F.col("node") != F.col("p")))
    links.check(others.groupBy("node", "row").agg(F.min(F.struct("p", "p_row")).alias("s")).select("node", "row", "s.*"))

    at = stage(links.named(members), "rooted")
    mixed = at.groupBy("bucket").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).where("lo <> hi").select("bucket")
    crowd = stage(salted_lookup(at, "bucket", mixed, ["node"], "inner", pinned=True).select("row", "node", "n_shingles").distinct(), "crowd")
    drop_staged(members)
    drop_staged(at)
    dealt = stage(cells(crowd, rows), "cells")
    pivot = F.min(F.struct((F.col("n_shingles") - F.col("left")).alias("before"), F.col("node").alias("p")))
    crowds = dealt.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), pivot.alias("pivot")).where("n > 1")
    share = (F.pmod(F.xxhash64("node", "cell"), F.lit(1 << 40)) + 1) / F.lit(float(1 << 40)) * F.col("n")
    rank = F.when(F.col("node") == F.col("pivot.p"), F.lit(0.0)).otherwise(share)
    ranked = stage(salted_lookup(dealt, "cell", crowds, ["node"], "inner", pinned=True).select(
        "cell", "node", "row", "n_shingles", "left", rank.alias("rank"), "n"), "ranked")
    drop_staged(dealt)
    drop_staged(crowd)
    most = ranked.agg(F.max("n")).first()[0] or 0
    enough = (100 + LEAST_PERCENT) * F.least("left", "p_left") >= LEAST_PERCENT * (F.col("n_shingles") + F.col("p_n"))
    before, reach = -1.0, 0.0  # the pivot with the fewest rarer shingles is the first
    while before < most:
        at = stage(links.named(ranked.where(F.col("rank") > before).drop("n")), "rooted")  # earlier pivots have met everybody
        spans = at.groupBy("cell").agg(F.min("root").alias("lo"), F.max("root").alias("hi"))
        mixed = stage(spans.where("lo <> hi").select("cell"), "mixed")
        if not mixed.limit(1).count():
            break
        pivots = at.where(F.col("rank") <= reach).join(mixed, "cell").select(
            "cell", F.col("node").alias("p"), F.col("row").alias("p_row"), F.col("n_shingles").alias("p_n"),
            F.col("left").alias("p_left"), F.col("root").alias("p_root"))
        pairs = salted_lookup(at, "cell", pivots, ["node"], "inner", pinned=True).where(
            enough & (F.col("root") != F.col("p_root")) & ((F.col("rank") > reach) | (F.col("node") > F.col("p"))))
        links.check(pairs.select("node", "row", "p", "p_row").distinct())
        drop_staged(at)
        before, reach = reach, max(reach, 1.0) * PIVOT_GROWTH
    drop_staged(ranked)
    return links.roots


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """A row per document: doc_id, n_shingles, component_id, kept.

    Documents without words are linked with nothing. Null ids take part in links but name no
    component: a component of null ids only has a null component_id and its rows are kept.
    Repeated rows give repeated rows; an empty table gives none. Other columns are not read.
    """
    rows = stage(signed_rows(docs, key, text).withColumn("row", F.monotonically_increasing_id()), "signed")
    worded = rows.where("n_shingles > 0")
    one = worded.groupBy("node").agg(F.min("id").alias("id"), F.min("row").alias("row"), F.max("n_shingles").alias("n_shingles"))
    nodes = stage(one.join(worded.select("row", "bands", "bytes"), "row"), "nodes")
    roots = linked(nodes, rows.select("row", "line"))
    named = nodes.select("node", "id")
    if roots is None:
        named = named.select("node", F.col("id").alias("component_id"))
    else:
        rooted = named.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
        least = rooted.groupBy("root").agg(F.min("id").alias("component_id"))
        named = salted_lookup(rooted, "root", least, ["node"]).select("node", "component_id")
    every = salted_lookup(rows.select("id", "node", "n_shingles"), "node", named, ["id"])
    component = F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("id"))
    return every.select(F.col("id").alias("doc_id"), "n_shingles", component.alias("component_id")).withColumn(
        "kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.col("component_id").isNull()))
