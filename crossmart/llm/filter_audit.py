"""How text filters interact: what each one removes in every order of application.

Filters applied so far form a subset, so all orders are paths through the lattice of subsets:
an edge leads from a state to the state with one more filter. What an edge removes depends on
the state alone, not on the order in which the state was reached. So a document is read once,
into the set of filters it fails; the equal sets of a part are counted; edges get their
removals from those counts; and every order reads its steps from the edges of its path.
A forward pass counts the orders that reach a state and a backward pass those that leave it;
their product at both ends of an edge says how many orders use it, which is the weight of the
edge's removals in the Shapley sum.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b
from itertools import permutations

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from crossmart.llm.common import salted_lookup, stage

#: The letters of the filters in order; bit i of a mask stands for letter i.
FILTERS = "ABCDE"
LEAST_WORDS = 100
LEAST_DISTINCT_PERCENT = 80
MOST_CAPITALS_PERCENT = 10
SIGNS = b"#$%&*|"
CAPITALS = bytes(range(ord("A"), ord("Z") + 1))
CONTINUATION = bytes(range(0x80, 0xC0))  # UTF-8 bytes that begin no character


def failed(text: bytes) -> int:
    """Mask of the filters A to D that a text in UTF-8 fails."""
    words = text.split()  # bytes split at ASCII white space only
    points = len(text) if text.isascii() else len(text.translate(None, CONTINUATION))
    capitals = len(text) - len(text.translate(None, CAPITALS))
    return (
        (len(words) < LEAST_WORDS)
        | (100 * len(set(words)) < LEAST_DISTINCT_PERCENT * len(words)) << 1
        | (100 * capitals > MOST_CAPITALS_PERCENT * points) << 2
        | (len(text.translate(None, SIGNS)) < len(text)) << 3
    )


def judged_rows(docs: DataFrame, key: str = "doc_id", text: str = "text", part: str = "lang") -> DataFrame:
    """(id, part, mask, digest) a row; mask has filters A to D, digest stands for the whole text."""
    chosen = docs.select(F.col(key).alias("id"), F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"), F.col(text).alias("text"))

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            masks, digests = [], []
            for value in batch.column("text").cast(pa.binary()):
                body = value.as_py() or b""
                masks.append(failed(body))
                digests.append(blake2b(body, digest_size=16).digest())
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("part"), pa.array(masks, pa.int32()), pa.array(digests, pa.binary())],
                names=["id", "part", "mask", "digest"])

    schema = T.StructType([
        T.StructField("id", chosen.schema["id"].dataType), T.StructField("part", T.StringType()),
        T.StructField("mask", T.IntegerType()), T.StructField("digest", T.BinaryType())])
    return chosen.mapInArrow(judge, schema)


def failure_counts(
    docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", part: str = "lang"
) -> DataFrame:
    """(part, mask, n, good, toxic): documents by the exact set of filters they fail.

    Filter E fails where the text stands under a smaller id anywhere in the table. The first
    id of a text is an aggregate that combines before the shuffle, and rows find it by text
    and id together, so a text that fills a third of the table is no hot key. Rows with a
    null id have no smaller id and no label. An id with several labels is good (toxic) if
    one of them says so.
    """
    rows = stage(judged_rows(docs, key, text, part), "judged")
    first = rows.groupBy("digest").agg(F.min("id").alias("id")).select("digest", "id", F.lit(True).alias("first"))
    combined = rows.groupBy("digest", "id", "part", "mask").agg(F.count(F.lit(1)).alias("n"))
    again = F.col("id").isNotNull() & F.col("first").isNull()
    marked = combined.join(first, ["digest", "id"], "left").withColumn(
        "mask", F.when(again, F.col("mask").bitwiseOR(F.lit(1 << 4))).otherwise(F.col("mask")))
    said = labels.groupBy(F.col(key).alias("id")).agg(
        F.max(F.coalesce(F.col("quality") == 1, F.lit(False))).alias("is_good"),
        F.max(F.coalesce(F.col("toxic") == 1, F.lit(False))).alias("is_toxic"))
    known = salted_lookup(marked, "id", said, ["digest"])
    return known.groupBy("part", "mask").agg(
        F.sum("n").alias("n"),
        F.sum(F.when(F.col("is_good"), F.col("n")).otherwise(0)).alias("good"),
        F.sum(F.when(F.col("is_toxic"), F.col("n")).otherwise(0)).alias("toxic"))


def edge_weights(n_filters: int) -> dict[tuple[int, int], int]:
    """{(state, filter): orders that apply the filter in that state}, by path counts from both ends."""
    full = (1 << n_filters) - 1
    forward, backward = {0: 1}, {full: 1}
    for state in range(1, full + 1):  # every predecessor is a smaller number
        forward[state] = sum(forward[state ^ 1 << i] for i in range(n_filters) if state >> i & 1)
    for state in range(full - 1, -1, -1):
        backward[state] = sum(backward[state | 1 << i] for i in range(n_filters) if not state >> i & 1)
    return {
        (state, i): forward[state] * backward[state | 1 << i]
        for state in range(full + 1) for i in range(n_filters) if not state >> i & 1
    }


def lattice_edges(counts: DataFrame, n_filters: int) -> DataFrame:
    """Per part and edge (state, filter): what is kept, removed, redundant and lost there, and the Shapley sum.

    A part has at most two to the number of filters of rows in ``counts``, so this works on
    aggregates of a fixed size a part, whatever the size of the table.
    """
    weights = edge_weights(n_filters)
    edges = F.array(*[F.struct(
        F.lit(state).alias("state"), F.lit(i).alias("filter"), F.lit(weight).cast("long").alias("weight"))
        for (state, i), weight in weights.items()])
    at = counts.select("*", F.explode(edges).alias("edge")).select("*", "edge.*").drop("edge")
    bit = F.call_function("shiftleft", F.lit(1), F.col("filter"))
    mask, state = F.col("mask"), F.col("state")
    fails, alive = mask.bitwiseAND(bit) != 0, mask.bitwiseAND(state) == 0

    def total(condition: Column, value: str = "n") -> Column:
        return F.sum(F.when(condition, F.col(value)).otherwise(0)).cast("long")

    found = at.groupBy("part", "state", "filter", "weight").agg(
        total(alive & ~fails).alias("kept"), total(alive & fails).alias("removed"),
        total(~alive & fails).alias("redundant"), total(mask == bit).alias("unique_fails"),
        total(alive & fails, "good").alias("good_lost"), total(alive & fails, "toxic").alias("toxic_lost"))
    shares = found.groupBy("part", "filter").agg(F.sum(F.col("weight") * F.col("removed")).alias("shapley"))
    return found.join(shares, ["part", "filter"]).drop("weight")


def interactions(
    docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", part: str = "lang"
) -> DataFrame:
    """A row per part, order of the five filters and step: counts of documents, zeros included.

    Null texts count as empty, null parts as the empty string; an empty table has no parts
    and gives no rows. Repeated rows count as often as they stand there. Other columns are
    not read, whatever their names.
    """
    edges = lattice_edges(failure_counts(docs, labels, key, text, part), len(FILTERS))
    steps = []
    for order in permutations(range(len(FILTERS))):
        state = 0
        for step, i in enumerate(order, 1):
            steps.append(("".join(FILTERS[k] for k in order), step, state, i))
            state |= 1 << i
    paths = docs.sparkSession.createDataFrame(steps, "filter_order string, step int, state int, filter int")
    # 600 rows, fixed by the number of filters
    return edges.join(F.broadcast(paths), ["state", "filter"]).select(
        "part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")
