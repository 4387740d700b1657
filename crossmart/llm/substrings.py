"""Substring deduplication by unit hashing: the earliest occurrence of a line or sentence stays.

Units are lines, cut further at sentence ends, so a passage that was pasted into the middle
of a line still shares its sentences. Every unit keeps its offsets in the original text.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from crossmart.llm.common import SALTS, stage

#: Shorter units recur by chance and stay: a whole line needs fewer words than a sentence within one.
LINE_WORDS, SENTENCE_WORDS = 4, 6
SENTENCE = re.compile(r"(?<=[.!?])[ \t\x0b\x0c\r]+")
BATCH = 20_000


def units(text: str | None) -> Iterator[tuple[int, int, int, int, int, int]]:
    """(start, end, words, digest, digest, gap) of the units long enough to count, in code points.

    A unit is normalised to lower case and single spaces before it is hashed (XXH3, 128 bits);
    ``gap`` hashes what was too short to count since the unit before.
    """
    at, gap = 0, []
    for line in (text or "").split("\n"):
        cuts = [0, *[m.end() for m in SENTENCE.finditer(line)], len(line)]
        for lo, hi in zip(cuts, cuts[1:], strict=False):
            part = line[lo:hi]
            tokens = part.lower().split()
            if len(tokens) >= (LINE_WORDS if hi - lo == len(line) else SENTENCE_WORDS):
                start = at + lo + len(part) - len(part.lstrip())
                value = xxhash.xxh3_128_intdigest(" ".join(tokens).encode("utf-8", "surrogatepass"))
                skipped = signed(xxhash.xxh3_64_intdigest(" ".join(gap).encode("utf-8", "surrogatepass")))
                yield start, at + lo + len(part.rstrip()), len(tokens), signed(value >> 64), signed(value & (2**64 - 1)), skipped
                gap = []
            else:
                gap += tokens
        at += len(line) + 1


def signed(value: int) -> int:
    return value - 2**64 if value >= 2**63 else value


def unit_table(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, nr, start, end, n_words, d1, d2, gap): every unit of every text."""

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        columns = ["doc_id", "nr", "start", "end", "n_words", "d1", "d2", "gap"]
        for batch in batches:
            rows = []
            for doc, body in zip(batch["doc_id"], batch["text"], strict=True):
                for nr, unit in enumerate(units(body)):
                    rows.append((doc, nr, *unit))
                    if len(rows) >= BATCH:
                        yield pd.DataFrame(rows, columns=columns)
                        rows = []
            yield pd.DataFrame(rows, columns=columns)

    narrow = docs.where(F.col(key).isNotNull()).select(F.col(key).alias("doc_id"), F.col(text).alias("text"))
    kind = narrow.schema["doc_id"].dataType.simpleString()
    return narrow.mapInPandas(cut, f"doc_id {kind}, nr int, start int, end int, n_words int, d1 long, d2 long, gap long")


def repeats(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, start, end, n_words, n_units, keeper_doc_id, keeper_start): spans to remove.

    Occurrences rank by id and then place; the first stays. Neighbouring removed units
    become one span if they are neighbours in the keeper too, with the same short units between. Digests are grouped with a salt first, so a unit
    that a third of all documents share fills no task. Null and blank texts have no units,
    rows with a null id are left alone, rows that repeat an id count as one document.
    """
    cut = unit_table(docs, key, text).withColumn("salt", F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)).cast("int"))
    cut = stage(cut, "units")
    digest = ["d1", "d2"]
    partly = cut.groupBy(*digest, "salt").agg(F.count(F.lit(1)).alias("n"), F.min("doc_id").alias("doc"))
    twice = partly.groupBy(*digest).agg(F.sum("n").alias("n"), F.min("doc").alias("keeper_doc_id")).where("n > 1").drop("n")
    shared = stage(partly.select(*digest, "salt").join(twice, digest), "shared")
    found = stage(cut.join(shared, [*digest, "salt"]), "repeated")
    firsts = found.where("doc_id = keeper_doc_id").groupBy(*digest).agg(
        F.min("start").alias("keeper_start"), F.min_by("nr", "start").alias("keeper_nr"), F.min_by("gap", "start").alias("keeper_gap"))
    places = shared.select(*digest, "salt").join(firsts, digest)
    later = found.join(places, [*digest, "salt"]).where(
        (F.col("doc_id") != F.col("keeper_doc_id")) | (F.col("start") != F.col("keeper_start")))
    order = Window.partitionBy("doc_id").orderBy("nr", "start")
    step = F.col("nr") - F.lag("nr").over(order)
    beside = (step == 1) & (F.col("keeper_nr") == F.lag("keeper_nr").over(order) + 1) & (F.col("gap") == F.col("keeper_gap"))
    follows = (F.col("keeper_doc_id") == F.lag("keeper_doc_id").over(order)) & ((step == 0) | beside)
    runs = later.withColumn("again", step == 0).withColumn("new", F.when(follows, 0).otherwise(1)).withColumn(
        "run", F.sum("new").over(order)).where("again IS NULL OR NOT again")
    return runs.groupBy("doc_id", "run").agg(
        F.min("start").alias("start"), F.max("end").alias("end"), F.sum("n_words").alias("n_words"),
        F.count(F.lit(1)).alias("n_units"), F.min("keeper_doc_id").alias("keeper_doc_id"), F.min("keeper_start").alias("keeper_start"),
    ).drop("run")


def cut_out(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The table with repeated spans cut from its texts, and ``removed``: their (start, end) in the original.

    Other columns stay; a text without repeats stays as it is.
    """
    spans = repeats(docs, key, text).groupBy(F.col("doc_id").alias("_doc")).agg(
        F.sort_array(F.collect_list(F.struct("start", "end"))).alias("removed"))
    own = [c for c in docs.columns if c != "removed"]
    found = docs.select(*own).join(spans, F.col(key) == F.col("_doc"), "left")
    body, gone = F.col(text), F.col("removed")
    gaps = F.transform(F.sequence(F.lit(0), F.size(gone)), lambda i: F.substring(
        body, F.when(i == 0, 1).otherwise(F.element_at(gone, F.greatest(i, F.lit(1)))["end"] + 1),
        F.greatest(F.lit(0), F.when(i == F.size(gone), F.length(body)).otherwise(
            F.element_at(gone, F.least(i + 1, F.size(gone)))["start"]) - F.when(i == 0, 0).otherwise(
            F.element_at(gone, F.greatest(i, F.lit(1)))["end"]))))
    cut = F.when(gone.isNull(), body).otherwise(F.array_join(gaps, ""))
    return found.select(*[cut.alias(c) if c == text else F.col(c) for c in own], "removed")
