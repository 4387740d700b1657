"""Secret scans: fixed patterns, and Markov models that tell random strings from identifiers.

Positions come from built-in functions alone: splitting a text at a pattern and extracting
the pattern visit the same leftmost, non-overlapping matches, so the lengths of pieces and
matches add up to code-point offsets.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crossmart.llm.common import let, stage, unit_hash

#: Kind, pattern, group whose length counts, least length. Fixed values.
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
#: A maximal run is the only match in it, so the least length may stand in these two patterns.
BASE = (
    ("assign", ASSIGN, 2, 12),
    ("access", r"AKIA[A-Z0-9]{14,}", 0, 18),
    ("hex", r"[0-9a-f]{16,}", 0, 16),
)
METHOD = "markov"
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
CANDIDATE = r"[A-Za-z0-9+/_=-]{16,}"
IDENTIFIER = r"[A-Za-z_][A-Za-z0-9_-]{5,}"
#: Expected number of documents in the labelled sample.
SAMPLE_DOCUMENTS = 20_000
#: A candidate is random from this mean log-likelihood ratio a transition, in thousandths of a nat.
MIN_RATIO = 700
BLOCK = 256
PRIOR = 10.0


def offsets(lengths: Column) -> Column:
    """Sums of the lengths before each place, in blocks so that long arrays stay far from quadratic."""
    blocks = F.transform(
        F.sequence(F.lit(0), F.floor((F.size(lengths) - 1) / BLOCK).cast("int")), lambda b: F.slice(lengths, b * BLOCK + 1, BLOCK))

    def before(values):
        return F.transform(values, lambda _, i: F.aggregate(F.slice(values, 1, i), F.lit(0), lambda a, x: a + x))

    def shifted(blocks):
        sums = F.transform(blocks, lambda b: F.aggregate(b, F.lit(0), lambda a, x: a + x))
        starts = let(sums, before)
        return let(starts, lambda at: F.flatten(F.transform(
            blocks, lambda b, k: F.transform(before(b), lambda x: x + F.element_at(at, k + 1)))))

    return let(blocks, shifted)


def matches(text: Column, kind: str, pattern: str, group: int, least: int, order: int) -> Column:
    """Array of (start, order, kind, end, value) of one pattern; empty without a match."""

    def spans(sized):
        lengths = F.transform(sized, lambda x: x["p"] + x["m"])
        return let(let(lengths, offsets), lambda before: F.transform(sized, lambda x, i: F.struct(
            (F.element_at(before, i + 1) + x["p"]).alias("start"), F.lit(order).alias("order"), F.lit(kind).alias("kind"),
            (F.element_at(before, i + 1) + x["p"] + x["m"]).alias("end"), x["v"].alias("value"))))

    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    value = F.regexp_extract_all(text, F.lit(pattern), F.lit(group))
    zipped = F.arrays_zip(found.alias("m"), value.alias("v"), F.split(text, pattern, -1).alias("p"))
    sized = F.transform(F.filter(zipped, lambda x: x["m"].isNotNull()), lambda x: F.struct(
        F.length(x["p"]).alias("p"), F.length(x["m"]).alias("m"), x["v"].alias("v")))
    kept = F.filter(let(sized, spans), lambda x: F.length(x["value"]) >= least)
    none = "array<struct<start:int,order:int,kind:string,end:int,value:string>>"
    return F.when(text.rlike(pattern), kept).otherwise(F.array().cast(none))


def base_spans(text: Column) -> Column:
    """All base spans by start, then kind as listed."""
    return F.sort_array(F.concat(*[matches(text, *rule, order) for order, rule in enumerate(BASE)]))


def outside(spans: Column, taken: Column) -> Column:
    return F.filter(spans, lambda x: ~F.exists(taken, lambda b: (x["start"] < b["end"]) & (b["start"] < x["end"])))


def labelled_sample(docs: DataFrame, key: str, text: str, size: int = SAMPLE_DOCUMENTS) -> DataFrame:
    """(label, token): base values are random strings (1), identifiers beside them are ordinary (0).

    Documents are drawn by a hash of their id with probability size / count, so the sample
    does not grow with the table.
    """
    share = F.lit(float(size)) / F.greatest(F.lit(1), F.lit(docs.count()))
    drawn = docs.where(unit_hash(F.lit("secrets"), F.col(key)) < share).select(F.coalesce(F.col(text), F.lit("")).alias("_text"))
    spans = drawn.select("_text", base_spans(F.col("_text")).alias("_spans"))
    random = spans.select(F.lit(1).alias("label"), F.explode("_spans.value").alias("token"))
    ordinary = drawn.select(F.lit(0).alias("label"), F.explode(F.regexp_extract_all(
        F.regexp_replace(F.regexp_replace("_text", ASSIGN, " "), r"[0-9a-f]{16,}|AKIA[A-Z0-9]{14,}", " "), F.lit(IDENTIFIER), F.lit(0))).alias("token"))
    return random.unionByName(ordinary)


def place_of(char: Column) -> Column:
    return F.instr(F.lit(ALPHABET), char)


def train(sample: DataFrame) -> list[int] | None:
    """Log-likelihood ratio of every transition, random over ordinary, in thousandths of a nat.

    First-order models; a row is smoothed with ``PRIOR`` transitions drawn from the label's
    character frequencies, so characters that identifiers rarely use speak for chance even
    after a character they never use. None if a label has no transition.
    """
    pairs = sample.where(F.length("token") > 1).select("label", F.explode(F.transform(
        F.sequence(F.lit(1), F.length("token") - 1), lambda i: F.substring("token", i, F.lit(2)))).alias("pair"))
    coded = pairs.groupBy("label", "pair").count().select(
        "label", place_of(F.substring("pair", 1, 1)).alias("a"), place_of(F.substring("pair", 2, 1)).alias("b"), "count")
    counts = {0: {}, 1: {}}
    for r in coded.where("a > 0 AND b > 0").collect():  # at most two tables of alphabet x alphabet
        counts[r["label"]][r["a"], r["b"]] = r["count"]
    if not counts[0] or not counts[1]:
        return None
    n = len(ALPHABET)
    places = range(1, n + 1)
    rows = {k: [sum(c.get((a, b), 0) for b in places) for a in places] for k, c in counts.items()}
    columns = {k: [sum(c.get((a, b), 0) for a in places) + 0.5 for b in places] for k, c in counts.items()}

    def log(label, a, b):
        back = columns[label][b - 1] / sum(columns[label])
        return math.log((counts[label].get((a, b), 0) + PRIOR * back) / (rows[label][a - 1] + PRIOR))

    return [round(1000 * (log(1, a, b) - log(0, a, b))) for a in places for b in places]


def random_spans(text: Column, weights: Column, taken: Column, least: int = MIN_RATIO) -> Column:
    """Candidates outside the taken spans whose mean ratio is high enough."""
    n = len(ALPHABET)
    found = outside(matches(text, METHOD, CANDIDATE, 0, 16, len(BASE)), taken)

    def ratio(token):
        return F.aggregate(F.sequence(F.lit(1), F.length(token) - 1), F.lit(0), lambda acc, i: acc + F.element_at(
            weights, (place_of(F.substring(token, i, F.lit(1))) - 1) * n + place_of(F.substring(token, i + 1, F.lit(1)))))

    return F.filter(found, lambda x: ratio(x["value"]) >= least * (F.length(x["value"]) - 1))


def joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")


def scanned(docs: DataFrame, key: str = "doc_id", text: str = "text", weights: list[int] | None = None, least: int = MIN_RATIO) -> DataFrame:
    """(doc_id, base, spans): arrays of (start, order, kind, end, value), the second with the method's.

    Without weights the model is trained on a sample of the table; if that holds no secrets or
    no identifiers, only base spans are found. Null and empty texts have no spans.
    """
    weights = weights or train(stage(labelled_sample(docs, key, text), "tokens"))
    body = docs.select(F.col(key).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("_text"))
    based = body.select("doc_id", "_text", base_spans(F.col("_text")).alias("base"))
    if weights is None:
        return based.select("doc_id", "base", F.col("base").alias("spans"))
    table = F.split(F.lit(",".join(map(str, weights))), ",").cast("array<int>")
    more = random_spans(F.col("_text"), table, F.col("base"), least)
    return based.select("doc_id", "base", F.sort_array(F.concat("base", more)).alias("spans"))


def secrets(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The scan's sheet: counts and digest of the base spans, and all spans as kind:start:end."""
    found = scanned(docs, key, text)
    count = lambda kind: F.size(F.filter("base", lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return found.select(
        "doc_id", *[count(rule[0]) for rule in BASE], F.sha2(joined(F.col("base")), 256).alias("base_sha256"),
        joined(F.col("spans")).alias("spans"))
