"""Quality rules: a table of thresholds compiled into one projection of built-in functions."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crossmart.llm.common import let, words

SYMBOLS = r"[#*$%&|<>]"
#: Frequent function words of English, German, French and Spanish.
STOP_WORDS = (
    "the of and to in is it that for was on are as with be by at this from "
    "der die das und den von zu mit ist im nicht eine ein auf für "
    "le la les de des et un une que est dans pour qui du en "
    "el los las se no por con su para lo una y"
).split()


@dataclass(frozen=True)
class Rule:
    """A document passes if low <= measure / per <= high; without a denominator the measure counts."""

    name: str
    measure: str
    per: str | None = None
    low: float | None = None
    high: float | None = None


BASE_RULES = (
    Rule("words", "n_words", low=50),
    Rule("repeated_words", "n_repeat_words", per="n_words", high=0.5),
)
RULES = (
    Rule("word_length", "word_chars", per="n_words", low=2.0, high=14.0),
    Rule("symbols", "n_symbols", per="n_words", high=0.25),
    Rule("stop_words", "n_stop_words", per="n_words", low=0.04),
    Rule("duplicate_lines", "n_dup_lines", per="n_lines", high=0.5),
)


#: Texts with more repeated hashes than this sort their windows instead of searching the hashes.
FEW = 64


def with_repeats(df: DataFrame, tokens: str, name: str, window: int = 3) -> DataFrame:
    """Add the number of words in a window of words found twice or more, the first find included.

    Window hashes find the windows that may be repeated, and only these are compared by their
    words, so a hash collision costs time and never a wrong count. Steps are columns of their
    own because an array that a lambda looks into must be computed once.
    """
    words_, last = F.col(tokens), F.size(tokens) - window + 1
    at = F.when(last >= 1, F.sequence(F.lit(1), last)).otherwise(F.array().cast("array<int>"))
    hashed = F.transform(at, lambda i: F.xxhash64(*[F.element_at(words_, i + k) for k in range(window)]))
    own = df.columns
    df = df.select(*own, hashed.alias("_h")).select(*own, "_h", F.sort_array("_h").alias("_s"))
    twice = F.array_distinct(F.filter("_s", lambda x, k: x == F.get("_s", k - 1)))
    df = df.select(*own, "_h", twice.alias("_d"))

    def repeated(ordered):
        return F.transform(F.filter(ordered, lambda x, k: (x["w"] == F.get(ordered, k - 1)["w"]) | (
            x["w"] == F.get(ordered, k + 1)["w"])), lambda x: x["i"])

    def finds(pairs):
        return let(F.sort_array(pairs), repeated)

    places = F.filter(F.transform("_h", lambda h, i: F.when(F.array_contains("_d", h), i + 1).otherwise(0)), lambda i: i > 0)
    likely = F.when(F.size("_d") <= FEW, places).otherwise(finds(F.transform("_h", lambda h, i: F.struct(h.alias("w"), (i + 1).alias("i")))))
    sure = F.sort_array(finds(F.transform(
        likely, lambda i: F.struct(F.array_join(F.slice(words_, i, window), " ").alias("w"), i.alias("i")))))
    covered = F.aggregate(
        sure, F.struct(F.lit(0).alias("n"), F.lit(-window).alias("at")),
        lambda acc, i: F.struct((acc["n"] + F.least(F.lit(window), i - acc["at"])).alias("n"), i.alias("at")),
        lambda acc: acc["n"],
    )
    return df.select(*own, F.when(F.size("_d") == 0, 0).otherwise(covered).cast("long").alias(name))


def measures(text: str, stop_words=tuple(STOP_WORDS)) -> dict[str, Column]:
    """Every measure the rules may name, over a column ``_words`` of the text's words."""
    body, tokens = F.coalesce(F.col(text), F.lit("")), F.col("_words")
    lines = F.filter(F.split(body, "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    return {
        "n_words": F.size(tokens).cast("long"),
        "word_chars": F.length(F.array_join(tokens, "")).cast("long"),
        "n_symbols": (F.size(F.split(body, SYMBOLS, -1)) - 1).cast("long"),
        "n_dup_lines": (F.size(lines) - F.size(F.array_distinct(lines))).cast("long"),
        "n_lines": F.size(lines).cast("long"),
        "n_stop_words": F.size(F.filter(tokens, lambda w: F.lower(w).isin(*stop_words))).cast("long"),
    }


def passes(rule: Rule) -> Column:
    """One rule as a condition; a ratio over nothing counts as 0. Compared as products, so exact at the bound."""
    value = F.col(rule.measure).cast("double")
    base = F.col(rule.per).cast("double") if rule.per else F.lit(1.0)
    ok = F.lit(True)
    if rule.low is not None:
        ok = ok & (value >= F.lit(float(rule.low)) * base)
    if rule.high is not None:
        ok = ok & (value <= F.lit(float(rule.high)) * base)
    return ok


def judged(df: DataFrame, text: str = "text", rules=RULES, base=BASE_RULES) -> DataFrame:
    """The table with measures, ``base_failed``, ``failed_rules`` and ``kept``; one map-only projection.

    A null or empty text has no words and fails the base rules. Repeated rows are judged alike.
    Input columns with the name of an added one are replaced.
    """
    own = [F.col(c) for c in df.columns if c not in MEASURES and c not in ("base_failed", "failed_rules", "kept")]
    split = with_repeats(df.select(*own, words(F.col(text)).alias("_words")), "_words", "n_repeat_words")
    found = F.struct("n_repeat_words", *[c.alias(n) for n, c in measures(text).items()])
    # a generated row is a fence: filters on measures stay above it, so nothing is measured twice
    measured = split.select(*own, F.explode_outer(F.array(found)).alias("_m")).select(*own, *[F.col(f"_m.{n}").alias(n) for n in MEASURES])
    failed = F.array_compact(F.array(*[F.when(~passes(r), F.lit(r.name)) for r in (*base, *rules)]))
    base_failed = F.lit(False)
    for r in base:
        base_failed = base_failed | ~passes(r)
    return measured.withColumn("base_failed", base_failed).withColumn("failed_rules", failed).withColumn(
        "kept", F.size("failed_rules") == 0)


MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_stop_words")
