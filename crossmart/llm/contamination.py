"""Benchmark decontamination on templates: numbers, units and names become typed slots.

Two texts with the same wording but other parameters share their template. Windows of five
template words are joined on their hash. Windows that match at one offset are one occurrence.
In it a benchmark value stands for the document value that most windows bind to it; windows
that bind another one do not count, unless all of their own slots are unchanged. Two benchmark
values may stand for one document value. Windows made of slots alone must agree in their values.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crossmart.llm.common import let, stage

WINDOW = 5
THRESHOLD = 0.8
#: Benchmark windows (a hash, two numbers and short slot values each) are broadcast up to this number.
BROADCAST_WINDOWS = 500_000
#: Units of measure and currencies, in lower case.
UNITS = (
    "mm cm m km in ft yd mi mg g kg t lb lbs oz ml l s sec min h hr hrs "
    "meter meters metre metres kilometer kilometers kilometre kilometres mile miles foot feet inch inches "
    "gram grams kilogram kilograms ton tons pound pounds ounce ounces liter liters litre litres "
    "second seconds minute minutes hour hours day days week weeks month months year years "
    "dollar dollars euro euros cent cents percent usd eur gbp"
).split()
SPACE, NO_SPACE = r"[\x20\x09-\x0D]", r"[^\x20\x09-\x0D]"
PUNCTUATION = r"[!-/:-@\[-`{-~]+"
#: Private characters that mark a slot word; removed from texts that have them.
NAME_MARK, NUMBER_MARK, UNIT_MARK = "\ue001", "\ue002", "\ue003"
MARKS = "[\ue001-\ue003]"
NAME = rf"(?<=[\p{{L}}\p{{N}},;]{SPACE})\p{{Lu}}\p{{Ll}}+(?![\p{{L}}\p{{N}}])"
QUOTES = "[\"'`()\\[\\]{}<>\u00ab\u00bb\u2018-\u201f\u2039\u203a]+"
QUOTED = rf"{QUOTES}(?=[.,;:!?]*{SPACE})|({SPACE}){QUOTES}"
EDGES = rf"{PUNCTUATION}(?={SPACE})|({SPACE}){PUNCTUATION}"
NUMBER = rf"({SPACE})([0-9][0-9.,:/]*(?:st|nd|rd|th)?)(?={SPACE})"
UNIT = rf"({NUMBER_MARK}{NO_SPACE}+{SPACE}+)({'|'.join(UNITS)})(?={SPACE})"
BETWEEN = "\x1f"
NO_SLOTS = BETWEEN * (WINDOW - 1)


def marked(text: Column) -> Column:
    """The text in lower case without ASCII punctuation at word edges, slot words marked.

    A capitalised word after a letter, digit, comma or semicolon and one white space is a name,
    digits are a number, and a unit word right after a number is a unit. Quotation marks and
    brackets at word edges and further white space go first. One pass a rule over
    the whole text costs far less than rules applied word by word; the passes expect a space
    at both ends.
    """
    padded = F.concat(F.lit(" "), F.regexp_replace(text, MARKS, ""), F.lit(" "))
    padded = F.regexp_replace(F.regexp_replace(padded, QUOTED, "$1"), SPACE + "+", " ")
    bare = F.regexp_replace(F.lower(F.regexp_replace(padded, NAME, NAME_MARK + "$0")), EDGES, "$1")
    counted = F.regexp_replace(F.regexp_replace(bare, NUMBER, "$1" + NUMBER_MARK + "$2"), UNIT, "$1" + UNIT_MARK + "$2")
    return F.when(text.rlike("[0-9]"), counted).otherwise(bare)


def windows(df: DataFrame, key: str, text: str) -> DataFrame:
    """A row per window: id, hash, place, slots (values joined) and the text's number of windows.

    A window with a name has a second row in which names are literal words, so that it meets
    copies in lower or upper case. Fewer template words than a window are one window of the
    whole sequence, which meets other such texts only; a text without words has none.
    """

    def is_slot(word):
        return F.substring(word, 1, 1).isin(NAME_MARK, NUMBER_MARK, UNIT_MARK)

    def is_name(word):
        return F.substring(word, 1, 1) == NAME_MARK

    def literal(t, i):
        own = F.slice(t, i, WINDOW)
        return F.struct(F.size(t).alias("n"), i.alias("place"), F.xxhash64(own).alias("h"), F.lit(NO_SLOTS).alias("slots"))

    def slotted(x, i):
        own, values, flags = (F.slice(x[c], i, WINDOW) for c in ("t", "v", "f"))
        h = F.when(F.array_contains(flags, False), F.xxhash64(own)).otherwise(F.xxhash64(F.lit("values"), values))
        slots = F.when(F.array_contains(flags, True), F.concat_ws(BETWEEN, values)).otherwise(NO_SLOTS)
        return F.struct(F.size(x["t"]).alias("n"), i.alias("place"), h.alias("h"), slots.alias("slots"))

    def with_slots(w):
        named = let(template(w), slotted_windows)
        return F.when(~F.exists(w, is_name), named).otherwise(F.concat(named, let(
            template(F.transform(w, lambda x: F.when(is_name(x), F.substring(x, 2, 1 << 30)).otherwise(x))), lambda x: let(F.transform(w, is_name), lambda names: F.when(
                F.size(w) >= WINDOW, F.transform(F.filter(at(w), lambda i: F.array_contains(F.slice(names, i, WINDOW), True)), lambda i: slotted(x, i))
            ).otherwise(slotted_windows(x))))))

    def template(w):
        parts = F.transform(w, lambda x: F.when(is_slot(x), F.struct(
            F.substring(x, 1, 1).alias("t"), x.alias("v"), F.lit(True).alias("f"))).otherwise(F.struct(x.alias("t"), F.lit("").alias("v"), F.lit(False).alias("f"))))
        return let(parts, lambda p: F.struct(*[p[c].alias(c) for c in "tvf"]))

    def at(t):
        return F.sequence(F.lit(1), F.size(t) - (WINDOW - 1))

    def slotted_windows(x):
        whole = F.array(F.struct(
            F.size(x["t"]).alias("n"), F.lit(1).alias("place"), F.xxhash64(F.lit("whole"), x["t"]).alias("h"), F.concat_ws(BETWEEN, x["v"]).alias("slots")))
        return F.when(F.size(x["t"]) >= WINDOW, F.transform(at(x["t"]), lambda i: slotted(x, i))).otherwise(whole)

    def literal_windows(t):
        whole = F.array(F.struct(
            F.size(t).alias("n"), F.lit(1).alias("place"), F.xxhash64(F.lit("whole"), t).alias("h"), F.array_join(F.transform(t, lambda _: F.lit("")), BETWEEN).alias("slots")))
        return F.when(F.size(t) >= WINDOW, F.transform(at(t), lambda i: literal(t, i))).when(F.size(t) > 0, whole)

    def every(s):
        tokens = F.filter(F.split(s, SPACE + "+", -1), lambda x: x != "")
        return F.when(s.rlike(MARKS), let(tokens, with_slots)).otherwise(let(tokens, literal_windows))

    all_ = let(marked(F.coalesce(F.col(text), F.lit(""))), every)
    # the outer form keeps Spark from testing the array for rows, and so computing it, a second time
    found = df.select(F.col(key).alias("id"), all_.alias("_all")).select(
        "id", F.explode_outer("_all").alias("_x")).where("_x IS NOT NULL")
    n = F.greatest(F.lit(1), F.col("_x.n") - (WINDOW - 1))
    return found.select("id", n.alias("n_windows"), F.col("_x.place").alias("place"), F.col("_x.h").alias("h"), F.col("_x.slots").alias("slots"))


def pairs_of(b: Column, d: Column) -> Column:
    """(benchmark value, document value) of every slot in two slot strings."""
    both = F.arrays_zip(F.split(b, BETWEEN, -1).alias("b"), F.split(d, BETWEEN, -1).alias("d"))
    return F.filter(both, lambda p: p["b"] != "")


def voted(pairs: Column) -> Column:
    """For each benchmark value the pair that most windows bind; of equal votes the unchanged value, then the largest."""

    def settled(every, distinct):
        def votes(p):
            return F.struct(F.size(F.filter(every, lambda q: q == p)).alias("n"), (p["b"] == p["d"]).alias("same"), p["d"].alias("d"))

        ranked = F.transform(distinct, lambda p: F.struct(p["b"].alias("b"), p["d"].alias("d"), votes(p).alias("votes")))
        best = let(ranked, lambda r: F.filter(r, lambda x: ~F.exists(r, lambda y: (y["b"] == x["b"]) & (y["votes"] > x["votes"]))))
        once = F.size(F.array_distinct(F.transform(distinct, lambda p: p["b"]))) == F.size(distinct)
        return F.when(once, distinct).otherwise(F.transform(best, lambda x: F.struct(x["b"].alias("b"), x["d"].alias("d"))))

    return let(pairs, lambda every: let(F.array_distinct(every), lambda distinct: settled(every, distinct)))


def standing(seen: Column) -> Column:
    """The matched (at, b, d) windows with slots that are unchanged, or bind only what the occurrence voted for."""
    return let(voted(F.flatten(F.transform(seen, lambda x: pairs_of(x["b"], x["d"])))), lambda bound: F.filter(
        seen, lambda x: (x["b"] == x["d"]) | F.forall(pairs_of(x["b"], x["d"]), lambda p: F.exists(bound, lambda q: q == p))))


def contaminated(
    docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text",
    item: str = "item_id", item_text: str = "text", threshold: float = THRESHOLD,
) -> DataFrame:
    """(doc_id, item_id, n_matched, n_windows, n_slots, n_changed) of every leaked benchmark item.

    n_matched counts the item's windows that stand in an occurrence, n_slots the slot values bound
    in them and n_changed those with another value in the document (0: these windows are as they are).
    An item leaks if n_matched is at least ``threshold`` of its windows. Null and blank texts
    leak nothing; repeated rows are one document or item; empty tables give no rows.
    """
    asked = stage(windows(benchmark, item, item_text).select(
        F.col("id").alias("item_id"), F.col("n_windows"), F.col("place").alias("at"), "h", F.col("slots").alias("b")
    ).distinct(), "windows")
    small = asked.limit(BROADCAST_WINDOWS + 1).count() <= BROADCAST_WINDOWS
    told = windows(docs, key, text).select(F.col("id").alias("doc_id"), "place", "h", F.col("slots").alias("d"))
    met = told.join(F.broadcast(asked) if small else asked, "h")
    has_slots = F.regexp_replace("b", BETWEEN, "") != ""
    occurrence = met.groupBy("doc_id", "item_id", "n_windows", (F.col("place") - F.col("at")).alias("offset")).agg(
        F.collect_set(F.when(~has_slots, F.col("at"))).alias("plain"), F.collect_set(F.when(has_slots, F.struct("at", "b", "d"))).alias("seen"))
    stood = occurrence.withColumn("stood", F.when(F.size("seen") > 0, standing(F.col("seen"))).otherwise(F.col("seen")))
    bound = stood.withColumn("bound", F.flatten(F.transform("stood", lambda x: pairs_of(x["b"], x["d"]))))
    values = lambda pairs: F.size(F.array_distinct(F.transform(pairs, lambda p: p["b"])))
    per_place = bound.select(
        "doc_id", "item_id", "n_windows", values(F.col("bound")).alias("slots"),
        values(F.filter("bound", lambda p: p["b"] != p["d"])).alias("changed"),
        F.explode(F.array_union("plain", F.transform("stood", lambda x: x["at"]))).alias("at"))
    found = per_place.groupBy("doc_id", "item_id", "n_windows", "at").agg(
        F.max("slots").alias("slots"), F.min("changed").alias("changed"))
    whole = found.groupBy("doc_id", "item_id", "n_windows").agg(
        F.count(F.lit(1)).alias("n_matched"), F.max("slots").cast("long").alias("n_slots"), F.max("changed").cast("long").alias("n_changed"))
    return whole.where(F.col("n_matched") >= F.lit(threshold) * F.col("n_windows")).select(
        "doc_id", "item_id", "n_matched", F.col("n_windows").cast("long").alias("n_windows"), "n_slots", "n_changed")


def decontaminated(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """The documents in which no benchmark item leaks; all columns, repeated rows and null ids stay."""
    leaks = contaminated(docs, benchmark, key, text, **options).select(F.col("doc_id").alias("_leak")).distinct()
    return docs.join(leaks, F.col(key) == F.col("_leak"), "left_anti")
