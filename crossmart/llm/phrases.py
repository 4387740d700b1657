"""Phrase collocations: counts of all phrases of up to five words, their weakest cut, the best of each language.

Counting works on weighted acyclic automata. A task reads texts into shards of about
``SHARD_WORDS`` words, sorts a shard's word windows and builds count automata from them by
adding each window behind its common prefix with the one before. Windows are dealt by ranges
of a hash of their first words, so all counts of a phrase meet in one range; there the
automata of all shards are united and weights summed, and only then rare phrases go. Ranges
are split step by step, at most ``FAN`` at once, so their number follows the size of the
texts while a shard never falls into more than ``FAN`` pieces.

Words and pairs are counted first. A longer phrase is no more frequent than any pair inside,
so the second reading ends windows at the first pair that is too rare. It knows the frequent
pairs as a broadcast list of hashes, up to ``KNOWN_PAIRS`` of them; with more, windows are not
cut short, which costs more and counts the same.

Parts are looked up by composing the automaton of the parts asked for with the automaton of
the counts, again range by range. Parts with a thousandth of all words or more, of which there
can be 5,000 at most, are broadcast instead, so no range is asked too often.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from crossmart.llm.common import salted_lookup, stage
from crossmart.llm.count_automaton import CountAutomaton, of_phrases, ranges

LONGEST = 5
LEAST = 100
TOP = 2000
SHARD_WORDS = 3 << 19
#: Text bytes whose windows share a range, and pieces a range is split into at once (a power of two).
RANGE_BYTES = 24 << 20
FAN = 256
#: Automata are kept apart by the words that place a phrase: one, two, or the first three of three to five.
DEPTHS = (1, 2, LONGEST)
KNOWN_PAIRS = 4_000_000
ASKED_ROWS = 100_000
HOT_SHARE = 1000
SALTS = 64
FRAGMENT = "at long, lang string, depth int, payload binary"
UPPER, ENDS = bytes(range(0x41, 0x5B)), b".,;:!?\x0a\x0b\x0c\x0d"
#: A-Z to a-z, tabs to blanks, piece ends to line breaks.
PLAIN = bytes.maketrans(UPPER + b"\t" + ENDS, UPPER.lower() + b" " + b"\n" * len(ENDS))
#: Tokens that are numbered at once, so that a text has no bound.
SLICE = 1 << 17


class Labels(dict):
    """Numbers words from 1 in the order they come; a piece's end is 0, what lies between two blanks is -1."""

    def __init__(self):
        super().__init__({b"\n": 0, b"": -1})

    def __missing__(self, word: bytes) -> int:
        self[word] = found = len(self) - 1
        return found

    def words(self) -> list[bytes]:
        return sorted(w for w, label in self.items() if label > 0)


def place(vocab: list[bytes]) -> np.ndarray:
    return np.array([xxhash.xxh64_intdigest(w) for w in vocab], dtype=np.uint64)


def placed(hashes: list[np.ndarray], bits: int) -> np.ndarray:
    """Range of phrases by the hashes of the words that place them."""
    mixed = np.zeros(len(hashes[0]), dtype=np.uint64)
    for h in hashes:
        mixed = (mixed ^ h) * np.uint64(0x9E3779B97F4A7C15)
        mixed ^= mixed >> np.uint64(29)
    return (mixed >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(mixed), dtype=np.int64)


def automata(
    vocab: list[bytes], columns: list[np.ndarray], bits: int, counts: np.ndarray | None = None, depths: tuple[int, ...] = DEPTHS
) -> Iterator[tuple[int, int, CountAutomaton]]:
    """(range, depth, automaton) of windows; column k has the label plus 1 of word k or 0 behind the end."""
    spot = np.concatenate((np.zeros(1, dtype=np.uint64), place(vocab)))
    for depth in depths:
        whole = columns[min(depth, 3) - 1] > 0  # windows that reach what this automaton counts
        cols = [c[whole] for c in columns[:depth]]
        gained = None if counts is None else counts[whole]
        packed = [pack(cols[:3])] if depth < 4 else [pack(cols[3:]), pack(cols[:3])]
        order = np.lexsort(packed)
        del packed
        at = placed([spot[c] for c in cols[:3]], bits)[order]
        by_range = np.argsort(at.astype(np.uint16) if bits <= 16 else at, kind="stable")
        order, at = order[by_range], at[by_range]
        cols = [c[order] for c in cols]
        gained = None if gained is None else gained[order]
        for r, rows in ranges(at):
            yield r, depth, CountAutomaton.from_sorted(vocab, [c[rows] for c in cols], None if gained is None else gained[rows])


def pack(columns: list[np.ndarray]) -> np.ndarray:
    """Up to three labels of 21 bits in one number that sorts like them."""
    out = np.zeros(len(columns[0]), dtype=np.int64)
    for column in columns:
        out = out << 21 | column
    return out


def pair_keys(first: np.ndarray, second: np.ndarray, lang: str) -> np.ndarray:
    """A number for every pair of words, from the words' hashes and their language."""
    own = np.uint64(xxhash.xxh64_intdigest(lang.encode()))
    mixed = (first * np.uint64(0x9E3779B97F4A7C15)) ^ (second * np.uint64(0xC2B2AE3D27D4EB4F)) ^ own
    return mixed ^ mixed >> np.uint64(31)


def windows(codes: np.ndarray, keep: int, longest: int, joined: np.ndarray | None = None) -> list[np.ndarray]:
    """Columns: the word at every place but the last ``keep`` and those behind it, 0 from the end of the piece on.

    ``joined`` says whether the word at a place goes with the next one; windows end where it does not.
    """
    n = len(codes) - keep
    longer = np.concatenate((codes, np.zeros(longest, dtype=codes.dtype)))
    if joined is not None:
        joined = np.concatenate((joined, np.zeros(longest, dtype=bool)))
    columns = [codes[:n]]
    for k in range(1, longest):
        goes = columns[-1] > 0
        if joined is not None:
            goes &= joined[k - 1 : k - 1 + n]
        columns.append(longer[k : k + n] * goes)
    there = columns[min(2, longest - 1) if joined is not None else 0] > 0
    return [c[there] for c in columns]


def last_words(tokens: list[bytes]) -> list[bytes]:
    """The last words of the piece that the tokens end in, as many as a window reaches ahead."""
    found: list[bytes] = []
    for token in reversed(tokens):
        if token == b"\n" or len(found) == LONGEST - 1:
            break
        if token:
            found.append(token)
    return found[::-1]


class Shard:
    """Words of one language, numbered, with 0 between pieces."""

    def __init__(self, words: list[bytes]):
        self.restart(words)

    def restart(self, words: list[bytes]) -> None:
        self.labels = Labels()
        self.codes = [self.labels[w] for w in words]

    def add(self, text: bytes) -> Iterator[list[bytes]]:
        """Adds a text. Yields where the shard may be taken, with the words that then begin the next one."""
        tokens = text.translate(PLAIN).replace(b"\n", b" \n ").split(b" ")
        for a in range(0, len(tokens), SLICE):
            self.codes.extend(map(self.labels.__getitem__, tokens[a : a + SLICE]))
            if a + SLICE < len(tokens):
                yield last_words(tokens[: a + SLICE])
        self.codes.append(0)
        yield []

    def taken(self, keep: int, longest: int, lang: str, pairs: np.ndarray | None) -> tuple[list[bytes], list[np.ndarray]]:
        """Vocabulary in byte order and the windows; the last ``keep`` places wait for the words behind them."""
        vocab = self.labels.words()
        to = np.zeros(len(vocab) + 1, dtype=np.int32)
        to[[self.labels[w] for w in vocab]] = np.arange(1, len(vocab) + 1)
        codes = np.array(self.codes, dtype=np.int32)
        codes = to[codes[codes >= 0]]
        if pairs is None:
            return vocab, windows(codes, keep, longest)
        spot = np.concatenate((np.zeros(1, dtype=np.uint64), place(vocab)))[codes]
        keys = pair_keys(spot[:-1], spot[1:], lang)
        at = np.minimum(np.searchsorted(pairs, keys), max(len(pairs) - 1, 0))
        joined = pairs[at] == keys if len(pairs) else np.zeros(len(keys), dtype=bool)
        return vocab, windows(codes, keep, longest, joined)


def fragment(at: int, lang: str, depth: int, automaton: CountAutomaton) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([at], pa.int64()), pa.array([lang]), pa.array([depth], pa.int32()), pa.array([automaton.dump()], pa.binary())],
        names=["at", "lang", "depth", "payload"])


def shard_fragments(docs: DataFrame, bits: int, depths: tuple[int, ...], known: Broadcast | None = None) -> DataFrame:
    """Fragments (range, lang, depth, automaton) of the shards of (lang, text); ``known`` are the frequent pairs' keys, sorted."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shards: dict[str, Shard] = {}
        pairs = None if known is None else known.value

        def taken(current: str, tail: list[bytes]) -> Iterator[pa.RecordBatch]:
            for name in list(shards):
                vocab, columns = shards[name].taken(len(tail) if name == current else 0, max(depths), name, pairs)
                if name == current:
                    shards[name].restart(tail)
                else:
                    del shards[name]
                for r, depth, automaton in automata(vocab, columns, bits, depths=depths):
                    yield fragment(r, name, depth, automaton)

        held = 0
        for batch in batches:
            for name, value in zip(batch.column("lang").to_pylist(), batch.column("text").cast(pa.binary()), strict=True):
                body = value.as_py()
                if not body:
                    continue
                if name not in shards:
                    shards[name] = Shard([])
                before = len(shards[name].codes)
                for tail in shards[name].add(body):
                    held += len(shards[name].codes) - before
                    before = len(shards[name].codes)
                    if held >= SHARD_WORDS:
                        yield from taken(name, tail)
                        held = before = len(tail)
        yield from taken("", [])

    return docs.mapInArrow(read, FRAGMENT)


def loaded(group: pd.DataFrame) -> Iterator[tuple[str, int, CountAutomaton]]:
    """(lang, depth, union of the automata) of a range."""
    for (lang, depth), rows in group.groupby(["lang", "depth"], sort=True):
        yield lang, depth, CountAutomaton.union([CountAutomaton.load(bytes(p)) for p in rows["payload"]])


def split_further(fragments: DataFrame, coarse: int, fine: int) -> DataFrame:
    """The fragments of ``2 ** coarse`` ranges, united in groups of the size of a range and cut into finer ranges."""

    def cut(group: pd.DataFrame) -> pd.DataFrame:
        out = []
        for lang, depth, automaton in loaded(group):
            columns, counts = automaton.rows()
            out += [(r, lang, d, a.dump()) for r, d, a in automata(automaton.vocab, columns, fine, counts, (depth,))]
        return pd.DataFrame(out, columns=["at", "lang", "depth", "payload"])

    dealt = fragments.withColumn("salt", F.pmod(F.xxhash64("payload"), F.lit(1 << (fine - coarse))))
    return dealt.groupBy("at", "salt").applyInPandas(cut, FRAGMENT)


def united(fragments: DataFrame, now: int, bits: int, fan: int, least: int, name: str) -> DataFrame:
    """(lang, words, phrase, f) of all fragments: frequent phrases, and rows of 0 words that add up to a language's words."""
    step = fan.bit_length() - 1
    while now < bits:
        fragments = split_further(fragments, now, min(bits, now + step))
        now = min(bits, now + step)

    def unite(group: pd.DataFrame) -> pd.DataFrame:
        out = []
        for lang, depth, automaton in loaded(group):
            if depth == 1:
                out.append((lang, 0, None, int(automaton.weights[0].sum())))
            for k in range(min(depth, 3) - 1, depth):
                often = np.flatnonzero(automaton.weights[k] >= least)
                found = automaton.phrases(k, often)
                out += [(lang, k + 1, p.decode(), f) for p, f in zip(found, automaton.weights[k][often].tolist(), strict=True)]
        return pd.DataFrame(out, columns=["lang", "words", "phrase", "f"])

    return stage(fragments.groupBy("at").applyInPandas(unite, "lang string, words int, phrase string, f long"), name)


@F.pandas_udf(T.LongType())
def key_of_pair(lang: pd.Series, phrase: pd.Series) -> pd.Series:
    out = []
    for g, p in zip(lang, phrase, strict=True):
        a, b = (np.array([xxhash.xxh64_intdigest(w)], dtype=np.uint64) for w in p.encode().split(b" "))
        out.append(pair_keys(a, b, g).view(np.int64)[0])
    return pd.Series(out, dtype="int64")


def counted(
    docs: DataFrame, least: int = LEAST, range_bytes: int = RANGE_BYTES, fan: int = FAN, known_pairs: int = KNOWN_PAIRS
) -> DataFrame:
    """(lang, words, phrase, f) of (lang, text): phrases with at least ``least`` occurrences.

    Rows with ``words`` 0 add up to the number of words of the language.
    """
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    bits = max(0, (size // range_bytes).bit_length())
    first = min(bits, fan.bit_length() - 1)
    short = united(shard_fragments(docs, first, DEPTHS[:2]), first, bits, fan, least, "short")
    pairs = short.where("words = 2")
    known = None
    if pairs.count() <= known_pairs:
        keys = np.array(pairs.select(key_of_pair("lang", "phrase").alias("k")).toArrow()["k"], dtype=np.int64)  # at most known_pairs numbers
        known = docs.sparkSession.sparkContext.broadcast(np.sort(keys.view(np.uint64)))
    return short.unionByName(united(shard_fragments(docs, first, DEPTHS[2:], known), first, bits, fan, least, "long"))


def part_counts(asked: DataFrame, counts: DataFrame, n_words: int, n_asked: int) -> DataFrame:
    """``asked`` (lang, part, and what else) with the part's count ``f``; every part has one."""
    parts = counts.select("lang", F.col("phrase").alias("part"), "f")
    often = parts.where(F.col("f") * HOT_SHARE >= n_words)  # each length has HOT_SHARE of them at most
    named = asked.join(F.broadcast(often), ["lang", "part"], "left")
    easy = named.where(F.col("f").isNotNull())
    n_ranges = max(1, n_asked // ASKED_ROWS)
    spot = F.pmod(F.xxhash64("lang", "part"), F.lit(n_ranges))
    left = named.where(F.col("f").isNull()).drop("f").select(spot.alias("at"), "*")
    right = parts.where(F.col("f") * HOT_SHARE < n_words).select(
        spot.alias("entry_at"), F.col("lang").alias("entry_lang"), F.col("part").alias("entry"), F.col("f").alias("count"))
    columns = [*asked.columns, "f"]

    def compose(requests: pd.DataFrame, entries: pd.DataFrame) -> pd.DataFrame:
        done = []
        for lang, wanted in requests.groupby("lang"):
            have = entries[entries["entry_lang"] == lang]
            parts_of = [x.encode() for x in wanted["part"]]
            request, level, state = of_phrases(parts_of, np.ones(len(parts_of), dtype=np.int64), LONGEST)
            count, k, s = of_phrases([x.encode() for x in have["entry"]], np.zeros(len(have), dtype=np.int64), LONGEST)
            for depth in range(LONGEST):  # the weight of a sequence is its own count, not that of what it begins
                count.weights[depth][s[k == depth]] = have["count"].to_numpy()[k == depth]
            found = request.composed(count)
            f = np.empty(len(wanted), dtype=np.int64)
            for depth in range(LONGEST):
                f[level == depth] = found[depth][state[level == depth]]
            done.append(wanted.assign(f=f)[columns])
        return pd.concat(done) if done else pd.DataFrame(columns=columns)

    schema = named.select(*columns).schema
    return easy.select(*columns).unionByName(left.groupBy("at").cogroup(right.groupBy("entry_at")).applyInPandas(compose, schema))


def exact(a: Column, b: Column) -> Column:
    """Product of two counts as a whole number of up to 38 digits."""
    return a.cast("decimal(19,0)") * b.cast("decimal(18,0)")


def collocations(docs: DataFrame, text: str = "text", lang: str = "lang", least: int = LEAST, top: int = TOP, **sizes: int) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: the best phrases of each language.

    Null texts are empty, a null language is ``und``; texts without words give nothing, and an
    empty table gives no rows. Equal rows count as often as they stand there, and other
    columns are not read. Ties in the score go by count, then by the phrase's bytes.
    """
    chosen = docs.select(F.col(text).alias("text"), F.coalesce(F.col(lang).cast("string"), F.lit("und")).alias("lang"))
    counts = counted(chosen, least, **sizes)
    totals = counts.where("words = 0").groupBy("lang").agg(F.sum("f").alias("n"))
    size = counts.agg(
        F.sum(F.when(F.col("words") == 0, F.col("f"))), F.sum(F.when(F.col("words") > 1, 2 * (F.col("words") - 1)))).first()
    counts = counts.where("words > 0")
    words = F.split("phrase", " ", -1)
    cuts = counts.where("words > 1").select("lang", "phrase", F.col("f").alias("a"), "words", F.explode(F.sequence(F.lit(1), F.col("words") - 1)).alias("k"))
    head, rest = F.slice(words, F.lit(1), F.col("k")), F.slice(words, F.col("k") + 1, F.col("words"))
    asked = cuts.select(
        "lang", "phrase", "a", "words", "k",
        F.explode(F.array(F.struct(F.lit(0).alias("side"), F.array_join(head, " ").alias("part")),
                          F.struct(F.lit(1).alias("side"), F.array_join(rest, " ").alias("part")))).alias("p"),
    ).select("lang", "phrase", "a", "words", "k", "p.side", "p.part")
    answered = stage(part_counts(asked, counts, size[0] or 0, size[1] or 0), "parts")

    inner = ((F.col("side") == 0) & (F.col("k") == F.col("words") - 1)) | ((F.col("side") == 1) & (F.col("k") == 1))
    # a phrase inside a longer one with as many occurrences is inside one that is a word longer, too
    absorbed = answered.where(inner & (100 * F.col("a") >= 100 * F.col("f"))).select("lang", F.col("part").alias("phrase")).distinct()

    def at(k: int, side: int) -> Column:
        return F.max(F.when((F.col("k") == k) & (F.col("side") == side), F.col("f")))

    both = answered.groupBy("lang", "phrase", "a").agg(
        *[at(k, side).alias(f"{name}{k}") for k in range(1, LONGEST) for side, name in enumerate("lr")])
    whole = salted_lookup(both.join(absorbed, ["lang", "phrase"], "left_anti"), "lang", totals, ["phrase"])
    for k in range(1, LONGEST):
        whole = whole.withColumn(f"up{k}", exact(1000 * F.col("a"), F.col("n"))).withColumn(f"down{k}", exact(F.col(f"l{k}"), F.col(f"r{k}")))
    lowest = F.array_min(F.array_compact(F.array(*[
        F.when(F.col(f"l{k}").isNotNull(), F.struct(
            F.expr(f"up{k} div down{k}").alias("score"), F.lit(k).alias("k"), F.col(f"l{k}").alias("l"), F.col(f"r{k}").alias("r")))
        for k in range(1, LONGEST)])))
    scored = whole.select("lang", "phrase", "a", "n", lowest.alias("cut")).select("lang", "phrase", "a", "cut.l", "cut.r", "n", "cut.score")
    best = [F.col("score").desc(), F.col("a").desc(), F.col("phrase")]
    salted = scored.withColumn("salt", F.pmod(F.xxhash64("phrase"), F.lit(SALTS)))
    first = salted.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "salt").orderBy(*best))).where(F.col("rank") <= top)
    ranked = first.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*best)).cast("long"))
    return ranked.where(F.col("rank") <= top).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
