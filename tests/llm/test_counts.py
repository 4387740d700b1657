"""Phrase mining, MinHash near-dedup and the filter audit against plain versions."""

import itertools
import random
from collections import Counter, defaultdict

import numpy as np
import pytest

from crossmart.llm import filter_audit, minhash, phrases
from crossmart.llm.count_automaton import CountAutomaton, of_phrases

SPACES = "\x20\x09\x0a\x0b\x0c\x0d"
DOCS = "doc_id long, text string, lang string, words int, phrase string, node string, part string, n int, row int, id int"


def table(spark, rows, parts=3):
    return spark.createDataFrame([(d, t, g, 7, "x", "y", "z", 1, 2, 3) for d, t, g in rows], DOCS).repartition(parts)


def lowered(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def split(text, at):
    out, now = [], ""
    for c in text:
        if c in at:
            out.append(now)
            now = ""
        else:
            now += c
    return [x for x in [*out, now] if x]


ODD = [
    (1, None, "en"), (2, "", None), (3, " \t\n", "en"), (4, "one", None), (5, "one two", "en"), (6, "a b c d", "en"),
    (6, "a b c d", "en"), (7, "ÄÖ ü x 日本語 😀 end", "日"), (8, "word " * 30_000, "en"), (None, "no id here at all", "en"),
    (None, "no id here at all", "en"), (9, "a\x0bb\x0cc\rd", "en"), (10, "A B C D", "en"), (11, "x\x1cy\xa0z\x85w", ""),
]


# --- phrases ------------------------------------------------------------------------------


def plain_phrases(rows, least, top):
    f, n = Counter(), Counter()
    for _, text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in split(lowered(text), ".,;:!?\n\x0b\x0c\r"):
            words = split(piece, " \t")
            n[lang] += len(words)
            for i in range(len(words)):
                for m in range(1, 6):
                    if i + m <= len(words):
                        f[lang, tuple(words[i : i + m])] += 1
    cand = {p: a for p, a in f.items() if len(p[1]) > 1 and a >= least}
    out = defaultdict(list)
    for (lang, p), a in cand.items():
        longer = [q for q in cand if q[0] == lang and len(q[1]) > len(p) and 100 * cand[q] >= 100 * a]
        if any(q[1][i : i + len(p)] == p for q in longer for i in range(len(q[1]) - len(p) + 1)):
            continue
        score, _, l, r = min((1000 * a * n[lang] // (f[lang, p[:k]] * f[lang, p[k:]]), k, f[lang, p[:k]], f[lang, p[k:]]) for k in range(1, len(p)))
        out[lang].append((-score, -a, " ".join(p).encode(), l, r))
    return sorted((g, i, p.decode(), -a, l, r, n[g], -s) for g, rows in out.items() for i, (s, a, p, l, r) in enumerate(sorted(rows)[:top], 1))


def corpus(seed, size):
    rng = random.Random(seed)
    words = ["the", "The", "of", "new", "york", "zürich", "a", "b", "é", "x" * 30]
    join = [" ", " ", " ", "  ", "\t", ", ", ". ", "\n", "!"]
    return [(i, "".join(w + rng.choice(join) for w in rng.choices(words, k=rng.randrange(40))), rng.choice(["en", "de", None])) for i in range(size)]


@pytest.mark.parametrize("sizes", [{}, {"range_bytes": 400, "known_pairs": 0}, {"range_bytes": 300, "fan": 4}])
def test_phrases_match_plain_counts(spark, sizes):
    rows = corpus(1, 120) + ODD
    got = phrases.collocations(table(spark, rows), least=4, top=60, **sizes)
    assert sorted(map(tuple, got.collect())) == plain_phrases(rows, 4, 60)


def test_shards_cut_long_texts_without_losing_windows(spark, monkeypatch):
    rows = corpus(2, 30) + [(99, "new york of the " * 400 + "a b " * 300, "en")]
    monkeypatch.setattr(phrases, "SLICE", 37)
    monkeypatch.setattr(phrases, "SHARD_WORDS", 101)
    got = phrases.collocations(table(spark, rows), least=3, top=500)
    assert sorted(map(tuple, got.collect())) == plain_phrases(rows, 3, 500)


def test_phrases_of_nothing(spark):
    assert phrases.collocations(table(spark, ODD).where("false")).count() == 0
    assert phrases.collocations(table(spark, ODD[:5])).count() == 0


def test_scores_beyond_64_bits(spark, monkeypatch):
    rows = [(1, "a b " * 5 + "c a c", "en")]
    real = phrases.counted

    def grown(*args, **sizes):
        counts = real(*args, **sizes)
        return counts.selectExpr("lang", "words", "phrase", "f * 100000000000 AS f")

    monkeypatch.setattr(phrases, "counted", grown)
    got = phrases.collocations(table(spark, rows), least=2).collect()
    big = 10**11
    a, n, l, r = 5 * big, 13 * big, 6 * big, 5 * big
    assert ("a b", 1000 * a * n // (l * r)) in {(x["phrase"], x["score"]) for x in got}


def test_automata_keep_counts():
    rng = random.Random(5)
    seqs = [tuple(rng.choices("abcd", k=rng.randrange(1, 6))) for _ in range(400)]
    parts = [seqs[:100], seqs[100:101], seqs[101:]]
    built = [of_phrases([" ".join(s).encode() for s in p], [1] * len(p), 5)[0] for p in parts]
    whole = CountAutomaton.load(CountAutomaton.union([CountAutomaton.load(b.dump()) for b in built]).dump())
    want = Counter(s[:k] for s in seqs for k in range(1, len(s) + 1))
    got = {}
    for k, weights in enumerate(whole.weights):
        for p, w in zip(whole.phrases(k, np.arange(len(weights))), weights.tolist(), strict=True):
            got[tuple(p.decode().split(" "))] = w
    assert got == want
    columns, counts = whole.rows()
    ends = Counter()
    for row, c in zip(zip(*columns, strict=True), counts.tolist(), strict=True):
        ends[tuple(whole.vocab[x - 1].decode() for x in row if x)] += c
    assert ends == Counter(seqs)
    asked, level, state = of_phrases([b"a", b"a b", b"zz", b"a zz b", b"d c b a"], [1] * 5, 5)
    found = asked.composed(whole)
    assert [int(found[k][s]) for k, s in zip(level, state, strict=True)] == [want["a",], want["a", "b"], 0, 0, want["d", "c", "b", "a"]]


# --- MinHash ------------------------------------------------------------------------------


def shingle_set(text):
    w = split(lowered(text), SPACES)
    return {tuple(w)} if 0 < len(w) < 3 else {tuple(w[i : i + 3]) for i in range(len(w) - 2)}


def plain_near(rows):
    sets = [shingle_set(t) for _, t, _ in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, j in itertools.combinations(range(len(rows)), 2):
        both = len(sets[i] & sets[j])
        if sets[i] and sets[j] and 100 * both >= 85 * (len(sets[i]) + len(sets[j]) - both):
            root[find(i)] = find(j)
    least = {}
    for i, (d, _, _) in enumerate(rows):
        if d is not None:
            least[find(i)] = min(d, least.get(find(i), d))
    out = []
    for i, (d, _, _) in enumerate(rows):
        c = least.get(find(i))
        out.append((d, len(sets[i]), c, c is None or d == c))
    return out


def family(rng, words, size, edits):
    base = [f"w{rng.randrange(5000)}" for _ in range(words)]
    out = [base]
    while len(out) < size:
        copy = list(rng.choice(out))
        for _ in range(edits):
            copy[rng.randrange(words)] = f"e{rng.randrange(10**6)}"
        out.append(copy)
    return [" ".join(x) for x in out]


def test_near_duplicates_match_all_pairs(spark):
    rng = random.Random(4)
    texts = family(rng, 120, 60, 1) + family(rng, 100, 40, 3) + family(rng, 60, 30, 1) + [t.upper() for t in family(rng, 40, 5, 0)]
    texts += [" ".join(f"w{rng.randrange(300)}" for _ in range(50)) for _ in range(60)]
    rng.shuffle(texts)
    rows = [(i, t, "en") for i, t in enumerate(texts)] + [(500, texts[3], "de")]
    got = sorted(map(tuple, minhash.near_duplicates(table(spark, rows)).collect()))
    assert got == sorted(plain_near(rows))


def test_near_duplicates_of_odd_rows(spark):
    got = minhash.near_duplicates(table(spark, ODD)).collect()
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, plain_near(ODD)))
    assert minhash.near_duplicates(table(spark, ODD).where("false")).count() == 0
    assert minhash.near_duplicates(table(spark, ODD[:3])).count() == 3


def test_crowded_buckets_join_components_that_their_pivot_does_not(spark):
    rng = random.Random(8)
    texts = family(rng, 200, 90, 6)  # a drifting family: most pairs are not similar, their chain is
    rows = [(i, t, "en") for i, t in enumerate(texts)]
    got = sorted(map(tuple, minhash.near_duplicates(table(spark, rows)).collect()))
    assert got == sorted(plain_near(rows))


def test_copies_that_are_not_similar_enough_do_not_meet_each_other(spark, monkeypatch):
    """Copies of one text that share bands but no link: looking at all of their pairs would take 44,850."""
    rng, seen = random.Random(12), []
    base = [f"w{i}" for i in range(150)]
    texts = [" ".join(base)]
    while len(texts) < 300:
        copy, edits = list(base), rng.randrange(3, 9)
        for at in rng.sample(range(150), edits):
            copy[at] = f"e{rng.randrange(10**9)}"
        texts.append(" ".join(copy))
    rows = [(i, t, "en") for i, t in enumerate(texts)]
    confirmed = minhash.confirmed
    monkeypatch.setattr(minhash, "confirmed", lambda pairs, *rest: (seen.append(pairs.count()), confirmed(pairs, *rest))[1])
    got = sorted(map(tuple, minhash.near_duplicates(table(spark, rows)).collect()))
    assert got == sorted(plain_near(rows))
    assert sum(seen) < 3000


def test_signature_agreement_estimates_similarity():
    rng = random.Random(1)
    a = [str(rng.randrange(10**6)).encode() for _ in range(600)]
    b = a[:450] + [str(rng.randrange(10**6)).encode() for _ in range(150)]
    hashes = minhash.WordHashes()
    x, y = (minhash.signature(minhash.scattered(w, hashes), 2000) for w in (a, b))
    s, t = minhash.shingles(a), minhash.shingles(b)
    assert abs((x == y).mean() - len(s & t) / len(s | t)) < 0.05


# --- filter audit -------------------------------------------------------------------------


def plain_audit(rows, labels):
    judged = []
    for d, text, lang in rows:
        text = text or ""
        w = split(text, SPACES)
        fails = {"A": len(w) < 100, "B": 100 * len(set(w)) < 80 * len(w), "C": 100 * sum("A" <= c <= "Z" for c in text) > 10 * len(text),
                 "D": any(c in "#$%&*|" for c in text),
                 "E": d is not None and any(o is not None and o < d and (t or "") == text for o, t, _ in rows)}
        judged.append((lang or "", fails, any(d is not None and i == d and q == 1 for i, q, _ in labels),
                       any(d is not None and i == d and x == 1 for i, _, x in labels)))
    out = []
    for part in {j[0] for j in judged}:
        docs = [j for j in judged if j[0] == part]
        removed_by, steps = Counter(), []
        for order in itertools.permutations("ABCDE"):
            for step, f in enumerate(order, 1):
                before = [j for j in docs if not any(j[1][g] for g in order[: step - 1])]
                hit = [j for j in before if j[1][f]]
                removed_by[f] += len(hit)
                steps.append((part, "".join(order), step, len(before) - len(hit), len(hit), sum(j[1][f] for j in docs) - len(hit),
                              sum(j[1][f] and sum(j[1].values()) == 1 for j in docs), sum(j[2] for j in hit), sum(j[3] for j in hit), f))
        out += [(*s[:-1], removed_by[s[-1]]) for s in steps]
    return sorted(out)


def test_audit_matches_plain_orders(spark):
    rng = random.Random(6)
    rows = list(ODD)
    for i in range(60):
        text = " ".join(rng.choice(["alpha", "BETA", "c", f"w{rng.randrange(500)}", "50%"][: rng.randrange(1, 6)]) for _ in range(rng.randrange(200)))
        rows += [(100 + i, text, rng.choice(["en", "de", None]))] * rng.randrange(1, 3) + [(rng.choice([None, 300 + i]), text, "fr")] * rng.randrange(2)
    labels = [(d, rng.choice([0, 1, None]), rng.randrange(2)) for d in range(0, 400, 2)] + [(100, 1, 0), (100, 0, 1), (None, 1, 1)]
    said = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got = sorted(map(tuple, filter_audit.interactions(table(spark, rows), said).collect()))
    assert got == plain_audit(rows, labels)
    assert filter_audit.interactions(table(spark, rows).where("false"), said).count() == 0


def test_path_counts_give_each_filter_every_order():
    weights = filter_audit.edge_weights(5)
    assert len(weights) == 80
    for i in range(5):
        assert sum(w for (_, k), w in weights.items() if k == i) == 120
