"""Plain versions of the text operators for comparison."""

from __future__ import annotations

import hashlib
import html
import math
import re
import zlib
from collections import Counter, defaultdict

import xxhash

SPACES = "\x20\x09\x0a\x0b\x0c\x0d"
WORD = re.compile(rf"[^{SPACES}]+")


def words(text):
    return WORD.findall(text or "")


def fingerprint(text):
    tokens = words("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    if not tokens:
        return 0
    shingles = [" ".join(tokens[i : i + 3]) for i in range(max(1, len(tokens) - 2))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


def component_ids(prints):
    """{fp: root fp} under links of at most two differing bits, all pairs."""
    root = {p: p for p in prints}

    def find(p):
        while root[p] != p:
            p = root[p]
        return p

    nodes = sorted(root)
    for i, a in enumerate(nodes):
        for b in nodes[i + 1 :]:
            if (a ^ b).bit_count() <= 2:
                root[find(a)] = find(b)
    return {p: find(p) for p in nodes}


def near_duplicates(docs):
    """Rows (id, hex, component id) of (id, text) pairs."""
    return sorted(near_duplicates_odd(docs))


def near_duplicates_odd(docs):
    """As near_duplicates, in the order given (ids may be null)."""
    prints = [(d, fingerprint(t)) for d, t in docs]
    root, least = component_ids({p for _, p in prints}), {}
    for d, p in prints:
        if d is not None:
            least[root[p]] = min(d, least.get(root[p], d))
    return [(d, f"{p:016x}", least.get(root[p])) for d, p in prints]


def quality(text):
    w = words(text)
    windows = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
    n, seen = Counter(windows), set()
    for i, x in enumerate(windows):
        if n[x] > 1:
            seen |= {i, i + 1, i + 2}
    lines = [x for x in (text or "").split("\n") if words(x)]
    base_failed = len(w) < 50 or 100 * len(seen) > 50 * len(w)
    return (
        len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(seen), base_failed)


def unit_hash(*parts):
    return (int(hashlib.md5(":".join(map(str, parts)).encode()).hexdigest()[:13], 16) + 0.5) / 2**52


def shard(key, n):
    return min((-math.log(unit_hash("shard", i, key)), i) for i in range(n))[1]


def crc(text):
    return zlib.crc32((text or "").encode())


def copies(docs):
    """{id: number of copies} of (id, text, source) rows with equal weights."""
    size = defaultdict(int)
    for _, t, s in docs:
        size[s] += len((t or "").encode()) + 1
    out = {}
    for d, t, s in docs:
        rate = sum(size.values()) / len(size) / size[s]
        parts = max(1, math.ceil(rate / 64))
        n = 0
        for i in range(1, parts + 1):
            u, p = unit_hash("mix", i, d, hashlib.md5((t or "").encode()).hexdigest()), math.exp(-rate / parts)
            c, k = p, 0
            while u >= c and k < 1000:
                k += 1
                p *= rate / parts / k
                c += p
            n += k
        out[d] = n
    return out


PATTERNS = (
    ("assign", r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 1, 12),
    ("access", r"AKIA[A-Z0-9]+", 0, 18),
    ("hex", r"[0-9a-f]+", 0, 16),
)


def base_spans(text):
    found = []
    for order, (kind, pattern, group, least) in enumerate(PATTERNS):
        found += [(m.start(), order, kind, m.end()) for m in re.finditer(pattern, text or "", re.ASCII) if len(m.group(group)) >= least]
    return [(k, a, b) for a, _, k, b in sorted(found)]


def article(page):
    """Text of the article element of a generated page."""
    m = re.search(r"<article>(.*?)(</article>|<footer|\Z)", page or "", re.S)
    text = re.sub(r"</?(p|h1|br)>", " ", m.group(1)) if m else ""
    return " ".join(html.unescape(re.sub(r"<[^>]*>", "", text)).split())
