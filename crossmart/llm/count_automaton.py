"""Weighted acyclic automata that map word sequences to counts, kept as arrays, one set a level.

State ``i`` of level ``k`` is reached from state ``parents[k][i]`` of the level above by the
word ``vocab[labels[k][i]]``, and ``weights[k][i]`` is the count of the sequence read so far.
States of a level are sorted by (parent, label), so a transition is found by binary search.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa

CODEC = "zstd"


def keyed(parents: np.ndarray, labels: np.ndarray) -> np.ndarray:
    return parents.astype(np.int64) << 32 | labels.astype(np.int64)


class CountAutomaton:
    def __init__(self, vocab: list[bytes], labels: list[np.ndarray], parents: list[np.ndarray], weights: list[np.ndarray]):
        self.vocab, self.labels, self.parents, self.weights = vocab, labels, parents, weights

    @classmethod
    def from_sorted(cls, vocab: list[bytes], columns: list[np.ndarray], counts: np.ndarray | None = None) -> CountAutomaton:
        """From sorted sequences, a row each: column k has the k-th word's label plus 1, or 0 behind the end.

        A row adds the states behind its longest common prefix with the row before; the
        states it shares gain its count. Whole columns are added at once.
        """
        n = len(columns[0])
        labels, parents, weights = [], [], []
        new, above = np.zeros(n, dtype=bool), np.zeros(n, dtype=np.int64)
        for column in columns:
            new[:1] = True
            new[1:] |= column[1:] != column[:-1]
            live = column > 0
            first = new & live
            at = np.cumsum(first) - 1
            starts = np.flatnonzero(first[live])
            gained = np.ones(n, dtype=np.int64) if counts is None else counts
            labels.append((column[first] - 1).astype(np.uint32))
            parents.append(above[first].astype(np.uint32))
            weights.append(np.add.reduceat(gained[live], starts) if len(starts) else np.zeros(0, dtype=np.int64))
            above = at
        return cls(vocab, labels, parents, weights)

    @classmethod
    def union(cls, parts: list[CountAutomaton]) -> CountAutomaton:
        """All sequences of all parts; weights of equal sequences are summed."""
        vocab = sorted(set().union(*(p.vocab for p in parts)))
        index = {w: i for i, w in enumerate(vocab)}
        renamed = [np.array([index[w] for w in p.vocab], dtype=np.int64) for p in parts]
        moved = [np.zeros(1, dtype=np.int64) for _ in parts]
        labels, parents, weights = [], [], []
        for k in range(max(len(p.labels) for p in parts)):
            here = [(i, p) for i, p in enumerate(parts) if k < len(p.labels)]
            keys = np.concatenate([keyed(moved[i][p.parents[k]], renamed[i][p.labels[k]]) for i, p in here])
            order = np.argsort(keys, kind="stable")
            keys = keys[order]
            first = np.ones(len(keys), dtype=bool)
            first[1:] = keys[1:] != keys[:-1]
            starts = np.flatnonzero(first)
            gained = np.concatenate([p.weights[k] for _, p in here])[order]
            weights.append(np.add.reduceat(gained, starts) if len(starts) else gained)
            labels.append((keys[starts] & 0xFFFFFFFF).astype(np.uint32))
            parents.append((keys[starts] >> 32).astype(np.uint32))
            state = np.empty(len(keys), dtype=np.int64)
            state[order] = np.cumsum(first) - 1
            ends = np.cumsum([len(p.labels[k]) for _, p in here])
            for (i, _), part in zip(here, np.split(state, ends[:-1]), strict=True):
                moved[i] = part
        return cls(vocab, labels, parents, weights)

    def columns(self, level: int, states: np.ndarray) -> list[np.ndarray]:
        """Labels of the paths that lead to states of a level, word by word."""
        found = []
        for k in range(level, -1, -1):
            found.append(self.labels[k][states])
            states = self.parents[k][states]
        return found[::-1]

    def phrases(self, level: int, states: np.ndarray) -> list[bytes]:
        columns = [[self.vocab[x] for x in c.tolist()] for c in self.columns(level, states)]
        return [b" ".join(words) for words in zip(*columns, strict=True)]

    def rows(self) -> tuple[list[np.ndarray], np.ndarray]:
        """The sequences that end here, as columns for :meth:`from_sorted` (unsorted), and their counts."""
        columns, counts = [[] for _ in self.labels], []
        for k, weight in enumerate(self.weights):
            own = weight.copy()
            if k + 1 < len(self.weights):
                np.subtract.at(own, self.parents[k + 1], self.weights[k + 1])
            ending = np.flatnonzero(own)
            path = self.columns(k, ending)
            for i, column in enumerate(columns):
                column.append(path[i].astype(np.int32) + 1 if i <= k else np.zeros(len(ending), dtype=np.int32))
            counts.append(own[ending])
        return [np.concatenate(c) for c in columns], np.concatenate(counts)

    def composed(self, counts: CountAutomaton) -> list[np.ndarray]:
        """Composition with ``counts``: the weight it gives to every state of this one, 0 where it has no such path."""
        index = {w: i for i, w in enumerate(counts.vocab)}
        renamed = np.array([index.get(w, -1) for w in self.vocab], dtype=np.int64)
        state, out = np.zeros(1, dtype=np.int64), []
        for k in range(len(self.labels)):
            above, label = state[self.parents[k]], renamed[self.labels[k]]
            have = keyed(counts.parents[k], counts.labels[k]) if k < len(counts.labels) else np.zeros(0, dtype=np.int64)
            want = above << 32 | np.maximum(label, 0)
            at = np.minimum(np.searchsorted(have, want), max(len(have) - 1, 0))
            hit = (above >= 0) & (label >= 0) & (have[at] == want if len(have) else False)
            state = np.where(hit, at, -1)
            out.append(np.where(hit, counts.weights[k][at], 0) if len(have) else np.zeros(len(want), dtype=np.int64))
        return out

    def dump(self) -> bytes:
        """Packed, with the words that occur only."""
        used = np.zeros(len(self.vocab), dtype=bool)
        for column in self.labels:
            used[column] = True
        renamed = (np.cumsum(used) - 1).astype("<u4")
        words = b"\n".join([self.vocab[i] for i in np.flatnonzero(used).tolist()])
        sizes = [len(words), *[len(c) for c in self.labels]]
        wide = any(len(w) and int(w.max()) >= 1 << 32 for w in self.weights)
        body = [np.array([len(sizes), wide, *sizes], dtype="<u8").tobytes(), words]
        for label, parent, weight in zip(self.labels, self.parents, self.weights, strict=True):
            steps = np.diff(parent.astype(np.int64), prepend=0).astype("<i4")  # mostly 0 and 1, which pack well
            body += [renamed[label].tobytes(), steps.tobytes(), weight.astype("<u8" if wide else "<u4").tobytes()]
        raw = b"".join(body)
        return len(raw).to_bytes(8, "little") + pa.compress(raw, codec=CODEC, asbytes=True)

    @classmethod
    def load(cls, packed: bytes) -> CountAutomaton:
        raw = pa.decompress(packed[8:], int.from_bytes(packed[:8], "little"), codec=CODEC, asbytes=True)
        n, wide = np.frombuffer(raw, "<u8", 2).tolist()
        length, *sizes = np.frombuffer(raw, "<u8", n, 16).tolist()
        at = 16 + 8 * n
        vocab, at = raw[at : at + length].split(b"\n"), at + length
        labels, parents, weights = [], [], []
        for size in sizes:
            labels.append(np.frombuffer(raw, "<u4", size, at))
            parents.append(np.cumsum(np.frombuffer(raw, "<i4", size, at + 4 * size).astype(np.int64)))
            weights.append(np.frombuffer(raw, "<u8" if wide else "<u4", size, at + 8 * size).astype(np.int64))
            at += (16 if wide else 12) * size
        return cls(vocab, labels, parents, weights)


def of_phrases(phrases: Iterable[bytes], counts: Iterable[int], longest: int) -> tuple[CountAutomaton, np.ndarray, np.ndarray]:
    """Automaton of phrases of up to ``longest`` words, and the level and state of every phrase."""
    split = [p.split(b" ") for p in phrases]
    vocab = sorted({w for words in split for w in words})
    index = {w: i + 1 for i, w in enumerate(vocab)}
    rows = np.zeros((len(split), longest), dtype=np.int64)
    for i, words in enumerate(split):
        rows[i, : len(words)] = [index[w] for w in words]
    order = np.lexsort(rows.T[::-1])
    ordered = rows[order]
    automaton = CountAutomaton.from_sorted(vocab, list(ordered.T), np.fromiter(counts, dtype=np.int64, count=len(split))[order])
    level = np.empty(len(split), dtype=np.int64)
    state = np.empty(len(split), dtype=np.int64)
    new = np.zeros(len(split), dtype=bool)
    for k in range(longest):
        column = ordered[:, k]
        new[:1] = True
        new[1:] |= column[1:] != column[:-1]
        at = np.cumsum(new & (column > 0)) - 1
        live = column > 0
        level[order[live]], state[order[live]] = k, at[live]
    return automaton, level, state


def ranges(of: np.ndarray) -> Iterator[tuple[int, slice]]:
    """(value, rows) of every run of equal values."""
    if len(of):
        starts = np.flatnonzero(np.concatenate(([True], of[1:] != of[:-1])))
        for a, b in zip(starts.tolist(), [*starts[1:].tolist(), len(of)], strict=True):
            yield int(of[a]), slice(a, b)
