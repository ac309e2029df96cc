"""Periodic runs of words by recursive frequency splitting.

A run is a stretch of consecutive words with smallest period ``q`` (words ``q`` apart are identical) of at least
``max(shortest, repeats * q)`` words that no neighbouring word extends. Every word of a run occurs at least ``repeats`` times
in it, so a word that is rarer than that within a segment lies in no run and splits the segment. Splitting goes on
until every segment is left with frequent words only; mostly nothing is left. The surviving segments are scanned lag by lag:
a run of period ``q`` covers ``repeats - 1`` blocks between multiples of ``q``, so comparing neighbouring blocks by prefix
hashes finds it, then both ends are moved word by word and the run is compared exactly. A scan takes n log n steps.

Null texts and texts without words have no runs and collapse to empty text. Rows are judged one by one: repeated ids and rows
do no harm. Words are separated by blanks, tabs and line ends only. Columns of the input pass through; one named like a
result is replaced. An empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from pilotlamp.llm.common import add_columns, word_codes

REPEATS, SHORTEST = 4, 6  # a run holds its period so often, and so many words
_RUN = T.StructType().add("start", T.LongType()).add("length", T.LongType()).add("period", T.LongType())
RESULT = T.StructType().add("n_words", T.LongType()).add("runs", T.ArrayType(_RUN)).add("collapsed", T.StringType())
_BASE = np.uint64(0x9E3779B97F4A7C15)


def split_rare(codes: np.ndarray, repeats: int = REPEATS, shortest: int = SHORTEST) -> list[tuple[int, int]]:
    """Segments ``(begin, end)`` in which every word occurs at least ``repeats`` times, in order."""
    settled = []
    at = np.arange(len(codes))  # places of the segments that still change
    segment = np.zeros(len(codes), np.int64)
    width = int(codes.max()) + 1 if len(codes) else 1
    while len(at):
        _, which, count = np.unique(segment * width + codes[at], return_inverse=True, return_counts=True)
        rare = count[which] < repeats
        changed = np.zeros(int(segment[-1]) + 1, bool)
        changed[segment[rare]] = True
        edge = np.flatnonzero(segment[1:] != segment[:-1]) + 1
        begins, ends = np.append(0, edge), np.append(edge, len(at))
        for i in np.flatnonzero(~changed[segment[begins]]):
            settled.append((int(at[begins[i]]), int(at[ends[i] - 1]) + 1))
        left = changed[segment] & ~rare
        at, segment = at[left], segment[left]
        if len(at):
            fresh = np.append(0, np.cumsum((at[1:] != at[:-1] + 1) | (segment[1:] != segment[:-1])))
            long_enough = np.bincount(fresh)[fresh] >= shortest
            at, fresh = at[long_enough], fresh[long_enough]
            segment = np.cumsum(np.append(0, fresh[1:] != fresh[:-1])) if len(at) else fresh
    return sorted(settled)


def _exact(codes: np.ndarray, q: int, low: int, high: int) -> list[tuple[int, int]]:
    """Maximal stretches of period ``q`` that meet ``[low, high)``, word by word: for the case that two hashes collide."""
    same = np.flatnonzero(np.diff(np.concatenate([[False], codes[:-q] == codes[q:], [False]]).astype(np.int8)))
    return [(int(s), int(e) + q) for s, e in same.reshape(-1, 2) if s < high and e + q > low]


class _Known:
    """Runs found so far, by their ends."""

    def __init__(self):
        self.period: dict[tuple[int, int], int] = {}
        self._sorted: list[np.ndarray] | None = None

    def add(self, begin: int, end: int, q: int) -> None:
        if (begin, end) not in self.period:
            self.period[begin, end] = q
            self._sorted = None

    def covered(self, low: np.ndarray, high: np.ndarray, q: int) -> np.ndarray:
        """Is the stretch inside a run whose period divides ``q``? Looks at the nearest runs only; a no costs time, not truth."""
        out = np.zeros(len(low), bool)
        if not self.period:
            return out
        if self._sorted is None:
            ends = np.array(sorted((b, e, p) for (b, e), p in self.period.items()))
            self._sorted = [ends[:, 0], ends[:, 1], ends[:, 2]]
        begins, ends, periods = self._sorted
        last = np.searchsorted(begins, low, side="right") - 1
        for back in range(4):
            i = last - back
            ok = i >= 0
            i = np.maximum(i, 0)
            out |= ok & (ends[i] >= high) & (q % periods[i] == 0)
        return out


def scan(codes: np.ndarray, repeats: int = REPEATS, shortest: int = SHORTEST) -> list[tuple[int, int, int]]:
    """All runs ``(start, length, period)`` of one segment, every lag up to a ``repeats``-th of it tried."""
    m = len(codes)
    with np.errstate(over="ignore"):
        value = (codes.astype(np.uint64) + np.uint64(1)) * np.uint64(0xBF58476D1CE4E5B9)
        value = (value ^ (value >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
        power = np.cumprod(np.append(np.uint64(1), np.full(m, _BASE)))
        prefix = np.append(np.uint64(0), np.cumsum((value ^ (value >> np.uint64(32))) * power[:m]))
    known, span = _Known(), repeats - 2
    for q in range(1, m // repeats + 1):
        h = prefix[::q]
        blocks = h[span:] - h[:-span]
        hits = np.flatnonzero(blocks[:-1] * power[q] == blocks[1:])
        if not len(hits):
            continue
        edge = np.flatnonzero(hits[1:] != hits[:-1] + 1)
        low = hits[np.append(0, edge + 1)] * q
        high = (hits[np.append(edge, len(hits) - 1)] + span + 1) * q
        new = ~known.covered(low, high, q)
        for a, b in zip(low[new].tolist(), high[new].tolist(), strict=True):
            first = max(0, a - q)
            apart = np.flatnonzero(codes[first:a] != codes[first + q:a + q])
            begin = first + int(apart[-1]) + 1 if len(apart) else first
            last = min(b + q, m)
            apart = np.flatnonzero(codes[b - q:last - q] != codes[b:last])
            end = b + int(apart[0]) if len(apart) else last
            if (begin, end) in known.period:
                continue
            true = np.array_equal(codes[begin:end - q], codes[begin + q:end])
            for s, e in [(begin, end)] if true else _exact(codes, q, a, b):
                if e - s >= max(shortest, repeats * q):
                    known.add(s, e, q)
    return sorted((s, e - s, q) for (s, e), q in known.period.items())


def runs_of(codes: np.ndarray, repeats: int = REPEATS, shortest: int = SHORTEST) -> list[tuple[int, int, int]]:
    """All runs ``(start, length, period)`` of a text, by start, then period."""
    found = []
    for a, b in split_rare(codes, repeats, shortest):
        found += [(a + s, n, q) for s, n, q in scan(codes[a:b], repeats, shortest)]
    return sorted(found, key=lambda r: (r[0], r[2]))


def kept_words(n: int, runs: list[tuple[int, int, int]]) -> np.ndarray:
    """Which of ``n`` words stay when every run is cut after its first period."""
    change = np.zeros(n + 1, np.int64)
    for s, length, q in runs:
        change[s + q] += 1
        change[s + length] -= 1
    return np.cumsum(change[:n]) == 0


def find_runs(documents: DataFrame, repeats: int = REPEATS, shortest: int = SHORTEST, keep=None) -> DataFrame:
    """``documents`` with ``n_words``, ``runs`` (by start, then period) and ``collapsed``: the words that no run repeats,
    joined by one blank. ``repeats`` is 3 at least. ``keep`` names the columns that go on (all by default).
    """
    if repeats < 3 or shortest < 1:
        raise ValueError("a run repeats its period three times at least and has a word")

    def judge(text):
        sizes, offsets, flat, out = [], [0], [], []
        for t in text.cast(pa.binary()).to_pylist():
            words, codes = word_codes(t)
            runs = runs_of(codes, repeats, shortest)
            sizes.append(len(words))
            flat += runs
            offsets.append(len(flat))
            out.append(b" ".join([words[i] for i in np.flatnonzero(kept_words(len(words), runs))] if runs else words))
        columns = np.array(flat, np.int64).reshape(-1, 3)
        values = pa.StructArray.from_arrays([pa.array(columns[:, i]) for i in range(3)], _RUN.names)
        return [pa.array(sizes, pa.int64()), pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), values), pa.array(out, pa.binary()).cast(pa.string())]

    return add_columns(documents, ["text"], judge, RESULT, keep)
