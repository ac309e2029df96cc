"""Quality rules: statistics of the rules, and an isolation forest over them.

Two fixed rules fail a document at once: too few words, or too many words in repeated windows. For the others an isolation
forest judges how odd the statistics are together. Each tree splits a small sample at random values of random statistics until
rows are alone; odd rows are alone early, so a short mean path means an anomaly. The labelled rows set the anomaly score above which
documents go: the one that tells bad from good documents best.

The forest learns from ``TREES * ROWS`` distinct rows of statistics, drawn evenly by hash: a parameter of the method that does not grow.
The scores and the counts that calibrate the threshold cover all rows. Both fixed rules apply before: the forest neither learns from
nor judges what they fail.

Null texts have no words and fail. Whole texts of any length are read. Rows are judged one by one, so repeated ids and rows do
no harm; rows of equal statistics and id count once in the sample. An id that is null or has no label does not calibrate; an id with
several labels counts as bad if one is. Without labels of both kinds no threshold is known and only the fixed rules decide.
Columns of the input pass through; one named like a result is replaced. An empty table gives an empty result.
"""

from __future__ import annotations

import math
import string

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pilotlamp.llm.common import add_columns, col, without, word_codes
from pilotlamp.session import durable

TREES, ROWS, SEED = 100, 256, 20
LEAST_WORDS, WINDOW, MOST_REPEATED = 50, 3, 50  # words, words a window, percent
STEPS = 1000  # values the calibrated threshold may take

SYMBOLS = "#*$%&|<>"
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
FURTHER = ["n_lines", "n_distinct", "n_punctuation", "n_plain_words"]
STATISTICS = T.StructType([T.StructField(c, T.LongType()) for c in COUNTS + FURTHER] + [T.StructField("base_failed", T.BooleanType())])
VERDICT = T.StructType().add("anomaly", T.DoubleType())

_BLANKS = np.array([9, 10, 11, 12, 13, 32])
_SYMBOLS = np.frombuffer(SYMBOLS.encode(), np.uint8)
_MARKS = np.frombuffer(string.punctuation.encode(), np.uint8)
_LETTERS = bytes(b for b in range(256) if chr(b) in string.ascii_letters or b >= 0x80)
_NO_LETTERS = bytes(b for b in range(256) if b not in _LETTERS and b not in _BLANKS)


def repeated_words(codes: np.ndarray, window: int = WINDOW) -> int:
    """Words inside windows that occur twice or more, the first occurrence included."""
    n = len(codes) - window + 1
    if n < 2:
        return 0
    name = codes
    for i in range(1, window):  # windows one word longer each time, numbered anew
        _, name = np.unique(name[:len(codes) - i] * (codes.max() + 1) + codes[i:], return_inverse=True)
    twice = np.bincount(name)[name] > 1
    inside = np.zeros(len(codes), bool)
    for i in range(window):
        inside[i:i + n] |= twice
    return int(inside.sum())


def counts_of(text: bytes | None) -> list[int]:
    """``COUNTS`` and ``FURTHER`` of one text."""
    text = text or b""
    seen = np.bincount(np.frombuffer(text, np.uint8), minlength=256)
    words, codes = word_codes(text)
    lines = [line for line in text.split(b"\n") if line.strip()]
    characters = int(seen.sum() - seen[0x80:0xC0].sum() - seen[_BLANKS].sum())
    return [
        len(words), characters, int(seen[_SYMBOLS].sum()), len(lines) - len(set(lines)), repeated_words(codes),
        len(lines), int(codes.max()) + 1 if len(codes) else 0, int(seen[_MARKS].sum()), len(text.translate(None, _NO_LETTERS).split()),
    ]


def statistics(documents: DataFrame, keep=None) -> DataFrame:
    """``documents`` with the statistics of the rules and ``base_failed``, by one pass over the texts."""

    def judge(text):
        rows = np.array([counts_of(t) for t in text.cast(pa.binary()).to_pylist()], np.int64).reshape(-1, len(COUNTS + FURTHER))
        failed = (rows[:, 0] < LEAST_WORDS) | (100 * rows[:, 4] > MOST_REPEATED * rows[:, 0])
        return [*[pa.array(rows[:, i]) for i in range(rows.shape[1])], pa.array(failed)]

    return add_columns(documents, ["text"], judge, STATISTICS, keep)


def features(rows: np.ndarray) -> np.ndarray:
    """What the forest sees of each row of ``COUNTS`` and ``FURTHER``: shares and means, so that long texts are not odd as such."""
    words, chars, symbols, again, repeated, lines, distinct, marks, plain = (rows[:, i].astype(float) for i in range(9))
    n, c = np.maximum(words, 1), np.maximum(chars, 1)
    return np.column_stack([
        np.log2(1 + words), chars / n, symbols / c, symbols / n, marks / c, again / np.maximum(lines, 1), repeated / n, distinct / n, 1 - plain / n,
    ])


def mean_path(n: np.ndarray) -> np.ndarray:
    """Mean path length of an unsuccessful search in a random tree of ``n`` rows."""
    n = np.asarray(n, float)
    m = np.maximum(n, 2)
    return np.where(n < 2, 0.0, np.where(n == 2, 1.0, 2 * (np.log(np.maximum(m - 1, 1)) + 0.5772156649015329) - 2 * (m - 1) / m))


class Forest:
    """Random trees as flat arrays: the statistic (-1: leaf), the value, the left child (the right one follows), the path length of a leaf."""

    def __init__(self, sample: np.ndarray, trees: int = TREES, rows: int = ROWS, seed: int = SEED):
        self.rows = min(rows, len(sample))
        self.depth = max(1, math.ceil(math.log2(max(self.rows, 2))))
        rng = np.random.default_rng(seed)
        self.roots, self.nodes = [], []
        for _ in range(trees if len(sample) else 0):
            self.roots.append(len(self.nodes))
            self._grow(sample[rng.choice(len(sample), self.rows, replace=False)], rng)
        table = np.array(self.nodes, float).reshape(-1, 4)
        self.which, self.value, self.left, self.path = table[:, 0].astype(np.int64), table[:, 1], table[:, 2].astype(np.int64), table[:, 3]

    def _grow(self, sample: np.ndarray, rng) -> None:
        self.nodes.append(None)
        todo = [(len(self.nodes) - 1, sample, 0)]
        while todo:
            at, x, depth = todo.pop()
            low, high = x.min(0), x.max(0)
            varied = np.flatnonzero(high > low)
            if depth >= self.depth or not len(varied):
                self.nodes[at] = (-1, 0.0, at, depth + float(mean_path(len(x))))
                continue
            which = int(rng.choice(varied))
            value = rng.uniform(low[which], high[which])
            value = value if value > low[which] else high[which]  # both sides get rows
            self.nodes[at] = (which, value, len(self.nodes), 0.0)
            self.nodes += [None, None]
            small = x[:, which] < value
            todo += [(len(self.nodes) - 2, x[small], depth + 1), (len(self.nodes) - 1, x[~small], depth + 1)]

    def anomaly(self, x: np.ndarray) -> np.ndarray:
        """Score of each row: near 1 for rows alone at once, below one half for common ones; 0 without any tree."""
        if not self.roots:
            return np.zeros(len(x))
        total, row = np.zeros(len(x)), np.arange(len(x))
        for root in self.roots:
            at = np.full(len(x), root)
            for _ in range(self.depth):
                which = self.which[at]
                at = np.where(which < 0, at, self.left[at] + (x[row, np.maximum(which, 0)] >= self.value[at]))
            total += self.path[at]
        return 2.0 ** (-total / len(self.roots) / max(float(mean_path(self.rows)), 1e-9))


def draw(judged: DataFrame, rows: int) -> np.ndarray:
    """At most ``rows`` distinct rows of statistics that the fixed rules let pass, evenly by hash."""
    slim = judged.where("NOT base_failed").select("doc_id", *COUNTS, *FURTHER).distinct()
    slim = slim.withColumn("_draw", F.pmod(F.xxhash64(*map(col, slim.columns)), F.lit(1 << 40)))
    total = slim.count()
    if total > 2 * rows:  # what reaches the driver: about twice the rows wanted, whatever the size of the table
        slim = slim.where(F.col("_draw") < int((1 << 40) * 2 * rows / total))
    found = slim.select("_draw", *COUNTS, *FURTHER).toArrow()
    table = np.column_stack([found.column(c).to_numpy() for c in ["_draw", *COUNTS, *FURTHER]]).astype(np.int64).reshape(-1, 1 + len(COUNTS + FURTHER))
    return table[np.lexsort(table.T[::-1])][:rows, 1:]


def calibrate(counts: list[tuple[int, bool, int]]) -> float | None:
    """Score from which documents go, from ``(step, bad, rows)``: most bad less most good ones above it, the highest if several are best."""
    bad, good = np.zeros(STEPS + 2), np.zeros(STEPS + 2)
    for step, is_bad, n in counts:
        (bad if is_bad else good)[step] += n
    if not bad.sum() or not good.sum():
        return None
    above = lambda x: np.cumsum(x[::-1])[::-1] / x.sum()
    gain = above(bad) - above(good)
    return float(STEPS + 1 - np.argmax(gain[::-1])) / STEPS


def judge(documents: DataFrame, labels: DataFrame, trees: int = TREES, rows: int = ROWS, keep=None) -> DataFrame:
    """``documents`` with the statistics, ``base_failed``, ``anomaly`` (0 to 1, null if a fixed rule fails) and ``kept``.

    ``labels`` has ``doc_id`` and ``quality`` (0: bad).
    """
    kept = without(documents.columns if keep is None else keep, [*STATISTICS.names, "anomaly", "kept"])
    extra = [c for c in kept if c.lower() != "doc_id"]
    judged = durable(statistics(documents, ["doc_id", *extra]))
    forest = Forest(features(draw(judged, trees * rows)), trees, rows)

    def score(*columns):
        table = np.column_stack([c.to_numpy(zero_copy_only=False) for c in columns[:-1]])
        failed = columns[-1].to_numpy(zero_copy_only=False).astype(bool)
        out = np.full(len(table), np.nan)
        if (~failed).any():
            out[~failed] = forest.anomaly(features(table[~failed]))
        return [pa.array(out, mask=failed)]

    scored = durable(add_columns(judged, [*COUNTS, *FURTHER, "base_failed"], score, VERDICT))
    # equal ids are counted before they meet the labels: one id on most rows is one row for each step
    step = F.floor(F.col("anomaly") * STEPS).cast("int")
    by_id = scored.where("NOT base_failed AND doc_id IS NOT NULL").groupBy("doc_id", step.alias("step")).agg(F.count("*").alias("n"))
    marks = labels.where("doc_id IS NOT NULL AND quality IS NOT NULL").groupBy("doc_id").agg((F.min("quality") == 0).alias("bad"))
    counts = by_id.join(marks, "doc_id").groupBy("step", "bad").agg(F.sum("n").alias("n")).collect()
    limit = calibrate([(r.step, r.bad, r.n) for r in counts])
    passes = F.lit(True) if limit is None else F.floor(F.col("anomaly") * STEPS) < F.lit(round(limit * STEPS))
    return scored.withColumn("kept", ~F.col("base_failed") & passes).select(*map(col, kept), *STATISTICS.names, "anomaly", "kept")


def digest(judged: DataFrame) -> DataFrame:
    """The contract's columns from the result of ``judge``."""
    return judged.select("doc_id", *COUNTS, "base_failed", "kept", "anomaly")
