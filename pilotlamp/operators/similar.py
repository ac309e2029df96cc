"""Exact best-k names by edit distance and shared tokens, without scoring every pair.

Both sides are packed into blocks that meet block by block. Inside, a row orders the other block by an upper bound of the
score: the characters two texts have in common bound their edit distance, shared tokens count exactly. Scores are worked out
from the highest bound down, and the row is done when its k-th score beats the bound of all names not yet seen; the
threshold rises with every step. Edit distances of one text to many are computed together, a bit a character.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pilotlamp.operators import ordered

LEFT_ROWS, RIGHT_ROWS = 128, 4096
FIRST = 64  # names scored in the first step; each further one takes twice as many


@dataclass
class Facts:
    """What a score is made of, one number for each name of a block (or an upper bound of it)."""

    ratios: list[np.ndarray]
    contained: list[np.ndarray]  # one text lies in the other, neither is empty
    shared: np.ndarray
    marked: np.ndarray  # shared tokens that are marked
    tokens: tuple[int, np.ndarray]

    def at(self, rows: np.ndarray) -> Facts:
        return Facts([r[rows] for r in self.ratios], [c[rows] for c in self.contained], self.shared[rows], self.marked[rows], (self.tokens[0], self.tokens[1][rows]))


Score = Callable[[Facts], np.ndarray]


def distances(one: str, codes: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Edit distance of ``one`` to each text, given as rows of code points padded with zeros."""
    pattern = np.array([ord(c) for c in one], np.uint32)
    m, n = len(pattern), len(lengths)
    if m == 0:
        return lengths.astype(np.int64)
    if m > 64:
        return _by_rows(pattern, codes, lengths)
    full = np.uint64(0xFFFFFFFFFFFFFFFF)
    top, one_bit = np.uint64(1 << (m - 1)), np.uint64(1)
    alphabet = np.unique(pattern)
    masks = np.array([sum(1 << i for i in np.flatnonzero(pattern == c)) for c in alphabet], np.uint64)
    plus, minus, out = np.full(n, full), np.zeros(n, np.uint64), np.full(n, m, np.int64)
    for j in range(int(lengths.max(initial=0))):
        place = np.minimum(np.searchsorted(alphabet, codes[:, j]), len(alphabet) - 1)
        same = np.where(alphabet[place] == codes[:, j], masks[place], np.uint64(0))
        vertical = same | minus
        with np.errstate(over="ignore"):
            level = (((same & plus) + plus) ^ plus) | same
        up, down = minus | ~(level | plus), plus & level
        step = ((up & top) != 0).astype(np.int64) - ((down & top) != 0)
        out += np.where(lengths > j, step, 0)
        up, down = (up << one_bit) | one_bit, down << one_bit
        plus, minus = down | ~(vertical | up), up & vertical
    return out


def _by_rows(pattern: np.ndarray, codes: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The same for long texts: one row of the table a character, all texts at once."""
    steps = np.arange(codes.shape[1] + 1)
    row = np.broadcast_to(steps, (len(lengths), len(steps))).astype(np.int64)
    for i, c in enumerate(pattern):
        best = np.minimum(row[:, :-1] + (codes != c), row[:, 1:] + 1)
        first = np.full((len(lengths), 1), i + 1)
        # an insertion adds one to the cell before: a running minimum of cell less place
        row = np.minimum.accumulate(np.hstack([first, best]) - steps, axis=1) + steps
    return row[np.arange(len(lengths)), lengths]


class Block:
    """The names of a block as arrays: texts as code points, how often they hold each character, tokens as flat lists."""

    def __init__(self, texts: list[list[str]], tokens: list[list[str]]):
        self.texts = texts
        self.lengths = [np.array([len(t) for t in column], np.int64) for column in texts]
        self.codes, self.alphabets, self.counts = [], [], []
        for column, lengths in zip(texts, self.lengths, strict=True):
            width = max(1, int(lengths.max(initial=0)))
            codes = np.array([list(map(ord, t.ljust(width, "\0"))) for t in column], np.uint32).reshape(-1, width)
            real = np.arange(width) < lengths[:, None]
            alphabet, at = np.unique(codes[real], return_inverse=True)
            counts = np.zeros((len(column), max(1, len(alphabet))), np.int32)
            np.add.at(counts, (np.nonzero(real)[0], at), 1)
            self.codes.append(codes)
            self.alphabets.append({chr(c): i for i, c in enumerate(alphabet)})
            self.counts.append(counts)
        self.n_tokens = np.array([len(t) for t in tokens], np.int64)
        self.token_row = np.repeat(np.arange(len(tokens)), self.n_tokens)
        flat = [x for t in tokens for x in t]
        number: dict[str, int] = {}
        self.token = np.array([number.setdefault(x, len(number)) for x in flat], np.int64)
        self.number = number

    def _hits(self, tokens: list[str]) -> np.ndarray:
        wanted = np.zeros(len(self.number) + 1, bool)
        wanted[[self.number[t] for t in tokens if t in self.number]] = True
        return np.bincount(self.token_row[wanted[self.token]], minlength=len(self.n_tokens)) if len(self.token) else np.zeros(len(self.n_tokens), np.int64)

    def bounds(self, texts: list[str], tokens: list[str], marked: list[str]) -> Facts:
        ratios, contained = [], []
        for t, lengths, alphabet, counts in zip(texts, self.lengths, self.alphabets, self.counts, strict=True):
            common = np.zeros(len(lengths), np.int64)
            for c in set(t):
                if c in alphabet:
                    common += np.minimum(counts[:, alphabet[c]], t.count(c))
            longest = np.maximum(lengths, len(t))
            ratios.append(_ratio(longest - common, longest))
            shortest = np.minimum(lengths, len(t))
            contained.append((shortest > 0) & (common == shortest))
        return Facts(ratios, contained, self._hits(tokens), self._hits(marked), (len(tokens), self.n_tokens))

    def exact(self, texts: list[str], bound: Facts, rows: np.ndarray) -> Facts:
        out = bound.at(rows)
        for i, t in enumerate(texts):
            lengths = self.lengths[i][rows]
            out.ratios[i] = _ratio(distances(t, self.codes[i][rows], lengths), np.maximum(lengths, len(t)))
            for j in np.flatnonzero(out.contained[i]):
                other = self.texts[i][rows[j]]
                out.contained[i][j] = t in other or other in t
        return out


def _ratio(distance: np.ndarray, longest: np.ndarray) -> np.ndarray:
    return np.where(longest > 0, 1.0 - distance / np.maximum(longest, 1), 0.0)


def best_of(block: Block, texts: list[str], tokens: list[str], marked: list[str], score: Score, k: int) -> tuple[np.ndarray, np.ndarray, Facts, int]:
    """Rows of the ``k`` best names of a block, their scores and facts, and how many names were scored; ties go to the lower row."""
    bound = block.bounds(texts, tokens, marked)
    limit = score(bound)
    order = np.argsort(-limit, kind="stable")
    seen, at, size = np.zeros(0, np.int64), 0, FIRST
    scores = np.zeros(0)
    while at < len(order):
        if len(scores) >= k and limit[order[at]] < np.partition(scores, -k)[-k]:
            break
        rows = order[at:at + size]
        scores = np.append(scores, score(block.exact(texts, bound, rows)))
        seen, at, size = np.append(seen, rows), at + len(rows), 2 * size
    top = np.lexsort((seen, -scores))[:k]
    return seen[top], scores[top], block.exact(texts, bound, seen[top]), len(seen)


def best_k(left: DataFrame, right: DataFrame, texts: Sequence[str], tokens: str, score: Score, k: int, marked: str | None = None,
           left_rows: int = LEFT_ROWS, right_rows: int = RIGHT_ROWS) -> DataFrame:
    """``name, item, score, ratio, compared, place``: the ``k`` best right names of every left name, and how many names of
    their blocks were scored for it.

    Both sides have ``name`` (unique), the ``texts`` and an array ``tokens`` without repeats; ``marked`` names an array of those
    left tokens that count apart. ``score`` grows with ratios and shared tokens. ``ratio`` is that of the first text. Ties go to the
    lower name. Null texts and tokens are empty.
    """
    def packed(df: DataFrame, columns: Sequence[str], out: str, rows: int) -> DataFrame:
        kept = [F.coalesce(c, F.lit("") if c in texts else F.array().cast("array<string>")).alias(c) for c in columns]
        return ordered.pages(df, [], [("name", "asc")], F.struct("name", *kept), out, rows)

    marks = [marked] if marked else []
    asked = packed(left, [*texts, tokens, *marks], "asked", left_rows).withColumnRenamed("page", "asked_page")
    offered = packed(right, [*texts, tokens], "offered", right_rows)
    pages = -(-right.count() // right_rows)  # without any the lone page 0 meets nothing
    met = asked.withColumn("page", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(max(pages - 1, 0)).cast("long"))))
    met = ordered.spread(met.join(offered, "page"), "asked_page", "page").select("asked", "offered")
    schema = T.StructType().add("name", T.StringType()).add("item", T.StringType()).add("score", T.DoubleType()).add("ratio", T.DoubleType()).add("compared", T.LongType())

    def search(batches):
        for batch in batches:
            for row in range(batch.num_rows):
                them = batch.column(1)[row].as_py()
                block = Block([[x[t] for x in them] for t in texts], [x[tokens] for x in them])
                out = []
                for mine in batch.column(0)[row].as_py():
                    best, scores, facts, seen = best_of(block, [mine[t] for t in texts], mine[tokens], mine[marked] if marked else [], score, k)
                    out += [(mine["name"], them[i]["name"], float(s), float(r), seen) for i, s, r in zip(best, scores, facts.ratios[0], strict=True)]
                columns = list(zip(*out, strict=True)) or [[]] * 5
                yield pa.RecordBatch.from_arrays([pa.array(c, type=t) for c, t in zip(columns, [pa.string(), pa.string(), pa.float64(), pa.float64(), pa.int64()], strict=True)], schema.names)

    found = met.mapInArrow(search, schema)
    return ordered.top_in_groups(found, ["name"], [("score", "desc"), ("item", "asc")], k, "place")
