"""Benchmark decontamination: broadcast set of benchmark windows, scanned over the words of every document.

Nulls and empty texts have no words and are never contaminated. Repeated rows are judged one by one; benchmark
rows that share an ``item_id`` count as one item, a null ``item_id`` reads as the empty string. Columns of the
input pass through; one named like a result is replaced.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pilotlamp.llm.common import add_columns, words

WINDOW = 13
BLOCK_WORDS = 2_000_000  # benchmark words in one broadcast set, about 200 MB of Python objects
_BASE = np.uint64(0x9E3779B97F4A7C15)

HITS = T.StructType([
    T.StructField("n_words", T.LongType()),
    T.StructField("hits", T.ArrayType(T.IntegerType(), False)),
    T.StructField("items", T.ArrayType(T.StringType(), False)),
])


@dataclass
class WindowSet:
    """Windows of one block of benchmark items, by length; words are numbered from 1."""

    vocabulary: dict[bytes, int] = field(default_factory=dict)
    windows: dict[int, dict[tuple[int, ...], set[str]]] = field(default_factory=dict)
    hashes: dict[int, np.ndarray] = field(default_factory=dict)

    def add(self, item: str, tokens: list[bytes], size: int) -> None:
        ids = [self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in tokens]
        n = min(size, len(ids))
        for i in range(len(ids) - n + 1):
            self.windows.setdefault(n, {}).setdefault(tuple(ids[i:i + n]), set()).add(item)

    def freeze(self) -> WindowSet:
        for n, found in self.windows.items():
            self.hashes[n] = np.unique(_rolling(np.array(list(found), dtype=np.uint64).reshape(-1, n).T))
        return self


def _rolling(columns) -> np.ndarray:
    """Hash of windows given as one array for each place in the window."""
    total = None
    with np.errstate(over="ignore"):
        for c in columns:
            total = c.astype(np.uint64) if total is None else total * _BASE + c.astype(np.uint64)
    return total


def _blocks(benchmark: DataFrame, window: int, block_words: int) -> Iterator[WindowSet]:
    """The benchmark is the stated query set: it passes in blocks of bounded size."""
    rows = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")), F.encode("text", "utf-8"))
    block, size = WindowSet(), 0
    for item, text in rows.toLocalIterator():
        tokens = words(bytes(text) if text is not None else None)
        if not tokens:
            continue
        if size and size + len(tokens) > block_words:
            yield block.freeze()
            block, size = WindowSet(), 0
        block.add(item, tokens, window)
        size += len(tokens)
    yield block.freeze()


def _scan(block: WindowSet, texts: list[list[bytes]]) -> dict[int, tuple[set[int], set[str]]]:
    """By row: the places of hit words and the items met."""
    found: dict[int, tuple[set[int], set[str]]] = {}
    if not block.windows:
        return found
    get = block.vocabulary.get
    # one 0 after each text, so that no window reaches over the end of its text
    ids = np.fromiter((x for t in texts for x in (*(get(w, 0) for w in t), 0)), dtype=np.int64)
    starts = np.cumsum([0] + [len(t) + 1 for t in texts])
    unknown = np.concatenate([[0], np.cumsum(ids == 0)])
    for n, known in block.hashes.items():
        if len(ids) < n:
            continue
        at = np.flatnonzero(unknown[n:] == unknown[:-n])
        if not len(at):
            continue
        h = _rolling(ids[at + j] for j in range(n))
        place = np.minimum(np.searchsorted(known, h), len(known) - 1)
        for i in at[known[place] == h].tolist():
            items = block.windows[n].get(tuple(ids[i:i + n].tolist()))  # equal hashes are verified word by word
            if items:
                row = int(np.searchsorted(starts, i, side="right")) - 1
                places, met = found.setdefault(row, (set(), set()))
                places.update(range(i - int(starts[row]), i - int(starts[row]) + n))
                met |= items
    return found


def scan_windows(
    documents: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_words: int = BLOCK_WORDS, keep=None
) -> DataFrame:
    """``documents`` with ``n_words``, ``hits`` (places of words inside a benchmark window) and ``items`` met.

    An item of fewer than ``window`` words is one window. A benchmark above ``block_words`` is scanned in blocks,
    each with its own broadcast set, and the hits are united.
    """
    spark = documents.sparkSession
    out, more = documents, []
    passed = list(documents.columns if keep is None else keep)
    blocks = _blocks(benchmark, window, block_words)
    block = next(blocks)
    while block is not None:
        following = next(blocks, None)  # two blocks at most are held here
        shared = spark.sparkContext.broadcast(block)

        def judge(text, *before, shared=shared):
            texts = [words(t) for t in text.cast(pa.binary()).to_pylist()]
            found = _scan(shared.value, texts)
            hits, items = ([x.to_pylist() for x in before] if before else ([[] for _ in texts] for _ in range(2)))
            for row, (places, met) in found.items():
                hits[row] = sorted(places | set(hits[row]))
                items[row] = sorted(met | set(items[row]))
            return [pa.array(map(len, texts), pa.int64()), pa.array(hits, pa.list_(pa.int32())), pa.array(items, pa.list_(pa.string()))]

        scanned_again = following is not None and "text" not in passed
        out = add_columns(out, ["text", *more], judge, HITS, [*passed, "text"] if scanned_again else passed)
        block, more = following, ["hits", "items"]
    return out


def contaminated(share: int = 20):
    """Condition on the result of ``scan_windows``: at least one word in ``share`` is hit."""
    return (F.size("hits") > 0) & (F.size("hits") * share >= F.col("n_words"))


def drop_contaminated(documents: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """Documents that are not contaminated, with their own columns."""
    found = scan_windows(documents.withColumnsRenamed({c: f"_{c}" for c in ("n_words", "hits", "items") if c in documents.columns}), benchmark, window)
    return found.where(~contaminated()).drop("n_words", "hits", "items").withColumnsRenamed({f"_{c}": c for c in ("n_words", "hits", "items")})


_WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def cut_spans(documents: DataFrame, benchmark: DataFrame, window: int = WINDOW, mark: str = " ") -> DataFrame:
    """Documents with every run of hit words, from the first to the last word of the run, replaced by ``mark``."""

    def cut(text, hits):
        out = []
        for t, h in zip(text.to_pylist(), hits.to_pylist(), strict=True):
            if h:
                hit, kept, end, at = set(h), [], 0, [m.span() for m in _WORD.finditer(t)]
                for i in h:
                    if i - 1 not in hit:
                        kept += [t[end:at[i][0]], mark]
                    end = at[i][1]
                t = "".join([*kept, t[end:]])
            out.append(t)
        return [pa.array(out, pa.string())]

    found = scan_windows(documents, benchmark, window)
    names = [c for c in found.columns if c not in HITS.names]
    return add_columns(found, ["text", "hits"], cut, T.StructType([T.StructField("text", T.StringType())]), names).select(*names)


def digest(found: DataFrame) -> DataFrame:
    """The contract's columns from the result of ``scan_windows``."""
    return found.select(
        "doc_id", "n_words", F.size("hits").cast("long").alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), contaminated().alias("contaminated"),
    )
