"""Katz backoff over word pairs, learnt from and applied to a whole corpus.

Good-Turing discounted pair counts give the probability of a pair that the training rows hold; otherwise the word's own discounted
probability times the history's backoff weight, which is set so that all words, an unknown one included, sum to one. One
unseen event is added to every total, so a history always leaves mass.

Pairs are dealt to parts by their word; words that fill a large share of the tokens are dealt by the whole pair. A map task packs
the pairs of some thousand documents for each part, with the documents they occur in. A part's packs are merged
into one row of the pair table: runs of words, their histories and counts, and the occurrences. Word counts and count
statistics come from this table; backoff weights are summed by history into a second one. Scores are summed for the
documents of each map batch. Words are known by 64-bit hashes.

Null and empty texts consist of the end token. A row with a null ``doc_id`` is held out. Repeated rows count and are scored one
by one. Columns other than the id are not returned. An empty table gives no rows; without training rows every word is
unknown and its probability is one.
"""

from __future__ import annotations

import math
import pickle
from contextlib import contextmanager
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pilotlamp.llm.common import col
from pilotlamp.llm.ngram_join import _mix
from pilotlamp.session import durable

PART_CHARS = 12_000_000  # characters of the corpus for one part, about 2 million tokens
PACK_BYTES = 10_000_000  # text packed together: larger packs shuffle less and need more memory
MAX_COUNT = 5  # counts above are not discounted
SAMPLE = 0.02  # share of the rows in which frequent words are looked for; it decides on the layout only
START, END = np.uint64(1), np.uint64(2)
_LOWER = bytes(b + 32 if 0x41 <= b <= 0x5A else b for b in range(256))
_STEP = np.uint64(0x9E3779B97F4A7C15)
_PACK = "part int, batch long, data binary"
_TABLE = (
    "part int, batch long, docs binary, words array<long>, pairs array<int>, histories array<long>, history array<int>, counts array<int>,"
    " occurrences binary, pair_counts array<long>, word_counts array<long>, n_words long, n_tokens long, often array<long>, often_counts array<long>"
)


class _Words(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) > 100_000:  # a cache only
            self.clear()
            self[None] = int(END)
        h = self[word] = xxhash.xxh64_intdigest(word)
        return h


_WORD = _Words({None: int(END)})


def tokens(text: bytes | None) -> list[bytes | None]:
    """Words between blanks, A-Z in lower case, then the end token."""
    return [*text.translate(_LOWER).split(), None] if text else [None]


class _Planes:
    """An array by byte planes, and as differences where it is sorted 64-bit hashes: what repeats then stands together."""

    def __init__(self, x: np.ndarray):
        self.kind, self.rising = x.dtype, x.dtype == np.uint64
        x = np.diff(x, prepend=np.uint64(0)) if self.rising else np.ascontiguousarray(x)
        self.data = x.view(np.uint8).reshape(-1, x.itemsize).T.tobytes()

    def array(self) -> np.ndarray:
        x = np.ascontiguousarray(np.frombuffer(self.data, np.uint8).reshape(self.kind.itemsize, -1).T).view(self.kind).ravel()
        return np.cumsum(x, dtype=np.uint64) if self.rising else x


def _pack(*parts) -> bytes:
    packed = [_Planes(x) if isinstance(x, np.ndarray) and x.itemsize > 1 and x.dtype.kind == "u" else x for x in parts]
    return zstandard.ZstdCompressor(level=1).compress(pickle.dumps(packed, protocol=5))


def _unpack(data: bytes) -> list:
    return [x.array() if isinstance(x, _Planes) else x for x in pickle.loads(zstandard.ZstdDecompressor().decompress(data))]


def _small(x: np.ndarray) -> np.ndarray:
    top = int(x.max()) if len(x) else 0
    return x.astype(np.uint8 if top < 2**8 else np.uint16 if top < 2**16 else np.uint32 if top < 2**32 else np.uint64)


def _place(word: np.ndarray, history: np.ndarray, often: np.ndarray) -> np.ndarray:
    """Sort key of pairs; a part is a range of it."""
    place = _mix(word)
    if len(often):
        hot = often[np.minimum(np.searchsorted(often, word), len(often) - 1)] == word
        with np.errstate(over="ignore"):
            place[hot] = _mix(word[hot] * _STEP + history[hot])
    return place


def _edges(*columns: np.ndarray) -> np.ndarray:
    """First places of runs of equal rows."""
    if not len(columns[0]):
        return np.zeros(0, np.int64)
    new = np.zeros(len(columns[0]), bool)
    new[0] = True
    for c in columns:
        new[1:] |= c[1:] != c[:-1]
    return np.flatnonzero(new)


def _slices(batch: pa.RecordBatch, text: int):
    """Slices of about ``PACK_BYTES`` of text."""
    size = np.cumsum(pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False))
    at = 0
    while at < batch.num_rows:
        stop = max(at + 1, int(np.searchsorted(size, (size[at - 1] if at else 0) + PACK_BYTES, side="right")))
        yield batch.slice(at, stop - at)
        at = stop


def _packs(documents: DataFrame, parts: int, often: np.ndarray) -> DataFrame:
    """Pairs of every Arrow batch by part; part -1 has the documents of the batch."""

    def run(batches):
        task, seq = TaskContext.get().partitionId(), 0
        for b in batches:
            for part in _slices(b, 2):
                yield pack(part, (task << 24) + seq)  # the same when the task is run again
                seq += 1

    def pack(b, number):
        held = b.column(1).to_numpy(zero_copy_only=False).astype(bool)
        found = []
        for at in range(0, b.num_rows, 200):  # words live as objects for a few documents only
            texts = [tokens(t) for t in b.column(2).slice(at, 200).cast(pa.binary()).to_pylist()]
            found.append((np.fromiter(map(len, texts), np.int64, len(texts)), np.fromiter((_WORD[w] for t in texts for w in t), np.uint64)))
        n, word = (np.concatenate([f[i] for f in found]) for i in (0, 1))
        del found, texts
        history = np.empty_like(word)
        history[1:] = word[:-1]
        history[np.cumsum(n) - n] = START
        place = _place(word, history, often)
        order = np.lexsort((history, place))
        place = place[order]
        bounds = np.searchsorted(((place >> np.uint64(32)) * np.uint64(parts)) >> np.uint64(32), np.arange(parts + 1, dtype=np.uint64))
        del place
        word, history = word[order], history[order]
        doc = np.repeat(np.arange(len(n), dtype=np.uint32), n)[order]
        del order
        rows = [(-1, _pack(b.column(0).to_pylist(), np.packbits(held), _small(n)))]
        for p in range(parts):
            w, h, d = (x[bounds[p]:bounds[p + 1]] for x in (word, history, doc))
            if not len(w):
                continue
            first = _edges(w, h)
            words, wi = np.unique(w[first], return_inverse=True)
            histories, hi = np.unique(h[first], return_inverse=True)
            rows.append((p, _pack(words, _small(wi), histories, _small(hi), _small(np.diff(np.append(first, len(w)))), _small(d), np.packbits(held), len(n))))
        return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int32()), pa.array([number] * len(rows), pa.int64()), pa.array([r[1] for r in rows], pa.binary())], ["part", "batch", "data"])

    return documents.select("doc_id", "held_out", "text").mapInArrow(run, _PACK)


def _merge(packs: DataFrame, parts: int, often: np.ndarray) -> DataFrame:
    """The pair table: one row for each part, and one with the documents of each batch."""

    def run(batches):
        part, held = None, []
        for b in batches:
            for p, batch, data in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if p == -1:
                    yield row(part=-1, batch=batch, docs=data)
                    continue
                if p != part and held:
                    yield merged(part, held)
                    held = []
                part = p
                held.append((batch, data))
        if held:
            yield merged(part, held)

    def row(**values):
        return pa.RecordBatch.from_arrays([pa.array([values.get(n)], k) for n, k in _KINDS.items()], list(_KINDS))

    def merged(part, held):
        word, history, trained, packs = [], [], [], []
        while held:
            batch, data = held.pop(0)
            words, wi, histories, hi, times, docs, bits, n = _unpack(data)
            out = np.unpackbits(bits, count=n)
            first = np.cumsum(times.astype(np.int64)) - times
            word.append(words[wi])
            history.append(histories[hi])
            trained.append(np.add.reduceat(1 - out[docs].astype(np.int32), first))
            packs.append((batch, times, docs, bits, n))
        size = [len(w) for w in word]
        word, history, trained = (np.concatenate(x) for x in (word, history, trained))
        order = np.lexsort((history, _place(word, history, often)))
        word, history = word[order], history[order]
        first = _edges(word, history)
        mine = np.empty(len(word), np.uint32)
        mine[order] = np.repeat(np.arange(len(first), dtype=np.uint32), np.diff(np.append(first, len(word))))
        count = np.add.reduceat(trained[order], first)
        del order, trained
        word, history = word[first], history[first]
        run_at = _edges(word)
        run_word, run_count = word[run_at], np.add.reduceat(count.astype(np.int64), run_at)
        runs = np.diff(np.append(run_at, len(word)))
        del word, first
        hot = np.isin(run_word, often)
        cold = run_count[~hot]
        often_words, inverse = np.unique(run_word[hot], return_inverse=True)
        histories, hi = np.unique(history, return_inverse=True)
        del history
        at, kept = 0, []
        for n, (batch, times, docs, bits, docs_n) in zip(size, packs, strict=True):
            index = mine[at:at + n]  # rising: packs and table are in one order
            kept.append(_pack(batch, _small(np.diff(index, prepend=np.uint32(0))), times, docs, bits, docs_n))
            at += n
        del mine, packs
        of = lambda c: np.bincount(np.minimum(c, MAX_COUNT + 2), minlength=MAX_COUNT + 3)[1:MAX_COUNT + 2]
        return row(
            part=part, words=run_word.view(np.int64), pairs=runs, histories=histories.view(np.int64), history=hi.astype(np.int32),
            counts=count, occurrences=pickle.dumps(kept, protocol=5), pair_counts=of(count), word_counts=of(cold), n_words=int((cold > 0).sum()), n_tokens=int(cold.sum()),
            often=often_words.view(np.int64), often_counts=np.bincount(inverse, weights=run_count[hot], minlength=len(often_words)).astype(np.int64),
        )

    to = F.when(F.col("part") >= 0, F.col("part")).otherwise(F.pmod("batch", F.lit(parts))).cast("int")  # one part a task
    dealt = packs.withColumn("to", to).repartitionById(parts, "to").sortWithinPartitions("part", "batch")
    return dealt.drop("to").mapInArrow(run, _TABLE)


_KINDS = {
    "part": pa.int32(), "batch": pa.int64(), "docs": pa.binary(), "words": pa.list_(pa.int64()), "pairs": pa.list_(pa.int32()),
    "histories": pa.list_(pa.int64()), "history": pa.list_(pa.int32()), "counts": pa.list_(pa.int32()), "occurrences": pa.binary(),
    "pair_counts": pa.list_(pa.int64()), "word_counts": pa.list_(pa.int64()), "n_words": pa.int64(), "n_tokens": pa.int64(),
    "often": pa.list_(pa.int64()), "often_counts": pa.list_(pa.int64()),
}


def discounts(count_of: list[int]) -> np.ndarray:
    """Factors of the counts 0 to ``MAX_COUNT + 1``, the last for all above, by Good and Turing as Katz scales them.

    Where the counts of counts give no factor between 0 and 1, half an event is taken off.
    """
    n = [0, *count_of]
    factor = np.ones(MAX_COUNT + 2)
    above = (MAX_COUNT + 1) * n[MAX_COUNT + 1] / n[1] if n[1] else 1.0
    for r in range(1, MAX_COUNT + 1):
        d = ((r + 1) * n[r + 1] / (r * n[r]) - above) / (1 - above) if n[r] and above < 1 else 0.0
        factor[r] = d if 0 < d < 1 else (r - 0.5) / r
    return factor


@dataclass
class Model:
    """What tasks need beside the tables: a few numbers and the counts of the most frequent words."""

    pair_factor: np.ndarray
    word_factor: np.ndarray
    n_tokens: int
    n_words: int
    n_docs: int
    often: np.ndarray
    often_counts: np.ndarray
    unknown: float = 0.0

    def discounted(self, counts: np.ndarray, factor: np.ndarray) -> np.ndarray:
        return counts * factor[np.minimum(counts, MAX_COUNT + 1)]

    def word_probability(self, counts: np.ndarray) -> np.ndarray:
        known = self.discounted(counts, self.word_factor) / (self.n_tokens + 1)
        return np.where(counts > 0, known, self.unknown)

    def word_counts(self, words: np.ndarray, pairs: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """Training count of the word of each run."""
        if not len(words):
            return np.zeros(0, np.int64)
        own = np.add.reduceat(counts, np.cumsum(pairs) - pairs)
        if len(self.often):
            at = np.minimum(np.searchsorted(self.often, words), len(self.often) - 1)
            own = np.where(self.often[at] == words, self.often_counts[at], own)
        return own


def _arrays(batch: pa.RecordBatch, names: list[str], i: int) -> list[np.ndarray]:
    return [batch.column(n)[i].values.to_numpy(zero_copy_only=False) for n in names]


def _columns(batch, i):
    words, pairs, histories, history, counts = _arrays(batch, ["words", "pairs", "histories", "history", "counts"], i)
    return words.view(np.uint64), pairs.astype(np.int64), histories.view(np.uint64), history, counts.astype(np.int64)


@contextmanager
def _shuffle_files_dropped(spark):
    """Shuffle files of what is written meanwhile go as soon as it is written."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, "false")
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def train(documents: DataFrame) -> tuple[DataFrame, DataFrame, Model]:
    """Pair table, backoff table (``history, log_weight``) and model from ``doc_id, held_out, text``.

    Rows that are held out are in the pair table with their occurrences, but add to no count.
    """
    spark = documents.sparkSession
    chars, n_docs = documents.agg(F.sum(F.char_length("text")), F.count_if(~F.col("held_out"))).first()
    parts = max(12, -(-(chars or 0) // PART_CHARS))
    seen = documents.sample(SAMPLE, seed=1).select(F.explode(F.split(F.lower(F.coalesce("text", F.lit(""))), "[ \\t-\\r]+")).alias("w"))
    seen = seen.groupBy("w").count()
    total = seen.agg(F.sum("count")).first()[0] or 0
    # a frequent word fills a quarter of a part; there are four times as many such words as parts at most
    frequent = [r["w"] for r in seen.where((F.col("count") > max(50, total / (4 * parts))) & (F.col("w") != "")).select("w").collect()]
    often = np.array(sorted({int(END), *(xxhash.xxh64_intdigest(w.encode()) for w in frequent)}), np.uint64)
    with _shuffle_files_dropped(spark):  # the packs are as large as the table made of them
        table = durable(_merge(_packs(documents, parts, often), parts, often))
    sums = table.where("part >= 0").select(
        *[F.sum(F.element_at("pair_counts", i + 1)).alias(f"p{i}") for i in range(MAX_COUNT + 1)],
        *[F.sum(F.element_at("word_counts", i + 1)).alias(f"w{i}") for i in range(MAX_COUNT + 1)], F.sum("n_words").alias("words"), F.sum("n_tokens").alias("tokens"),
    ).first().asDict()
    each = table.where("part >= 0").select(F.explode(F.arrays_zip("often", "often_counts")).alias("o")).groupBy("o.often").agg(F.sum("o.often_counts").alias("n"))
    hot = {int(np.int64(r["often"]).view(np.uint64)): r["n"] for r in each.collect()}
    counts = np.array([hot.get(int(w), 0) for w in often], np.int64)
    word_of = [(sums[f"w{i}"] or 0) + int((counts == i + 1).sum()) for i in range(MAX_COUNT + 1)]
    model = Model(
        discounts([sums[f"p{i}"] or 0 for i in range(MAX_COUNT + 1)]), discounts(word_of), (sums["tokens"] or 0) + int(counts.sum()),
        (sums["words"] or 0) + int((counts > 0).sum()), n_docs or 0, often, counts,
    )
    lost = sum((1 - model.word_factor[r]) * r * word_of[r - 1] for r in range(1, MAX_COUNT + 1))
    model.unknown = (1 + lost) / (model.n_tokens + 1)
    shared = spark.sparkContext.broadcast(model)

    def weigh(batches):
        model = shared.value
        for b in batches:
            for i in range(b.num_rows):
                words, pairs, histories, history, counts = _columns(b, i)
                p = np.repeat(model.word_probability(model.word_counts(words, pairs, counts)), pairs)
                seen = counts > 0
                h = history[seen]
                sums = [np.bincount(h, weights=x[seen], minlength=len(histories)) for x in (counts, model.discounted(counts, model.pair_factor), p)]
                some = np.flatnonzero(sums[0])
                yield pa.RecordBatch.from_pydict({"history": histories[some].view(np.int64), "n": sums[0][some], "kept": sums[1][some], "covered": sums[2][some]})

    columns = table.where("part >= 0").select("words", "pairs", "histories", "history", "counts")
    partial = columns.mapInArrow(weigh, "history long, n double, kept double, covered double")
    weights = partial.groupBy("history").agg(F.sum("n").alias("n"), F.sum("kept").alias("kept"), F.sum("covered").alias("covered"))
    backoff = durable(weights.select("history", F.log10((F.col("n") + 1 - F.col("kept")) / F.greatest(1 - F.col("covered"), F.lit(1e-12))).alias("log_weight")))
    return table, backoff, model


def score(documents: DataFrame, folds: int = 10) -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score`` of every row; fold 0 by crc32 of the id is held out."""
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % folds, F.lit(0)) == 0
    rows = documents.select(col("doc_id").cast("long").alias("doc_id"), held.alias("held_out"), F.col("text"))
    table, backoff, model = train(rows)
    shared = rows.sparkSession.sparkContext.broadcast(model)

    def known_terms(batches):
        """Sums of all terms but the backoff weights, for the documents of each batch."""
        model = shared.value
        for b in batches:
            for i in range(b.num_rows):
                words, pairs, histories, history, counts = _columns(b, i)
                c = model.word_counts(words, pairs, counts)
                base = np.log10((c + 0.1) / (model.n_tokens + 0.1 * (model.n_words + 1)))
                after = np.where((c > 0) & (words != END), -np.log10(c + 1.0), 0.0)  # as the history of the next word
                of_run = np.repeat(np.arange(len(words)), pairs)
                with np.errstate(divide="ignore"):
                    term = np.where(counts > 0, np.log10(np.maximum(model.discounted(counts, model.pair_factor), 1e-300)), np.log10(model.word_probability(c))[of_run])
                term = term + after[of_run] - np.where(histories[history] == START, math.log10(model.n_docs + 1), 0.0)
                out = []
                for batch, step, times, docs, _bits, n in map(_unpack, pickle.loads(b.column("occurrences")[i].as_py())):
                    pair = np.repeat(np.cumsum(step.astype(np.int64)), times)
                    r = of_run[pair]
                    values = [np.bincount(docs, weights=x, minlength=n) for x in (term[pair], base[r], c[r] > 0)]
                    out.append((batch, _pack(values[0], values[1], _small(values[2].astype(np.int64)))))
                yield sums_batch([o[0] for o in out], 1, data=[o[1] for o in out])

    def unseen(batches):
        """Histories of pairs that training lacks, with the documents they occur in."""
        for b in batches:
            for i in range(b.num_rows):
                _, _, histories, history, counts = _columns(b, i)
                for batch, step, times, docs, _bits, _n in map(_unpack, pickle.loads(b.column("occurrences")[i].as_py())):
                    pair = np.repeat(np.cumsum(step.astype(np.int64)), times)
                    new = counts[pair] == 0
                    if new.any():
                        h = histories[history[pair[new]]].view(np.int64)
                        yield pa.RecordBatch.from_arrays([pa.array(h), pa.array(np.full(len(h), batch)), pa.array(docs[new].astype(np.int32))], ["history", "batch", "doc"])

    parts = table.where("part >= 0").select("words", "pairs", "histories", "history", "counts", "occurrences")
    known = parts.mapInArrow(known_terms, _SUMS)
    asked = parts.mapInArrow(unseen, "history long, batch long, doc int").groupBy("history", "batch", "doc").agg(F.count("*").alias("n"))
    more = asked.join(backoff, "history").groupBy("batch", "doc").agg(F.sum(F.col("n") * F.col("log_weight")).alias("value"))
    more = more.select("batch", F.lit(2).alias("kind"), "doc", "value", F.lit(None).cast("binary").alias("data"))
    listed = table.where("part = -1").select("batch", F.lit(0).alias("kind"), F.lit(None).cast("int").alias("doc"), F.lit(None).cast("double").alias("value"), F.col("docs").alias("data"))
    every = listed.unionByName(known).unionByName(more).repartition("batch").sortWithinPartitions("batch", "kind")

    def add(batches):
        state = None
        for b in batches:
            for batch, kind, doc, value, data in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if kind == 0:
                    if state:
                        yield finish(state)
                    ids, bits, n = _unpack(data)
                    state = (ids, np.unpackbits(bits, count=len(ids)).astype(bool), n.astype(np.int64), np.zeros(len(ids)), np.zeros(len(ids)), np.zeros(len(ids), np.int64))
                elif kind == 1:
                    s, base, some = _unpack(data)
                    state[3][:] += s
                    state[4][:] += base
                    state[5][:] += some.astype(np.int64)
                else:
                    state[3][doc] += value
        if state:
            yield finish(state)

    def finish(state):
        ids, held, n, s, base, some = state
        arrays = [pa.array(ids, pa.int64()), pa.array(held), pa.array(n), pa.array(some), pa.array(np.full(len(ids), shared.value.n_tokens)), pa.array(base), pa.array(s)]
        return pa.RecordBatch.from_arrays(arrays, ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    return every.mapInArrow(add, "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")


_SUMS = "batch long, kind int, doc int, value double, data binary"


def sums_batch(batch: list[int], kind: int, data: list[bytes]) -> pa.RecordBatch:
    n = len(batch)
    return pa.RecordBatch.from_arrays(
        [pa.array(batch, pa.int64()), pa.array([kind] * n, pa.int32()), pa.nulls(n, pa.int32()), pa.nulls(n, pa.float64()), pa.array(data, pa.binary())],
        ["batch", "kind", "doc", "value", "data"],
    )
