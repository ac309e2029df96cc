"""Quality classifier: random-indexing vectors pooled per document and a two-layer network in numpy.

Tokens are runs of letters and digits, or of other visible bytes. Each token falls into one of ``SLOTS`` slots, and a
slot has a sparse random index vector. A slot's context vector sums the index vectors of its neighbours over all
documents; a document's features are the weighted mean of both kinds of vectors, their
norms, and the share of tokens beside their like. The network learns
from an even sample of about ``SAMPLE`` labelled rows that are not held out, and a temperature fitted on a part of them that it has
not seen calibrates its probabilities.

Null and empty texts get features of zero and a score like any other row. A row with a null ``doc_id`` is held out.
Repeated rows score alike; repeated labels of a document count as their mean, rounded up. Without labels of both classes the
score is the smoothed share of class 1. Columns of the input pass through, those named like a result are replaced.
"""

from __future__ import annotations

import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pilotlamp.llm.common import add_columns, without
from pilotlamp.session import durable

SLOTS, DIMS, NONZERO, WINDOW = 8192, 64, 2, 2
SAMPLE = 20_000
HIDDEN, EPOCHS, BATCH = 32, 60, 256
FEATURES = 2 * DIMS + 5
CHUNKS = 16  # of the slots, summed apart
DOCS = 256  # documents pooled in one product

_TOKEN = re.compile(rb"[0-9A-Za-z\x80-\xff]+|[^\s0-9A-Za-z\x80-\xff]+")


class _Slots(dict):
    def __missing__(self, token: bytes) -> int:
        if len(self) > 500_000:  # a cache only
            self.clear()
        slot = self[token] = zlib.crc32(token) % SLOTS
        return slot


_SLOT = _Slots()


def _slots(text: bytes | None) -> list[int]:
    return [_SLOT[t] for t in _TOKEN.findall(text)] if text else []


def index_vectors() -> tuple[np.ndarray, np.ndarray]:
    """Places and signs of the non-zero entries of every slot's index vector; the same in every task."""
    rng = np.random.default_rng(8)
    return rng.integers(0, DIMS, (SLOTS, NONZERO)), rng.choice([-1.0, 1.0], (SLOTS, NONZERO))


def _context(texts: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    """Sums of the neighbours' index vectors by slot, and counts of the slots."""
    place, sign = index_vectors()
    slots = np.fromiter((s for t in texts for s in (*t, *[-1] * WINDOW)), dtype=np.int64)
    total = np.zeros(SLOTS * DIMS)
    for off in range(1, WINDOW + 1):
        ok = (slots[:-off] >= 0) & (slots[off:] >= 0)
        a, b = slots[:-off][ok], slots[off:][ok]
        for left, right in ((a, b), (b, a)):
            for k in range(NONZERO):
                total += np.bincount(left * DIMS + place[right, k], weights=sign[right, k], minlength=SLOTS * DIMS)
    return total, np.bincount(slots[slots >= 0], minlength=SLOTS)


def learn_vectors(documents: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Context sums and counts of all slots over all documents.

    Every task sums what it reads; the sums, of fixed size, are added slot range by slot range.
    """
    width = SLOTS // CHUNKS

    def partial(batches):
        total, count = np.zeros(SLOTS * DIMS), np.zeros(SLOTS, dtype=np.int64)
        for b in batches:
            texts = b.column(0).cast(pa.binary()).to_pylist()
            for at in range(0, len(texts), 2000):
                t, c = _context([_slots(x) for x in texts[at:at + 2000]])
                total += t
                count += c
        if count.any():
            sums = np.hstack([total.reshape(SLOTS, DIMS), count[:, None]]).astype(np.int64).reshape(CHUNKS, width * (DIMS + 1))
            small = np.int32 if abs(sums).max() < 2**31 else np.int64
            yield pa.RecordBatch.from_pydict({"chunk": list(range(CHUNKS)), "wide": [small is np.int64] * CHUNKS,
                                              "sums": [x.astype(small).tobytes() for x in sums]})

    def add(batches):
        held: dict[int, np.ndarray] = {}
        for b in batches:
            for k, wide, raw in zip(*(c.to_pylist() for c in b.columns), strict=True):
                x = np.frombuffer(raw, dtype=np.int64 if wide else np.int32).astype(np.int64)
                held[k] = held[k] + x if k in held else x
        if held:
            yield pa.RecordBatch.from_pydict({"chunk": list(held), "wide": [True] * len(held), "sums": [x.tobytes() for x in held.values()]})

    kind = "chunk long, wide boolean, sums binary"
    sums = documents.select("text").mapInArrow(partial, kind).repartition(CHUNKS, "chunk").mapInArrow(add, kind)
    all_sums = np.zeros((CHUNKS, width, DIMS + 1), dtype=np.int64)
    for k, _, raw in sums.collect():  # CHUNKS rows of fixed size
        all_sums[k] += np.frombuffer(raw, dtype=np.int64).reshape(width, DIMS + 1)
    flat = all_sums.reshape(SLOTS, DIMS + 1)
    return flat[:, :DIMS].astype(np.float64), flat[:, DIMS]


def _pooling_matrix(context: np.ndarray, count: np.ndarray) -> np.ndarray:
    """One row per slot: weighted unit context vector, then the index vector."""
    norm = np.linalg.norm(context, axis=1, keepdims=True)
    share = count / max(1, count.sum())
    weight = 1e-2 / (1e-2 + share)
    place, sign = index_vectors()
    index = np.zeros((SLOTS, DIMS))
    for k in range(NONZERO):
        np.add.at(index, (np.arange(SLOTS), place[:, k]), sign[:, k])
    return np.hstack([context / np.maximum(norm, 1e-9) * weight[:, None], index]).astype(np.float32)


def pooled(documents: DataFrame, context: np.ndarray, count: np.ndarray, keep=None) -> DataFrame:
    """``documents`` with ``features``, the bytes of ``FEATURES`` 32-bit floats (a quarter of what they take as Python numbers)."""
    matrix = documents.sparkSession.sparkContext.broadcast(_pooling_matrix(context, count))  # SLOTS rows: 4 MB

    def pool(text):
        texts = text.cast(pa.binary()).to_pylist()
        out = np.zeros((len(texts), FEATURES), dtype=np.float32)
        for at in range(0, len(texts), DOCS):
            part = [_slots(t) for t in texts[at:at + DOCS]]
            n = np.array([len(t) for t in part])
            flat = np.fromiter((s + i * SLOTS for i, t in enumerate(part) for s in t), dtype=np.int64)
            share = np.bincount(flat, minlength=len(part) * SLOTS).reshape(len(part), SLOTS).astype(np.float32)
            share /= np.maximum(n, 1)[:, None]
            vectors = share @ matrix.value
            twice = np.bincount(flat[1:][flat[1:] == flat[:-1]] // SLOTS, minlength=len(part)) / np.maximum(n, 1)  # a token and its like
            norms = [np.linalg.norm(vectors[:, :DIMS], axis=1), np.linalg.norm(vectors[:, DIMS:], axis=1), np.sqrt((share**2).sum(1))]
            rest = [*norms, twice, np.log1p(n) / 8]
            out[at:at + DOCS] = np.hstack([vectors, np.stack(rest, 1)])
        return [pa.array([row.tobytes() for row in out], pa.binary())]

    kind = T.StructType([T.StructField("features", T.BinaryType())])
    return add_columns(documents, ["text"], pool, kind, keep)


def _floats(rows) -> np.ndarray:
    return np.frombuffer(b"".join(rows), np.float32).reshape(-1, FEATURES).astype(np.float64)


class Network:
    """Two layers: tanh units, then one probability with a temperature."""

    def __init__(self, x: np.ndarray, y: np.ndarray):
        rng = np.random.default_rng(8)
        self.mean, self.spread = x.mean(0), x.std(0) + 1e-3
        self.p = [rng.normal(0, 1 / np.sqrt(x.shape[1]), (x.shape[1], HIDDEN)), np.zeros(HIDDEN), rng.normal(0, 1 / np.sqrt(HIDDEN), HIDDEN), np.zeros(1)]
        self.temperature = 1.0
        unseen = np.arange(len(y)) % 5 == 0
        fit = np.flatnonzero(~unseen)
        x = (x - self.mean) / self.spread
        first, second, step = [np.zeros_like(p) for p in self.p], [np.zeros_like(p) for p in self.p], 0
        for epoch in range(EPOCHS):
            order = rng.permutation(fit)
            for at in range(0, len(order), BATCH):
                rows = order[at:at + BATCH]
                hidden = np.tanh(x[rows] @ self.p[0] + self.p[1])
                err = (1 / (1 + np.exp(-np.clip(hidden @ self.p[2] + self.p[3], -30, 30))) - y[rows]) / len(rows)
                back = np.outer(err, self.p[2]) * (1 - hidden**2)
                step += 1
                for i, g in enumerate((x[rows].T @ back + 1e-4 * self.p[0], back.sum(0), hidden.T @ err + 1e-4 * self.p[2], err.sum(keepdims=True))):
                    first[i] = 0.9 * first[i] + 0.1 * g
                    second[i] = 0.999 * second[i] + 0.001 * g * g
                    rate = 3e-3 * (1 - epoch / EPOCHS)
                    self.p[i] = self.p[i] - rate * (first[i] / (1 - 0.9**step)) / (np.sqrt(second[i] / (1 - 0.999**step)) + 1e-8)
        if unseen.any():
            z, y = self.logits(x[unseen], True), y[unseen]
            loss = lambda t: np.mean(np.logaddexp(0, z / t) - y * z / t)
            self.temperature = float(min(np.geomspace(0.3, 10, 60), key=loss))

    def logits(self, x: np.ndarray, scaled: bool = False) -> np.ndarray:
        x = x if scaled else (x - self.mean) / self.spread
        return np.tanh(x @ self.p[0] + self.p[1]) @ self.p[2] + self.p[3]

    def __call__(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logits(x) / self.temperature, -30, 30)))


class Share:
    """Stands in for the network where labels of both classes are missing."""

    def __init__(self, y: np.ndarray):
        self.share = (y.sum() + 1) / (len(y) + 2)

    def __call__(self, x: np.ndarray) -> np.ndarray:
        return np.full(len(x), self.share)


def score_quality(documents: DataFrame, labels: DataFrame, folds: int = 5, threshold: float = 0.3, keep=None) -> DataFrame:
    """``documents`` with ``held_out, score, predicted``; rows of fold 0 by crc32 of the id are never learnt from."""
    names = ["held_out", "score", "predicted"]
    kept = without(documents.columns if keep is None else keep, names)
    context, count = learn_vectors(documents)
    fold = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % folds, F.lit(0))
    features = durable(pooled(documents.withColumn("_fold", fold), context, count, [*without(kept, ["text"]), "_fold"]))
    known = labels.where("quality IS NOT NULL").groupBy("doc_id").agg(F.round(F.avg("quality")).alias("_y"))
    learn = features.where("_fold != 0").join(known, "doc_id")
    share = min(1.0, SAMPLE / max(1, learn.count()))  # an even share by hash, so that no task gathers a sample of its own
    fit = learn.where(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_003)) < share * 1_000_003).select("doc_id", "features", "_y").toPandas()
    fit = fit.sort_values("doc_id", kind="stable")
    y = fit["_y"].to_numpy(dtype=np.float64)
    model = Network(_floats(fit["features"]), y) if 0 < y.sum() < len(y) else Share(y)
    shared = documents.sparkSession.sparkContext.broadcast(model)  # weights of fixed size

    def judge(x):
        return [pa.array(shared.value(_floats(x.to_pylist())), pa.float64())]

    scored = add_columns(features, ["features"], judge, T.StructType([T.StructField("score", T.DoubleType())]), [*without(kept, ["text"]), "_fold"])
    return scored.select(
        *without(kept, ["text"]), (F.col("_fold") == 0).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted")
    )


def keep_good(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``documents`` that are not rejected; equal ids with unequal texts are judged apart."""
    mark = documents.withColumn("_key", F.xxhash64(F.coalesce("text", F.lit(""))))
    bad = score_quality(mark, labels, keep=["doc_id", "_key"]).where("predicted = 0").select("doc_id", "_key").distinct()
    same = (mark["doc_id"].eqNullSafe(bad["doc_id"])) & (mark["_key"] == bad["_key"])
    return mark.join(bad, same, "left_anti").drop("_key")
