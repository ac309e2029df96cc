"""Live votes, routing and verdicts with Structured Streaming.

Votes depend on arrival order and on counts of samples, so they keep keyed state. Rows of one micro-batch
are put in frame order before they touch the state; the source's rate limit bounds a micro-batch. A row
that arrives twice (same stream, epoch and frame) is dropped within the watermark. Streams that have a column ``lane`` keep
the states of a lane's streams side by side under one key. A recorded table has no micro-batches: there the same step runs over bounded chunks of each stream and its state goes from chunk to chunk.
"""

from __future__ import annotations

import json
from collections import Counter
from collections.abc import Callable, Iterable, Iterator
from itertools import groupby

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from pilotlamp.operators import judge, ordered, voting
from pilotlamp.operators import requests as whole
from pilotlamp.session import durable, new_folder

SAMPLE = T.StructType([
    T.StructField("stream_id", T.LongType()), T.StructField("epoch", T.IntegerType()),
    T.StructField("frame_idx", T.LongType()), T.StructField("ts", T.TimestampType()),
    T.StructField("class_name", T.StringType()), T.StructField("confidence", T.DoubleType())])
DECISION = T.StructType([
    T.StructField("stream_id", T.LongType()), T.StructField("epoch", T.IntegerType()),
    T.StructField("frame_idx", T.LongType()), T.StructField("candidate", T.StringType()),
    T.StructField("ratio", T.DoubleType()), T.StructField("mean", T.DoubleType()),
    T.StructField("window_size", T.IntegerType()), T.StructField("stable", T.BooleanType()),
    T.StructField("late", T.LongType())])
ROUTE = T.StructType([
    T.StructField("stream_id", T.LongType()), T.StructField("epoch", T.IntegerType()),
    T.StructField("frame_idx", T.LongType()), T.StructField("position", T.LongType()),
    T.StructField("voted", T.StringType()), T.StructField("device", T.StringType()),
    T.StructField("device_confidence", T.DoubleType()), T.StructField("late", T.LongType())])
ALIASES = ("device_id string, canonical_name string, rule_name string, aliases array<string>, workspace_names array<string>,"
           " verified boolean, ordinal int")
STATE = T.StructType([T.StructField("body", T.StringType())])

CHUNK_ROWS = 200_000  # of a recorded stream, in one Python task
STATE_ROWS = 100_000  # of a recorded table, for each partition of state
LANES, LANE_STREAMS = 4, 4096  # lanes of a recorded table in each partition of state; streams of a lane, on average at most
_PARTITIONS = "spark.sql.shuffle.partitions"
_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def replay(samples: DataFrame, vote: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """A recorded table of samples through the same stateful step as a stream, ``CHUNK_ROWS`` rows of a stream at a time."""
    columns = [F.col(c).cast(SAMPLE[c].dataType).alias(c) for c in SAMPLE.fieldNames() if c != "epoch"]
    return vote(samples.select(*columns, F.lit(0).alias("epoch")))


def _cuts(rows: DataFrame, total: int, batch_rows: int) -> list[float]:
    """Frame numbers that cut ``rows`` into batches of about ``batch_rows`` rows."""
    n = max(1, -(-total // batch_rows))
    return sorted(set(rows.approxQuantile("frame_idx", [i / n for i in range(1, n)], 0.1 / n))) if n > 1 else []


def _most_of_a_stream(rows: DataFrame, cuts: list[float]) -> int:
    """Rows of the busiest stream, or lane if the rows have lanes, in one batch."""
    key = "lane" if "lane" in rows.columns else "stream_id"
    batch = F.size(F.filter(F.array(*[F.lit(int(c)) for c in cuts]).cast("array<long>"), lambda c: c <= F.col("frame_idx")))
    return rows.groupBy(key, batch.alias("batch")).count().agg(F.max("count")).first()[0] or 0


def _stores(total: int, most: int) -> int:
    """Partitions of state, at most ``most``."""
    return min(most, max(8, -(-total // STATE_ROWS)))


def _with_lanes(rows: DataFrame, stores: int, streams: int) -> DataFrame:
    """Add ``lane``, by hash of the stream; -1 holds the rows without a stream."""
    lanes = max(LANES * stores, -(-streams // LANE_STREAMS))
    return rows.withColumn("lane", F.when(F.col("stream_id").isNull(), -1).otherwise(F.pmod(F.xxhash64("stream_id"), F.lit(lanes))).cast("long"))


def _batches(rows: DataFrame, total: int, most: int, batch_rows: int | None) -> tuple[int, list[float]]:
    """Partitions of state, at most ``most``, and the frame numbers that cut the batches."""
    partitions = _stores(total, most)
    size = batch_rows or max(CHUNK_ROWS, partitions * STATE_ROWS)
    cuts = _cuts(rows, total, size)
    while batch_rows is None and size > CHUNK_ROWS and (busiest := _most_of_a_stream(rows, cuts)) > CHUNK_ROWS:
        size = max(CHUNK_ROWS, min(size // 2, size * CHUNK_ROWS // busiest))
        cuts = _cuts(rows, total, size)
    return partitions, cuts


def stream_recorded(samples: DataFrame, vote: Callable[[DataFrame], DataFrame], batch_rows: int | None = None) -> DataFrame:
    """A recorded table of samples through the streaming engine: files, keyed state, a result table in the shared folder.

    The frames are cut at quantiles of ``frame_idx`` into batches of about ``batch_rows`` rows. A run opens every partition
    of state, so by default a batch has ``STATE_ROWS`` rows for each and the number of stores opened grows with the rows, not
    their square; where that puts more than ``CHUNK_ROWS`` rows of a lane into a batch, all batches are smaller, down to that many rows. Every batch is appended to
    the source folder and read by a run of the query that goes on from the checkpoint of the run before it, so batches
    arrive in order whatever times the file system notes, and a lost run is repeated from its checkpoint. Without an
    ``epoch`` column there is one epoch. Every partition of state is a store to open in each run, so there is one for
    ``STATE_ROWS`` rows of the table, at most as many as the session's shuffle partitions. Frames without a number belong to no batch and are an error.
    A key of state is a lane of many streams, so that a call of Python and its trips to the store serve thousands of rows;
    each stream has its own state in it.
    """
    spark = samples.sparkSession
    epoch = F.col("epoch") if "epoch" in samples.columns else F.lit(0)
    columns = [(epoch if c == "epoch" else F.col(c)).cast(SAMPLE[c].dataType).alias(c) for c in SAMPLE.fieldNames()]
    rows = durable(samples.select(*columns).repartitionByRange("frame_idx"))
    total, numbered, streams = rows.agg(F.count(F.lit(1)), F.count("frame_idx"), F.approx_count_distinct("stream_id")).first()
    if total > numbered:
        raise ValueError(f"{total - numbered} samples have no frame number")
    most = int(spark.conf.get(_PARTITIONS))
    rows = _with_lanes(rows, _stores(total, most), streams)
    partitions, cuts = _batches(rows, total, most, batch_rows)
    source, out, checkpoint = (new_folder(spark, kind) for kind in ("samples", "decisions", "progress"))
    rows.limit(0).write.parquet(source)  # a stream is defined on a folder that exists
    decided = vote(spark.readStream.schema(rows.schema).parquet(source))
    settings = {_PROVIDER: _ROCKSDB, _PARTITIONS: str(partitions)}
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        for low, high in zip([None, *cuts], [*cuts, None]):
            part = rows if low is None else rows.filter(F.col("frame_idx") >= int(low))
            part = part if high is None else part.filter(F.col("frame_idx") < int(high))
            part.write.mode("append").parquet(source)
            decided.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint).outputMode(
                "append").trigger(availableNow=True).start().awaitTermination()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    return spark.read.schema(decided.schema).parquet(out)


def skip_ahead(frames: DataFrame, skip: int) -> DataFrame:
    """Keep a frame, drop the next ``skip``."""
    return frames.filter(F.pmod(F.col("frame_idx"), F.lit(skip + 1)) == 0)


def without_replays(samples: DataFrame, delay: str = "10 minutes") -> DataFrame:
    return samples.withWatermark("ts", delay).dropDuplicatesWithinWatermark(["stream_id", "epoch", "frame_idx"])


class _OrderedRows(StatefulProcessor):
    """Feeds rows in (epoch, frame) order to ``advance`` with a small JSON state; a new epoch starts afresh.

    Rows of an epoch before the current one change nothing; ``late`` counts them. With ``idle_ms`` a stream without
    rows for that long, in event time, ends: its state is cleared, and rows that come later open a new one.
    """

    idle_ms = 0
    lanes = False  # a key holds the rows of many streams
    needs = SAMPLE.fieldNames()
    many = None

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("state", STATE)

    def walk(self, rows: Iterable, saved: str | None) -> tuple[list[tuple], str]:
        """Output and closing state of sorted rows of one stream."""
        state = json.loads(saved) if saved else {**self.fresh(None), "late": 0}
        out = []
        for row in rows:
            if state["epoch"] is not None and row.epoch < state["epoch"]:
                state["late"] += 1
                continue
            if state["epoch"] is None or row.epoch > state["epoch"]:
                state = {**self.fresh(int(row.epoch)), "late": state["late"]}
            made = self.advance(state, row)
            if made is not None:
                out.append((row.stream_id, int(row.epoch), int(row.frame_idx), *made, state["late"]))
        return out, json.dumps(state)

    def fold(self, rows: pd.DataFrame, saved: str | None) -> tuple[pd.DataFrame, str]:
        """``walk`` over a table."""
        out, state = self.walk(rows.itertuples(index=False), saved)
        return pd.DataFrame(out, columns=self.schema.fieldNames()), state

    def fold_streams(self, rows: pd.DataFrame, states: dict[str, str]) -> pd.DataFrame:
        """Output of sorted rows of many streams; ``states``, by stream, becomes what they leave."""
        out = []
        for stream, part in groupby(rows.itertuples(index=False), lambda row: row.stream_id):
            made, states[str(stream)] = self.walk(part, states.get(str(stream)))
            out += made
        return pd.DataFrame(out, columns=self.schema.fieldNames())

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        batch = pd.concat(list(rows))
        saved = self.state.get()[0] if self.state.exists() else None
        if self.lanes:
            states = json.loads(saved) if saved else {}
            out = self.fold_streams(batch.sort_values(["stream_id", "epoch", "frame_idx"], ignore_index=True), states)
            self.state.update((json.dumps(states),))
            yield out if key[0] >= 0 else out.assign(stream_id=None)
            return
        batch = batch.sort_values(["epoch", "frame_idx"])
        out, state = self.fold(batch, saved)
        self.state.update((state,))
        if self.idle_ms:
            end = int(batch["ts"].max().timestamp() * 1000) + self.idle_ms
            timers = list(self.handle.listTimers())
            if not timers or end > max(timers):
                for t in timers:
                    self.handle.deleteTimer(t)
                self.handle.registerTimer(end)
        yield out

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self.state.clear()
        return iter([])

    def close(self) -> None:
        pass


class _Stable(_OrderedRows):
    schema, settle = DECISION, True

    def __init__(self, window: int, min_confidence: float, min_ratio: float, min_mean: float, every: float):
        self.window, self.min_confidence, self.every = window, min_confidence, every
        self.min_ratio, self.min_mean = min_ratio, min_mean

    @staticmethod
    def fresh(epoch):
        return {"epoch": epoch, "history": [], "last": None}

    def advance(self, state, row):
        if self.every > 0:
            now = row.ts.timestamp()
            if state["last"] is not None and now - state["last"] < self.every:
                return None
            state["last"] = now
        if row.confidence >= self.min_confidence:
            state["history"] = [*state["history"], [row.class_name, row.confidence]][-self.window:]
        seen = state["history"]
        if not seen:
            return None, None, None, 0, False
        name, votes = Counter(n for n, _ in seen).most_common(1)[0]
        mean = sum(c for n, c in seen if n == name) / votes
        ratio = votes / len(seen)
        stable = len(seen) >= min(3, self.window) and ratio >= self.min_ratio and mean >= self.min_mean
        return name, ratio, mean, len(seen), stable


class _Routed(_OrderedRows):
    schema, settle = ROUTE, False  # counts all rows
    needs = [c for c in SAMPLE.fieldNames() if c != "ts"]  # a time costs as much as all other columns on its way to Python

    def __init__(self, interval: int, window: int):
        self.interval, self.window = interval, window

    @staticmethod
    def fresh(epoch):
        return {"epoch": epoch, "position": 0, "votes": [], "device": None, "confidence": None}

    def advance(self, state, row):
        if state["position"] % self.interval == 0:
            state["device"], state["confidence"] = row.class_name, row.confidence
            state["votes"] = [*state["votes"], row.class_name][-self.window:]
        state["position"] += 1
        voted = Counter(state["votes"]).most_common(1)[0][0]
        return state["position"], voted, state["device"], state["confidence"]

    def many(self, rows: pd.DataFrame, starts: np.ndarray) -> pd.DataFrame:
        """Whole sorted streams at once."""
        return self.together(rows, starts, [None] * len(starts))[0]

    def fold_streams(self, rows: pd.DataFrame, states: dict[str, str]) -> pd.DataFrame:
        ids = rows["stream_id"].to_numpy()
        starts = np.flatnonzero(np.append(True, ids[1:] != ids[:-1]))
        streams = [str(i) for i in ids[starts]]
        out, closing = self.together(rows, starts, [json.loads(states[s]) if s in states else None for s in streams])
        states.update((s, json.dumps(c)) for s, c in zip(streams, closing))
        return out

    def together(self, rows: pd.DataFrame, starts: np.ndarray, states: list[dict | None]) -> tuple[pd.DataFrame, list[dict]]:
        """Output and closing states of sorted streams at once. The vote is taken on the recognised frames only; those a
        state remembers come before the others of their stream.
        """
        late = np.array([s["late"] if s else 0 for s in states], np.int64)
        since = np.array([s["epoch"] if s and s["epoch"] is not None else -1 << 63 for s in states], np.int64)
        stream = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, len(rows))))
        old = rows["epoch"].to_numpy() < since[stream]
        if old.any():
            late += np.bincount(stream[old], minlength=len(starts))
            rows, stream = rows[~old], stream[~old]
        n, epoch = len(rows), rows["epoch"].to_numpy().astype(np.int64)
        new = np.ones(n, bool)  # a run: rows of one stream and epoch
        new[1:] = (stream[1:] != stream[:-1]) | (epoch[1:] != epoch[:-1])
        run, opens = np.cumsum(new) - 1, np.flatnonzero(new)
        goes_on = np.flatnonzero(epoch[opens] == since[stream[opens]])  # at most the first run of a stream
        kept = [states[s] for s in stream[opens[goes_on]]]
        base, held = np.zeros(len(opens), np.int64), np.zeros(len(opens), np.int64)
        base[goes_on], held[goes_on] = [s["position"] for s in kept], [len(s["votes"]) for s in kept]
        position = np.arange(n) - opens[run] + base[run]
        is_head = position % self.interval == 0
        heads = np.flatnonzero(is_head)
        at = np.cumsum(held)[run] + np.cumsum(is_head) - 1  # the head that holds for each row
        # heads in order, those of states first in their run; only the last of these needs its confidence
        of = np.append(np.repeat(np.arange(len(opens)), held), run[heads])
        order = np.argsort(of, kind="stable")
        of = of[order]
        names, remembered = rows["class_name"].to_numpy(dtype=object), [v for s in kept for v in s["votes"]]
        name = np.append(np.array([*remembered, None], object)[:-1], names[heads])[order]
        trust = np.array([s["confidence"] for s in kept for _ in s["votes"]], np.float64)
        trust = np.append(trust, rows["confidence"].to_numpy(dtype=np.float64)[heads])[order]
        code = pd.factorize(name, use_na_sentinel=False)[0]
        back = np.arange(self.window - 1, -1, -1)  # oldest first
        seen = np.arange(len(of))[:, None] - back
        same = (seen >= 0) & (of[np.maximum(seen, 0)] == of[:, None])
        codes = np.where(same, code[np.maximum(seen, 0)], -1)
        votes = ((codes[:, :, None] == codes[:, None, :]) & same[:, None, :]).sum(2) * same
        first = seen[np.arange(len(of)), votes.argmax(1)]  # of equal counts the one seen first
        out = pd.DataFrame({
            "stream_id": rows["stream_id"], "epoch": rows["epoch"], "frame_idx": rows["frame_idx"], "position": position + 1, "voted": name[first[at]],
            "device": name[at], "device_confidence": trust[at], "late": late[stream]}).reset_index(drop=True)
        closing = [{**(s or self.fresh(None)), "late": int(k)} for s, k in zip(states, late)]
        ends = np.flatnonzero(np.append(stream[1:] != stream[:-1], True)) if n else []
        for i in ends:
            last = at[i]
            recent = [None if pd.isna(v) else v for v in name[seen[last][same[last]]]]
            closing[stream[i]] |= {"epoch": int(epoch[i]), "position": int(position[i]) + 1, "votes": recent, "device": recent[-1], "confidence": float(trust[last])}
        return out, closing


def _advance(samples: DataFrame, processor: _OrderedRows, idle_seconds: float = 0.0) -> DataFrame:
    """A stream by micro-batches, a table by chunks."""
    if samples.isStreaming:
        processor.idle_ms = int(idle_seconds * 1000)
        processor.lanes = "lane" in samples.columns and not processor.idle_ms  # a timer belongs to one stream
        if processor.lanes:  # a missing number would make all numbers of a batch floats
            samples = samples.withColumn("stream_id", F.coalesce("stream_id", F.lit(0))).select("lane", *processor.needs)
        return samples.groupBy("lane" if processor.lanes else "stream_id").transformWithStateInPandas(
            processor, processor.schema, "Append", "EventTime" if processor.idle_ms else "None")

    def step(rows: pd.DataFrame, state: bytes | None) -> tuple[pd.DataFrame, bytes]:
        out, closing = processor.fold(rows, state.decode() if state else None)
        return out, closing.encode()

    order = [(c, "asc") for c in ("epoch", "frame_idx", "ts", "class_name", "confidence")]
    return ordered.fold_in_order(samples.select(*SAMPLE.fieldNames()), ["stream_id"], order, step, processor.schema, CHUNK_ROWS, processor.settle, processor.many)


def stable_devices(samples: DataFrame, window: int = voting.WINDOW, min_confidence: float = voting.MIN_FRAME_CONFIDENCE,
                   min_ratio: float = voting.MIN_RATIO, min_mean: float = voting.MIN_MEAN,
                   sample_seconds: float = 0.0, idle_seconds: float = 0.0) -> DataFrame:
    """Running device decision per stream. ``sample_seconds`` keeps one sample per elapsed interval.

    ``idle_seconds`` ends the state of a stream that has been silent for so long; the samples then need a watermark on
    ``ts``. ``late`` is the number of rows of older epochs that the stream has rejected so far.
    """
    return _advance(samples, _Stable(window, min_confidence, min_ratio, min_mean, sample_seconds), idle_seconds)


def routed_devices(samples: DataFrame, interval: int = 15, window: int = voting.SHORT_WINDOW, idle_seconds: float = 0.0) -> DataFrame:
    """Device recognised every ``interval`` frames and its short vote, carried to every frame; the rest as above."""
    return _advance(samples, _Routed(interval, window), idle_seconds)


def judge_stream(requests: DataFrame, read_rules: Callable[[SparkSession], DataFrame],
                 write: Callable[[DataFrame, int], None], read_aliases: Callable[[SparkSession], DataFrame] | None = None
                 ) -> DataStreamWriter:
    """Judge each micro-batch of requests as ``requests.judge_requests`` does, failing requests included.

    Rules and aliases are read per batch, so a change counts for the next request. Without aliases device names are
    looked up among the devices of the rules.
    """
    def run(batch: DataFrame, epoch: int) -> None:
        spark = batch.sparkSession
        aliases = read_aliases(spark) if read_aliases else spark.createDataFrame([], ALIASES)
        write(whole.judge_requests(batch, aliases, read_rules(spark)), epoch)

    return requests.writeStream.foreachBatch(run)


def latest_rules(log: DataFrame) -> DataFrame:
    """Current rules of an append-only rule log: the newest entry per condition."""
    rest = [c for c in log.columns if c not in judge.KEY]
    return log.groupBy(*judge.KEY).agg(F.max_by(F.struct(*rest), F.struct("updated_at", "ordinal")).alias("r")).select(
        *judge.KEY, "r.*")


def progress(frames: DataFrame, totals: DataFrame) -> DataFrame:
    """Progress in percent (one decimal) and clock text of each processed frame of a file."""
    from pilotlamp.functions import text
    done = F.least(F.lit(100.0), F.round(F.col("frame_idx") * 100.0 / F.greatest(F.col("total_frames"), F.lit(1)), 1))
    j = frames.join(totals, "stream_id")
    return j.withColumn("progress", done).withColumn("clock", text.clock_text(F.col("frame_idx") / F.col("fps")))
