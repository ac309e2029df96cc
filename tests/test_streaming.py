import tempfile

import pytest

from pyspark.sql import functions as F

from pilotlamp.operators import voting
from pilotlamp.plans.registry import Tables
from pilotlamp.streaming import live

SF = "/root/testdata/sf0.001"
STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def staged(spark, parts):
    """Samples as files that a stream reads one per micro-batch, in time order."""
    s = Tables(spark, SF).samples.select("stream_id", F.lit(0).alias("epoch"), "frame_idx", "ts", "class_name", "confidence")
    folder = tempfile.mkdtemp(prefix="stream-")
    cut = s.count() // parts + 1
    for i in range(parts):
        s.filter((F.col("frame_idx") >= i * cut) & (F.col("frame_idx") < (i + 1) * cut)).coalesce(1).write.mode(
            "append").parquet(folder)
    return s, folder


def drain(spark, df, name, checkpoint):
    q = df.writeStream.format("memory").queryName(name).outputMode("append").option("checkpointLocation", checkpoint)
    q = q.trigger(availableNow=True).start() if checkpoint is None else q.start()
    q.processAllAvailable()
    q.stop()
    return spark.table(name)


def rows(df, *cols):
    return sorted(tuple(round(v, 6) if isinstance(v, float) else v for v in r) for r in df.select(*cols).collect())


def test_live_votes_equal_batch(spark):
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", STORE)
    batch, folder = staged(spark, 3)
    source = spark.readStream.schema(live.SAMPLE).option("maxFilesPerTrigger", 1).parquet(folder)
    got = drain(spark, live.stable_devices(live.without_replays(source, "3650 days")), "votes", tempfile.mkdtemp())
    want = voting.running_votes(batch, ["stream_id"], [("ts", "asc"), ("frame_idx", "asc")], "class_name", "confidence")
    cols = ["stream_id", "frame_idx", "candidate", "ratio", "mean", "window_size", "stable"]
    assert [tuple(map(str, r)) for r in rows(got.fillna("", ["candidate"]).fillna(0.0), *cols)] == [
        tuple(map(str, r)) for r in rows(want.fillna("", ["candidate"]).fillna(0.0), *cols)]


def test_live_routes_equal_batch(spark):
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", STORE)
    batch, folder = staged(spark, 2)
    source = spark.readStream.schema(live.SAMPLE).option("maxFilesPerTrigger", 1).parquet(folder)
    got = drain(spark, live.routed_devices(source), "routes", tempfile.mkdtemp())
    want = voting.interval_votes(batch, ["stream_id"], [("ts", "asc"), ("frame_idx", "asc")], "class_name", "confidence")
    cols = ["stream_id", "frame_idx", "position", "voted", "device", "device_confidence"]
    assert rows(got, *cols) == rows(want, *cols)


def test_replays_run_in_bounded_chunks(spark, monkeypatch):
    """A stream far above the chunk limit gives what one pass gives, and no step gets more rows than the limit."""
    cols = ["stream_id", "frame_idx", "candidate", "ratio", "mean", "window_size", "stable"]
    few = Tables(spark, SF).samples.filter("frame_idx < 400")
    votes = rows(live.replay(few, live.stable_devices).fillna("", ["candidate"]).fillna(0.0), *cols)
    paths = ["stream_id", "frame_idx", "position", "voted", "device", "device_confidence"]
    routes = rows(live.replay(few, live.routed_devices), *paths)
    limit = few.groupBy("stream_id").count().agg(F.max("count")).first()[0] // 3
    fold = live.ordered.fold_in_order

    def seen(df, keys, order, step, *args):
        def watched(part, state):
            if len(part) > limit:
                raise ValueError(f"{len(part)} rows in one step")
            return step(part, state)

        return fold(df, keys, order, watched, *args)

    monkeypatch.setattr(live, "CHUNK_ROWS", limit)
    monkeypatch.setattr(live.ordered, "fold_in_order", seen)
    assert rows(live.replay(few, live.stable_devices).fillna("", ["candidate"]).fillna(0.0), *cols) == votes
    assert rows(live.replay(few, live.routed_devices), *paths) == routes
    assert votes and routes and limit > 0


def test_epoch_resets_and_sampling(spark):
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", STORE)
    folder = tempfile.mkdtemp()
    data = [(1, e, i, f"2024-01-01 00:00:{i:02d}", "a" if e == 0 else "b", 0.9) for e in (0, 1) for i in range(6)]
    df = spark.createDataFrame(data, "stream_id long, epoch int, frame_idx long, ts string, class_name string, confidence double")
    df.withColumn("ts", F.col("ts").cast("timestamp")).coalesce(1).write.mode("append").parquet(folder)
    source = spark.readStream.schema(live.SAMPLE).parquet(folder)
    got = drain(spark, live.stable_devices(source, sample_seconds=2.0), "epochs", tempfile.mkdtemp())
    out = rows(got, "epoch", "frame_idx", "candidate", "window_size", "stable")
    assert out == [(0, 0, "a", 1, False), (0, 2, "a", 2, False), (0, 4, "a", 3, True),
                   (1, 0, "b", 1, False), (1, 2, "b", 2, False), (1, 4, "b", 3, True)]


KIND = "stream_id long, epoch int, frame_idx long, ts string, class_name string, confidence double"


def fed(spark, name, batches, vote, watermark=None):
    """The rows that ``vote`` gives when each list of samples is one micro-batch."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", STORE)
    folder = tempfile.mkdtemp()
    source = spark.readStream.schema(live.SAMPLE).parquet(folder)
    df = vote(source.withWatermark("ts", watermark) if watermark else source)
    q = df.writeStream.format("memory").queryName(name).outputMode("append").option("checkpointLocation", tempfile.mkdtemp()).start()
    for samples in batches:
        spark.createDataFrame(samples, KIND).withColumn("ts", F.col("ts").cast("timestamp")).coalesce(1).write.mode("append").parquet(folder)
        q.processAllAvailable()
    q.stop()
    return spark.table(name)


def test_rows_of_an_older_epoch_are_rejected_and_counted(spark):
    row = lambda e, i, c: (1, e, i, f"2024-01-01 00:00:{i:02d}", c, 0.9)
    batches = [[row(0, 50, "old")], [row(1, 0, "new"), row(1, 1, "new")], [row(0, 51, "old"), row(0, 52, "old"), row(1, 2, "new")], [row(2, 0, "next")]]
    got = fed(spark, "late_votes", batches, live.stable_devices)
    assert rows(got, "epoch", "frame_idx", "candidate", "window_size", "late") == [
        (0, 50, "old", 1, 0), (1, 0, "new", 1, 0), (1, 1, "new", 2, 0), (1, 2, "new", 3, 2), (2, 0, "next", 1, 2)]
    got = fed(spark, "late_routes", batches, lambda s: live.routed_devices(s, 1, 5))
    assert rows(got, "epoch", "frame_idx", "position", "voted", "late") == [
        (0, 50, 1, "old", 0), (1, 0, 1, "new", 0), (1, 1, 2, "new", 0), (1, 2, 3, "new", 2), (2, 0, 1, "next", 2)]


def test_state_of_a_dead_stream_ends(spark):
    row = lambda s, i, at: (s, 0, i, f"2024-01-01 {at}", "a", 0.9)
    batches = [[row(1, 0, "00:00:00"), row(1, 1, "00:00:01")], [row(2, 0, "00:00:05"), row(1, 2, "00:09:00")], [row(2, 1, "02:00:00")],
               [row(2, 2, "02:00:01")], [row(1, 3, "02:00:02"), row(2, 3, "02:00:02")]]
    want = {0.0: 4, 600.0: 1}
    for idle, size in want.items():
        got = fed(spark, f"idle_{int(idle)}", batches, lambda s: live.stable_devices(s, idle_seconds=idle), "1 minute")
        out = {(r[0], r[1]): r[2] for r in rows(got, "stream_id", "frame_idx", "window_size")}
        assert out[1, 2] == 3 and out[1, 3] == size, (idle, out)


def test_rule_change_counts_for_next_batch(spark):
    folder, verdicts = tempfile.mkdtemp(), []
    current = {"severity": "normal"}

    def rules(s):
        return s.createDataFrame([("d", "RUN", "green", "steady", current["severity"], "m", 1)],
                                 "device string, indicator string, color string, state string, severity string, meaning string, ordinal int")

    def put(n):
        spark.createDataFrame([(f"r{n}", "d", [("RUN", "green", "steady", None)])],
                              "request_id string, device string, observations array<struct<indicator:string,color:string,state:string,confidence:double>>"
                              ).coalesce(1).write.mode("append").json(folder)

    from pilotlamp.sources.tables import stream_payloads
    put(1)
    q = live.judge_stream(stream_payloads(spark, folder), rules, lambda df, e: verdicts.extend(df.collect())).option(
        "checkpointLocation", tempfile.mkdtemp()).start()
    q.processAllAvailable()
    current["severity"] = "critical"
    put(2)
    q.processAllAvailable()
    q.stop()
    assert [(r["request_id"], r["status"], r["alarm"]) for r in verdicts] == [("r1", "normal", False), ("r2", "fault", True)]


def test_rule_log_keeps_latest(spark):
    log = spark.createDataFrame([("d", "RUN", "green", "steady", "normal", 1, 1), ("d", "RUN", "green", "steady", "critical", 2, 2)],
                                "device string, indicator string, color string, state string, severity string, ordinal int, updated_at int")
    assert [r["severity"] for r in live.latest_rules(log).collect()] == ["critical"]


def test_recorded_samples_through_the_engine_equal_the_fold(spark):
    """Several batches with state carried by the checkpoint give what the batch fold gives; the session is left as it was."""
    few = Tables(spark, SF).samples.filter("frame_idx < 400")
    before = spark.conf.get(live._PROVIDER, None)
    size = few.count() // 3
    cols = ["stream_id", "frame_idx", "candidate", "ratio", "mean", "window_size", "stable"]
    want = rows(live.replay(few, live.stable_devices).fillna("", ["candidate"]).fillna(0.0), *cols)
    got = live.stream_recorded(few, live.stable_devices, size)
    assert want and rows(got.fillna("", ["candidate"]).fillna(0.0), *cols) == want
    assert spark.conf.get(live._PROVIDER, None) == before
    assert live.stream_recorded(few.limit(0), live.routed_devices).count() == 0
    lost = few.withColumn("frame_idx", F.lit(None).cast("long"))
    with pytest.raises(ValueError, match="no frame number"):
        live.stream_recorded(lost, live.routed_devices)


def test_batches_open_stores_in_proportion_to_rows(spark, monkeypatch):
    """Ten times the rows opened a hundred times the stores; a busy stream still comes in bounded batches."""
    monkeypatch.setattr(live, "CHUNK_ROWS", 40)
    monkeypatch.setattr(live, "STATE_ROWS", 5)
    for total in (400, 4000):
        many = spark.range(total).select((F.col("id") % 100).alias("stream_id"), F.col("id").alias("frame_idx"))
        assert live._batches(many, total, 1000, None) == (total // 5, [])
    assert len(live._batches(many, 4000, 100, None)[1]) == 7
    busy = many.withColumn("stream_id", F.lit(1))
    assert 90 <= len(live._batches(busy, 4000, 100, None)[1]) <= 99
    assert len(live._batches(many, 4000, 100, 1000)[1]) == 3


def test_routes_of_many_streams_equal_those_row_by_row():
    """Epochs, short streams, ties and missing names: the fold of whole streams gives what the step gives."""
    import numpy as np
    import pandas as pd

    rng = np.random.default_rng(3)
    for interval, window in ((1, 5), (3, 4), (15, 5), (2, 1)):
        parts = [pd.DataFrame({"stream_id": i, "epoch": np.sort(rng.integers(0, 3, k)), "frame_idx": np.arange(k),
                               "class_name": rng.choice(np.array(["a", "b", "c", None], object), k), "confidence": rng.random(k)}) for i, k in enumerate((1, 2, 40, 97, 5))]
        router = live._Routed(interval, window)
        want = pd.concat([router.fold(p, None)[0] for p in parts], ignore_index=True)
        got = router.many(pd.concat(parts, ignore_index=True), np.cumsum([0, 1, 2, 40, 97]))
        pd.testing.assert_frame_equal(got.astype(object), want.astype(object))


def test_lanes_of_streams_equal_streams_one_by_one():
    """A key of many streams: one call and one trip to the store a batch; epochs that go on, start or come late, as one stream at a time gives them."""
    import json

    import numpy as np
    import pandas as pd

    class Store:
        body, trips = None, 0

        def exists(self):
            return self.body is not None

        def get(self):
            return self.body

        def update(self, body):
            self.body, self.trips = body, self.trips + 1

    rng = np.random.default_rng(5)
    for make in (lambda: live._Routed(3, 4), lambda: live._Routed(1, 5), lambda: live._Stable(4, 0.3, 0.75, 0.8, 0.0)):
        lane, store, saved = make(), Store(), {}
        lane.lanes, lane.state = True, store
        for batch in range(4):
            k = 200
            rows = pd.DataFrame({"lane": 0, "stream_id": rng.integers(0, 40, k), "epoch": rng.integers(max(0, batch - 2), batch + 1, k), "frame_idx": np.arange(k) + batch * k,
                                 "ts": pd.Timestamp(0), "class_name": rng.choice(np.array(["a", "b", "c", None], object), k), "confidence": np.where(rng.random(k) < 0.1, np.nan, rng.random(k))})
            want = []
            for stream, part in rows.sort_values(["stream_id", "epoch", "frame_idx"]).groupby("stream_id"):
                made, saved[str(stream)] = make().fold(part, saved.get(str(stream)))
                want.append(made)
            got, = lane.handleInputRows((0,), iter([rows[:70], rows[70:]]), None)
            pd.testing.assert_frame_equal(got.astype(object).where(got.notna(), None), (w := pd.concat(want, ignore_index=True)).astype(object).where(w.notna(), None))
            assert store.trips == batch + 1 and (batch < 2 or got["late"].max() > 0)
        left = {s: json.loads(b) for s, b in json.loads(store.body[0]).items()}
        assert str(left) == str({s: {c: json.loads(saved[s])[c] for c in b} for s, b in left.items()}) and set(left) == set(saved)
    lane, store = live._Routed(15, 5), Store()
    lane.lanes, lane.state = True, store
    out, = lane.handleInputRows((-1,), iter([rows.assign(lane=-1, stream_id=0)]), None)
    assert out["stream_id"].isna().all() and len(out) + out["late"].max() == 200


def test_recorded_streams_share_lanes(spark, monkeypatch):
    """Three thousand streams come as a few lanes, in several batches, with what a fold of each stream gives; rows without a stream are one."""
    monkeypatch.setattr(live, "STATE_ROWS", 1000)
    seen = []
    rows_ = spark.range(9000).select(F.when(F.col("id") % 3000 != 7, F.col("id") % 3000).alias("stream_id"), F.col("id").alias("frame_idx"), F.lit("2024-01-01").cast("timestamp").alias("ts"),
                                     F.when(F.col("id") % 11 != 0, F.concat(F.lit("c"), (F.col("id") * 7 % 5).cast("string"))).alias("class_name"), (F.col("id") % 10 / 10).alias("confidence"))

    def vote(s):
        seen.append(s.columns)
        return live.routed_devices(s, 2, 5)

    cols = ["stream_id", "frame_idx", "position", "voted", "device", "device_confidence"]
    flat = lambda df: rows(df.fillna(-1, ["stream_id"]).fillna("", ["voted", "device"]), *cols)
    got = live.stream_recorded(rows_, vote, 2500)
    assert flat(got) == flat(live.replay(rows_, lambda s: live.routed_devices(s, 2, 5)))
    assert "lane" in seen[0] and "lane" not in got.columns
    assert live._with_lanes(rows_, 4, 3000).select("lane").distinct().count() <= 4 * live.LANES + 1
    assert live._with_lanes(rows_, 4, 300_000).agg(F.max("lane")).first()[0] >= 300_000 // live.LANE_STREAMS - 2


def test_a_busy_stream_does_not_cut_batches_further_than_it_must(spark, monkeypatch):
    """A stream of a tenth of the rows halves the batches a few times; they are not all cut to the least size."""
    monkeypatch.setattr(live, "CHUNK_ROWS", 40)
    monkeypatch.setattr(live, "STATE_ROWS", 10)
    some = spark.range(8000).select(F.when(F.col("id") % 10 == 0, -1).otherwise(F.col("id") % 1000).alias("stream_id"), F.col("id").alias("frame_idx"))
    assert 15 <= len(live._batches(some, 8000, 100, None)[1]) <= 40
