"""Queries: votes over classifier samples."""

import pandas as pd
from pyspark.sql import functions as F

from pilotlamp.operators import ordered, voting
from pilotlamp.plans.registry import Tables, query

_ORDER = [("ts", "asc"), ("frame_idx", "asc")]


@query("a06_majority_vote", """
    WITH c AS (SELECT stream_id, class_name, count(*) AS votes, avg(confidence) AS mean, min(frame_idx) AS first_seen
      FROM {samples} GROUP BY 1, 2),
    r AS (SELECT *, row_number() OVER (PARTITION BY stream_id ORDER BY votes DESC, first_seen) AS rn,
      sum(votes) OVER (PARTITION BY stream_id) AS samples FROM c)
    SELECT stream_id, class_name AS winner, round(votes / samples, 6) AS ratio, round(mean, 6) AS mean, CAST(samples AS BIGINT) AS samples
    FROM r WHERE rn = 1""")
def a06(t: Tables):
    w = voting.winner(t.samples, ["stream_id"], "class_name", "confidence", "frame_idx")
    return w.withColumn("ratio", F.round("ratio", 6)).withColumn("mean", F.round("mean", 6))


_RUNNING = """
    WITH acc AS (SELECT *, row_number() OVER (PARTITION BY stream_id ORDER BY ts, frame_idx) AS rn
      FROM {samples} WHERE confidence >= 0.6),
    h AS (SELECT a.stream_id, a.frame_idx, b.class_name, count(*) AS votes, sum(b.confidence) AS total, min(b.rn) AS seen
      FROM acc a JOIN acc b ON a.stream_id = b.stream_id AND b.rn BETWEEN a.rn - 7 AND a.rn GROUP BY 1, 2, 3),
    v AS (SELECT *, row_number() OVER (PARTITION BY stream_id, frame_idx ORDER BY votes DESC, seen) AS k,
      sum(votes) OVER (PARTITION BY stream_id, frame_idx) AS size FROM h),
    x AS (SELECT s.stream_id, s.frame_idx, s.ts, v.class_name, v.votes, v.total, v.size
      FROM {samples} s LEFT JOIN v ON s.stream_id = v.stream_id AND s.frame_idx = v.frame_idx AND v.k = 1),
    f AS (SELECT stream_id, frame_idx, ts, last_value(class_name IGNORE NULLS) OVER w AS candidate,
      last_value(votes / size IGNORE NULLS) OVER w AS ratio, last_value(total / votes IGNORE NULLS) OVER w AS mean,
      last_value(size IGNORE NULLS) OVER w AS size
      FROM x WINDOW w AS (PARTITION BY stream_id ORDER BY ts, frame_idx ROWS UNBOUNDED PRECEDING))
"""


@query("w04_running_vote", _RUNNING + """
    SELECT stream_id, frame_idx, candidate, round(ratio, 6) AS ratio, round(mean, 6) AS mean,
      CAST(coalesce(size, 0) AS INTEGER) AS window_size,
      coalesce(size >= 3 AND ratio >= 0.75 AND round(mean, 9) >= 0.80, false) AS stable FROM f""")
def w04(t: Tables):
    v = voting.running_votes(t.samples, ["stream_id"], _ORDER, "class_name", "confidence")
    stable = (F.col("window_size") >= 3) & (F.col("ratio") >= 0.75) & (F.round("mean", 9) >= 0.80)
    return v.select("stream_id", "frame_idx", "candidate", F.round("ratio", 6).alias("ratio"),
                    F.round("mean", 6).alias("mean"), "window_size", F.coalesce(stable, F.lit(False)).alias("stable"))


@query("st01_replayed_votes", _RUNNING + """
    SELECT stream_id, frame_idx, candidate, round(ratio, 6) AS ratio, round(mean, 6) AS mean,
      CAST(coalesce(size, 0) AS INTEGER) AS window_size,
      coalesce(size >= 3 AND ratio >= 0.75 AND round(mean, 9) >= 0.80, false) AS stable FROM f""")
def st01(t: Tables):
    from pilotlamp.streaming import live
    v = live.replay(t.samples, lambda s: live.stable_devices(s, 8, 0.6))
    stable = (F.col("window_size") >= 3) & (F.col("ratio") >= 0.75) & (F.round("mean", 9) >= 0.80)
    return v.select("stream_id", "frame_idx", "candidate", F.round("ratio", 6).alias("ratio"),
                    F.round("mean", 6).alias("mean"), "window_size", F.coalesce(stable, F.lit(False)).alias("stable"))


_STABLE = """
    SELECT stream_id, frame_idx, candidate, round(ratio, 6) AS ratio, round(mean, 6) AS mean,
      CAST(coalesce(size, 0) AS INTEGER) AS window_size,
      coalesce(size >= 3 AND ratio >= 0.75 AND round(mean, 9) >= 0.80, false) AS stable FROM f"""


def _stable(votes):
    stable = (F.col("window_size") >= 3) & (F.col("ratio") >= 0.75) & (F.round("mean", 9) >= 0.80)
    return votes.select("stream_id", "frame_idx", "candidate", F.round("ratio", 6).alias("ratio"), F.round("mean", 6).alias("mean"),
                        "window_size", F.coalesce(stable, F.lit(False)).alias("stable"))


@query("st01_streamed_votes", _RUNNING + _STABLE)
def st01_streamed(t: Tables):
    from pilotlamp.streaming import live
    return _stable(live.stream_recorded(t.samples, lambda s: live.stable_devices(s, 8, 0.6)))


# a looped file starts again every 500 frames: each run of it votes on its own
_LOOPED = ("\n    WITH looped AS (SELECT * REPLACE (stream_id * 100000 + frame_idx // 500 AS stream_id) FROM {samples})," +
           _RUNNING.replace("WITH acc", " acc", 1).replace("{samples}", "looped") + _STABLE.replace(
               "SELECT stream_id", "SELECT stream_id // 100000 AS stream_id"))


@query("st05_streamed_restarts", _LOOPED)
def st05_streamed(t: Tables):
    from pilotlamp.streaming import live
    looped = t.samples.withColumn("epoch", F.floor(F.col("frame_idx") / 500).cast("int"))
    return _stable(live.stream_recorded(looped, lambda s: live.stable_devices(s, 8, 0.6)))


_SAMPLED = """
    WITH RECURSIVE pick AS (
      SELECT stream_id, min(frame_idx) AS frame_idx, arg_min(ts, frame_idx) AS ts FROM {samples} GROUP BY stream_id
      UNION ALL
      SELECT s.stream_id, min(s.frame_idx), arg_min(s.ts, s.frame_idx) FROM pick p JOIN {samples} s ON s.stream_id = p.stream_id
        AND s.frame_idx > p.frame_idx AND s.ts >= p.ts + INTERVAL 2 HOUR GROUP BY s.stream_id)
    SELECT stream_id, frame_idx FROM pick"""


@query("st06_streamed_sampling", _SAMPLED)
def st06_streamed(t: Tables):
    from pilotlamp.streaming import live
    return live.stream_recorded(t.samples, lambda s: live.stable_devices(s, sample_seconds=7200.0)).select("stream_id", "frame_idx")


@query("w04_final_vote", _RUNNING + """
    SELECT stream_id, candidate, round(ratio, 6) AS ratio, round(mean, 6) AS mean, CAST(size AS INTEGER) AS window_size
    FROM (SELECT *, row_number() OVER (PARTITION BY stream_id ORDER BY ts DESC, frame_idx DESC) AS k FROM f)
    WHERE k = 1 AND size IS NOT NULL""")
def w04_final(t: Tables):
    v = voting.final_votes(t.samples, ["stream_id"], _ORDER, "class_name", "confidence")
    return v.select("stream_id", "candidate", F.round("ratio", 6).alias("ratio"), F.round("mean", 6).alias("mean"),
                    "window_size")


_INTERVAL = """
    WITH p AS (SELECT *, row_number() OVER (PARTITION BY stream_id ORDER BY ts, frame_idx) AS position FROM {samples}),
    d AS (SELECT *, row_number() OVER (PARTITION BY stream_id ORDER BY position) AS rn FROM p
      WHERE (position - 1) % 15 = 0),
    h AS (SELECT a.stream_id, a.position, b.class_name, count(*) AS votes, min(b.rn) AS seen
      FROM d a JOIN d b ON a.stream_id = b.stream_id AND b.rn BETWEEN a.rn - 4 AND a.rn GROUP BY 1, 2, 3),
    v AS (SELECT *, row_number() OVER (PARTITION BY stream_id, position ORDER BY votes DESC, seen) AS k FROM h),
    x AS (SELECT p.*, v.class_name AS winner, CASE WHEN v.k = 1 THEN p.class_name END AS device0,
        CASE WHEN v.k = 1 THEN p.confidence END AS conf0
      FROM p LEFT JOIN v ON p.stream_id = v.stream_id AND p.position = v.position AND v.k = 1),
    f AS (SELECT stream_id, frame_idx, position, last_value(winner IGNORE NULLS) OVER w AS voted,
        last_value(device0 IGNORE NULLS) OVER w AS device, last_value(conf0 IGNORE NULLS) OVER w AS device_confidence
      FROM x WINDOW w AS (PARTITION BY stream_id ORDER BY position ROWS UNBOUNDED PRECEDING))
"""


def _interval(t: Tables):
    return voting.interval_votes(t.samples, ["stream_id"], _ORDER, "class_name", "confidence").select(
        "stream_id", "frame_idx", "position", "voted", "device", "device_confidence")


@query("w05_interval_vote", _INTERVAL + "SELECT * FROM f")
def w05(t: Tables):
    return _interval(t)


@query("st02_replayed_routes", _INTERVAL + "SELECT * FROM f")
def st02(t: Tables):
    from pilotlamp.streaming import live
    return live.replay(t.samples, lambda s: live.routed_devices(s, 15, 5)).drop("epoch", "late")


@query("st02_streamed_routes", _INTERVAL + "SELECT * FROM f")
def st02_streamed(t: Tables):
    from pilotlamp.streaming import live
    return live.stream_recorded(t.samples, lambda s: live.routed_devices(s, 15, 5)).drop("epoch", "late")


@query("j18_detector_routing", _INTERVAL + """
    SELECT f.*, CASE WHEN device_confidence >= 0.7 AND device = voted AND voted NOT IN ('error')
                       AND voted NOT IN ('view') THEN concat('detector_', voted) END AS detector,
      CASE WHEN NOT (device_confidence >= 0.7 AND device = voted) THEN 'not_stable'
           WHEN voted = 'error' THEN 'not_configured' WHEN voted = 'view' THEN 'detector_missing'
           ELSE 'routed' END AS route_status FROM f""")
def j18(t: Tables):
    registry = t.samples.select(F.col("class_name").alias("device")).distinct().filter("device <> 'error'").select(
        "device", F.concat(F.lit("detector_"), "device").alias("detector"), (F.col("device") != "view").alias("present"))
    return voting.route(_interval(t), registry)


@query("w06_rolling_fps", """
    SELECT stream_id, frame_idx, round(1 / greatest(round(avg(latency_ms / 1000e0) OVER (
      PARTITION BY stream_id ORDER BY ts, frame_idx ROWS 29 PRECEDING), 9), 1e-9), 4) AS fps FROM {samples}""")
def w06(t: Tables):
    v = voting.rolling_fps(t.samples, ["stream_id"], _ORDER, F.col("latency_ms") / 1000.0)
    fps = 1.0 / F.greatest(F.round("mean_latency", 9), F.lit(1e-9))
    return v.select("stream_id", "frame_idx", F.round(fps, 4).alias("fps"))


@query("a16_class_counts_per_frame", """
    SELECT image, class_id, count(*) AS n FROM {boxes} GROUP BY image, class_id""")
def a16(t: Tables):
    return voting.class_counts(t.boxes, ["image"], "class_id")


@query("st07_skip_ahead", "SELECT stream_id, frame_idx, class_name FROM {samples} WHERE frame_idx % 3 = 0")
def st07(t: Tables):
    from pilotlamp.streaming.live import skip_ahead
    return skip_ahead(t.samples, 2).select("stream_id", "frame_idx", "class_name")


@query("s04_top_classes", """
    WITH s AS (SELECT vec_id, CAST(unnest(generate_series(1, len(embedding))) AS INTEGER) AS i, embedding FROM {embeddings}),
    r AS (SELECT vec_id, i, round(CAST(embedding[i] AS DOUBLE), 6) AS confidence,
      row_number() OVER (PARTITION BY vec_id ORDER BY embedding[i] DESC, i) AS place FROM s)
    SELECT vec_id, CAST(place AS INTEGER) AS place, concat('class_', CAST(i AS VARCHAR)) AS class_name, confidence
    FROM r WHERE place <= 3""")
def s04(t: Tables):
    scores = F.transform("embedding", lambda x, i: F.struct(
        F.concat(F.lit("class_"), (i + 1).cast("string")).alias("class_name"), x.cast("double").alias("confidence")))
    best = t.embeddings.select("vec_id", F.posexplode(voting.top_classes(scores, 3)).alias("p", "s"))
    return best.select("vec_id", (F.col("p") + 1).alias("place"), "s.class_name", F.round("s.confidence", 6).alias("confidence"))


@query("u01_batch_scorer", """
    SELECT vec_id, concat('class_', CAST(list_position(embedding, list_max(embedding)) AS VARCHAR)) AS class_name,
      round(CAST(list_max(embedding) AS DOUBLE), 6) AS confidence FROM {embeddings}""")
def u01(t: Tables):
    def make():
        def score(batch: pd.DataFrame) -> pd.DataFrame:
            top = batch["embedding"].map(lambda v: int(v.argmax()))
            return pd.DataFrame({"vec_id": batch["vec_id"], "class_name": top.map(lambda i: f"class_{i + 1}"),
                                 "confidence": [round(float(v[i]), 6) for v, i in zip(batch["embedding"], top)]})
        return score

    return voting.apply_scorer(t.embeddings.select("vec_id", "embedding"), make,
                               "vec_id long, class_name string, confidence double")
