"""Votes over classifier samples, and routing of a voted device to its detector."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pilotlamp.operators import ordered

WINDOW = 8
MIN_FRAME_CONFIDENCE = 0.60
MIN_RATIO = 0.75
MIN_MEAN = 0.80
SHORT_WINDOW = 5
LATENCY_WINDOW = 30
ROUTE_CONFIDENCE = 0.70


def winner(samples: DataFrame, keys: Sequence[str], label: str, confidence: str, position: str) -> DataFrame:
    """Most frequent label per group, its share and mean confidence; ties go to the label seen first."""
    per = samples.groupBy(*keys, label).agg(
        F.count(F.lit(1)).alias("votes"), F.sum(confidence).alias("total"), F.min(position).alias("first_seen"))
    # partial sums by label first, so a busy stream shrinks before its labels meet
    negative = F.struct((-F.col("votes")).alias("less"), "first_seen")
    out = per.groupBy(*keys).agg(
        F.min_by(F.struct(label, "votes", (F.col("total") / F.col("votes")).alias("mean")), negative).alias("w"),
        F.sum("votes").alias("samples"))
    return out.select(*keys, F.col(f"w.{label}").alias("winner"), (F.col("w.votes") / F.col("samples")).alias("ratio"),
                      F.col("w.mean").alias("mean"), "samples")


def vote_of(samples: Column) -> Column:
    """Vote over an array of struct(label, confidence) in arrival order: struct(winner, ratio, mean, size)."""
    labels = F.array_distinct(F.transform(samples, lambda s: s["label"]))
    counted = F.transform(labels, lambda name, i: F.struct(
        F.size(F.filter(samples, lambda s: s["label"] == name)).alias("votes"), (-i).alias("seen"), name.alias("label")))
    best = F.array_max(counted)
    total = F.aggregate(samples, F.lit(0.0),
                        lambda acc, s: acc + F.when(s["label"] == best["label"], s["confidence"]).otherwise(0.0))
    return F.struct(best["label"].alias("winner"), (best["votes"] / F.size(samples)).alias("ratio"),
                    (total / best["votes"]).alias("mean"), F.size(samples).alias("size"))


def is_stable(vote: Column, window: int = WINDOW, ratio: float = MIN_RATIO, mean: float = MIN_MEAN) -> Column:
    return (vote["size"] >= min(3, window)) & (vote["ratio"] >= ratio) & (vote["mean"] >= mean)


def running_votes(samples: DataFrame, keys: Sequence[str], order: ordered.Order, label: str, confidence: str,
                  window: int = WINDOW, min_confidence: float = MIN_FRAME_CONFIDENCE,
                  chunk_rows: int = ordered.BUCKET_ROWS) -> DataFrame:
    """Vote over the last ``window`` accepted samples at every sample; rejected samples keep the last vote."""
    accepted = F.col(confidence) >= min_confidence
    item = F.struct(F.col(label).alias("label"), F.col(confidence).cast("double").alias("confidence"))
    voted = ordered.trailing(samples.filter(accepted), keys, order, window, F.collect_list(item), "history",
                             "_pl_at", chunk_rows)
    voted = voted.withColumn("vote", vote_of(F.col("history"))).drop("history", "_pl_at")
    rest = samples.filter(~accepted | F.col(confidence).isNull())
    every = voted.unionByName(rest.withColumn("vote", F.lit(None).cast(voted.schema["vote"].dataType)))
    filled = ordered.fill_down(every, keys, order, ["vote"], chunk_rows)
    v = F.col("vote")
    return filled.select(
        *samples.columns, v["winner"].alias("candidate"), v["ratio"].alias("ratio"), v["mean"].alias("mean"),
        F.coalesce(v["size"], F.lit(0)).alias("window_size"),
        F.coalesce(is_stable(v, window), F.lit(False)).alias("stable"))


def final_votes(samples: DataFrame, keys: Sequence[str], order: ordered.Order, label: str, confidence: str,
                window: int = WINDOW, min_confidence: float = MIN_FRAME_CONFIDENCE) -> DataFrame:
    """Vote over the last ``window`` accepted samples of a group: the decision at the end of a file."""
    reverse = [(c, "desc" if d == "asc" else "asc") for c, d in order]
    last = ordered.top_in_groups(samples.filter(F.col(confidence) >= min_confidence), keys, reverse, window, "_pl_at")
    item = F.struct((-F.col("_pl_at")).alias("at"), F.col(label).alias("label"),
                    F.col(confidence).cast("double").alias("confidence"))
    v = F.col("vote")
    return last.groupBy(*keys).agg(vote_of(F.sort_array(F.collect_list(item))).alias("vote")).select(
        *keys, v["winner"].alias("candidate"), v["ratio"].alias("ratio"), v["mean"].alias("mean"),
        v["size"].alias("window_size"), is_stable(v, window).alias("stable"))


def interval_votes(samples: DataFrame, keys: Sequence[str], order: ordered.Order, label: str, confidence: str,
                   interval: int = 15, window: int = SHORT_WINDOW) -> DataFrame:
    """Device recognised every ``interval`` frames, vote over its last ``window`` results, both carried forward."""
    ranked = ordered.rank_in_groups(samples, keys, order, "position")
    due = (F.col("position") - 1) % interval == 0
    item = F.struct(F.col(label).alias("label"), F.col(confidence).cast("double").alias("confidence"))
    voted = ordered.trailing(ranked.filter(due), keys, order, window, F.collect_list(item), "history", "_pl_at")
    voted = voted.withColumn("vote", F.struct(
        vote_of(F.col("history"))["winner"].alias("voted"), F.col(label).alias("device"),
        F.col(confidence).cast("double").alias("device_confidence"))).drop("history", "_pl_at")
    rest = ranked.filter(~due).withColumn("vote", F.lit(None).cast(voted.schema["vote"].dataType))
    return ordered.fill_down(voted.unionByName(rest), keys, order, ["vote"]).select(
        *samples.columns, "position", "vote.voted", "vote.device", "vote.device_confidence")


def rolling_fps(samples: DataFrame, keys: Sequence[str], order: ordered.Order, seconds: Column,
                window: int = LATENCY_WINDOW) -> DataFrame:
    """Frames per second from the mean of the last ``window`` latencies."""
    out = ordered.trailing(samples.withColumn("_pl_s", seconds), keys, order, window, F.avg("_pl_s"), "mean_latency",
                           "_pl_at")
    return out.withColumn("fps", 1.0 / F.greatest(F.col("mean_latency"), F.lit(1e-9))).drop("_pl_s", "_pl_at")


def route(voted: DataFrame, registry: DataFrame, min_confidence: float = ROUTE_CONFIDENCE) -> DataFrame:
    """Detector of the voted device. ``registry``: device, detector, present."""
    r = registry.select(F.col("device").alias("voted"), "detector", "present", F.lit(True).alias("configured"))
    j = voted.join(r, "voted", "left")
    sure = (F.col("device_confidence") >= min_confidence) & (F.col("device") == F.col("voted"))
    status = (F.when(~F.coalesce(sure, F.lit(False)), "not_stable").when(F.col("configured").isNull(), "not_configured")
              .when(~F.col("present"), "detector_missing").otherwise("routed"))
    return j.withColumn("route_status", status).withColumn(
        "detector", F.when(F.col("route_status") == "routed", F.col("detector"))).drop("present", "configured")


def top_classes(scores: Column, k: int = 5) -> Column:
    """First ``k`` of an array of struct(class_name, confidence), highest confidence first."""
    keyed = F.transform(scores, lambda s, i: F.struct((-s["confidence"]).alias("less"), i.alias("i"), s.alias("s")))
    return F.transform(F.slice(F.sort_array(keyed), 1, k), lambda x: x["s"])


def class_counts(detections: DataFrame, frame_keys: Sequence[str], label: str) -> DataFrame:
    return detections.groupBy(*frame_keys, label).agg(F.count(F.lit(1)).alias("n"))


def apply_scorer(df: DataFrame, make_scorer: Callable[[], Callable[[pd.DataFrame], pd.DataFrame]],
                 schema: str) -> DataFrame:
    """Run a model over Arrow batches. ``make_scorer`` loads the model once per task and returns batch -> rows."""
    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        scorer = make_scorer()
        for batch in batches:
            yield scorer(batch)

    return df.mapInPandas(score, schema)
