"""A request from payload to decision: names resolved, rules merged and matched, verdict gated, failures as rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pilotlamp.functions import text
from pilotlamp.operators import judge, names, ordered, rules
from pilotlamp.session import durable


def split_payloads(requests: DataFrame, min_confidence: float = 0.60, colors: Sequence[str] = (),
                   states: Sequence[str] = ()) -> tuple[DataFrame, DataFrame]:
    """Accepted observations, and one row per request with what was dropped and why the whole request fails, if it does.

    A request fails without a device, without observations, or when none of them is accepted.
    """
    rows = judge.validate(judge.explode_requests(requests), min_confidence, colors, states)
    empty = F.col("index").isNull()
    rows = durable(rows.withColumn("drop_reason", F.when(~empty, F.col("drop_reason"))))  # read by the report and every lookup
    accepted = ~empty & F.col("drop_reason").isNull()
    note = F.when(F.col("drop_reason").isNotNull(), F.struct("index", "drop_reason"))
    report = rows.groupBy("request_id", "device").agg(  # a payload's own observations: as short as the payload
        F.sort_array(F.collect_list(note)).alias("notes"), F.count_if(~empty).alias("given"), F.count_if(accepted).alias("accepted"))
    error = (F.when(F.coalesce("device", F.lit("")) == "", "missing_device").when(F.col("given") == 0, "missing_observations")
             .when(F.col("accepted") == 0, "no_valid_observations"))
    dropped = F.transform("notes", lambda n: F.concat_ws(":", n["index"].cast("string"), n["drop_reason"]))
    report = report.select("request_id", "device", dropped.alias("dropped"), error.alias("error"))
    return rows.filter(accepted & (F.coalesce("device", F.lit("")) != "")), report


def match_requests(observations: DataFrame, aliases: DataFrame, known: DataFrame) -> DataFrame:
    """Observations with the device and indicator of the rules they mean, and their rule or the reason for having none.

    Devices are looked up among the aliases first, then among the devices of the rules; indicators among those of
    the device. Colours and states are read as in requests. Work on names is done on distinct names.
    """
    devices = names.resolve_devices(observations.select("device").distinct(), aliases, known).select(
        F.col("name").alias("device_key"), "canonical_name", "rule_name")
    asked = observations.select(
        "request_id", "index", F.col("device").alias("requested_device"), text.clean_text(F.col("device")).alias("device_key"),
        text.clean_text(F.col("indicator")).alias("name"), text.request_color(F.col("color")).alias("color"),
        text.request_state(F.col("state")).alias("state"))
    asked = ordered.join_keys(asked, devices, ["device_key"], "left").withColumnRenamed("rule_name", "device")
    listed = known.select("device").distinct().withColumn("listed", F.lit(True))
    asked = ordered.join_keys(asked, listed, ["device"], "left")
    lamps = names.match_indicators(asked.filter("listed").select("device", "name").distinct(), known).select(
        "device", "name", F.col("choice").alias("indicator"))
    asked = ordered.join_keys(asked, lamps, ["device", "name"], "left")
    found = judge.match_observations(asked, known)
    reason = (F.when(F.col("device").isNull(), "device_not_found_in_rules")
              .when(F.col("listed").isNull(), "resolved_rule_name_not_found")
              .when(F.col("indicator").isNull(), "indicator_not_found_in_rules").otherwise(F.col("reason")))
    return found.withColumn("reason", reason).drop("listed", "device_key")


def judge_requests(requests: DataFrame, aliases: DataFrame, base: DataFrame, custom: DataFrame | None = None,
                   answers: DataFrame | None = None, min_confidence: float = 0.60, colors: Sequence[str] = (),
                   states: Sequence[str] = ()) -> DataFrame:
    """One row per request: decision, its reason lines, dropped observations, and ``error`` for a request that fails.

    ``answers`` are read model answers (see ``judge.read_answers``); without them an open request stays uncertain.
    """
    known = base if custom is None else rules.merge_custom(base, custom)
    good, report = split_payloads(requests, min_confidence, colors, states)
    matched = durable(match_requests(good, aliases, known))  # read by the verdicts and the lines
    verdicts = judge.roll_up(matched)
    if answers is None:
        answers = requests.sparkSession.createDataFrame(
            [], "request_id string, model_status string, model_severity string, model_alarm boolean, model_review boolean")
    decided = judge.gate(verdicts, answers)
    line = F.when(F.col("reason").isNotNull(), F.col("reason")).otherwise(F.format_string(
        "%s：%s %s -> %s (%s, source=%s)", "indicator", "color", "state", "meaning", "severity", "rule_source"))
    lines = matched.groupBy("request_id").agg(  # as many as the payload's observations
        F.sort_array(F.collect_list(F.struct("index", line.alias("line")))).alias("l"), F.min("canonical_name").alias("canonical_name"))
    lines = lines.select("request_id", "canonical_name", F.transform("l", lambda x: x["line"]).alias("reasons"))
    out = report.join(lines, "request_id", "left").join(decided, "request_id", "left")
    failed = F.col("error").isNotNull()
    return out.select(
        "request_id", "device", "canonical_name", F.when(failed, "error").otherwise(F.col("status")).alias("status"), "severity",
        F.coalesce("alarm", F.lit(False)).alias("alarm"), "decision_source", F.coalesce("needs_review", F.lit(True)).alias("needs_review"),
        F.coalesce("reasons", F.array().cast("array<string>")).alias("reasons"), "dropped", "error")


def vocabulary_gaps(known: DataFrame) -> DataFrame:
    """Colours and states of rules that no request can name: reading them as a request gives another word."""
    words = known.select(F.explode(F.array(
        F.struct(F.lit("color").alias("kind"), F.col("color").alias("word"), text.request_color(F.col("color")).alias("as_request")),
        F.struct(F.lit("state").alias("kind"), F.col("state").alias("word"), text.request_state(F.col("state")).alias("as_request")),
    )).alias("w")).select("w.*")
    return words.filter(~F.col("word").eqNullSafe(F.col("as_request"))).groupBy("kind", "word", "as_request").agg(F.count(F.lit(1)).alias("rules"))
