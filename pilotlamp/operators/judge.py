"""From observations to verdicts: validation, rule matching, roll-up and the alarm gate."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pilotlamp.functions import text
from pilotlamp.operators import ordered

ALARMS = ["warning", "critical"]
KEY = ["device", "indicator", "color", "state"]

OBSERVATION = T.StructType([
    T.StructField("indicator", T.StringType()), T.StructField("color", T.StringType()),
    T.StructField("state", T.StringType()), T.StructField("confidence", T.DoubleType())])
REQUEST = T.StructType([
    T.StructField("request_id", T.StringType()), T.StructField("device", T.StringType()),
    T.StructField("observations", T.ArrayType(OBSERVATION))])
ANSWER = T.StructType([
    T.StructField("status", T.StringType()), T.StructField("severity", T.StringType()),
    T.StructField("alarm", T.BooleanType()), T.StructField("needs_review", T.BooleanType()),
    T.StructField("reason", T.ArrayType(T.StringType())), T.StructField("possible_fault", T.StringType()),
    T.StructField("evidence", T.ArrayType(T.StructType([
        T.StructField("source_index", T.IntegerType()), T.StructField("statement", T.StringType())])))])


def explode_requests(requests: DataFrame) -> DataFrame:
    """One row per observation of a payload, with its index and default values."""
    rows = requests.select("request_id", "device", F.posexplode_outer("observations").alias("index", "o"))
    return rows.select(
        "request_id", F.trim("device").alias("device"), "index",
        F.col("o").isNull().alias("not_object"),
        F.trim(F.coalesce("o.indicator", F.lit(""))).alias("indicator"),
        F.trim(F.coalesce("o.color", F.lit("unknown"))).alias("color"),
        F.trim(F.coalesce("o.state", F.lit("unknown"))).alias("state"),
        F.coalesce("o.confidence", F.lit(1.0)).alias("confidence"))


def validate(observations: DataFrame, min_confidence: float = 0.60, colors: Sequence[str] = (),
             states: Sequence[str] = ()) -> DataFrame:
    """Add ``drop_reason``: NULL when accepted, else the first failing check."""
    checks: list[tuple[Column, str]] = []
    if "not_object" in observations.columns:
        checks.append((F.col("not_object"), "observation_not_object"))
    checks += [(F.col("indicator") == "", "missing_indicator"),
               (F.col("confidence") < min_confidence, "low_confidence")]
    if colors:
        checks.append((~F.col("color").isin(*colors), "unsupported_color"))
    if states:
        checks.append((~F.col("state").isin(*states), "unsupported_state"))
    reason = F.lit(None).cast("string")
    for cond, name in reversed(checks):
        reason = F.when(cond, name).otherwise(reason)
    return observations.withColumn("drop_reason", reason)


def payload_report(validated: DataFrame) -> DataFrame:
    """Per request: accepted and dropped counts; a request without accepted rows is an error."""
    ok = F.col("drop_reason").isNull()
    return validated.groupBy("request_id", "device").agg(
        F.count_if(ok).alias("accepted"), F.count_if(~ok).alias("dropped"),
        (F.count_if(ok) == 0).alias("payload_error"))


def rule_accepts(rule_color: Column, rule_state: Column, color: Column, state: Column) -> Column:
    """Colour and state agree, where ``unknown`` on either side agrees with everything."""
    color_ok = (color == "unknown") | (rule_color == "unknown") | (color == rule_color)
    state_ok = ((state == "unknown") | (rule_state == "unknown") | (state == rule_state)
                | ((rule_state == "steady_or_blinking") & state.isin("steady", "blinking")))
    return color_ok & state_ok


def distinct_rules(rules: DataFrame) -> DataFrame:
    """Rules that differ in outcome or condition, with their count and the first ordinal."""
    source = F.col("rule_source") if "rule_source" in rules.columns else F.lit("base")
    return (rules.withColumn("rule_source", source)
            .groupBy(*KEY, "severity", "meaning")
            .agg(F.count(F.lit(1)).alias("rule_count"), F.min("ordinal").alias("ordinal"),
                 F.min_by("rule_source", "ordinal").alias("rule_source")))


def match_keys(keys: DataFrame, rules: DataFrame) -> DataFrame:
    """Resolve distinct (device, indicator, color, state) against the rules.

    Output per key: ``matches``, ``reason`` (NULL when resolved) and the winning rule. Work is done on
    distinct keys and distinct rules, so it grows with the vocabulary and not with the observations.
    """
    compact = distinct_rules(rules)
    pairs = compact.select("device", "indicator").distinct()
    devices = pairs.select("device").distinct().withColumn("known_device", F.lit(True))
    known = (keys.select(*KEY).distinct()
             .join(devices, "device", "left")
             .join(pairs.withColumn("known_pair", F.lit(True)), ["device", "indicator"], "left"))
    r = compact.select("device", "indicator", F.col("color").alias("r_color"), F.col("state").alias("r_state"),
                       "severity", "meaning", "rule_count", "ordinal", "rule_source")
    k = known.alias("k")
    hit = k.join(r.alias("r"), (F.col("k.device") == F.col("r.device")) & (F.col("k.indicator") == F.col("r.indicator"))
                 & rule_accepts(F.col("r_color"), F.col("r_state"), F.col("k.color"), F.col("k.state")))
    outcome = F.struct("r.severity", "r.meaning")
    verdict = hit.groupBy(*[F.col(f"k.{c}").alias(c) for c in KEY]).agg(
        F.sum("rule_count").alias("matches"), (F.min(outcome) == F.max(outcome)).alias("one_outcome"),
        F.min_by(F.struct("r.severity", "r.meaning", "r.ordinal", "r.rule_source"), "r.ordinal").alias("rule"))
    done = F.coalesce("one_outcome", F.lit(False))
    reason = (F.when(F.col("known_device").isNull(), "device_not_found_in_rules")
              .when(F.col("known_pair").isNull(), "indicator_not_found_in_rules")
              .when(F.col("matches").isNull(), "no_exact_rule")
              .when(~done, "multiple_conflicting_rules"))
    out = known.join(verdict, KEY, "left")
    return out.select(*KEY, F.coalesce("matches", F.lit(0)).alias("matches"), reason.alias("reason"),
                      *[F.when(done, F.col(f"rule.{c}")).alias(c) for c in ("severity", "meaning", "ordinal",
                                                                          "rule_source")])


def match_observations(observations: DataFrame, rules: DataFrame) -> DataFrame:
    """Observations with their resolution; distinct keys are resolved once and joined back.

    NULL equals NULL, so an observation without a device stays, as ``device_not_found_in_rules``.
    """
    return ordered.join_keys(observations, match_keys(observations, rules), KEY)


def strongest(severity: Column) -> Column:
    """Aggregate: the highest known severity, ``unknown`` when there is none."""
    rank = text.severity_rank(severity)
    known = F.when(rank >= 0, rank)
    return F.coalesce(F.max_by(severity, known), F.lit("unknown"))


def status_of(severity: Column) -> Column:
    return (F.when(severity == "critical", "fault").when(severity.isin("warning", "info", "normal"), severity)
            .otherwise("unknown"))


def roll_up(matched: DataFrame, keys: Sequence[str] = ("request_id",)) -> DataFrame:
    """Verdict per request: complete only when every observation has one rule with a known severity."""
    resolved = F.col("reason").isNull()
    out = matched.groupBy(*keys).agg(
        F.count_if(resolved).alias("resolved"), F.count_if(~resolved).alias("unresolved"),
        F.count_if(resolved & (F.col("severity") == "unknown")).alias("unknown_rules"),
        strongest(F.col("severity")).alias("severity"))
    return out.select(
        *keys, "resolved", "unresolved",
        ((F.col("resolved") > 0) & (F.col("unresolved") == 0) & (F.col("unknown_rules") == 0)).alias("complete"),
        status_of(F.col("severity")).alias("status"), "severity", F.col("severity").isin(*ALARMS).alias("alarm"))


def read_answers(answers: DataFrame, content: str = "content") -> DataFrame:
    """Parse model answers; missing fields get the cautious defaults."""
    a = F.from_json(text.json_object(F.col(content)), ANSWER)
    return answers.withColumn("a", a).select(
        *answers.columns, F.col("a").isNotNull().alias("parsed"),
        F.coalesce("a.status", F.lit("uncertain")).alias("model_status"),
        F.coalesce("a.severity", F.lit("unknown")).alias("model_severity"),
        F.coalesce("a.alarm", F.lit(False)).alias("model_alarm"),
        F.coalesce("a.needs_review", F.lit(True)).alias("model_review"),
        F.col("a.possible_fault").alias("possible_fault"))


def gate(verdicts: DataFrame, answers: DataFrame, key: str = "request_id") -> DataFrame:
    """Final decision. A model alone never raises an alarm and never lowers one set by a rule."""
    a = answers.select(key, "model_status", "model_severity", "model_alarm", "model_review")
    j = verdicts.join(a, key, "left").select(
        *verdicts.columns,
        F.coalesce("model_status", F.lit("uncertain")).alias("m_status"),
        F.coalesce("model_severity", F.lit("unknown")).alias("m_severity"),
        F.coalesce("model_alarm", F.lit(False)).alias("m_alarm"),
        F.coalesce("model_review", F.lit(True)).alias("m_review"))
    complete = F.col("complete")
    backed = F.col("severity").isin(*ALARMS)
    abnormal = (F.col("m_status").isin("warning", "fault") | F.col("m_severity").isin(*ALARMS) | F.col("m_alarm"))
    return j.select(
        key,
        F.when(complete | backed, F.col("status")).when(abnormal, "uncertain").otherwise(F.col("m_status"))
        .alias("status"),
        F.when(complete | backed, F.col("severity")).when(abnormal, "unknown").otherwise(F.col("m_severity"))
        .alias("severity"),
        F.when(complete, F.col("alarm")).otherwise(backed).alias("alarm"),
        F.when(complete, "deterministic_rule").when(backed, "deterministic_rule+llm_rag")
        .when(abnormal, "llm_rag_candidate").otherwise("llm_rag").alias("decision_source"),
        (~complete).alias("model_used"),
        F.when(complete, False).when(backed, F.col("m_review")).when(abnormal, True)
        .otherwise(F.col("m_review")).alias("needs_review"))


def question_text(matched: DataFrame, key: str = "request_id", device: str = "device",
                  order: str = "obs_id") -> DataFrame:
    """Retrieval text of requests that the rules leave open.

    Lines: device, instruction, every observation, then the reason of every unresolved one. A request's
    distinct lines are joined; repeated observations add nothing to a query.
    """
    line = F.concat_ws(" ", "indicator", "color", "state")
    lines = matched.groupBy(key, device, line.alias("line"), "reason").agg(F.min(order).alias("pos"))
    grouped = lines.groupBy(key, device).agg(
        F.sort_array(F.collect_list(F.struct("pos", "line"))).alias("seen"),
        F.sort_array(F.collect_list(F.when(F.col("reason").isNotNull(), F.struct("pos", "reason")))).alias("open"))
    open_lines = F.transform("open", lambda x: F.concat(F.lit("规则未确定原因："), x["reason"]))
    return grouped.filter(F.size("open") > 0).select(key, device, F.array_join(F.concat(
        F.array(F.concat(F.lit("设备："), F.col(device)), F.lit("请根据设备说明书和巡检规则判断以下观测状态：")),
        F.transform("seen", lambda x: x["line"]), open_lines), "\n").alias("question"))


def reason_text(matched: DataFrame, key: str = "request_id") -> DataFrame:
    """Distinct unresolved reasons per request, sorted and joined."""
    open_ = matched.filter(F.col("reason").isNotNull())
    return open_.groupBy(key).agg(
        F.count(F.lit(1)).alias("open_count"),
        F.array_join(F.array_sort(F.collect_set("reason")), ",").alias("reasons"))


def ask_model(verdicts: DataFrame | None, questions: DataFrame, make_client: Callable[[], Callable[[str], str]],
              key: str = "request_id") -> DataFrame:
    """Model answers for the requests that the rules leave open; complete ones never reach the model.

    ``make_client`` opens a client once per task and returns question -> answer text; a failing call gives
    an empty answer, which ``read_answers`` turns into the cautious defaults, and its ``error`` as text.
    Without ``verdicts`` all questions are asked. Those of ``question_text`` have an unresolved observation each, so that
    no verdict over the same observations is complete, and matching them a second time is saved.
    """
    open_ = questions.select(key, "question").filter(F.col(key).isNotNull())
    if verdicts is not None:
        open_ = verdicts.filter(~F.col("complete")).select(key).join(open_, key)
    schema = T.StructType([open_.schema[key], T.StructField("content", T.StringType()),
                           T.StructField("error", T.StringType())])

    def ask(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        client = make_client()

        def answer(question: str) -> tuple[str, str | None]:
            try:
                return client(question), None
            except Exception as e:  # noqa: BLE001 - a lost answer must not stop the judgement
                return "", f"{type(e).__name__}: {e}"

        for batch in batches:
            found = [answer(q) for q in batch["question"]]
            yield pd.DataFrame({key: batch[key], "content": [f[0] for f in found], "error": [f[1] for f in found]})

    return open_.mapInPandas(ask, schema)
