"""Queries: observations against rules."""

from pyspark.sql import functions as F

from pilotlamp.functions import text
from pilotlamp.operators import judge
from pilotlamp.operators import requests as whole
from pilotlamp.plans.registry import Tables, query

COLORS = ["green", "red", "yellow", "blue", "unknown"]
STATES = ["steady", "blinking", "off", "on", "unknown"]

_REASON = """CASE WHEN indicator = '' THEN 'missing_indicator' WHEN confidence < 0.6 THEN 'low_confidence'
    WHEN color NOT IN ('green','red','yellow','blue','unknown') THEN 'unsupported_color'
    WHEN state NOT IN ('steady','blinking','off','on','unknown') THEN 'unsupported_state' END"""

# every observation with the rules that accept it
_MATCH = """
WITH hits AS (
  SELECT o.obs_id, count(*) AS matches, count(DISTINCT concat(r.severity, '|', r.meaning)) AS outcomes,
         min(r.ordinal) AS ordinal
  FROM inspections o JOIN rules r ON o.device = r.device AND o.indicator = r.indicator
   AND (o.color = 'unknown' OR r.color = 'unknown' OR o.color = r.color)
   AND (o.state = 'unknown' OR r.state = 'unknown' OR o.state = r.state
        OR (r.state = 'steady_or_blinking' AND o.state IN ('steady', 'blinking')))
  GROUP BY o.obs_id),
matched AS (
  SELECT o.*, coalesce(h.matches, 0) AS matches,
    CASE WHEN o.device NOT IN (SELECT device FROM rules) THEN 'device_not_found_in_rules'
         WHEN NOT EXISTS (SELECT 1 FROM rules r WHERE r.device = o.device AND r.indicator = o.indicator)
           THEN 'indicator_not_found_in_rules'
         WHEN h.matches IS NULL THEN 'no_exact_rule'
         WHEN h.outcomes > 1 THEN 'multiple_conflicting_rules' END AS reason,
    CASE WHEN h.outcomes = 1 THEN r.severity END AS severity, CASE WHEN h.outcomes = 1 THEN r.meaning END AS meaning
  FROM inspections o LEFT JOIN hits h ON o.obs_id = h.obs_id LEFT JOIN rules r ON r.ordinal = h.ordinal)
"""
_ROLLED = _MATCH + """, rolled AS (
  SELECT request_id, count(*) FILTER (reason IS NULL) AS resolved, count(*) FILTER (reason IS NOT NULL) AS unresolved,
    count(*) FILTER (severity = 'unknown') AS unknown_rules,
    max(CASE severity WHEN 'normal' THEN 0 WHEN 'info' THEN 1 WHEN 'warning' THEN 2 WHEN 'critical' THEN 3
        ELSE -1 END) AS rank FROM matched GROUP BY request_id),
verdicts AS (
  SELECT request_id, resolved, unresolved, (resolved > 0 AND unresolved = 0 AND unknown_rules = 0) AS complete,
    CASE rank WHEN 3 THEN 'fault' WHEN 2 THEN 'warning' WHEN 1 THEN 'info' WHEN 0 THEN 'normal' ELSE 'unknown' END
      AS status,
    CASE rank WHEN 3 THEN 'critical' WHEN 2 THEN 'warning' WHEN 1 THEN 'info' WHEN 0 THEN 'normal' ELSE 'unknown' END
      AS severity, rank >= 2 AS alarm FROM rolled)
"""
_USES = "/* {inspections} {rules} */"


def _matched(t: Tables):
    return judge.match_observations(t.inspections, t.rules)


@query("flt03_observation_validation", f"""
    SELECT obs_id, request_id, device, indicator, color, state, confidence, {_REASON} AS drop_reason
    FROM {{observations}}""")
def flt03(t: Tables):
    return judge.validate(t.observations, 0.60, COLORS, STATES)


@query("flt03_payload_errors", f"""
    SELECT request_id, device, count(*) FILTER ({_REASON} IS NULL) AS accepted,
      count(*) FILTER ({_REASON} IS NOT NULL) AS dropped, count(*) FILTER ({_REASON} IS NULL) = 0 AS payload_error
    FROM {{observations}} GROUP BY request_id, device""")
def flt03_payloads(t: Tables):
    return judge.payload_report(judge.validate(t.observations, 0.60, COLORS, STATES))


@query("j03_wildcard_rule_match", _MATCH + " SELECT obs_id, matches FROM matched " + _USES)
def j03(t: Tables):
    return _matched(t).select("obs_id", "matches")


@query("a02_conflict_resolution", _MATCH + """
    SELECT obs_id, device, indicator, color, state, reason, severity, meaning FROM matched """ + _USES)
def a02(t: Tables):
    return _matched(t).select("obs_id", "device", "indicator", "color", "state", "reason", "severity", "meaning")


@query("a01_inspection_verdicts", _ROLLED + "SELECT * FROM verdicts " + _USES)
def a01(t: Tables):
    return judge.roll_up(_matched(t))


@query("a23_unresolved_reasons", _MATCH + """
    SELECT request_id, count(*) AS open_count, string_agg(DISTINCT reason, ',' ORDER BY reason) AS reasons
    FROM matched WHERE reason IS NOT NULL GROUP BY request_id """ + _USES)
def a23(t: Tables):
    return judge.reason_text(_matched(t))


_ANSWERS = """
answers AS (
  SELECT request_id, json_valid(body) AS parsed,
    CASE WHEN json_valid(body) THEN body END AS j FROM (
      SELECT request_id, CASE WHEN regexp_matches(content, '[{]') THEN
         substr(content, strpos(content, chr(123)), length(content)) ELSE '' END AS body FROM model_answers) AS x),
model AS (
  SELECT request_id, parsed, coalesce(j->>'$.status', 'uncertain') AS model_status,
    coalesce(j->>'$.severity', 'unknown') AS model_severity,
    coalesce((j->>'$.alarm')::BOOLEAN, false) AS model_alarm,
    coalesce((j->>'$.needs_review')::BOOLEAN, true) AS model_review FROM answers)
"""


@query("flt17_model_answer_defaults", "WITH " + _ANSWERS + "SELECT * FROM model /* {model_answers} */")
def flt17(t: Tables):
    return judge.read_answers(t.model_answers).drop("content", "possible_fault")


@query("flt16_alarm_gate", _ROLLED + "," + _ANSWERS + """, g AS (
    SELECT v.*, coalesce(model_status, 'uncertain') AS ms, coalesce(model_severity, 'unknown') AS mv,
      coalesce(model_alarm, false) AS ma, coalesce(model_review, true) AS mr
    FROM verdicts v LEFT JOIN model m ON v.request_id = m.request_id),
  h AS (SELECT *, severity IN ('warning', 'critical') AS backed,
      ms IN ('warning', 'fault') OR mv IN ('warning', 'critical') OR ma AS abnormal FROM g)
  SELECT request_id,
    CASE WHEN complete OR backed THEN status WHEN abnormal THEN 'uncertain' ELSE ms END AS status,
    CASE WHEN complete OR backed THEN severity WHEN abnormal THEN 'unknown' ELSE mv END AS severity,
    CASE WHEN complete THEN alarm ELSE backed END AS alarm,
    CASE WHEN complete THEN 'deterministic_rule' WHEN backed THEN 'deterministic_rule+llm_rag'
         WHEN abnormal THEN 'llm_rag_candidate' ELSE 'llm_rag' END AS decision_source,
    NOT complete AS model_used,
    CASE WHEN complete THEN false WHEN backed THEN mr WHEN abnormal THEN true ELSE mr END AS needs_review
  FROM h /* {inspections} {rules} {model_answers} */""")
def flt16(t: Tables):
    return judge.gate(judge.roll_up(_matched(t)), judge.read_answers(t.model_answers))


@query("e1_alarms_per_device", _ROLLED + """
    SELECT m.device, count(DISTINCT m.request_id) AS requests,
      count(DISTINCT CASE WHEN v.alarm THEN m.request_id END) AS alarms
    FROM matched m JOIN verdicts v ON m.request_id = v.request_id GROUP BY m.device """ + _USES)
def e1(t: Tables):
    per_device = judge.roll_up(_matched(t))
    pairs = t.inspections.select("request_id", "device").distinct()
    return pairs.join(per_device, "request_id").groupBy("device").agg(
        F.count(F.lit(1)).alias("requests"), F.count_if("alarm").alias("alarms"))


@query("f31_clock_text", """
    SELECT frame_idx, lpad(CAST(CAST(floor(time_sec / 60) AS BIGINT) AS VARCHAR),
        CAST(greatest(2, length(CAST(CAST(floor(time_sec / 60) AS BIGINT) AS VARCHAR))) AS INTEGER), '0') || ':'
        || lpad(CAST(CAST(floor(time_sec) AS BIGINT) % 60 AS VARCHAR), 2, '0') AS clock FROM {frames}""")
def f31(t: Tables):
    return t.frames.select("frame_idx", text.clock_text(F.col("time_sec")).alias("clock"))


@query("u02_open_request_answers", _ROLLED + """
    SELECT v.request_id, count(DISTINCT m.device) AS devices, 'warning' AS model_status, true AS model_review
    FROM verdicts v JOIN matched m ON v.request_id = m.request_id AND m.reason IS NOT NULL
    JOIN matched d ON d.request_id = v.request_id WHERE NOT v.complete GROUP BY v.request_id """ + _USES)
def u02(t: Tables):
    def client():
        return lambda question: chr(123) + '"status": "' + ("warning" if "规则未确定原因" in question else "normal") + '"' + chr(125)

    answers = judge.ask_model(None, judge.question_text(_matched(t)), client)
    read = judge.read_answers(answers)
    return read.groupBy("request_id", "model_status", "model_review").agg(F.count(F.lit(1)).alias("devices"))


# a payload per order and brand; its device is named exactly, in other letters, by an alias without rules, not at all known, or missing
_PAYLOADS = """SELECT concat(CAST(request_id AS STRING), '-', device) AS request_id, CASE request_id % 6 WHEN 0 THEN device WHEN 1 THEN lower(device)
      WHEN 2 THEN concat('lamp house of ', device) WHEN 3 THEN 'orphan cabinet' WHEN 4 THEN 'zzzzqqqqxxxx' END AS device,
    device AS brand, request_id % 6 AS kind, obs_id, indicator, color, state, confidence FROM {inspections}"""


def _requests(t: Tables):
    o = F.struct("indicator", "color", "state", "confidence")
    rows = t.sql(_PAYLOADS).groupBy("request_id", "device").agg(F.sort_array(F.collect_list(F.struct("obs_id", o.alias("o")))).alias("all"))
    return rows.select("request_id", "device", F.transform("all", lambda x: x["o"]).alias("observations"))


def _aliases(t: Tables):
    brands = t.rules.groupBy("device").agg(F.min("ordinal").alias("ordinal"))
    named = brands.select(
        F.concat(F.lit("id-"), "device").alias("device_id"), F.col("device").alias("canonical_name"), F.col("device").alias("rule_name"),
        F.array(F.concat(F.lit("lamp house of "), "device")).alias("aliases"), F.array().cast("array<string>").alias("workspace_names"),
        F.lit(True).alias("verified"), F.col("ordinal").cast("int").alias("ordinal"))
    orphan = t.spark.range(1).select(
        F.lit("id-orphan").alias("device_id"), F.lit("orphan cabinet").alias("canonical_name"), F.lit("rules that are gone").alias("rule_name"),
        F.array().cast("array<string>").alias("aliases"), F.array().cast("array<string>").alias("workspace_names"), F.lit(False).alias("verified"), F.lit(0).alias("ordinal"))
    return named.unionByName(orphan)


@query("e2_judged_requests", """
    WITH p AS (""" + _PAYLOADS + """),
    ok AS (SELECT *, CASE WHEN kind IN (0, 1, 2) THEN brand WHEN kind = 3 THEN 'rules that are gone' END AS rule_name FROM p WHERE confidence >= 0.6 AND kind <> 5),
    hits AS (SELECT o.obs_id, o.request_id, count(*) AS matches, count(DISTINCT concat(r.severity, '|', r.meaning)) AS outcomes, min(r.ordinal) AS ordinal
      FROM ok o JOIN {rules} r ON o.rule_name = r.device AND o.indicator = r.indicator
       AND (o.color = 'unknown' OR r.color = 'unknown' OR o.color = r.color)
       AND (o.state = 'unknown' OR r.state = 'unknown' OR o.state = r.state OR (r.state = 'steady_or_blinking' AND o.state IN ('steady', 'blinking')))
      GROUP BY o.obs_id, o.request_id),
    m AS (SELECT o.*, CASE WHEN rule_name IS NULL THEN 'device_not_found_in_rules' WHEN kind = 3 THEN 'resolved_rule_name_not_found'
        WHEN h.matches IS NULL THEN 'no_exact_rule' WHEN h.outcomes > 1 THEN 'multiple_conflicting_rules' END AS reason,
        CASE WHEN h.outcomes = 1 THEN r.severity END AS severity
      FROM ok o LEFT JOIN hits h ON o.obs_id = h.obs_id AND o.request_id = h.request_id LEFT JOIN {rules} r ON r.ordinal = h.ordinal),
    v AS (SELECT request_id, count(*) FILTER (reason IS NULL) AS resolved, count(*) FILTER (reason IS NOT NULL) AS unresolved, count(*) FILTER (severity = 'unknown') AS unknown_rules,
        max(CASE severity WHEN 'normal' THEN 0 WHEN 'info' THEN 1 WHEN 'warning' THEN 2 WHEN 'critical' THEN 3 ELSE -1 END) AS rank FROM m GROUP BY request_id),
    d AS (SELECT *, resolved > 0 AND unresolved = 0 AND unknown_rules = 0 AS complete, coalesce(rank, -1) >= 2 AS backed FROM v),
    report AS (SELECT request_id, device, count(*) AS given, count(*) FILTER (confidence >= 0.6) AS accepted FROM p GROUP BY request_id, device)
    SELECT r.request_id, CASE WHEN device IS NULL THEN 'missing_device' WHEN accepted = 0 THEN 'no_valid_observations' END AS error,
      CASE WHEN device IS NULL OR accepted = 0 THEN 'error' WHEN complete OR backed THEN CASE rank WHEN 3 THEN 'fault' WHEN 2 THEN 'warning' WHEN 1 THEN 'info' WHEN 0 THEN 'normal' ELSE 'unknown' END
        ELSE 'uncertain' END AS status,
      coalesce(CASE WHEN complete THEN rank >= 2 ELSE backed END, false) AS alarm, given - accepted AS dropped,
      coalesce(resolved + unresolved, 0) AS reasons
    FROM report r LEFT JOIN d ON d.request_id = r.request_id""")
def e2(t: Tables):
    out = whole.judge_requests(_requests(t), _aliases(t), t.rules)
    return out.select("request_id", "error", "status", "alarm", F.size("dropped").cast("long").alias("dropped"), F.size("reasons").cast("long").alias("reasons"))
