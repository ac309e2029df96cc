"""Queries: rule tables, vocabularies, overrides and summaries."""

from pyspark.sql import functions as F

from pilotlamp.functions import text
from pilotlamp.operators import rules as R
from pilotlamp.plans.registry import Tables, query

# fixed test words and what each must become, picked by a key of the row
_PHRASES = {
    "request_color": [(" 绿色 ", "green"), ("Green", "green"), ("橙红", "orange_red"), ("黄/绿", "yellow_green"),
                      ("亮黄色灯", "yellow"), ("Magenta", "magenta"), ("", "unknown"), ("UNKNOWN", "unknown"),
                      ("橙红灯", "red")],
    "request_state": [("常亮", "steady"), ("快速闪烁", "blinking"), ("常亮或闪烁", "steady_or_blinking"), ("不亮", "off"),
                      ("Blinking", "blinking"), ("fading", "fading"), ("", "unknown"), ("点亮", "on"),
                      ("常亮 / 闪烁", "steady_or_blinking")],
    "rule_color": [("绿", "green"), ("黄/绿", "yellow_green"), ("红、绿", "green_red"), ("白色灯", "white"),
                   ("透明", "unknown"), ("", "unknown"), ("橙 色", "orange"), ("绿/黄", "green_yellow"),
                   ("紫色或蓝色", "blue_purple")],
    "rule_state": [("常亮", "steady"), ("慢闪", "slow_blinking"), ("灯快闪三次", "fast_blinking"), ("亮起", "on"),
                   ("熄灭状态", "off"), ("未知", "unknown"), ("", "unknown"), ("不亮", "off"), ("绿灯亮", "on")],
    "meaning": [("设备正常", "normal"), ("链路 Down 故障", "critical"), ("次要告警", "critical"), ("预警提示", "warning"),
                ("启动中", "info"), ("无告警", "normal"), ("其它说明", "unknown"), ("不正常", "normal"),
                ("无告警，请注意", "warning")],
}


def _pick(kind: str, key: str, side: int) -> str:
    cases = " ".join(f"WHEN {i} THEN '{p[side]}'" for i, p in enumerate(_PHRASES[kind]))
    return f"CASE {key} % {len(_PHRASES[kind])} {cases} END"


def _words(side: int) -> str:
    keys = {"request_color": "p_partkey", "request_state": "p_size", "rule_color": "(p_partkey + p_size)",
            "rule_state": "(p_partkey * 2 + p_size)", "meaning": "(p_partkey * 5 + p_size)"}
    cols = ", ".join(f"{_pick(k, key, side)} AS {'severity' if side and k == 'meaning' else k}"
                     for k, key in keys.items())
    return f"SELECT p_partkey, {cols} FROM {{part}}"


@query("f06_f10_vocabulary", _words(1))
def vocabulary(t: Tables):
    w = t.sql(_words(0))
    return w.select("p_partkey", text.request_color(F.col("request_color")).alias("request_color"),
                    text.request_state(F.col("request_state")).alias("request_state"),
                    text.rule_color(F.col("rule_color")).alias("rule_color"),
                    text.rule_state(F.col("rule_state")).alias("rule_state"),
                    text.severity_of(F.col("meaning"), F.lit("on")).alias("severity"))


@query("f10_severity_longest_match", "SELECT p_partkey, " + _pick("meaning", "p_partkey", 0).replace("'次要告警'", "'W'")
       .replace("'设备正常'", "'N'").replace("'链路 Down 故障'", "'C'").replace("'预警提示'", "'W'")
       .replace("'启动中'", "'I'").replace("'无告警'", "'N'").replace("'其它说明'", "'U'").replace("'不正常'", "'N'")
       .replace("'无告警，请注意'", "'N'") + " AS letter FROM {part}")
def longest(t: Tables):
    w = t.sql(f"SELECT p_partkey, {_pick('meaning', 'p_partkey', 0)} AS meaning FROM {{part}}")
    sev = text.severity_of(F.col("meaning"), F.lit("on"), longest_match=True)
    return w.select("p_partkey", F.upper(F.substring(sev, 1, 1)).alias("letter"))


_WS = r"[\s\x0b\x{85}\p{Z}]"


@query("f01_clean_text", f"""
    SELECT doc_id, md5(regexp_replace(regexp_replace(regexp_replace(text, '{_WS}+', ' ', 'g'), '^ ', ''), ' $', ''))
      AS cleaned FROM {{documents}}""")
def f01(t: Tables):
    return t.documents.select("doc_id", F.md5(text.clean_text(F.col("text"))).alias("cleaned"))


@query("f01_clean_document", f"""
    SELECT doc_id, md5(regexp_replace(regexp_replace(regexp_replace(regexp_replace(
      translate(text, chr(160) || chr(12288) || chr(13), '  ' || chr(10)), '[ \t]+', ' ', 'g'), '\\n{{3,}}', chr(10) || chr(10), 'g'),
      '^{_WS}+', ''), '{_WS}+$', '')) AS cleaned FROM {{documents}}""")
def f01_document(t: Tables):
    return t.documents.select("doc_id", F.md5(text.clean_document(F.col("text"))).alias("cleaned"))


@query("f02_compact_keys", """
    SELECT p_partkey, lower(regexp_replace(raw, '[\\s_\\-/()]+', '', 'g')) AS compact,
      lower(regexp_replace(raw, '[^0-9a-zA-Z]+', '', 'g')) AS alnum,
      upper(regexp_replace(raw, '[\\s_\\-./()]+', '', 'g')) AS label,
      upper(regexp_replace(raw, '[\\s_\\-./:,;()]+', '', 'g')) AS catalog
    FROM (SELECT p_partkey, concat(p_brand, ' (', p_name, ')-', p_type, '/', CAST(p_size AS STRING)) AS raw FROM {part})""")
def f02(t: Tables):
    raw = F.concat("p_brand", F.lit(" (　"), "p_name", F.lit("）-"), "p_type", F.lit("/"), F.col("p_size").cast("string"))
    plain = F.concat("p_brand", F.lit(" ("), "p_name", F.lit(")-"), "p_type", F.lit("/"), F.col("p_size").cast("string"))
    return t.part.select("p_partkey", text.compact_key(raw).alias("compact"), text.alnum_key(plain).alias("alnum"),
                         text.label_key(raw).alias("label"), text.catalog_key(raw).alias("catalog"))


@query("f12_parse_observation", """
    SELECT p_partkey, p_type AS indicator, CASE WHEN p_size % 3 = 0 THEN 'green' ELSE 'unknown' END AS color,
      CASE p_size % 3 WHEN 2 THEN 'unknown' ELSE 'blinking' END AS state FROM {part}""")
def f12(t: Tables):
    obs = F.concat("p_type", F.when(F.col("p_size") % 3 == 0, "= 绿色，闪烁").when(F.col("p_size") % 3 == 1, "=Blinking")
                   .otherwise("= , "))
    return t.part.select("p_partkey", text.parse_observation(obs).alias("o")).select("p_partkey", "o.*")


@query("f33_split_values", """
    SELECT p_partkey, concat(p_brand, '|', p_name, '|', p_type) AS parts, 3 AS n FROM {part}""")
def f33(t: Tables):
    parts = text.split_values(F.concat("p_brand", F.lit("；; "), "p_name", F.lit(";"), "p_type", F.lit("； ")))
    return t.part.select("p_partkey", F.array_join(parts, "|").alias("parts"), F.size(parts).alias("n"))


# rule tables of 40 rows: header first, device named every 5th row, colour every 3rd, a repeated header in the middle
_CELLS = """
    SELECT p_partkey // 40 AS table_index, p_partkey % 40 + 1 AS row_index,
      CASE WHEN p_partkey % 40 = 20 THEN '设备名称' WHEN p_partkey % 5 = 0 THEN p_brand ELSE '' END AS device,
      CASE WHEN p_partkey % 2 = 0 THEN p_type ELSE '' END AS indicator,
      CASE WHEN p_partkey % 3 = 0 THEN '绿色' WHEN p_partkey % 7 = 0 THEN '红' ELSE '' END AS color,
      CASE p_partkey % 4 WHEN 0 THEN '常亮' WHEN 1 THEN '慢闪' ELSE '' END AS state,
      CASE p_partkey % 3 WHEN 0 THEN '运行正常' WHEN 1 THEN '电源故障' ELSE p_name END AS meaning
    FROM {part}"""


def _cells(t: Tables):
    body = t.sql(_CELLS.replace("p_partkey // 40", "p_partkey div 40"))
    body = body.select("table_index", "row_index", F.array("device", "indicator", "color", "state", "meaning").alias("cells"))
    head = body.select("table_index").distinct().select(
        "table_index", F.lit(0).cast("long").alias("row_index"),
        F.array(*[F.lit(x) for x in ("设备 名称", "指示灯", "灯色", "状 态", "状态含义")]).alias("cells"))
    return body.unionByName(head)


_FILLED = f"""
WITH c AS ({_CELLS}), f AS (
  SELECT table_index, row_index, state, meaning,
    last_value(nullif(device, '') IGNORE NULLS) OVER w AS device_name,
    last_value(nullif(indicator, '') IGNORE NULLS) OVER w AS indicator_name,
    last_value(nullif(color, '') IGNORE NULLS) OVER w AS color_raw
  FROM c WINDOW w AS (PARTITION BY table_index ORDER BY row_index ROWS UNBOUNDED PRECEDING)),
x AS (SELECT table_index, row_index + 1 AS source_row_index, device_name, coalesce(indicator_name, '') AS indicator_name,
    coalesce(color_raw, '') AS color_raw,
    CASE color_raw WHEN '绿色' THEN 'green' WHEN '红' THEN 'red' ELSE 'unknown' END AS color,
    state AS state_raw, CASE state WHEN '常亮' THEN 'steady' WHEN '慢闪' THEN 'slow_blinking' ELSE 'unknown' END AS state,
    meaning, '' AS normal_state,
    CASE meaning WHEN '运行正常' THEN 'normal' WHEN '电源故障' THEN 'critical' ELSE 'unknown' END AS severity
  FROM f WHERE device_name <> '设备名称')
"""


@query("w01_fill_down_rules", _FILLED + "SELECT * FROM x")
def w01(t: Tables):
    return R.extract_rules(_cells(t))


@query("f11_table_headers", """
    SELECT p_partkey // 40 AS table_index, count(*) + 1 AS row_count, 'ok' AS reason FROM {part} GROUP BY 1""")
def f11(t: Tables):
    return R.table_report(_cells(t), scan_rows=8)


@query("a04_repeated_rules", _FILLED + """
    SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (
      PARTITION BY device_name, indicator_name, color_raw, state_raw, meaning
      ORDER BY table_index, source_row_index) AS rn FROM x) WHERE rn = 1""")
def a04(t: Tables):
    return R.drop_repeated(R.extract_rules(_cells(t)))


@query("a05_nested_rules", _FILLED + """
    SELECT device_name, indicator_name, state, CAST((rn - 1) // 1000 AS BIGINT) AS page, count(*) AS n,
      string_agg(severity || ':' || meaning, ';' ORDER BY rn) AS entries
    FROM (SELECT *, row_number() OVER (PARTITION BY device_name, indicator_name, state
            ORDER BY table_index, source_row_index) AS rn FROM x WHERE device_name <> '' AND indicator_name <> '')
    GROUP BY 1, 2, 3, 4""")
def a05(t: Tables):
    nested = R.nest_rules(R.extract_rules(_cells(t)))
    return nested.select("device_name", "indicator_name", "state", "page", F.size("entries").alias("n"), F.array_join(
        F.transform("entries", lambda e: F.concat_ws(":", e["severity"], e["meaning"])), ";").alias("entries"))


@query("a05_device_texts", _FILLED + """
    SELECT device_name, indicator_name, string_agg(color, ',' ORDER BY p) AS colors FROM (
      SELECT device_name, indicator_name, color, min(table_index * 1000000 + source_row_index) AS p
      FROM x WHERE color <> 'unknown' GROUP BY 1, 2, 3) GROUP BY 1, 2""")
def a05_texts(t: Tables):
    d = R.device_texts(R.extract_rules(_cells(t)))
    return d.select("device_name", "indicator_name", F.array_join("colors", ",").alias("colors"))


@query("src10_cell_lines", f"""
    WITH c AS ({_CELLS}) SELECT table_index, row_index,
      concat_ws(' | ', device, indicator, color, state, meaning) AS line FROM c
    UNION ALL SELECT DISTINCT table_index, 0, '设备 名称 | 指示灯 | 灯色 | 状 态 | 状态含义' FROM c""")
def src10(t: Tables):
    return R.linearize_cells(_cells(t))


_DOC = ("concat(chr(123), '\"', p_brand, '\": ', chr(123), '\"normal_state_description\": \"n', CAST(p_size AS STRING), "
        "'\", \"indicators\": ', chr(123), '\"', p_type, '\": ', chr(123), '\"rules\": [', chr(123), '\"color\": \"green\", "
        "\"meaning\": \"', p_name, '\"', chr(125), ', ', chr(123), '\"color\": \"red\", \"meaning\": \"x\"', chr(125), ']', "
        "chr(125), chr(125), chr(125), chr(125))")


@query("src05_nested_rule_map", """
    SELECT p_partkey, p_brand AS device, concat('n', CAST(p_size AS STRING)) AS normal_state, p_type AS indicator,
      color, CASE color WHEN 'green' THEN p_name ELSE 'x' END AS meaning
    FROM {part}, (VALUES ('green'), ('red')) AS c(color)""")
def src05(t: Tables):
    docs = t.sql(f"SELECT p_partkey, {_DOC} AS body FROM {{part}}")
    return R.flatten_rules(docs).select("p_partkey", "device", "normal_state", "indicator", "color", "meaning")


@query("src09_row_lines", """
    SELECT p_partkey, concat('p_name: ', p_name, ' | ', CASE WHEN p_size % 4 = 0 THEN '' ELSE concat('p_brand: ', p_brand,
      ' | ') END, 'p_type: ', p_type) AS line FROM {part}""")
def src09(t: Tables):
    rows = t.part.withColumn("p_brand", F.when(F.col("p_size") % 4 == 0, " ").otherwise(F.col("p_brand")))
    return R.linearize(rows, ["p_name", "p_brand", "p_type"], ["p_partkey"])


@query("src16_index_names", "SELECT DISTINCT concat(p_brand, ' ', p_type) AS name FROM {part}")
def src16(t: Tables):
    index = t.part.select(F.lit("x").alias("equipment"), F.concat("p_brand", F.lit("　 "), "p_type").alias("device"))
    return R.index_names(index)


@query("a03_rule_summary", """
    SELECT device, count(DISTINCT indicator) AS indicator_count, count(*) AS rule_count,
      count(*) FILTER (severity = 'critical') AS critical_count, count(*) FILTER (severity = 'warning') AS warning_count,
      count(*) FILTER (severity = 'unknown') AS unknown_count FROM {rules} GROUP BY device""")
def a03(t: Tables):
    return R.summarize(t.rules)


@query("a21_device_catalogue", """
    SELECT device, string_agg(DISTINCT indicator, ',' ORDER BY indicator) AS indicators,
      count(DISTINCT indicator) AS indicator_count FROM {rules} GROUP BY device""")
def a21(t: Tables):
    return R.catalogue(t.rules).withColumn("indicators", F.array_join("indicators", ","))


@query("a22_expected_indicators", """
    SELECT device, string_agg(DISTINCT indicator, ' | ' ORDER BY indicator) AS expected FROM {rules} GROUP BY device""")
def a22(t: Tables):
    return R.expected_indicators(t.rules)


@query("a22_class_universe", "SELECT DISTINCT concat(device, '::', indicator) AS class_name FROM {rules}")
def a22_universe(t: Tables):
    return R.class_universe(t.rules)


@query("j04_custom_rule_merge", """
    WITH latest AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY device, indicator, color, state
        ORDER BY updated_at DESC, ordinal DESC) AS rn FROM {custom_rules}) WHERE rn = 1),
    b AS (SELECT *, row_number() OVER (PARTITION BY device, indicator, color, state ORDER BY ordinal) AS rn FROM {rules}),
    first_base AS (SELECT * FROM b WHERE rn = 1)
    SELECT b.device, b.indicator, b.color, b.state, b.severity, b.meaning, b.ordinal, 'base' AS rule_source
    FROM b LEFT JOIN latest l ON b.device = l.device AND b.indicator = l.indicator AND b.color = l.color
      AND b.state = l.state WHERE l.device IS NULL OR b.rn > 1
    UNION ALL
    SELECT l.device, l.indicator, l.color, l.state, l.severity, l.meaning,
      coalesce(f.ordinal, 1099511627776 + l.ordinal), 'custom'
    FROM latest l LEFT JOIN first_base f ON f.device = l.device AND f.indicator = l.indicator AND f.color = l.color
      AND f.state = l.state""")
def j04(t: Tables):
    return R.merge_custom(t.rules, t.custom_rules)


_CHECK = """
    SELECT ordinal, device, indicator, color, state, meaning, severity, updated_at,
      CASE WHEN severity NOT IN ('normal','info','warning','critical','unknown') THEN 'bad_severity'
           WHEN device NOT IN (SELECT device FROM {rules}) THEN 'unknown_device'
           WHEN state NOT IN ('steady','blinking','off','on','unknown') THEN 'bad_state' END AS problem,
      coalesce(alarm, severity IN ('warning','critical')) AS alarm,
      NOT EXISTS (SELECT 1 FROM {rules} r WHERE r.device = c.device AND r.indicator = c.indicator) AS new_indicator
    FROM {custom_rules} AS c"""


@query("flt18_custom_rule_checks", _CHECK)
def flt18(t: Tables):
    return R.check_custom(t.custom_rules, t.rules, states=["steady", "blinking", "off", "on", "unknown"])


@query("j09_known_devices", """
    SELECT device, count(*) AS rules, device IN (SELECT device FROM {rules}) AS known FROM {custom_rules} GROUP BY device""")
def j09(t: Tables):
    known, custom = t.rules.select("device"), t.custom_rules.groupBy("device").agg(F.count(F.lit(1)).alias("rules"))
    inside = custom.join(known, "device", "left_semi").withColumn("known", F.lit(True))
    return inside.unionByName(custom.join(known, "device", "left_anti").withColumn("known", F.lit(False)))


@query("o06_base_and_custom", """
    SELECT device, rule_source, count(*) AS n FROM (SELECT device, 'base' AS rule_source FROM {rules}
      UNION ALL SELECT device, 'custom' FROM {custom_rules}) GROUP BY 1, 2""")
def o06(t: Tables):
    both = t.rules.withColumn("rule_source", F.lit("base")).unionByName(
        t.custom_rules.withColumn("rule_source", F.lit("custom")), allowMissingColumns=True)
    return both.groupBy("device", "rule_source").agg(F.count(F.lit(1)).alias("n"))
