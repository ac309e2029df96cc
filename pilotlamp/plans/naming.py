"""Queries: device names, aliases and directories."""

from pyspark.sql import functions as F

from pilotlamp.functions import similarity, text
from pilotlamp.operators import matching, names
from pilotlamp.plans.registry import Tables, query

_COMPACT = "lower(regexp_replace({}, '[\\s_\\-/()\\[\\]]+', '', 'g'))"
_REQUESTED = """
    SELECT DISTINCT CASE p_partkey % 5
        WHEN 0 THEN upper(concat(p_brand, '_', p_name))
        WHEN 1 THEN concat(substr(p_brand, 1, 3), substr(p_brand, 5), ' ', p_name)
        WHEN 2 THEN p_name
        WHEN 3 THEN concat('zq', p_type, p_name)
        ELSE concat(p_brand, ' ', p_name, ' mk2') END AS name FROM {part}"""


def _tiers(wanted: str, choices: str, on: str, threshold: int, cols: str) -> str:
    w, c = _COMPACT.format("w.name"), _COMPACT.format("c.name")
    return f"""
    WITH w AS ({wanted}), c AS ({choices}),
    p AS (SELECT {cols} w.name, c.name AS choice, c.ordinal,
        CASE WHEN {w} = {c} THEN 100 WHEN contains({w}, {c}) OR contains({c}, {w}) THEN 95
        ELSE CASE WHEN levenshtein({w}, {c}) * 100 <= greatest(length({w}), length({c})) * {100 - threshold}
          THEN CAST(floor((greatest(length({w}), length({c})) - levenshtein({w}, {c})) * 100
               / greatest(length({w}), length({c}))) AS INTEGER) END END AS score,
        CASE WHEN {w} = {c} THEN 0 WHEN contains({w}, {c}) OR contains({c}, {w}) THEN 1 ELSE 2 END AS tier
      FROM w JOIN c ON {on}),
    b AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY {cols.replace('w.', '')} name
        ORDER BY tier, score DESC, ordinal) AS rn FROM p WHERE score IS NOT NULL) WHERE rn = 1)
    """


@query("j01_device_names", _tiers(_REQUESTED, "SELECT name, ordinal FROM {rule_names}", "true", 65, "") + """
    SELECT w.name, b.choice, coalesce(b.score, 0) AS score FROM w LEFT JOIN b ON w.name = b.name""")
def j01(t: Tables):
    return matching.best_names(t.sql(_REQUESTED), t.rule_names, 65)


@query("j02_indicator_names", _tiers(
    "SELECT DISTINCT p_brand AS device, CASE p_partkey % 3 WHEN 0 THEN lower(p_type) WHEN 1 THEN "
    "concat(substr(p_type, 1, 2), substr(p_type, 4)) ELSE concat('xx', p_size) END AS name FROM {part}",
    "SELECT device, indicator AS name, min(ordinal) AS ordinal FROM {rules} GROUP BY 1, 2", "w.device = c.device", 62,
    "w.device,") + """
    SELECT w.device, w.name, b.choice, coalesce(b.score, 0) AS score
    FROM w LEFT JOIN b ON w.name = b.name AND w.device = b.device""")
def j02(t: Tables):
    wanted = t.sql("SELECT DISTINCT p_brand AS device, CASE p_partkey % 3 WHEN 0 THEN lower(p_type) WHEN 1 THEN "
                   "concat(substr(p_type, 1, 2), substr(p_type, 4)) ELSE concat('xx', p_size) END AS name FROM {part}")
    return names.match_indicators(wanted, t.rules)


_PLAIN = "trim(regexp_replace(lower(translate(name, '_-', '  ')), '[^0-9a-z]+', ' ', 'g'))"
_DESC = f"""
    SELECT name, ordinal, {_PLAIN} AS plain, replace({_PLAIN}, ' ', '') AS solid,
      list_distinct(list_concat(list_concat(string_split({_PLAIN}, ' '),
        list_transform(regexp_extract_all({_PLAIN}, '[a-z]+\\s*[-_]?\\s*\\d+[a-z0-9-]*'), lambda x: replace(x, ' ', ''))),
        regexp_extract_all({_PLAIN}, '[a-z0-9-]{{3,}}'))) AS tokens"""
_SCORED = f"""
    r AS ({_DESC} FROM rule_names), w AS ({_DESC} FROM workspace_names),
    s AS (SELECT r.name, r.ordinal, w.name AS workspace, list_intersect(r.tokens, w.tokens) AS o,
        greatest(100 * (1 - levenshtein(r.plain, w.plain) / greatest(length(r.plain), length(w.plain))::DOUBLE),
                 100 * (1 - levenshtein(r.solid, w.solid) / greatest(length(r.solid), length(w.solid))::DOUBLE),
                 CASE WHEN r.solid = w.solid THEN 100 WHEN contains(r.solid, w.solid) OR contains(w.solid, r.solid)
                      THEN 96 ELSE 0 END) AS base FROM r, w),
    f AS (SELECT name, ordinal, workspace, CAST(round_even(least(100, base
          + CASE WHEN len(list_filter(o, lambda x: regexp_matches(x, '[a-z]') AND regexp_matches(x, '[0-9]'))) > 0
                 THEN 10 ELSE 0 END + least(10, 2 * len(o))), 0) AS INTEGER) AS score FROM s),
    k AS (SELECT *, row_number() OVER (PARTITION BY name ORDER BY score DESC, workspace) AS place FROM f)
"""


@query("j05_workspace_mapping", "WITH " + _SCORED + """
    SELECT name, ordinal, workspace, confidence, ordinal > first_ordinal AS duplicate,
      confidence < 82 OR ordinal > first_ordinal AS needs_review FROM (
      SELECT name, ordinal, workspace, score AS confidence,
        min(ordinal) OVER (PARTITION BY workspace) AS first_ordinal FROM k WHERE place = 1)
    /* {rule_names} {workspace_names} */""")
def j05(t: Tables):
    m = names.map_workspaces(t.rule_names, t.workspace_names)
    return m.select("name", "ordinal", "workspace", "confidence", "duplicate", "needs_review")


@query("s02_top3_workspaces", "WITH " + _SCORED + """
    SELECT name, CAST(place AS INTEGER) AS place, workspace, score FROM k WHERE place <= 3
    /* {rule_names} {workspace_names} */""")
def s02(t: Tables):
    m = names.map_workspaces(t.rule_names, t.workspace_names)
    return m.select("name", F.inline("top"))


_SOURCES = """
    SELECT DISTINCT CASE p_partkey % 4 WHEN 0 THEN upper(concat(p_brand, ' ', p_name, ' ', p_type))
      WHEN 1 THEN concat(substr(p_brand, 1, 4), substr(p_brand, 6), '_', p_name, '_', p_type)
      WHEN 2 THEN concat(p_type, p_name) ELSE concat(p_brand, '-', p_name) END AS name FROM {part}"""
_PACKAGES = """
    SELECT DISTINCT CASE WHEN p_partkey % 9 = 0 THEN concat(p_brand, '__', p_name, '__', p_type)
      ELSE concat(p_brand, '_', p_name, '_', p_type) END AS name FROM {part} WHERE p_size > 20"""


@query("j06_directory_matching", f"""
    WITH s AS ({_SOURCES}), p AS ({_PACKAGES}),
    sk AS (SELECT name, regexp_replace(lower(name), '[^a-z0-9]+', '', 'g') AS key,
        list_distinct(list_filter(regexp_split_to_array(lower(name), '[\\s_\\-./()]+'), lambda x: x <> '')) AS words FROM s),
    pk AS (SELECT name, regexp_replace(lower(name), '[^a-z0-9]+', '', 'g') AS key,
        list_distinct(list_filter(regexp_split_to_array(lower(name), '[\\s_\\-./()]+'), lambda x: x <> '')) AS words FROM p),
    e AS (SELECT key, count(*) AS n, min(name) AS package FROM pk GROUP BY key),
    c AS (SELECT sk.name, pk.name AS package,
        1.0::DOUBLE - levenshtein(sk.key, pk.key) / greatest(length(sk.key), length(pk.key))::DOUBLE AS seq,
        len(list_intersect(sk.words, pk.words)) / len(list_distinct(list_concat(sk.words, pk.words)))::DOUBLE AS overlap
      FROM sk, pk WHERE sk.key NOT IN (SELECT key FROM e)),
    k AS (SELECT *, seq * 0.75::DOUBLE + overlap * 0.25::DOUBLE AS score, row_number() OVER (PARTITION BY name
        ORDER BY seq * 0.75::DOUBLE + overlap * 0.25::DOUBLE DESC, package) AS place FROM c),
    d AS (SELECT a.name, a.package, a.score, a.seq, coalesce(b.score, 0) AS runner_up
      FROM k a LEFT JOIN k b ON a.name = b.name AND b.place = 2 WHERE a.place = 1)
    SELECT name, CASE WHEN ok THEN package END AS package, round(score, 4) AS score,
      CASE WHEN ok THEN 'fuzzy_unique' ELSE 'no_safe_unique_match' END AS method
    FROM (SELECT *, score >= 0.82 AND seq >= 0.85 AND score - runner_up >= 0.08 AS ok FROM d)
    UNION ALL
    SELECT sk.name, CASE WHEN n = 1 THEN package END, CASE WHEN n = 1 THEN 1.0 ELSE 0.0 END,
      CASE WHEN n = 1 THEN 'normalized_exact' ELSE 'ambiguous_normalized_exact' END FROM sk JOIN e ON sk.key = e.key""")
def j06(t: Tables):
    m = names.match_directories(t.sql(_SOURCES), t.sql(_PACKAGES))
    return m.withColumn("score", F.round("score", 4))


@query("j07_directory_lookup", f"""
    WITH s AS ({_SOURCES}), p AS ({_PACKAGES}),
    sk AS (SELECT name, lower(regexp_replace(name, '[^0-9a-zA-Z]+', '', 'g')) AS key FROM s),
    pk AS (SELECT name, lower(regexp_replace(name, '[^0-9a-zA-Z]+', '', 'g')) AS key FROM p),
    e AS (SELECT key, min(name) AS directory FROM pk GROUP BY key),
    i AS (SELECT sk.key, count(DISTINCT pk.name) AS hits, min(pk.name) AS inside FROM sk, pk
      WHERE sk.key <> pk.key AND (contains(sk.key, pk.key) OR contains(pk.key, sk.key)) GROUP BY sk.key)
    SELECT sk.name, coalesce(pk.name, e.directory, CASE WHEN hits = 1 THEN inside END) AS directory
    FROM sk LEFT JOIN pk ON sk.name = pk.name LEFT JOIN e ON sk.key = e.key LEFT JOIN i ON sk.key = i.key""")
def j07(t: Tables):
    return names.find_directories(t.sql(_SOURCES), t.sql(_PACKAGES))


_OWNERS = """
    SELECT workspace, canonical_name, rule_name FROM (SELECT *, row_number() OVER (PARTITION BY workspace
      ORDER BY ordinal {}) AS rn FROM (
        SELECT p_partkey AS ordinal, concat(p_brand, '-', p_type) AS canonical_name, p_brand AS rule_name,
          unnest([concat('ws ', p_name), concat('ws ', p_type, ' ', CAST(p_size AS VARCHAR))]) AS workspace
        FROM part WHERE p_partkey % 3 <> 0)) WHERE rn = 1"""


def _aliases(t: Tables):
    return t.part.select(
        F.col("p_partkey").alias("ordinal"), F.concat_ws("-", "p_brand", "p_type").alias("canonical_name"),
        F.col("p_brand").alias("rule_name"), (F.col("p_partkey") % 3 != 0).alias("verified"),
        F.array(F.concat(F.lit("ws "), "p_name"), F.concat_ws(" ", F.lit("ws"), "p_type", F.col("p_size").cast("string")))
        .alias("workspace_names"))


@query("j08_workspace_owners_last", _OWNERS.format("DESC"))
def j08(t: Tables):
    return names.workspace_owners(_aliases(t), "last")


@query("j08_workspace_owners_first", _OWNERS.format("ASC"))
def j08_first(t: Tables):
    return names.workspace_owners(_aliases(t), "first")


@query("f03_plain_names", f"""
    SELECT name, {_PLAIN} AS plain, replace({_PLAIN}, ' ', '') AS solid FROM {{workspace_names}}""")
def f03(t: Tables):
    n = F.col("name")
    return t.workspace_names.select("name", text.plain_name(n).alias("plain"), text.solid_name(n).alias("solid"))


@query("f04_name_tokens", f"""
    SELECT name, array_to_string(list_sort(tokens), ' ') AS tokens FROM ({_DESC} FROM {{workspace_names}})""")
def f04(t: Tables):
    return t.workspace_names.select("name", F.array_join(text.name_tokens(F.col("name")), " ").alias("tokens"))


@query("f04_print_tokens", """
    SELECT name, array_to_string(list_sort(list_distinct(list_concat(
        list_transform(regexp_extract_all(upper(name), '[A-Z][A-Z0-9/+_-]{1,24}'), lambda x: regexp_replace(x, '[^A-Z0-9+\\-/]', '', 'g')),
        [regexp_replace(upper(name), '[^A-Z0-9+\\-/]', '', 'g')]))), ' ') AS tokens FROM {workspace_names}""")
def f04_print(t: Tables):
    return t.workspace_names.select(
        "name", F.array_join(F.array_sort(text.print_tokens(F.col("name"))), " ").alias("tokens"))


@query("f05_alias_names", """
    WITH n AS (SELECT DISTINCT concat(p_type, ' (', p_name, ')') AS name, p_type, p_name FROM {part})
    SELECT name, array_to_string(list_sort(list_distinct(list_filter(
      [p_type, p_type || ' ', p_name, split_part(p_name, ' ', 1), split_part(p_name, ' ', 2)],
      lambda x: length(x) >= 3 AND x = trim(x)))), '|') AS aliases FROM n""")
def f05(t: Tables):
    n = t.part.select(F.concat("p_type", F.lit(" ("), "p_name", F.lit(")")).alias("name")).distinct()
    return n.select("name", F.array_join(text.alias_names(F.col("name")), "|").alias("aliases"))


@query("f20_safe_names", """
    SELECT p_partkey, concat(replace(p_brand, ' ', '_'), '_', replace(p_name, ' ', '_'), '_', p_type) AS safe,
      concat(p_name_, '_', p_type) AS class_name FROM (SELECT *, replace(p_name, ' ', '_') AS p_name_ FROM {part})""")
def f20(t: Tables):
    raw = F.concat(F.lit(" ."), "p_brand", F.lit(" / "), "p_name", F.lit("\t:"), "p_type", F.lit("? "))
    cls = F.concat(F.lit(" "), "p_name", F.lit("/"), "p_type")
    return t.part.select("p_partkey", text.safe_name(raw).alias("safe"), text.class_name(cls).alias("class_name"))


@query("f20_canonical_ids", f"""
    SELECT name, concat(replace({_PLAIN}, ' ', '_'), '_', substr(sha1(name), 1, 8)) AS device_id FROM {{rule_names}}""")
def f20_ids(t: Tables):
    return t.rule_names.select("name", text.canonical_id(F.col("name")).alias("device_id"))


@query("o01_all_workspaces", """
    SELECT name FROM {workspace_names} UNION SELECT name FROM {rule_names}""")
def o01(t: Tables):
    return t.workspace_names.select("name").union(t.rule_names.select("name")).distinct()


@query("o02_keyword_overlap", """
    SELECT p_partkey, round(len(list_intersect(a, b)) / len(list_distinct(list_concat(a, b)))::DOUBLE, 6) AS overlap FROM (
      SELECT p_partkey, list_distinct([lower(p_brand), split_part(p_name, ' ', 1), split_part(p_name, ' ', 2)]) AS a,
        list_distinct([split_part(p_name, ' ', 2), lower(p_type)]) AS b FROM {part})""")
def o02(t: Tables):
    a = text.keyword_tokens(F.concat_ws("_", "p_brand", "p_name"))
    b = text.keyword_tokens(F.concat_ws("-", F.substring_index("p_name", " ", -1), "p_type"))
    return t.part.select("p_partkey", F.round(text.jaccard(a, b), 6).alias("overlap"))


@query("o05_excluded_devices", """
    SELECT device, count(*) AS n FROM {rules} WHERE device NOT IN (
      SELECT DISTINCT device FROM {rules} WHERE severity = 'critical' AND indicator = 'PROMO' AND color = 'red')
    GROUP BY device""")
def o05(t: Tables):
    out = t.rules.filter("severity = 'critical' AND indicator = 'PROMO' AND color = 'red'").select("device").distinct()
    return t.rules.join(out, "device", "left_anti").groupBy("device").agg(F.count(F.lit(1)).alias("n"))


_WORD_PAIRS = """SELECT p_partkey, concat(p_name, ' ', p_type) AS a, CASE p_partkey % 6 WHEN 0 THEN '' WHEN 1 THEN concat(p_type, '  ', p_name, ' ', p_type)
    WHEN 2 THEN concat(' ', p_type, ' ', p_brand) WHEN 3 THEN concat(p_brand, ' ', p_name, ' mk2') WHEN 4 THEN concat(p_name, 's ', p_brand) ELSE p_name END AS b FROM {part}"""
_LIST = "list_sort(list_distinct(list_filter(string_split_regex({}, '\\s+'), lambda w: w <> '')))"


def _word_ratio(x: str, y: str) -> str:
    return f"(CASE WHEN greatest(length({x}), length({y})) > 0 THEN 1 - levenshtein({x}, {y}) / greatest(length({x}), length({y})) ELSE 0 END)"


@query("f21_token_set_ratio", f"""
    WITH p AS (SELECT p_partkey, {_LIST.format('a')} AS x, {_LIST.format('b')} AS y FROM ({_WORD_PAIRS})),
    s AS (SELECT *, list_filter(x, lambda w: list_contains(y, w)) AS c, list_filter(x, lambda w: NOT list_contains(y, w)) AS l,
      list_filter(y, lambda w: NOT list_contains(x, w)) AS r FROM p),
    j AS (SELECT *, coalesce(array_to_string(c, ' '), '') AS ct, array_to_string(list_concat(c, l), ' ') AS lt, array_to_string(list_concat(c, r), ' ') AS rt FROM s)
    SELECT p_partkey, round(CASE WHEN len(x) = 0 OR len(y) = 0 THEN 0 WHEN len(c) > 0 AND (len(l) = 0 OR len(r) = 0) THEN 1
      ELSE greatest({_word_ratio('lt', 'rt')}, {_word_ratio('ct', 'lt')}, {_word_ratio('ct', 'rt')}) END, 6) AS score FROM j""")
def f21_token_set(t: Tables):
    return t.sql(_WORD_PAIRS).select("p_partkey", F.round(similarity.token_set_ratio(F.col("a"), F.col("b")), 6).alias("score"))
