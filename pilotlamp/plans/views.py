"""Domain tables derived from the given parquet tables. One SQL text serves Spark and the SQL check."""

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings",
          "pages", "benchmark", "labels", "conversations"]

_OBS_ID = ("concat(CAST(l_orderkey AS STRING), '-', CAST(l_linenumber AS STRING), '-', CAST(l_partkey AS STRING), '-', "
           "CAST(l_suppkey AS STRING), '-', CAST(CAST(round(l_extendedprice * 100) AS BIGINT) AS STRING))")
_K = "CAST(substr(props, 7, length(props) - 7) AS INTEGER)"

VIEWS = {
    # observations of devices, one row each
    "observations": f"""
        SELECT l_orderkey AS request_id, {_OBS_ID} AS obs_id, p_brand AS device,
               CASE WHEN l_linenumber = 7 THEN '' ELSE p_type END AS indicator,
               CASE l_suppkey % 6 WHEN 0 THEN 'green' WHEN 1 THEN 'red' WHEN 2 THEN 'yellow' WHEN 3 THEN 'blue'
                    WHEN 4 THEN 'unknown' ELSE 'violet' END AS color,
               CASE l_partkey % 6 WHEN 0 THEN 'steady' WHEN 1 THEN 'blinking' WHEN 2 THEN 'off' WHEN 3 THEN 'on'
                    WHEN 4 THEN 'unknown' ELSE 'dim' END AS state,
               round(1 - l_discount * 6, 2) AS confidence
        FROM {{lineitem}} JOIN {{part}} ON l_partkey = p_partkey""",
    # the same with allowed words only
    "inspections": f"""
        SELECT l_orderkey AS request_id, {_OBS_ID} AS obs_id, p_brand AS device, p_type AS indicator,
               CASE l_suppkey % 5 WHEN 0 THEN 'green' WHEN 1 THEN 'red' WHEN 2 THEN 'yellow' WHEN 3 THEN 'blue'
                    ELSE 'unknown' END AS color,
               CASE l_partkey % 5 WHEN 0 THEN 'steady' WHEN 1 THEN 'blinking' WHEN 2 THEN 'off' WHEN 3 THEN 'on'
                    ELSE 'unknown' END AS state,
               round(1 - l_discount * 6, 2) AS confidence
        FROM {{lineitem}} JOIN {{part}} ON l_partkey = p_partkey""",
    # base rules
    "rules": """
        SELECT p_partkey AS ordinal, p_brand AS device, p_type AS indicator,
               CASE p_size % 5 WHEN 0 THEN 'green' WHEN 1 THEN 'red' WHEN 2 THEN 'yellow' WHEN 3 THEN 'blue'
                    ELSE 'unknown' END AS color,
               CASE p_partkey % 6 WHEN 0 THEN 'steady' WHEN 1 THEN 'blinking' WHEN 2 THEN 'off' WHEN 3 THEN 'on'
                    WHEN 4 THEN 'steady_or_blinking' ELSE 'unknown' END AS state,
               p_name AS meaning,
               CASE p_partkey % 5 WHEN 0 THEN 'normal' WHEN 1 THEN 'info' WHEN 2 THEN 'warning' WHEN 3 THEN 'critical'
                    ELSE 'unknown' END AS severity
        FROM {part}""",
    # rules set by people; a few name indicators or devices the base does not have
    "custom_rules": """
        SELECT p_partkey AS ordinal,
               CASE WHEN p_partkey % 7 = 0 THEN concat(p_brand, '-X') ELSE p_brand END AS device,
               CASE WHEN p_partkey % 11 = 0 THEN 'SPARE' ELSE p_type END AS indicator,
               CASE p_size % 5 WHEN 0 THEN 'green' WHEN 1 THEN 'red' WHEN 2 THEN 'yellow' WHEN 3 THEN 'blue'
                    ELSE 'unknown' END AS color,
               CASE p_partkey % 6 WHEN 0 THEN 'steady' WHEN 1 THEN 'blinking' WHEN 2 THEN 'off' WHEN 3 THEN 'on'
                    WHEN 4 THEN 'steady_or_blinking' ELSE 'unknown' END AS state,
               concat('custom ', p_name) AS meaning,
               CASE p_partkey % 5 WHEN 0 THEN 'info' WHEN 1 THEN 'warning' WHEN 2 THEN 'critical' WHEN 3 THEN 'unknown'
                    ELSE 'urgent' END AS severity,
               CASE WHEN p_partkey % 4 = 0 THEN p_size > 25 END AS alarm,
               p_partkey * 10 + p_size AS updated_at
        FROM {part}""",
    # classifier samples per stream
    "samples": f"""
        SELECT user_id AS stream_id, event_id AS frame_idx, ts, event_type AS class_name,
               {_K} / 100e0 AS confidence, value AS latency_ms
        FROM {{events}}""",
    # sampled video frames with metrics
    "frames": f"""
        SELECT event_type AS device, user_id AS video_idx, event_id AS frame_idx, event_id * 0.8e0 AS time_sec,
               value * 3e0 AS blur, {_K} * 2.6e0 AS brightness, (event_id * 7919) % 64 AS contrast,
               value * 2e0 AS clarity, {_K} - 10 AS scale_score
        FROM {{events}}""",
    # candidate boxes of 1000 x 700 images
    "boxes": f"""
        SELECT l_orderkey AS image, {_OBS_ID} AS box_id, CAST(l_partkey % 900 AS DOUBLE) AS x1,
               CAST((l_suppkey * 7) % 600 AS DOUBLE) AS y1,
               CAST(l_partkey % 900 + l_quantity + 4 AS DOUBLE) AS x2,
               CAST((l_suppkey * 7) % 600 + 4 + l_partkey % 40 AS DOUBLE) AS y2,
               l_linenumber AS class_id, l_discount * 10 + 0.0 AS score, 1000 AS width, 700 AS height
        FROM {{lineitem}}""",
    # boxes crowded into a corner, so that many overlap
    "crowded": f"""
        SELECT l_orderkey AS image, {_OBS_ID} AS box_id, CAST(l_partkey % 120 AS DOUBLE) AS x1,
               CAST((l_suppkey * 7) % 90 AS DOUBLE) AS y1,
               CAST(l_partkey % 120 + l_quantity + 4 AS DOUBLE) AS x2,
               CAST((l_suppkey * 7) % 90 + 4 + l_partkey % 40 AS DOUBLE) AS y2,
               l_linenumber AS class_id, l_discount * 10 + 0.0 AS score
        FROM {{lineitem}}""",
    # images to split: a customer is a video, a priority is a device
    "images": """
        SELECT o_orderkey AS image, concat('video_', CAST(o_custkey AS STRING)) AS grp, o_orderpriority AS device,
               o_totalprice AS clarity, concat('img_', CAST(o_orderkey AS STRING), '.jpg') AS filename
        FROM {orders}""",
    # one unit vector per chunk
    "chunk_vectors": """
        SELECT vec_id, CASE WHEN label = 0 THEN '_GLOBAL_' ELSE concat('dev_', CAST(label AS STRING)) END AS device_name,
               embedding FROM {embeddings}""",
    # indicator catalogue per device
    "catalog": """
        SELECT device, name, short_label, module, min(ordinal) AS ordinal
        FROM (SELECT p_brand AS device,
                     CASE p_partkey % 4 WHEN 0 THEN concat('ALM ', p_name) WHEN 1 THEN concat('PWR ', p_type)
                       ELSE concat(p_type, ' ', p_name) END AS name,
                     CASE WHEN p_partkey % 3 = 0 THEN '' ELSE substr(p_type, 1, 4) END AS short_label,
                     concat('M', CAST(p_size % 4 AS STRING)) AS module, p_partkey AS ordinal FROM {part}) AS c
        GROUP BY device, name, short_label, module""",
    # device names of the rule tables and of the workspace
    "rule_names": """
        SELECT name, min(ordinal) AS ordinal FROM (
            SELECT concat(p_brand, ' ', p_name) AS name, p_partkey AS ordinal FROM {part}) AS r GROUP BY name""",
    "workspace_names": """
        SELECT name, min(ordinal) AS ordinal FROM (
            SELECT CASE WHEN p_partkey % 3 = 0
                        THEN concat(substr(upper(replace(concat(p_brand, ' ', p_name), ' ', '_')), 1, 9),
                                    substr(upper(replace(concat(p_brand, ' ', p_name), ' ', '_')), 11))
                        ELSE upper(replace(concat(p_brand, ' ', p_name), ' ', '_')) END AS name,
                   p_partkey AS ordinal FROM {part}) AS w GROUP BY name""",
    # raw model answers; some lack fields, some are not JSON
    "model_answers": """
        SELECT o_orderkey AS request_id, CASE WHEN o_orderkey % 7 = 0 THEN 'no answer' ELSE concat(
            '<think>looking', chr(10), 'closer</think>', chr(123), '"status": "',
            CASE o_orderkey % 5 WHEN 0 THEN 'normal' WHEN 1 THEN 'info' WHEN 2 THEN 'warning' WHEN 3 THEN 'fault'
                 ELSE 'uncertain' END, '"',
            CASE WHEN o_custkey % 3 = 0 THEN '' ELSE concat(', "severity": "', CASE o_custkey % 5
                 WHEN 0 THEN 'normal' WHEN 1 THEN 'info' WHEN 2 THEN 'warning' WHEN 3 THEN 'critical' ELSE 'unknown' END,
                 '"') END,
            CASE WHEN o_custkey % 4 = 0 THEN ', "alarm": true' ELSE '' END,
            CASE WHEN o_custkey % 2 = 0 THEN ', "needs_review": false' ELSE '' END, chr(125)) END AS content
        FROM {orders}""",
}
