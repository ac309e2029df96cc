"""Queries: detection boxes, tracks and the indicator catalogue."""

from pyspark.sql import functions as F

from pilotlamp import vocab
from pilotlamp.functions import geometry as G
from pilotlamp.functions import text
from pilotlamp.functions.geometry import Box
from pilotlamp.operators import boxes as B
from pilotlamp.operators import catalog as C
from pilotlamp.operators import ordered
from pilotlamp.plans.registry import Tables, query
from pilotlamp.session import durable
from pilotlamp.sources import annotations as A

_LABELS = """SELECT p_partkey, CASE p_partkey % 9 WHEN 0 THEN 'LED' WHEN 1 THEN concat('indicator light ', p_name) WHEN 2 THEN 'panel'
    WHEN 3 THEN 'led panel' WHEN 4 THEN ' Light ' WHEN 5 THEN 'status light panel' WHEN 6 THEN p_name
    WHEN 7 THEN 'Signal Light' ELSE 'daylight' END AS label FROM {part}"""


@query("flt04_light_labels", f"SELECT p_partkey, label, p_partkey % 9 IN (0, 1, 4, 5, 7) AS light FROM ({_LABELS})")
def flt04(t: Tables):
    return t.sql(_LABELS).withColumn("light", B.is_light_label(F.col("label")))


@query("flt05_geometry_gate", """
    SELECT box_id, CASE WHEN least(x2 - x1, y2 - y1) < 6 THEN 'too_small' WHEN greatest(x2 - x1, y2 - y1) > 45 THEN 'too_large_side'
      WHEN (x2 - x1) * (y2 - y1) > 900 THEN 'too_large_area'
      WHEN greatest((x2 - x1) / (y2 - y1), (y2 - y1) / (x2 - x1)) > 3 THEN 'bad_aspect' END AS problem,
      CASE WHEN least(x2 - x1, y2 - y1) < 3 THEN 'too_small' WHEN x2 - x1 > 450 OR y2 - y1 > 315 THEN 'too_large_side'
        WHEN (x2 - x1) * (y2 - y1) > 1400 THEN 'too_large_area' END AS share_problem FROM {boxes}""")
def flt05(t: Tables):
    return t.boxes.select("box_id", B.geometry_problem(Box.of(), 6, 45, 900, 3).alias("problem"), B.share_problem(
        Box.of(), F.col("width"), F.col("height"), 3, 0.002, 0.45).alias("share_problem"))


_SMALL = "SELECT * REPLACE (800 AS width, 560 AS height) FROM {boxes}"


def _small(t: Tables):
    return t.boxes.withColumn("width", F.lit(800)).withColumn("height", F.lit(560))


@query("flt06_clamped_boxes", f"""
    SELECT box_id, x1, y1, x2, y2 FROM (SELECT box_id, least(x1, 800) AS x1, least(y1, 560) AS y1, least(x2, 800) AS x2,
      least(y2, 560) AS y2 FROM ({_SMALL})) WHERE x2 > x1 AND y2 > y1""")
def flt06(t: Tables):
    return B.clamp_boxes(_small(t)).select("box_id", *B.CORNERS)


@query("flt07_normalized_boxes", f"""
    SELECT box_id, round((x1 + (x2 - x1) / 2) / 800, 6) AS cx, round((y1 + (y2 - y1) / 2) / 560, 6) AS cy,
      round((x2 - x1) / 800, 6) AS bw, round((y2 - y1) / 560, 6) AS bh FROM (
      SELECT box_id, least(x1, 800) AS x1, least(y1, 560) AS y1, least(x2, 800) AS x2,
      least(y2, 560) AS y2 FROM ({_SMALL})) WHERE x2 > x1 AND y2 > y1""")
def flt07(t: Tables):
    n = B.normalize_boxes(_small(t))
    return n.select("box_id", *[F.round(c, 6).alias(c) for c in ("cx", "cy", "bw", "bh")])


_SIZES = "SELECT o_orderkey AS image, CAST(400 + o_custkey % 900 AS INTEGER) AS width, CAST(300 + o_orderkey % 700 AS INTEGER) AS height FROM {orders}"


def _starts(total: str) -> str:
    return (f"CASE WHEN {total} <= 640 THEN [0] ELSE list_distinct(list_append(generate_series(0, {total} - 640, 480), "
            f"{total} - 640)) END")


@query("flt09_tiles", f"""
    SELECT image, width, height, x1, y1, least(width, x1 + 640) AS x2, least(height, y1 + 640) AS y2 FROM (
      SELECT *, unnest({_starts('width')}) AS x1 FROM (SELECT *, unnest({_starts('height')}) AS y1 FROM ({_SIZES})))""")
def flt09(t: Tables):
    return B.tile_images(t.sql(_SIZES), 640, 0.25)


@query("flt10_tile_offsets", """
    SELECT box_id, x1 + class_id * 480 AS x1, y1 + class_id * 10 AS y1, x2 + class_id * 480 AS x2, y2 + class_id * 10 AS y2
    FROM {boxes}""")
def flt10(t: Tables):
    tiled = t.boxes.withColumn("tile_x", F.col("class_id") * 480).withColumn("tile_y", F.col("class_id") * 10)
    return B.from_tile(tiled).select("box_id", *B.CORNERS)


@query("flt11_context_boxes", """
    SELECT box_id, greatest(0, CAST(round_even((x1 + x2) / 2 - cw / 2, 0) AS INTEGER)) AS cx1,
      least(700, CAST(round_even((y1 + y2) / 2 + ch / 2, 0) AS INTEGER)) AS cy2,
      greatest(0, CAST(round_even((x1 + x2) / 2 - (x2 - x1) * 1.8e0 / 2, 0) AS INTEGER)) AS tx1,
      least(1000, CAST(round_even((x1 + x2) / 2 + (x2 - x1) * 1.8e0 / 2, 0) AS INTEGER)) AS tx2
    FROM (SELECT *, greatest(120, (x2 - x1) * 5) AS cw, greatest(90, (y2 - y1) * 5) AS ch FROM {boxes})""")
def flt11(t: Tables):
    w, h = F.col("width"), F.col("height")
    c, tight = G.expand(Box.of(), w, h, 5, 120, 90), G.expand(Box.of(), w, h, 1.8)
    return t.boxes.select("box_id", c.x1.alias("cx1"), c.y2.alias("cy2"), tight.x1.alias("tx1"), tight.x2.alias("tx2"))


_STATES = """SELECT p_partkey, CASE p_partkey % 8 WHEN 0 THEN '绿色 常亮' WHEN 1 THEN '闪烁' WHEN 2 THEN '红色告警灯' WHEN 3 THEN 'RUN 绿色'
    WHEN 4 THEN '' WHEN 5 THEN '黄色区域' WHEN 6 THEN p_name ELSE '异常' END AS name FROM {part}"""


@query("flt12_state_only_names", f"SELECT p_partkey, p_partkey % 8 IN (0, 1, 4, 5, 7) AS state_only FROM ({_STATES})")
def flt12(t: Tables):
    return t.sql(_STATES).select("p_partkey", text.is_state_only(F.col("name")).alias("state_only"))


_FILES = """SELECT o_orderpriority AS device, concat(CASE WHEN o_orderkey % 6 = 0 THEN 'photo_' ELSE 'video_' END,
    CAST(o_custkey AS STRING), CASE WHEN o_orderkey % 4 = 0 THEN '__far__' ELSE '__n_' END, CAST(o_orderkey AS STRING), '.png') AS filename
    FROM {orders}"""
_NATURAL = """CASE WHEN filename LIKE 'photo%' THEN 0 ELSE 1 END, lpad(regexp_extract(filename, '_(\\d+)_', 1), 20, '0'),
    regexp_extract(filename, '__(\\D+)', 1), lpad(regexp_extract(filename, '(\\d+)[.]png', 1), 20, '0')"""


@query("flt13_near_images_first", f"""
    SELECT device, filename, CAST(place AS INTEGER) AS place FROM (SELECT *, row_number() OVER (
      PARTITION BY device ORDER BY {_NATURAL}) AS place FROM ({_FILES}) WHERE NOT contains(filename, '__far__')) WHERE place <= 40""")
def flt13(t: Tables):
    return B.choose_images(t.sql(_FILES), 40)


@query("s01_natural_order", f"""
    SELECT device, filename, row_number() OVER (PARTITION BY device ORDER BY {_NATURAL}) AS place FROM ({_FILES})""")
def s01(t: Tables):
    keyed = t.sql(_FILES).withColumn("key", text.natural_key(F.col("filename")))
    return ordered.rank_in_groups(keyed, ["device"], [("key", "asc")], "place").select("device", "filename", "place")


@query("flt14_verified_types", """
    SELECT box_id, CASE class_id % 4 WHEN 0 THEN 'led' WHEN 1 THEN 'screw' ELSE 'other' END AS object_type,
      class_id % 4 = 0 AS accepted FROM {boxes}""")
def flt14(t: Tables):
    answer = F.when(F.col("class_id") % 4 == 0, " LED ").when(F.col("class_id") % 4 == 1, "Screw").when(
        F.col("class_id") % 4 == 2, "banana")
    return B.verify_types(t.boxes.withColumn("answer", answer), "answer").select("box_id", "object_type", "accepted")


@query("flt15_allowed_classes", """
    SELECT box_id, CASE WHEN class_id IN (1, 3, 5) THEN class_id END AS class_id FROM {boxes}""")
def flt15(t: Tables):
    answer = F.when(F.col("class_id") == 4, "four").otherwise(F.col("class_id").cast("string"))
    allowed = F.array(*[F.lit(i) for i in (1, 3, 5, 9)])
    return t.boxes.select("box_id", B.allowed_class(answer, allowed).alias("class_id"))


def _greedy(order: str, conflict: str) -> str:
    """Sequential suppression as a recursive walk over each image's boxes in order."""
    return f"""
    WITH RECURSIVE b AS (SELECT *, row_number() OVER (PARTITION BY image ORDER BY {order}) AS rn FROM crowded),
    r AS (
      SELECT image, rn, [{{'x1': x1, 'y1': y1, 'x2': x2, 'y2': y2, 'c': class_id, 'id': box_id}}] AS kept FROM b WHERE rn = 1
      UNION ALL
      SELECT b.image, b.rn, CASE WHEN len(list_filter(r.kept, lambda k: {conflict})) > 0 THEN r.kept
        ELSE list_append(r.kept, {{'x1': b.x1, 'y1': b.y1, 'x2': b.x2, 'y2': b.y2, 'c': b.class_id, 'id': b.box_id}}) END
      FROM r JOIN b ON b.image = r.image AND b.rn = r.rn + 1),
    z AS (SELECT image, unnest(list_transform(arg_max(kept, rn), lambda k: k.id)) AS box_id FROM r GROUP BY image)
    SELECT c.image, c.box_id, z.box_id IS NOT NULL AS kept FROM crowded c LEFT JOIN z ON c.box_id = z.box_id /* {{crowded}} */"""


_INTER = "(greatest(0, least(k.x2, b.x2) - greatest(k.x1, b.x1)) * greatest(0, least(k.y2, b.y2) - greatest(k.y1, b.y1)))"
_IOU = f"({_INTER} / ((k.x2 - k.x1) * (k.y2 - k.y1) + (b.x2 - b.x1) * (b.y2 - b.y1) - {_INTER}))"
_CD = "sqrt(((k.x1 + k.x2 - b.x1 - b.x2) / 2) ** 2 + ((k.y1 + k.y2 - b.y1 - b.y2) / 2) ** 2)"
_LONG = ("greatest(1, (greatest(k.x2 - k.x1, k.y2 - k.y1) + greatest(b.x2 - b.x1, b.y2 - b.y1)) / 2)")


@query("w13_suppress_by_score", _greedy("score DESC, box_id", f"{_IOU} >= 0.35 OR {_CD} <= {_LONG} * 0.65e0"))
def w13_score(t: Tables):
    return B.suppress(t.crowded, ["image"], [("score", "desc"), ("box_id", "asc")], B.near_conflict(), 0.65).select(
        "image", "box_id", "kept")


_KEPT_FIRST = f"""
    WITH RECURSIVE b AS (SELECT *, row_number() OVER (PARTITION BY image ORDER BY score DESC, box_id) AS rn FROM crowded),
    r AS (
      SELECT image, rn, [{{'x1': x1, 'y1': y1, 'x2': x2, 'y2': y2, 'id': box_id}}] AS kept, box_id, CAST(NULL AS VARCHAR) AS hit FROM b WHERE rn = 1
      UNION ALL
      SELECT image, rn, CASE WHEN hit IS NULL THEN list_append(kept, {{'x1': x1, 'y1': y1, 'x2': x2, 'y2': y2, 'id': box_id}}) ELSE kept END, box_id, hit
      FROM (SELECT b.*, r.kept, list_filter(r.kept, lambda k: {_IOU} >= 0.35 OR {_CD} <= {_LONG} * 0.65e0)[1].id AS hit
        FROM r JOIN b ON b.image = r.image AND b.rn = r.rn + 1))
    SELECT r.image, r.box_id, k.box_id AS kept_box_id, k.score AS kept_score, k.x1 AS kept_x1, round({_IOU}, 6) AS iou, round({_CD}, 6) AS center_distance
    FROM r JOIN crowded b ON b.box_id = r.box_id JOIN crowded k ON k.box_id = r.hit /* {{crowded}} */"""


@query("w13_conflict_record", _KEPT_FIRST)
def w13_conflicts(t: Tables):
    order = [("score", "desc"), ("box_id", "asc")]
    decided = B.suppress(t.crowded, ["image"], order, B.near_conflict(), 0.65)
    return B.conflict_record(decided, ["image"], order, B.near_conflict(), ["box_id", "score", "x1"], 0.65).select(
        "image", "box_id", "kept_box_id", "kept_score", "kept_x1", F.round("iou", 6).alias("iou"),
        F.round("center_distance", 6).alias("center_distance"))


@query("w13_suppress_by_area", _greedy("(x2 - x1) * (y2 - y1), box_id", f"{_IOU} >= 0.45"))
def w13_area(t: Tables):
    rows = t.crowded.withColumn("area", (F.col("x2") - F.col("x1")) * (F.col("y2") - F.col("y1")))
    return B.suppress(rows, ["image"], [("area", "asc"), ("box_id", "asc")], B.overlap_conflict(0.45)).select(
        "image", "box_id", "kept")


@query("w13_suppress_same_class", _greedy("box_id", f"k.c = b.class_id AND {_IOU} >= 0.6"))
def w13_class(t: Tables):
    return B.suppress(t.crowded, ["image"], [("box_id", "asc")], B.overlap_conflict(0.6, same_class=True)).select(
        "image", "box_id", "kept")


@query("j13_overlap_partners", f"""
    WITH g AS (SELECT image, x1, y1, x2, y2, count(*) AS copies FROM {{crowded}} GROUP BY ALL),
    p AS (SELECT k.image, k.x1, k.y1, k.x2, k.y2, b.copies, {_IOU} AS iou FROM g k JOIN g b ON k.image = b.image
      AND (k.x1 <> b.x1 OR k.y1 <> b.y1 OR k.x2 <> b.x2 OR k.y2 <> b.y2)),
    s AS (SELECT image, x1, y1, x2, y2, sum(copies) AS partners, max(iou) AS best FROM p WHERE iou > 0 GROUP BY ALL)
    SELECT g.*, CAST(coalesce(partners, 0) AS BIGINT) AS partners, round(coalesce(best, 0), 6) AS best_iou
    FROM g LEFT JOIN s USING (image, x1, y1, x2, y2)""")
def j13(t: Tables):
    p = B.overlap_partners(t.crowded, ["image"])
    return p.withColumn("best_iou", F.round("best_iou", 6))


@query("f23_box_geometry", f"""
    SELECT k.box_id, round({_IOU}, 6) AS iou, round({_CD}, 6) AS center_distance,
      round(sqrt((((k.x1 + k.x2 - b.x1 - b.x2) / 2) / 1000) ** 2 + (((k.y1 + k.y2 - b.y1 - b.y2) / 2) / 700) ** 2), 6) AS moved,
      greatest((k.x2 - k.x1) / (b.x2 - b.x1), (b.x2 - b.x1) / (k.x2 - k.x1)) <= 2.2
        AND greatest((k.y2 - k.y1) / (b.y2 - b.y1), (b.y2 - b.y1) / (k.y2 - k.y1)) <= 2.2 AS similar_size
    FROM {{crowded}} k JOIN (SELECT box_id, x1 + 7 AS x1, y1 + class_id AS y1, x2 + 9 AS x2, y2 + class_id + 2 AS y2 FROM {{crowded}}) b
      ON k.box_id = b.box_id""")
def f23(t: Tables):
    k = Box.of()
    b = Box(k.x1 + 7, k.y1 + F.col("class_id"), k.x2 + 9, k.y2 + F.col("class_id") + 2)
    return t.crowded.select(
        "box_id", F.round(G.iou(k, b), 6).alias("iou"), F.round(G.center_distance(k, b), 6).alias("center_distance"),
        F.round(G.normalized_distance(k, b, F.lit(1000), F.lit(700)), 6).alias("moved"),
        G.size_ratio_ok(k, b).alias("similar_size"))


@query("f24_vote_weights", "SELECT box_id, round(1 + least(greatest(score * 60 - 10, 0), 200) / 100, 6) AS weight FROM {boxes}")
def f24(t: Tables):
    return t.boxes.select("box_id", F.round(G.vote_weight(F.col("score") * 60 - 10), 6).alias("weight"))


# a target frame shows the template scaled by a factor and shifted
_TEMPLATES = """SELECT p_brand AS device, 'photo' AS template, CAST(p_partkey % 900 AS DOUBLE) AS x1, CAST((p_partkey * 7) % 600 AS DOUBLE) AS y1,
    CAST(p_partkey % 900 + 20 AS DOUBLE) AS x2, CAST((p_partkey * 7) % 600 + 20 AS DOUBLE) AS y2, p_partkey % 6 AS class_id, 8e0 AS base_weight FROM {part}"""
_CANDIDATES = """SELECT p_brand AS device, concat('f', CAST(l_linenumber AS STRING)) AS target, concat(CAST(l_orderkey AS STRING), '-', CAST(l_partkey AS STRING),
      '-', CAST(l_suppkey AS STRING), '-', CAST(CAST(l_quantity AS BIGINT) AS STRING)) AS box_id,
    CAST((l_partkey % 900) * 0.9e0 + 10 + l_suppkey % 5 AS DOUBLE) AS x1, CAST(((l_partkey * 7) % 600) * 0.9e0 + 10 AS DOUBLE) AS y1,
    CAST((l_partkey % 900) * 0.9e0 + 28 + l_suppkey % 5 AS DOUBLE) AS x2, CAST(((l_partkey * 7) % 600) * 0.9e0 + 28 AS DOUBLE) AS y2,
    CASE WHEN l_partkey % 3 = 0 THEN NULL ELSE l_partkey % 6 END AS class_id
    FROM {lineitem} JOIN {part} ON l_partkey = p_partkey"""
_PROJECTED = f"""
    p AS (SELECT device, target, class_id, px1, py1, px2, py2, base_weight * quality AS strength FROM (
      SELECT t.*, concat('f', CAST(f AS VARCHAR)) AS target, 0.5e0 + f * 0.05e0 AS quality, x1 * 0.9e0 + 10 AS px1, y1 * 0.9e0 + 10 AS py1,
        least(x2 * 0.9e0 + 10, 1000) AS px2, least(y2 * 0.9e0 + 10, 700) AS py2 FROM ({_TEMPLATES}) t, generate_series(1, 7) AS s(f))
      WHERE px2 > px1 AND py2 > py1)"""


def _transforms(t: Tables):
    h = F.array(*[F.lit(v) for v in (0.9, 0.0, 10.0, 0.0, 0.9, 10.0, 0.0, 0.0, 1.0)])
    frame = F.explode(F.sequence(F.lit(1), F.lit(7)))
    return t.part.select(F.col("p_brand").alias("device")).distinct().select("device", F.lit("photo").alias("template"), frame.alias("f")).select(
        "device", "template", F.concat(F.lit("f"), F.col("f").cast("string")).alias("target"), h.alias("h"),
        (F.col("f") * 0.05 + 0.5).alias("quality"), F.lit(1000).alias("width"), F.lit(700).alias("height"))


@query("f34_projected_boxes", f"""
    WITH {_PROJECTED} SELECT device, target, class_id, round(px1, 4) AS x1, round(py1, 4) AS y1, round(px2, 4) AS x2, round(py2, 4) AS y2 FROM p""")
def f34(t: Tables):
    p = B.project_templates(t.sql(_TEMPLATES), _transforms(t))
    return p.select("device", "target", "class_id", *[F.round(f"p_{c}", 4).alias(c) for c in B.CORNERS])


_VOTES = f"""
    WITH {_PROJECTED}, c AS (SELECT DISTINCT * FROM ({_CANDIDATES})),
    q AS (SELECT c.device, c.target, c.box_id, p.class_id, p.strength,
        greatest(0, least(x2, px2) - greatest(x1, px1)) * greatest(0, least(y2, py2) - greatest(y1, py1)) AS inter,
        (x2 - x1) * (y2 - y1) + (px2 - px1) * (py2 - py1) AS areas,
        sqrt(((x1 + x2 - px1 - px2) / 2) ** 2 + ((y1 + y2 - py1 - py2) / 2) ** 2) AS dist,
        sqrt(greatest(4, px2 - px1) ** 2 + greatest(4, py2 - py1) ** 2) AS diag
      FROM c JOIN p ON c.device = p.device AND c.target = p.target AND abs(c.x1 - p.px1) < 60 AND abs(c.y1 - p.py1) < 60),
    w AS (SELECT device, target, box_id, class_id, strength * CASE WHEN iou < 0.05 AND dist > greatest(18, diag * 0.85e0) THEN 0
        ELSE least(1, iou * 1.8e0 + greatest(0, 1 - dist / greatest(diag * 1.1e0, 24)) * 0.8e0) END AS weight
      FROM (SELECT *, inter / (areas - inter) AS iou FROM q)),
    v AS (SELECT device, target, box_id, class_id, sum(weight) AS score FROM w WHERE weight > 0 GROUP BY ALL),
    k AS (SELECT *, row_number() OVER (PARTITION BY device, target, box_id ORDER BY round(score, 9) DESC, class_id) AS place,
        lead(score) OVER (PARTITION BY device, target, box_id ORDER BY round(score, 9) DESC, class_id) AS second FROM v),
    votes AS (SELECT device, target, box_id, class_id AS winner, score AS winner_score, coalesce(second, 0) AS second_score,
      score >= 2.8 AND (coalesce(second, 0) <= 0 OR score >= second * 1.35e0) AS accepted FROM k WHERE place = 1)"""


def _candidates(t: Tables):
    return t.sql(_CANDIDATES).distinct()


def _votes(t: Tables):
    return B.template_votes(_candidates(t), B.project_templates(t.sql(_TEMPLATES), _transforms(t)))


@query("j14_template_votes", _VOTES + """
    SELECT device, target, box_id, CASE WHEN accepted THEN winner END AS winner, round(winner_score, 4) AS winner_score, round(second_score, 4) AS second_score,
      accepted FROM votes""")
def j14(t: Tables):
    v = _votes(t)
    return v.withColumn("winner", F.when(F.col("accepted"), F.col("winner"))).withColumn(
        "winner_score", F.round("winner_score", 4)).withColumn("second_score", F.round("second_score", 4))


@query("j14_corrected_classes", _VOTES + """
    SELECT change, count(*) AS n FROM (SELECT CASE WHEN v.winner IS NULL THEN 'none' WHEN c.class_id IS NULL THEN 'filled'
        WHEN c.class_id <> v.winner THEN 'corrected' ELSE 'same' END AS change
      FROM c LEFT JOIN votes v ON c.device = v.device AND c.target = v.target AND c.box_id = v.box_id AND v.accepted) GROUP BY change""")
def j14_apply(t: Tables):
    return B.apply_template_votes(_candidates(t), _votes(t)).groupBy("change").agg(F.count(F.lit(1)).alias("n"))


# tracks: a customer is a video, an order is a frame, its lines are boxes that drift slowly
def _track_input(t: Tables):
    images = t.orders.select(F.col("o_orderkey").alias("image"), F.lit("d").alias("device"), F.concat(
        F.lit("video_1__d__video_"), F.col("o_custkey").cast("string"), F.lit("__f"), F.col("o_orderkey").cast("string"),
        F.lit("__.png")).alias("filename"))
    placed = durable(B.frame_positions(images).select("image", "device", "track_group", "frame_pos"))
    lines = t.lineitem.select(F.col("l_orderkey").alias("image"), "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity")
    # joined and laid out before texts are made of the numbers, which take more room in a shuffle
    lines = lines.join(placed, "image")
    largest = ordered.largest_group(lines, ["device", "track_group"])
    lines = ordered.lay_out_groups(lines, ["device", "track_group"]).select(
        "_ord_h", "image", "device", "track_group", "frame_pos", F.col("l_linenumber").alias("line"), F.col("l_linenumber").alias("ann_idx"),
        F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
                    (F.col("l_extendedprice") * 100).cast("long")).alias("box_id"),
        (F.col("l_linenumber") * 120.0 + F.col("l_suppkey") % 3).alias("x1"),
        (F.col("l_linenumber") * 60.0 + F.col("l_partkey") % 4).alias("y1"),
        F.when(F.col("l_partkey") % 5 != 0, F.when(F.col("l_partkey") % 7 == 0, 1).otherwise(F.col("l_linenumber")))
        .alias("class_id"), (F.col("l_quantity") * 4).alias("class_score"))
    lines = lines.withColumn("x2", F.col("x1") + 30).withColumn("y2", F.col("y1") + 20)
    return lines.withColumn("ann_idx", F.struct("ann_idx", "box_id").cast("string")).withColumn("width", F.lit(1000)).withColumn("height", F.lit(700)), largest


def _tracked(t: Tables):
    rows, largest = _track_input(t)
    tracked = B.track_boxes(rows, carry=["image", "line", "class_id", "class_score"], largest=largest)
    return tracked.withColumn("ann_order", F.struct("image", F.col("line").alias("ann_idx"), "box_id"))


_TRACKS = """WITH RECURSIVE placed AS (
      SELECT o_orderkey AS image, concat('video_', o_custkey) AS track_group,
        row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) - 1 AS pos FROM {orders}),
    ids AS (SELECT *, concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey, CAST(trunc(l_extendedprice * 100) AS BIGINT)) AS box_id FROM {lineitem}),
    b AS (SELECT track_group, pos, image, l_linenumber, box_id, l_linenumber * 120e0 + l_suppkey % 3 AS x, l_linenumber * 60e0 + l_partkey % 4 AS y,
        CASE WHEN l_partkey % 5 <> 0 THEN CASE WHEN l_partkey % 7 = 0 THEN 1 ELSE l_linenumber END END AS class_id, l_quantity * 4 AS class_score,
        row_number() OVER (PARTITION BY track_group ORDER BY pos, concat('{', l_linenumber, ', ', box_id, '}')) AS k
      FROM ids JOIN placed ON image = l_orderkey),
    walk AS (
      SELECT DISTINCT track_group, CAST(0 AS BIGINT) AS k, CAST('' AS VARCHAR) AS box_id, CAST('' AS VARCHAR) AS track,
        CAST([] AS STRUCT(id VARCHAR, x DOUBLE, y DOUBLE, pos BIGINT, used BIGINT)[]) AS live FROM b
      UNION ALL
      SELECT track_group, k, box_id, CASE WHEN best > 0 THEN near[best].id ELSE box_id END,
        CASE WHEN best > 0 THEN list_transform(near, lambda t, i: CASE WHEN i = best THEN {'id': t.id, 'x': x, 'y': y, 'pos': pos, 'used': pos} ELSE t END)
          ELSE list_append(near, {'id': box_id, 'x': x, 'y': y, 'pos': pos, 'used': CAST(-1 AS BIGINT)}) END
      FROM (SELECT *, CASE WHEN len(scores) > 0 AND list_max(scores) >= 0 THEN list_position(scores, list_max(scores)) ELSE 0 END AS best
        FROM (SELECT *, list_transform(near, lambda t: CASE WHEN t.used <> pos AND (overlap(x, y, t.x, t.y) >= 0.18e0 OR move(x, y, t.x, t.y) <= 0.006e0)
            THEN overlap(x, y, t.x, t.y) * 3e0 + greatest(0e0, 0.006e0 - move(x, y, t.x, t.y)) / 0.006e0 ELSE -1e0 END) AS scores
          FROM (SELECT b.*, list_filter(w.live, lambda t: b.pos - t.pos <= 3) AS near FROM walk w JOIN b ON b.track_group = w.track_group AND b.k = w.k + 1)))
    ),
    tracks AS (SELECT 'd' AS device, track_group, box_id, track FROM walk WHERE k > 0)"""
# boxes are 30 x 20 in images of 1000 x 700
_COMMON = "(greatest(0e0, 30 - abs({x} - {u})) * greatest(0e0, 20 - abs({y} - {v})))"


def _plain_geometry(sql: str) -> str:
    """The two measures written out: SQL macros cannot be part of a query."""
    x, y, u, v = "x", "y", "t.x", "t.y"
    common = _COMMON.format(x=x, y=y, u=u, v=v)
    sql = sql.replace("overlap(x, y, t.x, t.y)", f"({common} / (1200e0 - {common}))")
    return sql.replace("move(x, y, t.x, t.y)", "sqrt(pow((x - t.x) / 1000e0, 2) + pow((y - t.y) / 700e0, 2))")


_TRACKS = _plain_geometry(_TRACKS)


@query("j15_box_tracks", _TRACKS + " SELECT device, track_group, box_id, track FROM tracks")
def j15(t: Tables):
    rows, largest = _track_input(t)
    return B.track_boxes(rows, largest=largest)


@query("a07_track_classes", _TRACKS + """,
    seen AS (SELECT t.device, t.track_group, t.track, b.class_id, b.class_score, row_number() OVER (ORDER BY image, l_linenumber, b.box_id) AS place
      FROM tracks t JOIN b ON b.track_group = t.track_group AND b.box_id = t.box_id),
    m AS (SELECT device, track_group, track, class_id, count(*) AS n, sum(1 + least(greatest(class_score, 0), 200) / 100) AS w, min(place) AS first_seen FROM seen GROUP BY ALL),
    r AS (SELECT *, row_number() OVER v AS place, lead(w) OVER v AS second, count(*) OVER (PARTITION BY device, track_group, track) AS classes
      FROM m WHERE class_id IS NOT NULL WINDOW v AS (PARTITION BY device, track_group, track ORDER BY w DESC, first_seen)),
    a AS (SELECT device, track_group, track, CAST(sum(n) AS BIGINT) AS members FROM m GROUP BY ALL)
    SELECT a.*, r.class_id AS winner, a.members >= 2 AND r.class_id IS NOT NULL AND (classes = 1 OR (n >= 2 AND w >= second * 1.35e0)) AS stable
    FROM a LEFT JOIN r ON a.device = r.device AND a.track_group = r.track_group AND a.track = r.track AND place = 1""")
def a07(t: Tables):
    return B.track_classes(_tracked(t))


# one light per line number of a customer: a track without motion, so that SQL can vote as well
_LAMPS = """SELECT 'd' AS device, concat('v', CAST(o_custkey AS STRING)) AS track_group, l_linenumber AS track, l_partkey AS ann_order,
    CASE WHEN l_suppkey % 5 <> 0 THEN CASE WHEN l_partkey % 7 = 0 THEN 1 ELSE l_linenumber END END AS class_id, l_quantity * 4 AS class_score
    FROM {lineitem} JOIN {orders} ON l_orderkey = o_orderkey"""


@query("a07_weighted_votes", f"""
    WITH m AS (SELECT device, track_group, track, class_id, count(*) AS n, sum(1 + least(greatest(class_score, 0), 200) / 100) AS w,
        min(ann_order) AS seen FROM ({_LAMPS}) GROUP BY ALL),
    k AS (SELECT *, row_number() OVER (PARTITION BY device, track_group, track ORDER BY w DESC, seen) AS place,
        lead(w) OVER (PARTITION BY device, track_group, track ORDER BY w DESC, seen) AS second,
        count(*) OVER (PARTITION BY device, track_group, track) AS classes FROM m WHERE class_id IS NOT NULL),
    a AS (SELECT device, track_group, track, CAST(sum(n) AS BIGINT) AS members FROM m GROUP BY ALL)
    SELECT a.*, k.class_id AS winner, a.members >= 2 AND k.class_id IS NOT NULL
      AND (classes = 1 OR (n >= 2 AND w >= second * 1.35e0)) AS stable
    FROM a LEFT JOIN k ON a.device = k.device AND a.track_group = k.track_group AND a.track = k.track AND place = 1""")
def a07_sql(t: Tables):
    return B.track_classes(t.sql(_LAMPS))


@query("a15_detection_funnel", """
    SELECT class_id, count(*) AS raw, count(*) FILTER (a) AS label_passed, count(*) FILTER (a AND b) AS geometry_passed,
      count(*) FILTER (a AND b AND c) AS after_dedup, count(*) FILTER (a AND b AND c AND d) AS verified,
      count(*) FILTER (a AND b AND c AND d AND e) AS classified
    FROM (SELECT class_id, x1 % 4 <> 0 AS a, x2 - x1 < 45 AS b, y1 % 3 <> 0 AS c, score >= 0.2 AS d, y2 % 2 = 0 AS e FROM {boxes}) GROUP BY class_id""")
def a15(t: Tables):
    flags = t.boxes.select("class_id", (F.col("x1") % 4 != 0).alias("label_ok"), (F.col("x2") - F.col("x1") < 45).alias("geometry_ok"),
                           (F.col("y1") % 3 != 0).alias("kept"), (F.col("score") >= 0.2).alias("verified"),
                           (F.col("y2") % 2 == 0).alias("classified"))
    return B.funnel(flags, ["class_id"])


@query("j21_images_without_boxes", """
    SELECT o_orderkey AS image, count(box_id) AS n_boxes FROM {orders} LEFT JOIN {boxes} ON o_orderkey = image GROUP BY o_orderkey""")
def j21(t: Tables):
    return B.fill_missing_images(t.orders.select(F.col("o_orderkey").alias("image")), t.boxes)


@query("src13_box_export", """
    SELECT o_orderkey AS image, CAST(0 AS BIGINT) AS page, count(box_id) AS n_boxes, CASE WHEN count(box_id) = 0 THEN '[]' ELSE
      '[' || string_agg(concat(chr(123), '"class_id":', CAST(class_id AS VARCHAR), ',"box_id":"', box_id, '"', chr(125)), ',' ORDER BY box_id) || ']' END AS boxes
    FROM {orders} LEFT JOIN {boxes} ON o_orderkey = image GROUP BY o_orderkey""")
def src13(t: Tables):
    images = t.orders.select(F.col("o_orderkey").alias("image"))
    return B.export_boxes(images, t.boxes, "image", [("box_id", "asc")], ["class_id", "box_id"])


_FOUND = """SELECT o_orderpriority AS device, concat('img_', CAST(image AS STRING), '.png') AS image, CAST(class_id AS INTEGER) AS class_id, box_id,
    CAST(x1 AS INTEGER) AS x1, class_id <> 7 AS label_ok, x2 - x1 < 45 AS geometry_ok, score > 2 AS kept, class_id % 2 = 1 AS verified,
    score <> 5 AS classified FROM {boxes} JOIN {orders} ON image = o_orderkey"""
_IMAGES = "SELECT o_orderpriority AS device, concat('img_', CAST(o_orderkey AS STRING), '.png') AS image FROM {orders}"
_CLASSES = """SELECT DISTINCT device, class_id, 8 - class_id AS ordinal, concat('lamp ', CAST(class_id AS STRING)) AS name,
    concat('L', CAST(class_id AS STRING)) AS short_label FROM """


@query("src13_nested_export", f"""
    WITH found AS ({_FOUND}), images AS ({_IMAGES}), classes AS ({_CLASSES} found),
    ranked AS (SELECT device, image, class_id, box_id, x1, row_number() OVER (PARTITION BY device ORDER BY image, box_id) AS rn
      FROM images LEFT JOIN found USING (device, image)),
    files AS (SELECT device, (rn - 1) // 1000 AS page, image, concat('"', image, '":[', string_agg('{{"class_id":' || class_id || ',"box_id":"' || box_id
      || '","x1":' || x1 || '}}', ',' ORDER BY rn), ']') AS item FROM ranked GROUP BY device, page, image),
    pages AS (SELECT device, page, string_agg(item, ',' ORDER BY image) AS items FROM files GROUP BY ALL),
    numbered AS (SELECT *, row_number() OVER (PARTITION BY device ORDER BY ordinal) - 1 AS place FROM classes),
    head AS (SELECT device, concat('"schema_classes":[', string_agg(concat('{{"order":', place, ',"class_id":', class_id, ',"name":"', name, '","short_label":"',
        short_label, '"}}'), ',' ORDER BY place), '],"class_order":[', string_agg(CAST(class_id AS VARCHAR), ',' ORDER BY place), '],"names":{{',
        string_agg(concat('"', class_id, '":"', name, '"'), ',' ORDER BY class_id), '}},') AS top FROM numbered GROUP BY device),
    stats AS (SELECT device, concat(',"meta":{{"raw":', count(*), ',"label_passed":', count_if(label_ok), ',"geometry_passed":', count_if(label_ok AND geometry_ok),
        ',"after_dedup":', count_if(label_ok AND geometry_ok AND kept), ',"verified":', count_if(label_ok AND geometry_ok AND kept AND verified),
        ',"classified":', count_if(label_ok AND geometry_ok AND kept AND verified AND classified), '}}') AS meta FROM found GROUP BY device)
    SELECT device, page, concat('{{"format":"tiled_prelabel","device_name":"', device, '","page":', page, ',', CASE WHEN page = 0 THEN top END,
      '"annotations":{{', items, '}},"needs_human_review":true', CASE WHEN page = 0 THEN meta END, '}}') AS document
    FROM pages LEFT JOIN head USING (device) LEFT JOIN stats USING (device)""")
def src13_nested(t: Tables):
    found = durable(t.sql(_FOUND))  # read by five steps below
    classes = t.spark.sql(_CLASSES + "{found}", found=found)
    return B.export_documents(t.sql(_IMAGES), found, classes, B.funnel(found, ["device"]), [("box_id", "asc")],
                              ["class_id", "box_id", "x1"])


_JSON = """SELECT l_orderkey, concat(chr(123), '"device_name": "', l_returnflag, '", "annotations": ', chr(123), '"img_', CAST(l_partkey AS STRING), '.png": [',
    chr(123), '"class_id": ', CAST(l_linenumber AS STRING), ', "x": ', CAST(l_suppkey AS STRING), ', "y": 2, "w": ', CAST(CAST(l_quantity AS BIGINT) AS STRING),
    ', "h": 4.5', chr(125), '], "empty_', CAST(l_suppkey AS STRING), '.png": []', chr(125), chr(125)) AS body FROM {lineitem}"""


@query("src04_annotation_json", """
    SELECT l_orderkey, l_returnflag AS device, concat('img_', CAST(l_partkey AS VARCHAR), '.png') AS filename, l_linenumber AS class_id,
      CAST(l_suppkey AS DOUBLE) AS x, CAST(l_quantity AS DOUBLE) AS w FROM {lineitem}
    UNION ALL SELECT l_orderkey, l_returnflag, concat('empty_', CAST(l_suppkey AS VARCHAR), '.png'), NULL, NULL, NULL FROM {lineitem}""")
def src04(t: Tables):
    boxes = A.explode_annotations(t.sql(_JSON), "body")
    return boxes.select("l_orderkey", "device", "filename", "class_id", "x", "w")


@query("f14_box_fields", """
    SELECT l_orderkey, l_linenumber, CAST(CASE WHEN l_partkey % 3 = 2 THEN NULL ELSE l_partkey END AS DOUBLE) AS x1 FROM {lineitem}""")
def f14(t: Tables):
    def answer(field: str):
        return F.format_string('thinking... {"found": true, "%s": [%d, 1, 2, 3]} done', F.lit(field), F.col("l_partkey"))

    raw = F.when(F.col("l_partkey") % 3 == 0, answer("bbox_2d")).when(F.col("l_partkey") % 3 == 1, answer("bbox")).otherwise("no box")
    return t.lineitem.select("l_orderkey", "l_linenumber", A.box_of_answer(raw)[0].alias("x1"))


@query("src06_class_lines", "SELECT p_partkey, CAST(p_size AS INTEGER) AS class_id, p_name AS name FROM {part} WHERE p_partkey % 4 <> 0")
def src06(t: Tables):
    line = F.when(F.col("p_partkey") % 4 == 0, F.concat("p_name", F.lit(": x"))).otherwise(
        F.concat(F.lit(" "), F.col("p_size").cast("string"), F.lit(" : "), "p_name", F.lit(" ")))
    return C.parse_class_lines(t.part.select("p_partkey", line.alias("value")))


@query("src14_dense_classes", """
    WITH n AS (SELECT p_brand AS device, p_size AS class_id, min(p_name) AS name FROM {part} WHERE p_size % 2 = 0 GROUP BY 1, 2),
    m AS (SELECT device, unnest(generate_series(0, max(class_id))) AS class_id FROM n GROUP BY device)
    SELECT m.device, CAST(m.class_id AS INTEGER) AS class_id, coalesce(n.name, concat('class_', CAST(m.class_id AS VARCHAR))) AS name
    FROM m LEFT JOIN n ON m.device = n.device AND m.class_id = n.class_id""")
def src14(t: Tables):
    names = t.part.filter("p_size % 2 = 0").groupBy(F.col("p_brand").alias("device"), F.col("p_size").alias("class_id")).agg(
        F.min("p_name").alias("name"))
    return C.dense_classes(names, ["device"])


# catalogue -----------------------------------------------------------------------------------------

_FAMILY = """CASE WHEN name LIKE 'ALM %' THEN 'ALM' WHEN name LIKE 'PWR %' THEN 'PWR' ELSE 'RAW:' || upper(replace(name, ' ', '')) END"""


@query("f16_semantic_keys", f"SELECT device, name, short_label, module, {_FAMILY} AS family FROM {{catalog}}")
def f16(t: Tables):
    return t.catalog.select("device", "name", "short_label", "module",
                            text.semantic_key(F.col("name"), F.col("short_label")).alias("family"))


@query("f15_short_labels", """
    SELECT device, name, module, short_label, CASE WHEN short_label <> '' THEN upper(short_label) ELSE
      split_part(upper(name), ' ', 1) END AS label FROM {catalog}""")
def f15(t: Tables):
    return t.catalog.select("device", "name", "module", "short_label",
                            text.short_label_of(F.col("name"), F.col("short_label")).alias("label"))


_DEDUP = f"""
    WITH c AS (SELECT *, {_FAMILY} AS key FROM {{catalog}}),
    s AS (SELECT device, key, arg_min(name, length(name) * 100000000 + ordinal) AS shortest, arg_min(short_label, ordinal) AS short_label,
        count(*) AS merged, min(ordinal) AS ordinal FROM c GROUP BY device, key),
    e AS (SELECT *, CASE key WHEN 'ALM' THEN 'ALM 告警指示灯' WHEN 'PWR' THEN 'PWR 电源指示灯' ELSE shortest END AS name FROM s),
    entries AS (SELECT *, row_number() OVER (PARTITION BY device ORDER BY key, ordinal) - 1 AS class_id FROM e)"""


def _entries(t: Tables):
    return C.deduplicate(t.catalog)


@query("a09_catalog_entries", _DEDUP + "SELECT device, class_id, key, name, merged FROM entries")
def a09(t: Tables):
    return _entries(t).select("device", "class_id", "key", "name", "merged")


@query("a09_entry_modules", _DEDUP + """, m AS (SELECT device, key, module, min(ordinal) AS p FROM c GROUP BY ALL)
    SELECT device, key, string_agg(module, ',' ORDER BY p) AS modules FROM m GROUP BY device, key""")
def a09_modules(t: Tables):
    return _entries(t).select("device", "key", F.array_join("modules", ",").alias("modules"))


@query("a09_entry_states", _DEDUP + """,
    st AS (SELECT device, key, concat('s', ordinal % 3, ':', module) AS state, ordinal * 2 AS p FROM c
      UNION ALL SELECT device, key, concat('off:', CASE WHEN ordinal % 2 = 0 THEN 'dark' ELSE '' END), ordinal * 2 + 1 FROM c),
    f AS (SELECT device, key, state, min(p) AS p FROM st GROUP BY ALL)
    SELECT device, key, string_agg(state, ',' ORDER BY p) AS states FROM f GROUP BY device, key""")
def a09_states(t: Tables):
    def state(name, meaning):
        return F.struct(name.alias("state"), meaning.alias("meaning"))

    p = F.col("ordinal")
    rows = t.catalog.withColumn("states", F.array(state(F.concat(F.lit("s"), (p % 3).cast("string")), F.col("module")),
                                                  state(F.lit("off"), F.when(p % 2 == 0, "dark").otherwise(""))))
    joined = F.transform("states", lambda s: F.concat_ws(":", s["state"], s["meaning"]))
    return C.deduplicate(rows).select("device", "key", F.array_join(joined, ",").alias("states"))


@query("a09_strict_entries", """
    SELECT device, concat('STRICT:', upper(replace(name, ' ', ''))) AS key, count(*) AS merged FROM {catalog} GROUP BY ALL""")
def a09_strict(t: Tables):
    return C.deduplicate(t.catalog, "strict").select("device", "key", "merged")


@query("a08_merged_candidates", """
    WITH c AS (SELECT *, CASE WHEN short_label <> '' THEN upper(short_label) ELSE split_part(upper(name), ' ', 1) END AS label FROM {catalog})
    SELECT device, concat('label|', label, '|', lower(module)) AS merge_key, arg_max(name, length(name) * 100000000 - ordinal) AS name,
      coalesce(arg_min(short_label, ordinal) FILTER (short_label <> ''), '') AS short_label, count(*) AS merged FROM c GROUP BY ALL""")
def a08(t: Tables):
    return C.merge_candidates(t.catalog).select("device", "merge_key", "name", "short_label", "merged")


@query("a20_first_seen_modules", """
    SELECT device, string_agg(module, ',' ORDER BY p) AS modules FROM (SELECT device, module, min(ordinal) AS p FROM {catalog} GROUP BY ALL) GROUP BY device""")
def a20(t: Tables):
    listed = C.first_seen(t.catalog, ["device"], F.col("module"), text.catalog_key(F.col("module")), F.col("ordinal"))
    return listed.select("device", F.array_join("values", ",").alias("modules"))


@query("w07_class_numbers", """
    SELECT device, name, short_label, module, row_number() OVER (PARTITION BY device ORDER BY module, name, ordinal, short_label) - 1 AS class_id FROM {catalog}""")
def w07(t: Tables):
    n = C.number(t.catalog, [("module", "asc"), ("name", "asc"), ("ordinal", "asc"), ("short_label", "asc")])
    return n.select("device", "name", "short_label", "module", "class_id")


# the SQL distance counts bytes: every wider character of the names becomes one free ASCII character
_WIDE = "".join(sorted({c for name in vocab.PREFERRED_NAMES.values() for c in name.upper() if ord(c) > 127}))
_FREE = "abcdefghijklmnopqrstuvwxyz!#$%&()*+,:;<=>?@[]^{|}~"[:len(_WIDE)].replace("{", "").replace("}", "")


@query("j20_ambiguous_names", _DEDUP + f""", k AS (SELECT *, translate(upper(regexp_replace(name, '[\\s_\\-./]+', '', 'g')), '{_WIDE}', '{_FREE}') AS n FROM entries)
    SELECT a.device, a.class_id AS class_a, a.name AS name_a, b.class_id AS class_b, b.name AS name_b,
      round(1 - levenshtein(a.n, b.n) / greatest(length(a.n), length(b.n))::DOUBLE, 3) AS similarity
    FROM k a JOIN k b ON a.device = b.device AND a.class_id < b.class_id
    WHERE levenshtein(a.n, b.n) * 100 <= greatest(length(a.n), length(b.n)) * 28 AND a.key <> b.key""")
def j20(t: Tables):
    return C.ambiguous_pairs(_entries(t))


_EVIDENCE = """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, p_brand AS device, CASE l_suppkey % 4 WHEN 0 THEN 'ALM' WHEN 1 THEN p_type WHEN 2 THEN substr(p_type, 1, 4)
      ELSE NULL END AS label_text, CASE WHEN l_suppkey % 3 = 0 THEN concat('M', CAST(l_linenumber % 4 AS STRING)) END AS module_text,
    CASE WHEN l_suppkey % 5 = 0 THEN p_name END AS interface_text, p_name AS nearby FROM {lineitem} JOIN {part} ON l_partkey = p_partkey"""
_RETRIEVED = _DEDUP + f""", ev AS (SELECT DISTINCT device, label_text, module_text, interface_text, nearby FROM ({_EVIDENCE})),
    m AS (SELECT device, key, string_agg(module, ' ' ORDER BY p) AS modules FROM (SELECT device, key, module, min(ordinal) AS p FROM c GROUP BY ALL) GROUP BY device, key),
    al AS (SELECT device, key, string_agg(name, ' ' ORDER BY p) AS names, list(name ORDER BY p) AS name_list FROM (
        SELECT device, key, arg_min(name, ordinal) AS name, min(ordinal) AS p FROM c GROUP BY device, key, upper(replace(name, ' ', ''))) GROUP BY device, key),
    x AS (SELECT e.device, e.class_id, e.name, list_distinct(list_concat(
        regexp_extract_all(upper(e.name || ' | ' || CASE WHEN e.key LIKE 'RAW%' THEN '' ELSE al.names || ' | ' END || m.modules), '[A-Z][A-Z0-9/+_-]{{1,24}}'),
        [regexp_replace(upper(e.name || CASE WHEN e.key LIKE 'RAW%' THEN '' ELSE al.names END || m.modules), '[^A-Z0-9+\\-/一-龥]', '', 'g')])) AS tokens,
        regexp_replace(upper(e.name || CASE WHEN e.key LIKE 'RAW%' THEN '' ELSE al.names END || m.modules), '[^A-Z0-9+\\-/一-龥]', '', 'g') AS body
      FROM entries e JOIN m ON e.device = m.device AND e.key = m.key JOIN al ON e.device = al.device AND e.key = al.key),
    sc AS (SELECT ev.*, x.class_id, x.name AS class_name, CASE WHEN label_text IS NULL THEN 0 WHEN list_contains(tokens, label_text) THEN 100
          WHEN length(label_text) >= 3 AND contains(body, label_text) THEN 75 ELSE 0 END
        + CASE WHEN module_text IS NOT NULL AND contains(body, module_text) THEN 38 ELSE 0 END
        + CASE WHEN interface_text IS NOT NULL AND contains(body, upper(replace(interface_text, ' ', ''))) THEN 32 ELSE 0 END
        + least(30, 8 * len(list_intersect(tokens, [upper(split_part(nearby, ' ', 1)), upper(split_part(nearby, ' ', 2)), upper(replace(nearby, ' ', ''))]))) AS score
      FROM ev JOIN x ON ev.device = x.device),
    k AS (SELECT *, row_number() OVER (PARTITION BY device, label_text, module_text, interface_text, nearby ORDER BY score DESC, class_id) AS place FROM sc)"""


def _evidence(t: Tables):
    return t.sql(_EVIDENCE).withColumn("nearby_text", F.array("nearby")).withColumn("relative_position", F.lit(None).cast("string"))


@query("j12_evidence_retrieval", _RETRIEVED + """
    SELECT DISTINCT device, label_text, module_text, interface_text, nearby, class_id, class_name, score, CAST(place AS INTEGER) AS place FROM k WHERE place <= 5""")
def j12(t: Tables):
    asked = _evidence(t).select("device", "label_text", "module_text", "interface_text", "nearby", "nearby_text", "relative_position").distinct()
    return C.retrieve_entries(asked, _entries(t)).select(
        "device", "label_text", "module_text", "interface_text", "nearby", "class_id", "class_name", "score", "place")


_KEYED = "concat_ws('|', device, coalesce(label_text, '~'), coalesce(module_text, '~'), coalesce(interface_text, '~'), nearby)"


@query("s03_best_entry_per_box", _RETRIEVED + f""", k1 AS MATERIALIZED (SELECT {_KEYED} AS ek, class_id, score FROM k WHERE place = 1),
    b AS MATERIALIZED (SELECT {_KEYED} AS ek, l_orderkey, l_linenumber, l_partkey, l_suppkey FROM ({_EVIDENCE}))
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, class_id, score FROM b JOIN k1 ON b.ek = k1.ek""")
def s03(t: Tables):
    return C.retrieve_entries(_evidence(t), _entries(t), 1).select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "class_id", "score")


_PRINTS = """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, concat('xx ', lower(p_name), CASE WHEN l_suppkey % 3 = 0 THEN ' Econ' ELSE '' END) AS ocr_text,
    l_discount * 10 AS visual_score FROM {lineitem} JOIN {part} ON l_partkey = p_partkey"""
_TERMS = "SELECT DISTINCT split_part(p_name, ' ', 1) AS keyword FROM {part} WHERE p_partkey % 2 = 0 UNION SELECT 'ECON'"


@query("j19_unique_terms", f"""
    WITH t AS ({_TERMS}), p AS (SELECT DISTINCT ocr_text FROM ({_PRINTS})),
    h AS (SELECT ocr_text, count(*) AS hits, min(keyword) AS keyword FROM p JOIN t ON contains(upper(ocr_text), upper(keyword)) GROUP BY ocr_text)
    SELECT x.*, CASE WHEN hits = 1 THEN keyword ELSE 'unknown_indicator' END AS label, round(CASE WHEN hits = 1 THEN least(0.95, visual_score * 0.35e0 + 0.55e0)
      ELSE least(0.55, visual_score * 0.3e0 + 0.25e0) END, 4) AS confidence FROM ({_PRINTS}) x LEFT JOIN h ON x.ocr_text = h.ocr_text""")
def j19(t: Tables):
    return C.match_terms(t.sql(_PRINTS), t.sql(_TERMS))


@query("f36_class_text", _DEDUP + """, m AS (SELECT device, key, string_agg(module, ' ' ORDER BY p) AS modules, arg_min(module, p) AS module FROM (
      SELECT device, key, module, min(ordinal) AS p FROM c GROUP BY ALL) GROUP BY device, key)
    SELECT e.device, concat(CAST(class_id AS VARCHAR), ': ', name, '；模块=', m.module) AS line FROM entries e JOIN m ON e.device = m.device AND e.key = m.key""")
def f36(t: Tables):
    e = _entries(t).withColumn("module", F.get("modules", F.lit(0))).drop("aliases")
    return e.select("device", C.class_text(e, aliases=6, evidence_chars=180).alias("line"))


