"""Queries: frame curation."""

from pyspark.sql import functions as F

from pilotlamp.functions import images, text
from pilotlamp.operators import frames as V
from pilotlamp.operators import ordered
from pilotlamp.plans.registry import Tables, query
from pilotlamp.session import durable

_VIDEOS = """
    SELECT c_custkey AS video, 24 + c_custkey % 7 AS fps, 1 + abs(CAST(floor(c_acctbal) AS BIGINT)) % 600 AS total
    FROM {customer}"""


@query("flt01_modulo_sampling", """
    SELECT frame_idx FROM {frames} WHERE frame_idx % greatest(1, CAST(round_even(0.8 * (2 + video_idx % 9), 0) AS BIGINT)) = 0""")
def flt01(t: Tables):
    return V.sample_frames(t.frames, 0.8, 2 + F.col("video_idx") % 9).select("frame_idx")


@query("flt01_frame_plan", f"""
    WITH v AS (SELECT *, greatest(1, CAST(round_even(fps * 0.8::DOUBLE, 0) AS BIGINT)) AS step FROM ({_VIDEOS})),
    x AS (SELECT *, ceil(total / step) < 12 AND total > 1 AS few, least(12, total) AS n FROM v)
    SELECT DISTINCT video, fps, total, CAST(round_even(i * ((total - 1) / (n - 1)), 0) AS BIGINT) AS frame_idx
    FROM (SELECT *, unnest(generate_series(0, n - 1)) AS i FROM x WHERE few)
    UNION ALL SELECT video, fps, total, unnest(generate_series(0, total - 1, step)) FROM x WHERE NOT few""")
def flt01_plan(t: Tables):
    return V.frame_plan(t.sql(_VIDEOS), 0.8, 12)


_FLAGS = """
    SELECT *, CASE WHEN why = '' THEN 'ok' ELSE why END AS quality_reason, why = '' AS passed_quality FROM (
      SELECT *, concat_ws(',', CASE WHEN blur < 40 THEN 'blurry' END, CASE WHEN brightness < 20 THEN 'too_dark' END,
        CASE WHEN brightness > 240 THEN 'too_bright' END) AS why FROM {frames})"""


@query("flt02_quality_flags", f"SELECT frame_idx, quality_reason, passed_quality FROM ({_FLAGS})")
def flt02(t: Tables):
    return V.flag_quality(t.frames).select("frame_idx", "quality_reason", "passed_quality")


_BINS = f"""
    WITH q AS ({_FLAGS}), g AS (SELECT *, max(CAST(passed_quality AS INT)) OVER (PARTITION BY device, video_idx) AS hit FROM q),
    r AS (SELECT *, row_number() OVER (PARTITION BY device, video_idx ORDER BY time_sec, frame_idx) - 1 AS r,
      count(*) OVER (PARTITION BY device, video_idx) AS n FROM g WHERE passed_quality OR hit = 0),
    b AS (SELECT r.*, CASE WHEN n <= 6 THEN r ELSE (SELECT max(i) FROM generate_series(0, 5) AS s(i)
      WHERE floor(i * (n / 6e0)) <= r.r) END AS bin FROM r),
    selected AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY device, video_idx, bin
      ORDER BY blur DESC, contrast DESC, r) AS k FROM b) WHERE k = 1)
"""


@query("w02_equal_count_bins", _BINS + "SELECT device, video_idx, frame_idx FROM selected")
def w02(t: Tables):
    return V.pick_equal_counts(V.flag_quality(t.frames), 6).select("device", "video_idx", "frame_idx")


_SUMMARY = _BINS + """, summary AS (
    SELECT device, video_idx, max(time_sec) AS duration_sec, count(*) AS sampled_frames,
      count(*) FILTER (passed_quality) AS quality_passed,
      (SELECT count(*) FROM selected s WHERE s.device = q.device AND s.video_idx = q.video_idx) AS selected_frames
    FROM q GROUP BY device, video_idx)
"""


def _summary(t: Tables):
    flagged = V.flag_quality(t.frames)
    return V.video_summary(flagged, V.pick_equal_counts(flagged, 6))


@query("a12_video_summary", _SUMMARY + "SELECT * REPLACE (round(duration_sec, 3) AS duration_sec) FROM summary")
def a12(t: Tables):
    return _summary(t).withColumn("duration_sec", F.round("duration_sec", 3))


@query("a12_device_index", _SUMMARY + """
    SELECT device, count(*) AS video_count, round(sum(duration_sec), 1) AS video_duration_sec,
      CAST(sum(sampled_frames) AS BIGINT) AS sampled_frames, CAST(sum(quality_passed) AS BIGINT) AS quality_passed,
      CAST(sum(selected_frames) AS BIGINT) AS selected_frames FROM summary GROUP BY device""")
def a12_index(t: Tables):
    return V.device_index(_summary(t)).withColumn("video_duration_sec", F.round("video_duration_sec", 1))


@query("a13_clarity_thresholds", """
    SELECT device, video_idx, round(greatest(28, quantile_cont(clarity, 0.2)), 6) AS clarity_threshold
    FROM {frames} GROUP BY device, video_idx""")
def a13(t: Tables):
    return V.clarity_thresholds(t.frames).withColumn("clarity_threshold", F.round("clarity_threshold", 6))


_BUCKETS = """
    WITH q AS (SELECT device, video_idx, count(*) AS n, quantile_cont(CAST(scale_score AS DOUBLE), 0.33) AS q1,
      quantile_cont(CAST(scale_score AS DOUBLE), 0.67) AS q2 FROM {frames} WHERE scale_score > 0 GROUP BY 1, 2)
    SELECT f.*, CASE WHEN coalesce(q.n, 0) < 3 OR scale_score <= 0 THEN 'mid' WHEN scale_score <= q1 + 1e-9 THEN 'far'
      WHEN scale_score >= q2 - 1e-9 THEN 'near' ELSE 'mid' END AS bucket
    FROM {frames} f LEFT JOIN q ON f.device = q.device AND f.video_idx = q.video_idx"""


@query("a14_scale_buckets", f"SELECT device, video_idx, frame_idx, bucket FROM ({_BUCKETS})")
def a14(t: Tables):
    return V.scale_buckets(t.frames).select("device", "video_idx", "frame_idx", "bucket")


@query("w03_equal_width_bins", """
    WITH f AS (SELECT * FROM {frames}), s AS (SELECT *, min(time_sec) OVER w AS t0, max(time_sec) OVER w AS t1,
      count(*) OVER w AS n FROM f WINDOW w AS (PARTITION BY device, video_idx)),
    b AS (SELECT *, CASE WHEN t1 <= t0 THEN 0 ELSE least(3, CAST(floor((time_sec - t0) / (t1 - t0 + 1e-9) * 4) AS BIGINT)) END AS bin FROM s),
    h AS (SELECT *, row_number() OVER (PARTITION BY device, video_idx, bin ORDER BY clarity DESC, time_sec, frame_idx) = 1
      AND t1 > t0 AS head FROM b),
    c AS (SELECT *, row_number() OVER (PARTITION BY device, video_idx ORDER BY head DESC, clarity DESC, time_sec, frame_idx) AS k FROM h)
    SELECT device, video_idx, frame_idx FROM c WHERE n <= 4 OR k <= 4""")
def w03(t: Tables):
    return V.pick_over_time(t.frames, V.VIDEO, 4).select("device", "video_idx", "frame_idx")


@query("w08_stride_sample", """
    WITH r AS (SELECT device, frame_idx, row_number() OVER (PARTITION BY device ORDER BY frame_idx) - 1 AS r,
      count(*) OVER (PARTITION BY device) AS n FROM {frames})
    SELECT device, frame_idx FROM r WHERE n <= 50 OR r IN (
      SELECT least(CAST(floor(i * (n / 50e0)) AS BIGINT), n - 1) FROM generate_series(0, 49) AS s(i))""")
def w08(t: Tables):
    return V.stride_sample(t.frames.select("device", "frame_idx"), ["device"], [("frame_idx", "asc")], 50)


@query("w09_balanced_sample", """
    WITH r AS (SELECT device, video_idx, frame_idx, row_number() OVER (PARTITION BY device, video_idx ORDER BY frame_idx) AS round
      FROM {frames}), k AS (SELECT *, row_number() OVER (PARTITION BY device ORDER BY round, video_idx) AS place FROM r)
    SELECT device, video_idx, frame_idx, round, CAST(place AS INTEGER) AS place FROM k WHERE place <= 120""")
def w09(t: Tables):
    rows = t.frames.select("device", "video_idx", "frame_idx")
    return V.balanced_sample(rows, "device", "video_idx", [("frame_idx", "asc")], 120)


@query("w09_striding_sample", """
    WITH RECURSIVE sizes AS (SELECT device, video_idx, count(*) AS n, row_number() OVER (PARTITION BY device ORDER BY video_idx) AS g FROM {frames} GROUP BY 1, 2),
    own AS (SELECT device, list(n ORDER BY g) AS n, count(*) AS groups FROM sizes GROUP BY device),
    walk AS (
      SELECT device, n, groups, list_transform(n, lambda x: CAST(0 AS BIGINT)) AS spot, CAST(0 AS BIGINT) AS g, CAST(0 AS BIGINT) AS picks, CAST(NULL AS BIGINT) AS place FROM own
      UNION ALL
      SELECT device, n, groups, list_transform(spot, lambda x, i: CASE WHEN i = h THEN least(n[h], x + greatest(1, (n[h] - x) // greatest(1, (400 - picks) // groups))) ELSE x END),
        h, picks + 1, spot[h]
      FROM (SELECT *, coalesce(list_min(list_filter(open, lambda i: i > g)), list_min(open)) AS h FROM (
        SELECT *, list_filter(generate_series(1, groups), lambda i: spot[i] < n[i]) AS open FROM walk WHERE picks < 400)) WHERE len(open) > 0
    ),
    r AS (SELECT device, video_idx, frame_idx, row_number() OVER (PARTITION BY device, video_idx ORDER BY frame_idx) - 1 AS place FROM {frames}),
    named AS (SELECT r.*, s.g, w.place IS NOT NULL AS taken FROM r JOIN sizes s ON s.device = r.device AND s.video_idx = r.video_idx
      LEFT JOIN walk w ON w.device = r.device AND w.g = s.g AND w.place = r.place)
    SELECT device, video_idx, frame_idx FROM (SELECT *, row_number() OVER (PARTITION BY device, taken ORDER BY g, place) AS k,
      count(*) FILTER (taken) OVER (PARTITION BY device) AS have FROM named) WHERE taken OR k <= 400 - have""")
def w09_exact(t: Tables):
    rows = t.frames.select("device", "video_idx", "frame_idx")
    return V.striding_sample(rows, "device", "video_idx", [("frame_idx", "asc")], 400)


@query("w10_device_budget", """
    WITH r AS (SELECT *, row_number() OVER (PARTITION BY device, video_idx ORDER BY time_sec, frame_idx) AS r,
      count(*) OVER (PARTITION BY device, video_idx) AS n FROM {frames}),
    o AS (SELECT *, CASE WHEN r <= ceil(n / 2) THEN 2 * r - 1 ELSE 2 * (n - r) + 2 END AS turn FROM r),
    k AS (SELECT *, row_number() OVER (PARTITION BY device ORDER BY turn, video_idx) AS place FROM o)
    SELECT device, video_idx, frame_idx, turn, CAST(place AS INTEGER) AS place FROM k WHERE place <= 200""")
def w10(t: Tables):
    return V.budget_round_robin(t.frames, 200).select("device", "video_idx", "frame_idx", "turn", "place")


_LENGTHS = "SELECT device, video_idx, count(*) AS duration FROM {frames} GROUP BY device, video_idx"
_ALLOC = f"""
    WITH v AS (SELECT *, count(*) OVER (PARTITION BY device) AS n, sum(duration) OVER (PARTITION BY device) AS d,
        CASE device WHEN 'click' THEN 37 ELSE 1000 END AS budget FROM ({_LENGTHS})),
    s AS (SELECT *, (budget - n) * (duration / CAST(d AS DOUBLE)) AS share FROM v),
    r AS (SELECT *, row_number() OVER (PARTITION BY device ORDER BY share - floor(share) DESC, video_idx DESC) AS rr,
        row_number() OVER (PARTITION BY device ORDER BY duration DESC, video_idx) AS longest,
        sum(floor(share)) OVER (PARTITION BY device) AS used FROM s),
    counts AS (SELECT device, video_idx, duration, CAST(CASE WHEN budget <= n THEN CASE WHEN longest <= budget THEN 1 ELSE 0 END
      ELSE 1 + floor(share) + CASE WHEN rr <= budget - n - used THEN 1 ELSE 0 END END AS BIGINT) AS frames FROM r)
"""


def _alloc(t: Tables):
    return V.allocate(t.sql(_LENGTHS), F.when(F.col("device") == "click", 37).otherwise(1000))


@query("w11_frame_allocation", _ALLOC + "SELECT * FROM counts")
def w11(t: Tables):
    return _alloc(t)


_SHARP = """SELECT device, video_idx, frame_idx, time_sec, clarity AS center, 0.2e0 * blur + 0.8e0 * clarity AS combined
    FROM {frames}"""


@query("j16_best_near_anchor", _ALLOC + f""", x AS (SELECT c.device, c.video_idx, mt AS duration, frames
      FROM counts c JOIN (SELECT device, video_idx, max(time_sec) AS mt FROM {{frames}} GROUP BY 1, 2) m
        ON c.device = m.device AND c.video_idx = m.video_idx),
    a AS (SELECT *, duration * (anchor + 0.5e0) / frames AS anchor_sec FROM (
      SELECT *, unnest(generate_series(0, frames - 1)) AS anchor FROM x)),
    b AS (SELECT a.device, a.video_idx, a.anchor, a.anchor_sec, f.frame_idx, f.time_sec, f.combined, f.center,
        row_number() OVER (PARTITION BY a.device, a.video_idx, a.anchor ORDER BY combined DESC, time_sec, frame_idx) AS k
      FROM a JOIN ({_SHARP}) f ON a.device = f.device AND a.video_idx = f.video_idx
        AND f.time_sec BETWEEN a.anchor_sec - 60 AND a.anchor_sec + 60)
    SELECT device, video_idx, anchor, round(anchor_sec, 4) AS anchor_sec, frame_idx, round(time_sec, 4) AS time_sec,
      round(combined, 4) AS combined, round(center, 4) AS center FROM b WHERE k = 1""")
def j16(t: Tables):
    longest = t.frames.groupBy(*V.VIDEO).agg(F.max("time_sec").alias("end"))
    videos = _alloc(t).join(longest, V.VIDEO).select(
        *V.VIDEO, F.col("end").alias("duration"), "frames")
    best = V.best_near_anchors(videos, t.sql(_SHARP), 60.0)
    return best.select(*V.VIDEO, "anchor", "frame_idx", *[F.round(c, 4).alias(c) for c in
                                                         ("anchor_sec", "time_sec", "combined", "center")])


_GOOD = """
    WITH f AS (SELECT *, center >= 60 AS good FROM (""" + _SHARP + """)),
    g AS (SELECT device, video_idx, frame_idx, good AS quality_pass, center, row_number() OVER (PARTITION BY device ORDER BY good DESC,
      CASE WHEN good THEN CAST(video_idx AS DOUBLE) ELSE -combined END, time_sec, frame_idx) AS place FROM f)
"""


@query("w21_good_first", _GOOD + """
    SELECT device, video_idx, frame_idx, quality_pass, CAST(place AS INTEGER) AS place FROM g WHERE place <= 900""")
def w21(t: Tables):
    return V.good_first(t.sql(_SHARP), 900, 60.0).select("device", "video_idx", "frame_idx", "quality_pass", "place")


_PHOTOS = "SELECT event_type AS device, event_id AS item, value AS clarity FROM {events} WHERE value > 120"


@query("a18_rebuild_summary", _GOOD + f""", c AS (SELECT * FROM g WHERE place <= 900),
    p AS (SELECT device, count(*) AS photos FROM ({_PHOTOS}) GROUP BY device)
    SELECT c.device, coalesce(max(photos), 0) AS photos, count(*) AS frames, count(*) + coalesce(max(photos), 0) AS total_images,
      round(avg(center), 6) AS mean_center FROM c LEFT JOIN p ON c.device = p.device GROUP BY c.device""")
def a18(t: Tables):
    s = V.rebuild_summary(t.sql(_PHOTOS), V.good_first(t.sql(_SHARP), 900, 60.0))
    return s.withColumn("mean_center", F.round("mean_center", 6))


@query("w20_photos_then_frames", f"""
    WITH p AS (SELECT *, row_number() OVER (PARTITION BY device ORDER BY clarity DESC, item) AS k FROM ({_PHOTOS})),
    u AS (SELECT device, count(*) AS used FROM p WHERE k <= 300 GROUP BY device),
    f AS (SELECT device, frame_idx AS item, row_number() OVER (PARTITION BY device ORDER BY video_idx, time_sec, frame_idx) AS k FROM {{frames}})
    SELECT device, item, 'photo' AS kind FROM p WHERE k <= 300
    UNION ALL SELECT f.device, item, 'frame' FROM f LEFT JOIN u ON f.device = u.device WHERE k <= 300 - coalesce(used, 0)""")
def w20(t: Tables):
    return V.photos_then_frames(t.sql(_PHOTOS), t.frames.withColumn("item", F.col("frame_idx")), 300)


@query("j11_unannotated_devices", """
    SELECT p_brand AS device, count(*) AS parts FROM {part} WHERE p_brand NOT IN (
      SELECT p_brand FROM {part} WHERE p_retailprice < 901) GROUP BY p_brand""")
def j11(t: Tables):
    done = t.part.filter("p_retailprice < 901").select(F.col("p_brand").alias("device"))
    devices = t.part.groupBy(F.col("p_brand").alias("device")).agg(F.count(F.lit(1)).alias("parts"))
    return V.unannotated(devices, done)


_NAMES = """SELECT event_id, concat(CASE WHEN event_id % 5 = 0 THEN 'photo_' ELSE 'video_' END, CAST(event_id AS STRING),
    '__', event_type, CASE WHEN event_id % 3 = 0 THEN concat('__video_', CAST(user_id AS STRING)) ELSE '' END, '__t',
    CAST(event_id AS STRING), '.5__', CASE WHEN event_id % 2 = 0 THEN 'f12__' ELSE '' END, 'x.PNG') AS filename FROM {events}"""


@query("f17_frame_groups", f"""
    WITH n AS ({_NAMES}), v AS (SELECT *, regexp_extract(filename, '__(video_\\d+)__', 1) AS mid FROM n)
    SELECT event_id, CASE WHEN filename LIKE 'video!_%' ESCAPE '!' THEN concat('video::', CASE WHEN mid <> '' THEN mid
        ELSE regexp_extract(filename, '^(video_\\d+)__', 1) END) ELSE concat('photo::', filename) END AS split_group,
      CASE WHEN mid <> '' THEN mid WHEN filename LIKE 'photo!_%' ESCAPE '!' THEN '__photos__' END AS track_group,
      CASE WHEN regexp_matches(filename, '.__video_\\d+') THEN regexp_extract(filename, '^(.+?__video_\\d+)', 1)
        ELSE 'frames' END AS clip_group, event_id + 0.5e0 AS seconds FROM v""")
def f17(t: Tables):
    f = F.col("filename")
    return t.sql(_NAMES).select(
        "event_id", text.video_group(f).alias("split_group"), text.track_group(f).alias("track_group"),
        text.clip_group(f, F.lit("frames")).alias("clip_group"), text.frame_time(f).alias("seconds"))


@query("src02_file_mapping", """
    SELECT device, kind, path, concat(device, '__', kind, '_', lpad(CAST(row_number() OVER (
      PARTITION BY device, kind ORDER BY path) AS VARCHAR), greatest(3, length(CAST(row_number() OVER (
      PARTITION BY device, kind ORDER BY path) AS VARCHAR)))::INTEGER, '0'), '.png') AS new_name FROM (
      SELECT event_type AS device, CASE WHEN event_id % 5 = 0 THEN 'image' ELSE 'video' END AS kind,
        concat('/data/', CAST(event_id AS VARCHAR), '.png') AS path FROM {events})""")
def src02(t: Tables):
    from pilotlamp.sources import assets
    files = t.events.select(
        F.col("event_type").alias("device"), F.when(F.col("event_id") % 5 == 0, "image").otherwise("video").alias("kind"),
        F.concat(F.lit("/data/"), F.col("event_id").cast("string"), F.lit(".png")).alias("path"))
    return assets.map_names(files).select("device", "kind", "path", "new_name")


@query("flt21_ready_devices", """
    SELECT device FROM (SELECT event_type || '_' || CAST(user_id % 40 AS VARCHAR) AS device,
      max(CASE WHEN event_id % 11 = 0 THEN 1 ELSE 0 END) AS a, max(CASE WHEN event_id % 13 = 0 THEN 1 ELSE 0 END) AS i
      FROM {events} GROUP BY 1) WHERE a = 1 AND i = 1""")
def flt21(t: Tables):
    from pilotlamp.sources import assets
    folder = F.concat_ws("_", "event_type", (F.col("user_id") % 40).cast("string"))
    path = F.concat(F.lit("/data/"), folder, F.when(F.col("event_id") % 11 == 0, F.lit("/annotations.json"))
                    .when(F.col("event_id") % 13 == 0, F.lit("/images/a.png")).otherwise(F.lit("/readme.txt")))
    both = F.explode(F.when(F.col("event_id") % 143 == 0, F.array(
        F.concat(F.lit("/data/"), folder, F.lit("/annotations.json")),
        F.concat(F.lit("/data/"), folder, F.lit("/images/a.png")))).otherwise(F.array(path)))
    return assets.ready_devices(t.events.select(folder.alias("device"), both.alias("path")))


def _gray(t: Tables):
    """8x8 grey images from the vectors, one video per label."""
    px = F.transform("embedding", lambda x: F.least(F.lit(255.0), F.greatest(
        F.lit(0.0), F.floor(x.cast("double") * 240.0 + 127.5).cast("double"))))
    return t.embeddings.select(
        F.concat(F.lit("dev_"), F.col("label").cast("string")).alias("device"), F.col("label").alias("video_idx"),
        F.col("vec_id").alias("frame_idx"), (F.col("vec_id") * 0.8).alias("time_sec"), px.alias("px"))


_PX = """SELECT vec_id, list_transform(embedding, lambda x: least(255e0, greatest(0e0, floor(x::DOUBLE * 240e0 + 127.5e0)))) AS px
    FROM {embeddings}"""


@query("f25_image_metrics", f"""
    WITH p AS ({_PX}), c AS (SELECT vec_id, i // 8 AS r, i % 8 AS c, px[i + 1] AS v, px FROM (
      SELECT vec_id, px, unnest(generate_series(0, 63)) AS i FROM p)),
    l AS (SELECT vec_id, v, px[abs(r - 1) * 8 + c + 1] + px[(CASE WHEN r = 7 THEN 6 ELSE r + 1 END) * 8 + c + 1]
        + px[r * 8 + abs(c - 1) + 1] + px[r * 8 + (CASE WHEN c = 7 THEN 6 ELSE c + 1 END) + 1] - 4 * v AS lap FROM c)
    SELECT vec_id AS frame_idx, round(var_pop(lap) + 1e-7, 4) AS blur, round(avg(v) + 1e-7, 4) AS brightness,
      round(stddev_pop(v) + 1e-7, 4) AS contrast FROM l GROUP BY vec_id""")
def f25(t: Tables):
    m = _gray(t).withColumn("m", images.sharpness("px", F.lit(8), F.lit(8)))
    # the small shift keeps exact halves from rounding apart
    return m.select("frame_idx", *[F.round(F.col(f"m.{c}") + 1e-7, 4).alias(name) for c, name in
                                   (("full", "blur"), ("brightness", "brightness"), ("contrast", "contrast"))])


@query("f26_difference_hash", f"""
    WITH p AS ({_PX}), b AS (SELECT vec_id, unnest(generate_series(0, 55)) AS i, px FROM p)
    SELECT vec_id AS frame_idx, CAST(sum(CASE WHEN px[(i // 7) * 8 + i % 7 + 2] > px[(i // 7) * 8 + i % 7 + 1]
      THEN 1::BIGINT << (55 - i) ELSE 0 END) AS BIGINT) AS dhash FROM b GROUP BY vec_id""")
def f26(t: Tables):
    return _gray(t).select("frame_idx", images.difference_hash(F.col("px"), 8, 8).alias("dhash"))


@query("f27_histogram", f"""
    SELECT vec_id AS frame_idx, CAST(unnest(generate_series(0, 63)) AS INTEGER) AS bin,
      unnest(list_transform(generate_series(0, 63), lambda b: len(list_filter(px, lambda v: floor(v / 4) = b)) / 64e0)) AS share
    FROM ({_PX})""")
def f27(t: Tables):
    return _gray(t).select("frame_idx", F.posexplode(images.histogram(F.col("px"))).alias("bin", "share"))


@query("f27_neighbour_similarity", f"""
    WITH p AS ({_PX}), h AS (SELECT vec_id, px, list_transform(generate_series(0, 63),
        lambda b: len(list_filter(px, lambda v: floor(v / 4) = b)) / 64e0) AS hist FROM p),
    u AS (SELECT vec_id, unnest(hist) AS x, unnest(generate_series(0, 63)) AS i FROM h)
    SELECT a.vec_id AS frame_idx, round(corr(a.x, b.x), 6) AS correlation FROM u a JOIN u b
      ON b.vec_id = a.vec_id + 1 AND a.i = b.i GROUP BY a.vec_id""")
def f27_pairs(t: Tables):
    h = _gray(t).select("frame_idx", images.histogram(F.col("px")).alias("hist"))
    after = h.select((F.col("frame_idx") - 1).alias("frame_idx"), F.col("hist").alias("other"))
    return h.join(after, "frame_idx").select(
        "frame_idx", F.round(images.correlation(F.col("hist"), F.col("other")), 6).alias("correlation"))


def _marked(t: Tables):
    g = _gray(t).withColumn("m", images.sharpness("px", F.lit(8), F.lit(8)))
    g = g.select("device", "video_idx", "frame_idx", "time_sec", F.col("m.full").alias("clarity"),
                 (F.col("m.contrast") - 30).alias("scale_score"), images.difference_hash(F.col("px"), 8, 8).alias("dhash"),
                 images.histogram(F.col("px"), 8).alias("hist"))
    g = durable(V.scale_buckets(g).join(V.clarity_thresholds(g), V.VIDEO))  # read by several steps below
    return V.drop_near_duplicates(g, "clarity_threshold", max_hamming=24, min_correlation=0.5)


_FOLDED = f"""WITH RECURSIVE p AS (SELECT vec_id, label, px FROM (SELECT e.label, g.* FROM {{embeddings}} e JOIN ({_PX}) g ON e.vec_id = g.vec_id)),
    c AS (SELECT vec_id, i // 8 AS r, i % 8 AS c, px[i + 1] AS v, px FROM (SELECT vec_id, px, unnest(generate_series(0, 63)) AS i FROM p)),
    lap AS (SELECT vec_id, v, px[abs(r - 1) * 8 + c + 1] + px[(CASE WHEN r = 7 THEN 6 ELSE r + 1 END) * 8 + c + 1]
        + px[r * 8 + abs(c - 1) + 1] + px[r * 8 + (CASE WHEN c = 7 THEN 6 ELSE c + 1 END) + 1] - 4 * v AS lap FROM c),
    sharp AS (SELECT vec_id, var_pop(lap) AS clarity, stddev_pop(v) - 30 AS scale_score FROM lap GROUP BY vec_id),
    bits AS (SELECT vec_id, unnest(generate_series(0, 55)) AS i, px FROM p),
    code AS (SELECT vec_id, CAST(sum(CASE WHEN px[(i // 7) * 8 + i % 7 + 2] > px[(i // 7) * 8 + i % 7 + 1] THEN 1::BIGINT << (55 - i) ELSE 0 END) AS BIGINT) AS dhash FROM bits GROUP BY vec_id),
    h AS (SELECT vec_id, list_transform(generate_series(0, 7), lambda b: len(list_filter(px, lambda v: floor(v / 32) = b)) / 64e0 - 0.125e0) AS hist FROM p),
    fr AS (SELECT p.label AS video_idx, p.vec_id AS frame_idx, p.vec_id * 0.8e0 AS time_sec, clarity, scale_score, dhash, hist, sqrt(list_inner_product(hist, hist)) AS norm
      FROM p JOIN sharp USING (vec_id) JOIN code USING (vec_id) JOIN h USING (vec_id)),
    th AS (SELECT video_idx, greatest(28, quantile_cont(clarity, 0.2)) AS floor_ FROM fr GROUP BY video_idx),
    f AS (SELECT fr.*, floor_, row_number() OVER (PARTITION BY video_idx ORDER BY time_sec, frame_idx) AS k FROM fr JOIN th USING (video_idx)),
    walk AS (
      SELECT DISTINCT video_idx, CAST(0 AS BIGINT) AS k, CAST(NULL AS BIGINT) AS frame_idx, CAST(NULL AS VARCHAR) AS reason, CAST(NULL AS BIGINT) AS gone, CAST(NULL AS VARCHAR) AS why,
        CAST([] AS STRUCT(idx BIGINT, t DOUBLE, c DOUBLE, h BIGINT, hist DOUBLE[], norm DOUBLE)[]) AS kept FROM f
      UNION ALL
      SELECT video_idx, k, frame_idx,
        CASE WHEN clarity < floor_ THEN format('blur<{{:.1f}}', floor_) WHEN twin > 0 AND clarity <= kept[twin].c * 1.18e0 THEN format('duplicate@{{:.2f}}s', kept[twin].t) END,
        CASE WHEN clarity >= floor_ AND twin > 0 AND clarity > kept[twin].c * 1.18e0 THEN kept[twin].idx END,
        CASE WHEN clarity >= floor_ AND twin > 0 AND clarity > kept[twin].c * 1.18e0 THEN format('replaced_by_clearer@{{:.2f}}s', time_sec) END,
        CASE WHEN clarity < floor_ OR (twin > 0 AND clarity <= kept[twin].c * 1.18e0) THEN kept
          WHEN twin > 0 THEN list_append(list_concat(kept[1:twin - 1], kept[twin + 1:]), mine)
          ELSE list_append(kept, mine)[-8:] END
      FROM (SELECT *, coalesce(list_position(list_transform(kept, lambda o: bit_count(xor(o.h, dhash)) <= 24
          AND (norm * o.norm = 0 OR list_inner_product(hist, o.hist) / (norm * o.norm) >= 0.5e0)), true), 0) AS twin
        FROM (SELECT f.*, w.kept, {{{{'idx': f.frame_idx, 't': time_sec, 'c': clarity, 'h': dhash, 'hist': hist, 'norm': norm}}}} AS mine
          FROM walk w JOIN f ON f.video_idx = w.video_idx AND f.k = w.k + 1))
    ),
    judged AS (SELECT video_idx, frame_idx, max(reason) AS reject_reason FROM (
        SELECT video_idx, frame_idx, reason FROM walk WHERE k > 0 UNION ALL SELECT video_idx, gone, why FROM walk WHERE gone IS NOT NULL) GROUP BY ALL)""".replace("{{'idx'", "{'idx'").replace("norm}}", "norm}")


@query("w14_near_duplicates", _FOLDED + """
    SELECT concat('dev_', video_idx) AS device, frame_idx, reject_reason FROM judged""")
def w14(t: Tables):
    return _marked(t).select("device", "frame_idx", "reject_reason")


_CHOSEN = _FOLDED + """,
    q AS (SELECT video_idx, count(*) AS qn, quantile_cont(scale_score, 0.33) AS q1, quantile_cont(scale_score, 0.67) AS q2 FROM fr WHERE scale_score > 0 GROUP BY 1),
    m AS (SELECT fr.video_idx, fr.frame_idx, time_sec, clarity, reject_reason, CASE WHEN coalesce(qn, 0) < 3 OR scale_score <= 0 THEN 'mid'
        WHEN scale_score <= q1 + 1e-9 THEN 'far' WHEN scale_score >= q2 - 1e-9 THEN 'near' ELSE 'mid' END AS bucket
      FROM fr JOIN judged j ON j.video_idx = fr.video_idx AND j.frame_idx = fr.frame_idx LEFT JOIN q ON q.video_idx = fr.video_idx),
    reps AS (SELECT *, count(*) OVER (PARTITION BY video_idx) AS reps FROM m WHERE reject_reason IS NULL),
    many AS (SELECT *, count(*) OVER b AS n, min(time_sec) OVER b AS t0, max(time_sec) OVER b AS t1 FROM reps WHERE reps > 18 WINDOW b AS (PARTITION BY video_idx, bucket)),
    bins AS (SELECT *, CASE WHEN t1 <= t0 THEN 0 ELSE least(5, CAST(floor((time_sec - t0) / (t1 - t0 + 1e-9) * 6) AS BIGINT)) END AS bin FROM many),
    heads AS (SELECT *, t1 > t0 AND row_number() OVER (PARTITION BY video_idx, bucket, bin ORDER BY clarity DESC, time_sec, frame_idx) = 1 AS head FROM bins),
    quota AS (SELECT *, row_number() OVER (PARTITION BY video_idx, bucket ORDER BY head DESC, clarity DESC, time_sec, frame_idx) <= 6 OR n <= 6 AS taken FROM heads),
    filled AS (SELECT *, taken OR row_number() OVER (PARTITION BY video_idx, taken ORDER BY clarity DESC, time_sec, frame_idx)
        <= 18 - count(*) FILTER (taken) OVER (PARTITION BY video_idx) AS chosen FROM quota),
    first AS (SELECT m.*, coalesce(chosen, false) AS chosen FROM m LEFT JOIN (SELECT video_idx, frame_idx, true AS chosen FROM reps WHERE reps <= 18
        UNION ALL SELECT video_idx, frame_idx, chosen FROM filled) c ON c.video_idx = m.video_idx AND c.frame_idx = m.frame_idx),
    have AS (SELECT video_idx, count(*) FILTER (chosen) AS n, count(*) FILTER (chosen AND bucket = 'far') AS far, count(*) FILTER (chosen AND bucket = 'mid') AS mid,
        count(*) FILTER (chosen AND bucket = 'near') AS near, list(time_sec) FILTER (chosen) AS times FROM first GROUP BY video_idx),
    pool AS (SELECT f.video_idx, f.frame_idx, row_number() OVER (PARTITION BY f.video_idx ORDER BY
          CASE WHEN reject_reason LIKE '%duplicate%' OR reject_reason LIKE '%replaced%' THEN 3e0 ELSE 0e0 END + CASE WHEN reject_reason LIKE 'blur<%' THEN -3e0 ELSE 0e0 END
          + 2e0 / (1e0 + CASE bucket WHEN 'far' THEN far WHEN 'near' THEN near ELSE mid END)
          + least(3e0, coalesce(list_min(list_transform(times, lambda t: abs(time_sec - t))), 9999e0) / 2e0) + ln(1e0 + greatest(0e0, clarity)) / 4e0 DESC, time_sec, f.frame_idx) AS r, n
      FROM first f JOIN have h ON h.video_idx = f.video_idx AND h.n < 12 WHERE NOT chosen),
    selected AS (SELECT f.*, chosen OR p.frame_idx IS NOT NULL AS selected FROM first f
      LEFT JOIN pool p ON p.video_idx = f.video_idx AND p.frame_idx = f.frame_idx AND p.r <= 12 - p.n)"""


@query("w12_quota_selection", _CHOSEN + """
    SELECT concat('dev_', video_idx) AS device, frame_idx, bucket, reject_reason, selected FROM selected""")
def w12(t: Tables):
    return V.select_quota(_marked(t), 12, 18, 2).select("device", "frame_idx", "bucket", "reject_reason", "selected")


@query("a17_bucket_report", _CHOSEN + """
    SELECT concat('dev_', video_idx) AS device, video_idx, count(*) AS candidates, count(*) FILTER (reject_reason IS NULL) AS after_dedup, count(*) FILTER (selected) AS selected,
      count(*) FILTER (selected AND bucket = 'far') AS far, count(*) FILTER (selected AND bucket = 'mid') AS mid, count(*) FILTER (selected AND bucket = 'near') AS near
    FROM selected GROUP BY video_idx""")
def a17(t: Tables):
    return V.bucket_report(V.select_quota(_marked(t), 12, 18, 2))


@query("a17_reject_reasons", _CHOSEN + """
    SELECT concat('dev_', video_idx) AS device, regexp_replace(coalesce(reject_reason, CASE WHEN selected THEN 'selected' ELSE 'dropped_by_device_max_or_balance' END), '[<@].*$', '') AS outcome,
      count(*) AS n FROM selected GROUP BY ALL""")
def a17_reasons(t: Tables):
    return V.reason_report(V.select_quota(_marked(t), 12, 18, 2))


@query("s07_stable_order", """
    SELECT device, video_idx, frame_idx, row_number() OVER (ORDER BY device, video_idx, time_sec, frame_idx) AS place FROM {frames}""")
def s07(t: Tables):
    order = [("device", "asc"), ("video_idx", "asc"), ("time_sec", "asc"), ("frame_idx", "asc")]
    return ordered.rank_in_groups(t.frames, [], order, "place").select("device", "video_idx", "frame_idx", "place")
