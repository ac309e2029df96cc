"""Queries: splits, label files and dataset reports."""

from pyspark.sql import functions as F

from pilotlamp.operators import boxes as B
from pilotlamp.operators import splits as S
from pilotlamp.plans.registry import Tables, query

_TARGETS = """
    a AS (SELECT *, CAST(round_even(n * 0.7::DOUBLE, 0) AS BIGINT) AS tr, CAST(round_even(n * 0.15::DOUBLE, 0) AS BIGINT) AS va FROM sizes),
    b AS (SELECT *, CASE WHEN n >= 3 THEN greatest(tr, 1) ELSE tr END AS x, CASE WHEN n >= 3 THEN greatest(va, 1) ELSE va END AS y,
      CASE WHEN n >= 3 THEN greatest(n - tr - va, 1) ELSE n - tr - va END AS z FROM a),
    targets AS (SELECT * EXCLUDE (tr, va, x, y, z), x - CASE WHEN n >= 3 THEN x + y + z - n ELSE 0 END AS train, y AS val, z AS test FROM b)"""


@query("f35_split_targets", "WITH sizes AS (SELECT o_custkey AS k, count(*) AS n FROM {orders} GROUP BY 1)," + _TARGETS + """
    SELECT k, n, train, val, test FROM targets""")
def f35(t: Tables):
    n = t.orders.groupBy(F.col("o_custkey").alias("k")).agg(F.count(F.lit(1)).alias("n"))
    return n.select("k", "n", S.target_counts(F.col("n"), 0.7, 0.15).alias("t")).select("k", "n", "t.*")


@query("w17_split_by_name", "WITH sizes AS (SELECT device, count(*) AS n FROM {images} GROUP BY device)," + _TARGETS + """,
    r AS (SELECT *, row_number() OVER (PARTITION BY device ORDER BY filename) AS rn FROM {images})
    SELECT image, CASE WHEN rn <= train THEN 'train' WHEN rn <= train + val THEN 'val' ELSE 'test' END AS split
    FROM r JOIN targets t ON r.device = t.device""")
def w17(t: Tables):
    return S.split_by_name(t.images, ["device"], "filename").select("image", "split")


_LARGEST = "WITH RECURSIVE" + """ g AS (SELECT device, grp, CAST(count(*) AS BIGINT) AS size FROM {images} GROUP BY 1, 2),
    sizes AS (SELECT device, CAST(sum(size) AS BIGINT) AS n, count(*) AS groups FROM g GROUP BY device),""" + _TARGETS + """,
    turns AS (SELECT *, row_number() OVER (PARTITION BY device ORDER BY size DESC, grp) AS k FROM g),
    walk AS (
      SELECT device, CAST(0 AS BIGINT) AS k, CAST('' AS VARCHAR) AS grp, 0 AS part, CAST(0 AS BIGINT) AS a, CAST(0 AS BIGINT) AS b, CAST(0 AS BIGINT) AS c FROM targets
      UNION ALL
      SELECT device, k, grp, part, a + CASE WHEN part = 1 THEN size ELSE 0 END, b + CASE WHEN part = 2 THEN size ELSE 0 END, c + CASE WHEN part = 3 THEN size ELSE 0 END
      FROM (SELECT w.device, x.k, x.grp, x.size, w.a, w.b, w.c, CAST(CASE WHEN groups >= 3 AND x.k <= 3 THEN x.k
          WHEN train - a >= val - b AND train - a >= test - c THEN 1 WHEN val - b >= test - c THEN 2 ELSE 3 END AS INTEGER) AS part
        FROM walk w JOIN targets t ON t.device = w.device JOIN turns x ON x.device = w.device AND x.k = w.k + 1)
    ),
    largest AS (SELECT device, grp, CASE part WHEN 1 THEN 'train' WHEN 2 THEN 'val' ELSE 'test' END AS split FROM walk WHERE k > 0)"""


@query("w18_group_split", _LARGEST + " SELECT device, grp, split FROM largest")
def w18(t: Tables):
    return S.assign_largest_first(t.images, ["device"], "grp")


@query("w18_device_split", _LARGEST + """,
    named AS (SELECT i.device, i.grp, CASE WHEN rn <= train THEN 'train' WHEN rn <= train + val THEN 'val' ELSE 'test' END AS split
      FROM (SELECT *, row_number() OVER (PARTITION BY device ORDER BY filename) AS rn FROM {images}) i JOIN targets t ON t.device = i.device AND groups < 3),
    done AS (SELECT i.device, i.grp, l.split, 'video_group' AS strategy FROM {images} i JOIN largest l ON l.device = i.device AND l.grp = i.grp
        JOIN targets t ON t.device = i.device AND groups >= 3
      UNION ALL SELECT device, grp, split, 'image_level' FROM named)
    SELECT device, split, strategy, count(*) AS images, count(DISTINCT grp) AS groups FROM done GROUP BY device, split, strategy""")
def w18_devices(t: Tables):
    done = S.split_devices(t.images, ["device"], "grp", "filename")
    return done.groupBy("device", "split", "strategy").agg(F.count(F.lit(1)).alias("images"), F.countDistinct("grp").alias("groups"))


_SHUFFLED = """
    WITH g AS (SELECT device, grp, count(*) AS size FROM {images} GROUP BY 1, 2),
    o AS (SELECT *, row_number() OVER w AS rn, coalesce(sum(size) OVER (PARTITION BY device ORDER BY md5(concat('42:', grp)), grp
        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before, sum(size) OVER (PARTITION BY device) AS total
      FROM g WINDOW w AS (PARTITION BY device ORDER BY md5(concat('42:', grp)), grp)),
    p AS (SELECT *, before < total * 0.7::DOUBLE AS tr, sum(CASE WHEN before < total * 0.7::DOUBLE THEN size ELSE 0 END) OVER (PARTITION BY device) AS used FROM o),
    assigned AS (SELECT device, grp, CAST(size AS BIGINT) AS size, CASE WHEN tr THEN 'train' WHEN before - used < total * 0.15::DOUBLE THEN 'val' ELSE 'test' END AS split FROM p)
"""


@query("w19_shuffled_group_split", _SHUFFLED + "SELECT * FROM assigned")
def w19(t: Tables):
    return S.assign_shuffled(t.images, ["device"], "grp")


_SPLIT_IMAGES = _SHUFFLED + """, si AS (SELECT i.*, a.split, CAST(i.image % 4 AS BIGINT) AS n_boxes FROM {images} i JOIN assigned a ON i.device = a.device AND i.grp = a.grp)
"""


def _split_images(t: Tables):
    done = S.apply_splits(t.images, S.assign_shuffled(t.images, ["device"], "grp"), ["device"], "grp")
    return done.withColumn("n_boxes", F.col("image") % 4)


@query("a11_split_summary", _SPLIT_IMAGES + """
    SELECT coalesce(split, 'total') AS split, count(*) AS images, CAST(sum(n_boxes) AS BIGINT) AS boxes, count(*) FILTER (n_boxes = 0) AS empty
    FROM si GROUP BY ROLLUP (split)""")
def a11(t: Tables):
    return S.split_summary(_split_images(t))


@query("flt19_missing_classes", _SPLIT_IMAGES + """, l AS (SELECT split, grp AS class_name FROM si)
    SELECT c.class_name, s.split AS missing_in FROM (SELECT DISTINCT class_name FROM l) c, (VALUES ('train'), ('val'), ('test')) AS s(split)
    WHERE NOT EXISTS (SELECT 1 FROM l WHERE l.class_name = c.class_name AND l.split = s.split)""")
def flt19(t: Tables):
    return S.missing_classes(_split_images(t).withColumn("class_name", F.col("grp")), "class_name")


@query("o03_train_only_devices", _SPLIT_IMAGES + """
    SELECT grp FROM si WHERE split = 'train' EXCEPT SELECT grp FROM si WHERE split = 'test'""")
def o03(t: Tables):
    done = _split_images(t)
    return done.filter("split = 'train'").select("grp").subtract(done.filter("split = 'test'").select("grp"))


@query("a10_class_totals", """
    SELECT c.class_id, concat('class_', CAST(c.class_id AS VARCHAR)) AS name, count(b.box_id) AS instances
    FROM (SELECT DISTINCT p_size AS class_id FROM {part}) c LEFT JOIN {boxes} b ON b.class_id = c.class_id GROUP BY c.class_id""")
def a10(t: Tables):
    names = t.part.select(F.col("p_size").alias("class_id")).distinct().withColumn(
        "name", F.concat(F.lit("class_"), F.col("class_id").cast("string")))
    return S.class_totals(names, t.boxes)


@query("j10_annotated_images", """
    SELECT l_orderkey AS image, count(*) AS boxes, l_orderkey IN (SELECT o_orderkey FROM {orders} WHERE o_custkey % 3 <> 0) AS present
    FROM {lineitem} GROUP BY l_orderkey""")
def j10(t: Tables):
    files = t.orders.filter("o_custkey % 3 <> 0").select(F.col("o_orderkey").alias("image"))
    rows = t.lineitem.groupBy(F.col("l_orderkey").alias("image")).agg(F.count(F.lit(1)).alias("boxes"))
    present, missing = S.match_inventory(rows, files, ["image"])
    return present.withColumn("present", F.lit(True)).unionByName(missing.withColumn("present", F.lit(False)))


_LINES = """SELECT l_orderkey AS file, l_partkey AS line_no, concat(CASE WHEN l_partkey % 50 = 1 THEN 'one' WHEN l_partkey % 50 = 2 THEN '9' ELSE CAST(l_linenumber AS STRING) END, ' ',
      CASE WHEN l_partkey % 50 = 3 THEN '1.5' ELSE '0.5' END, '  ', CAST(l_discount AS STRING), ' 0.25', CASE WHEN l_partkey % 50 = 4 THEN '' ELSE ' 0.125' END) AS line FROM {lineitem}"""
_PROBLEM = """CASE l_partkey % 50 WHEN 1 THEN 'not_a_number' WHEN 2 THEN 'class_out_of_range' WHEN 3 THEN 'coordinate_out_of_range' WHEN 4 THEN 'column_count' END"""


@query("flt08_label_lines", f"""
    SELECT l_orderkey AS file, l_partkey AS line_no, CASE l_partkey % 50 WHEN 1 THEN NULL WHEN 2 THEN 9 ELSE l_linenumber END AS class_id, {_PROBLEM} AS problem FROM {{lineitem}}""")
def flt08(t: Tables):
    return S.parse_label_lines(t.sql(_LINES), 8).select("file", "line_no", "class_id", "problem")


@query("flt08_label_report", f"""
    SELECT file, min(line_no) AS line_no, arg_min(problem, line_no) AS problem FROM (
      SELECT l_orderkey AS file, l_partkey AS line_no, {_PROBLEM} AS problem FROM {{lineitem}}) WHERE problem IS NOT NULL GROUP BY file""")
def flt08_report(t: Tables):
    return S.label_report(S.parse_label_lines(t.sql(_LINES), 8))


@query("s06_first_problems", f"""
    SELECT problem, file, line_no FROM (SELECT *, row_number() OVER (PARTITION BY problem ORDER BY file) AS k FROM (
      SELECT file, min(line_no) AS line_no, arg_min(problem, line_no) AS problem FROM (
      SELECT l_orderkey AS file, l_partkey AS line_no, {_PROBLEM} AS problem FROM {{lineitem}}) WHERE problem IS NOT NULL GROUP BY file)) WHERE k <= 50""")
def s06(t: Tables):
    report = S.label_report(S.parse_label_lines(t.sql(_LINES), 8))
    return B.first_per_group(report, ["problem"], [("file", "asc")], 50).select("problem", "file", "line_no")


@query("src08_label_files", """
    SELECT o_orderkey AS image, CAST(0 AS BIGINT) AS page, coalesce(string_agg(format('{:d} {:.8f} {:.8f} {:.8f} {:.8f}', class_id, (x1 + (x2 - x1) / 2) / 1000,
      (y1 + (y2 - y1) / 2) / 700, (x2 - x1) / 1000, (y2 - y1) / 700), chr(10) ORDER BY box_id), '') AS body
    FROM {orders} LEFT JOIN {boxes} ON o_orderkey = image GROUP BY o_orderkey""")
def src08(t: Tables):
    images = t.orders.select(F.col("o_orderkey").alias("image"))
    return S.label_text(images, B.normalize_boxes(t.boxes), "image", [("box_id", "asc")])
