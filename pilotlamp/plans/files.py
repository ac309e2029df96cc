"""Queries: given tables written as files and read back by the library's readers."""

from pyspark.sql import functions as F

from pilotlamp.operators import ordered, splits
from pilotlamp.plans.registry import Tables, query
from pilotlamp.session import new_folder
from pilotlamp.sources import tables as files


@query("src03_manifest_round_trip", """
    SELECT CAST(p_partkey AS VARCHAR) AS part, p_brand AS device, CASE WHEN p_partkey % 5 = 0 THEN '' ELSE concat('  "', p_name, '", ', chr(92), chr(10), p_type, ' ') END
      AS note, concat(p_brand, ' | ', p_type) AS tags FROM {part}""")
def src03_round_trip(t: Tables):
    note = F.concat(F.lit('  "'), "p_name", F.lit('", \\\n'), "p_type", F.lit(" "))
    rows = t.part.select(F.col("p_partkey").cast("string").alias("part"), F.col("p_brand").alias("device"),
                         F.when(F.col("p_partkey") % 5 != 0, note).alias("note"), F.array("p_brand", "p_type").alias("tags"))
    path = new_folder(t.spark, "manifest")
    files.write_manifest(rows, path)
    return files.read_manifest(t.spark, path, ["tags", "note", "device", "part"])


@query("src15_manifest_by_device", "SELECT p_brand AS device, p_partkey AS part, p_name AS name FROM {part}")
def src15_by_device(t: Tables):
    rows = t.part.select(F.col("p_partkey").alias("part"), F.col("p_name").alias("name"), F.col("p_brand").alias("device"))
    path = new_folder(t.spark, "manifest")
    files.write_manifest(rows, path, ["device"])
    back = files.read_manifest(t.spark, path, ["part", "name", "device"])
    return back.select("device", F.col("part").cast("long").alias("part"), "name")


@query("src07_label_lines", """
    SELECT row_number() OVER (PARTITION BY l_suppkey ORDER BY l_orderkey, l_linenumber, l_partkey) AS line_no,
      concat(l_linenumber, ' ', l_orderkey, ' ', l_partkey, ' ', l_suppkey) AS line FROM {lineitem}""")
def src07_lines(t: Tables):
    line = F.concat_ws(" ", "l_linenumber", "l_orderkey", "l_partkey", "l_suppkey")
    order = [(c, "asc") for c in ("l_orderkey", "l_linenumber", "l_partkey")]
    rows = t.lineitem.select("l_suppkey", "l_orderkey", "l_linenumber", "l_partkey", line.alias("line"))
    listed = ordered.pages(rows, ["l_suppkey"], order, F.col("line"), "items")
    bodies = listed.select(F.lit("train").alias("split"), F.col("l_suppkey").alias("image"), "page", F.array_join("items", "\n").alias("body"))
    path = new_folder(t.spark, "labels")
    files.write_labels(bodies, path)
    return files.read_label_files(t.spark, path).select(F.col("line_no").cast("long").alias("line_no"), "line")


_PAYLOAD = """SELECT concat(chr(123), '"request_id": "r', CAST(o_orderkey AS STRING), '", "device": "', o_orderpriority, '", "observations": [', chr(123),
    '"indicator": "RUN", "color": "', o_orderstatus, '"', CASE WHEN o_orderkey % 7 = 0 THEN '' ELSE concat(chr(125), ']', chr(125)) END) AS line FROM {orders}"""


@query("src12_payload_lines", """
    SELECT CASE WHEN o_orderkey % 7 > 0 THEN concat('r', o_orderkey) END AS request_id, CASE WHEN o_orderkey % 7 > 0 THEN o_orderpriority END AS device,
      CASE WHEN o_orderkey % 7 > 0 THEN o_orderstatus END AS color, CASE WHEN o_orderkey % 7 = 0 THEN concat(chr(123), '"request_id": "r', o_orderkey,
        '", "device": "', o_orderpriority, '", "observations": [', chr(123), '"indicator": "RUN", "color": "', o_orderstatus, '"') END AS broken FROM {orders}""")
def src12_payloads(t: Tables):
    path = new_folder(t.spark, "payloads")
    t.sql(_PAYLOAD).write.text(path)
    rows = files.read_payloads(t.spark, path)
    return rows.select("request_id", "device", F.get(F.col("observations"), F.lit(0))["color"].alias("color"),
                       F.col("_corrupt_record").alias("broken"))


@query("flt20_split_ratios", """
    SELECT o_orderkey, o_custkey, train > 0 AND val >= 0 AND train + val < 1 AS accepted
    FROM (SELECT *, (o_orderkey % 12 - 1) / 10e0 AS train, (o_custkey % 6 - 1) / 10e0 AS val FROM {orders})""")
def flt20(t: Tables):
    train, val = (F.col("o_orderkey") % 12 - 1) / F.lit(10.0), (F.col("o_custkey") % 6 - 1) / F.lit(10.0)
    return t.orders.select("o_orderkey", "o_custkey", splits.ratios_ok(train, val).alias("accepted"))
