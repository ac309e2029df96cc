"""Hand-made cases for the decisions that SQL on the given tables does not pin."""

import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from pilotlamp.functions import images, text
from pilotlamp.operators import boxes as B
from pilotlamp.operators import catalog as C
from pilotlamp.operators import corpus as D
from pilotlamp.operators import frames as V
from pilotlamp.operators import judge
from pilotlamp.operators import splits as S
from pilotlamp.plans.registry import Tables


def one(spark, column, **values):
    row = spark.range(1).select(*[F.lit(v).alias(k) for k, v in values.items()])
    return row.select(column.alias("out")).first()["out"]


def test_text_quirks(spark):
    c = F.col
    assert one(spark, text.clean_text(c("s")), s=" a 　b\n c ") == "a b c"
    assert one(spark, text.severity_of(c("m"), F.lit("on")), m="次要告警") == "critical"
    assert one(spark, text.severity_of(c("m"), F.lit("on"), True), m="次要告警") == "warning"
    assert one(spark, text.severity_of(c("m"), F.lit("off")), m="无供电") == "critical"
    assert one(spark, text.semantic_key(c("n"), F.lit("")), n="PALM 功率管理告警指示灯") == "ALM"
    assert one(spark, text.semantic_key(c("n"), F.lit("")), n="Fan  tray") == "RAW:FANTRAY"
    assert one(spark, text.json_object(c("s")), s='<think>{}</think>```json\n{"a": 1}\n```') == '{"a": 1}'
    assert one(spark, text.json_array(c("s")), s='x {"a": 1} y') == '[{"a": 1}]'
    assert one(spark, text.json_object(c("s")), s="nothing") is None
    assert one(spark, text.natural_key(c("a")) < text.natural_key(c("b")), a="photo_2.png", b="photo_10.png")
    assert one(spark, text.video_group(c("f")), f="video_0017__dev__video_002__t1.png") == "video::video_002"
    assert one(spark, text.label_key(c("s")), s="ＲＵＮ / act") == "RUNACT"


def test_gate_never_alarms_without_a_rule(spark):
    v = spark.createDataFrame([(i, c, s) for i, (c, s) in enumerate(
        [(True, "critical"), (False, "critical"), (False, "normal"), (False, "unknown"), (False, "warning")])],
        "request_id int, complete boolean, severity string").select(
        "request_id", F.lit(1).alias("resolved"), F.lit(0).alias("unresolved"), "complete",
        judge.status_of(F.col("severity")).alias("status"), "severity", F.col("severity").isin("warning", "critical").alias("alarm"))
    a = v.select("request_id", F.when(F.col("request_id") == 3, '{"status": "fault", "alarm": true}').otherwise(
        '{"status": "normal", "severity": "normal", "needs_review": false}').alias("content"))
    out = {r.request_id: (r.status, r.alarm, r.decision_source, r.needs_review) for r in judge.gate(v, judge.read_answers(a)).collect()}
    assert out == {0: ("fault", True, "deterministic_rule", False), 1: ("fault", True, "deterministic_rule+llm_rag", False),
                   2: ("normal", False, "llm_rag", False), 3: ("uncertain", False, "llm_rag_candidate", True),
                   4: ("warning", True, "deterministic_rule+llm_rag", False)}


def test_explode_requests_defaults(spark):
    df = spark.createDataFrame([("r", " d ", [("RUN", None, None, None), None, ("", "red", "on", 0.2)])],
                               judge.REQUEST)
    rows = judge.validate(judge.explode_requests(df)).orderBy("index").collect()
    assert [(r.color, r.confidence, r.drop_reason) for r in rows] == [
        ("unknown", 1.0, None), ("unknown", 1.0, "observation_not_object"), ("red", 0.2, "missing_indicator")]


def test_near_duplicates(spark):
    def rows(*specs):
        return spark.createDataFrame([("d", 1, i, float(i), c, h, [1.0, 0.0, 2.0], 28.0) for i, (c, h) in enumerate(specs)],
                                     "device string, video_idx int, frame_idx int, time_sec double, clarity double, dhash long, hist array<double>, limit double")

    out = V.drop_near_duplicates(rows((100.0, 0), (117.0, 0), (119.0, 0), (10.0, 0), (100.0, -1)), "limit")
    reasons = [r.reject_reason for r in out.orderBy("frame_idx").collect()]
    assert reasons == ["replaced_by_clearer@2.00s", "duplicate@0.00s", None, "blur<28.0", None]
    # a repeat of the 9th frame back is out of sight and kept
    far = [(100.0, 0)] + [(100.0, (0xFF << (8 * (i % 7))) ^ (0x0F0F << i)) for i in range(1, 9)] + [(100.0, 0)]
    last = V.drop_near_duplicates(rows(*far), "limit", max_hamming=0).orderBy(F.desc("frame_idx")).first()
    assert last.reject_reason is None
    chunked = V.drop_near_duplicates(rows(*far), "limit", chunk_rows=3).orderBy("frame_idx").collect()
    whole = V.drop_near_duplicates(rows(*far), "limit").orderBy("frame_idx").collect()
    assert [r.reject_reason for r in chunked] == [r.reject_reason for r in whole]


def test_tracks(spark):
    def box(pos, idx, x, name):
        return ("d", "video_1", pos, idx, name, x, 0.0, x + 20, 20.0, 1000, 700)

    data = [box(0, 0, 0.0, "a"), box(3, 0, 1.0, "b"), box(7, 0, 1.0, "c"), box(7, 1, 2.0, "c2"), box(8, 0, 500.0, "z")]
    df = spark.createDataFrame(data, "device string, track_group string, frame_pos long, ann_idx int, box_id string, x1 double, y1 double, x2 double, y2 double, width int, height int")
    want = {"a": "a", "b": "a", "c": "c", "c2": "c", "z": "z"}
    for chunk in (100, 2):
        assert {r.box_id: r.track for r in B.track_boxes(df, chunk).collect()} == want


def test_track_votes_do_not_depend_on_float_noise(spark):
    """Exactly equal weights go to the class seen first, exactly ``lead`` times the next is enough; float sums missed both."""
    def rows(track, first, second):
        return [("d", "v", track, i, c, float(x)) for c, xs in ((1, first), (2, second)) for i, x in enumerate(xs, c * 10)]

    data = rows(1, (1, 13), (2, 12)) + rows(2, (40, 57), (3, 17))
    df = spark.createDataFrame(data, "device string, track_group string, track int, ann_order int, class_id int, class_score double")
    got = {r.track: (r.members, r.winner, r.stable) for r in B.track_classes(df).collect()}
    assert got == {1: (4, 1, False), 2: (4, 1, True)}


def reference_chunks(body, size=700, overlap=120):
    """The chunk rule written as plain loops."""
    packed, current = [], ""
    for p in [x.strip() for x in re.split(r"\n+", body.strip()) if x.strip()]:
        if len(current) + len(p) + 1 <= size:
            current = (current + "\n" + p).strip()
        else:
            packed += [current] if current else []
            current = p
    packed += [current] if current else []
    out = []
    for c in packed:
        at = 0
        while len(c) > size:
            out.append(c[at:at + size].strip())
            if at + size >= len(c):
                break
            at += size - overlap
        else:
            out.append(c)
    return [c for c in out if c]


def test_chunks(spark):
    cases = ["a" * 699, "a" * 700, "a" * 701, "a" * 1500, "b" * 300 + "\n\n" + "c" * 400 + "\n" + "d" * 10, "", " \n ", "x\ny"]
    df = spark.createDataFrame([(i, c) for i, c in enumerate(cases)], "i int, body string")
    for r in df.select("i", D.chunks(F.col("body")).alias("c")).collect():
        assert list(r.c) == reference_chunks(cases[r.i])


def test_evidence_windows(spark):
    from pilotlamp import vocab
    body = ("RUN lamp" + "x" * 50 + "告警灯 steady\n\n\n\nalarm " + "y" * 70) * 4
    points = set()
    for w in vocab.EVIDENCE_WORDS:
        points |= {m.start() for m in re.finditer(re.escape(w.lower()), body.lower())}
    want = []
    for i in sorted(points):
        c = re.sub(r"\n{3,}", "\n\n", body[max(0, i - 30):i + 30]).strip()
        if c and c not in want:
            want.append(c)
    assert list(one(spark, D.evidence_windows(F.col("b"), 30), b=body)) == want


def test_image_metrics(spark):
    g = np.arange(80, dtype=float).reshape(8, 10) ** 1.5 % 255
    df = spark.createDataFrame([(g.ravel().tolist(),)], "px array<double>")
    m = df.select(images.sharpness("px", F.lit(10), F.lit(8)).alias("m")).first()["m"]
    assert m["brightness"] == pytest.approx(g.mean()) and m["contrast"] == pytest.approx(g.std())
    thumb = g[:, :9]
    bits = (thumb[:, 1:] > thumb[:, :-1]).ravel()
    want = int("".join("1" if b else "0" for b in bits), 2)
    got = spark.createDataFrame([(thumb.ravel().tolist(),)], "px array<double>").select(images.difference_hash(F.col("px"))).first()[0]
    assert got & 0xFFFFFFFFFFFFFFFF == want


def test_label_checks(spark):
    df = spark.createDataFrame([("f", 1, "0 .5 .5 .1 .1"), ("f", 2, "1 2 3 4"), ("f", 3, "x y z w v"), ("g", 1, "8 0 0 0 0"),
                                ("h", 1, "1 1.0001 0 0 0"), ("i", 1, "1.0 0 0 0 0")], "file string, line_no int, line string")
    report = S.label_report(S.parse_label_lines(df, 8))
    assert {(r.file, r.line_no, r.problem) for r in report.collect()} == {
        ("f", 2, "column_count"), ("g", 1, "class_out_of_range"), ("h", 1, "coordinate_out_of_range"), ("i", 1, "not_a_number")}
    with pytest.raises(ValueError):
        S.require_clean(report)
    with pytest.raises(ValueError):
        S.check_ratios(0.9, 0.1)


def test_merge_states(spark):
    df = spark.createDataFrame([("d", "RUN lamp", "RUN", "m", 1, [("on", "ok")]), ("d", "RUN status lamp", "run", "M", 2, [("on", "ok"), ("off", "bad")]),
                                ("d", "闪烁", "", "", 3, None)],
                               "device string, name string, short_label string, module string, ordinal int, states array<struct<state:string,meaning:string>>")
    r = C.merge_candidates(df).collect()
    assert len(r) == 1 and r[0].name == "RUN status lamp" and [tuple(s) for s in r[0].states] == [("on", "ok"), ("off", "bad")]


def test_parts_of_a_manifest_agree_on_their_header(spark, tmp_path):
    from pilotlamp.sources import tables
    (tmp_path / "a.csv").write_text("\ufeffdevice,note\nd1,x\n", encoding="utf-8")
    (tmp_path / "b.csv").write_text("\ufeffdevice,note\nd2,y\n", encoding="utf-8")
    read = lambda: sorted(map(tuple, tables.read_manifest(spark, str(tmp_path), ["note", "device"]).collect()))
    assert read() == [("x", "d1"), ("y", "d2")]
    (tmp_path / "c.csv").write_text("\ufeffnote,device\nz,d3\n", encoding="utf-8")
    with pytest.raises(Exception, match="header"):
        read()


def test_sources(spark, tmp_path):
    from pilotlamp.sources import assets, tables
    (tmp_path / "m.csv").write_text("﻿device,note\nd1,\nd2,x\n", encoding="utf-8")
    rows = tables.read_manifest(spark, str(tmp_path / "m.csv"), ["device", "note"]).collect()
    assert [tuple(r) for r in rows] == [("d1", ""), ("d2", "x")]
    (tmp_path / "n.csv").write_text('note,device\n"two\nlines",d1\n', encoding="utf-8")
    assert [tuple(r) for r in tables.read_manifest(spark, str(tmp_path / "n.csv"), ["device", "note"]).collect()] == [("d1", "two\nlines")]
    df = spark.createDataFrame([("d", ["a", "b"])], "device string, tags array<string>")
    tables.write_manifest(df, str(tmp_path / "out"))
    assert all(p.read_bytes().startswith(b"\xef\xbb\xbfdevice") for p in (tmp_path / "out").glob("part-*.csv"))
    assert [tuple(r) for r in tables.read_manifest(spark, str(tmp_path / "out"), ["tags", "device"]).collect()] == [("a | b", "d")]
    odd = spark.createDataFrame([("file:/r.o(o)t+x/dev/images/a.png",)], "path string")
    assert [r.device for r in assets.describe_paths(odd, "file:/r.o(o)t+x").collect()] == ["dev"]
    (tmp_path / "labels").mkdir()
    (tmp_path / "labels" / "a.txt").write_text("0 .1 .2 .3 .4\n\n1 1 1 1 1\n")
    (tmp_path / "labels" / "b.txt").write_text("")
    lines = tables.read_label_files(spark, str(tmp_path / "labels")).orderBy("line_no").collect()
    assert [(r.file, r.line_no, r.line) for r in lines] == [("a.txt", 1, "0 .1 .2 .3 .4"), ("a.txt", 2, ""), ("a.txt", 3, "1 1 1 1 1")]
    (tmp_path / "p.json").write_text('{"request_id": "1", "device": "d", "observations": []}\n{broken\n')
    payloads = tables.read_payloads(spark, str(tmp_path / "p.json")).collect()
    assert [r.request_id for r in payloads if r._corrupt_record is None] == ["1"] and len(payloads) == 2
    for f in ("dev/图片/a.JPG", "dev/视频/v.mp4", "dev/x/b.png", "dev/manuals/m.txt"):
        (tmp_path / "root" / f).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / "root" / f).write_text("x")
    files = assets.read_inventory(spark, str(tmp_path / "root"))
    assert [tuple(r) for r in assets.inventory_by_device(files).collect()] == [("dev", 1, 1, 1)]
    assert assets.corpus_sources(files).select("source_type").collect()[0][0] == "manual"


def test_plans_have_no_cross_join_and_no_python(spark):
    t = Tables(spark, "/root/testdata/sf0.001")
    from pilotlamp.plans import load_all
    from pilotlamp.plans.registry import QUERIES
    load_all()
    for name in ("a01_inspection_verdicts", "flt16_alarm_gate", "w04_running_vote", "w13_suppress_by_score", "j16_best_near_anchor",
                 "j14_template_votes", "w15_document_chunks"):
        plan = QUERIES[name].build(t)._jdf.queryExecution().executedPlan().toString()
        assert "CartesianProduct" not in plan and "Python" not in plan and "NestedLoop" not in plan, name


def test_observation_without_device_stays(spark):
    rules = spark.createDataFrame([("d", "RUN", "green", "on", "ok", "normal", 1, "r")],
                                  "device string, indicator string, color string, state string, meaning string, severity string, ordinal int, rule_source string")
    seen = spark.createDataFrame([("q1", 1, None, "RUN", "green", "on"), ("q1", 2, "d", "RUN", "green", "on")],
                                 "request_id string, obs_id int, device string, indicator string, color string, state string")
    got = {r.obs_id: (r.reason, r.severity) for r in judge.match_observations(seen, rules).collect()}
    assert got == {1: ("device_not_found_in_rules", None), 2: (None, "normal")}


def test_failing_model_is_reported(spark):
    verdicts = spark.createDataFrame([("q1", False), ("q2", False)], "request_id string, complete boolean")
    questions = spark.createDataFrame([("q1", "ok"), ("q2", "bad")], "request_id string, question string")

    def client():
        def ask(question):
            if question == "bad":
                raise TimeoutError("no answer")
            return "{}"
        return ask

    got = {r.request_id: (r.content, r.error) for r in judge.ask_model(verdicts, questions, client).collect()}
    assert got == {"q1": ("{}", None), "q2": ("", "TimeoutError: no answer")}


def test_open_questions_need_no_second_match(spark):
    """Questions are asked without verdicts, the same as with them."""
    matched = spark.createDataFrame([("q1", 1, "d", "no_exact_rule", None), ("q1", 2, "d", None, "normal"), ("q2", 3, "d", None, "normal"), (None, 4, "d", "no_exact_rule", None)],
                                    "request_id string, obs_id int, device string, reason string, severity string")
    matched = matched.selectExpr("*", "'RUN' AS indicator", "'red' AS color", "'on' AS state")
    questions = judge.question_text(matched)
    asked = [judge.ask_model(v, questions, lambda: lambda q: '{"status": "normal"}') for v in (None, judge.roll_up(matched))]
    assert [[r.request_id for r in a.collect()] for a in asked] == [["q1"], ["q1"]]
    read = judge.read_answers(asked[0])
    assert [(r.model_status, r.model_review) for r in read.collect()] == [("normal", True)]


def test_whole_requests(spark):
    """Alias tier, rule tier, unresolved, rule name gone, wrong indicator, and all ways to fail."""
    from pilotlamp.operators import requests
    rules = spark.createDataFrame([("Rectifier A", "RUN lamp", "green", "steady", "normal", "works", 1), ("Rectifier A", "ALM lamp", "red", "steady", "critical", "broken", 2),
                                   ("Cooling unit", "RUN lamp", "green", "steady", "warning", "hot", 3)],
                                  "device string, indicator string, color string, state string, severity string, meaning string, ordinal int")
    aliases = spark.createDataFrame([("1", "Rectifier", "Rectifier A", ["power cabinet"], [], True, 1), ("2", "Ghost", "Gone", ["phantom"], [], False, 2)],
                                    "device_id string, canonical_name string, rule_name string, aliases array<string>, workspace_names array<string>, verified boolean, ordinal int")
    run, alm = ("RUN lamp", "green", "steady", 0.9), ("ALM lamp", "red", "steady", None)
    cases = {
        "alias": ("power cabinet", [run, alm]), "rule": ("cooling unit", [run]), "ghost": ("phantom", [run]), "none": ("qqqqqqq", [run]), "lamp": ("power cabinet", [("ZZZZ 9", "green", "steady", 1.0)]),
        "no_device": (None, [run]), "blank": (" ", [run]), "no_list": ("power cabinet", None), "empty": ("power cabinet", []), "rejected": ("power cabinet", [("", "green", "steady", 1.0), ("RUN lamp", "green", "steady", 0.1)]),
        "some": ("power cabinet", [run, ("RUN lamp", "green", "steady", 0.1)]),
    }
    df = spark.createDataFrame([(k, *v) for k, v in cases.items()], "request_id string, device string, observations array<struct<indicator:string,color:string,state:string,confidence:double>>")
    got = {r.request_id: r for r in requests.judge_requests(df, aliases, rules).collect()}
    assert len(got) == len(cases)
    assert {k: (r.status, r.alarm, r.error) for k, r in got.items()} == {
        "alias": ("fault", True, None), "rule": ("warning", True, None), "ghost": ("uncertain", False, None), "none": ("uncertain", False, None), "lamp": ("uncertain", False, None),
        "no_device": ("error", False, "missing_device"), "blank": ("error", False, "missing_device"), "no_list": ("error", False, "missing_observations"),
        "empty": ("error", False, "missing_observations"), "rejected": ("error", False, "no_valid_observations"), "some": ("normal", False, None)}
    assert got["ghost"].reasons == ["resolved_rule_name_not_found"] and got["none"].reasons == ["device_not_found_in_rules"] and got["lamp"].reasons == ["indicator_not_found_in_rules"]
    assert got["alias"].reasons == ["RUN lamp：green steady -> works (normal, source=base)", "ALM lamp：red steady -> broken (critical, source=base)"]
    assert got["rejected"].dropped == ["0:missing_indicator", "1:low_confidence"] and got["some"].dropped == ["1:low_confidence"]
    odd = rules.withColumn("color", F.lit("teal glow 红")).limit(1)
    assert [(r.kind, r.word) for r in requests.vocabulary_gaps(odd).collect()] == [("color", "teal glow 红")]


def test_label_files_are_text(spark, tmp_path):
    from pilotlamp.sources import tables
    rows = [("train", "a", 1, "1 .5 .5 .1 .1"), ("train", "a", 0, "0 .5 .5 .1 .1\n0 .2 .2 .1 .1"), ("val", "b", 0, "")]
    tables.write_labels(spark.createDataFrame(rows, "split string, image string, page int, body string"), str(tmp_path / "labels"))
    body = "".join(p.read_text() for p in (tmp_path / "labels" / "split=train" / "image=a").glob("*.txt"))
    assert body == "0 .5 .5 .1 .1\n0 .2 .2 .1 .1\n1 .5 .5 .1 .1\n" and list((tmp_path / "labels" / "split=val" / "image=b").glob("*.txt"))


def test_retrieval_without_equal_texts(spark):
    items = spark.createDataFrame([(1, "_GLOBAL_", [1.0, 0.0], "f", "t"), (2, "_GLOBAL_", [1.0, 0.1], "f", "t"), (3, "_GLOBAL_", [0.0, 1.0], "g", "t")],
                                  "item_id long, device_name string, vector array<double>, file string, body string")
    asked = spark.createDataFrame([(7, "d", False, [1.0, 0.0])], "query_id long, device_name string, verified boolean, vector array<double>")
    assert [r.item_id for r in D.retrieve(asked, items, 3, same=["file", "body"]).orderBy("place").collect()] == [1, 3]
    assert [r.item_id for r in D.retrieve(asked, items, 3).orderBy("place").collect()] == [1, 2, 3]


def test_catalogue_modes(spark):
    df = spark.createDataFrame([("d", "RUN lamp", "", "M1", "front", "p1", 1), ("d", "RUN", "", "M2", "rear", "p2", 2), ("d", "RUN", "", "M2", "rear", "p3", 3)],
                               "device string, name string, short_label string, module string, location_hint string, evidence string, ordinal int")
    assert [C.deduplicate(df, m).count() for m in ("semantic", "strict", "none")] == [1, 2, 3]
    merged = C.deduplicate(df)
    row = merged.first()
    assert row.location_hints == ["front", "rear"] and row.evidences == ["p1", "p2", "p3"] and row.modules == ["M1", "M2"]
    assert [(r.device, r.merged) for r in C.merge_report(merged).collect()] == [("d", 3)]
