"""Conflict records, nested result documents and united states on rows with NULL keys, copies and empty tables."""

import json
import random

from pyspark.sql import functions as F

from pilotlamp.operators import boxes as B
from pilotlamp.operators import catalog as C

RNG = random.Random(7)
BOX = "image int, box_id string, x1 double, y1 double, x2 double, y2 double, class_id int, score double"
ORDER = [("score", "desc"), ("box_id", "asc")]


def iou(a, b):
    w, h = min(a[2], b[2]) - max(a[0], b[0]), min(a[3], b[3]) - max(a[1], b[1])
    cut = max(w, 0) * max(h, 0)
    return cut / ((a[2] - a[0]) * (a[3] - a[1]) + (b[2] - b[0]) * (b[3] - b[1]) - cut)


def away(a, b):
    return (((a[0] + a[2] - b[0] - b[2]) / 2) ** 2 + ((a[1] + a[3] - b[1] - b[3]) / 2) ** 2) ** 0.5


def clash(a, b, limit, ratio):
    side = lambda x: max(x[2] - x[0], x[3] - x[1])
    return iou(a, b) >= limit or (ratio > 0 and away(a, b) <= max(1.0, (side(a) + side(b)) / 2) * ratio)


def records(data, limit, ratio):
    """Box, its first kept rival, overlap and distance, walked one by one."""
    kept, out = {}, []
    for image, name, *rest in sorted(data, key=lambda r: (-r[7], r[1])):
        box, mine = rest[:4], kept.setdefault(image, [])
        rival = next((k for k in mine if clash(box, k[1], limit, ratio)), None)
        if rival is None:
            mine.append((name, box))
        else:
            out.append((str(image), name, rival[0], round(iou(box, rival[1]), 6), round(away(box, rival[1]), 6)))
    return sorted(out)


def test_conflict_record_equals_a_walk(spark):
    data = []
    for image in (None, 1, 2):
        for i in range(90):
            side = RNG.choice((1, 4, 20, 20, 60, 300))
            x, y = RNG.randrange(-40, 90), RNG.randrange(-40, 90)
            data.append((image, f"b{i:03d}", *map(float, (x, y, x + RNG.randrange(1, side + 1), y + RNG.randrange(1, side + 1))), i % 3, RNG.randrange(9) / 10))
    df = spark.createDataFrame(data, BOX)
    for limit, ratio, conflict in ((0.3, 0.0, B.overlap_conflict(0.3)), (0.35, 0.65, B.near_conflict()), (0.5, 1.5, B.near_conflict(0.5, 1.5))):
        want = records(data, limit, ratio)
        decided = B.suppress(df, ["image"], ORDER, conflict, ratio)
        got = B.conflict_record(decided, ["image"], ORDER, conflict, ["box_id"], ratio).collect()
        assert sorted((str(r.image), r.box_id, r.kept_box_id, round(r.iou, 6), round(r.center_distance, 6)) for r in got) == want
        assert want


def test_conflict_record_of_copies_and_of_nothing(spark):
    box = (0.0, 0.0, 10.0, 10.0, 1, 0.5)
    df = spark.createDataFrame([(None, "a", *box)] * 4 + [(1, "c", 0.0, 0.0, 9.0, 10.0, 1, 0.9)], BOX)
    conflict = B.overlap_conflict(0.5)
    got = B.conflict_record(B.suppress(df, ["image"], ORDER, conflict), ["image"], ORDER, conflict, ["box_id", "score"])
    assert [(r.image, r.box_id, r.kept_box_id, r.kept_score, r.iou, r.center_distance) for r in got.collect()] == [(None, "a", "a", 0.5, 1.0, 0.0)] * 3
    none = df.limit(0)
    assert B.conflict_record(B.suppress(none, ["image"], ORDER, conflict), ["image"], ORDER, conflict, ["score"]).count() == 0


def exported(spark, page_rows):
    images = spark.createDataFrame([("d", "b.png"), ("d", "a.png"), ("d", "a.png"), ("d", "empty.png"), (None, "x.png"), ("bare", None)], "device string, image string")
    found = spark.createDataFrame(
        [("d", "a.png", 3, i, 0.5) for i in range(5)] + [("d", "b.png", None, 9, None), ("d", "new.png", 1, 1, 0.1), (None, "x.png", 2, 7, 0.2)],
        "device string, image string, class_id int, at int, score double")
    classes = spark.createDataFrame([("d", 3, 'red "A"', "A", 0), ("d", 1, None, "B", 1), ("d", 3, "red B", None, 2), ("d", None, "lost", "L", 3), (None, 2, "n", "N", 0)],
                                    "device string, class_id int, name string, short_label string, ordinal int")
    stats = spark.createDataFrame([("d", 8, 7)], "device string, raw long, kept long")
    rows = B.export_documents(images, found, classes, stats, [("at", "desc")], ["class_id", "at"], page_rows=page_rows).collect()
    assert len({(r.device, r.page) for r in rows}) == len(rows)
    return {(r.device, r.page): json.loads(r.document) for r in rows}


def test_nested_document(spark):
    docs = exported(spark, 1000)
    assert set(docs) == {("d", 0), (None, 0), ("bare", 0)}
    d = docs["d", 0]
    assert d["annotations"] == {"a.png": [{"class_id": 3, "at": i} for i in (4, 3, 2, 1, 0)], "b.png": [{"at": 9}], "empty.png": [],
                                "new.png": [{"class_id": 1, "at": 1}]}
    assert list(d["annotations"]) == ["a.png", "b.png", "empty.png", "new.png"]
    assert d["class_order"] == [3, 1, 3] and d["names"] == {"1": "", "3": "red B"} and d["meta"] == {"raw": 8, "kept": 7}
    assert d["schema_classes"] == [{"order": 0, "class_id": 3, "name": 'red "A"', "short_label": "A"}, {"order": 1, "class_id": 1, "name": "", "short_label": "B"},
                                   {"order": 2, "class_id": 3, "name": "red B", "short_label": ""}]
    assert docs[None, 0]["names"] == {"2": "n"} and "device_name" not in docs[None, 0] and docs["bare", 0]["annotations"] == {"": []}


def test_pages_of_a_document_unite_to_the_whole(spark):
    whole, paged = exported(spark, 1000)["d", 0], exported(spark, 2)
    pages = [paged["d", i] for i in range(4)]
    assert all(sum(max(1, len(v)) for v in p["annotations"].values()) == 2 for p in pages)
    united = {}
    for p in pages:
        for name, boxes in p["annotations"].items():
            united.setdefault(name, []).extend(boxes)
    assert united == whole["annotations"] and pages[0]["meta"] == whole["meta"] and "meta" not in pages[1] and "names" not in pages[1]


def test_documents_of_empty_tables(spark):
    def none(kind):
        return spark.createDataFrame([], kind)

    args = none("device string, class_id int, name string, short_label string, ordinal int"), none("device string, raw long"), [("at", "asc")], ["class_id", "at"]
    found = none("device string, image string, class_id int, at int")
    assert B.export_documents(none("device string, image string"), found, *args).count() == 0
    docs = B.export_documents(spark.createDataFrame([("d", "a.png")], "device string, image string"), found, *args).collect()
    assert json.loads(docs[0].document)["annotations"] == {"a.png": []}


ITEM = "device string, name string, short_label string, module string, ordinal int, states array<struct<state:string,meaning:string>>"


def test_deduplicate_unites_states(spark):
    data = [("d", "PWR lamp", "PWR", "m", 2, [("off", "dark"), ("on", "ok")]), ("d", "PWR", "", "m", 1, [("on", "ok"), None, ("on", None), ("on", "ok")]),
            ("d", "zzz", "", "m", 3, None), ("d", "yyy", "", "m", 4, [])]
    got = {r["name"]: r.states and [tuple(s) for s in r.states] for r in C.deduplicate(spark.createDataFrame(data, ITEM)).collect()}
    power = next(v for k, v in got.items() if "PWR" in k)
    assert power == [("on", "ok"), ("on", None), ("off", "dark")] and got["zzz"] is None and got["yyy"] is None


def test_second_merge_finds_nothing(spark):
    """Merging the merged entries again by label and module leaves them as they are."""
    words = ("RUN", "run", "RUN灯", "AL-M", "ALM", "灯", "指示灯", "status", "lamp")
    labels = ("", None, "-", "run", "R-UN", "ALM", "a l m")
    data = [("d", " ".join(RNG.choice(words) for _ in range(RNG.randrange(1, 4))), RNG.choice(labels), RNG.choice(("m", "M", "m-", "", None)), i, None)
            for i in range(400)]
    once = C.merge_candidates(spark.createDataFrame(data, ITEM))
    again = C.merge_candidates(once.select("device", "name", "short_label", "module", "ordinal", "location_hint", "evidence", "states"))
    cols = ["name", "short_label", "module", "ordinal"]
    assert sorted(map(tuple, once.select(*cols).collect())) == sorted(map(tuple, again.select(*cols).collect()))
    assert 1 < once.count() < 400 and again.agg(F.max("merged")).first()[0] == 1
