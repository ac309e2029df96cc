"""Skew paths: with tiny bucket limits every group is large, and results must equal plain windows."""

import pickle
import random

import numpy as np
import pandas as pd
from pyspark.sql import Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pilotlamp.operators import boxes as B
from pilotlamp.functions import text
from pilotlamp.operators import frames, matching, ordered
from pilotlamp.operators import splits as S

RNG = random.Random(7)


def frame(spark, n=400):
    data = [("hot" if RNG.random() < 0.7 else f"k{RNG.randrange(5)}", RNG.randrange(40), i, f"name_{RNG.randrange(90):04d}",
             RNG.choice([None, None, f"v{i}"])) for i in range(n)]
    return spark.createDataFrame(data, "k string, x long, id long, s string, v string").repartition(5)


def same(a, b):
    assert sorted(map(str, a.collect())) == sorted(map(str, b.select(*a.columns).collect()))


def test_rank_in_groups(spark):
    df = frame(spark)
    for order in ([("x", "asc"), ("id", "asc")], [("x", "desc"), ("id", "asc")], [("s", "asc"), ("id", "asc")]):
        want = df.withColumn("rn", F.row_number().over(Window.partitionBy("k").orderBy(*ordered.sort_columns(order))).cast("long"))
        same(ordered.rank_in_groups(df, ["k"], order, bucket_rows=10), want)
    order = [("x", "asc"), ("id", "desc")]
    want = df.withColumn("rn", F.row_number().over(Window.partitionBy("k").orderBy(*ordered.sort_columns(order))).cast("long"))
    same(ordered.rank_in_groups(df, ["k"], order, bucket_rows=5), want)


def test_ranges_stay_short(spark):
    """Outliers, names with a common prefix, one-value columns, NULL keys and NULL order values; at most twice the limit."""
    n, limit = 1000, 50
    cases = {
        "outlier": [(None, 10**12 if i == 0 else i, i) for i in range(n)],
        "ties": [("k", 7, i) for i in range(n)],
        "prefix": [("k", f"same_prefix_{'a' if i == 0 else 'z' if i == 1 else 'm'}{i:025d}", i) for i in range(n)],
        "nulls": [("k" if i % 3 else None, None if i % 2 else i, i) for i in range(n)],
        "equal": [("k", 1, 1) for _ in range(n)],
    }
    for name, rows in cases.items():
        kind = "string" if name == "prefix" else "long"
        df = spark.createDataFrame(rows, f"k string, x {kind}, id long").repartition(4)
        order = [("x", "desc"), ("id", "asc")]
        b, ranges = ordered.bucketize(df, ["k"], order, limit)
        assert ranges > 10 and b.groupBy("k", "_ord_b").count().agg(F.max("count")).first()[0] <= 2 * limit, name
        want = df.withColumn("rn", F.row_number().over(Window.partitionBy("k").orderBy(*ordered.sort_columns(order))).cast("long"))
        same(ordered.rank_in_groups(df, ["k"], order, bucket_rows=limit), want)
    whole = spark.range(500).select((F.col("id") % 5).alias("device"), "id")
    b, _ = ordered.bucketize(whole, [], [("device", "asc"), ("id", "asc")], 20)
    assert b.groupBy("_ord_b").count().agg(F.max("count")).first()[0] <= 40


def test_prefix_sum_and_fill_down(spark):
    df = frame(spark)
    w = Window.partitionBy("k").orderBy("x", "id")
    want = df.withColumn("before", F.coalesce(F.sum("x").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    same(ordered.prefix_sum(df, ["k"], [("x", "asc"), ("id", "asc")], "x", "before", 10), want)
    want = df.withColumn("v", F.last("v", ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    same(ordered.fill_down(df, ["k"], [("x", "asc"), ("id", "asc")], ["v"], 10), want)


def test_trailing_windows_cross_chunks(spark):
    df = frame(spark)
    w = Window.partitionBy("k").orderBy("x", "id").rowsBetween(-7, 0)
    want = df.withColumn("h", F.collect_list("id").over(w))
    got = ordered.trailing(df, ["k"], [("x", "asc"), ("id", "asc")], 8, F.collect_list("id"), "h", chunk_rows=9)
    same(got.drop("rn"), want)


def test_exact_quantiles(spark):
    df = frame(spark)
    want = df.groupBy("k").agg(F.percentile("x", 0.33).alias("q"), F.count("x").alias("n_values"))
    got = ordered.exact_quantiles(df, ["k"], "x", {"q": 0.33})
    assert [(r.k, round(r.q, 6)) for r in got.orderBy("k").collect()] == [(r.k, round(r.q, 6)) for r in want.orderBy("k").collect()]


def test_quantile_positions_are_whole_numbers(spark):
    df = spark.range(1501).select(F.lit(1).alias("k"), F.col("id").cast("double").alias("x"))
    assert 1500 * 0.67 > 1005  # in floats
    assert ordered.exact_quantiles(df, ["k"], "x", {"q": 0.67, "low": 0.335}).first()[:3] == (1, 1005.0, 502.5)


def test_fold_in_chunks_equals_one_pass(spark):
    df = frame(spark)
    schema = T.StructType([T.StructField("k", T.StringType()), T.StructField("id", T.LongType()), T.StructField("seen", T.LongType())])

    def step(last):
        def run(pdf, state):
            kept = pickle.loads(state) if state else []
            out = []
            for i, x in zip(pdf["id"], pdf["x"]):
                out.append(sum(kept))
                kept = (kept + [int(x)])[-last:] if last else [sum(kept) + int(x)]
            return pd.DataFrame({"k": pdf["k"], "id": pdf["id"], "seen": out}), pickle.dumps(kept)
        return run

    order = [("x", "asc"), ("id", "asc")]
    for last, settle in ((3, True), (0, False)):
        whole = ordered.fold_in_order(df, ["k"], order, step(last), schema)
        same(ordered.fold_in_order(df, ["k"], order, step(last), schema, chunk_rows=60, settle=settle), whole)


def test_fold_keeps_null_keys_and_null_order(spark):
    rows = [(None if i % 2 else "k", None if i % 5 == 0 else i % 7, i) for i in range(60)]
    df = spark.createDataFrame(rows, "k string, x long, id long")
    schema = T.StructType([T.StructField("k", T.StringType()), T.StructField("id", T.LongType()), T.StructField("before", T.LongType())])

    def step(pdf, state):
        last = pickle.loads(state) if state else -1
        before = [last, *pdf["id"].tolist()[:-1]]
        return pd.DataFrame({"k": pdf["k"], "id": pdf["id"], "before": before}), pickle.dumps(int(pdf["id"].iloc[-1]))

    for order in ([("x", "asc"), ("id", "asc")], [("x", "desc"), ("id", "desc")]):
        w = Window.partitionBy("k").orderBy(*ordered.sort_columns(order))
        want = df.select("k", "id", F.coalesce(F.lag("id").over(w), F.lit(-1)).alias("before"))
        for limit in (1000, 7):
            same(ordered.fold_in_order(df, ["k"], order, step, schema, chunk_rows=limit), want)


def test_suppression_of_equal_boxes_and_null_images(spark):
    box = (0.0, 0.0, 10.0, 10.0, 1, 0.5)
    rows = [(None, *box)] * 4 + [(1, *box)] * 3 + [(None, 50.0, 50.0, 60.0, 60.0, 1, 0.4), (1, 0.0, 0.0, 9.0, 10.0, 1, 0.9)]
    df = spark.createDataFrame(rows, "image int, x1 double, y1 double, x2 double, y2 double, class_id int, score double")
    order = [("score", "desc"), ("x1", "asc")]
    for limit in (100, 1):
        got = B.suppress(df, ["image"], order, B.overlap_conflict(0.5), fold_boxes=limit)
        assert got.count() == len(rows)
        assert sorted((str(r.image), r.score) for r in got.filter("kept").collect()) == [("1", 0.9), ("None", 0.4), ("None", 0.5)]


def test_natural_key_of_long_numbers(spark):
    names = [f"a_{'9' * 30}{i}.png" for i in (2, 9, 1)] + ["a_10.png", "a_9.png", "a_09.png", "photo_3.png"]
    df = spark.createDataFrame([(n,) for n in names], "f string").orderBy(text.natural_key(F.col("f")))
    assert [r.f for r in df.collect()] == ["photo_3.png", "a_9.png", "a_09.png", "a_10.png"] + [f"a_{'9' * 30}{i}.png" for i in (1, 2, 9)]


def test_striding_picks_follow_the_rule():
    def plain(sizes, target, groups):
        """One pick at a time, as the rule is worded."""
        at, picks = dict.fromkeys(range(len(sizes)), 0), []
        while len(picks) < target and any(at[g] < sizes[g] for g in at):
            for g in [g for g in at if at[g] < sizes[g]]:
                if len(picks) < target:
                    left = max(1, (target - len(picks)) // groups)
                    picks.append((g, at[g]))
                    at[g] = min(sizes[g], at[g] + max(1, (sizes[g] - at[g]) // left))
        free = [(g, p) for g in at for p in range(sizes[g]) if (g, p) not in set(picks)]
        return picks + free[:max(0, target - len(picks))]

    for _ in range(200):
        sizes = [RNG.randrange(1, 30) for _ in range(RNG.randrange(1, 8))]
        target = RNG.randrange(1, 60)
        got = frames._striding_picks(np.array(sizes), target, len(sizes))
        assert got == plain(sizes, target, len(sizes))


def test_suppression_rounds_equal_fold(spark):
    data = [(1, f"b{i:03d}", *[float(v) for v in (x, y, x + RNG.randrange(5, 40), y + RNG.randrange(5, 40))], i % 3, RNG.randrange(9) / 10)
            for i in range(150) for x, y in [(RNG.randrange(80), RNG.randrange(80))]]
    df = spark.createDataFrame(data, "image int, box_id string, x1 double, y1 double, x2 double, y2 double, class_id int, score double")
    order = [("score", "desc"), ("box_id", "asc")]
    for conflict, reach in ((B.overlap_conflict(0.3), 0.0), (B.near_conflict(), 0.65)):
        fold = B.suppress(df, ["image"], order, conflict, reach)
        rounds = B.suppress(df, ["image"], order, conflict, reach, fold_boxes=10)
        same(fold, rounds)
        assert 0 < fold.filter("kept").count() < 150


def test_name_pairs_equal_brute_force(spark):
    names = {"".join(RNG.choice("abcd") for _ in range(RNG.randrange(1, 9))) for _ in range(120)}
    df = spark.createDataFrame([(n,) for n in names], "key string")
    a, b = df.withColumnRenamed("key", "l_key"), df.withColumnRenamed("key", "r_key")
    longest = F.greatest(F.length("l_key"), F.length("r_key"))
    every = a.crossJoin(b)
    for threshold in (62, 72, 90):
        want = every.filter(F.levenshtein("l_key", "r_key") * 100 <= longest * (100 - threshold)).select("l_key", "r_key")
        same(matching.fuzzy_pairs(df, df, "key", threshold).select("l_key", "r_key"), want)
    want = every.filter(F.col("l_key").contains(F.col("r_key")) | F.col("r_key").contains(F.col("l_key")))
    same(matching.contained_pairs(df, df, "key").select("l_key", "r_key"), want)


def test_largest_first_split(spark):
    """Groups dealt by arithmetic go where the loop over groups puts them: equal sizes, few groups, NULL keys."""
    cases = {None: [1] * 40, "one": [7], "two": [2, 9], "even": [5] * 23, "tail": [30, 30] + [1] * 17, "three": [4, 4, 4], "jump": [50, 9, 9, 9, 9, 2, 2, 1]}
    cases |= {f"r{i}": [RNG.randrange(1, RNG.choice([3, 9, 40])) for _ in range(RNG.randrange(1, 60))] for i in range(60)}
    rows = [(d, f"g{g:02d}", i) for d, sizes in cases.items() for g, s in enumerate(sizes) for i in range(s)]
    df = spark.createDataFrame(rows, "device string, grp string, size int")
    for train, val in ((0.7, 0.15), (0.34, 0.33)):
        goal = {n: r.t for n, r in ((r.n, r) for r in spark.createDataFrame([(n,) for n in {sum(s) for s in cases.values()}], "n long").select(
            "n", S.target_counts(F.col("n"), train, val).alias("t")).collect())}
        want = {}
        for device, sizes in cases.items():
            counts = [0, 0, 0]
            for i, (s, g) in enumerate(sorted(((s, g) for g, s in enumerate(sizes)), key=lambda x: (-x[0], x[1]))):
                lack = [t - c for t, c in zip(goal[sum(sizes)], counts)]
                j = i if len(sizes) >= 3 and i < 3 else lack.index(max(lack))
                counts[j] += s
                want[device, f"g{g:02d}"] = S.SPLITS[j]
        got = S.assign_largest_first(df, ["device"], "grp", train, val)
        assert got.columns == ["device", "grp", "split"]
        found = [((r.device, r.grp), r.split) for r in got.collect()]
        assert len(found) == len(want) and dict(found) == want


def test_shuffled_split_properties(spark):
    for sizes in ([5, 5, 100], [1], [3, 3], [1, 1, 1, 1], [50] * 10):
        df = spark.createDataFrame([("d", f"g{g}", i) for g, s in enumerate(sizes) for i in range(s)], "device string, grp string, i int")
        got = S.assign_shuffled(df, ["device"], "grp").collect()
        assert len({r.grp for r in got}) == len(got) == len(sizes)
        if len(sizes) >= 3:
            assert {r.split for r in got} == set(S.SPLITS)


def test_ranks_of_few_large_groups_are_stored_once(spark, monkeypatch):
    """With few groups the rows are numbered as they are stored: no window over the rows; with many the old way gives the same."""
    df = frame(spark)
    few = ordered.rank_in_groups(df, ["k"], [("x", "asc"), ("id", "asc")], bucket_rows=20)
    assert "windowspecdefinition(k#" not in few._jdf.queryExecution().optimizedPlan().toString()
    monkeypatch.setattr(ordered, "BROADCAST_RANGES", 0)
    many = ordered.rank_in_groups(df, ["k"], [("x", "asc"), ("id", "asc")], bucket_rows=20)
    assert "windowspecdefinition(k#" in many._jdf.queryExecution().optimizedPlan().toString()
    same(few, df.withColumn("rn", F.row_number().over(Window.partitionBy("k").orderBy("x", "id")).cast("long")))
    same(few, many)
