"""Train/val/test splits without leakage, label files and dataset reports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pilotlamp.functions import arrays, text
from pilotlamp.operators import ordered

SPLITS = ["train", "val", "test"]


def ratios_ok(train, val):
    """Train has a share, val may have one and test is left some; for numbers and columns."""
    return (train > 0) & (val >= 0) & (train + val < 1)


def check_ratios(train: float, val: float) -> None:
    if not ratios_ok(train, val):
        raise ValueError(f"split ratios {train} and {val} must be positive and leave room for test")


def target_counts(n: Column, train: float, val: float) -> Column:
    """struct(train, val, test): rounded half to even; from three rows on no part is empty."""
    check_ratios(train, val)
    a, b = F.bround(n * train).cast("long"), F.bround(n * val).cast("long")
    c = n - a - b
    one = F.lit(1).cast("long")
    raised = F.struct(F.greatest(a, one).alias("train"), F.greatest(b, one).alias("val"), F.greatest(c, one).alias("test"))

    def give_back(s: Column, _: Column) -> Column:
        """Raising parts to one can overshoot; the largest part gives one back."""
        x, y, z = s["train"], s["val"], s["test"]
        over = x + y + z > n
        cut_x = over & (x >= y) & (x >= z) & (x > 1)
        cut_y = over & ~cut_x & (y >= z) & (y > 1)
        cut_z = over & ~cut_x & ~cut_y & (z > 1)
        return F.struct((x - cut_x.cast("long")).alias("train"), (y - cut_y.cast("long")).alias("val"),
                        (z - cut_z.cast("long")).alias("test"))

    repaired = F.aggregate(F.array(F.lit(1), F.lit(2), F.lit(3)), raised, give_back)
    plain = F.struct(a.alias("train"), b.alias("val"), c.alias("test"))
    return F.when(n >= 3, repaired).otherwise(plain)


def split_by_name(images: DataFrame, keys: Sequence[str], name: str, train: float = 0.7, val: float = 0.15) -> DataFrame:
    """Contiguous split in name order."""
    ranked = ordered.with_size(ordered.rank_in_groups(images, keys, [(name, "asc")], "_pl_rn"), keys, "_pl_n")
    t = target_counts(F.col("_pl_n"), train, val)
    ranked = ranked.withColumn("_pl_t", t)
    split = F.when(F.col("_pl_rn") <= F.col("_pl_t.train"), "train").when(
        F.col("_pl_rn") <= F.col("_pl_t.train") + F.col("_pl_t.val"), "val").otherwise("test")
    return ranked.withColumn("split", split).drop("_pl_rn", "_pl_n", "_pl_t")


def _group_sizes(images: DataFrame, keys: Sequence[str], group: str) -> DataFrame:
    return images.groupBy(*keys, group).agg(F.count(F.lit(1)).alias("size"))


def _div(a: Column, b: Column | int) -> Column:
    return F.call_function("div", a, F.lit(b) if isinstance(b, int) else b)


def _share_out(state: Column, run: Column, groups: Column) -> Column:
    """One run of ``run.n`` groups of equal ``run.size``: how its groups are dealt, and what the parts lack after it.

    Seeds come first (``seeds`` from part ``seen`` on). Of the others the part that lacks most (``s1``) takes ``p1``, then
    ``s2`` and ``s1`` take ``p2`` in turn until they lack no more than ``s3``, then all three take turns.
    """
    size, zero = run["size"], F.lit(0).cast("long")
    seeds = F.when(groups >= 3, F.least(run["n"], F.greatest(zero, 3 - state["seen"]))).otherwise(zero)

    def lead(u: Column, v: Column) -> Column:
        """Groups that ``u`` takes before ``v`` takes one; of parts that lack the same the first goes first."""
        gap = v["v"] - u["v"]
        return F.when(gap < 0, zero).otherwise(_div(gap + F.when(u["i"] < v["i"], size).otherwise(size - 1), size))

    def opened(seeds: Column) -> Column:
        lacking = F.transform(state["lack"], lambda v, i: v - F.when((i >= state["seen"]) & (i < state["seen"] + seeds), size).otherwise(zero))
        ranked = F.sort_array(F.transform(lacking, lambda v, i: F.struct((-v).alias("v"), i.alias("i"))))
        return arrays.let(ranked, lambda r: dealt(seeds, F.get(r, F.lit(0)), F.get(r, F.lit(1)), F.get(r, F.lit(2))))

    def dealt(seeds: Column, a: Column, b: Column, c: Column) -> Column:
        def second(p1: Column) -> Column:
            left = F.struct((a["v"] + p1 * size).alias("v"), a["i"].alias("i"))
            p2 = lead(left, c) + lead(b, c)
            return F.struct(size.alias("size"), state["seen"].alias("seen"), seeds.alias("seeds"), p1.alias("p1"), p2.alias("p2"),
                            a["i"].alias("s1"), b["i"].alias("s2"), c["i"].alias("s3"))

        return arrays.let(arrays.let(lead(a, b), second), lambda out: after(out, a, b, c))

    def after(out: Column, a: Column, b: Column, c: Column) -> Column:
        rest = run["n"] - out["seeds"]
        one = F.least(rest, out["p1"])
        two = F.least(rest - one, out["p2"])
        three = rest - one - two
        odd = out["p2"] % 2
        taken = {0: one + _div(two, 2) + _div(three + odd, 3), 1: _div(two + 1, 2) + _div(three + 1 - odd, 3), 2: _div(three + 2, 3)}
        lack = F.transform(F.sort_array(F.array(*[F.struct(p["i"].alias("i"), (-p["v"] - taken[k] * size).alias("v"))
                                                  for k, p in enumerate((a, b, c))])), lambda x: x["v"])
        return F.struct(F.struct(lack.alias("lack"), (state["seen"] + run["n"]).alias("seen")).alias("state"), out.alias("out"))

    return arrays.let(seeds, opened)


def assign_largest_first(images: DataFrame, keys: Sequence[str], group: str, train: float = 0.7,
                         val: float = 0.15) -> DataFrame:
    """Split per group: the three largest groups open train, val and test, each next one goes where most is missing.

    Largest first, ties by name. Groups of equal size are dealt by arithmetic and find their part by their rank among
    them, so only the distinct sizes of a key are listed: at most the square root of twice its images.
    """
    keys = list(keys)
    part, size = F.struct("_pl_size", "_pl_n"), "_pl_size"
    sizes = images.groupBy(*keys, group).agg(F.count(F.lit(1)).alias(size))
    runs = sizes.groupBy(*keys, size).agg(F.count(F.lit(1)).alias("_pl_n"))
    listed = runs.groupBy(*keys).agg(
        F.sum("_pl_n").alias("_pl_groups"), F.sum(F.col(size) * F.col("_pl_n")).alias("_pl_total"),
        F.sort_array(F.collect_list(part), asc=False).alias("_pl_runs"))
    t = target_counts(F.col("_pl_total"), train, val)
    start = F.struct(F.array(*[t[s] for s in SPLITS]).alias("lack"), F.lit(0).cast("long").alias("seen"))
    kind = "struct<size:bigint,seen:bigint,seeds:bigint,p1:bigint,p2:bigint,s1:int,s2:int,s3:int>"
    items = F.transform("_pl_runs", lambda r: F.struct(r[size].alias("size"), r["_pl_n"].alias("n")))
    plan = arrays.scan(items, start, lambda state, run: _share_out(state, run, F.col("_pl_groups")), kind)
    plan = listed.select(*keys, F.explode(plan).alias("_pl_d")).withColumn(size, F.col("_pl_d.size"))
    ranked = ordered.rank_in_groups(sizes, [*keys, size], [(group, "asc")], "_pl_rn")
    d, q = F.col("_pl_d"), F.col("_pl_rn") - 1 - F.col("_pl_d.seeds")
    turn = q - d["p1"] - d["p2"]
    next_, other = (F.when(d["p2"] % 2 == k, d["s2"]).otherwise(d["s1"]) for k in (0, 1))
    place = (F.when(q < 0, d["seen"] + F.col("_pl_rn") - 1).when(q < d["p1"], d["s1"])
             .when(turn < 0, F.when((q - d["p1"]) % 2 == 0, d["s2"]).otherwise(d["s1"]))
             .when(turn % 3 == 0, d["s3"]).when(turn % 3 == 1, next_).otherwise(other))
    split = F.get(F.array(*[F.lit(s) for s in SPLITS]), place.cast("int"))
    return ordered.join_keys(ranked, plan, [*keys, size]).select(*keys, group, split.alias("split"))


def split_devices(images: DataFrame, keys: Sequence[str], group: str, name: str, train: float = 0.7,
                  val: float = 0.15) -> DataFrame:
    """Group split where there are three groups, else a split in name order; adds split and strategy."""
    keys = list(keys)
    many = _group_sizes(images, keys, group).groupBy(*keys).agg(F.count(F.lit(1)).alias("_pl_g")).filter("_pl_g >= 3")
    grouped = ordered.join_keys(images, many.select(*keys), keys, "left_semi")
    assigned = assign_largest_first(grouped, keys, group, train, val)
    by_group = ordered.join_keys(grouped, assigned, [*keys, group])
    by_name = split_by_name(ordered.join_keys(images, many.select(*keys), keys, "left_anti"), keys, name, train, val)
    return by_group.withColumn("strategy", F.lit("video_group")).unionByName(
        by_name.withColumn("strategy", F.lit("image_level")))


def assign_shuffled(images: DataFrame, keys: Sequence[str], group: str, train: float = 0.7, val: float = 0.15,
                    seed: int = 42) -> DataFrame:
    """Split per group in hashed order: train up to its share, then val, the rest test.

    Prefix sums replace the loop. With three groups or more an empty part takes the last group of the
    part with most groups.
    """
    check_ratios(train, val)
    keys = list(keys)
    sizes = _group_sizes(images, keys, group).withColumn(
        "_pl_h", F.md5(F.concat_ws(":", F.lit(str(seed)), F.col(group).cast("string"))))
    order = [("_pl_h", "asc"), (group, "asc")]
    run = ordered.prefix_sum(sizes, keys, order, "size", "_pl_before", rank_col="_pl_rn")
    total = sizes.groupBy(*keys).agg(F.sum("size").alias("_pl_total"))
    run = ordered.join_keys(run, total, keys)
    in_train = F.col("_pl_before") < F.col("_pl_total") * train
    used = run.filter(in_train).groupBy(*keys).agg(F.sum("size").alias("_pl_used"))
    run = ordered.join_keys(run, used, keys, "left")
    in_val = F.col("_pl_before") - F.coalesce("_pl_used", F.lit(0)) < F.col("_pl_total") * val
    run = run.withColumn("split", F.when(in_train, "train").when(in_val, "val").otherwise("test"))
    have = run.groupBy(*keys).agg(*[F.count_if(F.col("split") == s).alias(f"_pl_{s}") for s in SPLITS])
    run = ordered.join_keys(run, have, keys)
    a, b, c, r = (F.col(f"_pl_{x}") for x in ("train", "val", "test", "rn"))
    enough = a + b + c >= 3
    moved = (F.when(enough & (b == 0) & (c == 0), F.when(r == a, "val").when(r == a - 1, "test"))
             .when(enough & (c == 0), F.when(r == F.when(a >= b, a).otherwise(a + b), "test"))
             .when(enough & (b == 0), F.when(r == F.when(a >= c, a).otherwise(a + c), "val")))
    return run.select(*keys, group, "size", F.coalesce(moved, F.col("split")).alias("split"))


def apply_splits(images: DataFrame, assigned: DataFrame, keys: Sequence[str], group: str) -> DataFrame:
    return ordered.join_keys(images, assigned.select(*keys, group, "split"), [*keys, group])


def missing_classes(rows: DataFrame, label: str) -> DataFrame:
    """Classes of train that a part lacks, and other classes that train lacks."""
    has = rows.groupBy(label).agg(*[F.bool_or(F.col("split") == s).alias(s) for s in SPLITS])
    lacking = F.filter(F.array(*[F.when(~F.col(s), F.lit(s)) for s in SPLITS]), lambda x: x.isNotNull())
    return has.select(label, F.explode(lacking).alias("missing_in"))


def class_totals(names: DataFrame, boxes: DataFrame) -> DataFrame:
    """Boxes per class of the dictionary, zero included."""
    counts = boxes.groupBy("class_id").agg(F.count(F.lit(1)).alias("instances"))
    return names.join(counts, "class_id", "left").withColumn("instances", F.coalesce("instances", F.lit(0)))


def split_summary(images: DataFrame) -> DataFrame:
    """Images, boxes and empty images per part and in total. ``images``: split, n_boxes."""
    out = images.rollup("split").agg(
        F.count(F.lit(1)).alias("images"), F.sum("n_boxes").alias("boxes"), F.count_if(F.col("n_boxes") == 0).alias("empty"))
    return out.withColumn("split", F.coalesce("split", F.lit("total")))


def match_inventory(annotations: DataFrame, inventory: DataFrame, on: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Annotations with a file, and those whose file is missing.

    Names in order shrink to little in a shuffle, so partitions merged by size would hold too many rows to sort in memory.
    """
    files = ordered.lay_out(inventory.select(*on), *on).distinct()
    annotations = ordered.lay_out(annotations, *on)
    return annotations.join(files, list(on)), annotations.join(files, list(on), "left_anti")


# label files -------------------------------------------------------------------------------------

def parse_label_lines(lines: DataFrame, class_count: int, column: str = "line") -> DataFrame:
    """Typed fields of ``class cx cy w h`` lines and the first problem of each line."""
    lines = lines.withColumn("_pl_parts", F.split(text.strip(F.col(column)), r"(?U)\s+"))
    parts = F.col("_pl_parts")
    number = lambda i: F.when(~F.get(parts, F.lit(i)).rlike("(?i)[0-9.][df]$"),
                              F.get(parts, F.lit(i)).try_cast("double"))
    whole = F.when(F.get(parts, F.lit(0)).rlike(r"^[+-]?[0-9]+$"), F.get(parts, F.lit(0)).try_cast("long"))
    fields = ["cx", "cy", "w", "h"]
    typed = lines.withColumns(
        {"class_id": whole, **{c: number(i + 1) for i, c in enumerate(fields)}})
    unread = F.col("class_id").isNull()
    outside = F.lit(False)
    for c in fields:
        unread = unread | F.col(c).isNull()
        outside = outside | ~F.col(c).between(0.0, 1.0)
    problem = (F.when(F.size(parts) != 5, "column_count").when(unread, "not_a_number")
               .when((F.col("class_id") < 0) | (F.col("class_id") >= class_count), "class_out_of_range")
               .when(outside, "coordinate_out_of_range"))
    return typed.withColumn("problem", problem).drop("_pl_parts")


def label_report(parsed: DataFrame, file: str = "file", line_no: str = "line_no") -> DataFrame:
    """First problem per file."""
    bad = F.when(F.col("problem").isNotNull(), F.col(line_no))
    # conditional aggregates: a filter on the derived column would parse every line twice
    return parsed.groupBy(file).agg(F.min(bad).alias("line_no"), F.min_by("problem", bad).alias("problem")).filter(
        "problem IS NOT NULL")


def require_clean(report: DataFrame, show: int = 50) -> None:
    """Refuse to go on when label files have problems."""
    found = report.count()
    if found:
        first = "; ".join(f"{r[0]}:{r['line_no']} {r['problem']}" for r in report.orderBy(report.columns[0]).take(show))
        raise ValueError(f"{found} label files have problems: {first}")


def label_text(images: DataFrame, boxes: DataFrame, key: str, order: ordered.Order, digits: int = 8,
               page_rows: int = 10_000) -> DataFrame:
    """Label file body per image (in pages), empty for images without boxes. ``boxes``: class_id, cx, cy, bw, bh."""
    line = F.format_string(f"%d %.{digits}f %.{digits}f %.{digits}f %.{digits}f", "class_id", "cx", "cy", "bw", "bh")
    listed = ordered.pages(boxes, [key], order, line, "lines", page_rows)
    return images.join(listed, key, "left").select(
        *images.columns, F.coalesce("page", F.lit(0)).alias("page"),
        F.coalesce(F.array_join("lines", "\n"), F.lit("")).alias("body"))
