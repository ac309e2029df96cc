"""Ranks, fill-down, sliding windows and folds that stay balanced when one group holds most rows.

A plain ``Window.partitionBy(key)`` sends a whole group to one task. Where the largest group is above
``bucket_rows``, the table is dealt by range of keys and order columns, so that a large group covers several
ranges, however its values are spread: a range is one window partition, and a small table of range sums supplies
what each range needs from those before it. Range limits are sampled, so the dealt table is written once to
the shared folder and read by all later steps; a lost executor cannot change the limits.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from fractions import Fraction

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pilotlamp.session import durable

BUCKET_ROWS = 1_000_000
BROADCAST_RANGES = 50_000
Order = Sequence[tuple[str, str]]


def sort_columns(order: Order) -> list[Column]:
    return [F.col(c).asc() if d == "asc" else F.col(c).desc() for c, d in order]


def _renamed(keys: Sequence[str], prefix: str) -> list[Column]:
    return [F.col(k).alias(f"{prefix}{i}") for i, k in enumerate(keys)]


def join_keys(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Join by equal keys where NULL equals NULL; the columns of ``left``, then the other columns of ``right``."""
    keys = list(keys)
    other = right.select(*_renamed(keys, "_ord_j"), *[c for c in right.columns if c not in keys])
    cond = F.lit(True)
    for i, k in enumerate(keys):
        cond = cond & left[k].eqNullSafe(other[f"_ord_j{i}"])
    out = left.join(other, cond, how)
    return out if how in ("left_semi", "left_anti") else out.drop(*[f"_ord_j{i}" for i in range(len(keys))])


def bucketize(df: DataFrame, keys: Sequence[str], order: Order, bucket_rows: int = BUCKET_ROWS) -> tuple[DataFrame, int]:
    """``df`` with ``_ord_b``, a range number that grows with ``order`` inside each group, and the number of ranges.

    Ranges are cut by the keys, all order columns and a row number, so neither outliers nor ties make a long one.
    One range (all 0) when no group is above ``bucket_rows``.
    """
    dealt, ranges, _ = _deal(df, keys, order, bucket_rows)
    return (dealt, 1) if ranges == 1 else (durable(dealt.drop("_ord_tie")), ranges)


def _deal(df: DataFrame, keys: Sequence[str], order: Order, bucket_rows: int) -> tuple[DataFrame, int, int]:
    """The rows in ranges with ``_ord_b``, not yet stored, the number of ranges and that of groups."""
    largest, total, groups = df.groupBy(*keys).count().agg(F.max("count"), F.sum("count"), F.count(F.lit(1))).first()
    if not total or largest <= bucket_rows:
        return df.withColumn("_ord_b", F.lit(0).cast("long")), 1, groups
    ranges = -(-2 * total // bucket_rows)
    by = [*[F.col(k).asc() for k in keys], *sort_columns(order), F.col("_ord_tie").asc()]
    dealt = df.withColumn("_ord_tie", F.monotonically_increasing_id()).repartitionByRange(ranges, *by)
    return dealt.withColumn("_ord_b", F.spark_partition_id().cast("long")), ranges, groups


def _before(b: DataFrame, keys: Sequence[str], ranges: int, sums: Sequence[Column], carry: Sequence[Column]) -> DataFrame:
    """``sums`` per range of a group, turned by ``carry`` into what its later ranges need, one row for each of those.

    A group that lies in one range has none, so there are at most twice as many rows as ranges.
    """
    names = [f"_ord_o{i}" for i in range(len(keys))]
    over = Window.partitionBy(*names).orderBy("_ord_ob")
    per_range = b.groupBy(*_renamed(keys, "_ord_o"), F.col("_ord_b").alias("_ord_ob")).agg(*sums)
    later = per_range.select(*names, "_ord_ob", F.row_number().over(over).alias("_ord_rank"), *[
        c.over(over.rowsBetween(Window.unboundedPreceding, -1)).alias(f"_ord_c{i}") for i, c in enumerate(carry)])
    later = later.filter("_ord_rank > 1").drop("_ord_rank")
    return F.broadcast(later) if ranges <= BROADCAST_RANGES else later


def _with_before(rows: DataFrame, later: DataFrame, keys: Sequence[str]) -> DataFrame:
    cond = F.col("_ord_b") == F.col("_ord_ob")
    for i, k in enumerate(keys):
        cond = cond & F.col(k).eqNullSafe(F.col(f"_ord_o{i}"))
    return rows.join(later, cond, "left").drop("_ord_ob", *[f"_ord_o{i}" for i in range(len(keys))])


def rank_in_groups(df: DataFrame, keys: Sequence[str], order: Order, rank_col: str = "rn",
                   bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """1-based position of each row in its group; ``order`` must be total for a repeatable result.

    Where groups are large and few, the rows of a range are numbered as they are stored, and a small table says where each
    group starts in it: they are shuffled once.
    """
    dealt, ranges, groups = _deal(df, keys, order, bucket_rows)
    local = F.row_number().over(Window.partitionBy(*keys, "_ord_b").orderBy(*sort_columns(order)))
    if ranges == 1:
        return dealt.withColumn(rank_col, local.cast("long")).drop("_ord_b")
    if groups + ranges <= BROADCAST_RANGES:
        by = [*[F.col(k).asc() for k in keys], *sort_columns(order), F.col("_ord_tie").asc()]
        b = durable(dealt.sortWithinPartitions(*by).drop("_ord_tie").withColumn("_ord_at", F.monotonically_increasing_id()))
        names = [f"_ord_o{i}" for i in range(len(keys))]
        starts = b.groupBy(*_renamed(keys, "_ord_o"), F.col("_ord_b").alias("_ord_ob")).agg(
            F.min("_ord_at").alias("_ord_first"), F.count(F.lit(1)).alias("_ord_n"))
        over = Window.partitionBy(*names).orderBy("_ord_ob").rowsBetween(Window.unboundedPreceding, -1)
        starts = starts.withColumn("_ord_c0", F.coalesce(F.sum("_ord_n").over(over), F.lit(0)) - F.col("_ord_first") + 1).drop("_ord_first", "_ord_n")
        out = _with_before(b, F.broadcast(starts), keys)
        return out.withColumn(rank_col, F.col("_ord_at") + F.col("_ord_c0")).drop("_ord_b", "_ord_at", "_ord_c0")
    b = durable(dealt.drop("_ord_tie"))
    later = _before(b, keys, ranges, [F.count(F.lit(1)).alias("_ord_n")], [F.sum("_ord_n")])
    out = _with_before(b.withColumn("_ord_r", local), later, keys)
    return out.withColumn(rank_col, (F.col("_ord_r") + F.coalesce("_ord_c0", F.lit(0))).cast("long")).drop(
        "_ord_b", "_ord_r", "_ord_c0")


def prefix_sum(df: DataFrame, keys: Sequence[str], order: Order, value: str, out_col: str,
               bucket_rows: int = BUCKET_ROWS, rank_col: str | None = None) -> DataFrame:
    """Sum of ``value`` over the rows before the current one in its group (0 for the first), and its rank if named."""
    b, ranges = bucketize(df, keys, order, bucket_rows)
    w = Window.partitionBy(*keys, "_ord_b").orderBy(*sort_columns(order))
    local = {out_col: F.coalesce(F.sum(value).over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))}
    if rank_col:
        local[rank_col] = F.row_number().over(w).cast("long")
    out = b.withColumns(local)
    if ranges == 1:
        return out.drop("_ord_b")
    later = _before(b, keys, ranges, [F.sum(value).alias("_ord_s"), F.count(F.lit(1)).alias("_ord_n")],
                    [F.sum("_ord_s"), F.sum("_ord_n")])
    out = _with_before(out, later, keys)
    out = out.withColumns({c: F.col(c) + F.coalesce(f"_ord_c{i}", F.lit(0)) for i, c in enumerate(local)})
    return out.drop("_ord_b", "_ord_c0", "_ord_c1")


def fill_down(df: DataFrame, keys: Sequence[str], order: Order, columns: Sequence[str],
              bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """Replace NULLs by the last non-NULL value above them in the group."""
    if len({d for _, d in order}) > 1:
        raise ValueError("fill_down needs one direction for all order columns")
    b, ranges = bucketize(df, keys, order, bucket_rows)
    w = Window.partitionBy(*keys, "_ord_b").orderBy(*sort_columns(order)).rowsBetween(Window.unboundedPreceding, 0)
    filled = {f"_ord_l{i}": F.last(c, ignorenulls=True).over(w) for i, c in enumerate(columns)}
    out = b.withColumns(filled)
    if ranges > 1:
        position = F.struct(*[F.col(c) for c, _ in order])
        pick = F.max_by if order[0][1] == "asc" else F.min_by
        last = [pick(F.col(c), F.when(F.col(c).isNotNull(), position)).alias(f"_ord_v{i}") for i, c in enumerate(columns)]
        later = _before(b, keys, ranges, last, [F.last(f"_ord_v{i}", ignorenulls=True) for i in range(len(columns))])
        out = _with_before(out, later, keys)
        out = out.withColumns({f"_ord_l{i}": F.coalesce(f"_ord_l{i}", f"_ord_c{i}") for i in range(len(columns))})
    return out.withColumns({c: F.col(f"_ord_l{i}") for i, c in enumerate(columns)}).select(*df.columns)


def trailing(df: DataFrame, keys: Sequence[str], order: Order, size: int, aggregate: Column, out_col: str,
             rank_col: str = "rn", chunk_rows: int = BUCKET_ROWS) -> DataFrame:
    """``aggregate`` over the last ``size`` rows including the current one, plus the row's rank.

    Chunks of ``chunk_rows`` ranks are windowed apart; each chunk also gets the last ``size - 1`` rows of
    the chunk before it, so the result equals one window over the whole group.
    """
    if chunk_rows < size:
        raise ValueError("chunk_rows must not be smaller than the window")
    ranked = rank_in_groups(df, keys, order, rank_col, bucket_rows=chunk_rows)
    at = F.col(rank_col) - 1
    chunk = F.floor(at / F.lit(chunk_rows)).cast("long")
    copies = F.when(at % chunk_rows >= chunk_rows - (size - 1), F.array(chunk, chunk + 1)).otherwise(F.array(chunk))
    spread = ranked.withColumn("_ord_home", chunk).withColumn("_ord_chunk", F.explode(copies))
    w = Window.partitionBy(*keys, "_ord_chunk").orderBy(rank_col).rowsBetween(-(size - 1), 0)
    out = spread.withColumn(out_col, aggregate.over(w))
    return out.filter(F.col("_ord_home") == F.col("_ord_chunk")).drop("_ord_home", "_ord_chunk")


def with_size(df: DataFrame, keys: Sequence[str], out_col: str = "n", where: Column | None = None) -> DataFrame:
    """Add the group size (of the rows where ``where`` holds)."""
    count = F.count(F.lit(1)) if where is None else F.count_if(where)
    return join_keys(df, df.groupBy(*keys).agg(count.alias(out_col)), keys)


def exact_quantiles(df: DataFrame, keys: Sequence[str], value: str, shares: dict[str, float]) -> DataFrame:
    """Quantiles with linear interpolation per group, from ranks instead of a whole group in memory.

    Positions are computed in whole numbers: 0.67 of 1500 is row 1005, not a hair above it as in floats.
    """
    rows = df.filter(F.col(value).isNotNull()).select(*keys, value)
    ranked = rank_in_groups(rows, keys, [(value, "asc")], "_ord_rn")
    sized = with_size(ranked, keys, "_ord_size")
    place = F.col("_ord_rn") - 1
    near, aggregates = F.lit(False), []
    for name, p in shares.items():
        share = Fraction(str(p))
        steps = (F.col("_ord_size") - 1) * F.lit(share.numerator).cast("long")
        over = steps % F.lit(share.denominator).cast("long")
        below = ((steps - over) / share.denominator).cast("long")
        above = below + (over > 0).cast("long")
        near = near | (place == below) | (place == above)
        low = F.max(F.when(place == below, F.col(value)))
        high = F.max(F.when(place == above, F.col(value)))
        aggregates.append((low + (high - low) * F.max(over / share.denominator)).alias(name))
    picked = sized.filter(near)
    return picked.groupBy(*keys).agg(*aggregates, F.max("_ord_size").alias("n_values"))


def pages(df: DataFrame, keys: Sequence[str], order: Order, value: Column, out_col: str = "items",
          page_rows: int = 1000) -> DataFrame:
    """Ordered lists of ``value`` per group, cut into pages so that no list outgrows one row."""
    ranked = rank_in_groups(df, keys, order, "_ord_rn")
    page = F.floor((F.col("_ord_rn") - 1) / F.lit(page_rows)).cast("long")
    listed = ranked.groupBy(*keys, page.alias("page")).agg(
        F.sort_array(F.collect_list(F.struct(F.col("_ord_rn").alias("at"), value.alias("v")))).alias("_ord_items"))
    return listed.select(*keys, "page", F.transform("_ord_items", lambda x: x["v"]).alias(out_col))


def once(df: DataFrame, name: str, value: Column) -> DataFrame:
    """Add a column that is computed once per row, however often it is used below.

    Plain columns are copied into every expression that uses them; a generator is not.
    """
    return df.withColumn(name, F.explode(F.array(value)))


def _partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def lay_out(df: DataFrame, *keys: str) -> DataFrame:
    """Hash layout by ``keys`` for the join or aggregate that follows, not merged by size."""
    return df.repartition(_partitions(df), *keys)


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Use all shuffle partitions before a step that does much work per byte; merging by size would idle cores.

    The hashed key keeps the planner from dropping the shuffle when the rows are already laid out by ``keys``.
    """
    return df.repartition(_partitions(df), F.xxhash64(*keys))


def top_in_groups(df: DataFrame, keys: Sequence[str], order: Order, k: int, rank_col: str = "rn") -> DataFrame:
    """First ``k`` rows per group. Spark limits each map task to ``k`` rows per group before the shuffle."""
    w = Window.partitionBy(*keys).orderBy(*sort_columns(order))
    return df.withColumn(rank_col, F.row_number().over(w)).filter(F.col(rank_col) <= k)


def through_pandas(df: DataFrame, columns: Sequence[str], mask: str = "_ord_mask") -> tuple[list[Column], list[Column]]:
    """``columns`` (numbers, booleans, texts) as they can go through pandas, with ``mask``, and what restores them after it.

    In pandas a missing number makes whole numbers floats and NaN becomes NULL; ``mask`` tells which values were missing or NaN.
    """
    there, back, marks = [], [], F.lit(0).cast("long")
    for i, c in enumerate(columns):
        kind, v = df.schema[c].dataType, F.col(c)
        if isinstance(kind, T.StringType):
            there.append(v)
            back.append(v)
            continue
        if not isinstance(kind, (T.IntegralType, T.FloatType, T.DoubleType, T.BooleanType)) or i > 30:
            raise ValueError(f"{c}: {kind.simpleString()} does not go through pandas unchanged")
        floats = isinstance(kind, (T.FloatType, T.DoubleType))
        missing, nan = 1 << 2 * i, 2 << 2 * i
        odd = F.when(v.isNull(), missing)
        marks = marks + (odd.when(F.isnan(v), nan) if floats else odd).otherwise(0).cast("long")
        zero = F.lit(0).cast(kind)
        there.append(F.when(v.isNull() | F.isnan(v) if floats else v.isNull(), zero).otherwise(v).alias(c))
        marked = lambda bit: F.col(mask).bitwiseAND(F.lit(bit).cast("long")) != 0
        value = F.when(marked(missing), F.lit(None).cast(kind))
        back.append((value.when(marked(nan), F.lit(float("nan")).cast(kind)) if floats else value).otherwise(v).alias(c))
    return [*there, marks.alias(mask)], back


def largest_group(df: DataFrame, keys: Sequence[str]) -> int:
    return df.groupBy(*keys).count().agg(F.max("count")).first()[0] or 0


Step = Callable[[pd.DataFrame, bytes | None], tuple[pd.DataFrame, bytes]]
Many = Callable[[pd.DataFrame, np.ndarray], pd.DataFrame]


def lay_out_groups(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Whole groups in partitions, with ``_ord_h`` by which they are laid out; a fold of such rows does not shuffle them again.

    So narrow rows can be shuffled and widened afterwards. ``_ord_h`` is a short hash, which the windows of a fold share: by
    the keys themselves a constant one would make them shuffle again.
    """
    return lay_out(df.withColumn("_ord_h", F.pmod(F.xxhash64(*keys), F.lit(1 << 20)).cast("int")), "_ord_h")


def _whole_groups(df: DataFrame, keys: list[str], order: Order, many: Many, out_schema: T.StructType) -> DataFrame:
    """``many(rows, starts)`` over sorted groups, as many at once as came in a batch; a cut group waits for its rest."""
    placed = df if "_ord_h" in df.columns else lay_out_groups(df, keys)
    over = Window.partitionBy("_ord_h", *keys).orderBy(*sort_columns(order))
    placed = placed.withColumn("_ord_rn", F.row_number().over(over)).drop("_ord_h")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[pd.DataFrame] = []
        for batch in batches:
            first = np.flatnonzero(batch["_ord_rn"].to_numpy() == 1)
            if not len(first):
                held.append(batch)
                continue
            yield from done([*held, batch.iloc[:first[-1]]])
            held = [batch.iloc[first[-1]:]]
        yield from done(held)

    def done(parts: list[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        parts = [p for p in parts if len(p)]
        if parts:
            rows = pd.concat(parts, ignore_index=True)
            yield many(rows.drop(columns="_ord_rn"), np.flatnonzero(rows["_ord_rn"].to_numpy() == 1))

    return placed.mapInPandas(run, out_schema)


def fold_in_order(df: DataFrame, keys: Sequence[str], order: Order, step: Step, out_schema: T.StructType,
                  chunk_rows: int = 200_000, settle: bool = True, many: Many | None = None, largest: int | None = None) -> DataFrame:
    """Run an order-dependent ``step`` over each group, never more than ``chunk_rows`` rows at a time.

    ``step(rows, state)`` gets one sorted chunk and the state left by the chunk before it (None at the
    start) and returns the output rows and its own closing state. Groups that fit one chunk take one
    pass; ``many(rows, starts)``, if given, folds those of a batch at once, from sorted rows and the place where each
    group starts. For larger groups every chunk first runs from an empty state and runs again whenever the
    closing state before it changed, until nothing changes; then each chunk has seen exactly the state
    of a sequential run. ``settle=False`` is for states that depend on all rows so far (counters): there
    a chunk waits for the final state of the chunk before it, which keeps the work linear. ``largest`` is the size of the
    largest group, if known. Rows from ``lay_out_groups`` by the same keys are not laid out again.
    """
    keys = list(keys)

    def one_by_one(rows: pd.DataFrame, starts: np.ndarray) -> pd.DataFrame:
        ends = [*starts[1:], len(rows)]
        made = [step(rows.iloc[a:b].reset_index(drop=True), None)[0] for a, b in zip(starts, ends)]
        return pd.concat([m for m in made if len(m)] or made[:1])

    if (largest_group(df, keys) if largest is None else largest) <= chunk_rows:
        return _whole_groups(df, keys, order, many or one_by_one, out_schema)

    df = df.drop("_ord_h")
    at = (F.col("_ord_rn") - 1) / F.lit(chunk_rows)
    rows = durable(rank_in_groups(df, keys, order, "_ord_rn", bucket_rows=chunk_rows)
                   .withColumn("_ord_chunk", F.floor(at).cast("long")))
    key_fields = [rows.schema[k] for k in keys]
    state_schema = T.StructType([*key_fields, T.StructField("_ord_chunk", T.LongType()),
                                 T.StructField("_ord_out", T.BinaryType())])
    data = list(df.columns)

    def close(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("_ord_rn")
        state = pdf["_ord_in"].iloc[0]
        _, out = step(pdf[data].reset_index(drop=True), None if state is None else bytes(state))
        head = {k: [pdf[k].iloc[0]] for k in keys}
        return pd.DataFrame({**head, "_ord_chunk": [pdf["_ord_chunk"].iloc[0]], "_ord_out": [out]})

    def emit(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("_ord_rn")
        state = pdf["_ord_in"].iloc[0]
        return step(pdf[data].reset_index(drop=True), None if state is None else bytes(state))[0]

    empty = F.lit(None).cast("binary")
    todo = durable(rows.select(*keys, "_ord_chunk").distinct().withColumn("_ord_in", empty))
    states = todo.withColumn("_ord_out", empty)
    if not settle:
        todo = todo.filter("_ord_chunk = 0")
    on = [*keys, "_ord_chunk"]
    while True:
        ran = join_keys(rows, todo, on).groupBy(*on).applyInPandas(close, state_schema)
        used = todo.select(*on, F.col("_ord_in").alias("_ord_used"), F.lit(True).alias("_ord_hit"))
        states = durable(
            join_keys(join_keys(states, used, on, "left"), ran.withColumnRenamed("_ord_out", "_ord_new"), on, "left").select(*on, F.when(F.col("_ord_hit"), F.col("_ord_used")).otherwise(F.col("_ord_in")).alias("_ord_in"),
                    F.when(F.col("_ord_hit"), F.col("_ord_new")).otherwise(F.col("_ord_out")).alias("_ord_out")))
        earlier = states.select(*keys, (F.col("_ord_chunk") + 1).alias("_ord_chunk"), F.col("_ord_out").alias("_ord_prev"))
        todo = (join_keys(states, earlier, on)
                .filter(F.col("_ord_prev").isNotNull() & ~F.col("_ord_prev").eqNullSafe(F.col("_ord_in")))
                .select(*on, F.col("_ord_prev").alias("_ord_in")))
        todo = durable(todo)
        if todo.isEmpty():
            break
    return join_keys(rows, states.select(*on, "_ord_in"), on).groupBy(*on).applyInPandas(emit, out_schema)
