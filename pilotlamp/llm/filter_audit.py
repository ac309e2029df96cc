"""Interactions of filters by relations of failing ids.

Every filter has one stored table: the keys of the documents that fail it. What a filter removes after a prefix of other filters
depends on the set of these, not on their order: its failing keys, left-anti joined with the tables of the filters before. A left-semi join
gives those that the filter added last made redundant. The sets grow by one filter a round, all in one relation, so ``f`` filters
take ``f - 1`` rounds. Survivors of a prefix are all documents less what its steps remove. The counts by set are a small
table, from which every order reads its steps.

Documents are told apart by a key made of id, text and part; equal rows share a key and count as often as they occur. A null id is
above all others when texts are compared; null text reads as empty, a null part as ''. A label counts if any row of the id has it; rows
with a null id have none. Other columns of the input are not read, whatever their names. An empty table gives an empty result.
"""

from __future__ import annotations

from functools import reduce
from itertools import permutations
from math import factorial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pilotlamp.llm.common import col
from pilotlamp.session import durable, new_folder

HOT = 256  # a text on more than this part of all rows is hot: there are fewer than HOT such texts
REPEATED = "E"


def text_filters(text: Column, words: Column) -> dict[str, Column]:
    """Failure conditions of the filters that look at one text."""
    upper = F.length(text) - F.length(F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", ""))
    return {
        "A": F.size(words) < 200,
        "B": 100 * F.size(F.array_distinct(words)) < 50 * F.size(words),
        "C": 100 * upper > 3 * F.length(text),
        "D": text.rlike("[#$%&*|]"),
    }


def keyed(documents: DataFrame, part: str = "lang", filters=text_filters) -> DataFrame:
    """``key, doc_id, part, text_key`` of every row and one boolean for each filter of ``filters``: does it fail?"""
    rows = documents.select(col("doc_id"), F.coalesce(col(part).cast("string"), F.lit("")).alias("part"), F.coalesce(col("text"), F.lit("")).alias("text"))
    rows = rows.select("*", F.unhex(F.md5("text")).alias("text_key"), F.filter(F.split("text", "[\\x20\\x09-\\x0D]+"), lambda w: w != "").alias("words"))
    whole = F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), F.hex("text_key"), F.col("part"))
    fails = filters(F.col("text"), F.col("words"))
    return rows.select(F.unhex(F.md5(whole)).alias("key"), "doc_id", "part", "text_key", *[c.alias(name) for name, c in fails.items()])


def repeated_texts(rows: DataFrame) -> DataFrame:
    """``key`` of the rows whose text a smaller id has. Texts on very many rows are few and meet their least id by broadcast."""
    least = durable(rows.groupBy("text_key").agg(F.min("doc_id").alias("least"), F.count("*").alias("n")).where("n > 1"))
    bound = rows.count() / HOT
    hot, cold = F.broadcast(least.where(F.col("n") > bound)), least.where(F.col("n") <= bound)
    later = (F.col("doc_id") > F.col("least")) | (F.col("doc_id").isNull() & F.col("least").isNotNull())
    slim = rows.select("key", "doc_id", "text_key")
    many = slim.join(hot, "text_key").where(later)
    few = slim.join(hot, "text_key", "left_anti").join(cold, "text_key").where(later)
    return many.select("key").unionByName(few.select("key"))


def store(failing: dict[str, DataFrame], spark) -> dict[str, DataFrame]:
    """One table of distinct failing keys for each filter, in the shared folder."""
    folder = new_folder(spark, "failing")
    for name, keys in failing.items():
        keys.select("key").distinct().write.parquet(f"{folder}/{name}")
    return {name: spark.read.schema("key binary").parquet(f"{folder}/{name}") for name in failing}


def _reads(filters: int) -> list[tuple[int, int, str, int, int, str, int]]:
    """Which counts make up the figures of filter ``own`` after the set ``before``: ``own, before, figure, from_own, from_before, kind, times``."""
    out, every = [], range(filters)
    bits = lambda s: [i for i in every if s >> i & 1]
    lower = lambda s, i: s & ((1 << i) - 1)
    for own in every:
        others = ((1 << filters) - 1) & ~(1 << own)
        sets = [s for s in range(1 << filters) if not s >> own & 1]
        for before in sets:
            out.append((own, before, "removed", own, before, "removed", 1))
            out.append((own, before, "unique_fails", own, others, "removed", 1))
            # a failing document becomes redundant with the first filter of the set, by number, that it fails
            out += [(own, before, "redundant", own, lower(before, i) | 1 << i, "redundant", 1) for i in bits(before)]
            after = before | 1 << own
            out += [(own, before, "gone", i, lower(after, i), "removed", 1) for i in bits(after)]
            # so many orders put exactly this set before the filter
            out += [(own, before, "shapley", own, s, "removed", factorial(len(bits(s))) * factorial(filters - 1 - len(bits(s)))) for s in sets]
    return out


def count_sets(weighed: DataFrame, failing: dict[str, DataFrame]) -> DataFrame:
    """``part, own, before, kind, n`` and the flags of ``weighed``: documents that filter ``own`` removes after the set ``before``
    (``removed``), or that the last filter of the set, by number, keeps it from removing (``redundant``). Sets are numbers, a bit a filter.
    """
    names = sorted(failing)
    flags = [c for c in weighed.columns if c not in ("key", "part", "n")]
    relation = reduce(DataFrame.unionByName, [failing[name].select(F.lit(i).alias("own"), "key") for i, name in enumerate(names)])
    numbers = F.array(*[F.lit(i) for i in range(len(names))])
    measures = [F.sum("n").alias("n"), *[F.sum(F.when(F.col(f), F.col("n")).otherwise(0)).alias(f) for f in flags]]

    def counted(rows: DataFrame, kind: str) -> DataFrame:
        return rows.groupBy("part", "own", "before").agg(*measures).withColumn("kind", F.lit(kind))

    left = durable(relation.join(weighed, "key").withColumn("before", F.lit(0)))
    found, earlier = [counted(left, "removed")], relation.withColumnRenamed("own", "last")
    for _ in names[1:]:
        # a set gets numbers above its own only, so each is made once
        free = F.filter(numbers, lambda i: (i != F.col("own")) & (F.pow(F.lit(2), i) > F.col("before")))
        grown = left.withColumn("last", F.explode(free))
        grown = grown.withColumn("before", F.col("before") + F.pow(F.lit(2), F.col("last")).cast("int"))
        found.append(counted(grown.join(earlier, ["last", "key"], "left_semi"), "redundant"))
        left = durable(grown.join(earlier, ["last", "key"], "left_anti").drop("last"))
        found.append(counted(left, "removed"))
    return reduce(DataFrame.unionByName, found)


def all_orders(parts: DataFrame, counts: DataFrame, names: list[str]) -> DataFrame:
    """One row per part, order of the filters and step. ``parts``: ``part, total``; ``counts``: as ``count_sets`` gives them."""
    spark, n = parts.sparkSession, len(names)
    flags = [c for c in counts.columns if c not in ("part", "own", "before", "kind", "n")]
    # both tables depend on the number of filters alone
    reads = spark.createDataFrame(_reads(n), "to_own int, to_before int, figure string, own int, before int, kind string, times long")
    steps = [
        ("".join(names[i] for i in order), k + 1, own, sum(1 << i for i in order[:k])) for order in permutations(range(n)) for k, own in enumerate(order)
    ]
    steps = spark.createDataFrame(steps, "filter_order string, step int, own int, before int")
    small = durable(counts)
    figure = lambda name, value: F.sum(F.when(F.col("figure") == name, F.col(value) * F.col("times")).otherwise(0))
    sums = small.join(F.broadcast(reads), ["own", "before", "kind"]).groupBy("part", F.col("to_own").alias("own"), F.col("to_before").alias("before")).agg(
        *[figure(name, "n").alias(name) for name in ("removed", "redundant", "unique_fails", "gone", "shapley")], *[figure("removed", f).alias(f"{f}_lost") for f in flags]
    )
    figures = ["removed", "redundant", "unique_fails", *[f"{f}_lost" for f in flags], "shapley"]
    wanted = F.array(*[F.struct(F.lit(own).alias("own"), F.lit(s).alias("before")) for own in range(n) for s in range(1 << n) if not s >> own & 1])
    every = parts.select("part", "total", F.explode(wanted).alias("w")).select("part", "total", "w.own", "w.before")
    filled = every.join(sums, ["part", "own", "before"], "left").fillna(0)
    return filled.join(F.broadcast(steps), ["own", "before"]).select(
        "part", "filter_order", "step", (F.col("total") - F.col("gone")).alias("kept"), *[F.col(f).cast("long").alias(f) for f in figures]
    )


def audit(documents: DataFrame, labels: DataFrame, part: str = "lang", filters=text_filters) -> DataFrame:
    """One row per part of ``documents``, order of the filters and step of it: ``part, filter_order, step, kept, removed, redundant,
    unique_fails, good_lost, toxic_lost, shapley``.

    ``filters`` gives the failure conditions from a text and its words, named by single letters before ``E``; filter ``E`` fails texts
    that a smaller id has. ``labels`` has ``doc_id, quality`` (1: good) and ``toxic`` (1: toxic). ``shapley`` is ``removed`` over all orders.
    """
    spark = documents.sparkSession
    rows = durable(keyed(documents, part, filters))
    names = [c for c in rows.columns if c not in ("key", "doc_id", "part", "text_key")]
    failing = store({**{c: rows.where(F.col(c)).select("key") for c in names}, REPEATED: repeated_texts(rows)}, spark)
    marks = labels.where("doc_id IS NOT NULL").groupBy("doc_id").agg(F.max(F.col("quality") == 1).alias("good"), F.max(F.col("toxic") == 1).alias("toxic"))
    weighed = rows.groupBy("key", "part", "doc_id").agg(F.count("*").alias("n")).join(marks, "doc_id", "left")
    weighed = weighed.select("key", "part", "n", F.coalesce("good", F.lit(False)).alias("good"), F.coalesce("toxic", F.lit(False)).alias("toxic"))
    parts = durable(rows.groupBy("part").agg(F.count("*").alias("total")))
    return all_orders(parts, count_sets(weighed, failing), sorted(failing))
