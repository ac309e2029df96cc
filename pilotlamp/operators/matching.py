"""Name matching without cross joins.

``contained_pairs`` and ``fuzzy_pairs`` find candidates through shared two-character pieces and then test
them exactly. The piece filters lose no match: the bounds follow from the q-gram lemma. Rare pieces are
used first, so frequent ones ("brand", "video") do not pair everything with everything.
Best-k names without a lossless bound on shared pieces are in ``similar``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pilotlamp.functions import similarity, text
from pilotlamp.operators import ordered
from pilotlamp.session import durable


def _keys(df: DataFrame, key: str, on: Sequence[str]) -> DataFrame:
    return df.select(*on, F.col(key).alias("key")).filter(F.coalesce(F.col("key"), F.lit("")) != "").distinct()


def _pieces(key: Column) -> Column:
    """Distinct single characters and two-character pieces."""
    at = F.sequence(F.lit(1), F.length(key))
    ones = F.transform(at, lambda i: F.substr(key, i, F.lit(1)))
    twos = F.transform(at, lambda i: F.substr(key, i, F.lit(2)))
    return F.array_distinct(F.concat(ones, twos))


def _needle_pieces(key: Column) -> Column:
    twos = F.transform(F.sequence(F.lit(1), F.greatest(F.length(key) - 1, F.lit(1))),
                       lambda i: F.substr(key, i, F.lit(2)))
    return F.array_distinct(twos)


def _inside(needles: DataFrame, stacks: DataFrame, on: Sequence[str]) -> DataFrame:
    """Pairs (key, stack) where the needle is contained in the stack: probe with its rarest piece."""
    index = stacks.select(*on, F.col("key").alias("stack"), F.explode(_pieces(F.col("key"))).alias("piece"))
    common = index.groupBy("piece").agg(F.count(F.lit(1)).alias("uses"))
    probes = needles.select(*on, "key", F.explode(_needle_pieces(F.col("key"))).alias("piece"))
    # a piece that no stack has rules the needle out, and as the rarest one it joins with nothing
    rarest = (probes.join(common, "piece", "left")
              .groupBy(*on, "key").agg(F.min_by("piece", F.struct(F.coalesce("uses", F.lit(0)), "piece")).alias("piece")))
    return ordered.spread(rarest, "key").join(index, [*on, "piece"]).filter(F.col("stack").contains(F.col("key"))).select(*on, "key", "stack")


def contained_pairs(left: DataFrame, right: DataFrame, key: str, on: Sequence[str] = ()) -> DataFrame:
    """Distinct key pairs (l_key, r_key) where one contains the other."""
    a, b = _keys(left, key, on), _keys(right, key, on)
    ab = _inside(a, b, on).select(*on, F.col("key").alias("l_key"), F.col("stack").alias("r_key"))
    ba = _inside(b, a, on).select(*on, F.col("stack").alias("l_key"), F.col("key").alias("r_key"))
    return ab.unionByName(ba).distinct()


def fuzzy_pairs(left: DataFrame, right: DataFrame, key: str, threshold: int, on: Sequence[str] = ()) -> DataFrame:
    """Distinct key pairs with a Levenshtein ratio of at least ``threshold`` percent, with their distance.

    Two keys with ratio t share at least (2t-1)*L+1 of their padded two-character pieces, L being the
    longer length. So their rarest len+2-required pieces must meet; only those are joined.
    """
    if not 50 < threshold <= 100:
        raise ValueError("the piece filter needs a threshold above 50")
    share = 2 * threshold / 100 - 1
    a, b = _keys(left, key, on), _keys(right, key, on)

    def exploded(d: DataFrame) -> DataFrame:
        return d.select(*on, "key", F.explode(similarity.bigrams(F.col("key"))).alias("piece"))

    ea, eb = exploded(a), exploded(b)
    common = ea.unionByName(eb).groupBy("piece").agg(F.count(F.lit(1)).alias("uses"))

    def prefix(e: DataFrame) -> DataFrame:
        size = F.length("key") + 2 - F.ceil(F.length("key") * share + 1 - 1e-9)
        return (e.join(common, "piece").groupBy(*on, "key")
                .agg(F.sort_array(F.collect_list(F.struct("uses", "piece"))).alias("all"))
                .select(*on, "key", F.explode(F.slice("all", F.lit(1), size.cast("int"))).alias("p"))
                .select(*on, "key", F.col("p.piece").alias("piece")))

    # both sides are laid out by the join key, so the join adds no shuffle
    pairs = (ordered.lay_out(prefix(ea), *on, "piece").withColumnRenamed("key", "l_key")
             .join(ordered.lay_out(prefix(eb), *on, "piece").withColumnRenamed("key", "r_key"), [*on, "piece"]).drop("piece"))
    longest = F.greatest(F.length("l_key"), F.length("r_key"))
    allowed = longest * (100 - threshold)
    near = pairs.filter(F.abs(F.length("l_key") - F.length("r_key")) * 100 <= allowed)
    near = ordered.lay_out(near, "l_key", "r_key").distinct()
    return (near.withColumn("distance", F.levenshtein("l_key", "r_key"))
            .filter(F.col("distance") * 100 <= allowed).withColumn("longest", longest))


def best_names(requested: DataFrame, choices: DataFrame, threshold: int, on: Sequence[str] = ()) -> DataFrame:
    """First choice with an equal key (100), else the first that contains or is contained (95), else the most
    similar one above ``threshold``. ``requested``: name; ``choices``: name, ordinal. Ties go to the lower ordinal.
    """
    # distinct names are few next to the rows they come from; every tier below reads them again
    want = durable(requested.select(*on, "name").distinct().withColumn("key", text.compact_key(F.col("name"))))
    first = durable(choices.withColumn("key", text.compact_key(F.col("name"))).groupBy(*on, "key").agg(
        F.min(F.struct("ordinal", "name")).alias("c")))
    keys = want.select(*on, "key").distinct()
    choice = first.select(*on, F.col("key").alias("r_key"), F.col("c.ordinal").alias("ordinal"),
                          F.col("c.name").alias("choice"))

    def pick(pairs: DataFrame, score: Column) -> DataFrame:
        scored = pairs.join(choice, [*on, "r_key"]).withColumn("score", score)
        return scored.groupBy(*on, "l_key").agg(
            F.min_by(F.struct("choice", "score"), F.struct(-F.col("score"), F.col("ordinal"))).alias("m"))

    exact = keys.join(first, [*on, "key"], "left_semi")
    equal = pick(exact.select(*on, F.col("key").alias("l_key"), F.col("key").alias("r_key")), F.lit(100))
    rest = keys.join(exact, [*on, "key"], "left_anti")
    inside = durable(pick(contained_pairs(rest, first, "key", on), F.lit(95)))
    rest = rest.join(inside.withColumnRenamed("l_key", "key"), [*on, "key"], "left_anti")
    close = F.floor((F.col("longest") - F.col("distance")) * 100 / F.col("longest")).cast("int")
    near = pick(fuzzy_pairs(rest, first, "key", threshold, on), close)
    found = equal.unionByName(inside).unionByName(near).withColumnRenamed("l_key", "key")
    return want.join(found, [*on, "key"], "left").select(
        *on, "name", F.col("m.choice").alias("choice"), F.coalesce("m.score", F.lit(0)).alias("score"))
