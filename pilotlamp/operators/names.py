"""Device names: aliases, workspaces and directories."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pilotlamp.functions import text
from pilotlamp.operators import matching, similar
from pilotlamp.session import durable

DEVICE_THRESHOLD = 65
INDICATOR_THRESHOLD = 62


def alias_index(aliases: DataFrame) -> DataFrame:
    """Every searchable name of a device: canonical, rule, alias and workspace names.

    ``ordinal`` is the device's place; within a device longer names come first, then alphabetical order.
    """
    every = F.array_union(F.array("canonical_name", "rule_name"),
                          F.concat(F.coalesce("aliases", F.array()), F.coalesce("workspace_names", F.array())))
    rows = aliases.select("device_id", F.col("ordinal").alias("device_ordinal"),
                          F.explode(F.array_distinct(F.transform(every, text.clean_text))).alias("name"))
    return rows.filter("name != ''").select(
        "device_id", "name", F.struct("device_ordinal", (-F.length("name")).alias("shorter"), "name").alias("ordinal"))


def resolve_devices(requested: DataFrame, aliases: DataFrame, rules: DataFrame) -> DataFrame:
    """Resolve requested device names: alias names first, then the device names of the rules, else unresolved.

    ``rules`` needs ``device`` and ``ordinal``. Work is done on distinct names.
    """
    names = requested.select(text.clean_text(F.col("device")).alias("name")).distinct()
    index = alias_index(aliases)
    by_alias = matching.best_names(names, index, DEVICE_THRESHOLD)
    hit = by_alias.filter(F.col("choice").isNotNull())
    owner = index.groupBy(F.col("name").alias("choice")).agg(F.max_by("device_id", "ordinal").alias("device_id"))
    info = aliases.select("device_id", "canonical_name", "rule_name",
                          F.coalesce("verified", F.lit(False)).alias("verified"),
                          F.coalesce("workspace_names", F.array()).alias("workspace_names"))
    first = hit.join(owner, "choice").join(info, "device_id").select(
        "name", "device_id", "canonical_name", "rule_name", "verified", "workspace_names",
        F.col("choice").alias("matched_alias"), "score")
    rest = by_alias.filter(F.col("choice").isNull()).select("name")
    devices = rules.groupBy(F.col("device").alias("name")).agg(F.min("ordinal").alias("ordinal"))
    second = matching.best_names(rest, devices, DEVICE_THRESHOLD).select(
        "name", F.lit(None).cast("string").alias("device_id"), F.coalesce("choice", "name").alias("canonical_name"),
        F.col("choice").alias("rule_name"), F.lit(False).alias("verified"),
        F.array().cast("array<string>").alias("workspace_names"), F.col("choice").alias("matched_alias"), "score")
    return first.withColumn("device_id", F.col("device_id").cast("string")).unionByName(second)


def match_indicators(requested: DataFrame, rules: DataFrame) -> DataFrame:
    """Indicator per (device, requested name), among the indicators of that device."""
    choices = rules.groupBy("device", F.col("indicator").alias("name")).agg(F.min("ordinal").alias("ordinal"))
    return matching.best_names(requested, choices, INDICATOR_THRESHOLD, ["device"])


def name_score(f: similar.Facts) -> np.ndarray:
    """Composite score 0..100 of two names, rounded half to even."""
    base = np.maximum(100 * f.ratios[0], np.maximum(100 * f.ratios[1], np.where(f.contained[1], 96.0, 0.0)))
    bonus = np.where(f.marked > 0, 10, 0) + np.minimum(10, 2 * f.shared)
    return np.rint(np.minimum(100.0, base + bonus))


def directory_score(f: similar.Facts) -> np.ndarray:
    """Three parts edit ratio, one part shared words."""
    union = f.tokens[0] + f.tokens[1] - f.shared
    return f.ratios[0] * 0.75 + np.where(union > 0, f.shared / np.maximum(union, 1), 0.0) * 0.25


def _described(names: DataFrame) -> DataFrame:
    n = F.col("name")
    return names.select("name", "ordinal", text.plain_name(n).alias("plain"), text.solid_name(n).alias("solid"),
                        text.name_tokens(n).alias("tokens"))


def map_workspaces(rule_names: DataFrame, workspace_names: DataFrame, review_below: int = 82, k: int = 3) -> DataFrame:
    """Best workspace per rule name, with the ``k`` best candidates and a review flag.

    Review is due below ``review_below`` or when an earlier rule name already took the same workspace.
    """
    left = _described(rule_names).withColumn("models", F.filter("tokens", text.is_model_token))
    right = durable(_described(workspace_names.withColumn("ordinal", F.col("name"))))
    best = similar.best_k(left, right, ["plain", "solid"], "tokens", name_score, k, "models")
    best = best.join(left.select("name", "ordinal", "tokens"), "name").join(right.select(F.col("name").alias("item"), F.col("tokens").alias("its")), "item")
    best = best.withColumn("score", F.col("score").cast("int"))
    rows = best.groupBy("name", "ordinal").agg(
        F.max(F.when(F.col("place") == 1, F.struct(F.col("item").alias("workspace"), F.col("score").alias("score"),
              F.array_intersect("tokens", F.col("its")).alias("overlap")))).alias("b"),
        F.sort_array(F.collect_list(F.struct("place", F.col("item").alias("workspace"), "score"))).alias("top"))
    rows = durable(rows.select("name", "ordinal", "b.workspace", "b.score", "b.overlap", "top"))  # read twice below
    taken = rows.groupBy("workspace").agg(F.min("ordinal").alias("first_ordinal"))
    out = rows.join(taken, "workspace")
    duplicate = F.col("ordinal") > F.col("first_ordinal")
    return out.select(
        "name", "ordinal", text.canonical_id(F.col("name")).alias("device_id"), "workspace",
        F.col("score").alias("confidence"), duplicate.alias("duplicate"),
        ((F.col("score") < review_below) | duplicate).alias("needs_review"), "overlap",
        F.filter("overlap", text.is_model_token).alias("model_tokens"), text.alias_names(F.col("name")).alias("aliases"),
        "top")


def match_directories(sources: DataFrame, packages: DataFrame) -> DataFrame:
    """Package directory per source directory: one equal key, else one clearly best similar name, else none."""
    key = text.letters_key(F.col("name"))
    s = sources.select("name").distinct().withColumn("key", key).withColumn(
        "words", text.keyword_tokens(F.col("name")))
    p = packages.select("name").distinct().withColumn("key", key)
    equal = p.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.min("name").alias("package"))
    direct = s.join(equal, "key").select(
        "name", F.when(F.col("n") == 1, F.col("package")).alias("package"),
        F.when(F.col("n") == 1, 1.0).otherwise(0.0).alias("score"),
        F.when(F.col("n") == 1, "normalized_exact").otherwise("ambiguous_normalized_exact").alias("method"))
    rest = s.join(equal, "key", "left_anti")
    right = durable(p.withColumn("words", text.keyword_tokens(F.col("name"))))
    best = similar.best_k(rest, right, ["key"], "words", directory_score, 2)
    scored = best.select("name", F.col("item").alias("package"), "score", F.col("ratio").alias("seq"), "place")
    return direct.unionByName(_decide(scored))


def _decide(scored: DataFrame) -> DataFrame:
    first, second = F.col("place") == 1, F.col("place") == 2
    rows = scored.groupBy("name").agg(
        F.max(F.when(first, F.col("package"))).alias("package"), F.max(F.when(first, F.col("score"))).alias("score"),
        F.max(F.when(first, F.col("seq"))).alias("seq"),
        F.coalesce(F.max(F.when(second, F.col("score"))), F.lit(0.0)).alias("runner_up"))
    ok = (F.col("score") >= 0.82) & (F.col("seq") >= 0.85) & (F.col("score") - F.col("runner_up") >= 0.08)
    return rows.select("name", F.when(ok, F.col("package")).alias("package"), "score",
                       F.when(ok, "fuzzy_unique").otherwise("no_safe_unique_match").alias("method"))


def find_directories(wanted: DataFrame, directories: DataFrame) -> DataFrame:
    """Directory per name: the same name, else the first equal key, else the only one that contains or is contained."""
    key = text.alnum_key(F.col("name"))
    w = wanted.select("name").distinct().withColumn("key", key)
    d = directories.select("name").distinct().withColumn("key", key)
    by_key = d.groupBy("key").agg(F.min("name").alias("directory"), F.count(F.lit(1)).alias("n"))
    same = w.join(d.select("name").withColumn("same", F.col("name")), "name", "left")
    pairs = matching.contained_pairs(w, d, "key").filter("l_key != r_key")
    inside = pairs.join(by_key.withColumnRenamed("key", "r_key"), "r_key").groupBy(F.col("l_key").alias("key")).agg(
        F.sum("n").alias("hits"), F.min("directory").alias("inside"))
    out = same.join(by_key.select("key", "directory"), "key", "left").join(inside, "key", "left")
    return out.select("name", F.coalesce("same", "directory", F.when(F.col("hits") == 1, F.col("inside")))
                      .alias("directory"))


def workspace_owners(aliases: DataFrame, policy: str = "last") -> DataFrame:
    """Canonical and rule name per workspace, verified aliases only; ``policy`` says which alias wins."""
    rows = aliases.filter("verified").select("canonical_name", "rule_name", "ordinal",
                                             F.explode("workspace_names").alias("workspace"))
    pick = F.max_by if policy == "last" else F.min_by
    return rows.groupBy("workspace").agg(pick(F.struct("canonical_name", "rule_name"), "ordinal").alias("o")).select(
        "workspace", "o.*")
