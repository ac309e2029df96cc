"""The indicator catalogue of a device: merging, de-duplication and retrieval by visual evidence."""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pilotlamp.functions import text
from pilotlamp.operators import matching, ordered
from pilotlamp.session import durable

AMBIGUOUS_FROM = 72
FIELDS = ["short_label", "module", "location_hint", "evidence"]


def _given(df: DataFrame, name: str) -> Column:
    return F.trim(F.coalesce(F.col(name), F.lit(""))) if name in df.columns else F.lit("")


def first_seen(rows: DataFrame, keys: Sequence[str], value: Column, same: Column, position: Column,
               out_col: str = "values") -> DataFrame:
    """Distinct non-empty values per group in first-seen order; values with an equal ``same`` key count once."""
    v = rows.select(*keys, value.alias("v"), same.alias("s"), position.alias("p")).filter("coalesce(v, '') <> ''")
    once = v.groupBy(*keys, "s").agg(F.min(F.struct("p", "v")).alias("pv"))
    return once.groupBy(*keys).agg(F.transform(F.sort_array(F.collect_list("pv")), lambda x: x["v"]).alias(out_col))


def merge_candidates(items: DataFrame) -> DataFrame:
    """Merge proposals for one light: same short label and module, or same name when there is no label.

    ``items``: device, name, short_label, module, ordinal (and optional location_hint, evidence, states).
    State-only names are dropped. The longest name wins, other fields take the first non-empty value,
    states are united in first-seen order. Numbered by (module, name).

    A second merge of the result by short label and module finds nothing: the entries of one label take a short label with
    that key if any of them has one and else a name with that label, and entries merged by name have no label at all.
    """
    rows = items.filter(~text.is_state_only(F.col("name"))).select(
        "device", "ordinal", F.trim("name").alias("name"), *[_given(items, c).alias(c) for c in FIELDS],
        F.col("states") if "states" in items.columns else F.lit(None).cast("array<struct<state:string,meaning:string>>")
        .alias("states"))
    label = text.short_label_of(F.col("name"), F.col("short_label"))
    module = text.letters_key(F.col("module"))
    key = F.when(label != "", F.concat_ws("|", F.lit("label"), label, module)).otherwise(
        F.concat_ws("|", F.lit("name"), text.letters_key(F.col("name"))))
    rows = rows.withColumn("merge_key", key)
    pos = F.col("ordinal")
    merged = rows.groupBy("device", "merge_key").agg(
        F.max_by("name", F.struct(F.length("name"), -pos)).alias("name"),
        *[F.coalesce(F.min_by(c, F.when(F.col(c) != "", pos)), F.lit("")).alias(c) for c in FIELDS],
        F.count(F.lit(1)).alias("merged"), F.min(pos).alias("ordinal"))
    named = rows.withColumn("states", F.filter("states", lambda s: F.coalesce(s["state"], F.lit("")) != ""))
    out = merged.join(united_states(named, ["device", "merge_key"]), ["device", "merge_key"], "left")
    out = out.withColumn("_pl_m", text.letters_key(F.col("module"))).withColumn("_pl_n", text.letters_key(F.col("name")))
    return number(out, [("_pl_m", "asc"), ("_pl_n", "asc"), ("ordinal", "asc")]).drop("_pl_m", "_pl_n")


def united_states(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Distinct states per group, ordered by the row that names them first and their place in it."""
    each = rows.select(*keys, "ordinal", F.posexplode("states").alias("i", "state")).filter("state IS NOT NULL")
    once = each.groupBy(*keys, "state").agg(F.min(F.struct("ordinal", "i")).alias("p"))
    return once.groupBy(*keys).agg(F.transform(F.sort_array(F.collect_list(F.struct("p", "state"))), lambda x: x["state"])
                                   .alias("states"))


def number(items: DataFrame, order: ordered.Order, out_col: str = "class_id") -> DataFrame:
    """Dense class ids from 0 per device."""
    return ordered.rank_in_groups(items, ["device"], order, out_col).withColumn(out_col, F.col(out_col) - 1)


def group_key(name: Column, short_label: Column, mode: str) -> Column:
    if mode == "semantic":
        return text.semantic_key(name, short_label)
    if mode == "strict":
        return F.concat(F.lit("STRICT:"), text.catalog_key(name))
    if mode == "none":
        return F.concat(F.lit("NONE:"), F.uuid())
    raise ValueError(f"unknown mode {mode!r}")


def deduplicate(items: DataFrame, mode: str = "semantic") -> DataFrame:
    """One entry per semantic family (per equal name in ``strict`` mode, per row in mode ``none``) and device.

    The name is the family's display name, else the shortest. Modules, locations, evidence, states and other names are united
    in first-seen order; states are equal when all their fields are. ``merged`` counts the entries; ``merge_report`` lists those
    of more than one.
    """
    rows = items.withColumn("name", F.trim("name")).filter("coalesce(name, '') <> ''")
    rows = rows.withColumn("key", group_key(F.col("name"), _given(items, "short_label"), mode))
    if mode == "none":
        rows = durable(rows)  # its keys are drawn once
    pos = F.col("ordinal")
    base = rows.groupBy("device", "key").agg(
        F.min_by("name", F.struct(F.length("name"), pos)).alias("shortest"),
        F.min_by(F.coalesce("short_label", F.lit("")), pos).alias("short_label"),
        F.count(F.lit(1)).alias("merged"), pos_min(pos))
    name = F.coalesce(text.preferred_name(F.col("key")), F.col("shortest"))
    base = base.withColumn("name", name).drop("shortest")
    same = lambda c: text.catalog_key(F.col(c))
    names = first_seen(rows, ["device", "key"], F.col("name"), same("name"), pos, "names")
    modules = first_seen(rows, ["device", "key"], _given(items, "module"), same("module"), pos, "modules")
    out = base.join(names, ["device", "key"]).join(modules, ["device", "key"], "left")
    for given, united in (("location_hint", "location_hints"), ("evidence", "evidences")):
        if given in items.columns:
            listed = first_seen(rows, ["device", "key"], F.col(given), text.catalog_key(F.col(given)), pos, united)
            out = out.join(listed, ["device", "key"], "left")
    if "states" in items.columns:
        out = out.join(united_states(rows, ["device", "key"]), ["device", "key"], "left")
    own = text.catalog_key(F.col("name"))
    out = out.withColumn("aliases", F.filter("names", lambda x: text.catalog_key(x) != own))
    out = out.withColumn("_pl_k", text.semantic_key(F.col("name"), F.col("short_label"))).withColumn("_pl_n", own)
    return number(out, [("_pl_k", "asc"), ("_pl_n", "asc"), ("ordinal", "asc")]).drop("_pl_k", "_pl_n")


def merge_report(deduplicated: DataFrame) -> DataFrame:
    """Entries that unite several rows: how many, under which name, and the names that went in."""
    return deduplicated.filter("merged > 1").select("device", "key", "name", "merged", "names")


def pos_min(pos: Column) -> Column:
    return F.min(pos).alias("ordinal")


def ambiguous_pairs(entries: DataFrame, threshold: int = AMBIGUOUS_FROM) -> DataFrame:
    """Entries of one device with similar names and different semantic families."""
    e = entries.select("device", "class_id", "name", text.catalog_key(F.col("name")).alias("key"),
                       text.semantic_key(F.col("name"), F.coalesce("short_label", F.lit(""))).alias("family"))
    near = matching.fuzzy_pairs(e, e, "key", threshold, ["device"])
    a = e.select("device", *[F.col(c).alias(f"{c}_a") for c in ("class_id", "name", "family")], F.col("key").alias("l_key"))
    b = e.select("device", *[F.col(c).alias(f"{c}_b") for c in ("class_id", "name", "family")], F.col("key").alias("r_key"))
    pairs = near.join(a, ["device", "l_key"]).join(b, ["device", "r_key"])
    return pairs.filter((F.col("class_id_a") < F.col("class_id_b")) & (F.col("family_a") != F.col("family_b"))).select(
        "device", F.col("class_id_a").alias("class_a"), F.col("name_a"), F.col("class_id_b").alias("class_b"), F.col("name_b"),
        F.round(1.0 - F.col("distance") / F.col("longest"), 3).alias("similarity"))


def with_manual_text(entries: DataFrame) -> DataFrame:
    """Searchable text and tokens of an entry: name, aliases, modules, locations, evidence, states."""
    def listed(c: str) -> Column:
        return F.array_join(c, " ") if c in entries.columns else F.lit(None)

    parts = [F.col("name"), listed("aliases"), listed("modules"), listed("location_hints"),
             F.col("evidence") if "evidence" in entries.columns else F.lit(None)]
    manual = F.concat_ws(" | ", *[F.nullif(p, F.lit("")) for p in parts])
    return entries.withColumn("manual_text", text.print_key(manual)).withColumn("manual_tokens", text.print_tokens(manual))


WEIGHTS = {"near": (8, 30), "place": (4, 12), "equal": (100, 100), "label": (75, 75), "module": (38, 38), "interface": (32, 32)}  # a hit, at most

HITS = 1_000_000  # of one partition, on average


def evidence_hits(asked: DataFrame, entries: DataFrame) -> DataFrame:
    """``e_id, class_id`` of every piece of evidence and entry of its device that have something in common, with their score.

    Tokens meet in posting lists by (device, token); texts inside a manual text are found by their rarest piece. Each hit adds its weight.
    Hits are laid out by evidence before they are counted, in partitions whose number grows with them, so that no task holds more as tables grow.
    """
    tokens = {"near": F.col("e_nearby"), "place": F.col("e_place"), "equal": F.filter(F.array("e_label"), lambda x: x != "")}
    wanted = [asked.select("device", "e_id", F.lit(kind).alias("kind"), F.explode(F.array_distinct(c)).alias("token")) for kind, c in tokens.items()]
    postings = entries.select("device", "class_id", F.explode(F.array_distinct("manual_tokens")).alias("token"))
    wanted = reduce(DataFrame.unionByName, wanted)
    by_token = wanted.join(postings, ["device", "token"]).select("e_id", "class_id", "kind")

    texts = {"label": F.when(F.length("e_label") >= 3, F.col("e_label")), "module": F.col("e_module"), "interface": F.col("e_interface")}
    inner = durable(reduce(DataFrame.unionByName, [
        asked.select("device", "e_id", F.lit(kind).alias("kind"), c.alias("key")).filter("key != ''") for kind, c in texts.items()]))
    bodies = entries.select("device", "class_id", F.col("manual_text").alias("key"))
    pairs = durable(matching._inside(matching._keys(inner, "key", ["device"]), matching._keys(bodies, "key", ["device"]), ["device"]))
    by_text = pairs.join(inner, ["device", "key"]).join(bodies.withColumnRenamed("key", "stack"), ["device", "stack"]).select("e_id", "class_id", "kind")

    def sizes(rows: DataFrame, *on: str) -> DataFrame:
        return rows.groupBy("device", *on).agg(F.count("*").alias("_" + on[0]))

    stacks = bodies.withColumnRenamed("key", "stack")
    of_token = sizes(wanted, "token").join(sizes(postings, "token").withColumnRenamed("_token", "_n"), ["device", "token"]).select((F.col("_token") * F.col("_n")).alias("n"))
    of_text = pairs.join(sizes(inner, "key"), ["device", "key"]).join(sizes(stacks, "stack"), ["device", "stack"]).select((F.col("_key") * F.col("_stack")).alias("n"))
    n = of_token.unionByName(of_text).agg(F.sum("n")).first()[0] or 0
    parts = max(int(asked.sparkSession.conf.get("spark.sql.shuffle.partitions")), math.ceil(n / HITS))
    counts = by_token.unionByName(by_text).repartition(parts, "e_id").groupBy("e_id", "class_id").agg(*[F.count_if(F.col("kind") == kind).alias(kind) for kind in WEIGHTS])
    points = {kind: F.least(F.col(kind) * each, F.lit(most)) for kind, (each, most) in WEIGHTS.items()}
    label = F.greatest(points.pop("equal"), points.pop("label"))
    return counts.select("e_id", "class_id", reduce(lambda x, y: x + y, points.values(), label).cast("int").alias("score"))


def retrieve_entries(evidence: DataFrame, entries: DataFrame, k: int = 5) -> DataFrame:
    """The ``k`` best entries of the device per piece of evidence; ties keep catalogue order.

    Equal evidence is scored once: ``evidence`` rows are reduced to distinct ones and joined back. Entries without a hit
    follow in catalogue order; they come from one short list per device.
    """
    text_of = lambda c: F.coalesce(c, F.lit(""))
    columns = ["device", "label_text", "module_text", "interface_text", "nearby_text", "relative_position"]
    nearby = F.array_distinct(F.flatten(F.transform(F.coalesce("nearby_text", F.array().cast("array<string>")),
                                                    text.print_tokens)))
    asked = durable(evidence.select(*columns).distinct().select(
        *columns, text.print_key(text_of("label_text")).alias("e_label"), text.print_key(text_of("module_text"))
        .alias("e_module"), text.print_key(text_of("interface_text")).alias("e_interface"), nearby.alias("e_nearby"),
        text.print_tokens(text_of("relative_position")).alias("e_place"), F.monotonically_increasing_id().alias("e_id")))
    right = durable(with_manual_text(entries).select("device", "class_id", "name", "manual_text", "manual_tokens"))
    order = [("score", "desc"), ("class_id", "asc")]
    hits = ordered.top_in_groups(evidence_hits(asked, right), ["e_id"], order, k, "place").drop("place")
    # k hits at most are among the first entries, so 2k of them hold k without any
    first = ordered.top_in_groups(right.select("device", "class_id"), ["device"], [("class_id", "asc")], 2 * k, "place").drop("place")
    plain = asked.select("device", "e_id").join(first, "device").select("e_id", "class_id", F.lit(0).alias("score"))
    every = hits.unionByName(plain).groupBy("e_id", "class_id").agg(F.max("score").alias("score"))
    best = ordered.top_in_groups(every, ["e_id"], order, k, "place").join(asked.select("e_id", *columns), "e_id")
    found = best.join(right.select("device", "class_id", F.col("name").alias("class_name")), ["device", "class_id"])
    cond = F.lit(True)
    e, f = evidence.alias("e"), found.alias("f")
    for c in columns:
        cond = cond & F.col(f"e.{c}").eqNullSafe(F.col(f"f.{c}"))
    return e.join(f, cond).select("e.*", "f.class_id", "f.class_name", "f.score", "f.place")


def match_terms(prints: DataFrame, terms: DataFrame) -> DataFrame:
    """Term of a recognised print, accepted only when exactly one term is contained in it.

    ``prints``: print_id, ocr_text, visual_score; ``terms``: keyword. Distinct texts are matched once.
    """
    p = prints.withColumn("key", F.upper(F.coalesce("ocr_text", F.lit(""))))
    t = terms.select(F.upper("keyword").alias("key"), "keyword").groupBy("key").agg(
        F.min("keyword").alias("keyword"), F.count(F.lit(1)).alias("n"))
    inside = matching._inside(matching._keys(t, "key", []), matching._keys(p, "key", []), [])
    hits = inside.join(t, "key").groupBy(F.col("stack").alias("key")).agg(
        F.sum("n").alias("hits"), F.min("keyword").alias("keyword")).filter("hits = 1")
    j = p.join(hits, "key", "left")
    v = F.col("visual_score")
    known = F.col("keyword").isNotNull()
    return j.select(
        *prints.columns, F.coalesce("keyword", F.lit("unknown_indicator")).alias("label"),
        F.round(F.when(known, F.least(F.lit(0.95), v * 0.35 + 0.55)).otherwise(F.least(F.lit(0.55), v * 0.30 + 0.25)), 4)
        .alias("confidence"))


def class_text(entries: DataFrame, aliases: int | None = None, evidence_chars: int | None = None) -> Column:
    """One line describing an allowed class; the limits keep its first aliases and the start of its evidence."""
    def labelled(prefix: str, value: Column) -> Column:
        return F.when(F.coalesce(value, F.lit("")) != "", F.concat(F.lit(prefix), value))

    def listed(c: str) -> Column:
        if c not in entries.columns:
            return F.lit(None)
        return F.array_join(F.col(c) if aliases is None else F.slice(F.col(c), 1, aliases), " / ")

    evidence = _given(entries, "evidence")
    evidence = evidence if evidence_chars is None else F.substring(evidence, 1, evidence_chars)

    return F.concat_ws(
        "；", F.concat(F.col("class_id").cast("string"), F.lit(": "), F.trim("name")),
        labelled("模块=", _given(entries, "module")), labelled("位置=", _given(entries, "location_hint")),
        labelled("别名=", listed("aliases")), labelled("说明书=", evidence))


def parse_class_lines(lines: DataFrame) -> DataFrame:
    """``id: name`` lines to a class dictionary; lines without a numeric id are skipped."""
    pattern = r"^\s*(\d+)\s*:(.*)$"
    return lines.filter(F.col("value").rlike(pattern)).select(
        *[c for c in lines.columns if c != "value"], F.regexp_extract("value", pattern, 1).cast("int").alias("class_id"),
        text.strip(F.regexp_extract("value", pattern, 2)).alias("name"))


def dense_classes(names: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Ids 0..max per group; missing ids are named ``class_i``."""
    top = names.groupBy(*keys).agg(F.max("class_id").alias("_pl_top"))
    ids = top.select(*keys, F.explode(F.sequence(F.lit(0), F.col("_pl_top"))).alias("class_id"))
    return ids.join(names, [*keys, "class_id"], "left").withColumn(
        "name", F.coalesce("name", F.concat(F.lit("class_"), F.col("class_id").cast("string"))))
