"""URL filters as a temporal list join, in DataFrame functions only.

List entries are dated: at ``dated`` a list of a ``category`` gains (``add``) or loses (``remove``) a ``pattern`` of ``kind``
``host`` (that host), ``domain`` (it and all below) or ``prefix`` (a host with leading path segments). Entries become validity
intervals, and each capture is held against those that are open when it was fetched, to the instant: a date is its
midnight. Captures are reduced to distinct keys and times before the join, which meets intervals by key and ``BIN_DAYS``
days, so that neither a host with most captures nor a pattern with a long history multiplies rows.

A null or unreadable url, a null time and a capture without keys match nothing and are kept. An entry with a null field is void. Of
entries equal but for the action, at one time, a removal wins. Repeated captures are judged alike. Columns of
the captures pass through; those named like a result are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pilotlamp.llm.common import col, without

BIN_DAYS = 32
ALLOW = "allow"  # entries of this category overrule all others


def host_of(url: Column) -> Column:
    """Lower-case host of an absolute url, else an empty string."""
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), "^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:@]+)", 1))


def segments_of(url: Column) -> Column:
    """Path segments that are not empty, without query and fragment."""
    path = F.regexp_extract(F.coalesce(url, F.lit("")), "^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)", 1)
    return F.filter(F.split(path, "/"), lambda s: s != "")


def intervals(entries: DataFrame) -> DataFrame:
    """``key, category, since, until``: when each listed pattern was on its list; ``until`` is null while it still is."""
    known = entries.dropna(subset=["kind", "pattern", "category", "action", "dated"])
    one = known.groupBy("kind", "pattern", "category", "dated").agg(F.max("action").alias("action"))
    order = Window.partitionBy("kind", "pattern", "category").orderBy("dated")
    spans = one.withColumn("until", F.lead("dated").over(order)).where("action = 'add'")
    key = F.concat(F.substr("kind", F.lit(1), F.lit(1)), F.lit(":"), F.lower("pattern"))
    prefix = F.concat(F.lit("p:"), F.lower(F.substring_index("pattern", "/", 1)), F.expr("substring(pattern, length(substring_index(pattern, '/', 1)) + 1)"))
    return spans.select(F.when(F.col("kind") == "prefix", prefix).otherwise(key).alias("key"), "category", F.col("dated").alias("since"), "until")


def keys_of(host: Column, segments: Column, depth: int) -> Column:
    """All keys under which a url may be listed; ``depth`` is that of the deepest listed prefix."""
    labels = F.split(host, "\\.")
    domains = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.concat(F.lit("d:"), F.array_join(F.slice(labels, i, F.size(labels)), ".")))
    levels = F.sequence(F.lit(0), F.least(F.size(segments), F.lit(depth)))
    prefixes = F.transform(levels, lambda i: F.concat(F.lit("p:"), F.array_join(F.concat(F.array(host), F.slice(segments, 1, i)), "/")))
    keys = F.concat(F.array(F.concat(F.lit("h:"), host)), domains, prefixes)
    return F.when(host == "", F.expr("cast(array() as array<string>)")).otherwise(keys)


def judge(captures: DataFrame, entries: DataFrame) -> DataFrame:
    """``captures`` (``url``, ``fetched``) with ``n_active``, ``categories`` of the open entries and ``blocked``."""
    names = ["n_active", "categories", "blocked"]
    kept = without(captures.columns, names)
    depth = entries.where("kind = 'prefix'").agg(F.max(F.size(F.split("pattern", "/"))).alias("d")).first()[0] or 1
    rows = captures.select(*[col(c).alias(f"c{i}") for i, c in enumerate(kept)], F.coalesce("url", F.lit("")).alias("u"), F.col("fetched").cast("timestamp").alias("at"))
    each = rows.where("u != '' AND at IS NOT NULL").select("u", "at").distinct()
    keyed = each.select("u", "at", F.explode(keys_of(host_of(F.col("u")), segments_of(F.col("u")), depth - 1)).alias("key"))
    asked = keyed.select("key", "at").distinct().withColumn("bin", F.floor(F.unix_date(F.to_date("at")) / BIN_DAYS))
    first, last = (F.lit(x).cast("date") for x in rows.agg(F.to_date(F.min("at")), F.to_date(F.max("at"))).first())
    known = intervals(entries).withColumns({"since": F.col("since").cast("timestamp"), "until": F.col("until").cast("timestamp")})
    since_day, until_day = F.greatest(F.to_date("since"), first), F.least(F.coalesce(F.to_date("until"), last), last)
    bins = F.sequence(F.floor(F.unix_date("since_day") / BIN_DAYS), F.floor(F.unix_date("until_day") / BIN_DAYS))
    spans = (
        known.withColumns({"since_day": since_day, "until_day": until_day}).where("since_day <= until_day").withColumn("bin", F.explode(bins))
        .select("key", "bin", "category", "since", "until")
    )
    found = asked.join(spans, ["key", "bin"]).where("at >= since AND (until IS NULL OR at < until)").select("key", "at", "category").distinct()
    per_key = found.groupBy("key", "at").agg(F.count("*").alias("n"), F.collect_set("category").alias("names"))  # a few categories
    verdict = (
        keyed.join(per_key, ["key", "at"]).groupBy("u", "at")
        .agg(F.sum("n").alias("n_active"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("names")))).alias("names"))
    )
    allowed = F.array_contains("names", ALLOW)
    judged = rows.join(verdict, ["u", "at"], "left")
    return judged.select(
        *[F.col(f"c{i}").alias(c) for i, c in enumerate(kept)], F.coalesce("n_active", F.lit(0)).alias("n_active"),
        F.coalesce(F.array_join("names", ","), F.lit("")).alias("categories"),
        (F.col("names").isNotNull() & ~F.coalesce(allowed, F.lit(False))).alias("blocked"),
    )
