"""The rule base: from table cells to normalised rules, overrides, checks and summaries."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pilotlamp import vocab
from pilotlamp.functions import arrays, text
from pilotlamp.operators import ordered
from pilotlamp.operators.judge import KEY
from pilotlamp.session import durable

NESTED_RULES = T.MapType(T.StringType(), T.StructType([
    T.StructField("normal_state_description", T.StringType()),
    T.StructField("indicators", T.MapType(T.StringType(), T.StructType([
        T.StructField("rules", T.ArrayType(T.StructType([
            T.StructField(c, T.StringType()) for c in
            ("color", "color_raw", "state", "state_raw", "meaning", "severity", "rule_source")])))])))]))
RAW = ["device_name", "indicator_name", "color_raw", "state_raw", "meaning"]


def flatten_rules(documents: DataFrame, column: str = "body") -> DataFrame:
    """Nested device -> indicator -> rules JSON to one row per rule."""
    keep = [c for c in documents.columns if c != column]
    parsed = ordered.once(documents, "doc", F.from_json(column, NESTED_RULES))
    devices = parsed.select(*keep, F.explode("doc").alias("device", "info"))
    lamps = devices.select(*keep, "device", F.col("info.normal_state_description").alias("normal_state"),
                           F.explode("info.indicators").alias("indicator", "detail"))
    return lamps.select(*keep, "device", "normal_state", "indicator", F.inline("detail.rules"))


def header_position(keys: Column, logical: str) -> Column:
    """0-based index of a logical column among lower-case compact cells: exact header word first, contained word second, else NULL."""
    words = sorted({w.replace(" ", "").lower() for w in vocab.HEADER_WORDS[logical]})
    exact = F.array_position(F.transform(keys, lambda k: k.isin(*words)), True)
    part = F.array_position(F.transform(keys, lambda k: text._contains_any(k, words)), True)
    return F.coalesce(F.nullif(exact, F.lit(0).cast("long")), F.nullif(part, F.lit(0).cast("long"))).cast("int") - 1


def find_headers(cells: DataFrame, scan_rows: int | None = None) -> DataFrame:
    """Header row per table: the first row that names most logical columns, among the first ``scan_rows`` if set."""
    head = ordered.spread(cells if scan_rows is None else cells.filter(F.col("row_index") < scan_rows), "table_index", "row_index")
    keys = F.transform("cells", lambda c: F.lower(text.compact_cell(c)))
    at = ordered.once(head.select("table_index", "row_index", keys.alias("keys")), "at", arrays.let(
        F.col("keys"), lambda k: F.struct(*[header_position(k, c).alias(c) for c in vocab.HEADER_WORDS])))
    named = sum((F.col(f"at.{c}").isNotNull().cast("int") for c in vocab.HEADER_WORDS), F.lit(0))
    best = at.withColumn("named", named).groupBy("table_index").agg(
        F.max_by(F.struct("row_index", "at", "named"), F.struct("named", -F.col("row_index"))).alias("h"))
    return best.select("table_index", F.col("h.row_index").alias("header_row"), F.col("h.at").alias("at"),
                       F.col("h.named").alias("named"))


def table_report(cells: DataFrame, scan_rows: int | None = None) -> DataFrame:
    """Per table: whether it can be parsed, and why not."""
    reason = (F.when(F.col("named") < 3, "no_header")
              .when(F.col("at.device_name").isNull() | F.col("at.indicator_name").isNull(), "no_device_or_indicator")
              .otherwise("ok"))
    rows = cells.groupBy("table_index").agg(F.count(F.lit(1)).alias("row_count"))
    return (rows.join(find_headers(cells, scan_rows), "table_index", "left")
            .select("table_index", "row_count", F.coalesce(reason, F.lit("no_header")).alias("reason")))


def extract_rules(cells: DataFrame) -> DataFrame:
    """Table cells to normalised rule rows.

    Device, indicator, colour and normal state are filled down inside a table (merged cells); state and
    meaning are not. Repeated header rows update the carried values and are then skipped.
    """
    usable = durable(find_headers(cells).filter(
        (F.col("named") >= 3) & F.col("at.device_name").isNotNull() & F.col("at.indicator_name").isNotNull()))
    # words are read before values are filled down, on all partitions; a filled word keeps what it was read as
    body = ordered.spread(cells, "table_index", "row_index").join(usable, "table_index").filter(F.col("row_index") > F.col("header_row"))
    body = ordered.once(body, "clean", F.transform("cells", text.clean_cell))
    rows = body.select("table_index", "row_index", *[
        F.nullif(F.get("clean", F.col(f"at.{c}")), F.lit("")).alias(c) for c in vocab.HEADER_WORDS])
    headers = sorted({w.replace(" ", "").lower() for w in vocab.HEADER_WORDS["device_name"]})
    rows = ordered.once(rows, "known_state", text.rule_state(F.col("state")))
    rows = rows.withColumns({
        "known_color": F.when(F.col("color").isNotNull(), text.rule_color(F.col("color"))),
        "severity": text.severity_of(F.coalesce("meaning", F.lit("")), F.col("known_state")),
        "heads": F.when(F.col("device_name").isNotNull(), F.lower(text.compact_cell(F.col("device_name"))).isin(*headers))})
    filled = ordered.fill_down(rows, ["table_index"], [("row_index", "asc")],
                               ["device_name", "heads", "indicator_name", "color", "known_color", "normal_state"])
    blank = F.lit("")
    filled = filled.filter(F.coalesce(*[F.col(c) for c in vocab.HEADER_WORDS]).isNotNull() & ~F.coalesce("heads", F.lit(False)))
    return filled.select(
        "table_index", (F.col("row_index") + 1).alias("source_row_index"),
        F.coalesce("device_name", blank).alias("device_name"), F.coalesce("indicator_name", blank).alias("indicator_name"),
        F.coalesce("color", blank).alias("color_raw"), F.coalesce("known_color", F.lit("unknown")).alias("color"),
        F.coalesce("state", blank).alias("state_raw"), F.col("known_state").alias("state"), F.coalesce("meaning", blank).alias("meaning"),
        F.coalesce("normal_state", blank).alias("normal_state"), "severity")


def drop_repeated(rows: DataFrame, keys: Sequence[str] = RAW,
                  order: Sequence[str] = ("table_index", "source_row_index")) -> DataFrame:
    """Keep the first row of every key. An aggregate, so copies shrink before the shuffle."""
    rest = [c for c in rows.columns if c not in keys]
    first = rows.groupBy(*keys).agg(F.min_by(F.struct(*rest), F.struct(*order)).alias("r"))
    return first.select(*[F.col(c) if c in keys else F.col(f"r.{c}").alias(c) for c in rows.columns])


def nest_rules(rows: DataFrame, page_rows: int = 1000) -> DataFrame:
    """Entries per device, indicator and state in source order, in pages of bounded length."""
    named = rows.filter((F.col("device_name") != "") & (F.col("indicator_name") != ""))
    entry = F.struct("color", "color_raw", "state_raw", "meaning", "severity")
    return ordered.pages(named.withColumn("state", F.coalesce(F.nullif("state", F.lit("")), F.lit("unknown"))),
                         ["device_name", "indicator_name", "state"],
                         [("table_index", "asc"), ("source_row_index", "asc")], entry, "entries", page_rows)


def device_texts(rows: DataFrame) -> DataFrame:
    """First non-empty normal-state text per device, and colours per indicator in first-seen order."""
    pos = F.struct("table_index", "source_row_index")
    normal = rows.groupBy("device_name").agg(
        F.min_by(F.col("normal_state"), F.when(F.col("normal_state") != "", pos)).alias("normal_state_description"))
    known = rows.filter((F.col("color") != "") & (F.col("color") != "unknown"))
    colors = known.groupBy("device_name", "indicator_name", "color").agg(F.min(pos).alias("pos")).groupBy(
        "device_name", "indicator_name").agg(F.transform(
            F.sort_array(F.collect_list(F.struct("pos", "color"))), lambda x: x["color"]).alias("colors"))
    return colors.join(normal, "device_name")


def merge_custom(base: DataFrame, custom: DataFrame) -> DataFrame:
    """Custom rules replace the first base rule with the same condition, else they are appended.

    The latest custom rule of a condition wins. ``ordinal`` keeps list order: a replacement takes the
    place of the rule it replaces, an appended rule comes after all base rules.
    """
    columns = [*KEY, "severity", "meaning"]
    latest = custom.groupBy(*KEY).agg(
        F.max_by(F.struct("severity", "meaning", "ordinal"), F.struct("updated_at", "ordinal")).alias("c"))
    replaced = (base.join(latest.select(*KEY), KEY, "left_semi").groupBy(*KEY)
                .agg(F.min("ordinal").alias("base_ordinal")))
    gone = replaced.withColumnRenamed("base_ordinal", "ordinal")
    kept = base.join(gone, [*KEY, "ordinal"], "left_anti").select(
        *columns, F.col("ordinal").cast("long").alias("ordinal"), F.lit("base").alias("rule_source"))
    placed = latest.join(replaced, KEY, "left").select(
        *KEY, F.col("c.severity").alias("severity"), F.col("c.meaning").alias("meaning"),
        F.coalesce("base_ordinal", F.lit(1 << 40) + F.col("c.ordinal")).cast("long").alias("ordinal"),
        F.lit("custom").alias("rule_source"))
    return kept.unionByName(placed)


def check_custom(custom: DataFrame, base: DataFrame, colors: Sequence[str] = (),
                 states: Sequence[str] = ()) -> DataFrame:
    """First failing check per custom rule, the default alarm, and whether the indicator is new."""
    devices = base.select("device").distinct().withColumn("known_device", F.lit(True))
    lamps = base.select("device", "indicator").distinct().withColumn("known_indicator", F.lit(True))
    j = custom.join(devices, "device", "left").join(lamps, ["device", "indicator"], "left")
    severity = F.lower(F.trim("severity"))
    problem = F.when(~severity.isin(*vocab.SEVERITY_RANK), "bad_severity").when(
        F.col("known_device").isNull(), "unknown_device")
    if colors:
        problem = problem.when(~F.col("color").isin(*colors), "bad_color")
    if states:
        problem = problem.when(~F.col("state").isin(*states), "bad_state")
    return j.select(*[c for c in custom.columns if c != "alarm"], problem.alias("problem"),
                    F.coalesce("alarm", severity.isin("warning", "critical")).alias("alarm"),
                    F.col("known_indicator").isNull().alias("new_indicator"))


def summarize(rules: DataFrame) -> DataFrame:
    """Per device: indicators, rules and counts of critical, warning and unknown rules."""
    per_lamp = rules.groupBy("device", "indicator").agg(
        F.count(F.lit(1)).alias("n"), *[F.count_if(F.col("severity") == s).alias(s)
                                        for s in ("critical", "warning", "unknown")])
    return per_lamp.groupBy("device").agg(
        F.count(F.lit(1)).alias("indicator_count"), F.sum("n").alias("rule_count"),
        *[F.sum(s).alias(f"{s}_count") for s in ("critical", "warning", "unknown")])


def catalogue(rules: DataFrame) -> DataFrame:
    """Per device: sorted indicator names and their number."""
    lamps = rules.groupBy("device").agg(F.array_sort(F.collect_set("indicator")).alias("indicators"))
    return lamps.withColumn("indicator_count", F.size("indicators"))


def expected_indicators(rules: DataFrame) -> DataFrame:
    return catalogue(rules).select("device", F.array_join("indicators", " | ").alias("expected"))


def class_universe(rules: DataFrame) -> DataFrame:
    return rules.select(F.concat_ws("::", "device", "indicator").alias("class_name")).distinct()


def linearize(rows: DataFrame, columns: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """Rows as ``col: value | col: value`` lines; blank cells are left out, blank rows dropped."""
    cells = [F.when(text.clean_document(F.col(c)) != "", F.concat(F.lit(f"{c}: "), text.clean_document(F.col(c))))
             for c in columns]
    return rows.select(*keep, F.concat_ws(" | ", *cells).alias("line")).filter(F.col("line") != "")


def linearize_cells(cells: DataFrame) -> DataFrame:
    """Table rows as lines of cells; rows without text are dropped."""
    clean = F.transform("cells", text.clean_document)
    return cells.filter(F.exists(clean, lambda c: c != "")).select(
        "table_index", "row_index", F.array_join(clean, " | ").alias("line"))


def first_header(df: DataFrame) -> str | None:
    """The column that names the device, by the order of the header list."""
    return next((c for c in vocab.DEVICE_HEADERS if c in df.columns), None)


def index_names(df: DataFrame) -> DataFrame:
    """Distinct device names of a dataset index; empty when no header is known."""
    column = first_header(df)
    if column is None:
        return df.sparkSession.createDataFrame([], "name string")
    return df.select(text.clean_text(F.col(column)).alias("name")).filter("name != ''").distinct()
