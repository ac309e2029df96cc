"""File inventories as tables: what each device directory holds."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pilotlamp import vocab
from pilotlamp.functions import text
from pilotlamp.operators import ordered

ANNOTATION_FILE = "annotations.json"
PACKAGE_MARKERS = ["annotations.json", "annotator.html", "classes.txt", "manual_indicator_schema.json"]


def read_inventory(spark: SparkSession, root: str) -> DataFrame:
    """Files below ``root``: device, directory, file name, suffix, size. File content is never read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root).select("path", "length")
    return describe_paths(files, root)


def describe_paths(files: DataFrame, root: str) -> DataFrame:
    base = "/" + root.rstrip("/").split(":", 1)[-1].lstrip("/") + "/"
    at = F.instr("path", F.lit(base))
    below = F.when(at > 0, F.substr("path", at + len(base))).otherwise("")
    parts = F.split(below, "/")
    name = F.element_at(parts, -1)
    folders = F.slice(parts, F.lit(2), F.greatest(F.size(parts) - 2, F.lit(0)))
    return files.select(
        "*", F.get(parts, F.lit(0)).alias("device"), folders.alias("folders"), name.alias("file"),
        F.lower(F.regexp_extract(name, r"(\.[^.]+)$", 1)).alias("suffix")).filter(F.size(parts) >= 2)


def asset_kind(suffix: Column, folders: Column) -> Column:
    """manual / image / video: the directory name decides, and the suffix must fit it."""
    first = F.lower(F.coalesce(F.get(folders, F.lit(0)), F.lit("")))
    kind = F.lit(None).cast("string")
    for name, directories in vocab.ASSET_DIRECTORIES.items():
        kind = F.when(first.isin(*directories) & suffix.isin(*vocab.ASSET_SUFFIXES[name]), name).otherwise(kind)
    return kind


def inventory_by_device(files: DataFrame) -> DataFrame:
    kinds = files.withColumn("kind", asset_kind(F.col("suffix"), F.col("folders"))).filter("kind IS NOT NULL")
    return kinds.groupBy("device").agg(*[F.count_if(F.col("kind") == k).alias(f"{k}_count")
                                         for k in vocab.ASSET_DIRECTORIES])


def corpus_sources(files: DataFrame) -> DataFrame:
    """Files to index: a device's manuals, and global or rule files under the global device."""
    shared = F.col("device").isin("_global", "rules")
    manual = ~F.col("device").startswith("_") & F.array_contains("folders", "manuals")
    kind = F.when(F.col("device") == "_global", "global").when(F.col("device") == "rules", "rule").when(manual, "manual")
    return (files.filter(F.col("suffix").isin(*vocab.CORPUS_SUFFIXES)).withColumn("source_type", kind)
            .filter("source_type IS NOT NULL")
            .withColumn("device", F.when(shared, vocab.GLOBAL_DEVICE).otherwise(F.col("device"))))


def map_names(files: DataFrame) -> DataFrame:
    """Uniform file names: device, kind and 1-based number in path order."""
    ranked = ordered.rank_in_groups(files, ["device", "kind"], [("path", "asc")], "number")
    suffix = F.lower(F.regexp_extract("path", r"(\.[^./]+)$", 1))
    return ranked.withColumn("new_name", F.format_string(
        "%s__%s_%03d%s", text.safe_name(F.col("device")), F.col("kind"), F.col("number"), suffix))


def ready_devices(files: DataFrame) -> DataFrame:
    """Devices with both an annotation file and an image directory."""
    has = files.groupBy("device").agg(
        F.bool_or(F.col("path").endswith(f"/{ANNOTATION_FILE}")).alias("annotations"),
        F.bool_or(F.col("path").contains("/images/")).alias("images"))
    return has.filter(F.col("annotations") & F.col("images")).select("device")


def package_devices(files: DataFrame) -> DataFrame:
    """Devices whose directory carries any marker of an annotation package."""
    name = F.element_at(F.split("path", "/"), -1)
    marked = name.isin(*PACKAGE_MARKERS) | F.col("path").contains("/images/")
    return files.groupBy("device").agg(F.bool_or(marked).alias("m")).filter("m").select("device")
