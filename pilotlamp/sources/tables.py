"""Readers and writers of manifests, label files, class lists and detection payloads."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pilotlamp.operators.judge import REQUEST


MARK = "\ufeff"


def read_manifest(spark: SparkSession, path: str, columns: Sequence[str]) -> DataFrame:
    """CSV with a header, columns picked by name; all strings, empty cells stay empty strings.

    A byte order mark is dropped and quoted cells may hold line breaks. A missing column is an error, and so are
    parts of a folder whose headers differ.
    """
    rows = spark.read.option("header", True).option("enforceSchema", False).option("escape", '"').option("multiLine", True).csv(path)
    rows = rows.toDF(*[c.removeprefix(MARK) for c in rows.columns])
    return rows.select(*columns).fillna("")


def write_manifest(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """CSV parts, each with a byte order mark and a header; arrays become ' | ' lists.

    Quotes in cells are doubled and blanks around them kept, so that ``read_manifest`` gives the same cells back
    (NULL as an empty string).
    """
    flat = [F.array_join(F.col(f.name).cast("array<string>"), " | ").alias(f.name)
            if isinstance(f.dataType, T.ArrayType) else F.col(f.name) for f in df.schema.fields]
    out = df.select(*flat)
    first = next(c for c in out.columns if c not in partition_by)
    out.withColumnRenamed(first, MARK + first).write.partitionBy(*partition_by).mode("error").csv(
        path, header=True, escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)


def read_label_files(spark: SparkSession, path: str) -> DataFrame:
    """file, line_no (from 1), line. A label file is one image's boxes; line numbers need the file in one row."""
    raw = spark.read.format("binaryFile").option("pathGlobFilter", "*.txt").option("recursiveFileLookup", True).load(path)
    body = F.regexp_replace(F.regexp_replace(F.decode("content", "UTF-8"), r"(?U)^\s+", ""), r"(?U)\s+$", "")
    rows = raw.select(F.element_at(F.split("path", "/"), -1).alias("file"), body.alias("body")).filter("body <> ''")
    return rows.select("file", F.posexplode(F.split("body", "\r\n|\n|\r")).alias("i", "line")).select(
        "file", (F.col("i") + 1).alias("line_no"), "line")


def write_labels(label_bodies: DataFrame, path: str) -> None:
    """Label files as text, one folder per image below its split (``split=.../image=...``); pages follow each other.

    An image without boxes has a file with one empty line.
    """
    rows = label_bodies.repartition("split", "image").sortWithinPartitions("split", "image", "page")
    rows.select("split", "image", "body").write.partitionBy("split", "image").mode("error").text(path)


def read_class_lines(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path)


def read_payloads(spark: SparkSession, path: str) -> DataFrame:
    """Detection payloads, one JSON object per line; broken lines keep their text in ``_corrupt_record``."""
    schema = T.StructType([*REQUEST.fields, T.StructField("_corrupt_record", T.StringType())])
    return spark.read.schema(schema).option("columnNameOfCorruptRecord", "_corrupt_record").json(path)


def stream_payloads(spark: SparkSession, path: str, files_per_batch: int = 16) -> DataFrame:
    return spark.readStream.schema(REQUEST).option("maxFilesPerTrigger", files_per_batch).json(path)
