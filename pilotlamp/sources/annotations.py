"""Annotation JSON and model answers as box rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pilotlamp.functions import arrays, text
from pilotlamp.operators import ordered

BOX = T.StructType([
    T.StructField("class_id", T.IntegerType()), T.StructField("class_name", T.StringType()),
    *[T.StructField(c, T.DoubleType()) for c in ("x", "y", "w", "h")]])
DOCUMENT = T.StructType([
    T.StructField("device_name", T.StringType()), T.StructField("names", T.MapType(T.StringType(), T.StringType())),
    T.StructField("annotations", T.MapType(T.StringType(), T.ArrayType(BOX)))])
ANSWER = T.StructType([
    T.StructField("found", T.BooleanType()), T.StructField("bbox_2d", T.ArrayType(T.DoubleType())),
    T.StructField("bbox", T.ArrayType(T.DoubleType()))])


def explode_annotations(documents: DataFrame, column: str) -> DataFrame:
    """One row per box; an image without boxes stays as one row of NULLs (a negative)."""
    keep = [c for c in documents.columns if c != column]
    doc = ordered.once(documents, "doc", F.from_json(column, DOCUMENT))
    images = doc.select(*keep, F.col("doc.device_name").alias("device"), F.explode("doc.annotations").alias("filename", "list"))
    rows = images.select(*keep, "device", "filename", F.posexplode_outer("list").alias("ann_idx", "box"))
    return rows.select(*keep, "device", "filename", "ann_idx", "box.*")


def class_names(documents: DataFrame, column: str) -> DataFrame:
    """Class dictionary of annotation documents."""
    doc = ordered.once(documents, "doc", F.from_json(column, DOCUMENT))
    return doc.select(F.col("doc.device_name").alias("device"), F.explode("doc.names").alias("id", "name")).select(
        "device", F.col("id").try_cast("int").alias("class_id"), "name")


def box_of_answer(answer: Column) -> Column:
    """Box array of a model answer: ``bbox_2d``, else ``bbox``."""
    return arrays.let(F.from_json(text.json_object(answer), ANSWER), lambda a: F.coalesce(a["bbox_2d"], a["bbox"]))
