"""Mixing sources to target weights: a golden-ratio schedule of slots over equal-token blocks.

A source's documents, shuffled by a hash, form one run of words that is cut into blocks. Slot ``i`` of the schedule
falls at the point ``frac(i * golden ratio)``; the cumulative weights map it to a source, and the r-th slot of a
source takes the source's r-th block, starting anew after the last one. Slots in order, and the pieces of a slot by ``at``,
are the training text. A piece keeps the blanks after its words, and before the first word of its text, so that the
pieces of one epoch make up the text. Columns of the input pass through; one named like a result is replaced. Null sources form one source, null and empty texts have size 0 and are never taken.
Repeated rows are shuffled as rows of their own.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pilotlamp.llm.common import add_columns, col, without
from pilotlamp.session import durable

BLOCK_WORDS = 1024
MIN_BLOCKS = 256  # a source of fewer words has one block for each word
MAX_REPEATS = 3
GOLDEN = 2654435769  # 2**32 / golden ratio
CELLS = 4096  # of the unit interval, for the equi join of slots and sources
CHUNK = 65_536  # slots ranked together

_NUMBERS = ["slot", "epoch", "at", "first_word", "words"]
_PIECE = T.StructType([*[T.StructField(n, T.LongType()) for n in _NUMBERS], T.StructField("text", T.StringType())])
_SLOTS = T.StructType([T.StructField("slots", T.ArrayType(_PIECE))])
_BLANK = np.isin(np.arange(256), [0x20, *range(0x09, 0x0E)])


def size_of(text) -> F.col:
    """Number of words ``[^\\x20\\x09-\\x0D]+``; null: 0."""
    return F.coalesce(F.regexp_count(text, F.lit("[^\\x20\\x09-\\x0D]+")), F.lit(0)).cast("long")


def plan_sources(sized: DataFrame) -> DataFrame:
    """One row per source: size, weight 1, 2, 3 in turn, target and block layout.

    Targets share all words by weight; the water level is the largest that any number of full sources allows.
    """
    by = sized.groupBy("skey", "source").agg(F.sum("size").alias("source_size"))
    number = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last()))
    cap = (F.col("source_size") * MAX_REPEATS).cast("double")
    up = Window.orderBy(F.col("cap") / F.col("weight"), "number")
    before = F.coalesce(F.sum("cap").over(up.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    rest = F.sum("weight").over(up.rowsBetween(0, Window.unboundedFollowing))
    every = Window.orderBy(F.lit(1)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    block = F.greatest(F.lit(1), F.least(F.lit(BLOCK_WORDS), F.expr(f"source_size div {MIN_BLOCKS}")))
    planned = (
        by.withColumn("number", number)
        .withColumn("weight", (F.col("number") - 1) % 3 + 1)
        .withColumn("cap", cap)
        .withColumn("level", (F.sum("source_size").over(every) - before) / rest)
        .withColumn("target", F.least("cap", F.col("weight") * F.max("level").over(every)))
        .withColumn("block", block.cast("long"))
        .withColumn("blocks", F.expr("(source_size + block - 1) div block"))
        .withColumn("slots", F.when(F.col("source_size") > 0, F.col("target") * F.col("blocks") / F.col("source_size")).otherwise(0.0))
    )
    return planned.select("skey", "source_size", "target", "block", "blocks", "number", "slots")


def schedule(sources: DataFrame) -> DataFrame:
    """Slots in order: ``slot, skey, rank, block_no, epoch``; no source is taken more than ``MAX_REPEATS`` times over."""
    spark = sources.sparkSession
    total = int(round(sources.agg(F.sum("slots")).first()[0] or 0))
    before = Window.orderBy("number")
    bounds = (
        sources.where("slots > 0")
        .withColumn("high", F.sum("slots").over(before.rowsBetween(Window.unboundedPreceding, 0)))
        .withColumn("whole", F.sum("slots").over(before.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))
        .withColumn("last", F.lead("number").over(before).isNull())
        .withColumn("low", F.coalesce(F.lag("high").over(before), F.lit(0.0)) / F.col("whole"))
        .withColumn("high", F.when(F.col("last"), F.lit(2.0)).otherwise(F.col("high") / F.col("whole")))
        .withColumn("cell", F.explode(F.sequence(F.floor(F.col("low") * CELLS), F.floor(F.least("high", F.lit(1.0)) * CELLS))))
        .select("cell", "skey", "low", "high", "blocks")
    )
    slots = spark.range(total).select(
        F.col("id").alias("slot"), ((F.col("id") % 2**31 * F.lit(GOLDEN)) % F.lit(2**32) / F.lit(float(2**32))).alias("point")
    ).withColumn("cell", F.floor(F.col("point") * CELLS))
    dealt = slots.join(bounds, "cell").where("point >= low AND point < high").withColumn("chunk", F.expr(f"slot div {CHUNK}"))
    # ranks inside a chunk of slots, plus the slots of the source in the chunks before
    counts = dealt.groupBy("skey", "chunk").agg(F.count("*").alias("n")).withColumn(
        "earlier", F.coalesce(F.sum("n").over(Window.partitionBy("skey").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    ).drop("n")
    rank = F.row_number().over(Window.partitionBy("skey", "chunk").orderBy("slot")) - 1 + F.col("earlier")
    return (
        dealt.join(counts, ["skey", "chunk"]).withColumn("rank", rank).where(F.col("rank") < F.col("blocks") * MAX_REPEATS)
        .select("slot", "skey", "rank", (F.col("rank") % F.col("blocks")).alias("block_no"), F.expr("rank div blocks").alias("epoch"))
    )


def place_words(sized: DataFrame, rows: int) -> DataFrame:
    """``first``: the place of a row's first word in the shuffled run of its source.

    Rows are ranged by their hash, so that a range holds few rows of a source however large the source is.
    """
    digits = 1 if rows < 20_000 else 2 if rows < 2_000_000 else 3 if rows < 200_000_000 else 4
    ranged = sized.withColumn("range", F.substring("hash", 1, digits))
    sums = ranged.groupBy("skey", "range").agg(F.sum("size").alias("n")).withColumn(
        "earlier", F.coalesce(F.sum("n").over(Window.partitionBy("skey").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    ).drop("n")
    within = Window.partitionBy("skey", "range").orderBy("hash", "row").rowsBetween(Window.unboundedPreceding, -1)
    return ranged.join(sums, ["skey", "range"]).withColumn(
        "first", F.col("earlier") + F.coalesce(F.sum("size").over(within), F.lit(0))
    ).drop("range", "earlier")


def pieces(placed: DataFrame, sources: DataFrame) -> DataFrame:
    """The blocks of every row: ``skey, block_no, row, at, first_word, words``.

    ``words`` is the row's share of the block, which begins at word ``at`` of the block and ``first_word`` of the text.
    """
    start, end, block = F.col("first"), F.col("first") + F.col("size"), F.col("block")
    begin, low = F.greatest(start, F.col("block_no") * block), F.col("block_no") * block
    return (
        placed.where("size > 0").join(sources.select("skey", "block"), "skey")
        .withColumn("block_no", F.explode(F.sequence(F.expr("first div block"), F.expr("(first + size - 1) div block"))))
        .select("skey", "block_no", "row", (begin - low).alias("at"), (begin - start).alias("first_word"), (F.least(end, low + block) - begin).alias("words"))
    )


def _cut(text, plan) -> list[pa.Array]:
    """The pieces ``plan`` names, with their texts and the words found in them."""
    counts = pc.fill_null(pc.list_value_length(plan), 0).to_numpy()
    slot, epoch, at, first, words = (x.to_numpy() for x in plan.flatten().flatten())
    found, texts, i = np.zeros(len(slot), np.int64), [], 0
    for t, n in zip(text.cast(pa.binary()), counts, strict=True):
        if not n:
            continue
        data = t.as_py()
        blank = _BLANK[np.frombuffer(data, np.uint8)]
        cuts = np.flatnonzero(~blank & np.append(True, blank[:-1]))
        n_words = len(cuts)
        cuts = np.append(cuts, len(data))
        cuts[0] = 0
        for j in range(i, i + n):
            low, high = min(first[j], n_words), min(first[j] + words[j], n_words)
            found[j] = high - low
            texts.append(data[cuts[low]:cuts[high]])
        i += n
    rows = pa.StructArray.from_arrays([*map(pa.array, (slot, epoch, at, first, found)), pa.array(texts, pa.binary()).view(pa.string())], _PIECE.names)
    return [pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(counts)), pa.int32()), rows)]


def _filled(documents: DataFrame, names: list[str]) -> DataFrame:
    """The columns of ``documents`` that are not named like one of ``names``, then ``names``."""
    kept = without(documents.columns, names)
    sized = durable(documents.select(
        *[col(c).alias(f"c{i}") for i, c in enumerate(kept)], F.col("source"), F.col("text"), size_of(F.col("text")).alias("size"),
        F.coalesce(F.concat(F.lit("s"), F.col("source")), F.lit("n")).alias("skey"),
        F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).alias("hash"), F.monotonically_increasing_id().alias("row"),
    ))
    sources = durable(plan_sources(sized))
    placed = place_words(sized.select("skey", "hash", "row", "size"), sized.count())
    plan = (
        pieces(placed, sources).join(schedule(sources).select("slot", "skey", "block_no", "epoch"), ["skey", "block_no"])
        .groupBy("row").agg(F.sort_array(F.collect_list(F.struct(*_NUMBERS))).alias("plan"))
    )
    columns = [f"c{i}" for i in range(len(kept))]
    # texts meet by row only, so that no source comes together with its texts
    known = sized.select("row", "skey").join(sources.select("skey", "source_size", "target"), "skey").drop("skey").join(plan, "row", "left")
    cut = add_columns(sized.join(known, "row"), ["text", "plan"], _cut, _SLOTS, [*columns, "size", "source_size", "target"])
    return cut.withColumn(
        "taken", F.aggregate("slots", F.lit(0).cast("long"), lambda n, piece: n + piece["words"])
    ).select(*[F.col(c).alias(k) for c, k in zip(columns, kept, strict=True)], *[n for n in names if n != "text"])


def fill_slots(documents: DataFrame) -> DataFrame:
    """The mix: ``documents``, without the text, with ``size, source_size, target, taken, slots``.

    ``slots`` holds what the mix takes of a document, one piece for each slot that takes words of it: ``slot, epoch, at``
    (first word in the slot), ``first_word`` (in the document), ``words`` and their ``text``; ``taken`` counts its words.
    """
    return _filled(documents, ["text", "size", "source_size", "target", "taken", "slots"])


def slot_rows(filled: DataFrame) -> DataFrame:
    """The pieces of ``fill_slots`` as rows: ``slot, at, epoch, source, doc_id, first_word, words, text``, in no order."""
    each = filled.select("source", "doc_id", F.explode("slots").alias("piece"))
    return each.select("piece.slot", "piece.at", "piece.epoch", "source", "doc_id", "piece.first_word", "piece.words", "piece.text")


def mix(documents: DataFrame) -> DataFrame:
    """``documents``, without the text, with ``size, source_size, target, taken``: the words of ``fill_slots``, repeats counted."""
    return _filled(documents, ["text", "size", "source_size", "target", "taken"])
