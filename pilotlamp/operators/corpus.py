"""Document corpus: chunks, ids, upserts, evidence windows, terms and exact vector search."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pilotlamp import vocab
from pilotlamp.functions import arrays, text
from pilotlamp.operators import ordered

CHUNK_SIZE = 700
CHUNK_OVERLAP = 120
EVIDENCE_BATCH = 15_000
META = ["device_name", "source_type", "source_file", "section", "page"]


def pack(pieces: Column, size: int, joiner: str = "\n") -> Column:
    """Join neighbouring pieces while length(current) + length(piece) + 1 stays within ``size``.

    The fold carries lengths only and lists where a text begins and how many pieces it has; each text is joined once.
    """
    kind = "struct<first:int,n:int>"

    def add(acc: Column, chars: Column) -> Column:
        fits, empty = acc["chars"] + chars + 1 <= size, acc["chars"] == 0
        closed = F.when(~empty & ~fits, F.struct(acc["first"].alias("first"), (acc["at"] - acc["first"]).alias("n")))
        opens = empty | ~fits
        state = F.struct((acc["at"] + 1).alias("at"), F.when(opens, acc["at"]).otherwise(acc["first"]).alias("first"),
                         F.when(opens, chars).otherwise(acc["chars"] + len(joiner) + chars).alias("chars"))
        return F.struct(state.alias("state"), closed.alias("out"))

    def close(last: Column, found: Column) -> Column:
        rest = F.struct(last["first"].alias("first"), (last["at"] - last["first"]).alias("n"))
        return F.when(last["chars"] == 0, found).otherwise(F.array_append(found, rest))

    start = F.struct(*[F.lit(0).alias(c) for c in ("at", "first", "chars")])
    return arrays.let(pieces, lambda all_: F.transform(
        arrays.scan(F.transform(all_, F.length), start, add, kind, close),
        lambda t: F.array_join(F.slice(all_, t["first"] + 1, t["n"]), joiner)))


def chunks(body: Column, size: int = CHUNK_SIZE, overlap: int = CHUNK_OVERLAP) -> Column:
    """Paragraphs packed up to ``size`` characters; longer ones cut into slices that overlap."""
    paragraphs = F.filter(F.transform(F.split(text.clean_document(body), "\n+"), text.strip), lambda p: p != "")
    step = size - overlap

    def cut(p: Column) -> Column:
        count = F.ceil((F.length(p) - size) / F.lit(step)) + 1
        starts = F.sequence(F.lit(0), F.greatest(count - 1, F.lit(0)).cast("int"))
        slices = arrays.let(arrays.pieces_of(p, step), lambda pieces: F.transform(
            starts, lambda i: text.strip(arrays.part_of(pieces, step, i * step, F.lit(size), size))))
        return F.when(F.length(p) <= size, F.array(p)).otherwise(slices)

    return F.filter(F.flatten(F.transform(pack(paragraphs, size), cut)), lambda c: c != "")


def chunk_documents(docs: DataFrame, body: str = "text", size: int = CHUNK_SIZE, overlap: int = CHUNK_OVERLAP) -> DataFrame:
    """One row per chunk with its index and content id (over the other columns in order, index and chunk)."""
    keep = [c for c in docs.columns if c != body]
    rows = docs.select(*keep, F.posexplode(chunks(F.col(body), size, overlap)).alias("chunk_index", "chunk"))
    return rows.withColumn("id", text.content_id(*[F.col(c) for c in keep], F.col("chunk_index"), F.col("chunk")))


def batch_windows(windows: Column, size: int = EVIDENCE_BATCH) -> Column:
    return pack(windows, size, "\n\n")


def upsert(old: DataFrame, new: DataFrame, key: str = "id", version: str = "version") -> DataFrame:
    """Latest version per id. An aggregate, so repeated ids shrink before the shuffle."""
    both = old.unionByName(new)
    rest = [c for c in both.columns if c != key]
    return both.groupBy(key).agg(F.max_by(F.struct(*rest), version).alias("r")).select(key, "r.*")


def manifest(chunked: DataFrame, preview: int | None = None) -> DataFrame:
    """Chunks with their length and their text, or its first ``preview`` characters, in one line."""
    start = F.col("chunk") if preview is None else F.substring("chunk", 1, preview)
    return chunked.select("*", F.length("chunk").alias("chars"), F.translate(start, "\n", " ").alias("preview"))


def corpus_stats(chunked: DataFrame, keys: Sequence[str], file: str) -> DataFrame:
    per_file = chunked.groupBy(*keys, file).agg(F.count(F.lit(1)).alias("n"), F.sum(F.length("chunk")).alias("c"))
    return per_file.groupBy(*keys).agg(F.sum("n").alias("chunks"), F.count(F.lit(1)).alias("source_files"),
                                       F.sum("c").alias("chars"))


def _hits(low: Column, word: str) -> Column:
    """0-based positions of non-overlapping occurrences, left to right."""
    def add(at: Column, part: Column) -> Column:
        here = at + F.length(part)
        return F.struct((here + len(word)).alias("state"), here.alias("out"))

    # the last part ends with the text, not with a word
    found = arrays.scan(F.split(low, "\\Q" + word + "\\E", -1), F.lit(0), add, "int",
                        lambda _, found: F.slice(found, F.lit(1), F.size(found) - 1))
    return F.when(low.contains(word), found).otherwise(F.array().cast("array<int>"))


def evidence_windows(body: Column, radius: int = 1000, limit: int | None = None) -> Column:
    """Distinct text windows around evidence words, by position; only the first ``limit`` where that is set."""
    def around(low: Column) -> Column:
        return F.array_sort(F.array_distinct(F.flatten(F.array(*[_hits(low, w.lower()) for w in vocab.EVIDENCE_WORDS]))))

    def window(pieces: Column, i: Column) -> Column:
        first = F.greatest(F.lit(0), i - radius)
        piece = arrays.part_of(pieces, 2 * radius, first, i + radius - first, 2 * radius)
        # most windows have nothing to mend; looking is faster than replacing
        single = arrays.let(piece, lambda p: F.when(p.contains("\n\n\n"), F.regexp_replace(p, "\n{3,}", "\n\n")).otherwise(p))
        return arrays.let(single, lambda p: F.when(
            F.concat(F.substring(p, 1, 1), F.substring(p, -1, 1)).rlike(r"(?U)\s"), text.strip(p)).otherwise(p))

    windows = arrays.let(arrays.pieces_of(body, 2 * radius), lambda pieces: F.transform(
        arrays.let(F.lower(body), around), lambda i: window(pieces, i)))
    found = F.array_distinct(F.filter(windows, lambda w: w != ""))
    return found if limit is None else F.slice(found, 1, limit)


def indicator_terms(docs: DataFrame, key: str, body: str = "text", longest: int | None = None,
                    kept_chars: int | None = None) -> DataFrame:
    """Distinct (label word, line) pairs of manual lines, and common words a text contains.

    ``longest`` leaves out longer lines, ``kept_chars`` keeps the start of a line.
    """
    lines = docs.select(key, F.explode(F.split(body, r"\r\n|[\n\r\x0b\x0c\x1c-\x1e\u0085  ]")).alias("line"))
    lines = lines.select(key, text.strip(F.regexp_replace("line", r"(?U)\s+", " ")).alias("line"))
    found = F.regexp_extract_all("line", F.lit("(?i)" + vocab.TERM_PATTERN), F.lit(1))
    short = F.lit(True) if longest is None else F.length("line") <= longest
    shown = F.col("line") if kept_chars is None else F.substring("line", 1, kept_chars)
    hits = lines.filter((F.col("line") != "") & short).select(
        key, F.explode(F.array_distinct(F.transform(found, F.upper))).alias("keyword"),
        shown.alias("manual_text")).distinct()
    upper = F.upper(body)
    words = F.filter(F.array(*[F.when(upper.contains(w), F.lit(w)) for w in vocab.COMMON_TERM_WORDS]),
                     lambda w: w.isNotNull())
    common = docs.select(key, F.explode(words).alias("keyword"))
    alone = common.join(hits.select(key, "keyword").distinct(), [key, "keyword"], "left_anti")
    return hits.unionByName(alone.withColumn("manual_text", F.col("keyword")))


def source_blocks(found: DataFrame, key: str) -> DataFrame:
    """Context text per question: numbered source blocks by distance. ``found`` holds a bounded top list per key."""
    block = F.format_string("[资料%d] 设备=%s | 文件=%s | 页=%d | 章节=%s\n%s", F.col("place"), F.col("device_name"),
                            F.col("source_file"), F.col("page"), F.col("section"), F.col("text"))
    listed = found.groupBy(key).agg(F.sort_array(F.collect_list(F.struct("place", block.alias("b")))).alias("all"))
    return listed.select(key, F.array_join(F.transform("all", lambda x: x["b"]), "\n\n").alias("context"))


def nearest(queries: DataFrame, items: DataFrame, on: str, k: int, query_rows: int = 4096, item_rows: int = 4096,
            digits: int = 6) -> DataFrame:
    """Exact ``k`` nearest items per query by cosine distance within equal ``on``.

    ``queries``: on, query_id, vector; ``items``: on, item_id, vector. Both sides of an ``on`` are dealt by hash into parts of
    about ``query_rows`` and ``item_rows``; every pair of parts is a tile of its own, on any partition, and only ``k`` rows per
    query leave it. Ties go to the lower id. The number of pairs is quadratic by nature, the memory of a tile is not.
    """
    def parts(df: DataFrame, id_col: str, rows: int, name: str) -> tuple[DataFrame, DataFrame]:
        df = df.filter(F.col(on).isNotNull()).select(on, id_col, "vector")
        width = df.groupBy(on).agg(F.ceil(F.count(F.lit(1)) / F.lit(rows)).alias(f"{name}_parts"))
        return df.join(width, on).withColumn(name, F.pmod(F.xxhash64(id_col, "vector"), F.col(f"{name}_parts"))).drop(f"{name}_parts"), width

    def meet(df: DataFrame, width: DataFrame, name: str) -> DataFrame:
        each = df.join(width, on).withColumn(name, F.explode(F.sequence(F.lit(0).cast("long"), F.col(f"{name}_parts") - 1)))
        # new names of the columns: both sides may come from one table
        return ordered.lay_out(each.select(*[F.col(c).alias(c) for c in each.columns if c != f"{name}_parts"]), on, "asked", "offered")

    asked, asked_parts = parts(queries, "query_id", query_rows, "asked")
    offered, offered_parts = parts(items, "item_id", item_rows, "offered")
    left, right = meet(asked, offered_parts, "offered"), meet(offered, asked_parts, "asked")
    schema = T.StructType([T.StructField("query_id", queries.schema["query_id"].dataType),
                           T.StructField("item_id", items.schema["item_id"].dataType),
                           T.StructField("distance", T.DoubleType())])
    slack = 2 * 10.0 ** -digits  # distances that round alike lie within it

    def unit(table: pa.Table) -> np.ndarray:
        flat = table.column("vector").combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(np.float64)
        m = flat.reshape(table.num_rows, -1)
        norm = np.sqrt((m * m).sum(axis=1, keepdims=True))
        return m / np.where(norm > 0, norm, 1.0)

    def search(queries_: pa.Table, items_: pa.Table) -> pa.Table:
        rows, columns, distances = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0)]
        if queries_.num_rows and items_.num_rows:
            q, m = unit(queries_), unit(items_)
            n = min(k, len(m))
            rank = np.empty(len(m), np.int64)
            rank[pc.sort_indices(items_.column("item_id"), null_placement="at_start").to_numpy()] = np.arange(len(m))
            for at in range(0, len(q), 256):
                near = q[at:at + 256] @ m.T
                least = np.partition(near, len(m) - n, axis=1)[:, len(m) - n]
                row, column = np.nonzero(near >= least[:, None] - slack)
                d = np.round(1.0 - near[row, column], digits) + 0.0
                order = np.lexsort((rank[column], d, row))
                row, column, d = row[order], column[order], d[order]
                place = np.arange(len(row)) - np.searchsorted(row, row)
                rows.append(row[place < n] + at)
                columns.append(column[place < n])
                distances.append(d[place < n])
        return pa.table({"query_id": queries_.column("query_id").take(pa.array(np.concatenate(rows))),
                         "item_id": items_.column("item_id").take(pa.array(np.concatenate(columns))),
                         "distance": pa.array(np.concatenate(distances))})

    tile = [on, "asked", "offered"]
    found = left.groupBy(*tile).cogroup(right.groupBy(*tile)).applyInArrow(search, schema)
    return ordered.top_in_groups(found, ["query_id"], [("distance", "asc"), ("item_id", "asc")], k, "place")


def retrieve(queries: DataFrame, items: DataFrame, k: int = 4, same: Sequence[str] = ()) -> DataFrame:
    """Nearest items of the query's verified workspaces and of the global device, without repeats, by distance.

    ``queries``: query_id, device_name, verified, vector; ``items``: item_id, device_name, vector. A query with
    several workspaces has one row per workspace and gets ``k`` items of each. Of items that agree in the columns
    ``same`` (file, page and text, say) a query keeps the nearest one.
    """
    own = queries.filter(F.col("verified"))
    mine = nearest(own.select(F.col("device_name").alias("on"), F.concat_ws("\u0001", F.col("query_id").cast("string"), "device_name")
                              .alias("query_id"), "vector"),
                   items.select(F.col("device_name").alias("on"), "item_id", "vector"), "on", k)
    mine = mine.withColumn("query_id", F.substring_index("query_id", "\u0001", 1).cast(queries.schema["query_id"].dataType))
    shared = F.lit(vocab.GLOBAL_DEVICE)
    each = queries.groupBy("query_id").agg(F.any_value("vector").alias("vector"))
    common = nearest(each.select(shared.alias("on"), "query_id", "vector"),
                     items.filter(F.col("device_name") == shared).select(F.col("device_name").alias("on"), "item_id", "vector"), "on", k)
    both = mine.unionByName(common).groupBy("query_id", "item_id").agg(F.min("distance").alias("distance"))
    if same:
        named = both.join(items.select("item_id", *same).distinct(), "item_id")
        first = named.groupBy("query_id", *same).agg(F.min(F.struct("distance", "item_id")).alias("f"))
        both = first.select("query_id", "f.item_id", "f.distance")
    # at most k rows per workspace plus k are left per query
    return both.withColumn("place", F.row_number().over(Window.partitionBy("query_id").orderBy("distance", "item_id")))
