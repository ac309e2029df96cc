"""Document fingerprints: a Merkle tree over leaves, paragraphs and sections, in DataFrame functions only.

Paragraphs are the lines of a text, leaves their pieces of up to ``LEAF`` code points. A section ends after a paragraph
whose hash ends in 0 or 1, so an edit moves no boundary but its own. A node's hash covers the hashes below it: equal roots
mean equal texts, and only branches that differ have to be looked into. The fingerprint is the root, then the first six digits
of every leaf hash, with a dot after each paragraph and a bar after each section.

A null text reads as empty. Rows with a null ``doc_id`` come first in the order of documents; rows with equal ids are
ordered by a hash of their texts, rows equal in both are each other's neighbours. Columns of the input other than the id
are not returned. An empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

LEAF, CODE = 32, 6
BUCKET_ROWS, MAX_BUCKETS = 2000, 16_384
ENDS = ("0", "1")


def with_tree(df: DataFrame, text: Column, name: str) -> DataFrame:
    """``df`` with ``{name}_root``, ``{name}_sections``, ``{name}_paragraphs`` (hashes), ``{name}_fingerprint`` and ``{name}_leaves`` (distinct codes)."""
    lines = F.split(text, "\n", -1)
    hashed = df.withColumn(f"_{name}", F.transform(lines, lambda p: F.transform(F.regexp_extract_all(p, F.lit(f"[^\\n]{{1,{LEAF}}}"), F.lit(0)), F.md5)))
    codes = lambda p: F.transform(p, lambda h: F.substr(h, F.lit(1), F.lit(CODE)))
    out = hashed.withColumn(f"_{name}_p", F.transform(f"_{name}", lambda p: F.struct(F.md5(F.array_join(p, "")).alias("hash"), codes(p).alias("codes"))))
    end = lambda h: F.when(F.substr(h, F.lit(32)).isin(*ENDS), "|").otherwise("")
    bounds = F.split(F.array_join(F.transform(f"_{name}_p", lambda p: F.concat(p["hash"], F.lit("."), end(p["hash"]))), ""), "\\|", -1)
    shape = F.array_join(F.transform(f"_{name}_p", lambda p: F.concat(F.array_join(p["codes"], ""), F.lit("."), end(p["hash"]))), "")
    out = out.withColumn(f"{name}_sections", F.transform(bounds, F.md5))
    return (
        out.withColumn(f"{name}_root", F.sha2(F.array_join(f"{name}_sections", ""), 256))
        .withColumn(f"{name}_fingerprint", F.concat(f"{name}_root", F.lit(":"), shape))
        .withColumn(f"{name}_paragraphs", F.transform(f"_{name}_p", lambda p: p["hash"]))
        .withColumn(f"{name}_leaves", F.array_distinct(F.flatten(F.transform(f"_{name}_p", lambda p: p["codes"]))))
        .drop(f"_{name}", f"_{name}_p")
    )


def likeness(a: str, b: str) -> Column:
    """1 for equal roots, else the share of common leaves in the larger of two trees."""
    common = F.size(F.array_intersect(f"{a}_leaves", f"{b}_leaves"))
    share = common / F.greatest(F.size(f"{a}_leaves"), F.size(f"{b}_leaves"), F.lit(1))
    return F.when(F.col(f"{a}_root") == F.col(f"{b}_root"), 1.0).otherwise(share)


def edited_paragraphs(old: str, new: str) -> Column:
    """Hashes of the paragraphs of ``new`` that ``old`` lacks; none where the roots are equal."""
    lacking = F.array_except(f"{new}_paragraphs", f"{old}_paragraphs")
    return F.when(F.col(f"{old}_root") == F.col(f"{new}_root"), F.slice(lacking, 1, 0)).otherwise(lacking)


def _bucket(cuts: list[int]) -> Column:
    """How many of the sorted cuts are not above ``doc_id``: a coarse and a fine search."""
    step = max(1, int(len(cuts) ** 0.5))
    coarse = F.array(*[F.lit(c) for c in cuts[::step]])
    whole = F.array(*[F.lit(c) for c in cuts])
    below = F.size(F.filter(coarse, lambda c: c <= F.col("doc_id")))
    start = F.greatest(below - 1, F.lit(0)) * step
    fine = F.size(F.filter(F.slice(whole, start + 1, F.lit(step)), lambda c: c <= F.col("doc_id")))
    return start + fine


def beside_next(documents: DataFrame) -> tuple[DataFrame, Window]:
    """Rows in ranges of ``doc_id`` with the window that orders a range; the first row of a range also ends the range before.

    The texts are shuffled once. ``copy`` marks the rows that only serve as neighbours.
    """
    rows = documents.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    n, first, nulls = rows.agg(F.count("*"), F.min("doc_id"), F.count_if(F.col("doc_id").isNull())).first()
    buckets = min(max(1, n // BUCKET_ROWS), MAX_BUCKETS)
    cuts: list[int] = []
    if buckets > 1:
        shares = [i / buckets for i in range(1, buckets)]
        cuts = sorted(set(rows.agg(F.percentile_approx("doc_id", shares, 20 * buckets)).first()[0] or []))
        cuts = [c for c in cuts if c > first]
    rows = rows.withColumn("own", _bucket(cuts) if cuts else F.lit(0))
    own = F.col("own")
    is_cut = F.get(F.array(*[F.lit(c) for c in cuts]), own - 1) == F.col("doc_id") if cuts else F.lit(False)
    wraps = F.col("doc_id").eqNullSafe(F.lit(None if nulls else first).cast("long"))
    places = F.array(
        F.struct(own.alias("bucket"), F.lit(False).alias("copy"), F.lit(False).alias("wrap")),
        F.when(is_cut, F.struct((own - 1).alias("bucket"), F.lit(True).alias("copy"), F.lit(False).alias("wrap"))),
        F.when(wraps, F.struct(F.lit(len(cuts)).alias("bucket"), F.lit(True).alias("copy"), F.lit(True).alias("wrap"))),
    )
    dealt = rows.withColumn("place", F.explode(F.filter(places, lambda p: p.isNotNull()))).select("doc_id", "text", "place.*")
    order = Window.partitionBy("bucket").orderBy("wrap", F.col("doc_id").asc_nulls_first(), "text_hash", "copy")
    return dealt.withColumn("text_hash", F.xxhash64("text")), order


def fingerprint_edits(documents: DataFrame) -> DataFrame:
    """Every document's fingerprint, that of its edited text, and likenesses; see the contract of the query."""
    rows, order = beside_next(documents)
    n = F.char_length("text")
    rows = rows.withColumn("n_chars", n.cast("long")).withColumn("next_text", F.lead("text").over(order))
    quarter = F.expr("cast(n_chars div 4 as int)")
    edited = F.concat(F.substr("text", F.lit(1), (F.col("n_chars") - quarter).cast("int")), F.substr("next_text", F.lit(1), quarter))
    rows = with_tree(rows.withColumn("edited", edited).drop("next_text"), F.col("text"), "own").drop("text")
    rows = rows.withColumn("next_root", F.lead("own_root").over(order)).withColumn("next_leaves", F.lead("own_leaves").over(order)).where("NOT copy")
    rows = with_tree(rows, F.col("edited"), "edited")
    return rows.select(
        "doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), F.col("own_fingerprint").alias("fingerprint"), "edited_fingerprint",
        likeness("own", "edited").alias("near_edited"), likeness("own", "next").alias("near_next"), F.size(edited_paragraphs("own", "edited")).alias("n_edited_paragraphs"),
    )
