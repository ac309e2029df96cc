"""N-gram Jaccard join by chosen paths.

A document is the set of its word shingles. Documents with equal sets form one member, so copies never meet each other.
Members are split recursively on sampled shared tokens of their min-hash embedding: a node passes a member on along each
token ``(place, value)`` whose hash with the node falls under ``1 / (similarity * places)``, so that members with a
shared token can follow it together. Buckets of at most ``SMALL`` members are compared at once, larger ones are split
again, and those that stay large at the last depth are compared in tiles. Independent runs are added until the recall at
the threshold reaches its target, in two waves. Components of members known to be alike come from the first wide buckets, whose members
all meet about ``PIVOTS`` of them, and again from the whole first wave. Buckets that lie in one component are dropped, for those could only
give links inside a candidate group that is checked pair by pair anyway. Where at least half of a large bucket, or all but ``SMALL`` of it, lies in one component,
the others meet its members, who do not meet each other, and only the others are split again. The sketches compared there are at most about
as many as the component has pairs, which are checked anyway. So a wide group of near copies is hardly split at all, a large one in the first wave. Members whose sketches look
alike form candidate groups; inside those every pair is checked exactly on whole shingle sets, in tiles of bounded size, and links are counted in the tile.

Null texts and texts without words have no shingles: they link to nothing, and each is a class of its own. Fewer words than a
shingle give one shingle of all words. Repeated rows are copies: they share a class and count as links. Classes and copies are
told apart by keys made of the sets: ids may be null or repeat and are labels only. Columns of the input other than the id are
not returned. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import math
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pilotlamp.llm.common import add_columns, col, whole_groups, words
from pilotlamp.session import durable

SHINGLE, SIMILARITY, RECALL = 5, 0.8, 0.999
PLACES = 64  # of the embedding
DEPTH, SMALL = 4, 100
WAVE = 3  # runs of the first wave; the second has the others
PIVOTS = 16  # of a wide bucket, on average
WIDE = 10 * PIVOTS  # members of one; below that pivots spare little
LOOSE = 0.15  # what an estimate may lack, three deviations
TILE, TILE_SHINGLES = 1024, 1_500_000  # members and shingles in one side of a tile
BROADCAST_ROWS = 500_000  # ids of 16 bytes

_PRINT = T.StructType().add("member", T.BinaryType()).add("size", T.IntegerType()).add("sketch", T.BinaryType())
_SET = T.StructType().add("member", T.BinaryType()).add("shingles", T.BinaryType())
_MIX = (np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))
_STEP = np.uint64(0x9E3779B97F4A7C15)


def _mix(x: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * _MIX[0]
        x = (x ^ (x >> np.uint64(27))) * _MIX[1]
        return x ^ (x >> np.uint64(31))


class _Words(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) > 500_000:  # a cache only
            self.clear()
        h = self[word] = xxhash.xxh64_intdigest(word)
        return h


_WORD = _Words()


def shingles(tokens: list[bytes], size: int = SHINGLE) -> np.ndarray:
    """Sorted distinct hashes of the shingles."""
    if not tokens:
        return np.zeros(0, np.uint64)
    h = np.fromiter((_WORD[w] for w in tokens), dtype=np.uint64, count=len(tokens))
    n = min(size, len(h))
    total = np.zeros(len(h) - n + 1, np.uint64)
    with np.errstate(over="ignore"):
        for i in range(n):
            total = total * _STEP + h[i:len(h) - n + 1 + i]
    return np.unique(_mix(total))


_SEEDS = _mix(np.arange(1, PLACES + 1, dtype=np.uint64) * _STEP) | np.uint64(1)


def sketch(found: np.ndarray) -> np.ndarray:
    """Least value of the set under each of ``PLACES`` hash functions, 32 bits each."""
    out = np.empty(PLACES, np.uint32)
    with np.errstate(over="ignore"):
        for j, seed in enumerate(_SEEDS):
            out[j] = (((found ^ seed) * seed) >> np.uint64(32)).min()
    return out


def _print(text) -> list[pa.Array]:
    ids, sizes, sketches = [], [], []
    for t in text.cast(pa.binary()).to_pylist():
        s = shingles(words(t))
        sizes.append(len(s))
        ids.append(hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None)
        sketches.append(sketch(s).tobytes() if len(s) else None)
    return [pa.array(ids, pa.binary()), pa.array(sizes, pa.int32()), pa.array(sketches, pa.binary())]


def _survival(depth: int) -> float:
    """Chance that a pair at the threshold meets in some bucket of ``depth``: one shared child a node on average."""
    p = 1.0
    for _ in range(depth):
        p = 1 - math.exp(-p)
    return p


def runs_for(recall: float = RECALL, depth: int = DEPTH) -> int:
    return math.ceil(math.log(1 - recall) / math.log(1 - _survival(depth)))


def _children(paths: np.ndarray, sketches: np.ndarray, similarity: float) -> tuple[np.ndarray, np.ndarray]:
    """Rows and buckets of the children of nodes ``paths``, one for each row of ``sketches``."""
    limit = np.uint64(int(2**64 / (similarity * PLACES)))
    with np.errstate(over="ignore"):
        token = _mix(sketches.astype(np.uint64) + (np.arange(PLACES, dtype=np.uint64) << np.uint64(32)))
        key = _mix(token + paths[:, None] * _STEP)
    row, place = np.nonzero(key < limit)
    return row, _mix(key[row, place] + _STEP).view(np.int64)


def _sketches(column) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint32).reshape(-1, PLACES)


def _split(members: DataFrame, similarity: float, runs: range | None = None) -> DataFrame:
    """``bucket, member, root`` of the next level; members at the root of the trees go through all of ``runs``."""

    def split(batches):
        for b in batches:
            for at in range(0, b.num_rows, 2000):
                part = b.slice(at, 2000)
                s, ids, known = _sketches(part.column(1)), part.column(0), part.column(2)
                if runs:
                    starts = [np.full(len(s), x, np.uint64) for x in _mix(np.arange(runs.start + 1, runs.stop + 1, dtype=np.uint64))]
                else:
                    starts = [part.column(3).to_numpy().view(np.uint64)]
                for paths in starts:
                    rows, buckets = _children(paths, s, similarity)
                    rows = pa.array(rows)
                    yield pa.RecordBatch.from_arrays([pa.array(buckets), ids.take(rows), known.take(rows)], ["bucket", "member", "root"])

    columns = ["member", "sketch", "root"] if runs else ["member", "sketch", "root", "bucket"]
    return members.select(*columns).mapInArrow(split, "bucket long, member binary, root binary")


def _candidates(members: DataFrame, similarity: float, recall: float, small: int, tile: int) -> DataFrame:
    """``member, root`` of the candidate groups that all runs give together."""
    brief = members.select("member", _brief_of(F.col("sketch")).alias("brief"))
    stars, found = [], None
    for runs in (range(WAVE), range(WAVE, max(runs_for(recall), WAVE + 1))):
        known = members.select("member", "sketch", F.lit(None).cast("binary").alias("root"))
        if found is not None:
            known = members.select("member", "sketch").join(_roots(found), "member", "left")
        nodes = durable(_split(known, similarity, runs))
        for level in range(1, DEPTH + 1):
            in_one = (F.count("root") == F.count("*")) & (F.min("root") == F.max("root"))
            sizes = nodes.groupBy("bucket").agg(F.count("*").alias("n"), F.coalesce(in_one, F.lit(False)).alias("in_one")).where("n > 1 AND NOT in_one").drop("in_one")
            shared = durable(nodes.join(sizes, "bucket"))
            last = level == DEPTH
            large, leaf = shared.where(F.col("n") > small), shared.where(F.col("n") <= small)
            wide = large.where(F.col("n") > WIDE)
            if found is None and not wide.isEmpty():
                found = components(_alike(_dealt_pivots(wide.join(brief, "member"), tile), similarity))
                large = durable(large.drop("root").join(_roots(found), "member", "left"))
                stars.append(found)
            if found is not None:
                main = durable(_main_roots(large, small))
                around = large.join(main, "bucket")
                stars.append(durable(_alike(_dealt_around(around.join(brief, "member"), tile), similarity)))
                rest = around.where(~F.col("root").eqNullSafe(F.col("main"))).withColumn("n", F.col("n") - F.col("part")).where("n > 1")
                large = durable(large.join(main, "bucket", "left_anti").unionByName(rest.select(*large.columns)))
            leaf = leaf.unionByName(large if last else large.where(F.col("n") <= small))
            large = large.where(F.col("n") > small)
            leaf = _tiled(leaf.join(brief, "member"), "bucket", F.ceil(F.col("n") / tile))
            stars.append(durable(_alike(leaf, similarity)))
            if last or large.isEmpty():
                break
            nodes = durable(_split(large.join(members.select("member", "sketch"), "member"), similarity))
        found = components(reduce(DataFrame.unionByName, stars))
        stars = [found]
    return found


def _roots(found: DataFrame) -> DataFrame:
    """Stars with a row for each root itself."""
    return found.unionByName(found.select(F.col("root").alias("member"), "root").distinct())


def _main_roots(large: DataFrame, small: int) -> DataFrame:
    """``bucket, main, part``: the component that at least half of a bucket's members, or all but ``small``, lie in, and how many do."""
    parts = large.where("root IS NOT NULL").groupBy("bucket", "n", "root").agg(F.count("*").alias("part"))
    most = parts.groupBy("bucket", "n").agg(F.max(F.struct("part", "root")).alias("most"))
    return most.where(F.col("n") - F.col("most.part") <= F.greatest("most.part", F.lit(small))).select("bucket", F.col("most.root").alias("main"), "most.part")


_APART = b""  # a root of members that are not to meet each other


def _dealt_pivots(rows: DataFrame, tile: int) -> DataFrame:
    """Tiles of buckets: about ``PIVOTS`` members, chosen by hash, are in each, the others are dealt over them and meet only those."""
    blocks = F.ceil(F.col("n") / tile)
    pivot = F.pmod(F.xxhash64("bucket", "member"), F.col("n")) < PIVOTS
    own = F.when(pivot, F.sequence(F.lit(0).cast("long"), blocks - 1)).otherwise(F.array(F.pmod(F.xxhash64("member"), blocks)))
    dealt = rows.withColumn("root", F.when(~pivot, F.lit(_APART))).withColumn("_block", F.explode(own))
    return dealt.withColumn("tile", F.xxhash64("bucket", "_block")).withColumn("side", F.lit(0)).drop("_block")


def _dealt_around(rows: DataFrame, tile: int) -> DataFrame:
    """Tiles of buckets with a main component: each block of its members meets each block of the others."""
    is_main = F.col("root").eqNullSafe(F.col("main"))
    of_main, of_rest = F.ceil(F.col("part") / tile), F.ceil((F.col("n") - F.col("part")) / tile)
    own = F.pmod(F.xxhash64("member"), F.when(is_main, of_main).otherwise(of_rest))
    met = F.sequence(F.lit(0).cast("long"), F.when(is_main, of_rest).otherwise(of_main) - 1)
    dealt = rows.where("n > part").withColumn("_own", own).withColumn("_met", F.explode(met))
    tile_id = F.xxhash64("bucket", F.when(is_main, F.col("_own")).otherwise(F.col("_met")), F.when(is_main, F.col("_met")).otherwise(F.col("_own")))
    return dealt.withColumn("tile", tile_id).withColumn("side", F.lit(0)).withColumn("root", F.when(is_main, F.col("root")).otherwise(F.lit(_APART))).drop("_own", "_met")


def _labels(n: int, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Least node of each node's component."""
    label = np.arange(n)
    while len(left):
        low = np.minimum(label[left], label[right])
        new = label.copy()
        np.minimum.at(new, left, low)
        np.minimum.at(new, right, low)
        new = new[new]
        if (new == label).all():
            break
        label = new
    return label


def _run_ends(new: np.ndarray) -> np.ndarray:
    """For each row the end of its run; ``new`` tells of all rows but the first whether one begins."""
    ends = np.append(np.flatnonzero(new) + 1, len(new) + 1)
    return np.repeat(ends, np.diff(np.append(0, ends)))


def _brief(column) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(-1, PLACES)


def _alike(leaves: DataFrame, similarity: float) -> DataFrame:
    """Stars ``member, root`` over members of a leaf whose sketches look alike, those of one component aside.

    ``leaves`` has ``tile`` (a bucket or a pair of blocks of one), ``side`` (0: both, 1 and 2: first and second block),
    ``root`` (the component known so far, or null).
    """
    need = math.floor((similarity - LOOSE) * PLACES)

    def compare(batches):
        for t in whole_groups(batches):
            tile, side = t.column(0).to_numpy(), t.column(1).to_numpy()
            ids, s = t.column(2), _brief(t.column(3))
            root = t.column(4).combine_chunks().dictionary_encode().indices.fill_null(-1).to_numpy()
            new = tile[1:] != tile[:-1]
            end, past = _run_ends(new), _run_ends(new | (root[1:] != root[:-1]) | (root[1:] < 0))  # of the tile, of its rows of one component
            reach = end - past
            found_l, found_r, at = [], [], 0
            upto = np.cumsum(reach)
            while at < len(tile):  # about 200 000 pairs at a time
                stop = max(at + 1, int(np.searchsorted(upto, (upto[at - 1] if at else 0) + 200_000, side="right")))
                left = np.repeat(np.arange(at, stop), reach[at:stop])
                right = past[left] + np.arange(len(left)) - np.repeat(np.cumsum(reach[at:stop]) - reach[at:stop], reach[at:stop])
                apart = (side[left] == side[right]) & (side[left] > 0)  # both of one block: met in the block's own tile
                left, right = left[~apart], right[~apart]
                hit = (s[left] == s[right]).sum(1) >= need
                found_l.append(left[hit])
                found_r.append(right[hit])
                at = stop
            label = _labels(len(tile), np.concatenate(found_l), np.concatenate(found_r))
            moved = np.flatnonzero(label != np.arange(len(tile)))
            yield from pa.table({"member": ids.take(pa.array(moved)), "root": ids.take(pa.array(label[moved]))}).to_batches()

    sorted_leaves = leaves.select("tile", "side", "member", "brief", "root").repartition("tile").sortWithinPartitions("tile", "root")
    return sorted_leaves.mapInArrow(compare, "member binary, root binary")


def _tiled(rows: DataFrame, group: str, blocks) -> DataFrame:
    """Each row once for every pair of blocks its own block is in: ``tile, side`` beside the row's columns."""
    own = F.pmod(F.xxhash64("member"), blocks)
    other = rows.withColumn("_own", own).withColumn("_other", F.explode(F.sequence(F.lit(0).cast("long"), blocks - 1)))
    low, high = F.least("_own", "_other"), F.greatest("_own", "_other")
    side = F.when(F.col("_own") == F.col("_other"), 0).when(F.col("_own") < F.col("_other"), 1).otherwise(2)
    return other.withColumn("tile", F.xxhash64(group, low, high)).withColumn("side", side.cast("int")).drop("_own", "_other")


def components(edges: DataFrame) -> DataFrame:
    """``member, root``: the least id of each node's component, by large-star and small-star rounds in the shared folder."""
    edges = durable(edges.select(F.greatest("member", "root").alias("a"), F.least("member", "root").alias("b")).where("a != b").distinct())
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = durable(large.where("a != b").distinct())
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(least.select("a", F.col("m").alias("b")))
        new = durable(small.where("a != b").distinct())
        if new.count() == edges.count() and new.exceptAll(edges).isEmpty():
            return new.select(F.col("a").alias("member"), F.col("b").alias("root"))
        edges = new


def _verify(tiles: DataFrame, similarity: float) -> DataFrame:
    """Exact check of all pairs of a tile: ``member, links`` (copies of partners counted) and ``root`` of a star."""
    top = round(similarity * 1000)

    def check(batches):
        for t in whole_groups(batches, rows=256):
            tile = t.column(0).to_numpy()
            cuts = np.concatenate([[0], np.flatnonzero(tile[1:] != tile[:-1]) + 1, [len(tile)]])
            ids, sides, copies = t.column(2), t.column(1).to_numpy(), t.column(3).to_numpy()
            sets = [np.frombuffer(x, np.uint64) for x in t.column(4).to_pylist()]
            members, links, roots = [], [], []
            for a, b in zip(cuts[:-1], cuts[1:], strict=True):
                near = _near(sets[a:b], top)
                side = sides[a:b]
                near &= ~((side[:, None] == side[None, :]) & (side[:, None] > 0))
                np.fill_diagonal(near, False)
                left, right = np.nonzero(np.triu(near))
                label = _labels(b - a, left, right)
                n = near @ copies[a:b]
                some = np.flatnonzero(n)
                members += (some + a).tolist()
                links += n[some].tolist()
                roots += (label[some] + a).tolist()
            yield from pa.table({"member": ids.take(pa.array(members, pa.int64())), "links": pa.array(links, pa.int64()),
                                 "root": ids.take(pa.array(roots, pa.int64()))}).to_batches()

    rows = tiles.select("tile", "side", "member", "copies", "shingles").repartition("tile").sortWithinPartitions("tile")
    return rows.mapInArrow(check, "member binary, links long, root binary")


def _near(sets: list[np.ndarray], top: int) -> np.ndarray:
    n = np.array([len(s) for s in sets])
    flat = np.concatenate(sets)
    row = np.repeat(np.arange(len(sets)), n)
    _, code, count = np.unique(flat, return_inverse=True, return_counts=True)
    shared = count[code] > 1  # others are in no intersection
    new = np.cumsum(count > 1) - 1
    row, code = row[shared], new[code[shared]]
    order = np.argsort(code, kind="stable")
    row, code = row[order], code[order]
    both = np.zeros((len(sets), len(sets)), np.float32)
    width = 4096
    for at in range(0, int(code[-1]) + 1 if len(code) else 0, width):
        low, high = np.searchsorted(code, [at, at + width])
        x = np.zeros((len(sets), min(width, int(code[-1]) + 1 - at)), np.float32)
        x[row[low:high], code[low:high] - at] = 1
        both += x @ x.T
    inter = both.astype(np.int64)
    return 1000 * inter >= top * (n[:, None] + n[None, :] - inter)


def join(documents: DataFrame, similarity: float = SIMILARITY, recall: float = RECALL, small: int = SMALL, tile: int = TILE, keep=()) -> DataFrame:
    """One row per document: ``doc_id, class_id, copy_id, n_links, class_key, copy_key``.

    Documents linked by a similarity of at least ``similarity``, directly or through others, share ``class_key``, the
    least set id among them; those with an equal set share ``copy_key``, its id. Both are null without words: such a row
    is a class of its own. ``class_id`` and ``copy_id`` label them with the least ``doc_id`` of the class and of the
    copies; two classes have one label if their ids are null or repeat. ``n_links`` counts all other documents that reach
    the similarity. ``keep`` names further columns to return; ``has_words`` may be among them.
    """
    rows = documents.select(col("doc_id"), col("text"))
    extra = [c for c in keep if c != "has_words"]
    prints = durable(add_columns(documents, ["text"], _print, _PRINT, ["doc_id", *extra]))
    members = durable(
        prints.where("member IS NOT NULL").groupBy("member")
        .agg(F.min("doc_id").alias("copy_id"), F.count("*").alias("copies"), F.first("size").alias("size"), F.first("sketch").alias("sketch"))
    )
    found = _candidates(members, similarity, recall, small, tile)
    group = found.unionByName(found.select(F.col("root").alias("member"), "root").distinct())
    group = group.join(members.select("member", "copies", "size", "copy_id"), "member")
    group = durable(group)
    extent = group.groupBy("root").agg(F.count("*").alias("n"), F.sum("size").alias("total"))
    blocks = F.ceil(F.greatest(F.col("n") / tile, F.col("total") / TILE_SHINGLES)).cast("long")
    sets = _sets_of(rows, group).join(group.select("member", "root", "copies"), "member").join(extent, "root")
    checked = durable(_verify(_tiled(sets, "root", blocks), similarity))
    links = checked.groupBy("member").agg(F.sum("links").alias("links"))
    linked = components(checked.select("member", "root"))
    ids = members.select("member", "copy_id", "copies")
    least = (
        linked.join(ids, "member").select("root", "copy_id")
        .unionByName(linked.select("root").distinct().join(ids.withColumnRenamed("member", "root"), "root").select("root", "copy_id"))
        .groupBy("root").agg(F.min("copy_id").alias("class_id"))
    )
    classes = linked.join(least, "root").select("member", "root", "class_id").unionByName(least.select(F.col("root").alias("member"), "root", "class_id"))
    per_member = ids.join(links, "member", "left").join(classes, "member", "left").select(
        "member", "copy_id", F.coalesce("root", "member").alias("class_key"),
        F.when(F.col("root").isNull(), F.col("copy_id")).otherwise(F.col("class_id")).alias("class_id"), (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links")
    )
    return prints.select("doc_id", "member", *extra).join(per_member, "member", "left").select(
        *keep_columns(keep), "doc_id", F.coalesce("class_id", "doc_id").alias("class_id"), F.coalesce("copy_id", "doc_id").alias("copy_id"), F.coalesce("n_links", F.lit(0)).alias("n_links"),
        "class_key", F.col("member").alias("copy_key"),
    )


def keep_columns(keep) -> list:
    return [F.col("member").isNotNull().alias(c) if c == "has_words" else col(c) for c in keep]


def _brief_of(whole):
    """The last byte of every 32-bit value of a sketch, in one piece."""
    return F.unhex(F.regexp_replace(F.hex(whole), "(..)......", "$1"))


def _sets_of(rows: DataFrame, group: DataFrame) -> DataFrame:
    """``member, shingles`` of the members of candidate groups, from the text of one document of each."""
    wanted = group.select(F.col("copy_id").alias("_id")).distinct()
    if group.count() <= BROADCAST_ROWS:
        wanted = F.broadcast(wanted)
    texts = rows.join(wanted, rows["doc_id"].eqNullSafe(wanted["_id"]), "left_semi")

    def take(text):
        sets = [shingles(words(t)) for t in text.cast(pa.binary()).to_pylist()]
        return [pa.array([hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None for s in sets], pa.binary()),
                pa.array([s.tobytes() for s in sets], pa.binary())]

    out = add_columns(texts, ["text"], take, _SET, [])
    return out.where("member IS NOT NULL").groupBy("member").agg(F.first("shingles").alias("shingles"))


def keep_one(documents: DataFrame) -> DataFrame:
    """``documents`` with one row of each class of near-duplicates: the first by ``doc_id``, then by a hash of the text.

    Rows without words all stay.
    """
    marked = documents.withColumn("_text_key", F.xxhash64("text"))
    found = durable(join(marked, keep=["_text_key", "has_words"]))
    first = found.where("has_words").groupBy("class_key").agg(F.min(F.struct("doc_id", "_text_key")).alias("r"), F.count("*").alias("n"))
    kept = first.select("r.doc_id", "r._text_key").unionByName(found.where("NOT has_words").select("doc_id", "_text_key")).distinct()
    same = marked["doc_id"].eqNullSafe(kept["doc_id"]) & marked["_text_key"].eqNullSafe(kept["_text_key"])
    out = marked.join(kept, same, "left_semi")
    again = found.where("has_words").groupBy("doc_id", "_text_key").count().where("count > 1")
    if not again.isEmpty():  # rows repeated with their id
        again = again.select("doc_id", "_text_key", F.lit(True).alias("_again"))
        twice = out["doc_id"].eqNullSafe(again["doc_id"]) & out["_text_key"].eqNullSafe(again["_text_key"])
        single = out.join(again, twice, "left_anti")
        out = single.unionByName(out.join(again, twice, "left_semi").dropDuplicates(["doc_id", "_text_key"]))
    return out.drop("_text_key")
