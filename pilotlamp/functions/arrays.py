"""Folds inside one row that list what they find, and texts cut into pieces of equal length."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often it is used; works inside other folds too."""
    return F.aggregate(F.array().cast("array<int>"), value, lambda v, _: v, body)


def scan(items: Column, start: Column, step: Callable[[Column, Column], Column], kind: str,
         finish: Callable[[Column, Column], Column] = lambda state, found: found) -> Column:
    """Fold ``items`` and list what the steps hand out.

    ``step(state, item)`` is a struct of ``state`` and ``out`` (of type ``kind``; NULL lists nothing), ``finish`` gets the
    last state and the list. A fold copies its state at every step, so blocks of as many items as there are blocks are
    folded apart: a step copies what its block found, and only a block copies all that was found before.
    """
    none = F.array().cast(f"array<{kind}>")

    def add(acc: Column, item: Column) -> Column:
        return let(step(acc["state"], item), lambda r: F.struct(
            r["state"].alias("state"),
            F.when(r["out"].isNull(), acc["found"]).otherwise(F.array_append(acc["found"], r["out"])).alias("found")))

    def add_block(acc: Column, block: Column) -> Column:
        inner = F.aggregate(block, F.struct(acc["state"].alias("state"), none.alias("found")), add)
        return let(inner, lambda r: F.struct(r["state"].alias("state"), F.array_append(acc["full"], r["found"]).alias("full")))

    def blocks(all_: Column) -> Column:
        rows = F.greatest(F.lit(1), F.ceil(F.sqrt(F.size(all_))).cast("int"))
        return F.transform(F.sequence(F.lit(0), rows - 1), lambda b: F.slice(all_, b * rows + 1, rows))

    zero = F.struct(start.alias("state"), F.array().cast(f"array<array<{kind}>>").alias("full"))
    return F.aggregate(let(items, blocks), zero, add_block, lambda acc: finish(acc["state"], F.flatten(acc["full"])))


def pieces_of(s: Column, size: int) -> Column:
    """The text in pieces of ``size`` characters, the last one shorter. Finding a place in a long text walks from its start."""
    return F.regexp_extract_all(s, F.lit(f"(?s).{{1,{size}}}"), F.lit(0))


def part_of(pieces: Column, size: int, first: Column, length: Column, longest: int) -> Column:
    """``length`` characters (at most ``longest``) from the 0-based place ``first`` of a text cut by ``pieces_of``."""
    at = F.call_function("div", first, F.lit(size)).cast("int")
    near = F.array_join(F.slice(pieces, at + 1, F.lit(-(-longest // size) + 1)), "")
    return F.substr(near, (first % size + 1).cast("int"), length.cast("int"))
