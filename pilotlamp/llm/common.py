"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Callable, Iterable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# every byte of UTF-8 text that is no digit, letter a-z or part of a wider character becomes a blank; A-Z become a-z
_WORD_BYTES = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256)
)


def words(text: bytes | None) -> list[bytes]:
    """Lower-cased (A-Z) words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` of UTF-8 text; null has none."""
    return text.translate(_WORD_BYTES).split() if text else []


def word_codes(text: bytes | None) -> tuple[list[bytes], np.ndarray]:
    """Words between blanks, tabs and line ends (``[^\\x20\\x09-\\x0D]+``) of UTF-8 text and a number for each, equal for equal words."""
    found = text.split() if text else []
    number: dict[bytes, int] = {}
    return found, np.fromiter((number.setdefault(w, len(number)) for w in found), np.int64, len(found))


def col(name: str):
    """A column by its exact name, dots included."""
    return F.col("`" + name.replace("`", "``") + "`")


def without(columns: Iterable[str], names: Iterable[str]) -> list[str]:
    """``columns`` less those that would clash with ``names``; Spark compares names without case."""
    gone = {n.lower() for n in names}
    return [c for c in columns if c.lower() not in gone]


def add_columns(
    df: DataFrame, inputs: list[str], fn: Callable[..., list[pa.Array]], added: T.StructType, keep: Iterable[str] | None = None
) -> DataFrame:
    """Append the columns ``fn`` makes from the ``inputs`` of an Arrow batch.

    ``keep`` names the columns that go on (all by default); a column with the name of an added one is replaced.
    """
    kept = without(df.columns if keep is None else keep, added.names)
    read = df.select(*[col(c).alias(f"k{i}") for i, c in enumerate(kept)], *[col(c).alias(f"x{i}") for i, c in enumerate(inputs)])
    fields = [T.StructField(f"k{i}", df.schema[c].dataType, True) for i, c in enumerate(kept)]
    names = [f.name for f in fields] + added.names
    n = len(kept)

    def run(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([*b.columns[:n], *fn(*b.columns[n:])], names)

    out = read.mapInArrow(run, T.StructType(fields + added.fields))
    return out.select(*[col(f"k{i}").alias(c) for i, c in enumerate(kept)], *map(col, added.names))


def table(spark, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def whole_groups(batches: Iterable[pa.RecordBatch], key: int = 0, rows: int = 20_000):
    """Tables of at least ``rows`` rows, the last aside, that never cut a run of equal keys; the input is sorted by key."""
    held: list[pa.RecordBatch] = []
    size = 0
    for b in batches:
        if not b.num_rows:
            continue
        held.append(b)
        size += b.num_rows
        if size < rows:
            continue
        t = pa.Table.from_batches(held).combine_chunks()
        keys = t.column(key)
        low, high = 0, t.num_rows - 1  # first row of the last run
        while low < high:
            mid = (low + high) // 2
            low, high = (low, mid) if keys[mid] == keys[t.num_rows - 1] else (mid + 1, high)
        if low:
            yield t.slice(0, low)
        held, size = t.slice(low).to_batches(), t.num_rows - low
        rows = max(rows, 2 * size)  # a long run is not looked at again for every batch
    if held:
        yield pa.Table.from_batches(held).combine_chunks()
