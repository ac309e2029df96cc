"""String and vector similarity."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def ratio(a: Column, b: Column) -> Column:
    """Levenshtein ratio 0..1 of two strings (two empty strings: 0)."""
    longest = F.greatest(F.length(a), F.length(b))
    return F.when(longest > 0, 1.0 - F.levenshtein(a, b) / longest).otherwise(0.0)


def token_set_ratio(a: Column, b: Column) -> Column:
    """Likeness 0..1 of two strings as sets of words, whatever their order and repeats.

    The best ``ratio`` among the shared words, the shared words followed by the other words of ``a``, and those of ``b``
    (sorted, joined by blanks). 1 when one set holds the other; 0 when one has no words; NULL for NULL.
    """
    def words(s: Column) -> Column:
        return F.filter(F.array_sort(F.array_distinct(F.split(s, r"(?U)\s+"))), lambda w: w != "")

    x, y = words(a), words(b)
    both, only_a, only_b = F.array_intersect(x, y), F.array_except(x, y), F.array_except(y, x)
    shared, left, right = (F.array_join(v, " ") for v in (both, F.concat(both, only_a), F.concat(both, only_b)))
    held = (F.size(both) > 0) & ((F.size(only_a) == 0) | (F.size(only_b) == 0))
    return (F.when(a.isNull() | b.isNull(), None).when((F.size(x) == 0) | (F.size(y) == 0), 0.0).when(held, 1.0)
            .otherwise(F.greatest(ratio(left, right), ratio(shared, left), ratio(shared, right))))


def bigrams(key: Column) -> Column:
    """Distinct two-character pieces, numbered when repeated, of the key between two sentinels."""
    padded = F.concat(F.lit("\u0002"), key, F.lit("\u0003"))
    pieces = F.transform(F.sequence(F.lit(1), F.length(padded) - 1), lambda i: F.substr(padded, i, F.lit(2)))
    ordered = F.array_sort(pieces)
    numbered = F.transform(ordered, lambda p, i: F.concat(p, F.lit("#"), (i - F.array_position(ordered, p) + 1)
                                                          .cast("string")))
    return numbered


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0),
                       lambda s, v: s + v)


def cosine_distance(a: Column, b: Column) -> Column:
    """1 - cosine of two vectors."""
    norm = F.sqrt(dot(a, a)) * F.sqrt(dot(b, b))
    return F.when(norm > 0, 1.0 - dot(a, b) / norm).otherwise(1.0)
