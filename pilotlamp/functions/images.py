"""Metrics of decoded grey images (row-major ``array<double>`` with width and height)."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

METRICS = T.StructType([T.StructField(c, T.DoubleType()) for c in ("full", "center", "combined", "brightness",
                                                                     "contrast")])


def _laplacian_variance(g: np.ndarray) -> float:
    if g.size == 0:
        return 0.0
    rows = min(1, g.shape[0] - 1)
    cols = min(1, g.shape[1] - 1)
    p = np.pad(g, ((rows, rows), (cols, cols)), mode="reflect")
    if not rows:
        p = np.pad(p, ((1, 1), (0, 0)), mode="edge")
    if not cols:
        p = np.pad(p, ((0, 0), (1, 1)), mode="edge")
    lap = p[:-2, 1:-1] + p[2:, 1:-1] + p[1:-1, :-2] + p[1:-1, 2:] - 4.0 * g
    return float(lap.var())


@F.pandas_udf(METRICS)
def sharpness(px: pd.Series, width: pd.Series, height: pd.Series) -> pd.DataFrame:
    """Laplacian variance of the image and of its centre (15-85 %), their 0.2/0.8 blend, mean and deviation."""
    rows = []
    for p, w, h in zip(px, width, height):
        g = np.asarray(p, dtype=np.float64).reshape(int(h), int(w))
        crop = g[int(0.15 * h):int(0.85 * h), int(0.15 * w):int(0.85 * w)]
        full, center = _laplacian_variance(g), _laplacian_variance(crop)
        rows.append((full, center, 0.2 * full + 0.8 * center, float(g.mean()), float(g.std())))
    return pd.DataFrame(rows, columns=["full", "center", "combined", "brightness", "contrast"])


def difference_hash(px: Column, width: int = 9, height: int = 8) -> Column:
    """64 bits, one per horizontal neighbour pair of a 9x8 thumbnail, first pair in the top bit."""
    pairs = F.sequence(F.lit(0), F.lit((width - 1) * height - 1))
    w1 = width - 1

    def at(i: Column, shift: int) -> Column:
        return F.get(px, (F.floor(i / w1) * width + i % w1 + shift).cast("int"))

    bit = lambda i: F.when(at(i, 1) > at(i, 0), F.lit(1).cast("long")).otherwise(F.lit(0).cast("long"))
    return F.aggregate(pairs, F.lit(0).cast("long"), lambda acc, i: F.shiftleft(acc, 1).bitwiseOR(bit(i)))


def hamming(a: Column, b: Column) -> Column:
    return F.bit_count(a.bitwiseXOR(b))


def histogram(px: Column, bins: int = 64, top: float = 256.0) -> Column:
    """Share of pixels per equal-width bin."""
    width = top / bins
    slots = F.transform(px, lambda v: F.least(F.lit(bins - 1), F.floor(v / width).cast("int")))
    return F.transform(F.sequence(F.lit(0), F.lit(bins - 1)),
                       lambda i: F.size(F.filter(slots, lambda s: s == i)) / F.size(px))


def correlation(a: Column, b: Column) -> Column:
    """Pearson correlation of two histograms; 1 when either is constant."""
    n = F.size(a)
    total = lambda v: F.aggregate(v, F.lit(0.0), lambda s, x: s + x)
    ma, mb = total(a) / n, total(b) / n
    cov = F.aggregate(F.zip_with(a, b, lambda x, y: (x - ma) * (y - mb)), F.lit(0.0), lambda s, x: s + x)
    va = F.aggregate(F.transform(a, lambda x: (x - ma) * (x - ma)), F.lit(0.0), lambda s, x: s + x)
    vb = F.aggregate(F.transform(b, lambda x: (x - mb) * (x - mb)), F.lit(0.0), lambda s, x: s + x)
    return F.when(va * vb > 0, cov / F.sqrt(va * vb)).otherwise(1.0)
