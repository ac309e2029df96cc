"""Box arithmetic on columns. A box is four columns x1, y1, x2, y2 held in ``Box``."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column
from pyspark.sql import functions as F


class Box(NamedTuple):
    x1: Column
    y1: Column
    x2: Column
    y2: Column

    @staticmethod
    def of(prefix: str = "", struct: Column | None = None) -> Box:
        pick = (lambda c: struct[c]) if struct is not None else (lambda c: F.col(prefix + c))
        return Box(*(pick(c) for c in ("x1", "y1", "x2", "y2")))

    @property
    def w(self) -> Column:
        return self.x2 - self.x1

    @property
    def h(self) -> Column:
        return self.y2 - self.y1

    @property
    def cx(self) -> Column:
        return (self.x1 + self.x2) / 2

    @property
    def cy(self) -> Column:
        return (self.y1 + self.y2) / 2


def clip(v: Column, low, high) -> Column:
    low = F.lit(low) if not isinstance(low, Column) else low
    high = F.lit(high) if not isinstance(high, Column) else high
    return F.greatest(low, F.least(high, v))


def clamp(b: Box, width: Column, height: Column) -> Box:
    w, h, zero = width.cast("double"), height.cast("double"), F.lit(0.0)
    return Box(clip(b.x1.cast("double"), zero, w), clip(b.y1.cast("double"), zero, h),
               clip(b.x2.cast("double"), zero, w), clip(b.y2.cast("double"), zero, h))


def iou(a: Box, b: Box) -> Column:
    zero = F.lit(0.0)
    iw = F.greatest(zero, F.least(a.x2, b.x2) - F.greatest(a.x1, b.x1))
    ih = F.greatest(zero, F.least(a.y2, b.y2) - F.greatest(a.y1, b.y1))
    inter = iw * ih
    union = F.greatest(zero, a.w) * F.greatest(zero, a.h) + F.greatest(zero, b.w) * F.greatest(zero, b.h) - inter
    return F.when((inter > 0) & (union > 0), inter / union).otherwise(0.0)


def center_distance(a: Box, b: Box) -> Column:
    return F.hypot(a.cx - b.cx, a.cy - b.cy)


def normalized_distance(a: Box, b: Box, width: Column, height: Column) -> Column:
    dx = (a.cx - b.cx) / F.greatest(width.cast("double"), F.lit(1.0))
    dy = (a.cy - b.cy) / F.greatest(height.cast("double"), F.lit(1.0))
    return F.sqrt(dx * dx + dy * dy)


def size_ratio_ok(a: Box, b: Box, limit: float = 2.2) -> Column:
    one = F.lit(1.0)
    aw, ah, bw, bh = (F.greatest(one, v) for v in (a.w, a.h, b.w, b.h))
    return (F.greatest(aw / bw, bw / aw) <= limit) & (F.greatest(ah / bh, bh / ah) <= limit)


def mean_long_side(a: Box, b: Box) -> Column:
    return F.greatest(F.lit(1.0), (F.greatest(a.w, a.h) + F.greatest(b.w, b.h)) / 2)


def template_score(candidate: Box, projected: Box) -> Column:
    """How well a candidate sits on a projected template box, 0..1."""
    overlap = iou(candidate, projected)
    dist = center_distance(candidate, projected)
    diag = F.hypot(F.greatest(F.lit(4.0), projected.w), F.greatest(F.lit(4.0), projected.h))
    far = (overlap < 0.05) & (dist > F.greatest(F.lit(18.0), diag * 0.85))
    near = F.greatest(F.lit(0.0), 1.0 - dist / F.greatest(diag * 1.1, F.lit(24.0)))
    return F.when(far, 0.0).otherwise(F.least(F.lit(1.0), overlap * 1.8 + near * 0.8))


def project_corners(b: Box, h: Column) -> Column:
    """The corners of ``b`` after a 3x3 transform (row-major array): struct of x0, y0 to x3, y3, NULL at infinity."""
    def point(x: Column, y: Column) -> tuple[Column, Column]:
        d = h[6] * x + h[7] * y + h[8]
        d = F.when(d != 0, d)
        return (h[0] * x + h[1] * y + h[2]) / d, (h[3] * x + h[4] * y + h[5]) / d

    points = [point(b.x1, b.y1), point(b.x2, b.y1), point(b.x2, b.y2), point(b.x1, b.y2)]
    return F.struct(*[v.alias(f"{c}{i}") for i, p in enumerate(points) for c, v in zip("xy", p)])


def corner_bounds(corners: Column, width: Column, height: Column) -> Column:
    """Clipped bounding box of ``project_corners``; NULL when a corner lies at infinity."""
    xs, ys = [[corners[f"{c}{i}"] for i in range(4)] for c in "xy"]
    c = clamp(Box(F.least(*xs), F.least(*ys), F.greatest(*xs), F.greatest(*ys)), width, height)
    finite = F.lit(True)
    for v in xs + ys:
        finite = finite & v.isNotNull() & ~F.isnan(v)
    return F.when(finite, F.struct(c.x1.alias("x1"), c.y1.alias("y1"), c.x2.alias("x2"), c.y2.alias("y2")))


def usable_projection(c: Box, width: Column, height: Column) -> Column:
    """False for empty boxes and boxes above 20 % of a side."""
    return (c.w > 0) & (c.h > 0) & (c.w <= width * 0.20) & (c.h <= height * 0.20)


def vote_percent(score: Column) -> Column:
    """What a score adds to the weight 1 of a vote, in hundredths."""
    return F.least(F.greatest(F.coalesce(score.cast("double"), F.lit(0.0)), F.lit(0.0)), F.lit(200.0))


def vote_weight(score: Column) -> Column:
    return 1.0 + vote_percent(score) / 100.0


def expand(b: Box, width: Column, height: Column, scale: float, min_w: float = 0.0, min_h: float = 0.0) -> Box:
    """Box grown around its centre to ``scale`` times its size, rounded half to even and clipped."""
    one = F.lit(1.0)
    w = F.greatest(F.lit(float(min_w)), F.greatest(one, b.w) * scale)
    h = F.greatest(F.lit(float(min_h)), F.greatest(one, b.h) * scale)

    def whole(v: Column) -> Column:
        return F.bround(v).cast("int")

    return Box(F.greatest(F.lit(0), whole(b.cx - w / 2)), F.greatest(F.lit(0), whole(b.cy - h / 2)),
               F.least(width.cast("int"), whole(b.cx + w / 2)), F.least(height.cast("int"), whole(b.cy + h / 2)))
