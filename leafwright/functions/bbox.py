"""Column functions on boxes (arrays x1, y1, x2, y2)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def four(box: Column) -> Column:
    """The first four values; zeros if there are fewer, or one is null or not a number."""
    whole = (F.size(F.coalesce(box, F.array())) >= 4) & ~F.exists(F.slice(box, 1, 4), lambda v: v.isNull() | F.isnan(v))
    return F.when(whole, F.slice(box, 1, 4)).otherwise(F.array(*[F.lit(0.0)] * 4))


def _clamped(box: Column, by: Column) -> Column:
    return F.transform(box, lambda v: F.least(F.lit(1.0), F.greatest(F.lit(0.0), v / by)))


def to_unit(box: Column, scale: float | None = None, width: Column | None = None, height: Column | None = None) -> Column:
    """Coordinates in 0..1: as they are if none is over 1.5, else by an assumed scale, else by the page size.

    With neither, the box comes back as it was.
    """
    b = four(box)
    greatest = F.array_max(F.transform(b, F.abs))
    if scale:
        other = _clamped(b, F.lit(float(scale)))
    elif width is not None and height is not None:
        by = F.array(width, height, width, height)
        sized = F.transform(F.arrays_zip(b.alias("v"), by.alias("s")), lambda z: F.least(F.lit(1.0), F.greatest(F.lit(0.0), z["v"] / z["s"])))
        other = F.when((width > 0) & (height > 0), sized).otherwise(b)
    else:
        other = b
    return F.when(greatest <= 1.5, _clamped(b, F.lit(1.0))).otherwise(other)


def from_unit(box: Column, scale: str) -> Column:
    """scale: relative (as it is) or thousand (0..1000)."""
    return F.transform(box, lambda v: v * 1000.0) if scale == "thousand" else box


def thousandths(box: Column) -> Column:
    """y1, x1, y2, x2 as whole thousandths, cut towards zero."""
    return F.transform(F.array(*[F.get(box, i) for i in (1, 0, 3, 2)]), lambda v: (v * 1000).cast("int"))


def violations(box: Column) -> Column:
    """Names of the rules a unit box breaks: length, number, order, range."""
    b = F.coalesce(box, F.array().cast("array<double>"))
    wrong_length = F.size(b) != 4
    no_number = F.exists(b, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    order = (F.get(b, 2) < F.get(b, 0)) | (F.get(b, 3) < F.get(b, 1))
    out = F.exists(b, lambda v: (v < -1e-6) | (v > 1.000001))
    return F.when(wrong_length, F.lit("length")).when(no_number, F.lit("number")).when(order, F.lit("order")).when(out, F.lit("range"))


def area(box: Column) -> Column:
    return F.greatest(F.lit(0.0), box[2] - box[0]) * F.greatest(F.lit(0.0), box[3] - box[1])


def intersection(a: Column, b: Column) -> Column:
    w = F.least(a[2], b[2]) - F.greatest(a[0], b[0])
    h = F.least(a[3], b[3]) - F.greatest(a[1], b[1])
    return F.greatest(F.lit(0.0), w) * F.greatest(F.lit(0.0), h)


def iou(a: Column, b: Column) -> Column:
    both = intersection(a, b)
    union = area(a) + area(b) - both
    return F.when(union > 0, both / union).otherwise(0.0)


def overlap_smaller(a: Column, b: Column) -> Column:
    least = F.least(area(a), area(b))
    return F.when(least > 0, intersection(a, b) / least).otherwise(0.0)


def inside(inner: Column, outer: Column) -> Column:
    """Whether inner lies in outer, with five percent to spare."""
    return (inner[0] >= 0.95 * outer[0]) & (inner[1] >= 0.95 * outer[1]) & (inner[2] <= 1.05 * outer[2]) & (inner[3] <= 1.05 * outer[3])
