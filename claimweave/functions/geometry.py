"""Polygons and boxes as column expressions: a polygon is array<double> x1, y1, x2, y2, ..."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from claimweave.functions.numeric import clamp, half_up


def _points(flat: Column) -> Column:
    return F.floor(F.size(flat) / 2).cast("int")


def _xs(flat: Column) -> Column:
    return F.filter(flat, lambda v, i: i % 2 == 0)


def _ys(flat: Column) -> Column:
    return F.filter(flat, lambda v, i: i % 2 == 1)


def shoelace_area(flat: Column) -> Column:
    """Area of a polygon; 0 below three points."""
    n = _points(flat)
    x = lambda i: F.get(flat, i * 2)
    y = lambda i: F.get(flat, i * 2 + 1)
    cross = F.aggregate(F.sequence(F.lit(0), F.greatest(n - 1, F.lit(0))), F.lit(0.0), lambda acc, i: acc + x(i) * y((i + 1) % n) - x((i + 1) % n) * y(i))
    return F.when(n >= 3, F.abs(cross) / 2).otherwise(F.lit(0.0))


def polygon_box(flat: Column) -> Column:
    """[x, y, w, h] around a polygon."""
    x0, y0 = F.array_min(_xs(flat)), F.array_min(_ys(flat))
    return F.array(x0, y0, F.array_max(_xs(flat)) - x0, F.array_max(_ys(flat)) - y0)


def box_polygon(box: Column) -> Column:
    """Four corners of [x, y, w, h], clockwise from the first."""
    x, y, w, h = (F.get(box, F.lit(i)) for i in range(4))
    return F.array(x, y, x + w, y, x + w, y + h, x, y + h)


def normalise_polygon(flat: Column, width: Column, height: Column, min_points: int = 4) -> Column:
    """Points divided by the image's size and clamped to [0, 1]; empty for small polygons or an image without size."""
    scaled = F.transform(flat, lambda v, i: clamp(v / F.when(i % 2 == 0, width).otherwise(height)))
    good = (F.size(flat) >= 2 * min_points) & (F.coalesce(width, F.lit(0)) > 0) & (F.coalesce(height, F.lit(0)) > 0)
    return F.when(good, scaled).otherwise(F.array().cast("array<double>"))


def label_line(class_id: Column, polygon: Column) -> Column:
    """``<class> x1 y1 ...`` with six decimals, halves rounded up."""
    return F.concat_ws(" ", class_id.cast("string"), F.array_join(F.transform(polygon, lambda v: F.format_string("%.6f", half_up(v, 6))), " "))


def valid_box(box: Column) -> Column:
    return F.coalesce((F.size(box) == 4) & (F.get(box, F.lit(2)) > 0) & (F.get(box, F.lit(3)) > 0), F.lit(False))


def overlap_share(a: Column, b: Column) -> Column:
    """Share of box ``a`` (x1, y1, x2, y2) that lies in box ``b``."""
    at = lambda box, i: F.get(box, F.lit(i))
    w = F.greatest(F.lit(0.0), F.least(at(a, 2), at(b, 2)) - F.greatest(at(a, 0), at(b, 0)))
    h = F.greatest(F.lit(0.0), F.least(at(a, 3), at(b, 3)) - F.greatest(at(a, 1), at(b, 1)))
    area = (at(a, 2) - at(a, 0)) * (at(a, 3) - at(a, 1))
    return F.coalesce(F.try_divide(w * h, area), F.lit(0.0))


def padded_crop(box: Column, width: Column, height: Column, pad: float = 0.15) -> Column:
    """[x1, y1, x2, y2] of [x, y, w, h] padded by a share of its longer side, cut to whole pixels and the image.

    A box that leaves nothing gives a corner of up to 8 x 8 pixels.
    """
    x, y, w, h = (F.get(box, F.lit(i)) for i in range(4))
    p = F.greatest(w, h) * pad
    x1 = F.greatest(F.lit(0), (x - p).cast("int"))
    y1 = F.greatest(F.lit(0), (y - p).cast("int"))
    x2 = F.least(width.cast("int"), (x + w + p).cast("int"))
    y2 = F.least(height.cast("int"), (y + h + p).cast("int"))
    corner = F.array(F.lit(0), F.lit(0), F.least(F.lit(8), width.cast("int")), F.least(F.lit(8), height.cast("int")))
    return F.when((x2 > x1) & (y2 > y1), F.array(x1, y1, x2, y2)).otherwise(corner)


def parse_points(text: Column) -> Column:
    """``x,y;x,y`` as array<double>."""
    return F.when(F.trim(text) != "", F.flatten(F.transform(F.split(text, ";"), lambda p: F.transform(F.split(p, ","), lambda v: v.cast("double")))))


def format_points(flat: Column) -> Column:
    """array<double> as ``x,y;x,y`` with one decimal."""
    pairs = F.transform(F.sequence(F.lit(0), F.greatest(_points(flat) - 1, F.lit(0))), lambda i: F.format_string("%.1f,%.1f", F.get(flat, i * 2), F.get(flat, i * 2 + 1)))
    return F.when(F.size(flat) >= 2, F.array_join(pairs, ";")).otherwise(F.lit(""))
