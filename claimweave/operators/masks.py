"""Masks of boxes and polygons, and what is measured on them, over Arrow batches.

A mask is as large as its image and lives only inside a task; what comes out are
counts and points.

Defined results: polygons below three points and boxes without an area give an
empty mask; the overlap of two empty masks is 0; a mask without pixels has no
points.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F


def box_mask(box, height: int, width: int) -> np.ndarray:
    """Pixels of [x1, y1, x2, y2], rounded and cut to the image."""
    mask = np.zeros((height, width), bool)
    if box is None or len(box) != 4:
        return mask
    x1, y1, x2, y2 = (int(np.rint(v)) for v in box)
    mask[max(0, y1) : max(0, min(height, y2)), max(0, x1) : max(0, min(width, x2))] = True
    return mask


def polygon_mask(flat, height: int, width: int) -> np.ndarray:
    """Pixels of a polygon x1, y1, ... with its border, points rounded; inside by crossings of each row."""
    mask = np.zeros((height, width), bool)
    if flat is None or len(flat) < 6:
        return mask
    points = np.rint(np.asarray(flat, "float64").reshape(-1, 2)).astype("int64")
    x0, y0 = points[:, 0], points[:, 1]
    x1, y1 = np.roll(x0, -1), np.roll(y0, -1)
    for y in range(max(0, int(y0.min())), min(height - 1, int(y0.max())) + 1):
        crosses = (np.minimum(y0, y1) <= y) & (np.maximum(y0, y1) > y)
        if crosses.any():
            at = np.sort(x0[crosses] + (y - y0[crosses]) * (x1[crosses] - x0[crosses]) / (y1[crosses] - y0[crosses]))
            for a, b in zip(at[::2], at[1::2], strict=True):
                mask[y, max(0, int(np.ceil(a))) : max(0, min(width, int(np.floor(b)) + 1))] = True
    for a, b, c, d in zip(x0, y0, x1, y1, strict=True):
        n = int(max(abs(c - a), abs(d - b))) + 1
        xs, ys = np.rint(np.linspace(a, c, n)).astype("int64"), np.rint(np.linspace(b, d, n)).astype("int64")
        inside = (xs >= 0) & (xs < width) & (ys >= 0) & (ys < height)
        mask[ys[inside], xs[inside]] = True
    return mask


def mask_counts(old_polygon: Column, new_box: Column, height: Column, width: Column) -> Column:
    """(area_old, area_new, intersection) in pixels of a polygon and a box in one image, as a struct."""

    @F.pandas_udf("area_old bigint, area_new bigint, intersection bigint")
    def count(polygon: pd.Series, box: pd.Series, h: pd.Series, w: pd.Series) -> pd.DataFrame:
        rows = []
        for p, b, hh, ww in zip(polygon, box, h, w, strict=True):
            old, new = polygon_mask(p, int(hh), int(ww)), box_mask(b, int(hh), int(ww))
            rows.append((int(old.sum()), int(new.sum()), int((old & new).sum())))
        return pd.DataFrame(rows, columns=["area_old", "area_new", "intersection"])

    return count(old_polygon, new_box, height, width)


def thinned(mask: np.ndarray) -> np.ndarray:
    """A mask thinned to lines of one pixel: border pixels go in two alternating passes while nothing breaks."""
    m = np.pad(mask, 1).astype("uint8")
    changed = True
    while changed:
        changed = False
        for step in (0, 1):
            n = [m[:-2, 1:-1], m[:-2, 2:], m[1:-1, 2:], m[2:, 2:], m[2:, 1:-1], m[2:, :-2], m[1:-1, :-2], m[:-2, :-2]]
            around = sum(x.astype("int8") for x in n)
            turns = sum(((n[i] == 0) & (n[(i + 1) % 8] == 1)).astype("int8") for i in range(8))
            a, b = (n[0] * n[2] * n[4], n[2] * n[4] * n[6]) if step == 0 else (n[0] * n[2] * n[6], n[0] * n[4] * n[6])
            gone = (m[1:-1, 1:-1] == 1) & (around >= 2) & (around <= 6) & (turns == 1) & (a == 0) & (b == 0)
            if gone.any():
                m[1:-1, 1:-1][gone] = 0
                changed = True
    return m[1:-1, 1:-1].astype(bool)


def line_points(mask: np.ndarray, n: int = 5) -> list[list[int]]:
    """Up to n points [x, y] spread evenly along the centre line of a mask; its centre if thinning leaves nothing."""
    ys, xs = np.nonzero(thinned(mask))
    if len(xs):
        at = np.rint(np.linspace(0, len(xs) - 1, min(n, len(xs)))).astype(int)
        return [[int(xs[i]), int(ys[i])] for i in at]
    ys, xs = np.nonzero(mask)
    return [[int(xs.mean()), int(ys.mean())]] if len(xs) else []


def centre_line(box: Column, height: Column, width: Column, n: int = 5) -> Column:
    """Points along the centre line of a box's mask, as array<array<int>>."""

    @F.pandas_udf("array<array<int>>")
    def points(b: pd.Series, h: pd.Series, w: pd.Series) -> pd.Series:
        return pd.Series([line_points(box_mask(x, int(hh), int(ww)), n) for x, hh, ww in zip(b, h, w, strict=True)])

    return points(box, height, width)
