"""Image quality from pixels and the verdict on it."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

STATS = "sharpness double, high_pct double, low_pct double, mean_brightness double, dhash bigint, rust double"


def _grey(bgr: np.ndarray) -> np.ndarray:
    return np.rint(bgr[..., 0] * 0.114 + bgr[..., 1] * 0.587 + bgr[..., 2] * 0.299)


def region_of(grey: np.ndarray, roi) -> np.ndarray:
    """The part of an image inside [x1, y1, x2, y2], rounded and cut to the image; the whole image for none or an empty one."""
    if roi is None:
        return grey
    h, w = grey.shape
    x1, y1, x2, y2 = (int(np.rint(v)) for v in roi)
    x1, y1, x2, y2 = max(0, x1), max(0, y1), min(w, x2), min(h, y2)
    return grey[y1:y2, x1:x2] if x2 > x1 and y2 > y1 else grey


def laplacian_variance(grey: np.ndarray, roi=None) -> float:
    """Variance of the 4-neighbour Laplacian with mirrored borders, of the whole image or of a region."""
    p = region_of(grey, roi).astype("float64")
    p = np.pad(p, 1, mode="reflect") if min(p.shape) > 1 else np.pad(p, 1, mode="edge")
    lap = p[:-2, 1:-1] + p[2:, 1:-1] + p[1:-1, :-2] + p[1:-1, 2:] - 4 * p[1:-1, 1:-1]
    return float(lap.var())


def _triangle_weights(size: int, out: int) -> np.ndarray:
    """(out, size) weights of a bilinear reduction: a triangle as wide as the step, so that every pixel counts."""
    scale = size / out
    support = max(scale, 1.0)
    centre = (np.arange(out) + 0.5) * scale
    far = np.abs(np.arange(size)[None, :] + 0.5 - centre[:, None]) / support
    w = np.maximum(0.0, 1.0 - far)
    return w / w.sum(axis=1, keepdims=True)


def dhash(grey: np.ndarray) -> int:
    """64 bits of left < right over the image reduced to 9 x 8 bilinearly, first row first, as a signed number."""
    h, w = grey.shape
    wide = np.floor(grey.astype("float64") @ _triangle_weights(w, 9).T + 0.5)
    small = np.floor(_triangle_weights(h, 8) @ wide + 0.5)
    value = 0
    for bit in (small[:, 1:] > small[:, :-1]).ravel():
        value = value << 1 | int(bit)
    return value - 2**64 if value >= 2**63 else value


def rust_share(bgr: np.ndarray) -> float:
    """Share of pixels with a rusty hue (hue 10-50 degrees, some saturation, neither black nor white)."""
    x = bgr.astype("float64")
    high, low = x.max(axis=2), x.min(axis=2)
    span = np.where(high == low, 1, high - low)
    b, g, r = x[..., 0], x[..., 1], x[..., 2]
    hue = np.where(high == r, (g - b) / span % 6, np.where(high == g, (b - r) / span + 2, (r - g) / span + 4)) * 60
    sat = np.where(high > 0, (high - low) / np.where(high > 0, high, 1) * 255, 0)
    return float(((hue >= 10) & (hue <= 50) & (sat >= 50) & (high >= 20) & (high <= 200)).mean())


def pixels_of(height: int, width: int, channels: int, raw: bytes) -> np.ndarray:
    """Blue, green and red of a row of Spark's image source."""
    pixels = np.frombuffer(raw, "uint8").reshape(height, width, channels)
    return pixels[..., :3] if channels >= 3 else np.repeat(pixels[..., :1], 3, axis=2)


def region_sharpness(images: DataFrame, roi: str = "roi") -> DataFrame:
    """``images`` (image, and a region [x1, y1, x2, y2] or null) with the sharpness of that region; null for what cannot be decoded."""

    @F.pandas_udf("double")
    def measure(height: pd.Series, width: pd.Series, channels: pd.Series, data: pd.Series, box: pd.Series) -> pd.Series:
        return pd.Series([round(laplacian_variance(_grey(pixels_of(h, w, c, raw)), b), 3) if h and h > 0 else None for h, w, c, raw, b in zip(height, width, channels, data, box, strict=True)], dtype="float64")

    i = F.col("image")
    return images.withColumn("sharpness", measure(i.getField("height"), i.getField("width"), i.getField("nChannels"), i.getField("data"), F.col(roi)))


def with_vehicles(images: DataFrame, detector, schema: str = "origin string, vehicle_detected boolean, vehicle_area_fraction double, n_vehicles int, bbox array<int>") -> DataFrame:
    """What an injected vehicle detector says of each image: ``detector(frame of origin, height, width, channels, data) -> frame`` runs on batches in the tasks."""
    i = F.col("image")
    fed = images.select(i.getField("origin").alias("origin"), i.getField("height").alias("height"), i.getField("width").alias("width"), i.getField("nChannels").alias("channels"), i.getField("data").alias("data"))

    def run(batches):
        for batch in batches:
            yield detector(batch)

    return fed.mapInPandas(run, schema)


def valid_only(detections: DataFrame, verdicts: DataFrame, image: str = "image_id") -> DataFrame:
    """Detections of images that passed the quality verdict; what an image that failed or has no verdict shows does not count."""
    return detections.join(verdicts.where("valid").select(image).distinct(), image, "left_semi")


def image_stats(images: DataFrame) -> DataFrame:
    """Rows of Spark's image source with width, height, megapixels and pixel statistics; nulls for what cannot be decoded."""

    @F.pandas_udf(STATS)
    def stats(height: pd.Series, width: pd.Series, channels: pd.Series, data: pd.Series) -> pd.DataFrame:
        rows = []
        for h, w, c, raw in zip(height, width, channels, data, strict=True):
            if h is None or h <= 0 or w <= 0:
                rows.append((None,) * 6)
                continue
            bgr = pixels_of(h, w, c, raw)
            grey = _grey(bgr)
            rows.append((round(laplacian_variance(grey), 3), round(float((grey > 250).mean() * 100), 3), round(float((grey < 15).mean() * 100), 3), round(float(grey.mean()), 2), dhash(grey), round(rust_share(bgr), 4)))
        return pd.DataFrame(rows, columns=[c.split()[0] for c in STATS.split(", ")]).astype({"dhash": "Int64"})

    i = F.col("image")
    fed = images.select(i.getField("origin").alias("origin"), i.getField("height").alias("height"), i.getField("width").alias("width"), stats(i.getField("height"), i.getField("width"), i.getField("nChannels"), i.getField("data")).alias("s"))
    good = F.col("height") > 0
    return fed.select("origin", good.alias("readable"), F.when(good, F.col("width")).alias("width"), F.when(good, F.col("height")).alias("height"), F.when(good, F.round(F.col("width") * F.col("height") / 1e6, 2)).alias("megapixels"), "s.*")


#: Limits of the verdict; strict comparisons throughout.
LIMITS = {"sharpness": 80.0, "high_pct": 15.0, "low_pct": 25.0, "dark": 40.0, "bright": 220.0, "long_side": 800, "short_side": 600, "vehicle": 0.10}


def problems(limits: dict[str, float] = LIMITS) -> Column:
    """Ordered list of what is wrong with an image, from its statistics; nulls say nothing wrong."""
    c = F.col
    over, under = c("high_pct") > limits["high_pct"], c("low_pct") > limits["low_pct"]
    dark, bright = c("mean_brightness") < limits["dark"], c("mean_brightness") > limits["bright"]
    said = [
        (~c("vehicle_detected") | (c("vehicle_area_fraction") < limits["vehicle"]), "no_vehicle"),
        (c("sharpness") < limits["sharpness"], "blurry"),
        (over, "overexposed"),
        (under, "underexposed"),
        (dark & ~F.coalesce(under, F.lit(False)), "underexposed"),
        (bright & ~F.coalesce(over, F.lit(False)), "overexposed"),
        ((F.greatest("width", "height") < limits["long_side"]) | (F.least("width", "height") < limits["short_side"]), "low_resolution"),
    ]
    return F.array_compact(F.array(*[F.when(F.coalesce(cond, F.lit(False)), F.lit(name)) for cond, name in said]))


def verdict(rows: DataFrame, limits: dict[str, float] = LIMITS) -> DataFrame:
    return rows.withColumn("problems", problems(limits)).withColumn("valid", F.size("problems") == 0)


def vehicle_boxes(rows: DataFrame, classes: tuple[int, ...] = (2, 5, 7), min_confidence: float = 0.5) -> DataFrame:
    """Boxes (x1, y1, x2, y2) of vehicle classes cut to the image; empty ones are left out."""
    kept = rows.where(F.col("class_id").isin(*classes) & (F.col("confidence") >= min_confidence))
    cut = kept.withColumns({"x1": F.greatest(F.lit(0.0), "x1"), "y1": F.greatest(F.lit(0.0), "y1"), "x2": F.least("width", "x2"), "y2": F.least("height", "y2")})
    return cut.where("x2 > x1 and y2 > y1")


def _covered(x1: np.ndarray, y1: np.ndarray, x2: np.ndarray, y2: np.ndarray) -> tuple[float, list[float]]:
    """Area that the boxes of one image cover together, and their hull."""
    xs = np.unique(np.concatenate([x1, x2]))
    ys = np.unique(np.concatenate([y1, y2]))
    covered = np.zeros((len(ys) - 1, len(xs) - 1), bool)
    for a, b, c, d in zip(x1, y1, x2, y2, strict=True):
        covered[np.searchsorted(ys, b) : np.searchsorted(ys, d), np.searchsorted(xs, a) : np.searchsorted(xs, c)] = True
    area = float((covered * np.outer(np.diff(ys), np.diff(xs))).sum())
    return area, [float(xs[0]), float(ys[0]), float(xs[-1]), float(ys[-1])]


def _covered_alike(x1: np.ndarray, y1: np.ndarray, x2: np.ndarray, y2: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """:func:`_covered` of many images with as many boxes each, a row an image."""
    xs, ys = np.sort(np.hstack([x1, x2]), axis=1), np.sort(np.hstack([y1, y2]), axis=1)
    covered = np.zeros((len(xs), ys.shape[1] - 1, xs.shape[1] - 1), bool)
    for k in range(x1.shape[1]):
        inside_x = (x1[:, k, None] <= xs[:, :-1]) & (xs[:, 1:] <= x2[:, k, None])
        inside_y = (y1[:, k, None] <= ys[:, :-1]) & (ys[:, 1:] <= y2[:, k, None])
        covered |= inside_y[:, :, None] & inside_x[:, None, :]
    area = (covered * (np.diff(ys, axis=1)[:, :, None] * np.diff(xs, axis=1)[:, None, :])).sum(axis=(1, 2))
    return area, np.stack([xs[:, 0], ys[:, 0], xs[:, -1], ys[:, -1]], axis=1)


#: Boxes of an image up to which images with as many are placed together.
FEW_BOXES = 8


def union_area(boxes: DataFrame, image: str = "image_id") -> DataFrame:
    """(image, fraction, hull, n) of the boxes of an image: area covered by any of them over the image's area.

    Boxes of one image are few (detector output), so they lie together in their
    task, and images with as many boxes are computed at once.
    """
    import pyarrow as pa
    import pyarrow.compute as pc

    sides = ("x1", "y1", "x2", "y2")

    def of_images(rows: pa.Table, starts: np.ndarray) -> pa.RecordBatch:
        """Results of the images whose rows begin at ``starts``."""
        corners = [rows[c].to_numpy() for c in sides]
        full = (rows["width"].to_numpy() * rows["height"].to_numpy())[starts]
        sizes = np.diff(np.append(starts, rows.num_rows))
        area, hull = np.zeros(len(starts)), np.zeros((len(starts), 4))
        known = np.logical_and.reduceat(np.isfinite(np.sum(corners, axis=0)), starts)
        for size in np.unique(sizes[known & (sizes <= FEW_BOXES)]):
            at = np.flatnonzero(known & (sizes == size))
            area[at], hull[at] = _covered_alike(*[c[starts[at, None] + np.arange(size)] for c in corners])
        for i in np.flatnonzero(~known | (sizes > FEW_BOXES)):
            area[i], hull[i] = _covered(*[c[starts[i] : starts[i] + sizes[i]] for c in corners])
        fraction = np.divide(area, full, out=np.zeros(len(area)), where=full != 0)
        hulls = pa.ListArray.from_arrays(pa.array(np.arange(len(hull) + 1, dtype="int32") * 4), pa.array(hull.ravel()))
        names = rows[image].take(pa.array(starts)).combine_chunks()
        return pa.RecordBatch.from_arrays([names.combine_chunks() if isinstance(names, pa.ChunkedArray) else names, pa.array(fraction), hulls, pa.array(sizes.astype("int64"))], [image, "fraction", "hull", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_rows: list[pa.RecordBatch] = []  # rows of the image that the next batch may go on with
        for batch in batches:
            if not batch.num_rows:
                continue
            before = [open_rows[-1].slice(open_rows[-1].num_rows - 1)] if open_rows else []
            ids = pa.Table.from_batches([*before, batch])[image].combine_chunks()
            here, there = ids.slice(1), ids.slice(0, len(ids) - 1)
            differ = pc.or_(pc.fill_null(pc.not_equal(here, there), False), pc.not_equal(pc.is_null(here), pc.is_null(there)))
            new = np.flatnonzero(differ.to_numpy(zero_copy_only=False)) + 1 - len(before)
            if not len(new):
                open_rows.append(batch)
                continue
            held = sum(b.num_rows for b in open_rows)
            yield of_images(pa.Table.from_batches([*open_rows, batch.slice(0, new[-1])]), np.concatenate([[0], new[:-1] + held]) if held + new[0] else new[:-1])
            open_rows = [batch.slice(new[-1])]
        if open_rows:
            yield of_images(pa.Table.from_batches(open_rows), np.array([0]))

    kind = dict(boxes.dtypes)[image]
    rows = boxes.select(image, *[F.col(c).cast("double").alias(c) for c in (*sides, "width", "height")])
    return rows.repartition(image).sortWithinPartitions(image).mapInArrow(run, f"`{image}` {kind}, fraction double, hull array<double>, n bigint")


#: Tags of the main directory and of the photo's own that can identify a person, a place or a device.
IDENTIFYING_TAGS = frozenset((271, 272, 305, 306, 315, 316, 33432, 37510, 42016, 34853, 36867, 36868, 42032, 42033, 42034))


def strip_exif(content: bytes) -> bytes:
    """A JPEG without its EXIF and other application segments but the first; anything else as it is.  Pixels are not encoded again."""
    if not content or content[:2] != b"\xff\xd8":
        return content
    out, at = [content[:2]], 2
    while at + 4 <= len(content) and content[at] == 0xFF and content[at + 1] not in (0xDA, 0xD9):
        end = at + 2 + int.from_bytes(content[at + 2 : at + 4], "big")
        if not 0xE1 <= content[at + 1] <= 0xEF:
            out.append(content[at:end])
        at = end
    out.append(content[at:])
    return b"".join(out)


def stripped(files: DataFrame) -> DataFrame:
    """(path, content, removed) of image files (path, content): identifying metadata taken off, files without any as they are."""

    @F.pandas_udf("content binary, removed boolean")
    def clean(content: pd.Series) -> pd.DataFrame:
        rows = []
        for c in content:
            found = c is not None and bool(IDENTIFYING_TAGS & set(exif_tags(bytes(c))))
            rows.append((strip_exif(bytes(c)) if found else c, found))
        return pd.DataFrame(rows, columns=["content", "removed"])

    return files.select("path", clean("content").alias("r")).select("path", "r.*")


def exif_tags(content: bytes) -> list[int]:
    """Numbers of the EXIF tags of a JPEG, of its main directory and those it points at; empty for anything else."""
    import struct

    if not content or content[:2] != b"\xff\xd8":
        return []
    at = 2
    while at + 4 <= len(content) and content[at] == 0xFF and content[at + 1] not in (0xDA, 0xD9):
        size = struct.unpack(">H", content[at + 2 : at + 4])[0]
        body = content[at + 4 : at + 2 + size]
        if content[at + 1] == 0xE1 and body[:6] == b"Exif\0\0":
            tiff = body[6:]
            order = {b"II": "<", b"MM": ">"}.get(tiff[:2])
            if order is None or len(tiff) < 8:
                return []
            found, todo, seen = [], [struct.unpack(order + "I", tiff[4:8])[0]], set()
            while todo:
                start = todo.pop()
                if start in seen or start + 2 > len(tiff):
                    continue
                seen.add(start)
                (n,) = struct.unpack(order + "H", tiff[start : start + 2])
                for i in range(n):
                    entry = tiff[start + 2 + 12 * i : start + 14 + 12 * i]
                    if len(entry) < 12:
                        break
                    tag, value = struct.unpack(order + "H", entry[:2])[0], struct.unpack(order + "I", entry[8:12])[0]
                    found.append(tag)
                    if tag in (0x8769, 0x8825):
                        todo.append(value)
            return found
        at += 2 + size
    return []


def exif_report(files: DataFrame) -> DataFrame:
    """(path, n_tags, identifying) of image files (path, content) of the binary file source."""

    @F.pandas_udf("n_tags int, identifying array<int>")
    def read(content: pd.Series) -> pd.DataFrame:
        tags = [exif_tags(bytes(c)) if c is not None else [] for c in content]
        return pd.DataFrame({"n_tags": [len(t) for t in tags], "identifying": [sorted(IDENTIFYING_TAGS & set(t)) for t in tags]})

    return files.select("path", read("content").alias("r")).select("path", "r.*")
