"""Annotation files and images as DataFrames.  Every reader takes a folder or a glob and reads whole files in parallel."""

from __future__ import annotations

import base64
import io
import shutil
import zipfile
import zlib
from collections import Counter
from pathlib import Path

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType

from claimweave.functions.geometry import polygon_box, shoelace_area
from claimweave.operators.annotations import map_class

IMAGE_SUFFIXES = ("jpg", "jpeg", "png", "bmp", "webp")

COCO = (
    "images array<struct<id bigint, file_name string, width int, height int>>, "
    "annotations array<struct<id bigint, image_id bigint, category_id int, segmentation string, bbox array<double>, area double, iscrowd int, confidence double, fine_conf double>>, "
    "categories array<struct<id int, name string, supercategory string>>"
)


def whole_files(spark: SparkSession, path: str, glob: str = "*.json") -> DataFrame:
    """(path, length, value) of each matching file below a folder, once each."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", glob).load(path)
    return files.select("path", "length", F.decode("content", "UTF-8").alias("value")).dropDuplicates(["path"])


def discover_coco(spark: SparkSession, path: str, min_bytes: int = 1000, glob: str = "*.json") -> DataFrame:
    """Paths of files that are large enough and have images and annotations."""
    keys = F.json_object_keys("value")
    return whole_files(spark, path, glob).where((F.col("length") > min_bytes) & F.array_contains(keys, "annotations") & F.array_contains(keys, "images")).select("path")


def sniff_format(spark: SparkSession, path: str, glob: str = "*.json") -> DataFrame:
    """(path, kind) of JSON files: via, fiftyone, coco or unknown, in this order of preference."""
    value = F.col("value")
    keys = F.json_object_keys(value)
    via = F.col("path").endswith("via_annos.json") | (F.element_at(F.from_json(value, "map<string, struct<regions string>>"), F.get(keys, F.lit(0))).getField("regions").isNotNull())
    kind = F.when(via, "via").when(F.array_contains(keys, "samples"), "fiftyone").when(F.array_contains(keys, "annotations") & F.array_contains(keys, "images"), "coco").otherwise("unknown")
    return whole_files(spark, path, glob).select("path", F.coalesce(kind, F.lit("unknown")).alias("kind"))


class CocoTables:
    """images, annotations and categories of COCO files, each with the file's path."""

    def __init__(self, parsed: DataFrame) -> None:
        self._parsed = parsed

    def _part(self, name: str) -> DataFrame:
        return self._parsed.select("path", F.explode(f"c.{name}").alias("r")).select("path", "r.*")

    @property
    def images(self) -> DataFrame:
        return self._part("images")

    @property
    def annotations(self) -> DataFrame:
        """Polygons as array<array<double>>; a run-length outline gives null and is_rle."""
        polygons = F.try_variant_get(F.try_parse_json("segmentation"), "$", "array<array<double>>")
        return self._part("annotations").withColumns({"polygons": polygons, "is_rle": F.coalesce(F.trim("segmentation").startswith("{"), F.lit(False))})

    @property
    def categories(self) -> DataFrame:
        return self._part("categories")


def read_coco(spark: SparkSession, path: str, glob: str = "*.json") -> CocoTables:
    """Annotation outlines stay text until they are known to be polygons."""
    parsed = whole_files(spark, path, glob).select("path", F.from_json("value", COCO).alias("c"))
    return CocoTables(parsed)


def mapped_annotations(coco: CocoTables) -> DataFrame:
    """Annotations with their category's name and the damage type it maps to; unmapped ones are left out."""
    names = coco.categories.select("path", F.col("id").alias("category_id"), F.col("name").alias("label"))
    return coco.annotations.join(names, ["path", "category_id"]).withColumn("type", map_class(F.col("label"))).where("type is not null")


def collect_instances(spark: SparkSession, sources: list[dict]) -> DataFrame:
    """Instances of several COCO sources in one table.

    A source is {"name", "path", optional "glob", "file_prefix"}.  Boxes without
    a size and annotations without an image are left out; an unknown category
    is ``?``; an area that is missing is the box's.
    """
    out = None
    for order, s in enumerate(sources):
        coco = read_coco(spark, s["path"], s.get("glob", "*.json"))
        images = coco.images.select("path", F.col("id").alias("image_id"), F.concat(F.lit(s.get("file_prefix", "")), "file_name").alias("file_name"), F.col("width").alias("img_w"), F.col("height").alias("img_h"))
        names = coco.categories.select("path", F.col("id").alias("category_id"), F.col("name").alias("coarse"))
        w, h = F.get("bbox", F.lit(2)), F.get("bbox", F.lit(3))
        rows = (
            coco.annotations.where((F.size("bbox") == 4) & (w > 0) & (h > 0)).join(images, ["path", "image_id"]).join(names, ["path", "category_id"], "left")
            .select(F.lit(s["name"]).alias("source"), F.lit(order).alias("source_order"), "path", "file_name", "bbox", "polygons", F.coalesce("area", w * h).alias("area"), F.coalesce("coarse", F.lit("?")).alias("coarse"), "img_w", "img_h", F.col("id").alias("annotation_id"))
        )
        out = rows if out is None else out.unionByName(rows)
    return out


def read_via(spark: SparkSession, path: str, glob: str = "*via*.json") -> DataFrame:
    """(path, file_name, region, label, type, polygon, bbox, area) of VIA files: a map of file name to regions.

    A region counts if its label maps and it has as many x as y and at least three.
    """
    entries = whole_files(spark, path, glob).select("path", F.explode(F.from_json("value", "map<string, struct<name: string, regions: array<struct<all_x: array<double>, all_y: array<double>, class: string>>>>")).alias("key", "e"))
    regions = entries.select("path", F.coalesce("e.name", "key").alias("file_name"), F.posexplode("e.regions").alias("region", "r"))
    good = regions.where((F.size("r.all_x") >= 3) & (F.size("r.all_x") == F.size("r.all_y")))
    flat = F.flatten(F.zip_with("r.all_x", "r.all_y", lambda x, y: F.array(x, y)))
    return good.select("path", "file_name", "region", F.col("r.class").alias("label"), map_class(F.col("r.class")).alias("type"), flat.alias("polygon")).where("type is not null").withColumns({"bbox": polygon_box(F.col("polygon")), "area": shoelace_area(F.col("polygon"))})


_SAMPLES = "samples array<struct<filepath: string, metadata: struct<width: int, height: int>, segmentations: struct<detections: array<struct<label: string, bounding_box: array<double>, mask: struct<`$binary`: struct<base64: string>>>>>>>"


def _runs(mask: np.ndarray) -> list[tuple[int, int, int]]:
    """(row, first, after) of every run of set pixels, in reading order."""
    edges = np.diff(np.pad(mask.astype("int8"), ((0, 0), (1, 1))), axis=1)
    row, first = np.nonzero(edges == 1)
    after = np.nonzero(edges == -1)[1]
    return list(zip(row.tolist(), first.tolist(), after.tolist(), strict=True))


def _outline(mask: np.ndarray) -> list[float] | None:
    """Boundary of the largest 4-connected region of a mask: per row its first and last pixel, walked around.

    Regions are joined run by run, so the work grows with the outline and not with the pixels.
    """
    runs = _runs(mask)
    if not runs:
        return None
    parent = list(range(len(runs)))

    def root(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    above, start = 0, 0
    for i, (y, x0, x1) in enumerate(runs):
        while runs[above][0] < y - 1 or (runs[above][0] == y - 1 and runs[above][2] <= x0 and above < i):
            above += 1
        start = above
        while start < i and runs[start][0] == y - 1 and runs[start][1] < x1:
            a, b = root(start), root(i)
            parent[max(a, b)] = min(a, b)
            start += 1
    sizes: dict[int, int] = {}
    for i, (_, x0, x1) in enumerate(runs):
        sizes[root(i)] = sizes.get(root(i), 0) + x1 - x0
    best = max(sizes, key=lambda r: (sizes[r], -r))
    rows: dict[int, tuple[int, int]] = {}
    for i, (y, x0, x1) in enumerate(runs):
        if root(i) == best:
            lo, hi = rows.get(y, (x0, x1 - 1))
            rows[y] = (min(lo, x0), max(hi, x1 - 1))
    ys = sorted(rows)
    left, right = [(rows[y][0], y) for y in ys], [(rows[y][1], y) for y in reversed(ys)]
    return [float(v) for p in left + right for v in p]


@F.pandas_udf(ArrayType(DoubleType()))
def mask_outline(encoded: pd.Series) -> pd.Series:
    """Outline of a base64, zlib, npy mask; null where there is none or it cannot be read."""

    def one(text):
        if not isinstance(text, str) or not text:
            return None
        try:
            return _outline(np.load(io.BytesIO(zlib.decompress(base64.b64decode(text))), allow_pickle=False).astype(bool))
        except (ValueError, zlib.error, OSError, EOFError):
            return None

    return encoded.map(one)


def read_fiftyone(spark: SparkSession, path: str, glob: str = "samples.json") -> DataFrame:
    """(path, file_name, detection, label, type, bbox, polygon, area) with relative boxes brought to pixels.

    The outline comes from the mask, moved to the box; without a mask it is the box.  The area is the box's.
    """
    samples = whole_files(spark, path, glob).select("path", F.explode(F.from_json("value", _SAMPLES).getField("samples")).alias("s"))
    found = samples.select("path", F.regexp_extract("s.filepath", r"([^/\\]*)$", 1).alias("file_name"), "s.metadata.width", "s.metadata.height", F.posexplode("s.segmentations.detections").alias("detection", "d"))
    size = lambda i: F.col("width") if i % 2 == 0 else F.col("height")
    box = F.array(*[F.get("d.bounding_box", F.lit(i)) * size(i) for i in range(4)])
    boxed = found.withColumns({"bbox": box, "shape": mask_outline(F.col("d.mask.$binary.base64")), "label": F.col("d.label"), "type": map_class(F.col("d.label"))}).where("type is not null")
    x, y, w, h = (F.get("bbox", F.lit(i)) for i in range(4))
    moved = F.transform("shape", lambda v, i: v + F.when(i % 2 == 0, F.floor(x)).otherwise(F.floor(y)))
    rectangle = F.array(x, y, x + w, y, x + w, y + h, x, y + h)
    return boxed.select("path", "file_name", "detection", "label", "type", "bbox", F.when(F.size("shape") >= 6, moved).otherwise(rectangle).alias("polygon"), (w * h).alias("area"))


_CVAT = "_id INT, _name STRING, _width INT, _height INT, polygon ARRAY<STRUCT<_label: STRING, _points: STRING, _VALUE: STRING>>"


def read_cvat(spark: SparkSession, path: str, labels: tuple[str, ...]) -> tuple[DataFrame, DataFrame]:
    """(images, polygons) of CVAT XML; unknown labels and fewer than four points are left out.

    The schema is given, as a file with single polygons would be read otherwise.
    """
    from claimweave.functions.geometry import parse_points

    rows = spark.read.format("xml").option("rowTag", "image").schema(_CVAT).load(path)
    images = rows.select(F.col("_id").cast("bigint").alias("id"), F.col("_name").alias("file_name"), F.col("_width").alias("width"), F.col("_height").alias("height"))
    shapes = rows.select(F.col("_id").cast("bigint").alias("image_id"), F.posexplode("polygon").alias("ordinal", "p")).select("image_id", "ordinal", F.col("p._label").alias("label"), parse_points(F.col("p._points")).alias("polygon"))
    kept = shapes.where(F.col("label").isin(*labels) & (F.size("polygon") >= 8)).withColumn("bbox", polygon_box(F.col("polygon")))
    return images, kept.withColumn("area", F.get("bbox", F.lit(2)) * F.get("bbox", F.lit(3)))


def open_container(path: str, into: str) -> tuple[str, str]:
    """(kind, path) of an export: the first XML of a ZIP, else its first JSON; XML and JSON as they are.

    Images below ``data/`` of a ZIP are laid beside it, in ``into/data``.  A driver-side step for one file.
    """
    p = Path(path)
    if p.suffix.lower() == ".zip":
        with zipfile.ZipFile(p) as z:
            names = sorted(z.namelist())
            chosen = next((n for n in names if n.lower().endswith(".xml")), None) or next((n for n in names if n.lower().endswith(".json")), None)
            if chosen is None:
                raise ValueError(f"{path} holds neither XML nor JSON")
            pictures = [n for n in names if n.startswith("data/") and n.lower().rsplit(".", 1)[-1] in IMAGE_SUFFIXES]
            for name, target in [(chosen, Path(into) / Path(chosen).name), *((n, Path(into) / "data" / Path(n).name) for n in pictures)]:
                target.parent.mkdir(parents=True, exist_ok=True)
                with z.open(name) as source, target.open("wb") as sink:
                    shutil.copyfileobj(source, sink)
        p = Path(into) / Path(chosen).name
    kind = {".xml": "xml", ".json": "json"}.get(p.suffix.lower())
    if kind is None:
        raise ValueError(f"{path} is no export")
    return kind, str(p)


def list_images(spark: SparkSession, path: str) -> DataFrame:
    """(path, length, modified) of image files below a folder, by suffix in any case."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return files.where(F.lower(F.regexp_extract("path", r"\.([^./]+)$", 1)).isin(*IMAGE_SUFFIXES)).select("path", "length", F.col("modificationTime").alias("modified"))


def hash_files(spark: SparkSession, path: str, glob: str = "*") -> DataFrame:
    """(path, sha256) of each file."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", glob).load(path)
    return files.select("path", F.sha2("content", 256).alias("sha256"))


def read_images(spark: SparkSession, path: str) -> DataFrame:
    """Spark's image source with unreadable files kept (height -1)."""
    return spark.read.format("image").option("dropInvalid", "false").option("recursiveFileLookup", "true").load(path)


def read_labels(spark: SparkSession, path: str) -> DataFrame:
    """(split, file, class_id, polygon) of label lines below labels/<split>/; lines of fewer than seven tokens are left out."""
    lines = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", "*.txt").text(path).select(F.input_file_name().alias("file"), F.split(F.trim("value"), r"\s+").alias("t"))
    return lines.where(F.size("t") >= 7).select(
        F.regexp_extract("file", r"([^/]+)/[^/]+$", 1).alias("split"), F.regexp_extract("file", r"([^/]+)\.txt$", 1).alias("stem"), F.get("t", F.lit(0)).cast("int").alias("class_id"), F.transform(F.slice("t", F.lit(2), F.size("t") - 1), lambda v: v.cast("double")).alias("polygon")
    )


def label_statistics(spark: SparkSession, path: str) -> DataFrame:
    """(split, n_files, n_lines, n_blank, n_short) of label files: files with or without shapes, lines with one, blank lines, lines of too few numbers.

    Empty files are known from the listing alone, which the driver holds for any read; a scan passes over them.
    """
    listed = Counter(f.rsplit("/", 2)[-2] for f in spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.txt").load(path).inputFiles())
    counts = spark.createDataFrame(sorted(listed.items()), "split string, n_files bigint")
    files = whole_files(spark, path, "*.txt").select(F.regexp_extract("path", r"([^/]+)/[^/]+$", 1).alias("split"), F.split(F.regexp_replace("value", r"\n\z", ""), "\n").alias("lines"))
    count = lambda test: F.sum(F.size(F.filter("lines", test)))
    tokens = lambda line: F.size(F.split(F.trim(line), r"\s+"))
    blank = lambda line: F.trim(line) == ""
    found = files.groupBy("split").agg(count(lambda x: ~blank(x) & (tokens(x) >= 7)).alias("n_lines"), count(blank).alias("n_blank"), count(lambda x: ~blank(x) & (tokens(x) < 7)).alias("n_short"))
    return counts.join(found, "split", "left").select("split", "n_files", *[F.coalesce(c, F.lit(0)).alias(c) for c in ("n_lines", "n_blank", "n_short")])


def outline_kinds(annotations: DataFrame) -> DataFrame:
    """(path, n_polygons, n_run_length, n_without): what a conversion to label lines takes, and what it skips."""
    polygons = F.coalesce(F.size("polygons") > 0, F.lit(False))
    return annotations.groupBy("path").agg(F.count_if(polygons).alias("n_polygons"), F.count_if("is_rle").alias("n_run_length"), F.count_if(~polygons & ~F.col("is_rle")).alias("n_without"))


def read_claim_metadata(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Metadata documents of claims, one a line; a broken one gives nulls, and fields outside of the schema are left out."""
    return spark.read.schema(schema).json(path)


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """(path, value) of a folder of JSON documents, broken ones included, for validation."""
    return whole_files(spark, path).select("path", "value")


def read_yaml_rows(spark: SparkSession, path: str, at: str, key: str = "key") -> DataFrame:
    """A mapping inside small YAML files as rows (path, key, value as JSON text), of every file; ``at`` is a dotted path into each."""
    import json

    import yaml

    def run(batches):
        for batch in batches:
            rows = []
            for file, text in zip(batch["path"], batch["value"], strict=True):
                node = yaml.safe_load(text)
                for part in at.split(".") if at else []:
                    node = node[part]
                rows.extend((file, str(k), json.dumps(v, ensure_ascii=False)) for k, v in node.items())
            yield pd.DataFrame(rows, columns=["path", key, "value"])

    return whole_files(spark, path, "*.y*ml").select("path", "value").mapInPandas(run, f"path string, `{key}` string, value string")


def read_annotations(spark: SparkSession, path: str) -> tuple[str, DataFrame]:
    """(kind, shapes) of a folder of annotation files: VIA, else FiftyOne, else COCO, the first that yields a shape.

    Shapes have path, file_name, type, polygon, bbox and area.
    """
    columns = ("path", "file_name", "type", "polygon", "bbox", "area")
    for kind, reader in (("via", read_via), ("fiftyone", read_fiftyone)):
        shapes = reader(spark, path).select(*columns)
        if not shapes.isEmpty():
            return kind, shapes
    coco = read_coco(spark, path)
    images = coco.images.select("path", F.col("id").alias("image_id"), "file_name")
    shapes = mapped_annotations(coco).join(images, ["path", "image_id"]).withColumn("polygon", F.get("polygons", F.lit(0)))
    return "coco", shapes.select(*columns)


def read_scores(spark: SparkSession, path: str) -> DataFrame:
    """(file_name, mean, least, n) of a JSON map of file name to confidence statistics."""
    entries = spark.read.option("wholetext", "true").text(path).select(F.explode(F.from_json("value", "map<string, struct<mean: double, min: double, count: int>>")).alias("file_name", "s"))
    return entries.select("file_name", F.col("s.mean").alias("mean"), F.col("s.min").alias("least"), F.col("s.count").alias("n"))


def remap_categories(coco: CocoTables, ids: dict[str, int]) -> DataFrame:
    """Annotations with the id that their category's name has in ``ids``; a name that is not listed keeps its id."""
    names = coco.categories.select("path", F.col("id").alias("category_id"), "name")
    table = F.create_map(*[F.lit(x) for k, v in ids.items() for x in (k, v)])
    joined = coco.annotations.join(names, ["path", "category_id"], "left")
    return joined.withColumn("category_id", F.coalesce(F.try_element_at(table, F.col("name")), "category_id")).drop("name")


def detect(images: DataFrame, detector, schema: str) -> DataFrame:
    """Rows a detector yields for batches of images: ``detector(batch) -> frame`` runs inside the tasks."""

    def run(batches):
        for batch in batches:
            yield detector(batch)

    return images.mapInPandas(run, schema)
