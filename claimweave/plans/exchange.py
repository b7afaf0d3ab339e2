"""Queries that write annotation files, documents, images and streams and read them back, with the SQL over the tables they came from."""

from __future__ import annotations

import json
import struct
import uuid

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from claimweave.functions import geometry as geo
from claimweave.functions.numeric import half_even, half_up
from claimweave.functions.templates import data_uri
from claimweave.functions.vocabulary import CLASS_MAP, DAMAGE_TYPES
from claimweave.operators import consolidate as con
from claimweave.operators import localize, lookup, masks, metrics, quality, relabel, validate
from claimweave.operators.staging import stage_root
from claimweave.plans.adapter import WITH, claims, detections
from claimweave.plans.claims import ISOTONIC
from claimweave.plans.datasets import _BASE, _R, _annotations, _images
from claimweave.session import read_table
from claimweave.sinks import files as sinks
from claimweave.sources import files as sources

QUERIES, ORACLES = {}, {}
#: Images that one document holds about, so that no document outgrows a task.
PER_DOCUMENT = 500


def query(sql: str | None = None):
    """Register a query under its own name, with its SQL."""

    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


def _folder(spark: SparkSession, name: str) -> str:
    return f"{stage_root(spark)}/{name}-{uuid.uuid4().hex}"


def _case(mapping: dict[str, str | None], value: str) -> str:
    listed = ", ".join(f"'{k}'" for k in mapping)
    whens = " ".join(f"when '{k}' then " + (f"'{v}'" if v else "null") for k, v in mapping.items())
    return f"case when {value} in ({listed}) then case {value} {whens} end"


_LOWER: dict[str, str | None] = {}
for _k, _v in CLASS_MAP.items():
    _LOWER.setdefault(_k.lower(), _v)
_TYPE = f"{_case(CLASS_MAP, 'c.name')} else {_case(_LOWER, 'lower(c.name)')} end end"
_SHAPES = _BASE + f""", shapes as (
  select a.*, c.name, {_TYPE} as type, i.file_name, i.width, i.height, i.build_id, a.polygons[1] as p from anns a join images i on a.image_id = i.id join coco_categories c on a.category_id = c.id)"""


def _chunk(images: DataFrame) -> DataFrame:
    """Images with the number of the document that holds them: of one build, about ``PER_DOCUMENT`` each."""
    counts = images.groupBy("build_id").agg(F.ceil(F.count(F.lit(1)) / PER_DOCUMENT).alias("n_docs"))
    joined = images.join(counts, images["build_id"].eqNullSafe(counts["build_id"])).drop(counts["build_id"])
    return joined.withColumn("doc", F.concat_ws("-", F.coalesce(F.col("build_id"), F.lit(-1)), F.pmod(F.xxhash64("id"), F.col("n_docs"))))


def _named_shapes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Annotations of known images with the document and file name of their image and the name of their category."""
    images = _chunk(_images(spark, sf_dir)).select(F.col("id").alias("image_id"), "doc", "file_name", "width", "height")
    names = read_table(spark, sf_dir, "coco_categories").select(F.col("id").alias("category_id"), "name")
    return _annotations(spark, sf_dir).join(images, "image_id").join(names, "category_id")


def _write_coco(spark: SparkSession, sf_dir: str, images: DataFrame, path: str) -> None:
    """One COCO document for each chunk of a build's images."""
    chunked = _chunk(images)
    of_image = chunked.groupBy("doc").agg(F.collect_list(F.struct("id", "file_name", "width", "height")).alias("images"))
    outline = F.when(F.col("segmentation") != "[]", F.col("segmentation"))
    mine = _annotations(spark, sf_dir).where("category_id is not null").join(chunked.select(F.col("id").alias("image_id"), "doc"), "image_id")
    of_ann = mine.groupBy("doc").agg(F.collect_list(F.struct("id", "image_id", "category_id", outline.alias("segmentation"), "bbox", "area", "fine_conf")).alias("annotations"))
    categories = read_table(spark, sf_dir, "coco_categories").agg(F.collect_list(F.struct("id", "name", "supercategory"))).scalar()
    empty = F.array().cast(dict(of_ann.dtypes)["annotations"])
    documents = of_image.join(of_ann, "doc", "left").select("doc", F.to_json(F.struct("images", F.coalesce("annotations", empty).alias("annotations"), categories.alias("categories"))).alias("value"))
    documents.repartition("doc").write.partitionBy("doc").text(path)


# --- annotation files


@query(_SHAPES + " select type, count(*) as n, count(*) filter (where polygons is not null and len(polygons) > 0) as n_outlined from shapes where type is not null group by type")
def coco_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Annotations written as COCO documents and read back with classes mapped."""
    path = _folder(spark, "coco")
    _write_coco(spark, sf_dir, _images(spark, sf_dir), path)
    found = sources.mapped_annotations(sources.read_coco(spark, path, "*.txt"))
    return found.groupBy("type").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.size("polygons") > 0).alias("n_outlined"))


@query(_BASE + ", m as (select a.* from anns a join images i on a.image_id = i.id where a.category_id is not null) select count(*) filter (where segmentation like '[[%') as n_polygons, count(*) filter (where segmentation like '{%') as n_run_length, count(*) filter (where segmentation is null or segmentation = '[]') as n_without from m")
def outline_kinds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How the outlines of COCO documents are given: polygons, run lengths (skipped on conversion) or not at all."""
    path = _folder(spark, "coco")
    _write_coco(spark, sf_dir, _images(spark, sf_dir), path)
    kinds = sources.outline_kinds(sources.read_coco(spark, path, "*.txt").annotations)
    return kinds.agg(*[F.sum(c).cast("bigint").alias(c) for c in ("n_polygons", "n_run_length", "n_without")])


@query(_BASE + ", d as (select count(distinct build_id) as n from images) select case when n > 0 then n end as n_documents, true as all_found from d")
def coco_discovery(spark: SparkSession, sf_dir: str) -> DataFrame:
    """COCO documents among files of other kinds and sizes: one of each build is found at least, and nothing else."""
    path = _folder(spark, "coco")
    _write_coco(spark, sf_dir, _images(spark, sf_dir), f"{path}/coco")
    for name, text in (("small", '{"images": [], "annotations": []}'), ("other", json.dumps({"pages": ["x" * 2000]})), ("broken", "{" * 2000)):
        spark.createDataFrame([(text,)], "value string").coalesce(1).write.text(f"{path}/{name}")
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.txt").load(f"{path}/coco").select("path", "length")
    large = files.where("length > 1000").count()
    found = sources.discover_coco(spark, path, glob="*.txt").select(F.regexp_extract("path", r"/coco/doc=(-?\d+)-\d+/", 1).alias("build"))
    return found.agg(F.countDistinct("build").alias("n_documents"), (F.count(F.lit(1)) == large).alias("all_found"))


@query(
    _BASE
    + f""", shapes as (select a.*, coalesce(c.name, '?') as coarse, i.file_name, i.build_id from anns a join images i on a.image_id = i.id left join coco_categories c on a.category_id = c.id where a.category_id is not null),
good as (select case when build_id % 2 = 0 then 'even' else 'odd' end as source, coarse, file_name, coalesce(area, bbox[3] * bbox[4]) as area from shapes where len(bbox) = 4 and bbox[3] > 0 and bbox[4] > 0)
select source, coarse, count(*) as n, {_R.format(x="sum(cast(area as decimal(24,4)))", n=2)} as area, count(distinct source || '/' || file_name) as n_files from good group by 1, 2"""
)
def multi_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Instances of two COCO sources in one table, file names with the prefix of their source."""
    given = []
    for odd, name in enumerate(("even", "odd")):
        path = _folder(spark, f"coco-{name}")
        _write_coco(spark, sf_dir, _images(spark, sf_dir).where(F.col("build_id") % 2 == odd), path)
        given.append({"name": name, "path": path, "glob": "*.txt", "file_prefix": f"{name}/"})
    rows = sources.collect_instances(spark, given)
    return rows.groupBy("source", "coarse").agg(F.count(F.lit(1)).alias("n"), half_up(F.sum(F.col("area").cast("decimal(24,4)"))).alias("area"), F.countDistinct("file_name").alias("n_files"))


_SHOELACE = "abs(list_sum([p[2 * i + 1] * p[2 * ((i + 1) % (len(p) // 2)) + 2] - p[2 * ((i + 1) % (len(p) // 2)) + 1] * p[2 * i + 2] for i in range(len(p) // 2)])) / 2"


@query(_SHAPES + f", r as (select type, {_SHOELACE} as area from shapes where type is not null and len(p) >= 6) select type, count(*) as n, {_R.format(x='sum(cast(area as decimal(24,4)))', n=2)} as area from r group by type")
def via_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First polygons written as VIA maps of file name to regions, and read back."""
    shapes = _named_shapes(spark, sf_dir).select("doc", "image_id", "file_name", "name", F.get("polygons", F.lit(0)).alias("p")).where("p is not null")
    xs, ys = F.filter("p", lambda v, i: i % 2 == 0), F.filter("p", lambda v, i: i % 2 == 1)
    entries = shapes.groupBy("doc", "image_id").agg(F.struct(F.min("file_name").alias("name"), F.collect_list(F.struct(xs.alias("all_x"), ys.alias("all_y"), F.col("name").alias("class"))).alias("regions")).alias("e"))
    documents = entries.groupBy("doc").agg(F.to_json(F.map_from_entries(F.collect_list(F.struct(F.col("image_id").cast("string"), "e")))).alias("value"))
    path = _folder(spark, "via")
    documents.repartition("doc").write.partitionBy("doc").text(path)
    found = sources.read_via(spark, path, "*.txt")
    return found.groupBy("type").agg(F.count(F.lit(1)).alias("n"), half_up(F.sum(F.col("area").cast("decimal(24,4)"))).alias("area"))


@query(_SHAPES + f" select type, count(*) as n, {_R.format(x='sum(cast(bbox[3] * bbox[4] as decimal(24,4)))', n=2)} as area from shapes where type is not null and len(bbox) = 4 and width > 0 and height > 0 group by type")
def fiftyone_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Boxes written as samples with relative boxes, and read back in pixels; without masks an outline is its box."""
    shapes = _named_shapes(spark, sf_dir).where("size(bbox) = 4 and width > 0 and height > 0")
    relative = F.array(*[F.get("bbox", F.lit(i)) / F.col("width" if i % 2 == 0 else "height") for i in range(4)])
    found = F.struct(F.collect_list(F.struct(F.col("name").alias("label"), relative.alias("bounding_box"))).alias("detections"))
    samples = shapes.groupBy("doc", "image_id").agg(F.struct(F.concat(F.lit("/data/"), F.min("file_name")).alias("filepath"), F.struct(F.min("width").alias("width"), F.min("height").alias("height")).alias("metadata"), found.alias("segmentations")).alias("s"))
    documents = samples.groupBy("doc").agg(F.to_json(F.struct(F.collect_list("s").alias("samples"))).alias("value"))
    path = _folder(spark, "fiftyone")
    documents.repartition("doc").write.partitionBy("doc").text(path)
    got = sources.read_fiftyone(spark, path, "*.txt")
    return got.groupBy("type").agg(F.count(F.lit(1)).alias("n"), half_up(F.sum(half_up(F.col("area"), 4).cast("decimal(24,4)"))).alias("area"))


@query(
    _SHAPES
    + f""", f as (select image_id, arg_min(name, id) as label, arg_min(p, id) as q from shapes where p is not null group by image_id),
k as (select label, (list_max([q[2 * i + 1] for i in range(len(q) // 2)]) - list_min([q[2 * i + 1] for i in range(len(q) // 2)])) * (list_max([q[2 * i + 2] for i in range(len(q) // 2)]) - list_min([q[2 * i + 2] for i in range(len(q) // 2)])) as area
  from f where len(q) >= 8 and label in ({", ".join(f"'{t}'" for t in DAMAGE_TYPES)}))
select label, count(*) as n, {_R.format(x="sum(cast(area as decimal(24,4)))", n=2)} as area, (select count(*) from images) as n_images from k group by label"""
)
def cvat_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Outlines written as CVAT files and read back: labels, shapes and areas; images without a shape are there as well."""
    shapes = _named_shapes(spark, sf_dir).select("image_id", F.col("id").alias("ordinal"), F.col("name").alias("label"), F.get("polygons", F.lit(0)).alias("polygon"), F.col("fine_conf").alias("confidence")).where("polygon is not null")
    path = _folder(spark, "cvat")
    sinks.write_cvat_parts(_images(spark, sf_dir).withColumn("review_order", F.col("id")), shapes, path)
    images, polygons = sources.read_cvat(spark, path, DAMAGE_TYPES)
    counts = polygons.groupBy("label").agg(F.count(F.lit(1)).alias("n"), half_up(F.sum(F.col("area").cast("decimal(24,4)"))).alias("area"))
    return counts.select("label", "n", "area", images.agg(F.count(F.lit(1))).scalar().alias("n_images"))


@query("select * from (values ('coco', 1), ('via', 1), ('fiftyone', 1), ('unknown', 2)) t(kind, n)")
def format_dispatch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files told apart by what is in them."""
    one = {"file_name": "a.jpg", "id": 1}
    documents = [{"images": [one], "annotations": [], "categories": []}, {"a": {"name": "a.jpg", "regions": []}}, {"samples": [{"filepath": "a.jpg"}]}, {"pages": []}, {"images": [one]}]
    path = _folder(spark, "mixed")
    spark.createDataFrame([(i, json.dumps(d)) for i, d in enumerate(documents)], "doc int, value string").repartition("doc").write.partitionBy("doc").text(path)
    return sources.sniff_format(spark, path, "*.txt").groupBy("kind").agg(F.count(F.lit(1)).cast("int").alias("n"))


@query(_BASE + ", m as (select a.*, c.name from anns a join images i on a.image_id = i.id left join coco_categories c on a.category_id = c.id where a.category_id is not null) select case name when 'scratch' then 101 when 'rust' then 102 else category_id end as category_id, count(*) as n from m group by 1")
def category_remap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Categories of a reviewed export brought to other numbers by name; names without one keep theirs."""
    path = _folder(spark, "coco")
    _write_coco(spark, sf_dir, _images(spark, sf_dir), path)
    return sources.remap_categories(sources.read_coco(spark, path, "*.txt"), {"scratch": 101, "rust": 102}).groupBy("category_id").agg(F.count(F.lit(1)).alias("n"))


_SCORES = ", s as (select image_id, count(fine_conf) as n, avg(cast(fine_conf as decimal(12,6))) as mean, min(fine_conf) as least from anns where fine_conf is not null and image_id is not null group by 1)"


@query(_BASE + _SCORES + " select cast(image_id as varchar) as file_name, cast(round(cast(mean as decimal(24,8)), 4) as double) as mean, least, cast(n as int) as n from s")
def score_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Confidence statistics written as maps of file name and read back."""
    scored = _annotations(spark, sf_dir).where("fine_conf is not null and image_id is not null").groupBy("image_id").agg(half_up(F.avg(F.col("fine_conf").cast("decimal(12,6)")), 4).alias("mean"), F.min("fine_conf").alias("min"), F.count(F.lit(1)).cast("int").alias("count"))
    entry = F.struct(F.col("image_id").cast("string").alias("k"), F.struct("mean", "min", "count").alias("v"))
    documents = scored.groupBy(F.pmod(F.xxhash64("image_id"), F.lit(8)).alias("doc")).agg(F.to_json(F.map_from_entries(F.collect_list(entry))).alias("value"))
    path = _folder(spark, "scores")
    documents.repartition("doc").write.partitionBy("doc").text(path)
    return sources.read_scores(spark, path)


_LABELLED = _SHAPES + ", l as (select *, case when image_id % 10 < 7 then 'train' when image_id % 10 < 9 then 'val' else 'test' end as split from shapes where len(p) >= 8 and width > 0 and height > 0)"


def _label_files(spark: SparkSession, sf_dir: str) -> str:
    """Label files of all images, by split, with an empty file for an image without shapes."""
    split = F.when(F.col("id") % 10 < 7, "train").when(F.col("id") % 10 < 9, "val").otherwise("test")
    images = _images(spark, sf_dir).select("id", F.concat(F.col("id").cast("string"), F.lit(".jpg")).alias("file_name"), split.alias("split"))
    shapes = _named_shapes(spark, sf_dir).select("image_id", F.col("id").alias("ordinal"), F.col("category_id").alias("class_id"), geo.normalise_polygon(F.get("polygons", F.lit(0)), F.col("width").cast("double"), F.col("height").cast("double")).alias("polygon")).where("size(polygon) > 0")
    path = _folder(spark, "labels")
    sinks.write_label_files(sinks.label_lines(images, shapes), path.removeprefix("file://"))
    return path


@query(_LABELLED + " select split, category_id as class_id, count(*) as n, cast(sum(len(p)) as bigint) as n_numbers from l group by 1, 2")
def label_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Label files written and read back: shapes and numbers of each split and class."""
    return sources.read_labels(spark, _label_files(spark, sf_dir)).groupBy("split", "class_id").agg(F.count(F.lit(1)).alias("n"), F.sum(F.size("polygon")).alias("n_numbers"))


@query(_LABELLED + ", f as (select case when id % 10 < 7 then 'train' when id % 10 < 9 then 'val' else 'test' end as split, count(*) as n_files from images group by 1), c as (select split, count(*) as n_lines from l group by 1) select split, n_files, coalesce(n_lines, 0) as n_lines, 0 as n_blank, 0 as n_short from f left join c using (split)")
def label_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files of each split, those without shapes as well, and what their lines are."""
    got = sources.label_statistics(spark, _label_files(spark, sf_dir))
    return got.select("split", "n_files", *[F.col(c).cast("bigint").alias(c) for c in ("n_lines", "n_blank", "n_short")])


@query("select 'data' as path, 'train' as key, '\"images/train\"' as value union all select 'data', 'val', '\"images/val\"' union all select 'data', 'test', '\"images/test\"' union all select 'data', 'path', '\"data\"' union all select 'data', 'names', '{\"0\": \"scratch\", \"1\": \"dent\"}'")
def yaml_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A dataset description written and read back."""
    from pathlib import Path

    path = _folder(spark, "yaml")
    target = Path(path.removeprefix("file://"))
    target.mkdir(parents=True)
    (target / "data.yaml").write_text(sinks.dataset_yaml("data", ("scratch", "dent")))
    return sources.read_yaml_rows(spark, path, "").select(F.regexp_extract("path", r"([^/]+)\.yaml$", 1).alias("path"), "key", "value")


# --- documents

TRUTH_SCHEMA = {
    "type": "object", "required": ["claim_id", "importe_final_pagado", "moneda", "severidad_oficial", "es_estructural"], "additionalProperties": False,
    "properties": {"claim_id": {"type": "string"}, "importe_final_pagado": {"type": "number", "minimum": 0}, "moneda": {"const": "EUR"}, "severidad_oficial": {"enum": ["leve", "moderado", "severo"]}, "es_estructural": {"type": "boolean"}, "fecha_cierre": {"type": "string", "format": "date"}},
}


def _truth_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ground truth of closed claims as JSON, with every kind of mistake in some."""
    c = claims(spark, sf_dir)
    k = F.col("claim_id") % 11
    fields = F.struct(
        F.when(k != 1, F.col("claim_id").cast("string")).alias("claim_id"), F.when(k == 2, -F.col("importe_real")).otherwise(F.col("importe_real")).alias("importe_final_pagado"), F.when(k == 3, "USD").otherwise("EUR").alias("moneda"),
        F.when(k == 4, "grave").otherwise(F.col("severidad_oficial")).alias("severidad_oficial"), "es_estructural", F.col("fecha_cierre").cast("string").alias("fecha_cierre"), F.when(k == 5, "1234ABC").alias("matricula"),
    )
    text = F.to_json(fields)
    return c.select("claim_id", F.when(k == 6, F.substring(text, 1, 20)).otherwise(text).alias("value"))


_TRUTH_ERRORS = """case claim_id % 11 when 1 then '$: ''claim_id'' is missing' when 2 then case when importe_real > 0 then '$.importe_final_pagado: below 0' else '' end when 3 then '$.moneda: not one of [''EUR'']'
  when 4 then '$.severidad_oficial: not one of [''leve'', ''moderado'', ''severo'']' when 5 then '$: unexpected ''matricula''' when 6 then '$: not JSON' else '' end"""


@query(WITH + f"select errors = '' as is_valid, errors, count(*) as n from (select {_TRUTH_ERRORS} as errors from claims) t group by 1, 2")
def golden_set(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A folder of ground-truth documents, broken ones included, held against its contract: every error, sorted by path."""
    path = _folder(spark, "truth")
    sinks.write_documents(_truth_documents(spark, sf_dir), path)
    checked = validate.validate(spark.read.text(path), "value", TRUTH_SCHEMA)
    return checked.groupBy("is_valid", F.array_join("errors", "; ").alias("errors")).agg(F.count(F.lit(1)).alias("n"))


OUTPUT_SCHEMA = {
    "type": "object", "required": ["id_evaluacion", "claim_id", "timestamp", "model_version", "damages", "zones_summary", "audit"], "additionalProperties": False,
    "properties": {
        "id_evaluacion": {"type": "string", "pattern": "^EVA-[0-9]{8}-[0-9A-F]{8}$"}, "claim_id": {"type": "string"}, "timestamp": {"type": "string"}, "model_version": {"type": "string"}, "zones_summary": {"type": "object"},
        "damages": {"type": "array", "items": {"type": "object", "required": ["damage_id", "type", "confidence"], "properties": {"damage_id": {"type": "string", "pattern": "^C[0-9]+$"}, "type": {"enum": list(DAMAGE_TYPES)}, "confidence": {"type": "number", "minimum": 0, "maximum": 1}}}},
        "audit": {"type": "object", "required": ["input_hashes", "processing_time_ms"], "properties": {"input_hashes": {"type": "array", "items": {"type": "string"}}, "processing_time_ms": {"type": "integer", "minimum": 0}}},
    },
}


def _output_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    from claimweave.plans.claims import _outputs

    # the number again: by it the damages lie together already
    outputs = _outputs(spark, sf_dir).withColumn("claim_id", F.col("claim_id").cast("bigint"))
    return sinks.output_document(outputs, con.assemble_claims(con.consolidate(detections(spark, sf_dir))))


@query(WITH + f", n as (select c.claim_id, count(distinct d.type || '|' || case when d.part not in ('', 'unknown') then 'part' when d.zone not in ('', 'unknown') then 'zone' else 'none' end || '|' || case when d.part not in ('', 'unknown') then d.part when d.zone not in ('', 'unknown') then d.zone else '' end) as n_damages, any_value(c.anio) as ms from claims c left join detections d on d.claim_id = c.claim_id group by c.claim_id) select cast(claim_id as varchar) as claim_id, cast(n_damages as int) as n_damages, true as is_valid, cast(ms as bigint) as processing_time_ms from n")
def output_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Evaluations as JSON documents, held against their contract and read back."""
    checked = validate.validate(_output_documents(spark, sf_dir), "value", OUTPUT_SCHEMA)
    back = sinks.audit_from_outputs(checked, "value", "is_valid")
    return back.select("claim_id", F.col("output_summary.n_damages").alias("n_damages"), "is_valid", "processing_time_ms")


@query(WITH + "select cast(claim_id as varchar) as claim_id, 'EVA-' || replace(cast(fecha_cierre as varchar), '-', '') || '-' || upper(substr(sha256(cast(claim_id as varchar) || cast(fecha_cierre as varchar) || 'T00:00:00Z'), 1, 8)) as id_evaluacion, sha256(cast(claim_id as varchar)) as hashes, '' as lane, 0e0 as total_eur from claims")
def audit_from_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The audit's fields taken from evaluation documents, missing ones with their defaults."""
    back = sinks.audit_from_outputs(_output_documents(spark, sf_dir), "value")
    return back.select("claim_id", "id_evaluacion", F.array_join("input_hashes", ",").alias("hashes"), "output_summary.lane", "output_summary.total_eur")


@query(WITH + "select cast(claim_id as varchar) as claim_id, marca, anio, valor from claims")
def claim_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metadata of claims written as one document each and read back."""
    c = claims(spark, sf_dir).select(F.col("claim_id").cast("string").alias("claim_id"), "marca", "anio", "valor")
    path = _folder(spark, "metadata")
    sinks.write_documents(c.select(F.to_json(F.struct(*c.columns)).alias("value")), path)
    return sources.read_claim_metadata(spark, path, "claim_id string, marca string, anio int, valor double")


@query(ISOTONIC)
def calibrator_saved(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A calibrator fitted, saved, loaded and applied."""
    from claimweave.plans.claims import _scored

    rows = _scored(spark, sf_dir)
    path = _folder(spark, "calibrator")
    metrics.Calibrator("isotonic").fit(rows).save(path)
    return metrics.Calibrator.load(path, "isotonic").transform(rows).select("claim_id", "pos", "confidence", "confidence_raw")


# --- images and files


def _bmp(pixels: np.ndarray) -> bytes:
    """An uncompressed 24-bit bitmap of blue, green, red rows."""
    h, w, _ = pixels.shape
    pad = b"\0" * (-3 * w % 4)
    body = b"".join(row.astype("uint8").tobytes() + pad for row in pixels[::-1])
    return b"BM" + struct.pack("<IHHI", 54 + len(body), 0, 0, 54) + struct.pack("<IiiHHIIiiII", 40, w, h, 1, 24, 0, len(body), 0, 0, 0, 0) + body


def _write_pictures(rows: DataFrame, path: str) -> None:
    """Small bitmaps <id>.bmp by the tasks: ``kind`` 0 flat, 1 columns of 0 and 255, 2 brighter to the right, 3 broken; ``v`` is the grey."""
    from pathlib import Path

    folder = path.removeprefix("file://")

    def run(batches):
        for batch in batches:
            Path(folder).mkdir(parents=True, exist_ok=True)
            for i, kind, v in zip(batch["id"], batch["kind"], batch["v"], strict=True):
                x = np.full((16, 18, 3), v)
                if kind == 1:
                    x[:, ::2], x[:, 1::2] = 0, 255
                elif kind == 2:
                    x = np.repeat(np.arange(18)[None, :, None] * 10, 16, axis=0) + np.zeros((16, 18, 3), int)
                (Path(folder) / f"{i}.bmp").write_bytes(b"BM broken" if kind == 3 else _bmp(x))
            yield pd.DataFrame({"n": [len(batch)]})

    rows.select("id", "kind", "v").mapInPandas(run, "n int").count()


_PICTURES = "with p as (select s_suppkey as id, s_suppkey % 4 as kind, s_suppkey % 256 as v from supplier)"


def _pictures(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("id"), (F.col("s_suppkey") % 4).alias("kind"), (F.col("s_suppkey") % 256).alias("v"))


@query(
    _PICTURES
    + """ select id, kind <> 3 as readable, case when kind <> 3 then 18 end as width, case when kind <> 3 then 16 end as height, case when kind <> 3 then 0e0 end as megapixels,
  case kind when 0 then case when v > 250 then 100e0 else 0e0 end when 1 then 50e0 when 2 then 0e0 end as high_pct, case kind when 0 then case when v < 15 then 100e0 else 0e0 end when 1 then 50e0 when 2 then round(200e0 / 18, 3) end as low_pct,
  case kind when 0 then cast(v as double) when 1 then 127.5e0 when 2 then 85e0 end as mean_brightness, case kind when 0 then true when 1 then false when 2 then false end as is_flat, case kind when 0 then 0 when 2 then -1 end as dhash from p"""
)
def picture_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pictures written and measured: size, exposure, sharpness and difference hash; unreadable ones are kept."""
    path = _folder(spark, "pictures")
    _write_pictures(_pictures(spark, sf_dir), path)
    found = quality.image_stats(sources.read_images(spark, path))
    i = F.regexp_extract("origin", r"(\d+)\.bmp$", 1).cast("bigint")
    return found.select(i.alias("id"), "readable", "width", "height", "megapixels", "high_pct", "low_pct", "mean_brightness", F.when(F.col("readable"), F.col("sharpness") == 0).alias("is_flat"), F.when(i % 4 != 1, F.col("dhash")).alias("dhash"))


@query(_PICTURES + " select id, case when kind <> 3 then true end as flat_left, case kind when 0 then true when 1 then false when 2 then false end as flat_whole from p")
def picture_regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sharpness of a region: the left column of a picture is flat, whatever the whole is."""
    path = _folder(spark, "pictures")
    _write_pictures(_pictures(spark, sf_dir), path)
    seen = sources.read_images(spark, path).withColumn("id", F.regexp_extract("image.origin", r"(\d+)\.bmp$", 1).cast("bigint"))
    left = quality.region_sharpness(seen.withColumn("roi", F.array(F.lit(0.0), F.lit(0.0), F.lit(1.2), F.lit(16.0)))).select("id", (F.col("sharpness") == 0).alias("flat_left"))
    whole = quality.region_sharpness(seen.withColumn("roi", F.lit(None).cast("array<double>"))).select("id", (F.col("sharpness") == 0).alias("flat_whole"))
    return left.join(whole, "id")


@query(_PICTURES + " select id, kind <> 3 as readable, case when kind = 0 then 1 else 0 end as n_vehicles from p where kind <> 3")
def injected_vehicles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A vehicle detector of the caller's, run on batches of pictures: this one sees a vehicle in flat ones."""
    path = _folder(spark, "pictures")
    _write_pictures(_pictures(spark, sf_dir), path)

    def detector(batch: pd.DataFrame) -> pd.DataFrame:
        flat = [h > 0 and len(set(np.frombuffer(d, "uint8").reshape(h, w, c)[..., 0].ravel().tolist())) == 1 for h, w, c, d in zip(batch["height"], batch["width"], batch["channels"], batch["data"], strict=True)]
        return pd.DataFrame({"origin": batch["origin"], "readable": batch["height"] > 0, "n_vehicles": [int(f) for f in flat]})

    found = quality.with_vehicles(sources.read_images(spark, path), detector, "origin string, readable boolean, n_vehicles int")
    return found.where("readable").select(F.regexp_extract("origin", r"(\d+)\.bmp$", 1).cast("bigint").alias("id"), "readable", "n_vehicles")


@query(_PICTURES + " select id, 54 + 16 * 56 as length from p where kind <> 3 union all select id, 9 from p where kind = 3")
def image_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Image files below a folder, by suffix."""
    path = _folder(spark, "pictures")
    _write_pictures(_pictures(spark, sf_dir), path)
    return sources.list_images(spark, path).select(F.regexp_extract("path", r"(\d+)\.bmp$", 1).cast("bigint").alias("id"), F.col("length").cast("int").alias("length"))


@query("select n_name || chr(10) as text, sha256(n_name || chr(10)) as sha256 from nation")
def file_hashes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SHA-256 of files, one a nation."""
    path = _folder(spark, "names")
    read_table(spark, sf_dir, "nation").select("n_name", F.col("n_name").alias("value")).repartition("n_name").write.partitionBy("n_name").text(path)
    hashes = sources.hash_files(spark, path, "*.txt")
    return hashes.select(F.concat(F.regexp_extract(F.url_decode(F.regexp_extract("path", r"n_name=([^/]*)/", 1)), "(.*)", 1), F.lit("\n")).alias("text"), "sha256")


def _jpeg(tags: list[int]) -> bytes:
    """A JPEG without pixels whose EXIF directory has these tags."""
    entries = b"".join(struct.pack("<HHII", t, 4, 1, 0) for t in tags)
    body = b"Exif\0\0II*\0" + struct.pack("<IH", 8, len(tags)) + entries + struct.pack("<I", 0)
    return b"\xff\xd8" + (b"\xff\xe1" + struct.pack(">H", len(body) + 2) + body if tags else b"") + b"\xff\xd9"


_EXIF = (271, 316, 37510, 42034, 256)


def _photographs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(path, content) of JPEGs with some of five tags, the last of which identifies nobody."""

    @F.pandas_udf("binary")
    def content(key: pd.Series) -> pd.Series:
        return key.map(lambda k: _jpeg([t for i, t in enumerate(_EXIF) if k >> i & 1]))

    return read_table(spark, sf_dir, "supplier").select(F.col("s_suppkey").cast("string").alias("path"), content(F.col("s_suppkey")).alias("content"))


_BITS = " + ".join(f"(s_suppkey >> {i} & 1)" for i in range(5))


@query(f"select cast(s_suppkey as varchar) as path, cast({_BITS} as int) as n_tags, concat_ws(',', " + ", ".join(f"case when s_suppkey >> {i} & 1 = 1 then '{t}' end" for i, t in enumerate(_EXIF[:4])) + ") as identifying from supplier")
def exif_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metadata tags of photographs, and those that identify someone."""
    return quality.exif_report(_photographs(spark, sf_dir)).select("path", "n_tags", F.array_join("identifying", ",").alias("identifying"))


@query(f"select cast(s_suppkey as varchar) as path, s_suppkey & 15 <> 0 as removed, case when s_suppkey & 15 <> 0 then 0 else cast({_BITS} as int) end as n_tags from supplier")
def exif_strip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Photographs without identifying metadata; those that had none are left as they are."""
    clean = quality.stripped(_photographs(spark, sf_dir))
    left = quality.exif_report(clean.select("path", "content"))
    return clean.select("path", "removed").join(left, "path").select("path", "removed", "n_tags")


# --- boxes and masks

_TWO = """with b as (select l_orderkey as image_id, l_linenumber as n, cast(l_partkey % 300 as double) as x1, cast(l_suppkey % 200 as double) as y1, l_partkey % 300 + 20 + l_quantity * 4 as x2, l_suppkey % 200 + 10 + l_quantity * 3 as y2 from lineitem where l_linenumber <= 2)"""


def _two_boxes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two boxes an image: the first two lines of an order."""
    x1, y1 = (F.col("l_partkey") % 300).cast("double"), (F.col("l_suppkey") % 200).cast("double")
    t = read_table(spark, sf_dir, "lineitem").where("l_linenumber <= 2")
    return t.select(F.col("l_orderkey").alias("image_id"), F.col("l_linenumber").alias("n"), x1.alias("x1"), y1.alias("y1"), (x1 + 20 + F.col("l_quantity") * 4).alias("x2"), (y1 + 10 + F.col("l_quantity") * 3).alias("y2"))


@query(
    _TWO
    + """, g as (select image_id, count(*) as c, max(x1) filter (where n = 1) as ax1, max(y1) filter (where n = 1) as ay1, max(x2) filter (where n = 1) as ax2, max(y2) filter (where n = 1) as ay2,
  max(x1) filter (where n = 2) as bx1, max(y1) filter (where n = 2) as by1, max(x2) filter (where n = 2) as bx2, max(y2) filter (where n = 2) as by2 from b group by image_id having count(*) = count(distinct n)),
u as (select image_id, c, coalesce((ax2 - ax1) * (ay2 - ay1), 0) + coalesce((bx2 - bx1) * (by2 - by1), 0) - case when ax1 is null or bx1 is null then 0 else greatest(0, least(ax2, bx2) - greatest(ax1, bx1)) * greatest(0, least(ay2, by2) - greatest(ay1, by1)) end as covered,
  case when ax1 is null or bx1 is null then 1 else 2 end as k, least(ax1, bx1) as hx from g)
select image_id, cast(round(cast(covered / 480000e0 as decimal(24,8)), 4) as double) as fraction, hx, c as n from u"""
)
def union_area(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Share of an image that boxes cover together, counted once where they overlap."""
    boxes = _two_boxes(spark, sf_dir)
    # line numbers repeat in some orders; those are left to the SQL's terms of two boxes
    whole = Window.partitionBy("image_id")
    plain = boxes.withColumn("once", F.count(F.lit(1)).over(whole) == F.size(F.collect_set("n").over(whole))).where("once").drop("once")
    sized = plain.withColumns({"width": F.lit(800.0), "height": F.lit(600.0)})
    return quality.union_area(sized).select("image_id", half_up(F.col("fraction"), 4).alias("fraction"), F.get("hull", F.lit(0)).alias("hx"), "n")


@query(_TWO + ", v as (select *, case when image_id % 3 = 0 then 2 when image_id % 3 = 1 then 7 else 0 end as class_id, (image_id % 10) / 10e0 as confidence from b), k as (select image_id, greatest(0e0, x1 - 50) as x1, greatest(0e0, y1 - 50) as y1, least(200e0, x2 - 50) as x2, least(150e0, y2 - 50) as y2, class_id from v where class_id in (2, 5, 7) and confidence >= 0.5e0) select class_id, count(*) as n, cast(sum(cast((x2 - x1) * (y2 - y1) as decimal(18,2))) as double) as area from k where x2 > x1 and y2 > y1 group by class_id")
def vehicle_boxes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Boxes of vehicles that are certain enough, cut to the image."""
    shifted = _two_boxes(spark, sf_dir).select("image_id", *[(F.col(c) - 50).alias(c) for c in ("x1", "y1", "x2", "y2")], F.when(F.col("image_id") % 3 == 0, 2).when(F.col("image_id") % 3 == 1, 7).otherwise(0).alias("class_id"), ((F.col("image_id") % 10) / 10).alias("confidence"), F.lit(200.0).alias("width"), F.lit(150.0).alias("height"))
    return quality.vehicle_boxes(shifted).groupBy("class_id").agg(F.count(F.lit(1)).alias("n"), F.sum(((F.col("x2") - F.col("x1")) * (F.col("y2") - F.col("y1"))).cast("decimal(18,2)")).cast("double").alias("area"))


_BOXES = "with r as (select o_orderkey as id, o_orderkey % 30 as x, o_custkey % 20 as y, 1 + o_custkey % 12 as w, 1 + o_orderkey % 9 as h, o_custkey % 25 as x2, o_orderkey % 25 as y2 from orders)"


def _mask_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A rectangle as polygon and a box, in images of 40 by 32 pixels."""
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    x, y, w, h = k % 30, c % 20, 1 + c % 12, 1 + k % 9
    polygon = F.array(*[v.cast("double") for v in (x, y, x + w, y, x + w, y + h, x, y + h)])
    box = F.array(*[v.cast("double") for v in (c % 25, k % 25, c % 25 + 10, k % 25 + 6)])
    return read_table(spark, sf_dir, "orders").select(k.alias("id"), polygon.alias("polygon"), box.alias("box"))


@query(
    _BOXES
    + """, s as (select id, (least(40, x + w + 1) - x) * (least(32, y + h + 1) - y) as area_old, (least(40, x2 + 10) - x2) * (least(32, y2 + 6) - y2) as area_new,
  greatest(0, least(40, x + w + 1, x2 + 10) - greatest(x, x2)) * greatest(0, least(32, y + h + 1, y2 + 6) - greatest(y, y2)) as intersection from r)
select verdict, count(*) as n, cast(sum(area_old) as bigint) as area_old, cast(sum(intersection) as bigint) as intersection from (select *, case when area_new <= 0 then 'skip_empty' when intersection / cast(area_old + area_new - intersection as double) between 0.5e0 and 0.95e0 and area_new / cast(area_old as double) between 0.3e0 and 3e0 then 'accepted' else 'rejected' end as verdict from s) t group by verdict"""
)
def mask_overlap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Masks of polygons and boxes counted pixel by pixel, and the gate on what replaces what."""
    from claimweave.operators.annotations import mask_gate

    counted = _mask_rows(spark, sf_dir).select("id", masks.mask_counts(F.col("polygon"), F.col("box"), F.lit(32), F.lit(40)).alias("m")).select("id", "m.*")
    return mask_gate(counted).groupBy("verdict").agg(F.count(F.lit(1)).alias("n"), F.sum("area_old").alias("area_old"), F.sum("intersection").alias("intersection"))


@query("select s_suppkey as id, array_to_string([cast(s_suppkey % 20 + cast(round_even(i * (4 + s_suppkey % 11) / 4e0, 0) as int) as varchar) || ' ' || cast(s_suppkey % 7 as varchar) for i in range(5)], ',') as points from supplier")
def centre_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Points along thin structures, here lines one pixel high."""
    k = F.col("s_suppkey")
    box = F.array(*[v.cast("double") for v in (k % 20, k % 7, k % 20 + 5 + k % 11, k % 7 + 1)])
    found = read_table(spark, sf_dir, "supplier").select(k.alias("id"), masks.centre_line(box, F.lit(10), F.lit(40)).alias("p"))
    return found.select("id", F.array_join(F.transform("p", lambda v: F.array_join(v, " ")), ",").alias("points"))


_PARTS = """, d as (select claim_id, pos, part, zone, claim_id % 5 as g from detections where part <> 'unknown'),
parts as (select claim_id, pos as ord, part, zone, cast((claim_id * 3 + pos * 40) % 200 as double) as px1, cast((claim_id * 5 + pos * 30) % 150 as double) as py1 from detections where zone <> 'unknown'),
boxes as (select claim_id, pos, cast((claim_id * 7 + pos * 11) % 200 as double) as x1, cast((claim_id + pos * 17) % 150 as double) as y1 from detections),
m as (select b.claim_id, b.pos, p.part, p.zone, p.ord, greatest(0e0, least(b.x1 + 60, p.px1 + 100) - greatest(b.x1, p.px1)) * greatest(0e0, least(b.y1 + 40, p.py1 + 80) - greatest(b.y1, p.py1)) / 2400e0 as raw from boxes b join parts p on b.claim_id = p.claim_id),
s as (select *, round(cast(raw as decimal(24,8)), 4)::double as overlap, case when zone in ('front_left', 'front_right', 'rear_left', 'rear_right') then 1e0 else 0.7e0 end as weight from m where raw >= 0.1e0),
z as (select *, cast(round(cast(overlap * weight as decimal(24,8)), 4) as double) as score from s),
r as (select *, row_number() over (partition by claim_id, pos order by score desc, ord) as rn from z)"""


@query(WITH + _PARTS + " select claim_id, pos, part, zone, overlap, score from r where rn = 1")
def part_overlap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Zone of every damage box from the parts detected in the same claim."""
    d = detections(spark, sf_dir)
    c, p = F.col("claim_id"), F.col("pos")
    px, py = ((c * 3 + p * 40) % 200).cast("double"), ((c * 5 + p * 30) % 150).cast("double")
    x, y = ((c * 7 + p * 11) % 200).cast("double"), ((c + p * 17) % 150).cast("double")
    parts = d.select("claim_id", F.col("pos").alias("ord"), "part", F.nullif("zone", F.lit("unknown")).alias("zone"), F.array(px, py, px + 100, py + 80).alias("part_box"))
    boxes = d.select("claim_id", "pos", F.struct("claim_id", "pos").alias("key"), F.array(x, y, x + 60, y + 40).alias("box"))
    return localize.best_zone(boxes, parts, "claim_id", "key").select("key.*", "part", "zone", "overlap", "score")


# --- values


@query(_SHAPES + ", c as (select id, least(bbox[3], bbox[4]) < 16 as small from shapes where len(bbox) = 4) select small, count(*) as n from c group by 1")
def small_crops(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Boxes too small for a classifier."""
    x, y, w, h = (F.get("bbox", F.lit(i)) for i in range(4))
    rows = _named_shapes(spark, sf_dir).where("size(bbox) = 4")
    return rows.groupBy(relabel.small_crop(F.array(x, y, x + w, y + h)).alias("small")).agg(F.count(F.lit(1)).alias("n"))


@query("select n_nationkey as id, 'data:text/plain;base64,' || to_base64(encode(n_name)) as uri from nation")
def data_uris(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("id"), data_uri(F.encode("n_name", "UTF-8"), "text/plain").alias("uri"))


@query("select l_linenumber as k, cast(sum(cast(round_even(l_quantity * 25 / 2, 0) as bigint)) as bigint) as halves from lineitem group by 1")
def rounding_to_even(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Amounts in halves of a cent rounded to even cents."""
    value = half_even(F.col("l_quantity") * 12.5 / 100)
    return read_table(spark, sf_dir, "lineitem").groupBy(F.col("l_linenumber").alias("k")).agg(F.sum(F.round(value * 100).cast("bigint")).alias("halves"))


@query(WITH + "select case when confidence >= 0.9e0 then 'high' when confidence >= 0.85e0 then 'medium' else 'low' end as mark, count(*) as n from detections group by 1")
def certainty_marks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return detections(spark, sf_dir).groupBy(relabel.certainty_mark(F.col("confidence"), 0.9, 0.85).alias("mark")).agg(F.count(F.lit(1)).alias("n"))


@query("select phrase, class from (values ('car scratch', 'scratch'), ('paint mark', 'scratch'), ('dented panel', 'dent'), ('hole', 'puncture')) t(phrase, class)")
def ontology_inversion(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Phrases of an ontology and the class each stands for; a phrase listed twice keeps the first class."""
    table = relabel.prompts_to_classes({"scratch": "car scratch . paint mark", "dent": "dented panel . paint mark", "puncture": "hole . "})
    return spark.createDataFrame(sorted(table.items()), "phrase string, class string")


@query(_SHAPES + ", t as (select id, array_to_string([printf('%.1f', p[2 * i + 1]) || ',' || printf('%.1f', p[2 * i + 2]) for i in range(len(p) // 2)], ';') as points, len(p) as n from shapes where len(p) >= 2) select id, points, n as n_numbers from t")
def points_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Polygons as text with one decimal, and back."""
    rows = _named_shapes(spark, sf_dir).withColumn("p", F.get("polygons", F.lit(0))).where("size(p) >= 2").select("id", geo.format_points(F.col("p")).alias("points"))
    return rows.withColumn("n_numbers", F.size(geo.parse_points(F.col("points"))).cast("bigint"))


@query(_SHAPES + ", b as (select id, bbox[1] as x, bbox[2] as y, bbox[3] as w, bbox[4] as h from shapes where len(bbox) = 4) select id, w * h as area, x + w as right_side, y + h as lower_side from b")
def box_corners(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Boxes as polygons of four corners: their area is the box's."""
    rows = _named_shapes(spark, sf_dir).where("size(bbox) = 4").withColumn("p", geo.box_polygon(F.col("bbox")))
    return rows.select("id", geo.shoelace_area(F.col("p")).alias("area"), F.get("p", F.lit(2)).alias("right_side"), F.get("p", F.lit(5)).alias("lower_side"))


_ACTIONS = {"verde": "pay", "ambar": "check", "rojo": "visit"}


@query("select case replace(lower(trim(lane)), 'á', 'a') when 'verde' then 'pay' when 'ambar' then 'check' when 'rojo' then 'visit' else 'by hand' end as action, count(*) as n from claim_metrics group by 1")
def mapped_default(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A word for each lane, another for all the rest."""
    lane = F.translate(F.lower(F.trim("lane")), "á", "a")
    return read_table(spark, sf_dir, "claim_metrics").groupBy(lookup.map_default(lane, _ACTIONS, "by hand").alias("action")).agg(F.count(F.lit(1)).alias("n"))


@query(WITH + ", o as (select claim_id, count(*) * 100e0 as estimated from detections group by 1) select o.claim_id, o.estimated, cast(round(cast(c.importe_real as decimal(24,8)), 2) as double) as real from o join claims c on o.claim_id = c.claim_id")
def outputs_with_truth(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Outputs beside the truth of their claim."""
    outputs = detections(spark, sf_dir).groupBy("claim_id").agg((F.count(F.lit(1)) * 100.0).alias("estimated"))
    return metrics.pair_with_truth(outputs, claims(spark, sf_dir).select("claim_id", "importe_real"), "claim_id", "importe_real").select("claim_id", "estimated", half_up(F.col("real")).alias("real"))


@query(WITH + "select claim_id, pos from detections where claim_id * 10 + conf_pct % 3 in (select distinct claim_id * 10 + conf_pct % 3 from detections where (claim_id + conf_pct % 3) % 4 > 0)")
def valid_images_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Detections of images that passed; an image stands for a claim and a shot here."""
    d = detections(spark, sf_dir).withColumn("image_id", F.col("claim_id") * 10 + F.col("conf_pct") % 3)
    verdicts = d.select("image_id", ((F.col("claim_id") + F.col("conf_pct") % 3) % 4 > 0).alias("valid")).distinct()
    return quality.valid_only(d, verdicts).select("claim_id", "pos")


@query(_BASE + "select count(*) as n, count(distinct file_name) as n_files, true as in_order from images")
def locality_sort(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Images placed by path: each task has a stretch of paths of its own, in order."""
    placed = relabel.near_files(_images(spark, sf_dir).select("id", "file_name"), "file_name").select("id", "file_name", F.spark_partition_id().alias("part"))
    parts = placed.groupBy("part").agg(F.min("file_name").alias("least"), F.max("file_name").alias("most"), F.count(F.lit(1)).alias("n"), F.countDistinct("file_name").alias("n_files"))
    met = parts.alias("a").join(parts.alias("b"), F.expr("a.part < b.part and a.most >= b.least")).agg(F.count(F.lit(1))).scalar()
    return parts.agg(F.sum("n").alias("n"), F.sum("n_files").alias("n_files"), (F.coalesce(met, F.lit(0)) == 0).alias("in_order"))


@query(
    WITH
    + """, s as (select type as label, confidence as score, (claim_id + pos) % 3 > 0 as hit from detections),
lv as (select label, score, count(*) as n, count(*) filter (where hit) as tp from s group by 1, 2),
c as (select *, cast(sum(tp) over w as double) / sum(n) over w as precision from lv window w as (partition by label order by score desc rows unbounded preceding)),
e as (select *, max(precision) over (partition by label order by score desc rows between current row and unbounded following) as best from c),
t as (select label, count(*) as n_true from s where hit or score < 0.9e0 group by 1)
select t.label, cast(round(cast(coalesce(a.area / t.n_true, 0) as decimal(24,8)), 4) as double) as ap, t.n_true from t left join (select label, sum(best * tp) as area from e group by 1) a on t.label = a.label"""
)
def average_precision(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Area under the precision-recall curve of each type."""
    rows = detections(spark, sf_dir).select(F.col("type").alias("label"), F.col("confidence").alias("score"), ((F.col("claim_id") + F.col("pos")) % 3 > 0).alias("hit"))
    truths = rows.where(F.col("hit") | (F.col("score") < 0.9)).groupBy("label").agg(F.count(F.lit(1)).alias("n_true"))
    return metrics.average_precision(rows, truths)


@query(WITH + ", n as (select claim_id, count(*) as n_detections from detections group by 1) select claim_id, n_detections * 50e0 as total from n")
def injected_estimator(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Damages handed to an estimator of the caller's; this one charges each detection alike."""
    damages = con.consolidate(detections(spark, sf_dir))
    return metrics.estimate(damages, lambda d: d.groupBy("claim_id").agg((F.sum("n_detections") * 50.0).alias("total")), ("claim_id", "total"))


@query("select case when vec_id % 2 = 0 then 'dent' else 'puncture' end as fine, 'classifier' as method, vec_id % 4 = 0 as needs_review, count(*) as n from embeddings where vec_id % 3 = 0 group by all union all select 'crack', 'direct', false, count(*) from embeddings where vec_id % 3 <> 0")
def injected_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Coarse labels made fine by a classifier of the caller's in place of the cosine scores."""
    from claimweave.functions.vocabulary import COARSE_TO_FINE

    rows = read_table(spark, sf_dir, "embeddings").select("vec_id", F.when(F.col("vec_id") % 3 == 0, "dent").otherwise("crack").alias("coarse"), F.col("embedding").alias("v"))
    protos = spark.createDataFrame([], "fine string, prototype array<double>")
    classifier = lambda open_rows: open_rows.select("vec_id", F.when(F.col("vec_id") % 2 == 0, "dent").otherwise("puncture").alias("fine"), F.when(F.col("vec_id") % 4 == 0, 0.5).otherwise(0.9).alias("probability"))
    found = relabel.assign_fine(rows, "vec_id", "coarse", "v", COARSE_TO_FINE, protos, classifier=classifier)
    return found.groupBy("fine", "method", "needs_review").agg(F.count(F.lit(1)).alias("n"))


# --- streams


@query("select user_id, count(*) as n from (select distinct user_id, event_type from events) t group by 1")
def first_arrivals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Kinds of events of each user, repeats within the watermark left out, as a stream."""
    from claimweave.plans.claims import _run_stream, _stream
    from claimweave.streaming.monitor import first_arrivals as first

    events = _stream(spark, sf_dir, "events").withColumn("key", F.concat_ws("|", "user_id", "event_type"))
    return _run_stream(first(events, "ts", "key"), "arrivals", "append").groupBy("user_id").agg(F.count(F.lit(1)).alias("n"))
