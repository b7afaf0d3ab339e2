"""Filters, joins and identities of annotation datasets (COCO-like tables)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from claimweave.functions.vocabulary import CLASS_MAP, EXCLUDED_PATTERNS
from claimweave.operators.staging import stage


def map_class(label: Column, mapping: dict[str, str | None] = CLASS_MAP) -> Column:
    """Damage type of a source's label, or null to leave it out.

    The exact label counts first, and a label listed as left out stays out;
    then the label in lower case; labels with an excluded part, and unknown
    ones, are left out.
    """
    exact = F.create_map(*[x for k, v in mapping.items() for x in (F.lit(k), F.lit(v).cast("string"))])
    lower: dict[str, str | None] = {}
    for k, v in mapping.items():
        lower.setdefault(k.lower(), v)
    folded = F.create_map(*[x for k, v in lower.items() for x in (F.lit(k), F.lit(v).cast("string"))])
    return F.when(F.map_contains_key(exact, label), F.try_element_at(exact, label)).when(F.map_contains_key(folded, F.lower(label)), F.try_element_at(folded, F.lower(label)))


def excluded_label(label: Column, excluded: tuple[str, ...] = EXCLUDED_PATTERNS) -> Column:
    return reduce(lambda a, b: a | b, [F.contains(F.lower(label), F.lit(p)) for p in excluded])


def drop_small(annotations: DataFrame, min_area: float) -> DataFrame:
    """Without annotations of an area between 0 and the minimum; no area at all passes."""
    area = F.coalesce("area", F.lit(0.0))
    return annotations.where(~((area > 0) & (area < min_area)))


def keep_polygons(polygons: Column, min_points: int = 4) -> Column:
    """Polygons of enough points."""
    return F.filter(polygons, lambda p: F.size(p) >= 2 * min_points)


def drop_thin(annotations: DataFrame, polygons: str, min_points: int = 4) -> DataFrame:
    """Short polygons removed, annotations that had some and keep none dropped; a missing or empty outline passes."""
    had = F.coalesce(F.size(F.col(polygons)) > 0, F.lit(False))
    kept = keep_polygons(F.col(polygons), min_points)
    return annotations.where(~had | (F.size(kept) > 0)).withColumn(polygons, F.when(had, kept).otherwise(F.col(polygons)))


def confidence_floor(images: DataFrame, annotations: DataFrame, floor: float, image_key: str = "image_id") -> tuple[DataFrame, DataFrame]:
    """Annotations at or above the floor (a missing confidence is 1) and the images that keep one; a floor of 0 changes nothing."""
    if floor <= 0:
        return images, annotations
    kept = annotations.where(F.coalesce("fine_conf", F.lit(1.0)) >= floor)
    return images.join(kept.select(F.col(image_key).alias("id")), "id", "left_semi"), kept


def annotated_images(images: DataFrame, annotations: DataFrame) -> DataFrame:
    return images.join(annotations.select(F.col("image_id").alias("id")), "id", "left_semi")


def without_orphans(annotations: DataFrame, images: DataFrame) -> DataFrame:
    return annotations.join(images.select(F.col("id").alias("image_id")), "image_id", "left_semi")


def annotation_counts(images: DataFrame, annotations: DataFrame) -> DataFrame:
    """(id, n) of every image, those without annotations with 0."""
    counts = annotations.groupBy(F.col("image_id").alias("id")).agg(F.count(F.lit(1)).alias("n"))
    return images.select("id").join(counts, "id", "left").select("id", F.coalesce("n", F.lit(0)).alias("n"))


def rebase_ids(parts: list[tuple[DataFrame, DataFrame]]) -> tuple[DataFrame, DataFrame]:
    """Union of (images, annotations) datasets with ids moved past those before: offset = largest id so far + 1.

    Only two maxima a dataset reach the driver.  An annotation of an unknown image keeps its image id.
    """
    images_out, annotations_out = [], []
    next_image = next_annotation = 0
    for images, annotations in parts:
        i0, a0 = next_image, next_annotation
        moved = images.withColumn("id", F.col("id") + i0)
        real = images.select(F.col("id").alias("image_id")).distinct().withColumn("__known", F.lit(True))
        ann = annotations.join(real, "image_id", "left").withColumn("image_id", F.when(F.col("__known"), F.col("image_id") + i0).otherwise(F.col("image_id"))).withColumn("id", F.col("id") + a0).drop("__known")
        images_out.append(moved)
        annotations_out.append(ann.select(*annotations.columns))
        top_i, top_a = images.agg(F.max("id")).first()[0], annotations.agg(F.max("id")).first()[0]
        next_image = next_image if top_i is None else i0 + top_i + 1
        next_annotation = next_annotation if top_a is None else a0 + top_a + 1
    return reduce(DataFrame.unionByName, images_out), reduce(DataFrame.unionByName, annotations_out)


def dense_image_ids(rows: DataFrame, image: str, order: str) -> DataFrame:
    """``rows`` with image_id counted from 0 in order of each image's first row.

    Images are numbered by range partitions: rank within one, plus the sizes of
    those before, so no single task orders them all.
    """
    first = rows.groupBy(image).agg(F.min(order).alias("__first"))
    n = max(1, rows.sparkSession.sparkContext.defaultParallelism)
    ranged = first.repartitionByRange(n, "__first", image).withColumn("__part", F.spark_partition_id())
    parts = stage(ranged, "dense").df
    sizes = {r["__part"]: r["n"] for r in parts.groupBy("__part").agg(F.count(F.lit(1)).alias("n")).collect()}
    offsets, total = {}, 0
    for part in sorted(sizes):
        offsets[part] = total
        total += sizes[part]
    before = F.create_map(*[F.lit(x) for kv in (offsets or {0: 0}).items() for x in kv])
    rank = F.row_number().over(Window.partitionBy("__part").orderBy("__first", image)) - 1
    ids = parts.select(image, (F.element_at(before, F.col("__part")) + rank).cast("bigint").alias("image_id"))
    return rows.join(ids, image)


def dominant_class(rows: DataFrame, key: str, label: str, pos: str) -> DataFrame:
    """(key, label) most frequent per key, the one seen first among equals."""
    counts = rows.groupBy(key, label).agg(F.count(F.lit(1)).alias("__n"), F.min(pos).alias("__p"))
    return counts.groupBy(key).agg(F.max_by(label, F.struct(F.col("__n"), (-F.col("__p")).alias("p"))).alias(label))


def mask_gate(rows: DataFrame, min_iou: float = 0.5, max_iou: float = 0.95, min_ratio: float = 0.3, max_ratio: float = 3.0) -> DataFrame:
    """``rows`` (intersection, area_old, area_new) with iou, area ratio and the verdict on the new mask."""
    union = F.col("area_old") + F.col("area_new") - F.col("intersection")
    iou = F.when(union > 0, F.col("intersection") / union).otherwise(0.0)
    ratio = F.when(F.col("area_old") > 0, F.col("area_new") / F.col("area_old")).otherwise(0.0)
    good = iou.between(min_iou, max_iou) & ratio.between(min_ratio, max_ratio)
    return rows.withColumns({"iou": iou, "area_ratio": ratio}).withColumn("verdict", F.when(F.col("area_new") <= 0, "skip_empty").when(good, "accepted").otherwise("rejected"))


def split_class_matrix(rows: DataFrame, split: str, label: str, labels: tuple[str, ...]) -> DataFrame:
    """Annotations per split and class with a TOTAL row over all rows."""
    counts = rows.rollup(split).agg(*[F.count_if(F.col(label) == c).alias(c) for c in labels], F.count(F.lit(1)).alias("total"), F.grouping(split).alias("__g"))
    return counts.select(F.when(F.col("__g") == 1, "TOTAL").otherwise(F.coalesce(split, F.lit("none"))).alias(split), *labels, "total")
