"""Queries of the general data-processing problems 3 and 5, with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimweave.operators import nested, orphans
from claimweave.operators.orphans import ForeignKey
from claimweave.session import read_table

IMAGE_OF_ANNOTATION = ForeignKey("coco_annotations", "id", "image_id", "coco_images", "id", at="created_at", start="ingested_at", end="deleted_at")
CATEGORY_OF_ANNOTATION = ForeignKey("coco_annotations", "id", "category_id", "coco_categories", "id", at="created_at", start="created_at", end="deleted_at")
IMAGE_OF_ASSIGNMENT = ForeignKey("split_map", "map_id", "image_id", "coco_images", "id", at="assigned_at", start="ingested_at", end="deleted_at")
BUILD_OF_IMAGE = ForeignKey("coco_images", "id", "build_id", "leakage_audit", "build_id", at="ingested_at")


def _tables(spark: SparkSession, sf_dir: str, *names: str) -> dict[str, DataFrame]:
    return {n: read_table(spark, sf_dir, n) for n in names}


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nested.evaluation_children(read_table(spark, sf_dir, "inference_raw"), "payload")


def p3_occurrences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nested.shred(read_table(spark, sf_dir, "inference_raw"), "rec_id", "payload").occurrences


def p3_statuses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How the payloads are: whole, null, empty or broken."""
    return p3_occurrences(spark, sf_dir).groupBy("status").agg(F.count(F.lit(1)).alias("n"), F.count("root_hash").alias("n_roots"))


def p3_objects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nested.shred(read_table(spark, sf_dir, "inference_raw"), "rec_id", "payload").objects


def p3_bridge(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nested.shred(read_table(spark, sf_dir, "inference_raw"), "rec_id", "payload").bridge


def _cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = _tables(spark, sf_dir, "coco_annotations", "coco_images", "coco_categories", "split_map", "leakage_audit")
    return orphans.orphan_cascade(tables, [BUILD_OF_IMAGE, IMAGE_OF_ANNOTATION, CATEGORY_OF_ANNOTATION, IMAGE_OF_ASSIGNMENT])


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of the cascade over images, annotations and assignments, what lacks a target of its own; what is lost with its image is in the report."""
    return _cascade(spark, sf_dir).where("kind = 'direct' and ref_table <> 'coco_images'").select("ref_table", "row_id", "field").distinct()


def p5_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return orphans.orphan_report(_cascade(spark, sf_dir)).select(
        "ref_table", "field", "month", "kind", F.col("n_references").cast("bigint"), F.col("n_rows").cast("bigint"), F.col("n_targets").cast("bigint")
    )


QUERIES = {
    "p3_found": p3_found,
    "p3_occurrences": p3_occurrences,
    "p3_statuses": p3_statuses,
    "p3_objects": p3_objects,
    "p3_bridge": p3_bridge,
    "p5_found": p5_found,
    "p5_report": p5_report,
}

_TARGETS = """
with images as (select id, min(ingested_at) as held_from, max(deleted_at) as held_to from coco_images group by id),
refs as (
  select 'coco_annotations' as ref_table, a.id as row_id, 'image_id' as field, cast(a.image_id as varchar) as ref_value, a.created_at as seen_at,
         i.held_from, i.held_to from coco_annotations a left join images i on a.image_id = i.id where a.image_id is not null
  union all
  select 'coco_annotations', a.id, 'category_id', cast(a.category_id as varchar), a.created_at, c.created_at, c.deleted_at
         from coco_annotations a left join coco_categories c on a.category_id = c.id where a.category_id is not null
  union all
  select 'split_map', s.map_id, 'image_id', cast(s.image_id as varchar), s.assigned_at, i.held_from, i.held_to
         from split_map s left join images i on s.image_id = i.id where s.image_id is not null
),
direct as (select distinct ref_table, row_id, field, ref_value, seen_at from refs where held_from is null or seen_at < held_from or seen_at >= held_to)
"""

ORACLES = {
    "p3_statuses": """
with s as (select case when payload is null then 'null' when trim(ltrim(payload, chr(65279)), chr(32) || chr(9) || chr(10) || chr(13)) = '' then 'empty' when json_valid(ltrim(payload, chr(65279))) then 'ok' else 'broken' end as status from inference_raw)
select status, count(*) as n, case when status = 'ok' then count(*) else 0 end as n_roots from s group by 1""",
    "p5_found": _TARGETS + "select distinct ref_table, row_id, field from direct",
    "p5_report": _TARGETS.rstrip()
    + """,
lost_images as (select distinct i.id, cast(i.build_id as varchar) as ref_value, i.ingested_at as seen_at from coco_images i
  where i.build_id is not null and not exists (select 1 from leakage_audit l where l.build_id = i.build_id)),
inherited as (
  select distinct 'coco_annotations' as ref_table, a.id as row_id, 'image_id' as field, cast(a.image_id as varchar) as ref_value, a.created_at as seen_at
    from coco_annotations a where a.image_id in (select id from lost_images)
  union
  select distinct 'split_map', s.map_id, 'image_id', cast(s.image_id as varchar), s.assigned_at from split_map s where s.image_id in (select id from lost_images)
),
every_one as (
  select *, 'direct' as kind from direct
  union all select 'coco_images', id, 'build_id', ref_value, seen_at, 'direct' from lost_images
  union all select n.*, 'inherited' from inherited n where not exists (select 1 from direct d where d.ref_table = n.ref_table and d.row_id = n.row_id and d.field = n.field)
)
select ref_table, field, strftime(seen_at, '%Y-%m') as month, kind, count(*) as n_references, count(distinct row_id) as n_rows, count(distinct ref_value) as n_targets
from every_one group by all""",
}
