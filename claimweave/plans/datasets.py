"""Queries over annotation datasets, images and vectors, with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimweave.functions import geometry as geo
from claimweave.functions.numeric import half_up
from claimweave.functions.times import nulls_last
from claimweave.functions.vocabulary import COARSE_TO_FINE, DAMAGE_TYPES, PART_ZONE, SIDE_ZONES
from claimweave.operators import annotations as ann
from claimweave.operators import lookup, neardup, quality, relabel, split
from claimweave.operators.graph import connected_components
from claimweave.operators.skew import lookup_join
from claimweave.operators.staging import stage
from claimweave.plans.adapter import WITH, detections
from claimweave.session import read_table
from claimweave.sinks import files as sinks

QUERIES, ORACLES = {}, {}


def query(sql: str | None = None):
    """Register a query under its own name, with its SQL."""

    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


def _images(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per image id, the first ingested, of those ingested together the smallest."""
    t = read_table(spark, sf_dir, "coco_images").where("id is not null")
    fields = ("file_name", "width", "height", "source", "build_id", "dhash")
    return t.groupBy("id").agg(F.min(F.struct(nulls_last("ingested_at").alias("__at"), *fields)).alias("i")).select("id", *[f"i.{f}" for f in fields])


def _annotations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per annotation id, the first received, of those received together the smallest; outlines parsed."""
    t = read_table(spark, sf_dir, "coco_annotations").where("id is not null")
    fields = ("image_id", "category_id", "bbox", "area", "segmentation", "fine_conf")
    one = t.groupBy("id").agg(F.min(F.struct(nulls_last("received_at").alias("__at"), *fields)).alias("a")).select("id", *[f"a.{f}" for f in fields])
    return one.withColumn("polygons", F.from_json("segmentation", "array<array<double>>"))


_BASE = """
with images as (select * from (select *, row_number() over (partition by id order by ingested_at) as rn from coco_images where id is not null) t where rn = 1),
anns as (select *, case when segmentation like '[%' then segmentation::json::double[][] end as polygons from (select *, row_number() over (partition by id order by received_at) as rn from coco_annotations where id is not null) t where rn = 1)"""
_R = "cast(round(cast({x} as decimal(24,8)), {n}) as double)"

# --- labels and filters

_LABELS = ("Dent", "SCRATCH", "Lamp Broken", "Tire Flat", "mop_lom", "vo_kinh", "damage", "Window Crack", "something", "minor")


def _label_sql() -> str:
    return "case (l_orderkey + l_linenumber) % 10 " + " ".join(f"when {i} then '{v}'" for i, v in enumerate(_LABELS)) + " end"


@query(
    f"""with l as (select {_label_sql()} as label from lineitem)
select label, case label when 'Dent' then 'dent' when 'SCRATCH' then 'scratch' when 'Lamp Broken' then 'broken_light' when 'mop_lom' then 'dent' when 'minor' then 'scratch' end as type,
  regexp_matches(lower(label), 'tire|tyre|flat|glass|windshield|window|luna|cristal|parabrisas') as excluded, count(*) as n from l group by 1, 2, 3"""
)
def class_mapping(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = ((F.col("l_orderkey") + F.col("l_linenumber")) % 10).cast("int")
    labels = read_table(spark, sf_dir, "lineitem").select(F.element_at(F.array(*[F.lit(v) for v in _LABELS]), n + 1).alias("label"))
    return labels.groupBy("label", ann.map_class(F.col("label")).alias("type"), ann.excluded_label(F.col("label")).alias("excluded")).agg(F.count(F.lit(1)).alias("n"))


@query(_BASE + "select id, area from anns where not (coalesce(area, 0) > 0 and coalesce(area, 0) < 5000)")
def min_area_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.drop_small(_annotations(spark, sf_dir), 5000.0).select("id", "area")


@query(_BASE + "select id, coalesce(len(polygons), -1) as n_polygons from anns where coalesce(len(polygons), 0) = 0 or len([p for p in polygons if len(p) >= 8]) > 0")
def polygon_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.drop_thin(_annotations(spark, sf_dir), "polygons").select("id", F.coalesce(F.when(F.col("polygons").isNotNull(), F.size("polygons")), F.lit(-1)).cast("bigint").alias("n_polygons"))


_SHOELACE = "abs(list_sum([p[2 * i + 1] * p[2 * ((i + 1) % (len(p) // 2)) + 2] - p[2 * ((i + 1) % (len(p) // 2)) + 1] * p[2 * i + 2] for i in range(len(p) // 2)])) / 2"
_FIRST = _BASE + ", first as (select id, image_id, category_id, polygons[1] as p from anns where len(polygons) > 0 and len(polygons[1]) >= 6)"


@query(_FIRST + f" select id, {_R.format(x=_SHOELACE, n=2)} as area from first")
def shoelace(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = F.get("polygons", F.lit(0))
    return _annotations(spark, sf_dir).where(F.size(p) >= 6).select("id", half_up(geo.shoelace_area(p)).alias("area"))


@query(_FIRST + ", xy as (select id, [p[2 * i + 1] for i in range(len(p) // 2)] as xs, [p[2 * i + 2] for i in range(len(p) // 2)] as ys from first) select id, list_min(xs) as x, list_min(ys) as y, list_max(xs) - list_min(xs) as w, list_max(ys) - list_min(ys) as h from xy")
def polygon_bbox(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = F.get("polygons", F.lit(0))
    box = geo.polygon_box(p)
    return _annotations(spark, sf_dir).where(F.size(p) >= 6).select("id", *[F.get(box, F.lit(i)).alias(n) for i, n in enumerate("xywh")])


@query(
    _FIRST
    + """, n as (select f.id, f.category_id, f.p, i.width as w, i.height as h from first f join images i on f.image_id = i.id)
select id, coalesce(category_id, -1) || ' ' || array_to_string([printf('%.6f', cast(round(cast(greatest(0e0, least(1e0, p[i + 1] / case when i % 2 = 0 then w else h end)) as decimal(24,8)), 6) as double)) for i in range(len(p))], ' ') as line from n where len(p) >= 8 and w > 0 and h > 0"""
)
def yolo_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Label lines of each annotation's first polygon."""
    images = _images(spark, sf_dir).select(F.col("id").alias("image_id"), F.col("width").cast("double").alias("width"), F.col("height").cast("double").alias("height"))
    rows = _annotations(spark, sf_dir).join(images, "image_id")
    line = geo.normalise_polygon(F.get("polygons", F.lit(0)), F.col("width"), F.col("height"))
    return rows.withColumn("n", line).where(F.size("n") > 0).select("id", geo.label_line(F.coalesce("category_id", F.lit(-1)), F.col("n")).alias("line"))


@query(_BASE + "select id from anns where len(bbox) = 4 and bbox[3] > 0 and bbox[4] > 0")
def bbox_validity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _annotations(spark, sf_dir).where(geo.valid_box(F.col("bbox"))).select("id")


@query(
    _BASE
    + """, b as (select a.id, a.bbox[1] as x, a.bbox[2] as y, a.bbox[3] as w, a.bbox[4] as h, greatest(a.bbox[3], a.bbox[4]) * 0.15e0 as p, i.width as iw, i.height as ih
  from anns a join images i on a.image_id = i.id where len(bbox) = 4 and bbox[3] > 0 and bbox[4] > 0),
c as (select id, greatest(0, cast(trunc(x - p) as int)) as x1, greatest(0, cast(trunc(y - p) as int)) as y1, least(iw, cast(trunc(x + w + p) as int)) as x2, least(ih, cast(trunc(y + h + p) as int)) as y2, iw, ih from b)
select id, case when x2 > x1 and y2 > y1 then x1 || ',' || y1 || ',' || x2 || ',' || y2 else '0,0,' || least(8, iw) || ',' || least(8, ih) end as crop from c"""
)
def padded_crops(spark: SparkSession, sf_dir: str) -> DataFrame:
    images = _images(spark, sf_dir).select(F.col("id").alias("image_id"), "width", "height")
    rows = _annotations(spark, sf_dir).where(geo.valid_box(F.col("bbox"))).join(images, "image_id")
    return rows.select("id", F.array_join(geo.padded_crop(F.col("bbox"), F.col("width"), F.col("height")), ",").alias("crop"))


# --- joins of images and annotations


@query(_BASE + "select id from images i where exists (select 1 from anns a where a.image_id = i.id)")
def images_with_anns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.annotated_images(_images(spark, sf_dir), _annotations(spark, sf_dir)).select("id")


@query(_BASE + "select id from anns a where exists (select 1 from images i where i.id = a.image_id)")
def anns_without_orphans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.without_orphans(_annotations(spark, sf_dir), _images(spark, sf_dir)).select("id")


@query(_BASE + "select i.id, count(a.id) as n from images i left join anns a on a.image_id = i.id group by i.id")
def image_ann_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.annotation_counts(_images(spark, sf_dir), _annotations(spark, sf_dir))


@query(_BASE + "select a.id, i.source, c.name from anns a left join images i on a.image_id = i.id left join coco_categories c on a.category_id = c.id")
def annotation_context(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every annotation with its image's source and category's name, hot placeholder keys kept apart."""
    images = _images(spark, sf_dir).select(F.col("id").alias("image_id"), "source")
    named = lookup_join(_annotations(spark, sf_dir).select("id", "image_id", "category_id"), images, "image_id")
    categories = read_table(spark, sf_dir, "coco_categories").select(F.col("id").alias("category_id"), "name")
    return named.join(categories, "category_id", "left").select("id", "source", "name")


@query(_BASE + ", kept as (select * from anns where coalesce(fine_conf, 1) >= 0.8e0) select (select count(*) from kept) as n_annotations, (select count(*) from images i where exists (select 1 from kept k where k.image_id = i.id)) as n_images")
def conf_floor(spark: SparkSession, sf_dir: str) -> DataFrame:
    images, kept = ann.confidence_floor(_images(spark, sf_dir), _annotations(spark, sf_dir), 0.8)
    return kept.agg(F.count(F.lit(1)).alias("n_annotations")).select("n_annotations", images.agg(F.count(F.lit(1))).scalar().alias("n_images"))


@query(
    _BASE
    + """, m as (select (select max(id) + 1 from images where build_id % 2 = 0) as i0, (select max(a.id) + 1 from anns a join images i on a.image_id = i.id where i.build_id % 2 = 0) as a0)
select a.id + case when i.build_id % 2 = 0 then 0 else a0 end as id, a.image_id + case when i.build_id % 2 = 0 then 0 else i0 end as image_id from anns a join images i on a.image_id = i.id, m"""
)
def merge_rebase(spark: SparkSession, sf_dir: str) -> DataFrame:
    images, rows = _images(spark, sf_dir), _annotations(spark, sf_dir)
    parts = []
    for odd in (0, 1):
        some = images.where(F.col("build_id") % 2 == odd).select("id")
        parts.append((some, rows.select("id", "image_id").join(some.select(F.col("id").alias("image_id")), "image_id", "left_semi").select("id", "image_id")))
    return ann.rebase_ids(parts)[1]


@query(_BASE + ", c as (select image_id, category_id, count(*) as n, min(id) as p from anns where image_id is not null and category_id is not null group by 1, 2) select image_id, category_id from (select *, row_number() over (partition by image_id order by n desc, p) as rn from c) t where rn = 1")
def dominant_class(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.dominant_class(_annotations(spark, sf_dir).where("image_id is not null and category_id is not null"), "image_id", "category_id", "id")


@query(_BASE + ", f as (select image_id, min(id) as p from anns where image_id is not null group by 1) select image_id, cast(row_number() over (order by p, image_id) - 1 as bigint) as dense_id from f")
def dense_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _annotations(spark, sf_dir).where("image_id is not null").select("id", F.col("image_id").alias("image"))
    return ann.dense_image_ids(rows, "image", "id").select(F.col("image").alias("image_id"), F.col("image_id").alias("dense_id")).distinct()


# --- splits

_DOMINANT = ", c as (select image_id, category_id, count(*) as n, min(id) as p from anns where image_id is not null and category_id is not null group by 1, 2), dom as (select image_id, category_id from (select *, row_number() over (partition by image_id order by n desc, p) as rn from c) t where rn = 1)"


@query(
    _BASE + _DOMINANT + """, r as (select *, row_number() over (partition by category_id order by md5('42:' || image_id), image_id) - 1 as pos, count(*) over (partition by category_id) as n from dom)
select image_id, category_id, case when pos < greatest(1, floor(n * 0.7e0)) then 'train' when pos < greatest(1, floor(n * 0.7e0)) + greatest(1, floor(n * 0.2e0)) then 'val' else 'test' end as split from r"""
)
def stratified_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _annotations(spark, sf_dir).where("image_id is not null and category_id is not null")
    return split.stratified_split(rows, "image_id", "category_id", "id")


_PATTERN = r"[a-zA-Z]+[-_ ]?\d+"
_GROUPED = (
    _BASE
    + rf""", stems as (select id, regexp_extract(file_name, '([^/]+?)(\.[^./]*)?$', 1) as stem from images),
keyed as (select id, coalesce(nullif(regexp_extract(stem, '^(?:([a-zA-Z]+[-_ ]?[0-9]+))', 1), ''), stem) as k from stems),
groups as (select k.id, g.group_id from keyed k join (select k, min(id) as group_id from keyed group by 1) g on k.k = g.k),
gc as (select g.group_id, a.category_id, count(*) as n, min(a.id) as p from anns a join groups g on a.image_id = g.id where a.category_id is not null group by 1, 2),
gd as (select group_id, category_id from (select *, row_number() over (partition by group_id order by n desc, p) as rn from gc) t where rn = 1),
s as (select d.group_id, gd.category_id from (select distinct group_id from groups) d left join gd on d.group_id = gd.group_id),
r as (select *, row_number() over (partition by category_id order by md5('42:' || group_id), group_id) - 1 as pos, count(*) over (partition by category_id) as n from s),
t as (select *, least(round_even(n * 0.7e0, 0), n) as n_train, least(round_even(n * 0.2e0, 0), n - least(round_even(n * 0.7e0, 0), n)) as n_val from r),
assigned as (select g.id, g.group_id, case when pos < n_train then 'train' when pos < n_train + n_val then 'val' else 'test' end as split from groups g join t on g.group_id = t.group_id)"""
)


def _groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    keyed = _images(spark, sf_dir).withColumn("k", split.group_key(F.col("file_name"), f"({_PATTERN})"))
    return split.image_groups(keyed, "k")


def _assigned(spark: SparkSession, sf_dir: str) -> DataFrame:
    return split.grouped_split(_groups(spark, sf_dir), _annotations(spark, sf_dir).where("category_id is not null").select(F.col("id").alias("ann_id"), "image_id", "category_id"), "category_id", "ann_id")


@query(_GROUPED + " select id, group_id, split from assigned")
def grouped_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _assigned(spark, sf_dir)


@query(_GROUPED + " select count(*) as n_groups, count(*) filter (where n > 1) as n_crossing from (select group_id, count(distinct split) as n from assigned group by 1) t")
def leakage_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    assigned = stage(_assigned(spark, sf_dir), "assigned").df
    return assigned.agg(F.countDistinct("group_id").alias("n_groups")).select("n_groups", split.crossing_groups(assigned).agg(F.count(F.lit(1))).scalar().alias("n_crossing"))


@query(
    _GROUPED
    + """, m as (select coalesce(s.split, 'none') as split, c.name from anns a left join assigned s on a.image_id = s.id left join coco_categories c on a.category_id = c.id)
select case when grouping(split) = 1 then 'TOTAL' else split end as split, """
    + ", ".join(f"count(*) filter (where name = '{t}') as {t}" for t in DAMAGE_TYPES)
    + ", count(*) as total from m group by rollup(split)"
)
def split_class_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = _assigned(spark, sf_dir).select(F.col("id").alias("image_id"), "split")
    names = read_table(spark, sf_dir, "coco_categories").select(F.col("id").alias("category_id"), "name")
    rows = _annotations(spark, sf_dir).join(placed, "image_id", "left").join(names, "category_id", "left").select(F.coalesce("split", F.lit("none")).alias("split"), "name")
    return ann.split_class_matrix(rows, "split", "name", DAMAGE_TYPES)


# --- near-duplicates and vectors


@query("select vec_id, cast(list_sum([case when embedding[i + 1] < embedding[i + 2] then cast(pow(2, 55 - i) as bigint) else 0 end for i in range(56)]) as bigint) as code from embeddings")
def dhash_bits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "embeddings").select("vec_id", neardup.dhash_of_vector(F.col("embedding"), 56).alias("code"))


_NEAR = _BASE + ", h as (select id, dhash from images where dhash is not null), pairs as (select a.id as id_a, b.id as id_b, cast(bit_count(xor(a.dhash, b.dhash)) as int) as distance from h a join h b on a.id < b.id and bit_count(xor(a.dhash, b.dhash)) <= 6)"


@query(_NEAR + " select * from pairs")
def near_dup_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_pairs(_images(spark, sf_dir), "id", "dhash", 6)


@query(
    _NEAR.replace("with images", "with recursive images", 1)
    + """, e as (select id_a as a, id_b as b from pairs union select id_b, id_a from pairs), reach as (select a as node, b as seen from e union select r.node, e.b from reach r join e on r.seen = e.a)
select node, least(node, min(seen)) as component from reach group by node"""
)
def near_dup_components(spark: SparkSession, sf_dir: str) -> DataFrame:
    return connected_components(neardup.near_pairs(_images(spark, sf_dir), "id", "dhash", 6), "id_a", "id_b")


_PROTO = """with u as (select vec_id, label, [x / sqrt(list_sum([cast(y as double) * y for y in embedding])) for x in [cast(z as double) for z in embedding]] as u from embeddings),
cells as (select label, i, avg(u[i + 1]) as m from u, range(64) r(i) group by 1, 2),
protos as (select label, list(m order by i) as p from cells group by 1),
unitp as (select label, [x / sqrt(list_sum([y * y for y in p])) for x in p] as p from protos)"""


@query(_PROTO + f" select label, cast(i as int) as i, {_R.format(x='p[i + 1]', n=5)} as v from unitp, range(64) r(i)")
def prototypes(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = relabel.prototypes(read_table(spark, sf_dir, "embeddings"), "label", "embedding")
    return found.select("label", F.posexplode("prototype").alias("i", "v")).select("label", "i", half_up(F.col("v"), 5).alias("v"))


@query(_PROTO + ", s as (select u.vec_id, p.label, round(list_sum([u.u[i + 1] * p.p[i + 1] for i in range(64)]) * 100, 9) as s from u, unitp p) select vec_id, label from (select *, row_number() over (partition by vec_id order by s desc, label) as rn from s) t where rn = 1")
def zero_shot_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The nearest prototype of every vector among all labels."""
    rows = read_table(spark, sf_dir, "embeddings")
    protos = stage(relabel.prototypes(rows, "label", "embedding"), "prototypes").df
    labels = protos.agg(F.collect_list("label")).scalar()
    return relabel.score_candidates(rows.select("vec_id", "embedding").withColumn("candidates", labels), "vec_id", "embedding", "candidates", protos).select("vec_id", "label")


def _fine(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read_table(spark, sf_dir, "embeddings")
    names = F.element_at(F.array(*[F.lit(t) for t in DAMAGE_TYPES]), (F.col("label") % len(DAMAGE_TYPES) + 1).cast("int"))
    protos = stage(relabel.prototypes(rows.withColumn("fine", names), "fine", "embedding"), "prototypes").df
    coarse = F.element_at(F.array(*[F.lit(c) for c in (*COARSE_TO_FINE, "?")]), (F.col("vec_id") % (len(COARSE_TO_FINE) + 1) + 1).cast("int"))
    vector = F.when(F.col("vec_id") % 11 != 0, F.col("embedding"))
    return relabel.assign_fine(rows.select("vec_id", coarse.alias("coarse"), vector.alias("v")), "vec_id", "coarse", "v", COARSE_TO_FINE, protos)


@query("with r as (select vec_id % 6 as c, vec_id % 11 <> 0 as has from embeddings) select case when c = 5 then 'unmapped' when c in (2, 3) then 'direct' when has then 'classifier' else 'first_candidate' end as method, count(*) as n from r group by 1")
def relabel_methods(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _fine(spark, sf_dir).groupBy("method").agg(F.count(F.lit(1)).alias("n"))


@query(WITH + ", r as (select claim_id, pos, type, confidence, row_number() over (partition by type order by confidence, claim_id * 100 + pos) as up, row_number() over (partition by type order by confidence desc, claim_id * 100 + pos) as down from detections) select type, claim_id, pos, confidence from r where up <= 3 or down <= 4")
def spotcheck_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The three least and four most certain detections of each type: a sample is what this operator is for."""
    rows = detections(spark, sf_dir).select("claim_id", "pos", "type", "confidence", (F.col("claim_id") * 100 + F.col("pos")).alias("id"))
    return relabel.spot_check(rows, "type", "confidence", "id", 7).select("type", "claim_id", "pos", "confidence")


@query(WITH + ", m as (select claim_id, sum(conf_pct) / cast(count(*) as double) as score from detections group by 1) select claim_id, cast(round(cast(score as decimal(24,8)), 4) as double) as score from m order by cast(round(cast(score as decimal(24,8)), 4) as double), claim_id limit 10")
def review_priority_top10(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten claims whose detections are the least certain: a top-k report."""
    mean = half_up(F.sum("conf_pct") / F.count(F.lit(1)).cast("double"), 4)
    return detections(spark, sf_dir).groupBy("claim_id").agg(mean.alias("score")).orderBy("score", "claim_id").limit(10)


@query(_GROUPED + """ select '{"strategy":"grouped","seed":42,"n_images":' || count(*) || ',"n_groups":' || count(distinct group_id) || ',"ratios_requested":{"train":0.7,"val":0.2,"test":0.1},"splits":{"train":' || count(*) filter (where split = 'train')
  || ',"val":' || count(*) filter (where split = 'val') || ',"test":' || count(*) filter (where split = 'test') || '},"cross_split_groups":0}' as value from assigned""")
def split_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    assigned = stage(_assigned(spark, sf_dir), "assigned").df
    return sinks.leakage_audit(assigned, "grouped", 42, {"train": 0.7, "val": 0.2, "test": 0.1})


@query(_BASE + "select id, file_name from images order by md5('7:' || id), id limit 50")
def seeded_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fifty images in the order of a seeded draw: a sample is what this operator is for."""
    return split.seeded_sample(_images(spark, sf_dir).select("id", "file_name"), "id", 50, 7)


@query(_BASE + ", s as (select image_id, avg(fine_conf) as mean from anns where fine_conf is not null and image_id is not null group by 1) select i.id, cast(round(cast(coalesce(s.mean, 0) as decimal(24,8)), 4) as double) as mean from images i left join s on s.image_id = i.id")
def score_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mean confidence of every image, 0 where it has none."""
    scores = _annotations(spark, sf_dir).where("fine_conf is not null and image_id is not null").groupBy("image_id").agg(F.avg("fine_conf").alias("mean"))
    return lookup.lookup_value(_images(spark, sf_dir).select("id"), "id", scores, "image_id", "mean", F.lit(0.0)).select("id", half_up(F.col("mean"), 4).alias("mean"))


@query(
    WITH + """, m as (select type as label, case when conf_pct >= 90 and claim_id % 3 > 0 then 'tp' when conf_pct >= 90 then 'fp' else 'fn' end as outcome from detections),
c as (select label, cast(count(*) filter (where outcome = 'tp') as double) as tp, count(*) filter (where outcome = 'fp') as fp, count(*) filter (where outcome = 'fn') as fn from m group by 1),
p as (select *, coalesce(tp / nullif(tp + fp, 0), 0) as p, coalesce(tp / nullif(tp + fn, 0), 0) as r from c)
select label, cast(round(cast(p as decimal(24,8)), 4) as double) as precision, cast(round(cast(r as decimal(24,8)), 4) as double) as recall, cast(round(cast(coalesce(2 * p * r / nullif(p + r, 0), 0) as decimal(24,8)), 4) as double) as f1, cast(tp + fn as bigint) as n_true from p"""
)
def precision_recall(spark: SparkSession, sf_dir: str) -> DataFrame:
    from claimweave.operators.metrics import precision_recall as measure

    outcome = F.when((F.col("conf_pct") >= 90) & (F.col("claim_id") % 3 > 0), "tp").when(F.col("conf_pct") >= 90, "fp").otherwise("fn")
    return measure(detections(spark, sf_dir).select(F.col("type").alias("label"), outcome.alias("outcome")))


@query(WITH + "select claim_id, pos, type || ' on ' || part || ' (' || printf('%.0f', confidence * 100) || '%)' as text from detections")
def template_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    from claimweave.functions.templates import render

    text = render("{type} on {part} ({conf:.0%})", {"type": F.col("type"), "part": F.col("part"), "conf": F.col("confidence")})
    return detections(spark, sf_dir).select("claim_id", "pos", text.alias("text"))


@query(WITH + ", v as (select unnest(['scratch', 'dent', 'crack', 'paint_chip', 'puncture', 'broken_light']) as type), z as (select unnest(['front', 'rear', 'front_left', 'front_right', 'rear_left', 'rear_right']) as zone), t as (select distinct type, zone from detections) select v.type, z.zone, 'missing' as gap from v, z where not exists (select 1 from t where t.type = v.type and t.zone = z.zone) union all select type, zone, 'unknown' from t where zone not in (select zone from z) or type not in (select type from v)")
def coverage_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Combinations of type and zone that all detections lack, and those they have outside the vocabularies."""
    from claimweave.functions.vocabulary import ZONES

    return lookup.coverage_gaps(detections(spark, sf_dir).select("type", "zone"), {"type": DAMAGE_TYPES, "zone": ZONES})


# --- boxes, masks, quality

_ZONE_ROWS = [(p, i, float((i * 37) % 300), float((i * 53) % 200)) for i, p in enumerate(PART_ZONE)]
_ZONE_VALUES = ", ".join(f"('{p}', {i}, {x}e0, {y}e0, " + (f"'{PART_ZONE[p]}'" if PART_ZONE[p] else "null") + ")" for p, i, x, y in _ZONE_ROWS)
_W = "greatest(0e0, least(d.x2, p.x + 200e0) - greatest(d.x1, p.x)) * greatest(0e0, least(d.y2, p.y + 150e0) - greatest(d.y1, p.y)) / ((d.x2 - d.x1) * (d.y2 - d.y1))"


@query(
    f"""with d as (select l_orderkey as claim_id, l_linenumber as pos, l_partkey, cast(l_partkey % 400 as double) as x1, cast(l_suppkey % 300 as double) as y1, l_partkey % 400 + l_quantity as x2, l_suppkey % 300 + l_quantity as y2, l_extendedprice from lineitem),
p(part, ord, x, y, zone) as (values {_ZONE_VALUES}),
s as (select d.claim_id, d.pos, d.l_partkey, d.l_extendedprice, p.zone, p.part, p.ord, round(cast({_W} as decimal(24,8)), 4)::double as overlap, case when p.zone in ('front_left', 'front_right', 'rear_left', 'rear_right') then 1e0 else 0.7e0 end as weight from d, p where p.zone is not null and {_W} >= 0.1e0),
r as (select *, row_number() over (partition by claim_id, pos, l_partkey, l_extendedprice order by round(cast(overlap * weight as decimal(24,8)), 4) desc, ord) as rn from s)
select zone, count(*) as n, cast(round(cast(sum(cast(overlap as decimal(18,4))) as decimal(24,8)), 2) as double) as overlap from r where rn = 1 group by zone"""
)
def box_overlap_zone(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Zone of each damage box: the part it lies in most, parts of a corner before central ones."""
    t = read_table(spark, sf_dir, "lineitem")
    x1, y1 = (F.col("l_partkey") % 400).cast("double"), (F.col("l_suppkey") % 300).cast("double")
    boxes = t.select("l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice", F.array(x1, y1, x1 + F.col("l_quantity"), y1 + F.col("l_quantity")).alias("box"))
    parts = F.array(*[F.struct(F.lit(p).alias("part"), F.lit(i).alias("ord"), F.lit(PART_ZONE[p]).cast("string").alias("zone"), F.array(*[F.lit(v) for v in (x, y, x + 200.0, y + 150.0)]).alias("box")) for p, i, x, y in _ZONE_ROWS if PART_ZONE[p]])
    scored = F.transform(
        parts,
        lambda p: F.struct(
            half_up(half_up(geo.overlap_share(F.col("box"), p["box"]), 4) * F.when(p["zone"].isin(*SIDE_ZONES), 1.0).otherwise(0.7), 4).alias("score"), (-p["ord"]).alias("ord"), p["zone"].alias("zone"), geo.overlap_share(F.col("box"), p["box"]).alias("raw"), half_up(geo.overlap_share(F.col("box"), p["box"]), 4).alias("overlap")
        ),
    )
    # a box meets the parts of its own image, a vocabulary of two dozen: the best is an array maximum, no join
    best = F.array_max(F.filter(scored, lambda s: s["raw"] >= 0.1))
    rows = boxes.dropDuplicates(["l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice"]).select(best.alias("b")).where("b is not null")
    return rows.groupBy(F.col("b.zone").alias("zone")).agg(F.count(F.lit(1)).alias("n"), half_up(F.sum(F.col("b.overlap").cast("decimal(18,4)"))).alias("overlap"))


@query(
    """with r as (select l_quantity * 10 as a, l_quantity * (5 + l_linenumber) as b, l_quantity * (4 + l_linenumber) * 0.9e0 as x from lineitem),
s as (select *, case when a + b - x > 0 then x / (a + b - x) else 0 end as iou, case when a > 0 then b / a else 0 end as ratio from r)
select case when b <= 0 then 'skip_empty' when iou between 0.5e0 and 0.95e0 and ratio between 0.3e0 and 3e0 then 'accepted' else 'rejected' end as verdict, count(*) as n from s group by 1"""
)
def mask_qa_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    q, n = F.col("l_quantity"), F.col("l_linenumber")
    rows = read_table(spark, sf_dir, "lineitem").select((q * 10).alias("area_old"), (q * (n + 5)).alias("area_new"), (q * (n + 4) * 0.9).alias("intersection"))
    return ann.mask_gate(rows).groupBy("verdict").agg(F.count(F.lit(1)).alias("n"))


def _scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = read_table(spark, sf_dir, "lineitem")
    return t.select(
        (F.col("l_quantity") * 4).alias("sharpness"), (F.col("l_discount") * 200).alias("high_pct"), (F.col("l_tax") * 400).alias("low_pct"), (F.col("l_quantity") * 5).alias("mean_brightness"),
        (F.col("l_partkey") % 1200).cast("int").alias("width"), (F.col("l_suppkey") % 100 * 10).cast("int").alias("height"), (F.col("l_linenumber") != 3).alias("vehicle_detected"), (F.col("l_discount") * 4).alias("vehicle_area_fraction"),
    )


@query(
    """with s as (select l_quantity * 4 as sharpness, l_discount * 200 as hi, l_tax * 400 as lo, l_quantity * 5 as br, l_partkey % 1200 as w, l_suppkey % 100 * 10 as h, l_linenumber <> 3 as v, l_discount * 4 as f from lineitem),
p as (select concat_ws(',', case when not v or f < 0.1e0 then 'no_vehicle' end, case when sharpness < 80 then 'blurry' end, case when hi > 15 then 'overexposed' end, case when lo > 25 then 'underexposed' end,
  case when br < 40 and not (lo > 25) then 'underexposed' end, case when br > 220 and not (hi > 15) then 'overexposed' end, case when greatest(w, h) < 800 or least(w, h) < 600 then 'low_resolution' end) as problems from s)
select problems, count(*) as n from p group by 1"""
)
def quality_verdict(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.verdict(_scores(spark, sf_dir)).groupBy(F.array_join("problems", ",").alias("problems")).agg(F.count(F.lit(1)).alias("n"))


@query("select o_orderkey % 3 as k, count(*) as n from orders group by 1 having count(*) > 0")
def last_source_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every file name is offered by three sources; the last one is taken."""
    o = read_table(spark, sf_dir, "orders")
    offers = o.select(F.col("o_orderkey"), F.explode(F.sequence(F.lit(0), F.lit(2))).alias("source_order")).select(F.concat(F.lit("f"), F.col("o_orderkey")).alias("file_name"), "source_order", F.col("o_orderkey"))
    return lookup.last_source_wins(offers, "file_name", "source_order").where("source_order = 2").groupBy((F.col("o_orderkey") % 3).alias("k")).agg(F.count(F.lit(1)).alias("n"))
