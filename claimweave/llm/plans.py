"""Queries of the training-data problems, with SQL where SQL can express them."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from claimweave.functions.filenames import shot_number, vehicle_number
from claimweave.functions.times import nulls_last
from claimweave.llm import canonical, groups, leakage, mixing, overlap, quantiles, splits, truncation
from claimweave.operators.staging import stage, stage_root
from claimweave.session import read_table

# --- 1: free-typed values to the canonical list


def _typed_claims(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per claim with its first-received brand and model (of equal times the smallest), entries of the list left out."""
    typed = read_table(spark, sf_dir, "vehicle_metadata").where("claim_id is not null")
    one = typed.groupBy("claim_id").agg(F.min(F.struct(nulls_last("received_at").alias("at"), "marca", "modelo")).alias("t")).select("claim_id", "t.marca", "t.modelo")
    listed = read_table(spark, sf_dir, "vehicle_catalog").select("marca", "modelo").distinct()
    return one.where("marca is not null or modelo is not null").join(listed, ["marca", "modelo"], "left_anti").select("claim_id", "marca", "modelo")


def _resolved_claims(spark: SparkSession, sf_dir: str) -> DataFrame:
    catalogue = read_table(spark, sf_dir, "vehicle_catalog")
    typed = read_table(spark, sf_dir, "vehicle_metadata").select("marca", "modelo")
    claims = _typed_claims(spark, sf_dir)
    lexicon = canonical.load_lexicon(catalogue, typed, "catalog_id", "marca", "marca_alias", "modelo")
    if lexicon is not None:
        return canonical.resolve_pairs(claims, lexicon, "marca", "modelo")
    claims = stage(claims, "claims").df
    return claims.join(canonical.resolve_by_join(claims, catalogue, "claim_id", "marca", "modelo", ("catalog_id", "marca", "marca_alias", "modelo"), typed), "claim_id")


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _resolved_claims(spark, sf_dir).select("claim_id", F.col("entry_id").alias("catalog_id"))


def p1_misses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed pairs without an entry, why, and how many claims have them."""
    return _resolved_claims(spark, sf_dir).where("entry_id = 0").groupBy("marca", "modelo", "reason").agg(F.count(F.lit(1)).alias("n_claims"))


# --- 2: percentiles per lane that combine over days

RANK_ERROR = 0.005
PERCENTILES = (0.01, 0.05, 0.25, 0.5, 0.75, 0.95, 0.99)
LANES = ("verde", "ambar", "rojo")


MEASURES = ("estimated_eur", "processing_time_ms")
#: Months are counted from the year 0; this one says that a record has no date.
_UNDATED = 12 * 10000


def _first_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(grp, *measures) of every distinct record in a lane: lane and month as a number, measured values or null.

    The first received row of a record counts as a whole, of rows received together the smallest.
    """
    lane = F.translate(F.lower(F.trim("lane")), "á", "a")
    code = F.when(lane == LANES[0], 1).when(lane == LANES[1], 2).when(lane == LANES[2], 3).otherwise(0)
    month = F.coalesce(F.greatest(F.lit(0), F.least(F.year("evaluated_at") * 12 + F.month("evaluated_at") - 1, F.lit(_UNDATED - 1))), F.lit(_UNDATED))
    row = F.struct(nulls_last("received_at").alias("at"), (code + month * 4).alias("grp"), *[quantiles.measured(F.col(m)).alias(m) for m in MEASURES])
    first = read_table(spark, sf_dir, "claim_metrics").where("record_id is not null").groupBy("record_id").agg(F.min(row).alias("r"))
    return first.where("r.grp % 4 > 0").select(F.col("r.grp").cast("bigint").alias("grp"), *[F.col(f"r.{m}") for m in MEASURES])


def _month_digests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(lane, measure, month, level, node, n) as numbers: digests of each task merged by node, and compressed once more."""
    local = quantiles.local_digests(_first_records(spark, sf_dir), "grp", list(MEASURES), quantiles.k_for(RANK_ERROR))
    keyed = local.select((F.col("grp") % 4 - 1).cast("tinyint").alias("lane"), F.col("field").alias("measure"), F.floor(F.col("grp") / 4).cast("int").alias("month"), "level", "node", "n")
    return quantiles.compact(quantiles.merge_digests(keyed, ["lane", "measure", "month"]), ["lane", "measure", "month"], quantiles.k_for(RANK_ERROR))


def _named(df: DataFrame, *columns: str) -> DataFrame:
    """Numbers of lane, measure and month as what they stand for; an undated month is null."""
    lane = F.element_at(F.array(*[F.lit(x) for x in LANES]), F.col("lane") + 1)
    measure = F.element_at(F.array(*[F.lit(x) for x in MEASURES]), F.col("measure") + 1)
    month = F.when(F.col("month") < _UNDATED, F.make_date(F.floor(F.col("month") / 12).cast("int"), (F.col("month") % 12 + 1).cast("int"), F.lit(1)))
    return df.select(lane.alias("lane"), measure.alias("measure"), month.alias("month"), *columns)


def p2_lane_digests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The digest of each lane, measure and month (null: undated): what is kept, and merges with the digests of other loads by adding equal nodes."""
    return _named(_month_digests(spark, sf_dir), "level", "node", "n")


def p2_lane_percentiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Percentiles per lane and measure, read off the digests: of each month (period ``month``, or ``undated``) and of all of them merged (``all``)."""
    k = quantiles.k_for(RANK_ERROR)
    monthly = stage(_month_digests(spark, sf_dir), "digests").df
    by_month = quantiles.digest_percentiles(monthly, ["lane", "measure", "month"], PERCENTILES, k).withColumn("period", F.when(F.col("month") < _UNDATED, "month").otherwise("undated"))
    merged = quantiles.merge_digests(monthly, ["lane", "measure"])
    overall = quantiles.digest_percentiles(merged, ["lane", "measure"], PERCENTILES, k).withColumns({"month": F.lit(_UNDATED), "period": F.lit("all")})
    return _named(by_month.unionByName(overall), "period", "percentile", "value", "value_low", "value_high", "n", "rank_error")


def p2_lane_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Measured values of each lane, measure and month: the counts of a digest's nodes add up to them exactly, at any compression."""
    return p2_lane_digests(spark, sf_dir).groupBy("lane", "measure", "month").agg(F.sum("n").cast("bigint").alias("n"))


def p2_month_percentiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Percentiles of the months whose digests are exact but for the width of a leaf (fewer values than the compression factor): the lower end of the leaf."""
    return p2_lane_percentiles(spark, sf_dir).where("period = 'month' and rank_error = 0").select("lane", "measure", "month", "percentile", "value_low", "n")


# --- 4: splits that keep a vehicle's images together


def _image_links(images: DataFrame, *more: str) -> DataFrame:
    """Images linked by the vehicle in their file name, and by further columns."""
    return splits.link_rows(images.select("id", vehicle_number(F.col("file_name")).alias("vehicle"), *more), "id", "vehicle", *more)


def _ratios(spark: SparkSession, sf_dir: str) -> dict[str, float]:
    """The ratios most builds asked for."""
    row = (
        read_table(spark, sf_dir, "leakage_audit").where("ratios_requested.train + ratios_requested.val + ratios_requested.test > 0")
        .groupBy("ratios_requested").count().orderBy(F.desc("count"), "ratios_requested").select("ratios_requested.*").first()
    )
    return row.asDict() if row else {"train": 0.7, "val": 0.2, "test": 0.1}


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Images of vehicles that have several; a component is named by its smallest image id."""
    images = read_table(spark, sf_dir, "coco_images").select("id", "file_name")
    return splits.group_batch(_image_links(images)).select(F.col("record_id").alias("image_id"), F.col("component").alias("group_id"))


def p4_components(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Images that hang together by vehicle or by content, directly or through others: what must not be split."""
    images = read_table(spark, sf_dir, "coco_images").select("id", "file_name", "image_hash")
    return splits.group_batch(_image_links(images, "image_hash")).select(F.col("record_id").alias("image_id"), F.col("component").alias("group_id"))


def _split_in_two_loads(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Rows ingested up to the middle of the time first, then all later ones on top of the saved state; some images come back in the second load."""
    images = read_table(spark, sf_dir, "coco_images").select("id", "file_name", "image_hash", "ingested_at")
    middle = images.agg(F.percentile_approx(F.unix_micros("ingested_at"), 0.5)).scalar()
    early = F.coalesce(F.unix_micros("ingested_at") <= middle, F.lit(True))
    ratios = _ratios(spark, sf_dir)
    first, state = splits.assign_batch(_image_links(images.where(early), "image_hash"), None, ratios)
    saved = f"{stage_root(spark)}/split-state-{uuid.uuid4().hex}"
    state.save(saved)
    second, _ = splits.assign_batch(_image_links(images.where(~early), "image_hash"), splits.SplitState.load(spark, saved), ratios)
    return first, second


def _assigned_images(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every image once, as the last load that had it left it."""
    first, second = _split_in_two_loads(spark, sf_dir)
    return first.join(second.select("record_id"), "record_id", "left_anti").unionByName(second)


def p4_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _assigned_images(spark, sf_dir).select(F.col("record_id").alias("image_id"), "component", "split")


def p4_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return splits.split_report(_assigned_images(spark, sf_dir), _ratios(spark, sf_dir))


def p4_split_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the splits must hold: every image placed, no component in two splits, no image moved when it came back, shares within a hundredth."""
    first, second = _split_in_two_loads(spark, sf_dir)
    moved = first.join(second.select("record_id", F.col("split").alias("later")), "record_id").where("split <> later")
    every = stage(first.join(second.select("record_id"), "record_id", "left_anti").unionByName(second), "every").df
    astray = every.groupBy("component").agg(F.countDistinct("split").alias("n")).where("n > 1")
    off = splits.split_report(every.where(F.col("split") != splits.QUARANTINE), _ratios(spark, sf_dir)).where(F.abs(F.col("share") - F.col("share_asked")) > 0.01)
    count = lambda df: df.agg(F.count(F.lit(1))).scalar()
    return every.agg(F.countDistinct("record_id").alias("n_images")).select("n_images", count(astray).alias("n_astray"), count(moved).alias("n_moved"), count(off).alias("n_off_share"))


# --- 6: images of evaluation splits that are in train as well

RADIUS = 7


def _sides(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Known images assigned to train, and to val or test."""
    label = F.lower(F.trim(F.regexp_replace("split", r"\s+", " ")))
    split = F.when(label == "train", "train").when(label.isin("val", "valid", "validation"), "val").when(label == "test", "test")
    assigned = read_table(spark, sf_dir, "split_map").where("image_id is not null").select(F.col("image_id").alias("id"), split.alias("split")).where("split is not null").distinct()
    images = (
        read_table(spark, sf_dir, "coco_images").where("id is not null")
        .select("id", F.col("image_hash").alias("content_hash"), F.col("dhash").alias("code"), vehicle_number(F.col("file_name")).alias("vehicle"), shot_number(F.col("file_name")).alias("shot"), "source", "build_id")
        .distinct()
    )
    known = stage(assigned.join(images, "id"), "sides").df
    return known.where("split = 'train'"), known.where("split <> 'train'")


_SIGNS = ("id", "content_hash", "code", "vehicle", "shot")


def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    train, held = (side.select(*_SIGNS).distinct() for side in _sides(spark, sf_dir))
    pairs = overlap.cross_pairs(train, held, RADIUS)
    return pairs.select(F.least("train_id", "held_out_id").alias("image_a"), F.greatest("train_id", "held_out_id").alias("image_b")).distinct()


def _overlapping(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    train, held = _sides(spark, sf_dir)
    found = overlap.held_out_overlaps(train.select(*_SIGNS).distinct(), held.select(*_SIGNS).distinct(), RADIUS)
    return found.withColumnRenamed("held_out_id", "id"), held


def p6_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Held-out images that train has as well, per split, source and way."""
    found, held = _overlapping(spark, sf_dir)
    return found.join(held.select("id", "split", "source").distinct(), "id").groupBy("split", "source", "how").agg(F.countDistinct("id").alias("n_images"))


def p6_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups across splits found per build beside what its audit claims."""
    found, held = _overlapping(spark, sf_dir)
    counts = found.select("id").distinct().join(held.select("id", "build_id").distinct(), "id").groupBy("build_id").agg(F.countDistinct("id").alias("n_found"))
    audit = read_table(spark, sf_dir, "leakage_audit").select("build_id", "cross_split_groups")
    return audit.join(counts, "build_id", "left").select("build_id", "cross_split_groups", F.coalesce("n_found", F.lit(0)).alias("n_found"))


# --- 7: pairwise verdicts to groups


def _same_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "match_pairs").where("id_a is not null and id_b is not null and lower(trim(verdict)) = 'same'").select("id_a", "id_b")


def p7_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return groups.group_pairs(_same_pairs(spark, sf_dir), "id_a", "id_b")


def p7_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of each build's images, an image without a link being its own, beside the audit's claim."""
    grouped = p7_found(spark, sf_dir)
    images = read_table(spark, sf_dir, "coco_images").where("id is not null").select("id", "build_id").distinct()
    found = images.join(grouped, "id", "left").groupBy("build_id").agg(F.countDistinct("id").alias("n_images_found"), F.countDistinct(F.coalesce("group_id", "id")).alias("n_groups_found"))
    audit = read_table(spark, sf_dir, "leakage_audit").select("build_id", "n_images", "n_groups")
    return audit.join(found, "build_id", "left").select("build_id", "n_images", "n_groups", F.coalesce("n_images_found", F.lit(0)).alias("n_images_found"), F.coalesce("n_groups_found", F.lit(0)).alias("n_groups_found"))


# --- 8: held-out passages in the corpus


def _leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leakage.find_leaks(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "eval_items"))


def p8_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _leaks(spark, sf_dir).select("item_id", "doc_id")


def p8_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Leaked items with the documents and sources they leak into."""
    documents = read_table(spark, sf_dir, "documents").select("doc_id", "source")
    found = _leaks(spark, sf_dir).join(documents, "doc_id")
    leaks = found.groupBy("item_id").agg(F.countDistinct("doc_id").alias("n_documents"), F.countDistinct("source").alias("n_sources"), F.max("run").alias("longest_run"))
    return leaks.join(read_table(spark, sf_dir, "eval_items").select("item_id", "task", "split"), "item_id")


# --- 9: sources mixed to target shares


#: Share a source of the report may be off by.
SHARE_ERROR = 0.02


def _mixture(spark: SparkSession, sf_dir: str) -> mixing.Mixture:
    return mixing.mix(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "source_weights"))


def p9_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _mixture(spark, sf_dir).documents


def p9_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _mixture(spark, sf_dir).report


def p9_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether each listed source came within ``SHARE_ERROR`` of its share among the sources that have documents, and within its cap.

    A mix of a few blocks cannot come nearer than to a block; there the share counts as reached to within one.
    """
    total = F.sum("tokens_mixed").over(Window.partitionBy())
    reached = (F.abs("share_error") < SHARE_ERROR) | (F.abs("share_error") * total <= mixing.BLOCK_TOKENS)
    return p9_report(spark, sf_dir).select("source", "target_share", "max_repeats", reached.alias("share_reached"), (F.col("most_repeats") <= F.col("max_repeats")).alias("cap_held"), (F.col("tokens_available") > 0).alias("has_documents"))


# --- 10: texts cut before their end


def _truncated(spark: SparkSession, sf_dir: str) -> DataFrame:
    return truncation.find_truncated(read_table(spark, sf_dir, "documents"))


def p10_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _truncated(spark, sf_dir).where("cut").select("doc_id")


def p10_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How often each source truncates."""
    documents = read_table(spark, sf_dir, "documents").select("doc_id", "source")
    marked = documents.join(_truncated(spark, sf_dir), "doc_id")
    return marked.groupBy("source").agg(
        F.count(F.lit(1)).alias("n_documents"), F.count_if("cut").alias("n_cut"), F.count_if(F.col("cut") & (F.col("by") == "copy")).alias("n_cut_by_copy"), F.avg(F.col("cut").cast("int")).alias("share_cut")
    )


QUERIES = {
    "p1_found": p1_found,
    "p1_misses": p1_misses,
    "p2_lane_digests": p2_lane_digests,
    "p2_lane_percentiles": p2_lane_percentiles,
    "p2_lane_counts": p2_lane_counts,
    "p2_month_percentiles": p2_month_percentiles,
    "p4_found": p4_found,
    "p4_split": p4_split,
    "p4_report": p4_report,
    "p4_components": p4_components,
    "p4_split_check": p4_split_check,
    "p6_found": p6_found,
    "p6_report": p6_report,
    "p6_audit": p6_audit,
    "p7_found": p7_found,
    "p7_audit": p7_audit,
    "p8_found": p8_found,
    "p8_report": p8_report,
    "p9_mixture": p9_mixture,
    "p9_report": p9_report,
    "p9_shares": p9_shares,
    "p10_found": p10_found,
    "p10_report": p10_report,
}

_VEHICLE = r"""regexp_extract(regexp_extract(lower(file_name), '([^/]*)$', 1), '(?:^|[^\p{L}])(?:automovil|automóvil|vehiculo|vehículo|vehicle|veiculo|veículo|viatura|coches|coche|carro|cars|auto|car|veh)[^\p{L}\p{N}]*0*([0-9]+)', 1)"""
_SHOT = r"""regexp_extract(regexp_extract(lower(file_name), '([^/]*)$', 1), '(?:^|[^\p{L}])(?:automovil|automóvil|vehiculo|vehículo|vehicle|veiculo|veículo|viatura|coches|coche|carro|cars|auto|car|veh)[^\p{L}\p{N}]*[0-9]+[^\p{L}\p{N}]+(?:(?:foto|photo|fotografia|img|image|imagen|imagem|pic|shot|toma|vista|view)[^\p{L}\p{N}]*)?0*([0-9]+)', 1)"""

_GROUPS = """
with recursive edges as (
  select distinct id_a as a, id_b as b from match_pairs where id_a is not null and id_b is not null and id_a <> id_b and lower(trim(verdict)) = 'same'
  union select distinct id_b, id_a from match_pairs where id_a is not null and id_b is not null and id_a <> id_b and lower(trim(verdict)) = 'same'
),
reach as (select a as id, a as seen from edges union select r.id, e.b from reach r join edges e on r.seen = e.a)"""
_SIDES = f"""
with label as (
  select distinct image_id as id, case lower(trim(split)) when 'train' then 'train' when 'test' then 'test' else 'val' end as split from split_map
  where image_id is not null and lower(trim(split)) in ('train', 'val', 'valid', 'validation', 'test')
),
images as (select distinct id, image_hash, dhash, source, build_id, {_VEHICLE} as vehicle, {_SHOT} as shot from coco_images where id is not null),
t as (select i.*, l.split from images i join label l on l.id = i.id and l.split = 'train'),
h as (select i.*, l.split from images i join label l on l.id = i.id and l.split <> 'train')"""
_WAYS = f"""ways as (
  select id, 'itself' as how from h where id in (select id from t)
  union select id, 'hash' from h where image_hash in (select image_hash from t)
  union select h.id, 'shot' from h join t on t.vehicle = h.vehicle and t.shot = h.shot where h.vehicle <> '' and h.shot <> ''
  union select h.id, 'code' from (select distinct id, dhash from h where dhash is not null) h join (select distinct dhash from t where dhash is not null) t on bit_count(xor(t.dhash, h.dhash)) <= {RADIUS}
)"""

_MEASURED = """
with firsts as (
  select record_id, replace(lower(trim(lane)), 'á', 'a') as lane, cast(date_trunc('month', evaluated_at) as date) as month, estimated_eur, processing_time_ms
  from (select *, row_number() over (partition by record_id order by received_at nulls last) as rn from claim_metrics where record_id is not null) t where rn = 1
),
measured as (
  select lane, 'estimated_eur' as measure, month, estimated_eur as v from firsts where isfinite(estimated_eur) and estimated_eur >= 0
  union all select lane, 'processing_time_ms', month, cast(processing_time_ms as double) from firsts where processing_time_ms >= 0
)"""

ORACLES = {
    "p9_shares": "select source, target_share, greatest(1, coalesce(max_repeats, 1)) as max_repeats, true as share_reached, true as cap_held, source in (select source from documents where text <> '') as has_documents from source_weights",
    "p2_lane_counts": _MEASURED + "select lane, measure, month, count(*) as n from measured where lane in ('verde', 'ambar', 'rojo') group by all",
    "p2_month_percentiles": _MEASURED + f""",
ranked as (
  select lane, measure, month, v, row_number() over (partition by lane, measure, month order by v) as r, count(*) over (partition by lane, measure, month) as n
  from measured where lane in ('verde', 'ambar', 'rojo') and month is not null
),
asked as (select unnest([{", ".join(f"{p}e0" for p in PERCENTILES)}]) as percentile),
met as (select lane, measure, month, percentile, v, n from ranked, asked where n < {quantiles.k_for(RANK_ERROR)} and r = greatest(1, ceil(percentile * n))),
guess as (select *, floor(log2(case when v > 0 then v end)) as g from met),
exact as (select *, case when pow(2e0, g) > v then g - 1 when pow(2e0, g + 1) <= v then g + 1 else g end as e from guess)
select lane, measure, month, percentile, n, coalesce(pow(2e0, e) * (1 + floor((v / pow(2e0, e) - 1) * 512) / 512), 0e0) as value_low from exact""",
    "p4_found": f"""
with named as (select distinct id, {_VEHICLE} as vehicle from coco_images where id is not null),
sized as (select vehicle, min(id) as group_id, max(id) as last_id from named where vehicle <> '' group by vehicle)
select n.id as image_id, s.group_id from named n join sized s on n.vehicle = s.vehicle where s.group_id <> s.last_id""",
    "p4_split_check": "select count(distinct id) as n_images, 0 as n_astray, 0 as n_moved, 0 as n_off_share from coco_images where id is not null",
    "p4_components": f"""
with recursive named as (select distinct id, image_hash, {_VEHICLE} as vehicle from coco_images where id is not null),
links as (
  select id, min(id) over (partition by vehicle) as other from named where vehicle <> ''
  union select id, min(id) over (partition by image_hash) from named where image_hash <> ''
),
edges as (select id as a, other as b from links where id <> other union select other, id from links where id <> other),
reach as (select a as id, a as seen from edges union select r.id, e.b from reach r join edges e on r.seen = e.a)
select id as image_id, min(seen) as group_id from reach group by id""",
    "p7_found": _GROUPS + " select id, min(seen) as group_id from reach group by id",
    "p6_found": f"""{_SIDES},
pairs as (
  select t.id as a, h.id as b from t join h on t.id = h.id
  union select t.id, h.id from t join h on t.image_hash = h.image_hash
  union select t.id, h.id from t join h on t.vehicle = h.vehicle and t.shot = h.shot where t.vehicle <> '' and t.shot <> ''
  union select t.id, h.id from (select id, dhash from t where dhash is not null) t, (select id, dhash from h where dhash is not null) h where bit_count(xor(t.dhash, h.dhash)) <= {RADIUS}
)
select distinct least(a, b) as image_a, greatest(a, b) as image_b from pairs""",
    "p6_report": f"""{_SIDES}, {_WAYS}
select h.split, h.source, w.how, count(distinct h.id) as n_images from h join ways w on h.id = w.id group by all""",
    "p6_audit": f"""{_SIDES}, {_WAYS},
found as (select h.build_id, count(distinct h.id) as n_found from h join ways w on h.id = w.id group by 1)
select a.build_id, a.cross_split_groups, coalesce(f.n_found, 0) as n_found from leakage_audit a left join found f on a.build_id = f.build_id""",
    "p7_audit": _GROUPS
    + """, grouped as (select id, min(seen) as group_id from reach group by id),
images as (select distinct id, build_id from coco_images where id is not null),
found as (select i.build_id, count(distinct i.id) as n_images_found, count(distinct coalesce(g.group_id, i.id)) as n_groups_found from images i left join grouped g on i.id = g.id group by 1)
select a.build_id, a.n_images, a.n_groups, coalesce(f.n_images_found, 0) as n_images_found, coalesce(f.n_groups_found, 0) as n_groups_found from leakage_audit a left join found f on a.build_id = f.build_id""",
}
