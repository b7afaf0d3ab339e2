"""Queries over detections, lookups, metrics and audit lines, with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimweave.functions.numeric import half_up
from claimweave.functions.times import nulls_last
from claimweave.functions.vocabulary import KEYWORD_PARTS, SEVERITIES
from claimweave.operators import consolidate as con
from claimweave.operators import lookup, metrics
from claimweave.operators.staging import stage
from claimweave.plans.adapter import WITH, claims, detections
from claimweave.session import read_table
from claimweave.sinks.files import audit_records, date_token

QUERIES, ORACLES = {}, {}


def query(sql: str | None = None):
    """Register a query under its own name, with its SQL."""

    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


@query(WITH + "select * from claims")
def claims_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    return claims(spark, sf_dir)


@query(WITH + "select claim_id, image_hash, pos, type, part, confidence, extension, area_pct, zone, part_category from detections")
def detections_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    return detections(spark, sf_dir).select("claim_id", "image_hash", "pos", "type", "part", "confidence", "extension", "area_pct", "zone", "part_category")


@query(WITH + "select type, count(*) as n, min(conf_pct) as least from detections where type in ('scratch', 'dent', 'crack') and confidence >= case type when 'scratch' then 0.84e0 when 'crack' then 0.94e0 else 0.9e0 end group by type")
def detections_filtered(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = con.filter_detections(detections(spark, sf_dir), {"scratch": 0.84, "crack": 0.94}, 0.9, ("scratch", "dent", "crack"))
    return kept.groupBy("type").agg(F.count(F.lit(1)).alias("n"), F.min("conf_pct").alias("least"))


_REGION = "case when part not in ('', 'unknown') then 'part' when zone not in ('', 'unknown') then 'zone' else 'none' end as region_kind, case when part not in ('', 'unknown') then part when zone not in ('', 'unknown') then zone else '' end as region"


@query(WITH + f"select region_kind, region, count(*) as n from (select {_REGION} from detections) t group by 1, 2")
def region_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return con.with_region(detections(spark, sf_dir)).groupBy("region_kind", "region").agg(F.count(F.lit(1)).alias("n"))


_CONSOLIDATED = (
    WITH
    + f""",
keyed as (select *, {_REGION}, cast(round(confidence * 1000000) as bigint) as w from detections),
base as (
  select claim_id, type, region_kind, region,
         cast(round(cast(coalesce(cast(sum(w * w) as double) / nullif(cast(sum(w) as double) * 1000000e0, 0), 0) as decimal(24,8)), 4) as double) as confidence,
         max(case extension when 'small' then 1 when 'medium' then 2 when 'large' then 3 else 1 end) as ext,
         max(case severity when 'leve' then 1 when 'moderado' then 2 when 'severo' then 3 end) as sev,
         bool_or(structural_suspicion) as structural_suspicion, cast(round(cast(max(area_pct) as decimal(24,8)), 2) as double) as area_pct,
         count(*) as n_detections, min(pos) as first_pos, array_to_string(list_sort(list(distinct image_hash)), ',') as supporting_images
  from keyed group by 1, 2, 3, 4
),
ballots as (
  select claim_id, type, region_kind, region, 'zone' as field, zone as value, w, pos from keyed
  union all select claim_id, type, region_kind, region, 'part', part, w, pos from keyed
  union all select claim_id, type, region_kind, region, 'part_category', part_category, w, pos from keyed
),
totals as (select claim_id, type, region_kind, region, field, value, sum(w) as w, min(pos) as p from ballots where value not in ('', 'unknown') group by 1, 2, 3, 4, 5, 6),
ranked as (select *, row_number() over (partition by claim_id, type, region_kind, region, field order by w desc, p) as rn from totals),
votes as (
  select claim_id, type, region_kind, region, max(value) filter (where field = 'zone') as zone, max(value) filter (where field = 'part') as part,
         max(value) filter (where field = 'part_category') as part_category from ranked where rn = 1 group by 1, 2, 3, 4
),
damages as (
  select b.claim_id, 'C' || row_number() over (partition by b.claim_id order by first_pos, b.type, b.region_kind, b.region) as damage_id, b.type,
         coalesce(v.zone, 'unknown') as zone, coalesce(v.part, 'unknown') as part, coalesce(v.part_category, 'unknown') as part_category,
         case ext when 1 then 'small' when 2 then 'medium' else 'large' end as extension,
         case sev when 1 then 'leve' when 2 then 'moderado' when 3 then 'severo' end as severity,
         confidence, structural_suspicion, supporting_images, area_pct, n_detections
  from base b left join votes v on b.claim_id = v.claim_id and b.type = v.type and b.region_kind = v.region_kind and b.region = v.region
)"""
)


@query(_CONSOLIDATED + "select * from damages")
def consolidated_damages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return con.consolidate(detections(spark, sf_dir)).withColumn("supporting_images", F.array_join("supporting_images", ",")).drop("first_pos")


@query(WITH + ", t as (select claim_id, zone, sum(conf_pct) as w, min(pos) as p from detections where zone <> 'unknown' group by 1, 2) select claim_id, zone from (select *, row_number() over (partition by claim_id order by w desc, p) as rn from t) r where rn = 1")
def weighted_vote_zone(spark: SparkSession, sf_dir: str) -> DataFrame:
    return con.weighted_votes(detections(spark, sf_dir), ["claim_id"], "zone", F.col("conf_pct"), "pos")


@query(_CONSOLIDATED + "select claim_id, zone, count(*) as n from damages group by 1, 2")
def zones_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return con.zones_summary(con.consolidate(detections(spark, sf_dir)))


@query(_CONSOLIDATED + "select claim_id, cast(to_json(map_from_entries(list_sort(list({k: zone, v: n})))) as varchar) as zones, cast(sum(n) as bigint) as n_damages from (select claim_id, zone, count(*) as n from damages group by 1, 2) t group by 1")
def assembled_claims(spark: SparkSession, sf_dir: str) -> DataFrame:
    assembled = con.assemble_claims(con.consolidate(detections(spark, sf_dir)))
    return assembled.select("claim_id", F.to_json("zones_summary").alias("zones"), F.size("damages").cast("bigint").alias("n_damages"))


_OFFICES = [("default", "CENTRAL", 0), ("Madrid", "M", 1), ("Barcelona", "B", 2), ("Sevilla", "SE", 3), ("Cuenca", "CU", 4)]
_OFFICE_VALUES = ", ".join(f"('{a}', '{b}', {c})" for a, b, c in _OFFICES)


@query(
    WITH
    + f", t(name, office, grade) as (values {_OFFICE_VALUES}) select c.claim_id, coalesce(t.name, 'default') as matched_key, coalesce(t.office, 'CENTRAL') as office, cast(coalesce(t.grade, 0) as int) as grade from claims c left join t on nullif(lower(trim(c.provincia)), '') = lower(t.name)"
)
def keyed_lookup_default(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = spark.createDataFrame(_OFFICES, "name string, office string, grade int")
    return lookup.lookup_default(claims(spark, sf_dir).select("claim_id", "provincia"), "provincia", table, "name", "default").drop("provincia")


_CHAIN = [("plastic_panel", "scratch", "small", "A"), ("plastic_panel", "scratch", "any", "B"), ("plastic_panel", "any", "any", "C"), ("body_panel", "dent", "large", "D"), ("body_panel", "any", "small", "E"), ("unknown", "crack", "any", "F"), ("unknown", "any", "any", "G")]
_CHAIN_VALUES = ", ".join(f"('{a}', '{b}', '{c}', '{d}')" for a, b, c, d in _CHAIN)


@query(
    WITH
    + f""", t(category, kind, size, code) as (values {_CHAIN_VALUES}),
d as (select claim_id, pos, part_category as category, type as kind, extension as size from detections),
hits as (
  select d.claim_id, d.pos, t.code, (t.category = d.category and t.kind = d.kind and t.size = d.size) or (t.category = 'unknown' and d.category = 'unknown' and t.kind = d.kind and t.size = d.size) as exact,
         row_number() over (partition by d.claim_id, d.pos order by t.category = d.category desc, t.kind = d.kind desc, t.size = d.size desc) as rn
  from d join t on t.category in (d.category, 'unknown') and t.kind in (d.kind, 'any') and t.size in (d.size, 'any')
)
select claim_id, pos, code, exact from hits where rn = 1"""
)
def cascade_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = spark.createDataFrame(_CHAIN, "category string, kind string, size string, code string")
    rows = detections(spark, sf_dir).select("claim_id", "pos", F.col("part_category").alias("category"), F.col("type").alias("kind"), F.col("extension").alias("size"))
    return lookup.cascade_lookup(rows, table, [("category", "unknown"), ("kind", "any"), ("size", "any")], ["code"]).select("claim_id", "pos", "code", "exact")


@query(WITH + "select claim_id, case lower(trim(marca)) when 'vw' then 'volkswagen' else lower(trim(marca)) end as brand from claims")
def alias_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = lookup.normal_key(F.col("marca"))
    return claims(spark, sf_dir).select("claim_id", F.coalesce(F.nullif(lookup.map_default(key, {"vw": "volkswagen"}, ""), F.lit("")), key).alias("brand"))


_KEYWORDS = ", ".join(f"('{k}', '{p}')" for k, parts in KEYWORD_PARTS.items() for p in parts)


@query(
    WITH
    + f""", k(keyword, part) as (values {_KEYWORDS}),
declared as (select c.claim_id, k.part from claims c join k on contains(strip_accents(lower(c.descripcion)), k.keyword) where c.descripcion <> ''),
seen as (select claim_id, part from detections union select claim_id, part_category from detections union select claim_id, zone from detections)
select claim_id, array_to_string(list_sort(list(distinct part)), ',') as declared from declared d
group by claim_id having count(*) filter (where exists (select 1 from seen s where s.claim_id = d.claim_id and s.part = d.part and s.part <> 'unknown')) = 0"""
)
def declared_parts_not_seen(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Claims whose description names parts of which none was detected."""
    words = spark.createDataFrame([(k, p) for k, parts in KEYWORD_PARTS.items() for p in parts], "keyword string, part string")
    declared = lookup.keyword_parts(claims(spark, sf_dir), "claim_id", "descripcion", words)
    seen = detections(spark, sf_dir).select("claim_id", F.explode(F.array("part", "part_category", "zone")).alias("p")).where("p <> 'unknown'").groupBy("claim_id").agg(F.collect_set("p").alias("seen"))
    joined = declared.join(seen, "claim_id", "left")
    return joined.where(~F.coalesce(F.arrays_overlap("declared", "seen"), F.lit(False))).select("claim_id", F.array_join("declared", ",").alias("declared"))


@query(_CONSOLIDATED + "select claim_id, count(distinct zone) as n_zones, count(distinct type) as n_types from damages where zone <> 'unknown' group by 1 having count(distinct zone) >= 2 and count(distinct type) >= 2")
def spread_damages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Claims with damages of several types in several zones."""
    damages = con.consolidate(detections(spark, sf_dir)).where("zone <> 'unknown'")
    return damages.groupBy("claim_id").agg(F.countDistinct("zone").alias("n_zones"), F.countDistinct("type").alias("n_types")).where("n_zones >= 2 and n_types >= 2")


_BRACKETS = [("<500", 500.0), ("500-1500", 1500.0), (">1500", None)]


@query(WITH + "select case when importe_real < 500 then '<500' when importe_real < 1500 then '500-1500' else '>1500' end as bracket, count(*) as n from claims where importe_real >= 0 group by 1")
def bracket_stratify(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = claims(spark, sf_dir)
    return c.select(lookup.bucket_ranges(c, "importe_real", _BRACKETS).alias("bracket")).where("bracket is not null").groupBy("bracket").agg(F.count(F.lit(1)).alias("n"))


@query(
    WITH
    + """, counts as (select marca, severidad_oficial, count(*) as n, min(claim_id) as p from claims group by 1, 2),
top as (select marca, severidad_oficial from (select *, row_number() over (partition by marca order by n desc, p) as rn from counts) r where rn = 1)
select c.marca, count(*) as n, cast(round(cast(min(importe_real) as decimal(24,8)), 2) as double) as least, cast(round(cast(max(importe_real) as decimal(24,8)), 2) as double) as most, count(*) filter (where es_estructural) as n_structural, any_value(t.severidad_oficial) as usual_severity
from claims c join top t on c.marca = t.marca group by c.marca"""
)
def truth_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    from claimweave.operators.annotations import dominant_class

    c = claims(spark, sf_dir)
    usual = dominant_class(c, "marca", "severidad_oficial", "claim_id").withColumnRenamed("severidad_oficial", "usual_severity")
    stats = c.groupBy("marca").agg(F.count(F.lit(1)).alias("n"), half_up(F.min("importe_real")).alias("least"), half_up(F.max("importe_real")).alias("most"), F.count_if("es_estructural").alias("n_structural"))
    return stats.join(usual, "marca")


# --- metrics over the evaluations of the claim_metrics table


def _records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct evaluations with their truth, lanes in one spelling, amounts that are numbers."""
    t = read_table(spark, sf_dir, "claim_metrics").where("record_id is not null")
    lane = F.translate(F.lower(F.trim("lane")), "á", "a")
    rows = t.select(
        "record_id", "received_at", lane.alias("lane"), metrics.finite(F.col("estimated_eur")).alias("estimated"), metrics.finite(F.col("ground_truth.importe_real")).alias("real"), F.col("structural_suspected"),
        F.col("ground_truth.es_estructural").alias("structural_truth"), "severity_pred", F.col("ground_truth.severidad_oficial").alias("severity_truth"), F.when(F.col("processing_time_ms") >= 0, F.col("processing_time_ms")).alias("processing_time_ms"),
    )
    fields = [c for c in rows.columns if c not in ("record_id", "received_at")]
    return rows.groupBy("record_id").agg(F.min(F.struct(nulls_last("received_at").alias("__at"), *fields)).alias("r")).select("record_id", *[f"r.{f}" for f in fields])


_RECORDS = """
with firsts as (select *, row_number() over (partition by record_id order by received_at) as rn from claim_metrics where record_id is not null),
records as (
  select record_id, replace(lower(trim(lane)), 'á', 'a') as lane, case when isfinite(estimated_eur) then estimated_eur end as estimated,
         case when isfinite(ground_truth.importe_real) then ground_truth.importe_real end as real, structural_suspected,
         ground_truth.es_estructural as structural_truth, severity_pred, ground_truth.severidad_oficial as severity_truth,
         case when processing_time_ms >= 0 then processing_time_ms end as processing_time_ms from firsts where rn = 1
),
paid as (select *, abs(cast(round(estimated * 100) as bigint) - cast(round(real * 100) as bigint)) as err from records where lane in ('verde', 'ambar') and estimated is not null and real is not null)"""
_HALF = "cast(round(cast({x} as decimal(24,8)), {n}) as double)"
_HEADLINE = (
    _RECORDS
    + f""",
headline as (select
  (select {_HALF.format(x="cast(sum(err) as double) / count(*) / 100", n=2)} from paid) as mae,
  {_HALF.format(x="cast(count(*) filter (where lane = 'verde') as double) / count(*)", n=4)} as green_of_all,
  {_HALF.format(x="cast(count(*) filter (where lane = 'verde') as double) / count(*) filter (where lane in ('verde', 'ambar'))", n=4)} as green_of_paid,
  {_HALF.format(x="cast(count(*) filter (where structural_truth and not coalesce(structural_suspected, false) and coalesce(lane, '') <> 'rojo') as double) / count(*) filter (where structural_truth)", n=4)} as structural_miss_rate,
  (select {_HALF.format(x="cast(count(*) filter (where real > 0 and abs(estimated - real) <= real * 0.15e0) as double) / count(*)", n=4)} from paid) as share_within,
  {_HALF.format(x="cast(sum(processing_time_ms) as double) / count(processing_time_ms)", n=1)} as mean_ms,
  count(*) as n_records, (select count(*) from paid) as n_paid from records)"""
)


@query(_HEADLINE + " select * from headline")
def headline_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.headline(_records(spark, sf_dir))


@query(
    _RECORDS
    + f""", b(ord, bracket, low, high) as (values (0, '<500', 0e0, 500e0), (1, '500-1500', 500e0, 1500e0), (2, '>1500', 1500e0, 1e300))
select b.bracket, {_HALF.format(x="cast(sum(err) as double) / count(err) / 100", n=2)} as mae, count(err) as n from b left join paid p on p.real >= b.low and p.real < b.high group by b.bracket"""
)
def mae_by_bracket(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.mae_by_bracket(_records(spark, sf_dir), _BRACKETS)


_RANK = "case {c} when 'leve' then 1 when 'moderado' then 2 when 'severo' then 3 end"


@query(
    _RECORDS
    + f""", p as (select {_RANK.format(c="severity_pred")} as i, {_RANK.format(c="severity_truth")} as j from records),
q as (select i, j from p where i is not null and j is not null),
o as (select i, j, count(*) as o from q group by 1, 2), r as (select i, count(*) as r from q group by 1), c as (select j, count(*) as c from q group by 1),
e as (select sum((i - j) * (i - j) * r * c) as e from r, c)
select {_HALF.format(x="1 - cast(sum((i - j) * (i - j) * o) as double) * sum(o) / (select cast(e as double) from e)", n=4)} as kappa, cast(sum(o) as bigint) as n_pairs from o"""
)
def weighted_kappa(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.weighted_kappa(_records(spark, sf_dir), "severity_pred", "severity_truth", SEVERITIES)


@query(
    _HEADLINE
    + """ select m.metric, m.value, m.target, m.passed from (
  select 'mae' as metric, mae as value, 120e0 as target, mae <= 120 as passed from headline
  union all select 'green_of_all', green_of_all, 0.5e0, green_of_all >= 0.5 from headline
  union all select 'structural_miss_rate', structural_miss_rate, 0.02e0, structural_miss_rate <= 0.02e0 from headline
  union all select 'share_within', share_within, 0.8e0, share_within >= 0.8e0 from headline) m where value is not null"""
)
def targets_pass(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.target_check(metrics.headline(_records(spark, sf_dir)), {"mae": ("<=", 120.0), "green_of_all": (">=", 0.5), "structural_miss_rate": ("<=", 0.02), "share_within": (">=", 0.8)})


@query()
def bootstrap_ci(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = metrics.counted(_records(spark, sf_dir)).select("lane", F.abs(F.col("estimated") - F.col("real")).alias("error"))
    return metrics.bootstrap_mean(rows, "error", ["lane"])


@query(_RECORDS + "select lane, count(*) as n, grouping(lane) = 1 as is_total from records group by rollup(lane)")
def lane_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _records(spark, sf_dir).rollup("lane").agg(F.count(F.lit(1)).alias("n"), (F.grouping("lane") == 1).alias("is_total"))


def _scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    return detections(spark, sf_dir).select("claim_id", "pos", "confidence", F.when((F.col("claim_id") + F.col("conf_pct")) % 7 < 5, 1.0).otherwise(0.0).alias("label"))


_SCORED = WITH + ", scored as (select confidence, case when (claim_id + conf_pct) % 7 < 5 then 1e0 else 0e0 end as label from detections)"
_CURVE = (
    _SCORED
    + """, cut as (select *, """
    + " + ".join(f"case when confidence >= {i / 10} then 1 else 0 end" for i in range(1, 10))
    + """ as bin from scored),
curve as (select cast(b.bin as int) as bin, round((b.bin + 0.5) / 10, 4)::double as centre,
  cast(round(cast(cast(sum(cast(confidence as decimal(12,6))) as double) / count(confidence) as decimal(24,8)), 4) as double) as mean_confidence,
  cast(round(cast(cast(sum(cast(label as decimal(12,6))) as double) / count(confidence) as decimal(24,8)), 4) as double) as accuracy, count(confidence) as n
  from range(10) b(bin) left join cut c on c.bin = b.bin group by b.bin)"""
)


@query(_SCORED + "select cast(round(cast(cast(sum((cast(confidence as decimal(12,6)) - cast(label as decimal(12,6))) * (cast(confidence as decimal(12,6)) - cast(label as decimal(12,6)))) as double) / count(*) as decimal(24,8)), 6) as double) as brier, count(*) as n from scored")
def brier_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.brier(_scored(spark, sf_dir))


@query(_CURVE + " select * from curve")
def reliability_curve(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.reliability_curve(_scored(spark, sf_dir))


@query(_CURVE + " select cast(round(cast(cast(sum(abs(cast(accuracy as decimal(12,4)) - cast(mean_confidence as decimal(12,4))) * n) as double) / sum(n) as decimal(24,8)), 4) as double) as ece, cast(sum(n) as bigint) as n from curve")
def calibration_error(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.calibration_error(metrics.reliability_curve(_scored(spark, sf_dir)))


#: Isotonic regression by its max-min formula over the distinct confidences.
ISOTONIC = (
    _SCORED.replace("select confidence,", "select claim_id, pos, confidence,", 1)
    + """, lv as (select confidence as x, sum(label) as y, count(*) as w from scored group by 1),
fit as (select a.x, max(b.low) as v from lv a join (
  select s.x as start, t.x as at, min(m.mean) as low from lv s join lv t on s.x <= t.x join (
    select f.x as start, g.x as stop, sum(k.y) / sum(k.w) as mean from lv f join lv g on f.x <= g.x join lv k on k.x between f.x and g.x group by 1, 2) m on m.start = s.x and m.stop >= t.x group by 1, 2) b on b.at = a.x group by 1)
select d.claim_id, d.pos, round(f.v, 4) as confidence, d.confidence as confidence_raw from scored d join fit f on d.confidence = f.x"""
)


@query(ISOTONIC)
def isotonic_calibrated(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = stage(_scored(spark, sf_dir), "scored").df
    return metrics.Calibrator("isotonic").fit(rows).transform(rows).select("claim_id", "pos", "confidence", "confidence_raw")


# --- audit lines and reports


def _outputs(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = claims(spark, sf_dir)
    stamp = F.concat(F.col("fecha_cierre").cast("string"), F.lit("T00:00:00Z"))
    return c.select(
        F.col("claim_id").cast("string").alias("claim_id"),
        F.concat(F.lit("EVA-"), date_token(stamp), F.lit("-"), F.upper(F.substring(F.sha2(F.concat(F.col("claim_id").cast("string"), stamp), 256), 1, 8))).alias("id_evaluacion"),
        F.array(F.sha2(F.col("claim_id").cast("string"), 256)).alias("input_hashes"),
        F.lit("v1").alias("model_version"),
        F.col("severidad_oficial").alias("output_summary"),
        F.col("anio").alias("processing_time_ms"),
        F.lit("R-1").alias("rule_id_applied"),
        stamp.alias("timestamp"),
    )


@query(
    WITH
    + """, s as (select *, cast(fecha_cierre as varchar) || 'T00:00:00Z' as stamp from claims)
select replace(cast(fecha_cierre as varchar), '-', '') as date,
  '{"claim_id":"' || claim_id || '","id_evaluacion":"EVA-' || replace(cast(fecha_cierre as varchar), '-', '') || '-' || upper(substr(sha256(cast(claim_id as varchar) || stamp), 1, 8))
  || '","input_hashes":["' || sha256(cast(claim_id as varchar)) || '"],"model_version":"v1","output_summary":"' || severidad_oficial || '","processing_time_ms":' || anio || ',"rule_id_applied":"R-1","timestamp":"' || stamp || '"}' as line from s"""
)
def audit_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit_records(_outputs(spark, sf_dir))


@query("select strftime(ts, '%Y%m%d') as date, event_type, count(*) as n from events group by 1, 2")
def audit_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = read_table(spark, sf_dir, "events").select(date_token(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'")).alias("date"), "event_type")
    return e.groupBy("date", "event_type").agg(F.count(F.lit(1)).alias("n"))


@query("select event_id, array_to_string(list_sort([x for x in json_keys(props) if x <> 'j']), ',') as extra from events where len([x for x in json_keys(props) if x <> 'j']) > 0")
def unexpected_event_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    from claimweave.operators.validate import unexpected_keys

    e = read_table(spark, sf_dir, "events").select("event_id", unexpected_keys(F.col("props"), ("j",)).alias("x"))
    return e.where(F.size("x") > 0).select("event_id", F.array_join("x", ",").alias("extra"))


@query(WITH + "select case when area_pct < 2 then 'Leve' when area_pct < 10 then 'Moderado' else 'Severo' end as band, count(*) as n from detections group by 1")
def area_bands(spark: SparkSession, sf_dir: str) -> DataFrame:
    band = F.when(F.col("area_pct") < 2, "Leve").when(F.col("area_pct") < 10, "Moderado").otherwise("Severo")
    return detections(spark, sf_dir).groupBy(band.alias("band")).agg(F.count(F.lit(1)).alias("n"))


@query("select o_orderkey as id, case when o_orderkey % 3 = 0 then 'new' else o_orderpriority end as label from orders")
def upsert_update(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read_table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"), F.col("o_orderpriority").alias("label"))
    return lookup.upsert(o, o.where("id % 3 = 0").withColumn("label", F.lit("new")), "id")


@query("select o_orderkey as id, o_orderpriority as label from orders where o_orderkey % 2 = 0 union all select o_orderkey, 'new' from orders where o_orderkey % 3 = 0 and o_orderkey % 2 <> 0")
def upsert_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read_table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"), F.col("o_orderpriority").alias("label"))
    return lookup.append_new(o.where("id % 2 = 0"), o.where("id % 3 = 0").withColumn("label", F.lit("new")), "id")


# --- streams in their batch form, and as streams


@query("select time_bucket(interval '1 day', ts) as start, event_type, count(*) as n from events group by 1, 2")
def daily_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    from claimweave.streaming.monitor import windowed_counts

    return windowed_counts(read_table(spark, sf_dir, "events"), "ts", "event_type")


@query(
    """with e as (select user_id, ts, case when ts - lag(ts) over (partition by user_id order by ts) < interval '30 minutes' then 0 else 1 end as fresh from events),
s as (select *, sum(fresh) over (partition by user_id order by ts rows unbounded preceding) as session from e)
select user_id, min(ts) as start, max(ts) + interval '30 minutes' as "end", count(*) as n from s group by user_id, session"""
)
def session_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    from claimweave.streaming.monitor import sessions

    return sessions(read_table(spark, sf_dir, "events"), "ts", "user_id")


def _run_stream(df: DataFrame, name: str, mode: str) -> DataFrame:
    """Run a stream over all that is there and return what it wrote."""
    from claimweave.operators.staging import stage_root
    import uuid

    spark = df.sparkSession
    root = f"{stage_root(spark)}/{name}-{uuid.uuid4().hex}"
    # state of very many keys lies on disk and not in the heap; a stream keeps the settings it starts with
    store = "spark.sql.streaming.stateStore.providerClass"
    own = spark.conf.get(store, None)
    spark.conf.set(store, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        q = df.writeStream.foreachBatch(lambda batch, n: batch.withColumn("batch", F.lit(n)).write.mode("append").parquet(f"{root}/out")).outputMode(mode).option("checkpointLocation", f"{root}/checkpoint").trigger(availableNow=True).start()
    finally:
        spark.conf.set(store, own) if own else spark.conf.unset(store)
    q.awaitTermination()
    return spark.read.parquet(f"{root}/out")


def _stream(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    schema = read_table(spark, sf_dir, name).schema
    return spark.readStream.schema(schema).option("pathGlobFilter", f"{name}.parquet").option("recursiveFileLookup", "false").parquet(sf_dir)


@query("select time_bucket(interval '1 day', ts) as start, event_type, count(*) as n from events group by 1, 2")
def streaming_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    from claimweave.streaming.monitor import windowed_counts

    out = _run_stream(windowed_counts(_stream(spark, sf_dir, "events"), "ts", "event_type"), "daily", "update")
    return out.groupBy("start", "event_type").agg(F.max_by("n", "batch").alias("n"))


@query("select cast(l_orderkey as varchar) as claim_id, count(*) as n_detections, count(distinct l_returnflag || '|' || l_linestatus) as n_damages, max(l_discount) as best from lineitem group by 1")
def streaming_consolidate(spark: SparkSession, sf_dir: str) -> DataFrame:
    from claimweave.streaming.monitor import running_damages

    lines = _stream(spark, sf_dir, "lineitem")
    rows = lines.select(F.col("l_orderkey").alias("claim_id"), F.col("l_returnflag").alias("type"), F.col("l_linestatus").alias("part"), F.col("l_discount").alias("confidence"))
    out = _run_stream(running_damages(rows), "damages", "update")
    return out.groupBy("claim_id").agg(F.max_by(F.struct("n_detections", "n_damages", "best"), "batch").alias("r")).select("claim_id", "r.*")
