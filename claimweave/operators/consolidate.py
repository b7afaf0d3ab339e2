"""Merge repeated detections of one claim into unique damages.

Detections of one type on one region fall together; the region is the part if
known, else the zone, else nothing.  Vocabulary values are chosen by weighted
vote: the value with the largest sum of confidences, the first seen among
equals.  Weights are summed as whole millionths, so the winner does not depend
on the order of addition.

Defined results: a null confidence weighs 0; null, empty and ``unknown`` values
do not vote, and a vote nobody takes part in gives ``unknown``; a missing
extension counts as small; severity is null where no detection has a valid one;
null hashes support nothing; an empty input gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from claimweave.functions.numeric import half_up, known, rank_in, word_at
from claimweave.functions.vocabulary import DAMAGE_TYPES, EXTENSIONS, SEVERITIES

KEYS = ("claim_id", "type", "region_kind", "region")
VOTED = ("zone", "part", "part_category")


def micro(confidence: Column) -> Column:
    """A confidence in whole millionths, so that sums of it are exact."""
    return F.round(F.coalesce(confidence, F.lit(0.0)) * 1_000_000).cast("bigint")


def with_region(detections: DataFrame) -> DataFrame:
    part, zone = known(F.col("part")), known(F.col("zone"))
    return detections.withColumns(
        {
            "region_kind": F.when(part.isNotNull(), "part").when(zone.isNotNull(), "zone").otherwise("none"),
            "region": F.coalesce(part, zone, F.lit("")),
        }
    )


def filter_detections(detections: DataFrame, thresholds: dict[str, float], default: float, types: tuple[str, ...] = DAMAGE_TYPES) -> DataFrame:
    """Detections of known types at or above the threshold of their type."""
    floor = F.coalesce(F.try_element_at(F.create_map(*[x for k, v in thresholds.items() for x in (F.lit(k), F.lit(v))]), F.col("type")), F.lit(default)) if thresholds else F.lit(default)
    return detections.where(F.col("type").isin(*types) & (F.coalesce("confidence", F.lit(0.0)) >= floor))


def weighted_votes(rows: DataFrame, keys: list[str], value: str, weight: Column, pos: str) -> DataFrame:
    """(*keys, value) with the largest sum of ``weight``; the value seen first wins ties."""
    totals = rows.where(known(F.col(value)).isNotNull()).groupBy(*keys, value).agg(F.sum(weight).alias("__w"), F.min(pos).alias("__p"))
    return totals.groupBy(*keys).agg(F.max_by(value, F.struct(F.col("__w"), (-F.col("__p")).alias("p"))).alias(value))


def _voted(votes: Column, field: str) -> Column:
    """Value of a field with the largest weight among tallies (w, p and the fields), the one seen first among equals; null where nobody votes."""
    said = F.filter(votes, lambda v: v[field].isNotNull())
    names = F.array_distinct(F.transform(said, lambda v: v[field]))

    def tally(name: Column) -> Column:
        mine = F.filter(said, lambda v: v[field] == name)
        weight = F.aggregate(mine, F.lit(0).cast("bigint"), lambda acc, v: acc + v["w"])
        return F.struct((-weight).alias("w"), F.array_min(F.transform(mine, lambda v: v["p"])).alias("p"), name.alias("name"))

    return F.array_min(F.transform(names, tally)).getField("name")


def consolidate(detections: DataFrame) -> DataFrame:
    """One row per unique damage of a claim, numbered C1, C2, ... in order of first appearance.

    Detections are first tallied per region and combination of voted values,
    with map-side combine, so a claim of very many photos shrinks to what the
    vocabularies allow before it is placed; then everything of a claim is done
    where it lies.
    """
    keyed = with_region(detections).withColumn("w", micro(F.col("confidence")))
    voted = {f: known(F.col(f)).alias(f"__{f}") for f in VOTED}
    tallies = keyed.groupBy(*KEYS, *voted.values()).agg(
        F.sum("w").alias("w"),
        F.sum((F.col("w") * F.col("w")).cast("decimal(38,0)")).alias("ww"),
        F.max(F.coalesce(rank_in(F.col("extension"), EXTENSIONS), F.lit(1))).alias("ext"),
        F.max(rank_in(F.col("severity"), SEVERITIES)).alias("sev"),
        F.bool_or(F.coalesce("structural_suspicion", F.lit(False))).alias("structural"),
        F.max(F.coalesce("area_pct", F.lit(0.0))).alias("area"),
        F.collect_set(F.nullif("image_hash", F.lit(""))).alias("images"),
        F.count(F.lit(1)).alias("n"),
        F.min("pos").alias("p"),
    )
    base = tallies.repartition("claim_id").groupBy(*KEYS).agg(
        half_up(F.coalesce(F.try_divide(F.sum("ww").cast("double"), F.sum("w") * F.lit(1e6)), F.lit(0.0)), 4).alias("confidence"),
        F.max("ext").alias("ext"),
        F.max("sev").alias("sev"),
        F.bool_or("structural").alias("structural_suspicion"),
        half_up(F.max("area"), 2).alias("area_pct"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("images")))).alias("supporting_images"),
        F.sum("n").alias("n_detections"),
        F.min("p").alias("first_pos"),
        F.collect_list(F.struct("w", "p", *[F.col(f"__{f}").alias(f) for f in VOTED])).alias("votes"),
    )
    number = F.row_number().over(Window.partitionBy("claim_id").orderBy("first_pos", "type", "region_kind", "region"))
    return base.select(
        "claim_id",
        F.concat(F.lit("C"), number.cast("string")).alias("damage_id"),
        "type",
        *[F.coalesce(_voted(F.col("votes"), f), F.lit("unknown")).alias(f) for f in VOTED],
        word_at(F.col("ext"), EXTENSIONS).alias("extension"),
        word_at(F.col("sev"), SEVERITIES).alias("severity"),
        "confidence",
        "structural_suspicion",
        "supporting_images",
        "area_pct",
        "n_detections",
        "first_pos",
    )


def zones_summary(damages: DataFrame) -> DataFrame:
    """(claim_id, zone, n) of the consolidated damages."""
    return damages.groupBy("claim_id", "zone").agg(F.count(F.lit(1)).alias("n"))


def assemble_claims(damages: DataFrame) -> DataFrame:
    """One row per claim: its damages as an array of structs in order, and a map of damages per zone."""
    fields = [c for c in damages.columns if c not in ("claim_id", "first_pos")]
    ordered = F.array_sort(F.collect_list(F.struct("first_pos", F.struct(*fields).alias("d"))))
    listed = damages.groupBy("claim_id").agg(F.transform(ordered, lambda x: x["d"]).alias("damages"))
    # counted in the list, so that the damages are made once
    zones = F.transform("damages", lambda d: d["zone"])
    counted = F.transform(F.array_sort(F.array_distinct(zones)), lambda z: F.struct(z.alias("zone"), F.size(F.filter(zones, lambda x: x == z)).cast("bigint").alias("n")))
    return listed.where("claim_id is not null").withColumn("zones_summary", F.map_from_entries(counted))
