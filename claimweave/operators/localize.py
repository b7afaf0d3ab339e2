"""Zones of damage boxes from the parts detected in the same image.

A damage box meets the parts of its own image.  A part counts if it covers at
least a share of the damage; parts that lie on one side of the vehicle weigh
more than central ones.  The best score wins, the part listed first among
equals.

Defined results: parts without a zone are left out; a damage without a part that
counts has no row; boxes without an area are covered by nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimweave.functions.geometry import overlap_share
from claimweave.functions.numeric import half_up
from claimweave.functions.vocabulary import SIDE_ZONES

#: Least share of a damage that a part must cover, and the weight of a central part.
MIN_OVERLAP, CENTRAL = 0.1, 0.7


def overlap_candidates(damages: DataFrame, parts: DataFrame, image: str, min_overlap: float = MIN_OVERLAP) -> DataFrame:
    """Every (damage, part) of one image that counts: columns of ``damages`` and part, zone, ord, overlap, score.

    ``damages`` has the image and ``box`` (x1, y1, x2, y2); ``parts`` has the
    image, part, zone, ord and ``part_box``.
    """
    met = damages.join(parts.where("zone is not null").select(image, "part", "zone", "ord", "part_box"), image)
    share = overlap_share(F.col("box"), F.col("part_box"))
    weight = F.when(F.col("zone").isin(*SIDE_ZONES), 1.0).otherwise(CENTRAL)
    kept = met.withColumn("raw", share).where(F.col("raw") >= min_overlap)
    return kept.withColumn("overlap", half_up(F.col("raw"), 4)).withColumn("score", half_up(F.col("overlap") * weight, 4)).drop("raw", "part_box")


def best_zone(damages: DataFrame, parts: DataFrame, image: str, identity: str, min_overlap: float = MIN_OVERLAP) -> DataFrame:
    """(identity, part, zone, overlap, score) of the best candidate of each damage, by map-side combined maximum."""
    found = overlap_candidates(damages, parts, image, min_overlap)
    best = F.max_by(F.struct("part", "zone", "overlap", "score"), F.struct("score", (-F.col("ord")).alias("o")))
    return found.groupBy(identity).agg(best.alias("b")).select(identity, "b.*")
