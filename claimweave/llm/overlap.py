"""Same or near-same records across splits, by joins of segmented fingerprints.

Photos of the two sides meet by identity, by content hash, by vehicle and shot,
and by perceptual code: codes within a Hamming radius are found by the exact
segment join of :mod:`claimweave.operators.neardup` over distinct codes and
expanded to records after verification.

Defined results: null codes, hashes and numbers match nothing; rows repeated
with the same identity count once; empty sides give no pairs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimweave.operators.neardup import HOT_BUCKET, hamming_pairs
from claimweave.operators.staging import stage, tidy


@tidy
def held_out_overlaps(train: DataFrame, held_out: DataFrame, radius: int, hot: int = HOT_BUCKET) -> DataFrame:
    """Distinct (held_out_id, how) of held-out records that train has as well, without naming the partners.

    Hashes, shots and codes meet as distinct values, so a value that very many
    records share costs as much as any other.
    """
    t, h = stage(train, "train").df, stage(held_out, "held-out").df
    how = lambda df, name: df.select(F.col("id").alias("held_out_id"), F.lit(name).alias("how"))
    shot = ["vehicle", "shot"]
    codes = hamming_pairs(t.select("code"), h.select("code"), radius, hot).select(F.col("right_code").alias("code")).distinct()
    return (
        how(h.join(t.select("id").distinct(), "id", "left_semi"), "itself")
        .unionByName(how(h.join(t.select("content_hash").distinct(), "content_hash", "left_semi"), "hash"))
        .unionByName(how(h.join(t.select(*shot).distinct(), shot, "left_semi"), "shot"))
        .unionByName(how(h.join(codes, "code", "left_semi"), "code"))
        .distinct()
    )


@tidy
def cross_pairs(train: DataFrame, held_out: DataFrame, radius: int, hot: int = HOT_BUCKET) -> DataFrame:
    """Distinct (train_id, held_out_id, how) of records that are the same or nearly the same.

    Both inputs have the columns id, content_hash, code, vehicle, shot.  ``how``
    is ``itself``, ``hash``, ``code`` or ``shot``; a pair may come out once per way.
    """
    t, h = stage(train, "train").df, stage(held_out, "held-out").df
    itself = t.join(h, t["id"] == h["id"]).select(t["id"].alias("train_id"), h["id"].alias("held_out_id"), F.lit("itself").alias("how"))
    by_hash = t.join(h, t["content_hash"] == h["content_hash"]).select(t["id"].alias("train_id"), h["id"].alias("held_out_id"), F.lit("hash").alias("how"))
    by_shot = t.join(h, (t["vehicle"] == h["vehicle"]) & (t["shot"] == h["shot"])).select(t["id"].alias("train_id"), h["id"].alias("held_out_id"), F.lit("shot").alias("how"))
    codes = stage(hamming_pairs(t.select("code"), h.select("code"), radius, hot), "code-pairs").df
    by_code = (
        codes.join(t.select(F.col("id").alias("train_id"), F.col("code").alias("left_code")), "left_code")
        .join(h.select(F.col("id").alias("held_out_id"), F.col("code").alias("right_code")), "right_code")
        .select("train_id", "held_out_id", F.lit("code").alias("how"))
    )
    return itself.unionByName(by_hash).unionByName(by_shot).unionByName(by_code).distinct()
