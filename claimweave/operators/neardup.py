"""Difference hashes and pairs of 64-bit codes within a Hamming radius.

A code is cut into four 16-bit blocks.  Two codes within radius r agree on some
block up to r // 4 bits (pigeonhole), so each code of one side is stored under
its four blocks and each code of the other side probes every block value within
that local radius; candidates are verified on the whole code.  Only distinct
codes are joined, so groups of copies meet once and are expanded afterwards.

A block value that very many codes share would make its bucket quadratic.  Such
buckets are keyed a second time: one of the three other blocks agrees up to
r // 3 bits, so the pair (block, second block) is joined in its place.  That is
exact, like the first level.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimweave.operators.staging import stage, tidy

BLOCKS, WIDTH = 4, 16
#: Distinct stored codes under one block value above which a bucket is keyed twice.
HOT_BUCKET = 4096


def _blocks(code: Column) -> list[Column]:
    return [F.shiftrightunsigned(code, WIDTH * i).bitwiseAND(F.lit((1 << WIDTH) - 1)).cast("int") for i in range(BLOCKS)]


def _masks(radius: int) -> list[int]:
    """Every mask of at most ``radius`` bits in one block."""
    return [sum(1 << b for b in bits) for n in range(radius + 1) for bits in combinations(range(WIDTH), n)]


def _near(value: Column, radius: int) -> Column:
    return F.explode(F.transform(F.array(*[F.lit(m) for m in _masks(radius)]), lambda m: value.bitwiseXOR(m)))


def _stored(codes: DataFrame) -> DataFrame:
    return codes.select("code", F.posexplode(F.array(*_blocks(F.col("code")))).alias("block", "value"))


@tidy
def hamming_pairs(left: DataFrame, right: DataFrame, radius: int, hot: int = HOT_BUCKET) -> DataFrame:
    """Distinct (left_code, right_code) within ``radius`` bits; both inputs are one bigint column ``code``."""
    local = radius // BLOCKS
    stored = stage(_stored(left.where("code is not null").distinct()), "blocks")
    probes = _stored(right.where("code is not null").distinct()).select("code", "block", _near(F.col("value"), local).alias("value"))
    crowded = stored.df.groupBy("block", "value").count().where(F.col("count") > hot).select("block", "value")
    crowded = stage(crowded, "crowded")
    # at most 4 * stored / hot block values are crowded; they are joined, never collected
    wide = stage(probes.join(crowded.df.withColumn("is_hot", F.lit(True)), ["block", "value"], "left"), "probes")
    verified = F.bit_count(F.col("left_code").bitwiseXOR(F.col("right_code"))) <= radius
    plain = (
        stored.df.select(F.col("code").alias("left_code"), "block", "value")
        .join(wide.df.where("is_hot is null").select(F.col("code").alias("right_code"), "block", "value"), ["block", "value"])
        .where(verified).select("left_code", "right_code")
    )
    out = plain
    if not crowded.empty():
        second = F.posexplode(F.array(*_blocks(F.col("code")))).alias("block2", "value2")
        inner = stored.df.join(crowded.df, ["block", "value"], "left_semi").select("code", "block", "value", second).where("block <> block2")
        outer = wide.df.where("is_hot").select("code", "block", "value", second).where("block <> block2").select("code", "block", "value", "block2", _near(F.col("value2"), radius // (BLOCKS - 1)).alias("value2"))
        twice = (
            inner.select(F.col("code").alias("left_code"), "block", "value", "block2", "value2")
            .join(outer.select(F.col("code").alias("right_code"), "block", "value", "block2", "value2"), ["block", "value", "block2", "value2"])
            .where(verified).select("left_code", "right_code")
        )
        out = plain.unionByName(twice)
    return out.distinct()


def dhash_of_vector(vector: Column, n_bits: int = 63) -> Column:
    """Bits of v[i] < v[i+1], the first as the highest of ``n_bits``."""
    return F.aggregate(
        F.sequence(F.lit(0), F.lit(n_bits - 1)),
        F.lit(0).cast("bigint"),
        lambda acc, i: F.shiftleft(acc, 1) + F.when(F.get(vector, i) < F.get(vector, i + 1), F.lit(1)).otherwise(F.lit(0)).cast("bigint"),
    )


def hamming(a: Column, b: Column) -> Column:
    return F.bit_count(a.bitwiseXOR(b))


def near_pairs(rows: DataFrame, identity: str, code: str, radius: int, hot: int = HOT_BUCKET) -> DataFrame:
    """(id_a, id_b, distance) with id_a < id_b of rows whose codes differ in at most ``radius`` bits.

    Equal codes are met once and expanded at the end.  Null codes and ids pair with nothing.
    """
    known = stage(rows.where(F.col(code).isNotNull() & F.col(identity).isNotNull()).select(F.col(identity).alias("id"), F.col(code).alias("code")).distinct(), "codes").df
    met = hamming_pairs(known.select("code"), known.select("code"), radius, hot)
    left = known.select(F.col("id").alias("id_a"), F.col("code").alias("left_code"))
    right = known.select(F.col("id").alias("id_b"), F.col("code").alias("right_code"))
    return met.join(left, "left_code").join(right, "right_code").where("id_a < id_b").select("id_a", "id_b", hamming(F.col("left_code"), F.col("right_code")).cast("int").alias("distance"))
