"""Joins that stay balanced when one key holds a large share of the rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: A key is heavy when it holds more than one in this many rows, so at most
#: this many keys can be heavy, whatever the size of the table.
HEAVY_SHARE = 200


def heavy_keys(df: DataFrame, key: str, share: int = HEAVY_SHARE) -> DataFrame:
    """Keys of ``df`` that hold more than ``1/share`` of its rows: fewer than ``share`` rows.

    Counting combines on the map side, so the hot key itself is never gathered.
    """
    counts = df.where(F.col(key).isNotNull()).groupBy(F.col(key).alias("__heavy")).count()
    limit = df.agg(F.count(F.lit(1)) / F.lit(share)).scalar()
    return counts.where(F.col("count") > limit).select("__heavy")


def lookup_join(left: DataFrame, right: DataFrame, key: str, share: int = HEAVY_SHARE) -> DataFrame:
    """``left`` left-joined to ``right`` on ``key``, for a ``right`` that has each key at most once.

    Rows of heavy keys meet a broadcast of the right rows of just those keys
    (fewer than ``share`` rows by construction); all others are shuffled.  Rows
    with a null key get nulls.  Result columns: those of ``left``, then those
    of ``right`` without the key.
    """
    heavy = F.broadcast(heavy_keys(left, key, share))
    flagged = left.join(heavy, left[key] == heavy["__heavy"], "left")
    light = flagged.where(F.col("__heavy").isNull()).drop("__heavy")
    hot = flagged.where(F.col("__heavy").isNotNull()).drop("__heavy")
    few = right.join(heavy, right[key] == heavy["__heavy"], "left_semi")
    return light.join(right, key, "left").unionByName(hot.join(F.broadcast(few), key, "left"))


def spread_join(left: DataFrame, right: DataFrame, key: str, share: int = HEAVY_SHARE, salts: int = 32) -> DataFrame:
    """Inner join on ``key`` for a ``right`` with any number of rows a key.

    Rows of the heavy keys of ``left`` are dealt out over ``salts`` places, and
    the right rows of just those keys are copied to each; all others meet as usual.
    """
    heavy = F.broadcast(heavy_keys(left, key, share))
    rest = [c for c in left.columns if c != key]
    dealt = left.join(heavy, left[key] == heavy["__heavy"], "left").withColumn("__salt", F.when(F.col("__heavy").isNotNull(), F.pmod(F.xxhash64(*rest), F.lit(salts))).otherwise(F.lit(0)).cast("int")).drop("__heavy")
    copied = right.join(heavy, right[key] == heavy["__heavy"], "left").withColumn("__salt", F.explode(F.when(F.col("__heavy").isNotNull(), F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0))))).drop("__heavy")
    return dealt.join(copied, [key, "__salt"]).drop("__salt")


def salted(key: Column, rows: Column, buckets: int) -> Column:
    """``key`` with a bucket drawn from the row's own identity, for two-step aggregation."""
    return F.struct(key.alias("key"), F.pmod(F.xxhash64(rows), F.lit(buckets)).cast("int").alias("salt"))
