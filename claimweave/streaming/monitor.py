"""Arriving evaluations and photos as streams: daily counts, late rows, repeated photos and running damages."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def windowed_counts(rows: DataFrame, time: str, key: str, window: str = "1 day", late: str = "2 days") -> DataFrame:
    """(start, key, n) per window; rows later than ``late`` are left to the watermark.  Works on streams and tables."""
    timed = rows.withColumn("__t", F.col(time).cast("timestamp")).withWatermark("__t", late)
    return timed.groupBy(F.window("__t", window).alias("w"), key).agg(F.count(F.lit(1)).alias("n")).select(F.col("w.start").alias("start"), key, "n")


def first_arrivals(rows: DataFrame, time: str, key: str, late: str = "2 days") -> DataFrame:
    """Rows whose key has not been seen within the watermark."""
    return rows.withColumn(time, F.col(time).cast("timestamp")).withWatermark(time, late).dropDuplicatesWithinWatermark([key])


def sessions(rows: DataFrame, time: str, key: str, gap: str = "30 minutes", late: str = "1 day") -> DataFrame:
    """(key, start, end, n) of bursts of a key's rows with no pause above ``gap``."""
    timed = rows.withColumn("__t", F.col(time).cast("timestamp")).withWatermark("__t", late)
    return timed.groupBy(key, F.session_window("__t", gap).alias("w")).agg(F.count(F.lit(1)).alias("n")).select(key, F.col("w.start").alias("start"), F.col("w.end").alias("end"), "n")


def running_damages(detections: DataFrame) -> DataFrame:
    """Running consolidation of a stream of detections: (claim_id, n_detections, n_damages, best) after each batch.

    State per claim is the set of its damages (type and part), their number of
    detections and the best confidence, so it is bounded by the vocabulary and
    not by the photos.
    """

    part = F.when(F.col("part").isin("", "unknown"), "").otherwise(F.coalesce(F.col("part"), F.lit("")))
    name = F.concat(F.coalesce(F.col("type"), F.lit("None")), F.lit("|"), part)
    confidence = F.coalesce(F.nanvl(F.col("confidence").cast("double"), F.lit(0.0)), F.lit(0.0))
    fed = detections.select(F.col("claim_id").cast("string").alias("claim_id"), name.alias("name"), confidence.alias("confidence"))
    per_claim = fed.groupBy("claim_id").agg(F.count(F.lit(1)).alias("n"), F.collect_set("name").alias("names"), F.max("confidence").alias("best"))
    return per_claim.select("claim_id", F.col("n").alias("n_detections"), F.size("names").cast("bigint").alias("n_damages"), F.greatest("best", F.lit(0.0)).alias("best"))
