"""Session factory with the settings every operator here was designed for."""

from __future__ import annotations

from pyspark.sql import SparkSession

#: Settings that matter for results (time zone) or for skew and small files.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
}


def build_session(app: str = "claimweave", master: str | None = None, **conf: str) -> SparkSession:
    """Create or reuse a session.

    ``master`` is only given for local runs; on a cluster spark-submit sets it.
    Extra settings are passed as keyword arguments with dots written as ``__``.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in DEFAULTS.items():
        builder = builder.config(key, value)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def read_table(spark: SparkSession, directory: str, name: str):
    """The Parquet table ``name`` of a data folder (one file or a folder of files)."""
    return spark.read.parquet(f"{directory}/{name}.parquet")
