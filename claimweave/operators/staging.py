"""Cut lineage with tables in the shared folder of the cluster.

Iterative operators write every round as Parquet below the folder that
``spark.checkpoint.dir`` names, so a lost executor costs a re-read and not a
recomputation, and the next plan starts from a scan with known size.  Operators
marked :func:`tidy` delete what they staged as soon as nothing of theirs reads it.
"""

from __future__ import annotations

import atexit
import functools
import gc
import shutil
import tempfile
import threading
import uuid

from pyspark.sql import DataFrame, SparkSession

_SETTING = "spark.checkpoint.dir"


def stage_root(spark: SparkSession) -> str:
    """The shared folder for staged tables.

    On a cluster it comes from ``spark.checkpoint.dir``, or else from the
    context's checkpoint folder.  A local session that leaves both unset gets a
    temporary folder of its own, set once a session.
    """
    root = spark.conf.get(_SETTING, None)
    if not root:
        own = spark.sparkContext._jsc.sc().getCheckpointDir()
        root = own.get() if own.isDefined() else None
    if not root:
        master = spark.sparkContext.master
        if not master.startswith("local"):
            raise ValueError(f"{_SETTING} must name a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="claimweave-stage-")
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
        root = "file://" + folder
        spark.conf.set(_SETTING, root)
    return root.rstrip("/")


class Staged:
    """A table written to the stage folder, read back with its own schema."""

    def __init__(self, spark: SparkSession, path: str, schema) -> None:
        self.spark, self.path, self.schema = spark, path, schema

    @property
    def df(self) -> DataFrame:
        return self.spark.read.schema(self.schema).parquet(self.path)

    def drop(self) -> None:
        """Delete the files; call it only when no unevaluated plan reads them."""
        jvm = self.spark.sparkContext._jvm
        path = jvm.org.apache.hadoop.fs.Path(self.path)
        path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)

    def empty(self) -> bool:
        return self.df.isEmpty()


def stage(df: DataFrame, tag: str) -> Staged:
    """Run ``df`` once and keep its rows as Parquet in the stage folder."""
    spark = df.sparkSession
    path = f"{stage_root(spark)}/{tag}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    staged = Staged(spark, path, df.schema)
    if _open():
        _open()[-1].append(staged)
    return staged


_local = threading.local()


def _open() -> list[list[Staged]]:
    """What the tidy operators at work in this thread have staged, the innermost last."""
    if not hasattr(_local, "scopes"):
        _local.scopes = []
    return _local.scopes


def _frames(value) -> list[DataFrame]:
    """DataFrames of a result: itself, or those of its parts."""
    if isinstance(value, DataFrame):
        return [value]
    if isinstance(value, Staged):
        return [value.df]
    if isinstance(value, dict):
        return [f for v in value.values() for f in _frames(v)]
    if isinstance(value, (list, tuple)):
        return [f for v in value for f in _frames(v)]
    return _frames(vars(value)) if hasattr(value, "__dict__") else []


def tidy(operator):
    """Delete, when the operator returns, the tables it staged that its result does not read.

    What the result reads is handed on to the tidy operator that called it, if
    any; for the outermost one it stays until the caller clears the folder, as
    the plan that reads it may run at any later time.
    """

    @functools.wraps(operator)
    def run(*args, **kwargs):
        scopes = _open()
        scopes.append([])
        try:
            result = operator(*args, **kwargs)
        finally:
            mine = scopes.pop()
        read = "\n".join(f for df in _frames(result) for f in df.inputFiles())
        for staged in mine:
            if staged.path.rsplit("/", 1)[1] not in read:
                staged.drop()
            elif scopes:
                scopes[-1].append(staged)
        if mine:
            # shuffle files of jobs that are over stay until the driver collects its garbage
            gc.collect()
            mine[0].spark.sparkContext._jvm.System.gc()
        return result

    return run
