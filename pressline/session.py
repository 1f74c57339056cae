"""Session helpers shared by every operator: scratch tables and sizing."""

from __future__ import annotations

import gc
import os
import re
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

#: Used only where the session names no spark.checkpoint.dir (tests, laptops).
LOCAL_SCRATCH = "file:///tmp/checkpoints"
#: Texts are long: an Arrow batch holds so many bytes, not a number of rows.
ARROW_BYTES, ARROW_BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch", str(4 << 20)


def scratch_root(spark: SparkSession) -> str:
    """Folder that the driver and all executors share, from spark.checkpoint.dir."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared and not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
    return (shared or LOCAL_SCRATCH).rstrip("/")


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write df as Parquet in the shared scratch folder and read it back.

    Cuts the lineage with a replicated copy: a lost executor re-reads files,
    it never recomputes the plan above. The files go with discard() or when the driver ends.
    """
    spark = df.sparkSession
    path = f"{scratch_root(spark)}/pressline-{uuid.uuid4().hex}/{label}"
    df.write.parquet(path)
    system, folder = _folder(spark, path)
    system.deleteOnExit(folder)
    out = spark.read.schema(df.schema).parquet(path)
    out._stored_at = path
    for noted in _NOTED:
        noted.append(path)
    return out


def _folder(spark: SparkSession, path: str):
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()), folder


def discard(*tables: DataFrame) -> None:
    """Delete tables that stored() wrote and no plan reads any more."""
    for table in tables:
        discard_paths(table.sparkSession, [table._stored_at])


def discard_paths(spark: SparkSession, paths: list[str]) -> None:
    """discard() by path; a path that is gone already is no error."""
    for path in paths:
        system, folder = _folder(spark, path)
        system.delete(folder.getParent(), True)
        system.cancelDeleteOnExit(folder)


_NOTED: list[list[str]] = []


@contextmanager
def noting() -> Iterator[list[str]]:
    """The paths that stored() writes inside the block."""
    paths: list[str] = []
    _NOTED.append(paths)
    try:
        yield paths
    finally:
        _NOTED.pop()


def release(spark: SparkSession) -> None:
    """Let Spark drop shuffle files and broadcasts that nothing refers to any more."""
    gc.collect()
    spark._jvm.System.gc()


def lean(spark: SparkSession) -> SparkSession:
    """Arrow batches of ARROW_BATCH_BYTES unless the session has a bound of its own.

    Spark's default of 64 MB is held in the JVM, and again in each Python worker. The bound on rows is
    left alone.
    """
    if ARROW_BYTES not in spark.conf.getAll:
        spark.conf.set(ARROW_BYTES, ARROW_BATCH_BYTES)
    return spark


def visible(spark: SparkSession) -> SparkSession:
    """Let Python workers on this machine import the package from where the driver has it.

    On a cluster ship it with --py-files; this only adds a folder to their path.
    """
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    env = spark.sparkContext.environment
    if root not in env.get("PYTHONPATH", "").split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(filter(None, [root, env.get("PYTHONPATH", "")]))
    return lean(spark)
