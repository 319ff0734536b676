"""Tables that a plan writes once and reads again."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``; only where that is unset and all runs in one process (tests, local runs)
    a new local one, which other machines would not see."""
    at = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if at is None:
        if not re.fullmatch(r"local(\[[^-]*\])?", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir names no folder that all executors share")
        at = "file://" + tempfile.mkdtemp(prefix="spark-")
        spark.sparkContext.setCheckpointDir(at)
    return at.rstrip("/")


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder; what lies there goes when the driver's JVM ends."""
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(p)
    return path


def cut(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back: later passes neither repeat its work nor depend on
    an executor that may be lost. The files go with ``drop``, or when the driver's JVM ends."""
    spark = df.sparkSession
    path = scratch(spark, name)
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._cut_at = path
    return out


def drop(*tables: DataFrame | None) -> None:
    """Delete the files of tables that ``cut`` wrote and nothing reads any more."""
    for t in tables:
        if t is not None and (path := t.__dict__.get("_cut_at")):
            p = t.sparkSession._jvm.org.apache.hadoop.fs.Path(path)
            p.getFileSystem(t.sparkSession._jsc.hadoopConfiguration()).delete(p, True)
