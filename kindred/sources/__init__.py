"""Readers and writers: partitioned logs, seed lists, taxonomies, guarded and published tables."""

from __future__ import annotations

import re
import warnings
from uuid import uuid4

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from kindred.functions import UUID, path_text
from kindred.sources.files import mark_of, rows_mark, written_mark

_NAME = re.compile(r"[A-Za-z_][A-Za-z0-9_]*")


def partitioned(spark: SparkSession, path: str, only: list[str] | None = None) -> DataFrame:
    """A table partitioned by year, month and day, whose keys stay zero-padded strings; with ``only`` the partitions of
    these folders alone, so that no other file is listed or opened."""
    df = spark.read.option("basePath", path).parquet(*([path] if only is None else only))
    return df.withColumns({c: F.lpad(df[c].cast("string"), 4 if c == "year" else 2, "0") for c in ("year", "month", "day") if c in df.columns})


def seed_list(spark: SparkSession, path: str) -> DataFrame:
    """First column of a CSV (a file, a folder or a pattern) as seed_id. Of each file a first record that is no UUID is a
    header. Quotes and a byte-order mark go; further columns are left out, with a warning."""
    rows = spark.read.csv(path).select("*", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_block"))
    if len(rows.columns) > 3:
        warnings.warn(f"{path} has several columns; the first is read", stacklevel=2)
    ids = rows.select(F.regexp_replace(F.col(rows.columns[0]), "^\ufeff", "").alias("seed_id"), "_file", "_block", F.monotonically_increasing_id().alias("_at"))
    heads = ids.where("_block = 0").groupBy("_file").agg(F.min("_at").alias("_first"))  # a row a file
    return ids.join(F.broadcast(heads), "_file", "left").where((F.col("_at") != F.col("_first")) | F.col("_first").isNull() | F.col("seed_id").rlike(UUID)).select("seed_id")


def one_csv(spark: SparkSession, path: str) -> str:
    """``path`` itself if it is a file, else the one CSV file that the folder holds; none or several are refused."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    if fs.exists(p) and fs.getFileStatus(p).isFile():
        return path
    found = [str(f.getPath()) for f in fs.globStatus(spark._jvm.org.apache.hadoop.fs.Path(f"{path}/*.csv")) or []]
    if len(found) != 1:
        raise ValueError(f"{path} holds {len(found)} CSV files, not one")
    return found[0]


def seed_table(spark: SparkSession, spec: str) -> tuple[str, DataFrame]:
    """``label=database.table:column`` as its label and the table's column."""
    m = re.fullmatch(r"([A-Za-z0-9_]+)=((?:[A-Za-z_][A-Za-z0-9_]*\.)?[A-Za-z_][A-Za-z0-9_]*):([A-Za-z_][A-Za-z0-9_]*)", spec)
    if not m:
        raise ValueError(f"label=database.table:column, not {spec}")
    return m[1], spark.table(m[2]).select(F.col(m[3]).cast("string").alias("seed_id"))


def taxonomy(spark: SparkSession, path: str, id_col: str, group_col: str, depth_cols: list[str], name_col: str) -> DataFrame:
    """(segment_id, feature_group, path) of a CSV of segments."""
    t = spark.read.option("header", True).csv(path)
    return t.select(F.col(id_col).alias("segment_id"), F.col(group_col).alias("feature_group"), path_text(*[F.col(c) for c in [*depth_cols, name_col]]).alias("path"))


def write_rows(df: DataFrame, path: str, root: str) -> str:
    """Overwrite a folder, only below ``root``; returns the mark of the rows, taken as they were written."""
    if ".." in path or not path.startswith(root.rstrip("/") + "/"):
        raise ValueError(f"{path} is not below {root}")
    seen = Observation()
    df.observe(seen, *rows_mark(df.columns)).write.mode("overwrite").parquet(path)
    held = seen.get
    return written_mark(held["n"], held["mark"]) if "n" in held else mark_of(df.sparkSession.read.schema(df.schema).parquet(path))


def publish(df: DataFrame, table: str) -> int:
    """Save as a new table. Rows are written under a name of their own and verified against those that the write counted;
    only then does the table get its name. An existing one is refused, also one that came to be meanwhile, and a failure
    leaves no table."""
    if not all(_NAME.fullmatch(p) for p in table.split(".")):
        raise ValueError(f"not a table name: {table}")
    spark = df.sparkSession
    if spark.catalog.tableExists(table):
        raise ValueError(f"{table} exists")
    staged, seen = f"{table}_staged_{uuid4().hex[:12]}", Observation()
    try:
        df.observe(seen, *rows_mark(df.columns)).write.mode("errorifexists").saveAsTable(staged)
        n, want = spark.table(staged).count(), seen.get.get("n", 0)
        if n != want:
            raise RuntimeError(f"{table} has {n} rows of {want}")
        spark.sql(f"alter table {staged} rename to {table}")
        return n
    finally:
        spark.sql(f"drop table if exists {staged}")
