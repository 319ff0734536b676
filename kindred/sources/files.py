"""What storage and catalogue say about tables without a row being read: partitions, files, and marks of both."""

from __future__ import annotations

from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

KEYS = ("year", "month", "day")
#: Files of at most so many bytes are hashed whole where a hash is asked for; larger ones have their size and time alone.
HASHED_BYTES = 256 << 20
_NO_VALUE = "__HIVE_DEFAULT_PARTITION__"  # fixed value: the folder of a null key


def partitions(spark: SparkSession, path: str, keys: tuple[str, ...] = KEYS) -> DataFrame:
    """(<keys>, modified, path): a row a partition folder below ``path``, from a listing of folders; a missing path is
    refused. There are as many rows as partitions, which is why they may pass through the driver."""
    jvm, p = spark._jvm, spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(p):
        raise FileNotFoundError(path)
    found = fs.globStatus(jvm.org.apache.hadoop.fs.Path(path.rstrip("/") + "/" + "/".join(f"{k}=*" for k in keys))) or []
    rows = []
    for f in found:
        parts = f.getPath().toString().rstrip("/").split("/")[-len(keys) :]
        values = [unquote(x.split("=", 1)[1]) for x in parts]
        rows.append((*[None if v == _NO_VALUE else v for v in values], f.getModificationTime(), f.getPath().toString()))
    return spark.createDataFrame(rows, ", ".join(f"{k} string" for k in keys) + ", modified bigint, path string")


def table_partitions(spark: SparkSession, table: str, keys: tuple[str, ...] = KEYS) -> DataFrame:
    """(<keys>): a row a partition that the catalogue has of ``table``; where it keeps none, from the table's folder."""
    try:
        named = spark.sql(f"show partitions {table}").select("partition")
    except AnalysisException:
        at = {r.col_name: r.data_type for r in spark.sql(f"describe formatted {table}").collect()}
        if "Location" not in at:
            raise
        return partitions(spark, at["Location"], keys).select(*keys)
    value = lambda k: F.regexp_extract("partition", rf"(?:^|/){k}=([^/]*)", 1)
    return named.select(*[F.when(value(k) != _NO_VALUE, F.url_decode(F.replace(value(k), F.lit("+"), F.lit("%2B")))).alias(k) for k in keys])


def latest_partition(found: DataFrame) -> DataFrame:
    """One row: the latest partition and how many there are, of ``partitions``' rows (or of any with their keys)."""
    keys = found.select(*KEYS).distinct()
    return keys.agg(F.max(F.concat_ws("-", *KEYS)).alias("latest"), F.count("*").alias("n_partitions"))


def facts(spark: SparkSession, paths: list[str], hashed: bool = False) -> DataFrame:
    """(path, length, modified, sha256) of every file below ``paths``, by Spark's listing. Contents are read only with
    ``hashed``, and of files up to HASHED_BYTES; the rest have no hash."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(paths)
    about = [F.col("path"), F.col("length"), F.col("modificationTime").alias("modified")]
    if not hashed:
        return files.select(*about, F.lit(None).cast("string").alias("sha256"))
    small = files.where(F.col("length") <= HASHED_BYTES).select(*about, F.sha2("content", 256).alias("sha256"))
    return small.unionByName(files.where(F.col("length") > HASHED_BYTES).select(*about, F.lit(None).cast("string").alias("sha256")))


def rows_mark(columns: list[str]) -> list[Column]:
    """Aggregates n and mark: how many rows, and a sum of their hashes, which no order or partitioning changes."""
    own = F.xxhash64(*[F.col(f"`{c}`") for c in sorted(columns)]) if columns else F.lit(0).cast("bigint")
    return [F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(own.cast("decimal(38,0)")), F.lit(0).cast("decimal(38,0)")).alias("mark")]


def mark_of(df: DataFrame) -> str:
    """A table's rows in short: their number and ``rows_mark``'s sum. Columns are taken by name, rows in any order."""
    r = df.agg(*rows_mark(df.columns)).first()
    return written_mark(r.n, r.mark)


def written_mark(n: int, mark: object) -> str:
    return f"{n}:{int(mark)}"


def files_mark(files: DataFrame) -> str:
    """``facts`` in short. Files with a hash count by it and their size, others by path, size and time."""
    own = files.select(F.coalesce("sha256", F.concat_ws("|", "path", F.col("modified").cast("string"))).alias("is"), "length")
    return mark_of(own)
