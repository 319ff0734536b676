"""Helpers that the document operators share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kindred.sources.tables import cut

#: ASCII white space as the operators read it: the space and tab to carriage return.
SPACE = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def text_of(name: str) -> Column:
    """The text; null counts as empty."""
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def with_rows(docs: DataFrame) -> DataFrame:
    """(r, row): each input row as a struct with its place in the scan, written once. A second scan of the input may be
    split otherwise, when executors come or go, and would number the rows anew."""
    return cut(docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("r"), F.monotonically_increasing_id().alias("row")), "rows")


def without_rows(tagged: DataFrame, drops: DataFrame, broadcast_rows: int = 1_000_000) -> DataFrame:
    """The rows of ``with_rows``' table that are not in ``drops`` (row). The drops are broadcast only if they were
    counted to be few; beyond that the join shuffles."""
    drops = cut(drops, "drops")
    few = drops.count() <= broadcast_rows
    return tagged.join(F.broadcast(drops) if few else drops.hint("merge"), "row", "left_anti").select("r.*")
