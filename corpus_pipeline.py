"""A training corpus from raw documents: quality, exact and near duplicates, mix, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and read again as the next
one's docs. All but the last return the columns of documents. Stages handle nulls, empty texts, repeated rows and empty
tables as their operators say.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from kindred.llm import exact_dedup, mixing, near_dup, packing, quality
from kindred.llm.common import documents
from kindred.sources.tables import cut, drop

#: Bytes of texts that a task hands its Python worker at once. Each is held several times on the way (in Spark, in Arrow, in the
#: worker and in what it answers), in a session that runs all stages in the same executors.
ARROW_BYTES = 4 << 20


def small_batches(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", ARROW_BYTES)


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier scores below 0.5 go."""
    small_batches(spark)
    return quality.keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def exact_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the smallest doc_id stays."""
    small_batches(spark)
    return exact_dedup.keep_first(docs)


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents that five-word shingles link at 0.8 or more, the smallest doc_id stays. (The query op10 takes four words,
    as its contract says.)"""
    small_batches(spark)
    return near_dup.keep_one(docs)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as its source's target takes it; a document taken twice is two rows."""
    return mixing.take_mix(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of 1024 tokens."""
    small_batches(spark)
    return packing.pack_documents(docs)


STAGES = [("quality", quality_stage), ("exact", exact_stage), ("near", near_stage), ("mixing", mixing_stage), ("packing", packing_stage)]

#: SQL cannot express the classifier; tests/llm hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        kept = cut(stage(spark, docs, sf_dir), name)
        drop(docs)
        docs = kept
    return STAGES[-1][1](spark, docs, sf_dir)
