"""Incremental runs of the batch operators."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kindred.operators.populations import append_new

BUCKETS = 64


def append_stream(spark: SparkSession, rows: DataFrame, path: str, checkpoint: str, buckets: int = BUCKETS):
    """Append a stream's rows of devices that the table at ``path`` does not hold yet, micro-batch by micro-batch.

    The table is partitioned by ``bucket`` (of the device's hash) and ``batch``: a micro-batch reads the IDs of the buckets
    that its own devices fall into, and writes partitions that bear its name. One that runs again after a failure, whatever it had
    written, leaves its own partitions out of what is held, and replaces them. ``buckets`` must stay the same for a table."""

    def step(batch: DataFrame, number: int) -> None:
        # the stream's own name, so that another stream's batches are not taken for this one's
        name = f"{json.loads(spark.read.text(f'{checkpoint}/metadata').first()[0])['id']}-{number}"
        own = batch.withColumn("bucket", F.pmod(F.xxhash64("device_ifa"), F.lit(buckets)).cast("int")).persist()
        try:
            touched = [r.bucket for r in own.select("bucket").distinct().collect()]  # as many as there are buckets at most
            try:
                held = spark.read.schema("device_ifa string, bucket int, batch string").parquet(path).where(F.col("bucket").isin(touched) & (F.col("batch") != name))
            except Exception as e:  # noqa: BLE001  the first batch makes the table
                if "PATH_NOT_FOUND" not in str(e):
                    raise
                held = own.limit(0)
            new = append_new(held, own).withColumn("batch", F.lit(name))
            new.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("bucket", "batch").parquet(path)
        finally:
            own.unpersist()

    return rows.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
