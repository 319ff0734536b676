"""Distribution reports over segments."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def segment_distribution(latest: DataFrame, taxonomy: DataFrame) -> DataFrame:
    """(feature_group, segment_id, device_cnt, pct_of_total_devices) by exploding once; ``latest`` has a row a device, and
    the taxonomy is a small table."""
    total = latest.agg(F.count("device_ifa").alias("total"))
    items = latest.select("device_ifa", F.explode(F.array_distinct(F.split("segments", ";"))).alias("segment_id"))
    counts = items.groupBy("segment_id").agg(F.count("device_ifa").alias("device_cnt")).join(taxonomy.select("segment_id", "feature_group"), "segment_id")
    return counts.join(F.broadcast(total)).select("feature_group", "segment_id", "device_cnt", F.round(F.col("device_cnt") / F.col("total") * 100, 6).alias("pct_of_total_devices"))


def group_stats(distribution: DataFrame) -> DataFrame:
    """Spread and concentration of device counts by group."""
    c = F.col("device_cnt")
    g = distribution.groupBy("feature_group").agg(
        F.count("*").alias("id_count"), F.sum(c).alias("sum_device_cnt"), F.avg(c).alias("mean"), F.median(c).alias("median"), F.coalesce(F.stddev_samp(c), F.lit(0.0)).alias("std"),
        F.min(c).alias("min"), F.max(c).alias("max"), F.max_by("segment_id", F.struct(c, -F.col("segment_id").cast("bigint"))).alias("top_segment_id"),
    )
    cv, n = F.coalesce(F.try_divide("std", "mean"), F.lit(0.0)), F.col("id_count")
    return g.select(
        "feature_group", "id_count", "sum_device_cnt", F.round("mean", 4).alias("mean"), F.round("median", 4).alias("median"), F.round("std", 4).alias("std"), F.round(cv, 4).alias("cv"),
        F.round(F.sqrt(n), 4).alias("cv_ceiling"), F.round(cv / F.sqrt(n), 4).alias("cv_normalized"), "min", "max", F.round(F.col("max") / F.col("sum_device_cnt"), 6).alias("top1_share"),
        F.round(1 / n, 6).alias("fair_share"), F.round(F.col("max") / F.col("sum_device_cnt") * n, 4).alias("concentration"), "top_segment_id",
    )


def lorenz(distribution: DataFrame) -> DataFrame:
    """Cumulative share of devices by rank in each group."""
    w = Window.partitionBy("feature_group").orderBy(F.desc("device_cnt"), "segment_id")
    whole = Window.partitionBy("feature_group")
    upto = w.rowsBetween(Window.unboundedPreceding, 0)
    return distribution.select("feature_group", "segment_id", F.round(F.row_number().over(w) / F.count("*").over(whole), 6).alias("rank_share"), F.round(F.sum("device_cnt").over(upto) / F.sum("device_cnt").over(whole), 6).alias("cum_share"))
