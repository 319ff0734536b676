"""Who is in: seeds, pools and candidates from event logs, segment snapshots and ID crosswalks."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kindred import functions as K


def _newest(rows: DataFrame) -> DataFrame:
    w = Window.partitionBy("device_ifa").orderBy(F.desc("seen"), F.desc_nulls_last("segments"))
    return rows.withColumn("rn", F.row_number().over(w)).where("rn = 1").drop("rn")


def latest_snapshots(snapshots: DataFrame) -> DataFrame:
    """(device_ifa, segments, seen): the latest snapshot of each ID of type 2 and its day; ties on a day go to the greater
    text.

    Filters stand below the window, where they reach the scan; rank 1 becomes a limit within groups before the shuffle."""
    rows = snapshots.where(~((F.col("year") == "2024") & (F.col("month") == "12") & (F.col("day") == "31")) & (F.col("id_type").cast("string") == "2") & K.not_blank(F.col("ad_id")))
    return _newest(rows.select(F.col("ad_id").alias("device_ifa"), "segments", F.concat_ws("-", "year", "month", "day").alias("seen")))


def latest_segments(snapshots: DataFrame) -> DataFrame:
    """(device_ifa, segments) of ``latest_snapshots``."""
    return latest_snapshots(snapshots).drop("seen")


def merge_latest(held: DataFrame, new: DataFrame) -> DataFrame:
    """Both ``latest_snapshots``' rows, of disjoint days, as of one table: the later day of each device stays."""
    return _newest(held.unionByName(new))


def seed_source(seeds: DataFrame, column: str, uuid_only: bool = True) -> DataFrame:
    """Distinct seed IDs of one column: UUIDs, or anything that is not blank."""
    c = F.col(column).cast("string")
    return seeds.select(c.alias("seed_id")).where(K.is_uuid(F.col("seed_id")) if uuid_only else K.not_blank(F.col("seed_id"))).distinct()


def compliant(log: DataFrame, when: Column, region: str | None = "KR", android: bool = True, sample: Column | None = None) -> DataFrame:
    """Rows of an event log that may be used."""
    keep = when & K.not_blank(F.col("device_ifa")) & K.is_uuid(F.col("device_ifa")) & K.allowed(F.col("req_ext_allow_user_data_collection"), F.col("device_lmt"))
    if region:
        keep &= K.in_region(F.col("device_geo_region"), region)
    if android:
        keep &= K.is_android(F.col("device_osv"))
    return log.where(keep if sample is None else keep & sample)


def population(log: DataFrame, latest: DataFrame) -> DataFrame:
    """Distinct devices of the log that have a snapshot, with its segments: the log is reduced before the one join."""
    return log.select("device_ifa").distinct().join(latest, "device_ifa")


def crosswalked(seeds: DataFrame, crosswalk: DataFrame, column: str) -> DataFrame:
    """Device IDs of seeds through one column of the crosswalk, which fans out."""
    pairs = crosswalk.select(F.col(column).alias("seed_id"), F.col("ad_id").alias("device_ifa")).where("device_ifa is not null").distinct()
    return seeds.join(pairs, "seed_id").select("device_ifa").distinct()


def without(rows: DataFrame, *seeds: DataFrame) -> DataFrame:
    return rows.join(union_ids(*seeds), "device_ifa", "left_anti")


def union_ids(*seeds: DataFrame) -> DataFrame:
    return reduce(DataFrame.union, [s.select(F.col(s.columns[0]).alias("device_ifa")) for s in seeds]).distinct()


def keep_first(frames: list[DataFrame], order: str) -> DataFrame:
    """Rows of several frames, one a device: an earlier frame wins, then the smaller ``order``."""
    tagged = reduce(DataFrame.unionByName, [f.withColumn("_frame", F.lit(i)) for i, f in enumerate(frames)])
    w = Window.partitionBy("device_ifa").orderBy("_frame", order)
    return tagged.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn", "_frame")


def append_new(held: DataFrame, rows: DataFrame) -> DataFrame:
    """What an append must write: rows of unknown devices, one each."""
    return rows.join(held.select("device_ifa"), "device_ifa", "left_anti").dropDuplicates(["device_ifa"])


def merge_embeddings(frames: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.join(b, "device_ifa"), frames)


ID_SPACES = ("snapshot_direct", "crosswalk_ad_id", "crosswalk_uuid", "crosswalk_platform_ad_id", "log_direct")


def _spaces(latest: DataFrame, crosswalk: DataFrame, log: DataFrame) -> DataFrame:
    """(space, seed_id) of all ID spaces; the crosswalk is scanned once for its three columns."""
    stacked = crosswalk.select(F.expr("stack(3, 'crosswalk_ad_id', ad_id, 'crosswalk_uuid', uuid, 'crosswalk_platform_ad_id', platform_ad_id) as (space, seed_id)"))
    return stacked.union(latest.select(F.lit("snapshot_direct"), "device_ifa")).union(log.select(F.lit("log_direct"), "device_ifa")).where("seed_id is not null")


def _near(seeds: DataFrame, latest: DataFrame, crosswalk: DataFrame, log: DataFrame) -> DataFrame:
    """Distinct (space, seed_id) of the seeds. Tasks hash their seeds, each once, and let the spaces pass by, which are far
    larger and are not sorted."""
    return _spaces(latest, crosswalk, log).join(seeds.select("seed_id").distinct().hint("shuffle_hash"), "seed_id", "left_semi").distinct()


def _sizes() -> list[Column]:
    return [F.count("*").alias("n_seed"), F.count_if(K.is_uuid(F.col("seed_id"))).alias("n_uuid"), F.min(F.length("seed_id")).alias("min_len"), F.max(F.length("seed_id")).alias("max_len")]


def id_space(seeds: DataFrame, latest: DataFrame, crosswalk: DataFrame, log: DataFrame) -> DataFrame:
    """One row: seed counts and, by ID space, how many seeds are in it. All spaces meet the seeds in one semi join, before
    what is left is made distinct."""
    hits = _near(seeds, latest, crosswalk, log).agg(*[F.count_if(F.col("space") == s).alias(f"n_{s}") for s in ID_SPACES])
    return seeds.agg(*_sizes()).join(hits)  # a row each


def id_spaces(seeds: DataFrame, latest: DataFrame, crosswalk: DataFrame, log: DataFrame) -> DataFrame:
    """``id_space`` of several lists (label, seed_id), a row a label, in one pass over log and crosswalk: the spaces are
    reduced to the IDs of any list, which then meet the lists. A list without rows has no row."""
    hits = seeds.join(_near(seeds, latest, crosswalk, log), "seed_id", "left").groupBy("label").agg(*[F.count_if(F.col("space") == s).alias(f"n_{s}") for s in ID_SPACES])
    return seeds.groupBy("label").agg(*_sizes()).join(hits, "label")


def id_space_decision(counts: DataFrame, least: float = 0.1) -> DataFrame:
    """direct, crosswalk or ambiguous, with both rates and the better crosswalk column (of equal ones the first); by label,
    if ``counts`` has one."""
    rate = lambda c: F.coalesce(F.try_divide(F.col(c), F.col("n_seed")), F.lit(0.0))
    direct, cross = F.greatest(rate("n_snapshot_direct"), rate("n_crosswalk_ad_id")), F.greatest(rate("n_crosswalk_platform_ad_id"), rate("n_crosswalk_uuid"))
    return counts.select(
        *[c for c in ("label",) if c in counts.columns],
        F.when((direct >= least) & (cross < least), "direct").when((direct < least) & (cross >= least), "crosswalk").otherwise("ambiguous").alias("mode"),
        F.when(rate("n_crosswalk_platform_ad_id") >= rate("n_crosswalk_uuid"), "platform_ad_id").otherwise("uuid").alias("crosswalk_col"),
        F.round(direct, 6).alias("direct_rate"),
        F.round(cross, 6).alias("crosswalk_rate"),
    )
