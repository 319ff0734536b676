"""The latest snapshot of every device as a table of its own, carried on by the partitions that are new.

A full build reads the whole history of snapshots. Here each version of the table notes the partitions that it has seen;
the next one reads those that came since, and joins them to the table that is held, a row a device.
"""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kindred import sources
from kindred.operators import populations
from kindred.plans import runs
from kindred.sources.files import KEYS, partitions


def seen_partitions(spark: SparkSession, path: str) -> dict[str, tuple[int, str]]:
    """Day, time of change and folder of each partition, from the listing; partitions without a day hold no snapshot."""
    rows = partitions(spark, path).where(" and ".join(f"{k} is not null" for k in KEYS)).select(F.concat_ws("-", *[F.lpad(k, 4 if k == "year" else 2, "0") for k in KEYS]).alias("day"), "modified", "path").collect()
    return {r.day: (r.modified, r.path) for r in rows}


def update_latest(spark: SparkSession, path: str, root: str) -> DataFrame:
    """(device_ifa, segments, seen) of all snapshots at ``path``, kept below ``root``.

    Only new partitions are read. If one that the table has seen was changed or is gone, the table is built anew, as what
    it gave cannot be taken back. A version counts once its note is written; the one before stays for those who read it."""
    listed, note = seen_partitions(spark, path), runs.held_at(spark, f"{root}/current")
    found, known = {day: at for day, (at, _) in listed.items()}, note["partitions"] if note else {}
    carried = bool(note) and all(found.get(day) == at for day, at in known.items())
    new = sorted(set(found) - set(known)) if carried else sorted(found)
    if carried and not new:
        return spark.read.parquet(f"{root}/{note['at']}")
    fresh = populations.latest_snapshots(sources.partitioned(spark, path, [listed[day][1] for day in new] or None))
    out = populations.merge_latest(spark.read.parquet(f"{root}/{note['at']}"), fresh) if carried else fresh
    at = f"v{uuid4().hex[:12]}"
    mark = sources.write_rows(out, f"{root}/{at}", root)
    runs.keep(spark, f"{root}/current", {"at": at, "before": note and note["at"], "partitions": found, "mark": mark, "read": new}, force=True)
    if note and note["before"]:
        runs.delete(spark, f"{root}/{note['before']}")
    return spark.read.parquet(f"{root}/{at}")
