"""Partitions, files and marks; publishing; the latest snapshots carried on; appends; places of values that many rows share."""

import shutil

import numpy as np
import pytest
from pyspark.sql import functions as F

from kindred import sources
from kindred.operators import labels, populations, ranking
from kindred.plans import runs
from kindred.plans.latest import update_latest
from kindred.sources import files


def days(spark, first, last, shift=0):
    """Snapshots of 40 devices over some days; not every device has one each day."""
    rows = spark.range(first, last + 1).withColumnRenamed("id", "d").crossJoin(spark.range(40)).where((F.col("id") + F.col("d")) % 3 != 0)
    return rows.select(F.concat(F.lit("u"), "id").alias("ad_id"), F.lit("2").alias("id_type"), F.concat(F.lit("s"), F.col("d") + shift).alias("segments"), F.lit("2024").alias("year"), F.lit("01").alias("month"), F.lpad(F.col("d").cast("string"), 2, "0").alias("day"))


def saved(df, at, mode="append"):
    df.write.mode(mode).partitionBy("year", "month", "day").parquet(str(at))


def broken(folder):
    """Files there can no longer be read; the folder does not change."""
    for p in folder.rglob("*.parquet"):
        p.write_bytes(b"x")


def test_partitions_come_from_folders(spark, tmp_path):
    saved(days(spark, 1, 30).repartition(7), tmp_path / "t")
    found = files.partitions(spark, str(tmp_path / "t"))
    broken(tmp_path / "t")  # no row is read
    out = files.latest_partition(found)
    assert out.first().asDict() == {"latest": "2024-01-30", "n_partitions": 30}
    assert "FileScan" not in out._jdf.queryExecution().executedPlan().toString()
    (tmp_path / "n" / "year=2024" / "month=__HIVE_DEFAULT_PARTITION__" / "day=a%3Ab").mkdir(parents=True)
    assert [r[:3] for r in files.partitions(spark, str(tmp_path / "n")).collect()] == [("2024", None, "a:b")]
    with pytest.raises(FileNotFoundError):
        files.partitions(spark, str(tmp_path / "none"))
    (tmp_path / "empty").mkdir()
    assert files.latest_partition(files.partitions(spark, str(tmp_path / "empty"))).first().asDict() == {"latest": None, "n_partitions": 0}


def test_partitions_of_a_table(spark):
    spark.sql("drop table if exists kindred_days")
    days(spark, 1, 12).write.partitionBy("year", "month", "day").saveAsTable("kindred_days")
    try:
        assert files.latest_partition(files.table_partitions(spark, "kindred_days")).first().asDict() == {"latest": "2024-01-12", "n_partitions": 12}
    finally:
        spark.sql("drop table kindred_days")


def test_marks(spark, tmp_path):
    a = spark.range(100).select("id", (F.col("id") * 2).alias("v"), F.array("id").alias("l"))
    assert files.mark_of(a) == files.mark_of(a.orderBy(F.desc("id")).repartition(5).select("l", "v", "id"))
    assert len({files.mark_of(x) for x in (a, a.where("id > 0"), a.union(a), a.withColumn("v", F.col("v") + (F.col("id") == 7).cast("int")), a.limit(0))}) == 5
    assert sources.write_rows(a, str(tmp_path / "r" / "t"), str(tmp_path / "r")) == files.mark_of(a)
    assert sources.write_rows(a.where("id < 0"), str(tmp_path / "r" / "e"), str(tmp_path / "r")) == "0:0"
    (tmp_path / "x.csv").write_text("a\n")
    one = files.files_mark(files.facts(spark, [str(tmp_path / "x.csv")], hashed=True))
    shutil.copy(tmp_path / "x.csv", tmp_path / "y.csv")
    assert one == files.files_mark(files.facts(spark, [str(tmp_path / "y.csv")], hashed=True))
    (tmp_path / "x.csv").write_text("b\n")
    assert one != files.files_mark(files.facts(spark, [str(tmp_path / "x.csv")], hashed=True))
    r = files.facts(spark, [str(tmp_path / "y.csv")]).first()
    assert r.length == 2 and r.modified and r.sha256 is None


def test_a_failed_publication_leaves_no_table(spark, monkeypatch):
    spark.sql("drop table if exists kindred_new")
    count = type(spark.range(1)).count
    monkeypatch.setattr(type(spark.range(1)), "count", lambda self: count(self) + 1)
    with pytest.raises(RuntimeError):
        sources.publish(spark.range(5), "kindred_new")
    monkeypatch.undo()
    assert not [t.name for t in spark.catalog.listTables() if t.name.startswith("kindred_new")]
    assert sources.publish(spark.range(5), "kindred_new") == 5 and [t.name for t in spark.catalog.listTables() if t.name.startswith("kindred_new")] == ["kindred_new"]
    spark.sql("drop table kindred_new")


def rows_of(df):
    return sorted(map(tuple, df.select("device_ifa", "segments").collect()))


def test_latest_is_carried_on(spark, tmp_path):
    """New partitions alone are read, also one of an earlier day; a changed or removed one means a new build."""
    at, root = tmp_path / "t", str(tmp_path / "held")
    saved(days(spark, 1, 5), at)
    saved(days(spark, 9, 9), at)
    full = lambda: rows_of(populations.latest_segments(sources.partitioned(spark, str(at))))
    assert rows_of(update_latest(spark, str(at), root)) == full()
    saved(days(spark, 7, 7, 100), at)
    saved(days(spark, 12, 13), at)
    want = full()
    for d in ("01", "05", "09"):
        broken(at / "year=2024" / "month=01" / f"day={d}")
    assert rows_of(update_latest(spark, str(at), root)) == want
    assert runs.held_at(spark, f"{root}/current")["read"] == ["2024-01-07", "2024-01-12", "2024-01-13"]
    broken(at)
    assert rows_of(update_latest(spark, str(at), root)) == want  # nothing new: nothing is read
    saved(days(spark, 1, 6), at, "overwrite")
    assert rows_of(update_latest(spark, str(at), root)) == full() and len(runs.held_at(spark, f"{root}/current")["read"]) == 6


def test_appends_read_the_buckets_they_touch(spark, tmp_path):
    from kindred.streaming import append_stream

    schema, out = "device_ifa string, v int", tmp_path / "out"

    def run(rows, n):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").json(str(tmp_path / "in"))
        append_stream(spark, spark.readStream.schema(schema).json(str(tmp_path / "in")), str(out), str(tmp_path / "at"), 8).awaitTermination()
        return n

    run([(f"d{i}", i) for i in range(50)] + [("d1", 99)], 0)
    assert spark.read.parquet(str(out)).count() == 50
    # a batch that is run again, as after a failure before its commit, leaves the same rows
    for p in (tmp_path / "at" / "commits").iterdir():
        p.unlink()
    run([("d3", 5), ("e1", 1)], 1)
    held = spark.read.parquet(str(out))
    assert held.count() == held.select("device_ifa").distinct().count() == 51
    bucket = spark.createDataFrame([("e1",)], "s string").select(F.pmod(F.xxhash64("s"), F.lit(8))).first()[0]
    for p in out.glob("bucket=*"):
        if p.name != f"bucket={bucket}":
            broken(p)
    run([("e1", 2)], 2)
    assert spark.read.parquet(f"{out}/bucket={bucket}").where("device_ifa = 'e1'").count() == 1


def test_a_value_that_most_rows_share_is_spread(spark):
    """Nine of ten rows have one score; no run of the order holds much more than its share, and places are the plain ones."""
    r = np.random.default_rng(3)
    a, b = np.where(r.random(4000) < 0.9, 1.0, np.round(r.random(4000), 2)), r.normal(size=4000)
    df = spark.createDataFrame([(float(x), float(y)) for x, y in zip(a, b)] + [(None, 1.0)], "a double, b double").repartition(6)
    pairs = df.where("a is not null").groupBy("a", "b").agg(F.count("*").alias("w"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # few rows would be one partition
    t = ranking._dealt(pairs, [F.col("a"), F.col("b")])
    sizes = [r[0] for r in t.groupBy("_part").count().select("count").collect()]
    assert len(sizes) > 2 and max(sizes) < 2 * 4000 / len(sizes)

    def places(x):
        order = np.sort(x)
        return (np.searchsorted(order, x, "left") + np.searchsorted(order, x, "right") + 1) / 2

    got = {(r.a, r.b): r.p for r in ranking.tied_places(pairs, "a", "b", "w", "p").collect()}
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert all(got[x, y] == p for x, y, p in zip(a.tolist(), b.tolist(), places(a)))
    want = float(np.corrcoef(places(a), places(b))[0, 1])
    assert labels.spearman(df, "a", "b").first().spearman == pytest.approx(want, abs=2e-6)
    assert labels.spearman(df.where("a is null"), "a", "b").first().spearman is None
    assert labels.spearman(df.where("a = 1"), "a", "b").first().spearman is None
