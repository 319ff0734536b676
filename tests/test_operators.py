import pytest
from pyspark.sql import functions as F

from kindred import functions as K
from kindred import sources
from kindred.operators import features, labels, populations, selection


def test_periods_are_checked():
    for a, b in (("2024-01-02", "2024-02-01"), ("2024-03-01", "2024-02-01"), ("2023-12-01", "2024-01-31")):
        with pytest.raises(ValueError):
            K.period(a, b)


def test_period_reaches_the_partitions(spark, tmp_path):
    d = spark.range(10).select("id", F.lit("2024").alias("year"), F.lit("03").alias("month"), F.format_string("%02d", F.col("id") + 1).alias("day"))
    d.write.partitionBy("year", "month", "day").parquet(str(tmp_path / "t"))
    spark.conf.set("spark.sql.sources.partitionColumnTypeInference.enabled", "false")
    try:
        t = spark.read.parquet(str(tmp_path / "t")).where(K.period("2024-01-01", "2024-03-05"))
        plan = t._jdf.queryExecution().executedPlan().toString()
        assert "PartitionFilters: [isnotnull(year" in plan and t.count() == 5
    finally:
        spark.conf.unset("spark.sql.sources.partitionColumnTypeInference.enabled")


def test_latest_segments_edges(spark):
    rows = [("a", "2", "x", "2024", "01", "02"), ("a", "2", "y", "2024", "01", "02"), ("a", "2", None, "2024", "01", "02"), ("b", "1", "x", "2024", "01", "01"), ("\t", "2", "x", "2024", "01", "01"), (None, "2", "x", "2024", "01", "01"), ("c", "2", None, "2024", "01", "01"), ("d", "2", "x", "2024", "12", "31")]
    s = spark.createDataFrame(rows, "ad_id string, id_type string, segments string, year string, month string, day string")
    assert {tuple(r) for r in populations.latest_segments(s).collect()} == {("a", "y"), ("c", None)}


def test_gender_of_null_and_unknown(spark):
    s = spark.createDataFrame([("a", None), ("b", ""), ("c", "26455;26458;26455;9")], "device_ifa string, segments string")
    ids = {g: ["1"] for g in features.GROUPS} | {"gender": list(features.GENDER_WEIGHTS)}
    assert {r[0]: r[1] for r in features.segment_features(s, ids).collect()} == {"a": None, "b": 0.0, "c": 0.25}


def test_hash_sample_share(spark):
    ids = spark.range(20_000).select(F.md5(F.col("id").cast("string").cast("binary")).alias("i"))
    assert 800 < ids.where(K.hash_sample(F.col("i"), 5)).count() < 1200
    with pytest.raises(ValueError):
        K.hash_sample(F.col("i"), 0)


def test_anti_and_semi_are_the_whole(spark):
    rows, seeds = spark.range(100).select(F.col("id").cast("string").alias("device_ifa")), spark.range(30, 60).select(F.col("id").cast("string").alias("s"))
    assert populations.without(rows, seeds).count() + rows.join(seeds, rows.device_ifa == seeds.s, "left_semi").count() == 100


def test_ambiguous_and_empty_seeds(spark):
    latest = spark.createDataFrame([("a", "1")], "device_ifa string, segments string")
    crosswalk = spark.createDataFrame([("b", "a", None)], "ad_id string, platform_ad_id string, uuid string")
    log = spark.createDataFrame([("c",)], "device_ifa string")
    for seeds, mode in (([("a",)], "ambiguous"), ([("z",)], "ambiguous"), ([("b",)], "direct"), ([], "ambiguous")):
        s = spark.createDataFrame(seeds, "seed_id string")
        assert populations.id_space_decision(populations.id_space(s, latest, crosswalk, log)).first()[0] == mode


def test_several_lists_in_one_pass(spark):
    """Each list as it is by itself; one without rows has none, as has an ID that no space knows in its counts."""
    latest = spark.createDataFrame([("a", "1"), ("e", "2")], "device_ifa string, segments string")
    crosswalk = spark.createDataFrame([("b", "a", None), ("b", "c", "u"), ("f", "c", "v")], "ad_id string, platform_ad_id string, uuid string")
    log = spark.createDataFrame([("c",), ("c",), ("e",)], "device_ifa string")
    lists = {"x": ["a", "b", "zz"], "y": ["c"], "z": ["e", "a", "u", "v"]}
    both = spark.createDataFrame([(k, i) for k, v in lists.items() for i in v], "label string, seed_id string")
    got = {r.label: r.asDict() for r in populations.id_spaces(both, latest, crosswalk, log).collect()}
    modes = {r.label: r.mode for r in populations.id_space_decision(populations.id_spaces(both, latest, crosswalk, log)).collect()}
    for k, v in lists.items():
        one = populations.id_space(spark.createDataFrame([(i,) for i in v], "seed_id string"), latest, crosswalk, log)
        assert got[k] == {"label": k} | one.first().asDict() and modes[k] == populations.id_space_decision(one).first().mode
    assert set(got) == set(lists)


def test_share_search_starts_at_its_least(spark):
    """No share below 0.01 % is taken, however small the target."""
    s = spark.range(200_000).select(F.col("id").cast("string").alias("device_ifa"), (-F.col("id")).cast("double").alias("score_a"))
    ranks = s.withColumn("r_a", (1 - F.col("score_a")).cast("bigint"))
    found = selection.percent_for_union(ranks, ["a"], 2).first()
    assert (found.pct, found.n_union) == (0.01, 20)
    assert selection.percent_for_union(ranks, ["a"], 2, least=0.001).first().n_union == 2


def test_selection_edges(spark):
    s = spark.createDataFrame([(str(i), float(i % 3), float(-i)) for i in range(50)], "device_ifa string, score_a double, score_b double")
    r = selection.ranked(s, ["a", "b"])
    assert sorted(x.r_a for x in r.collect()) == list(range(1, 51))
    assert selection.top_masks(r, ["a", "b"], 0.1).agg(F.sum("in_a")).first()[0] == 0
    sizes = [selection.percent_for_union(r, ["a", "b"], n, at_least=True).first() for n in (5, 20, 50, 60)]
    assert [x.n_union >= n for x, n in zip(sizes, (5, 20, 50))] == [True] * 3 and sizes[-1].pct == 100


def test_auc_of_one_class_and_ties(spark):
    one = spark.createDataFrame([(0.5, 1)], "s double, y int")
    assert labels.auc(one, "s", "y").first().auc is None
    tied = spark.createDataFrame([(0.5, 1), (0.5, 0)], "s double, y int")
    assert labels.auc(tied, "s", "y").first().auc == 0.5


def test_split_sizes(spark):
    rows = spark.range(105).select(F.col("id").cast("string").alias("device_ifa"), (F.col("id") % 2).alias("code"))
    out = labels.stratified_split(rows, "code", 0.1)
    assert {(r.code, r["count"]) for r in out.where("split = 'val'").groupBy("code").count().collect()} == {(0, 5), (1, 5)}
    assert labels.subsample(rows, 10).count() == 10 and labels.subsample(rows, 0).count() == 105


def test_seed_list_header(spark, tmp_path):
    u = "0a0b0c0d-0000-1111-2222-333344445555"
    for i, text in enumerate((f"﻿adid,x\n{u},1\n", f"{u},1\n", f'"{u}",1\n')):
        p = tmp_path / f"{i}.csv"
        p.write_text(text, encoding="utf-8")
        assert [r[0] for r in sources.seed_list(spark, str(p)).collect()] == [u]


def test_guarded_writes(spark, tmp_path):
    with pytest.raises(ValueError):
        sources.write_rows(spark.range(1), "/elsewhere/x", str(tmp_path))
    with pytest.raises(ValueError):
        sources.seed_table(spark, "a=b")


def test_no_task_holds_a_whole_table(spark):
    """Windows are over parts or over a row a part; percentiles are found from counts."""
    rows = spark.range(1000).select(F.col("id").cast("string").alias("device_ifa"), F.rand(1).alias("score_a"), F.rand(2).alias("score_b"), (F.col("id") % 9 == 0).cast("int").alias("y"))
    ranks = selection.ranked(rows, ["a", "b"])
    made = (labels.auc(rows, "score_a", "y"), labels.spearman(rows, "score_a", "score_b"), labels.lift(rows, "score_a", "y", 10), selection.top_share(rows, "score_a", 10), ranks, selection.percent_for_union(ranks, ["a", "b"], 150))
    for df in made:
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        assert "percentile" not in plan
        for line in plan.splitlines():
            if "Window [" in line:
                assert "_part#" in line.split("windowspecdefinition(", 1)[1] or "i#" in line
    assert made[3].count() == 100
    sizes = {r.pct: r.n_union for r in [selection.percent_for_union(ranks, ["a", "b"], 150).first()]}
    assert abs(list(sizes.values())[0] - 150) <= 2


def test_percentile_is_the_exact_one(spark):
    from kindred.operators.ranking import percentile, running

    for n, seed in ((1, 1), (2, 2), (37, 3), (400, 4)):
        rows = spark.range(n).select(F.round(F.rand(seed) * 20).alias("x")).union(spark.createDataFrame([(None,)], "x double"))
        for share in (0.0, 0.33, 0.5, 0.9, 1.0):
            assert percentile(rows, "x", share).first().value == pytest.approx(rows.agg(F.percentile("x", share)).first()[0])
    assert percentile(spark.createDataFrame([], "x double"), "x", 0.5).first().value is None
    sums = running(spark.range(100).withColumn("w", F.col("id") % 5), [F.desc("id")], "w", "run")
    assert [r.run for r in sums.orderBy(F.desc("id")).limit(4).collect()] == [4, 7, 9, 10]


def test_period_key():
    assert K.period_key([("2024-03-01", "2024-03-31"), ("2024-01-01", "2024-01-31")]) == "2024-01-01_2024-01-31+2024-03-01_2024-03-31"


def test_seed_lists_by_pattern(spark, tmp_path):
    for i, text in enumerate(("id\na\nb\n", "id\nc\n")):
        (tmp_path / f"{i}.csv").write_text(text)
    assert sorted(r[0] for r in sources.seed_list(spark, f"{tmp_path}/*.csv").collect()) == ["a", "b", "c"]


def test_token_vectors(spark):
    rows = spark.createDataFrame([(0,), (1,), (2,), (9,), (None,)], "idx int")
    assert [r.v for r in features.token_vectors(rows, "idx", [[5.0, 5.0], [1.0, 2.0], [3.0, 4.0]]).collect()] == [[0.0, 0.0], [1.0, 2.0], [3.0, 4.0], [0.0, 0.0], [0.0, 0.0]]


def test_appended_stream(spark, tmp_path):
    from kindred.streaming import append_stream

    schema = "device_ifa string, v int"
    for i, rows in enumerate(([("a", 1), ("b", 2), ("a", 1)], [("b", 3), ("c", 4)])):
        spark.createDataFrame(rows, schema).write.mode("append").json(str(tmp_path / "in"))
        append_stream(spark, spark.readStream.schema(schema).json(str(tmp_path / "in")), str(tmp_path / "out"), str(tmp_path / "at")).awaitTermination()
        assert sorted(r.device_ifa for r in spark.read.parquet(str(tmp_path / "out")).collect()) == ["a", "b", "c"][: 2 + i]
