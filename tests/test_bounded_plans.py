from kindred.operators import populations
from kindred.plans.scenarios import Inputs


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_id_spaces_are_not_sorted_to_meet_seeds(spark):
    frame = spark.createDataFrame
    latest, log = frame([("a", "1"), ("a2", "1")], "device_ifa string, segments string"), frame([("c",), ("a",)], "device_ifa string")
    crosswalk = frame([("b", "a", None), ("b", "p", "u")], "ad_id string, platform_ad_id string, uuid string")
    seeds = frame([("k", "a"), ("k", "b"), ("m", "a"), ("m", "z")], "label string, seed_id string")
    was = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        both, one = populations.id_spaces(seeds, latest, crosswalk, log), populations.id_space(seeds.where("label = 'k'").drop("label"), latest, crosswalk, log)
        for df in (both, one):
            semi = [line for line in _plan(df).splitlines() if "LeftSemi" in line]
            assert semi and all("ShuffledHashJoin" in line for line in semi)
        got = {r.label: r.asDict() for r in both.collect()}
        assert {c: got["k"][c] for c in one.columns} == one.first().asDict()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", was)
    assert [[got[k][f"n_{s}"] for s in populations.ID_SPACES] for k in "km"] == [[1, 1, 0, 1, 1], [1, 0, 0, 1, 1]]


def test_latest_snapshots_are_built_once_a_run(spark):
    rows = [("a", "2", "1;2", "2024", "01", "02"), ("a", "2", "3", "2024", "01", "01"), ("b", "2", None, "2024", "01", "01"), ("c", "1", "4", "2024", "01", "01")]
    snapshots = spark.createDataFrame(rows, "ad_id string, id_type string, segments string, year string, month string, day string")
    inputs = Inputs(snapshots, snapshots, snapshots, snapshots, None)
    assert sorted(map(tuple, inputs.latest.collect())) == [("a", "1;2"), ("b", None)]
    assert "Window" not in _plan(inputs.latest)
