"""A pool and seed runs from end to end on small tables."""

import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from kindred import sources
from kindred.operators import features, models
from kindred.plans import runs, scenarios
from kindred.plans.bindings import IDS, uuid
from kindred.sources.files import mark_of

N = 240


@pytest.fixture(scope="module")
def config(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("scenario")
    ids, user = [i for s in IDS.values() for i in s], F.col("user")
    rows = spark.range(3 * N).select((F.col("id") % N).alias("user"), F.format_string("%02d", (F.col("id") / N).cast("int") + 1).alias("month"))
    log = rows.select(uuid(user).alias("device_ifa"), F.lit("1").alias("req_ext_allow_user_data_collection"), F.lit(None).cast("string").alias("device_lmt"), F.lit("KR-11").alias("device_geo_region"), F.lit("14").alias("device_osv"), F.lit("2024").alias("year"), "month", F.lit("03").alias("day"))
    # seeds have other segments than the rest
    at = F.when(user < 60, user % 5).otherwise(40 + user % 50)
    t = F.array(*map(F.lit, ids))
    snapshots = rows.select(uuid(user).alias("ad_id"), F.lit("2").alias("id_type"), F.concat_ws(";", F.get(t, at.cast("int")), F.get(t, (at + 4).cast("int")), F.get(t, (at + 7).cast("int"))).alias("segments"), F.lit("2024").alias("year"), "month", F.lit("05").alias("day"))
    for name, df in (("log", log), ("snapshots", snapshots)):
        df.write.partitionBy("year", "month", "day").parquet(str(root / name))
    spark.range(N).select(uuid(F.col("id")).alias("ad_id"), F.concat(F.lit("p"), "id").alias("platform_ad_id"), F.concat(F.lit("u"), "id").alias("uuid")).write.parquet(str(root / "crosswalk"))
    (root / "taxonomy.csv").write_text("segment_id,feature_group,depth1,depth2,depth3,name\n" + "".join(f"{i},{g},{g},, ,name {k}\n" for g, s in IDS.items() for k, i in enumerate(s)))
    (root / "a").mkdir()
    (root / "a" / "a.csv").write_text("seed\n" + "".join(f"p{i}\n" for i in range(40)))
    (root / "b.csv").write_text("".join(f"p{i}\n" for i in range(30, 60)))
    held = {"_comment": 1, "root": str(root / "out"), "log": str(root / "log"), "snapshots": str(root / "snapshots"), "crosswalk": str(root / "crosswalk"), "taxonomy": str(root / "taxonomy.csv"), "pool": "p1", "pool_spec": {"periods": [["2024-01-01", "2024-01-31"]]}, "encoder": "e1", "train": {"rounds": 2, "dims": 8}, "run": "r1", "periods": [["2024-02-01", "2024-03-31"]], "seeds": {"a": str(root / "a"), "b": str(root / "b.csv")}, "id_mode": "crosswalk:platform_ad_id", "top_percent": 20.0, "fit": {"rounds": 3}}
    (root / "c.json").write_text(json.dumps(held))
    return held, root


def test_runs(spark, config, capsys):
    held, root = config
    c = str(root / "c.json")
    spark.conf.set("spark.sql.sources.partitionColumnTypeInference.enabled", "false")
    scenarios.main(["pool", c, "--dry-run"])
    assert "would make: pool, train, encode" in capsys.readouterr().out
    scenarios.main(["pool", c, "--explain"])
    assert "Scan parquet" in capsys.readouterr().out
    scenarios.main(["pool", c, "--until", "pool"])
    scenarios.main(["pool", c, "--status"])
    assert "pool made\ntrain open\nencode open" in capsys.readouterr().out
    scenarios.main(["pool", c])
    scenarios.main(["seeds", c])
    out = spark.read.parquet(f"{held['root']}/runs/r1/2024-02-01_2024-03-31/score")
    # the first header line is no seed, and seeds are not candidates
    assert out.count() == N - 60 and out.agg(F.sum("in_a")).first()[0] == round((N - 60) * 0.2)
    assert runs.registered_seeds(spark, runs.Layout(held["root"])).count() == 60
    states = {(r.name, r.status) for r in runs.lineage(spark, f"{held['root']}/runs/r1/2024-02-01_2024-03-31").collect()}
    assert states == {(s, "ok") for s in ("seed", "candidate", "encode", "train", "score", "lists", "overlap")}
    lists = {r.label: r["count"] for r in spark.read.parquet(f"{held['root']}/runs/r1/2024-02-01_2024-03-31/lists").groupBy("label").count().collect()}
    assert lists["a"] == lists["b"] == 36 and 36 <= lists["a+b"] <= 72
    pool = spark.read.parquet(f"{held['root']}/pools/p1/pool")
    done = spark.read.parquet(f"{held['root']}/pools/p1/encode").limit(200)
    assert scenarios.encode(spark, f"{held['root']}/encoders/e1", pool, done).count() == N - 200


def held_config(held, **more):
    return scenarios.DEFAULTS | {k: v for k, v in held.items() if k != "_comment"} | more


def times(spark, held):
    rows = runs.lineage(spark, f"{held['root']}/runs/r1/2024-02-01_2024-03-31").where("status = 'ok'").collect()
    return {n: sum(r.name == n for r in rows) for n in {r.name for r in rows}}


def test_changed_settings_make_what_follows(spark, config):
    """Another share: scores and lists again, what stands before them not. Nothing again without a change."""
    held, _ = config
    before = times(spark, held)
    out = scenarios.configured(spark, "seeds", held_config(held, top_percent=5.0)).run()
    assert out.count() == N - 60 and out.agg(F.sum("in_a")).first()[0] == round((N - 60) * 0.05)
    now = times(spark, held)
    assert {k for k in now if now[k] > before[k]} == {"score", "lists", "overlap"}
    scenarios.configured(spark, "seeds", held_config(held, top_percent=5.0)).run()
    assert times(spark, held) == now
    last = runs.lineage(spark, f"{held['root']}/runs/r1/2024-02-01_2024-03-31").where("size(changed) > 0 and name = 'score'").collect()
    assert [r.changed for r in last] == [["param top_percent"]]


def test_changed_seeds_make_a_run_again(spark, config):
    held, root = config
    before = (root / "b.csv").read_text()
    try:
        (root / "b.csv").write_text(before + "p60\n")
        out = scenarios.configured(spark, "seeds", held_config(held)).run("seed")
        assert out.count() == 61
    finally:
        (root / "b.csv").write_text(before)
    facts = runs.files(spark, f"{held['root']}/runs/r1/2024-02-01_2024-03-31").where("name = 'seed' and path like '%b.csv'").collect()
    assert len({r.sha256 for r in facts}) == 2 and all(r.length > 0 and r.modified for r in facts)
    assert scenarios.configured(spark, "seeds", held_config(held, seeds={"a": str(root / "a"), "b": [str(root / "b.csv")], "c": str(root / "*.csv").replace("*", "b*")})).run("seed").count() == 60


def test_imbalance_of_a_run(spark, config, capsys):
    held, root = config
    (root / "compare.json").write_text(json.dumps({k: v for k, v in held.items() if k != "fit"} | {"configs": {"w": {"mode": "posweight"}, "n": {"mode": "none"}}, "repeats": 1, "fit": {"rounds": 1}}))
    scenarios.main(["compare", str(root / "compare.json")])
    assert sorted(line.split(":")[0] for line in capsys.readouterr().out.splitlines() if "+-" in line) == ["n", "w"]
    with pytest.raises(ValueError, match="not encoded"):
        scenarios.configured(spark, "seeds", held_config(held, run="r9")).compare()


def test_probe_of_the_snapshots(spark, config):
    held, _ = config
    inputs = scenarios.configured(spark, "pool", held_config(held)).inputs
    assert scenarios.snapshot(inputs) == {"latest": "2024-03-05", "n_partitions": 3}
    inputs.paths["snapshots"] = [held["root"] + "/nowhere"]
    assert scenarios.snapshot(inputs) is None
    inputs.paths.clear()
    assert scenarios.snapshot(inputs) is None


def test_encoder_inputs_are_not_shuffled(spark, config):
    """One pass pools all groups; vectors are those of the bags pooled group by group."""
    held, _ = config
    at = scenarios.encoder_at(spark, f"{held['root']}/encoders/e1")
    rows, table, vocabulary = (spark.read.parquet(p) for p in (f"{held['root']}/pools/p1/pool", f"{at}/lookup", f"{at}/vocabulary"))
    lookups, model = models.folded(models.load_model(spark, f"{at}/model"), table)
    out = model.encode(scenarios.encoder_inputs(rows, lookups, vocabulary))
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning" not in plan and "Exchange rangepartitioning" not in plan and "Exchange SinglePartition" not in plan
    whole = models.load_model(spark, f"{at}/model").encode(scenarios.encoder_inputs(rows, dict.fromkeys(scenarios.BAGS, table), vocabulary))
    a, b = ({r.device_ifa: np.array(r.z) for r in d.collect()} for d in (out, whole))
    assert set(a) == set(b) and all(np.allclose(a[k], b[k], atol=1e-6) for k in a)
    bags = features.pool_groups(rows, scenarios.BAGS, dict.fromkeys(scenarios.BAGS, table))
    features.LOOKUP_ROWS, was = 0, features.LOOKUP_ROWS
    try:
        joined = features.pool_groups(rows, scenarios.BAGS, dict.fromkeys(scenarios.BAGS, table))
    finally:
        features.LOOKUP_ROWS = was
    x, y = ({r.device_ifa: np.concatenate([r[f"v_{g}"] for g in scenarios.BAGS]) for r in d.collect()} for d in (bags, joined))
    assert set(x) == set(y) and all(np.allclose(x[k], y[k]) for k in x)


def test_pooled_edges(spark):
    """Null and empty bags, unknown IDs, repeats, and bags that are longer than is kept."""
    table = spark.createDataFrame([("1", [1.0, 0.0]), ("2", [0.0, 4.0])], "segment_id string, vector array<double>")
    rows = spark.createDataFrame([("a", "1;2;2"), ("b", None), ("c", ""), ("d", "9;1"), ("e", "1;" + "2;" * 23 + "2")], "device_ifa string, product string")
    for limit in (10, 0):
        features.LOOKUP_ROWS, was = limit, features.LOOKUP_ROWS
        try:
            got = {r.device_ifa: r.v_product for r in features.pool_groups(rows, {"product": "product"}, {"product": table}).collect()}
        finally:
            features.LOOKUP_ROWS = was
        assert {k: [round(x, 6) for x in v] for k, v in got.items()} == {"a": [0.333333, 2.666667], "b": [0.0, 0.0], "c": [0.0, 0.0], "d": [1.0, 0.0], "e": [0.0, 4.0]}


def test_another_encoder_is_refused(spark, config):
    held, root = config
    config = scenarios.DEFAULTS | {k: v for k, v in held.items() if k != "_comment"} | {"encoder": "e2"}
    models.save_model(spark, models.Classifier({"w0": np.ones((2, 1))}, ["x"]), f"{held['root']}/encoders/e2/model")
    with pytest.raises(ValueError, match="sha256"):
        scenarios.configured(spark, "seeds", config).run("seed")


def test_models_are_kept(spark, tmp_path):
    p = {"w0": np.arange(6.0).reshape(3, 2), "b0": np.array([1.0, -1.0])}
    digest = models.save_model(spark, models.Classifier(p, ["a", "b"], 0.7, 3), str(tmp_path / "m"), note="x")
    back = models.load_model(spark, str(tmp_path / "m"))
    assert (back.labels, back.val_auc, back.rounds) == (["a", "b"], 0.7, 3) and all((back.params[k] == p[k]).all() for k in p)
    assert models.about_model(spark, str(tmp_path / "m")) == {"note": "x", "sha256": digest}


def test_folded_lookup_gives_the_same_means(spark):
    taxonomy = spark.createDataFrame([(str(i), f"group>name {i}") for i in range(9)], "segment_id string, path string")
    table = features.lookup(taxonomy, features.hashed_vectors(16))
    w = np.random.default_rng(0).normal(size=(16, 4))
    bags = spark.createDataFrame([("a", [1, 2, 2]), ("b", []), ("c", None), ("d", [3, 99])], "device_ifa string, idx array<int>")
    whole = {r.device_ifa: np.array(r.v) @ w for r in features.bag_means(bags, table, 16).collect()}
    folded = {r.device_ifa: np.array(r.v) for r in features.bag_means(bags, features.fold(table, w), 4).collect()}
    assert set(whole) == set("abcd") and all(np.allclose(whole[k], folded[k]) for k in whole)
    features.LOOKUP_ROWS, was = 0, features.LOOKUP_ROWS
    try:
        joined = {r.device_ifa: np.array(r.v) @ w for r in features.bag_means(bags, table, 16).collect()}
    finally:
        features.LOOKUP_ROWS = was
    assert all(np.allclose(whole[k], joined[k]) for k in whole)


def test_learned_vectors(spark):
    """Segments of one branch are nearer than those of others, reruns agree, and the vectors span what a plain
    decomposition of the same matrix does."""
    rows = [(f"{i}{j}{k}", f"Group {i}>branch {i}{j}>leaf {i}{j}{k}") for i in range(3) for j in range(3) for k in range(4)] + [("none", None)]
    taxonomy = spark.createDataFrame(rows, "segment_id string, path string").repartition(3)
    vectors = lambda: {r.segment_id: np.array(r.vector) for r in features.lookup(taxonomy, features.learned_vectors(9, 31)).collect()}
    v, again = vectors(), vectors()
    assert set(v) == {i for i, _ in rows} and not v["none"].any()
    names = [i for i, _ in rows[:-1]]
    cosine = np.array([[v[a] @ v[b] for b in names] for a in names])
    branch = np.array([[a[:2] == b[:2] for b in names] for a in names])
    group = np.array([[a[0] == b[0] for b in names] for a in names])
    assert cosine[branch].mean() > cosine[group & ~branch].mean() > cosine[~group].mean()
    assert np.allclose(cosine, [[again[a] @ again[b] for b in names] for a in names], atol=1e-6)
    parts = {(r.segment_id, r.token) for r in features.path_parts(taxonomy).collect()}
    s, t = sorted({a for a, _ in parts}), sorted({b for _, b in parts})
    m = np.array([[float((a, b) in parts) for b in t] for a in s])
    m = m * np.maximum(np.log(m.sum() / np.outer(m.sum(1), m.sum(0))), 0)
    u, values, _ = np.linalg.svd(m)
    assert values[8] > 1.02 * values[9]  # groups and branches; what follows are single leaves
    plain = u[:, :9] * values[:9]
    plain /= np.linalg.norm(plain, axis=1, keepdims=True)
    at = [s.index(i) for i in names]
    assert np.allclose(cosine, (plain @ plain.T)[np.ix_(at, at)], atol=1e-3)


def test_imbalance_is_compared(spark):
    r = np.random.default_rng(1)
    z = r.normal(size=(600, 3))
    rows = spark.createDataFrame([(str(i), z[i].tolist(), int(z[i, 0] > 0.9)) for i in range(600)], "device_ifa string, z array<double>, y int")
    out = models.compare_imbalance(rows, "y", {"w": {"mode": "posweight"}, "u": {"mode": "undersample", "ratio": 3}}, repeats=2, rounds=4, batch=64, rate=0.05)
    found = {r.config: (r.reps, r.mean_auc) for r in models.repeat_summary(out).collect()}
    assert set(found) == {"w", "u"} and all(n == 2 and a > 0.8 for n, a in found.values())


def test_published_table(spark):
    spark.sql("drop table if exists kindred_published")
    assert sources.publish(spark.range(7), "kindred_published") == 7
    with pytest.raises(ValueError):
        sources.publish(spark.range(7), "kindred_published")
    assert sources.seed_table(spark, "x=default.kindred_published:id")[1].count() == 7
    spark.sql("drop table kindred_published")


def test_one_csv(spark, tmp_path):
    with pytest.raises(ValueError):
        sources.one_csv(spark, str(tmp_path))
    (tmp_path / "a.csv").write_text("x\n")
    assert sources.one_csv(spark, str(tmp_path)).endswith("a.csv") and sources.one_csv(spark, str(tmp_path / "a.csv")) == str(tmp_path / "a.csv")


def test_a_pool_is_one_unit(spark, config):
    """Settings of a made pool are refused; by force vocabulary, lookup and model are made together, and runs of the
    encoder that was are refused."""
    held, root = config
    encoder = f"{held['root']}/encoders/e1"
    with pytest.raises(ValueError, match="param train"):
        scenarios.configured(spark, "pool", held_config(held, train={"rounds": 1, "dims": 8})).run()
    was, model = scenarios.encoder_at(spark, encoder), held["root"] + "/runs/r1/2024-02-01_2024-03-31"
    scenarios.configured(spark, "seeds", held_config(held), force=True).run()
    assert spark.read.parquet(f"{model}/train").first().model.startswith(f"{model}/models/")
    scenarios.configured(spark, "pool", held_config(held, train={"rounds": 1, "dims": 8}), force=True).run()
    now = scenarios.encoder_at(spark, encoder)
    assert now != was and models.about_model(spark, f"{now}/model")["sha256"] == spark.read.parquet(f"{held['root']}/pools/p1/train").first().sha256
    note = runs.held_at(spark, f"{encoder}/current")
    assert note["structure"]["dims"] == 64 and all(mark_of(spark.read.parquet(f"{now}/{k}")) == note["tables"][k] for k in ("lookup", "vocabulary"))
    with pytest.raises(ValueError, match="sha256"):
        scenarios.configured(spark, "seeds", held_config(held)).run()
    spark.read.parquet(f"{now}/vocabulary").limit(1).write.mode("overwrite").parquet(str(root / "less"))
    spark.read.parquet(str(root / "less")).write.mode("overwrite").parquet(f"{now}/vocabulary")
    with pytest.raises(ValueError, match="vocabulary is not"):
        scenarios.encode(spark, encoder, spark.read.parquet(f"{held['root']}/pools/p1/pool"))
