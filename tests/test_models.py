import numpy as np
import pytest
from pyspark.sql import functions as F

from kindred.operators import models


def vectors(spark, n, seed=1):
    """Vectors of 8; a is rare and depends on two of them, b on a third."""
    r = np.random.default_rng(seed)
    z = r.normal(size=(n, 8))
    a, b = (z[:, 0] + z[:, 1] > 1.8).astype(int), (z[:, 2] > 0).astype(int)
    return spark.createDataFrame([(str(i), z[i].tolist(), int(a[i]), int(b[i])) for i in range(n)], "device_ifa string, z array<double>, y_a int, y_b int")


def numeric(gradient, p, data, k, i):
    out = []
    for e in (1e-5, -1e-5):
        q = {x: v.copy() for x, v in p.items()}
        q[k].flat[i] += e
        out.append(gradient(q, data, np.random.default_rng(0))[0])
    return (out[0] - out[1]) / 2e-5


@pytest.mark.parametrize("mode", models.MODES)
def test_classifier_gradient(mode):
    r = np.random.default_rng(3)
    data = {"z": r.normal(size=(40, 5)), "y_a": (r.random(40) < 0.3).astype(float), "y_b": (r.random(40) < 0.5).astype(float)}
    weights = np.array([2.0, 1.5]) if mode == "posweight" else np.array([2.0])
    gradient, p = models._classifier_gradient(["y_a", "y_b"], weights, mode, 1, 0.2), models._dense([5, 6, 6, 2], r)
    g = gradient(p, data, np.random.default_rng(0))[1]
    for k in p:
        for i in (0, p[k].size - 1):
            assert g[k].flat[i] == pytest.approx(numeric(gradient, p, data, k, i), abs=1e-6)


def test_autoencoder_gradient_of_decoder():
    """The decoder's parameters do not move the fixed targets, so that differences agree."""
    r = np.random.default_rng(4)
    data = {"gender": r.normal(size=30), "age": r.integers(0, 4, 30).astype(float), "v_x": r.normal(size=(30, 6)), "v_y": r.normal(size=(30, 6))}
    p = {"age": r.normal(size=(4, 3))} | models._dense([1 + 3 + 4, 7, 5, 7, 1 + 4 + 4], r)
    for g in "xy":
        p[f"project_{g}"], p[f"shift_{g}"] = r.normal(size=(6, 2)), r.normal(size=2)
    gradient = models._autoencoder_gradient(["x", "y"])
    found = gradient(p, data, r)[1]
    assert set(found) == set(p)
    for k in ("w0", "b0", "w1", "b1", "w2", "b2", "w3", "b3", "age"):
        for i in (0, p[k].size - 1):
            assert found[k].flat[i] == pytest.approx(numeric(gradient, p, data, k, i), abs=1e-6)


@pytest.mark.parametrize("mode", ("posweight", "sampler", "undersample"))
def test_binary_classifier_learns(spark, mode):
    m = models.fit_classifier(vectors(spark, 2000), vectors(spark, 600, 2), {"a": "y_a"}, mode=mode, rounds=6, batch=64, rate=0.02)
    assert m.val_auc > 0.95
    new = vectors(spark, 300, 5)
    assert m.score(new).count() == 300 and m.score(new).columns == ["device_ifa", "score_a"]


def test_several_heads_learn(spark):
    m = models.fit_classifier(vectors(spark, 2000), vectors(spark, 600, 2), {"a": "y_a", "b": "y_b"}, hidden=(32, 32), rounds=6, batch=64, rate=0.02)
    assert m.val_auc > 0.95 and [w.shape for w, _ in m.layers()] == [(8, 32), (32, 32), (32, 2)]


def test_classifier_edges(spark):
    rows = vectors(spark, 60)
    with pytest.raises(ValueError):
        models.fit_classifier(rows, rows, {"a": "y_a"}, mode="other")
    assert models.fit_classifier(rows.limit(0), rows, {"a": "y_a"}).params == {}
    one = rows.withColumn("y_a", F.lit(None).cast("int")).union(spark.createDataFrame([("n", None, 1, 1)], rows.schema))
    m = models.fit_classifier(one, one, {"a": "y_a"}, rounds=2)
    assert m.val_auc is None and m.rounds == 2


def test_autoencoder_learns_and_encodes(spark):
    r = np.random.default_rng(6)
    base = r.normal(size=(1500, 3))
    turn = r.normal(size=(3, 12))
    rows = [(str(i), float(x[0]), int(x[1] > 0) + 1, (x @ turn).tolist()) for i, x in enumerate(base)]
    d = spark.createDataFrame([*rows, ("none", None, None, [0.0] * 12)], "device_ifa string, gender double, age int, v_product array<double>")
    first = models.fit_autoencoder(d, d, {"product": 4}, ages=3, dims=4, rounds=1, batch=64, rate=0.005)
    m = models.fit_autoencoder(d, d, {"product": 4}, ages=3, dims=4, rounds=12, batch=64, rate=0.005)
    assert m.val_loss < 0.6 * first.val_loss
    z = {x.device_ifa: x.z for x in m.encode(d).collect()}
    assert len(z) == 1501 and all(len(v) == 4 for v in z.values())
    assert models.fit_autoencoder(d.limit(0), d, {"product": 4}, ages=3).params == {}


def one_process(columns, data, pos, gradient, params, epochs, batch, seed, mode="none", ratio=1):
    """Plain minibatches over all rows in memory, in the orders that the distributed epochs have."""
    flat, adam = models._flat(params), models.Adam.new(params)
    p, n = int(pos.sum()), int((~pos).sum())
    most = min(n, int(p * ratio)) if mode == "undersample" else n
    for turn in range(1, epochs + 1):
        a, c = models.turned(n, [seed, turn, 1])
        key = np.where(pos, data["_at"], p + (data["_at"] * a + c) % n)
        a, c = models.turned(p + most, [seed, turn, 2])
        keep = np.flatnonzero(key < p + most)
        key = (key[keep] * a + c) % (p + most)
        order = keep[np.argsort(key)]
        key = np.sort(key)
        for at in range(0, len(order), batch):
            own = order[at : at + batch]
            _, g, used = gradient(models._shaped(flat, params), {k: data[k][own] for k in columns}, models.Keyed(key[at : at + batch], seed + turn))
            flat = adam.moved(flat, models._flat(g) / used, 0.02)
    return flat


@pytest.mark.parametrize("mode", ("posweight", "undersample"))
def test_training_is_one_process_training(spark, mode):
    """Parameters do not depend on the partitions, and are those of a loop in one process, dropout included."""
    rows = vectors(spark, 333)
    weights = np.array([3.0, 1.5]) if mode == "posweight" else np.array([2.0])
    gradient, params = models._classifier_gradient(["y_a", "y_b"], weights, mode, 0.5, 0.2, True), models._dense([8, 6, 6, 2], np.random.default_rng(1))
    found = []
    for parts in (1, 3, 8):
        deal = models.Minibatches(rows, F.greatest("y_a", "y_b") > 0, 50, mode, 0.5, 7, parts)
        assert deal.rows.rdd.getNumPartitions() == parts
        own, adam = params, models.Adam.new(params)
        for turn in (1, 2):
            dealt, steps = deal.epoch(turn)
            own, adam, loss = models.sync_round(dealt, ["z", "y_a", "y_b"], own, adam, gradient, steps, 0.02, 7 + turn)
        found.append(models._flat(own))
        held = deal.rows.collect()
        deal.unpersist()
    data = {"z": np.array([r.z for r in held]), "y_a": np.array([float(r.y_a) for r in held]), "y_b": np.array([float(r.y_b) for r in held]), "_at": np.array([r._at for r in held])}
    want = one_process(["z", "y_a", "y_b"], data, np.array([bool(r._pos) for r in held]), gradient, params, 2, 50, 7, mode, 0.5)
    assert loss > 0 and all(np.allclose(x, want, rtol=0, atol=1e-9) for x in found)


def test_epochs_deal_rows(spark):
    """Each row once, in full minibatches; undersampled all positives; sampled as many rows as there are, half of each class."""
    rows = vectors(spark, 300)
    seen = {}
    for mode in ("none", "undersample", "sampler"):
        deal = models.Minibatches(rows, F.col("y_a") > 0, 64, mode, 2, 1, 3)
        for turn in (1, 2):
            dealt, steps = deal.epoch(turn)
            seen[mode, turn] = [(r.device_ifa, r.y_a, r._step) for r in dealt.select("device_ifa", "y_a", "_step").collect()]
            assert {s for _, _, s in seen[mode, turn]} == set(range(steps))
        deal.unpersist()
    pos = rows.where("y_a = 1").count()
    assert all(len({i for i, _, _ in seen["none", t]}) == 300 == len(seen["none", t]) and sorted(s for _, _, s in seen["none", t])[:65].count(0) == 64 for t in (1, 2))
    assert sorted(seen["none", 1]) != sorted(seen["none", 2])
    assert all(sum(y for _, y, _ in seen["undersample", t]) == pos and len(seen["undersample", t]) == 3 * pos for t in (1, 2))
    assert {i for i, y, _ in seen["undersample", 1]} != {i for i, y, _ in seen["undersample", 2]}
    assert len(seen["sampler", 1]) == 300 and 110 < sum(y for _, y, _ in seen["sampler", 1]) < 190


def test_few_rows_in_many_tasks(spark):
    """Tasks without a row take part as well."""
    m = models.fit_classifier(vectors(spark, 5), vectors(spark, 60), {"a": "y_a"}, rounds=1, batch=2, mode="sampler")
    assert m.rounds <= 1 and m.params


def test_mixed_training(spark):
    m = models.fit_classifier(vectors(spark, 2000), vectors(spark, 600, 2), {"a": "y_a"}, rounds=4, batch=64, rate=0.02, exchange="mix")
    assert m.val_auc > 0.9


def test_scores_take_the_first_row_of_a_device(spark):
    m = models.Classifier({"w0": np.array([[1.0]]), "b0": np.zeros(1)}, ["a"])
    rows = spark.createDataFrame([("x", [3.0]), ("x", [1.0]), ("y", [0.0])], "device_ifa string, z array<double>")
    assert {r.device_ifa: round(r.score_a, 3) for r in m.score(rows).collect()} == {"x": 0.731, "y": 0.5} and m.score(rows, first_by=None).count() == 3
