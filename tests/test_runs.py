import json
import subprocess

import pytest

from kindred.plans import runs


def test_stage_is_made_once_and_recorded(spark, tmp_path):
    root, built = str(tmp_path / "run"), []

    def build():
        built.append(1)
        return spark.range(len(built) * 10)

    assert runs.stage(spark, root, "pool", build, {"region": "KR"}).count() == 10
    assert runs.stage(spark, root, "pool", build).count() == 10 and len(built) == 1
    assert runs.stage(spark, root, "pool", build, force=True).count() == 20

    def fail():
        raise RuntimeError("no log")

    with pytest.raises(RuntimeError):
        runs.stage(spark, root, "candidates", fail)
    assert not runs.made(spark, f"{root}/candidates")
    got = sorted((r.name, r.status, r["rows"], r.error) for r in runs.lineage(spark, root).collect())
    assert got == [("candidates", "failed", None, "no log"), ("pool", "ok", 10, None), ("pool", "ok", 20, None)]


def test_settings(tmp_path):
    p = tmp_path / "c.json"
    p.write_text(json.dumps({"_note": "x", "rounds": 3, "other": 1}))
    assert runs.settings(str(p), {"rounds": 20, "rate": 0.1}) == ({"rounds": 3, "rate": 0.1}, ["other"])


def test_refusals(spark, tmp_path):
    layout, spec = runs.Layout(str(tmp_path)), runs.PoolSpec((("2024-01-01", "2024-01-31"),))
    runs.keep_pool(spark, layout, "p1", spec)
    runs.keep_pool(spark, layout, "p1", spec)
    assert runs.load_pool(spark, layout, "p1") == spec
    other = runs.PoolSpec((("2024-01-01", "2024-01-31"),), region="US")
    with pytest.raises(ValueError, match="region"):
        runs.keep_pool(spark, layout, "p1", other)
    runs.keep_pool(spark, layout, "p1", other, force=True)
    with pytest.raises(ValueError):
        layout.run("../x", [("2024-01-01", "2024-01-31")])
    runs.refuse_overlap(spark, [("2024-01-01", "2024-01-31")], [("2024-02-01", "2024-02-10")])
    with pytest.raises(ValueError):
        runs.refuse_overlap(spark, [("2024-01-01", "2024-01-31")], [("2024-03-01", "2024-03-10"), ("2024-01-31", "2024-02-10")])


def test_seed_registry(spark, tmp_path):
    layout = runs.Layout(str(tmp_path))
    assert runs.registered_seeds(spark, layout).count() == 0
    for run, ids in (("a", "xy"), ("b", "yz"), ("a", "w")):
        runs.register_seeds(layout, run, spark.createDataFrame([(i,) for i in ids], "device_ifa string"))
    assert sorted(map(tuple, runs.registered_seeds(spark, layout).collect())) == [("a", "w"), ("b", "y"), ("b", "z")]


def test_changed_settings_and_inputs(spark, tmp_path):
    """A stage is made again for other settings or inputs, which its record names, or refused; without a note it counts as
    not made."""
    root, built = str(tmp_path / "run"), []

    def build():
        built.append(1)
        return spark.range(len(built))

    ask = lambda **k: runs.stage(spark, root, "s", build, **k).count()
    assert [ask(params={"p": 1}, inputs={"a": "x"}) for _ in range(2)] == [1, 1]
    assert ask(params={"p": 1}, inputs={"a": "y"}) == 2 and ask(params={"p": 2}, inputs={"a": "y"}) == 3
    with pytest.raises(ValueError, match="input a, param p"):
        ask(params={"p": 1}, inputs={"a": "x"}, refuse=True)
    assert ask() == 3 and ask(params={"p": 1}, inputs={"a": "x"}, refuse=True, force=True) == 4
    runs.delete(spark, f"{root}/_stages/s")
    assert ask(params={"p": 1}, inputs={"a": "x"}, refuse=True) == 5
    assert sorted(tuple(r.changed) for r in runs.lineage(spark, root).where("status = 'ok'").collect()) == [(), (), ("input a",), ("input a", "param p"), ("param p",)]


def test_code_state(tmp_path):
    """The commit, marked once a file differs; none outside of a repository."""
    assert runs.code_state(str(tmp_path)) is None
    git = lambda *a: subprocess.run(["git", "-C", str(tmp_path), "-c", "user.name=x", "-c", "user.email=x@example.com", *a], check=True, capture_output=True)
    git("init")
    (tmp_path / "f").write_text("1")
    git("add", "f")
    git("commit", "-m", "x")
    clean = runs.code_state(str(tmp_path))
    (tmp_path / "f").write_text("2")
    assert len(clean) == 40 and runs.code_state(str(tmp_path)) == clean + "+dirty"
