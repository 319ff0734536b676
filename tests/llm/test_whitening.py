"""Whitening against the eigenvectors of the covariance in whole numbers, and the tree against one decomposition."""

from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from kindred.llm import whitening
from kindred.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


def plain(vectors):
    """(n, deviations, whitened up to signs, explained) of the rows: covariance exact, then eigh."""
    x = np.array([[int(np.floor(64 * float(c))) + 1_000_000 for c in v] for v in vectors], object)
    n, sums = len(x), x.sum(axis=0)
    d = n * x - sums
    v = (d.T @ d).astype(object)
    cov = np.array([[float(Fraction(int(a), n**3)) for a in r] for r in v])
    e, u = np.linalg.eigh(cov)
    e, u = e[::-1], u[:, ::-1]
    centred = np.array([[float(Fraction(int(a), n)) for a in r] for r in d])
    return n, (d**2).sum(axis=1), centred @ u / np.sqrt(np.maximum(e, 1e-300)), e / np.trace(cov)


def compare(out, ids, vectors, rtol=1e-7):
    n, deviation, white, explained = plain(vectors)
    k = min(32, white.shape[1])
    got = {(r.vec_id, r.component): r for r in out.collect()}
    assert len(got) == len(ids) * k
    mine = np.array([[got[i, c + 1].whitened for c in range(k)] for i in ids])
    signs = np.sign((mine * white[:, :k]).sum(axis=0))
    assert np.allclose(mine, white[:, :k] * signs, rtol=rtol, atol=rtol)
    for j, i in enumerate(ids):
        assert got[i, 1].deviation == deviation[j] and got[i, 1].n == n
    assert np.allclose([got[ids[0], c + 1].explained for c in range(k)], explained[:k], rtol=1e-9)
    assert max(r.identity_error for r in got.values()) < 1e-9


def test_query(spark):
    rows = spark.read.parquet(f"{SF}/embeddings.parquet").collect()
    compare(QUERIES["op13_whiten_embeddings"](spark, SF), [r.vec_id for r in rows], [r.embedding for r in rows])


def test_hard_rows(spark, tmp_path):
    r = np.random.default_rng(1)
    good = (r.normal(size=(300, 5)) @ np.diag([9.0, 4.0, 2.0, 1.0, 0.3]) + [5e4, 0, -3e3, 1, 0]).tolist()
    bad = [(900, None), (901, [1.0, None, 1.0, 1.0, 1.0]), (902, [1.0, float("nan"), 0.0, 0.0, 0.0]), (903, [float("inf")] + [0.0] * 4), (904, []), (905, [1.0, 2.0]), (906, [1e30] + [0.0] * 4)]
    rows = [(i, v) for i, v in enumerate(good)] + bad
    df = spark.createDataFrame([(i, v, "x", "y") for i, v in rows], "vec_id bigint, embedding array<double>, n string, component string")
    df.repartition(7).write.parquet(str(tmp_path / "e"))
    compare(whitening.whiten_embeddings(spark.read.parquet(str(tmp_path / "e"))), list(range(300)), good)


def test_repeated_rows_and_ids(spark):
    df = spark.createDataFrame([(None, [1.0, 0.0]), (7, [2.0, 5.0]), (7, [2.0, 5.0]), (7, [0.0, 1.0])], "vec_id bigint, embedding array<float>")
    out = whitening.whiten_embeddings(df)
    assert out.count() == 8 and out.where("vec_id is null").count() == 2 and out.agg(F.max("n")).first()[0] == 4


@pytest.mark.parametrize("vectors", ([[1.5, 2.0, 3.0]], [[1.0, 1.0]] * 5, [[float(i), 2.0 * i, 1.0] for i in range(9)]))
def test_no_variance(spark, vectors):
    """Components without any have no value; the others are whole."""
    out = whitening.whiten_embeddings(spark.createDataFrame(list(enumerate(vectors)), "vec_id bigint, embedding array<double>")).collect()
    rank = int(np.linalg.matrix_rank(np.array(vectors) - np.mean(vectors, axis=0)))
    assert len(out) == len(vectors) * len(vectors[0])
    assert all((x.whitened is None) == (x.component > rank) for x in out) and all(x.identity_error < 1e-9 for x in out)


def test_empty(spark):
    schema = "vec_id bigint, embedding array<float>"
    for rows in ([], [(1, None), (2, [None])]):
        out = whitening.whiten_embeddings(spark.createDataFrame(rows, schema))
        assert out.count() == 0 and out.columns == whitening.WHITENED.replace(",", "").split()[::2]


def test_tree_loses_nothing(spark):
    """One decomposition of all rows has the singular values and vectors of the tree's root, all of them."""
    r = np.random.default_rng(5)
    y = np.floor(r.normal(size=(997, 6)) * [900, 300, 50, 9, 3, 1] + 1e6)
    df = spark.createDataFrame([(v,) for v in y.tolist()], "v array<double>").repartition(23)
    root = whitening.decomposed(df, 1.0, fan_in=3)
    _, s, vt = np.linalg.svd(y - y.mean(axis=0), full_matrices=False)
    assert root.n == 997 and root.sums == [int(x) for x in y.sum(axis=0)]
    assert np.allclose(root.s, s, rtol=1e-12) and np.allclose(np.abs((root.vt * vt).sum(axis=1)), 1, atol=1e-12)


def test_large_numbers_are_exact():
    """Deviations that need more than 63 bits are none; sums beyond a double's whole numbers keep every digit."""
    y = np.array([[2.0**40 + 1, 3.0], [2.0**40, 1.0], [5.0, 2.0]])
    w = whitening.Whitener.fitted(whitening.Summary.of(y), 2, 1)
    assert w.sums == [2**41 + 6, 6]
    want = [sum((3 * int(a) - s) ** 2 for a, s in zip(row, w.sums)) for row in y]
    assert w.deviations(y) == [x if x < 2**63 else None for x in want] and None in w.deviations(y)
    z = np.array([[2.0**33 + 1, 3.0], [2.0**33, 1.0], [5.0, 2.0]])
    w = whitening.Whitener.fitted(whitening.Summary.of(z), 2, 1)
    assert w.deviations(z[:2] - 0) == [x if x < 2**63 else None for x in (sum((3 * int(a) - s) ** 2 for a, s in zip(row, w.sums)) for row in z[:2])]
