"""The filters' interaction against a plain count of every document, and the scan against plain words."""

import random
import re
from collections import Counter
from itertools import permutations

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from kindred.llm import audit
from kindred.llm.queries import ORACLE_SQL, QUERIES

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id bigint, text string, source string, part string, mask string, digest string, n string, quality string"


def plain_measures(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    return [len(w), len(set(w)), len(re.findall("[A-Z]", text)), len(re.findall("[#$%&*|]", text)), len(text)]


def texts():
    r = random.Random(4)
    some = ["", " ", "a", "\n\n", "é", "é é É", "A B A B", "x|y", "\x00 \x1f \x85    　", "a\x0bb\x0cc\rd\te", "end ", " start", "😀 😀 #"]
    some += ["".join(r.choice("aAbé #\n\t|𝄞") for _ in range(r.randrange(300))) for _ in range(60)]
    return some + [" ".join(r.choice(("one", "two", "Three", "fünf")) + str(r.randrange(40)) for _ in range(n)) for n in (199, 200, 201, 5000)]


@pytest.mark.parametrize("piece", (8, 100, 1 << 20))
@pytest.mark.parametrize("base", (audit.BASE, 1))
def test_measures(monkeypatch, piece, base):
    """Whatever the pieces, and with a hash that holds words of the same letters equal."""
    monkeypatch.setattr(audit, "PIECE", piece)
    some = texts()
    data, offsets = audit._buffers(pa.array(["skipped", *some]).slice(1))
    assert audit.measures(data, offsets, audit._Powers(base)).tolist() == [plain_measures(t) for t in some]
    assert audit.measures(*audit._buffers(pa.array([], pa.string()))).shape == (0, 5)


def test_hashes_are_verified():
    """Anagrams have one hash when the base is 1."""
    data = np.frombuffer(b"abc cab abc bca", np.uint8)
    assert audit.measures(data, np.array([0, len(data)]), audit._Powers(1))[0, 1] == 3


def plain(rows, labels):
    good, toxic = ({i for i, *x in labels if i is not None and x[k] == 1} for k in (0, 1))
    least, masks = {}, []
    for i, t, _ in rows:
        if i is not None:
            least[t or ""] = min(i, least.get(t or "", i))
    for i, t, s in rows:
        w, d, c, y, n = plain_measures(t or "")
        fails = {f for f, x in zip("ABCDE", (w < 200, 100 * d < 50 * w, 100 * c > 2 * n, y > 0, i is not None and i > least[t or ""])) if x}
        masks.append((s or "", fails, i in good, i in toxic))
    out = {}
    for part in {m[0] for m in masks}:
        own, taken = [m for m in masks if m[0] == part], Counter()
        for order in permutations("ABCDE"):
            left = own
            for k, f in enumerate(order):
                gone = [m for m in left if f in m[1]]
                left = [m for m in left if f not in m[1]]
                taken[f] += len(gone)
                out[part, "".join(order), k + 1] = [len(left), len(gone), sum(f in m[1] for m in own) - len(gone), sum(m[1] == {f} for m in own), sum(m[2] for m in gone), sum(m[3] for m in gone)]
        for (p, order, k), v in out.items():
            if p == part:
                v.append(taken[order[k - 1]])
    return out


def test_audit_of_hard_rows(spark, tmp_path):
    """Null ids, texts and sources, repeated ids with other texts, copies across parts, clashing columns, labels twice."""
    r = random.Random(9)
    some = texts()
    rows = [(i, r.choice(some), r.choice(("a", "b", "", None))) for i in range(120)] + [(None, some[3], "a"), (None, some[3], None), (4, None, "b"), (4, None, "b"), (4, some[-1], "c"), (200, some[-1], "a"), (201, some[-2], "only")]
    labels = [(i, r.choice((0, 1, None)), r.choice((0, 1, None))) for i in range(0, 210, 2)] + [(4, 1, 0), (4, 0, 1), (None, 1, 1)]
    spark.createDataFrame([(*x, "p", "m", "d", "n", "q") for x in rows], SCHEMA).repartition(3).write.parquet(str(tmp_path / "d"))
    out = audit.audit_filters(spark.read.parquet(str(tmp_path / "d")), spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int"))
    got = {(x.part, x.filter_order, x.step): [x.kept, x.removed, x.redundant, x.unique_fails, x.good_lost, x.toxic_lost, x.shapley] for x in out.collect()}
    assert got == plain(rows, labels) and len(got) == 5 * 600


def test_audit_of_an_empty_table(spark):
    assert audit.audit_filters(spark.createDataFrame([], SCHEMA), spark.createDataFrame([], "doc_id bigint, quality int, toxic int")).count() == 0


def test_audit_without_labels(spark):
    docs = spark.createDataFrame([(1, "a"), (2, "a")], "doc_id bigint, text string").withColumn("source", F.lit(None).cast("string"))
    out = audit.audit_filters(docs, spark.createDataFrame([], "doc_id bigint, quality int, toxic int"))
    assert out.count() == 600 and out.agg(F.sum("good_lost")).first()[0] == 0


def test_query_and_sql(spark):
    con = duckdb.connect()
    for t in ("documents", "labels"):
        con.execute(f"create view {t} as select * from read_parquet('{SF}/{t}.parquet')")
    a, b = QUERIES["op11_audit_filters"](spark, SF), con.execute(ORACLE_SQL["op11_audit_filters"])
    names = [c[0] for c in b.description]
    assert sorted(map(tuple, a.select(*names).collect())) == sorted(b.fetchall())
