"""The document operators on small tables with nulls, empty and long texts, ties, repeated rows and clashing names."""

import random
import sys
import zlib
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).parent))
import brute  # noqa: E402

from kindred.llm import attribution, exact_dedup, media, mixing, near_dup, packing, passages, pii, quality, sharding, tokens  # noqa: E402

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, row bigint, size string, digest string, copies string, h string, r string, node string"


def table(spark, rows, at):
    """Written, as the operators' inputs are; with columns whose names clash with the operators' own."""
    df = spark.createDataFrame([(i, t, "en", s, 1, 7, "x", "x", "x", "x", "x", "x") for i, t, s in rows], SCHEMA)
    df.repartition(3).write.parquet(at)
    return spark.read.parquet(at)


def words(r, n):
    return " ".join("".join(r.choice("abcdeéfg") for _ in range(r.randint(1, 7))) for _ in range(n))


def corpus():
    r = random.Random(5)
    base = [words(r, r.choice((3, 40, 200, 600))) for _ in range(40)]
    rows = [(i, t, f"s{i % 4}") for i, t in enumerate(base)]
    rows += [(100 + i, base[i % 5].replace(" ", "  \t", 3), "s0") for i in range(20)]
    for i in range(30):
        w = base[3].split() if i % 2 else base[7].split()
        for _ in range(1 + i % 4):
            w[r.randrange(len(w))] = "changed" + str(r.randrange(1000))
        rows.append((200 + i, " ".join(w).upper() if i % 5 == 0 else " ".join(w), None if i % 3 else "s9"))
    rows += [(300, None, None), (301, "", "s1"), (302, " \n\t ", "s1"), (303, "one", "s2"), (304, "One", "s2"), (None, base[0], None), (None, "alone", None), (5, base[5], "s1"), (5, base[5], "s1"), (306, words(r, 30_000), "s3")]
    return rows


@pytest.fixture(scope="module")
def docs(spark, tmp_path_factory):
    return table(spark, corpus(), str(tmp_path_factory.mktemp("d") / "t"))


@pytest.fixture(scope="module")
def unique(docs):
    return docs.where("doc_id is not null").dropDuplicates(["doc_id"])


@pytest.fixture(scope="module")
def empty(spark, tmp_path_factory):
    return table(spark, [], str(tmp_path_factory.mktemp("d") / "t"))


def test_empty_tables(spark, empty):
    labels = spark.createDataFrame([], "doc_id bigint, quality int")
    for f in (mixing.mix_sources, mixing.take_mix, packing.pack_documents, pii.find_personal_data, exact_dedup.exact_duplicates, exact_dedup.keep_first, media.store_media, attribution.section_tokens, passages.repeated_passages, sharding.shard_documents, near_dup.near_duplicates, near_dup.keep_one):
        assert f(empty).count() == 0, f.__name__
    assert quality.score_quality(empty, labels).count() == 0


def test_exact(docs):
    out = exact_dedup.exact_duplicates(docs).collect()
    assert len(out) == len(corpus())
    groups = {}
    for i, t, _ in corpus():
        key = " ".join(__import__("re").split(r"[\x20\x09-\x0D]+", t or ""))
        groups.setdefault(key, []).append(i)
    by_id = {i: v for v in groups.values() for i in v}
    for x in out:
        ids = by_id[x.doc_id] if x.doc_id is not None else None
        if ids:
            assert x.group_size == len(ids) and x.keep_id == min(i for i in ids if i is not None)
    assert sum(x.kept for x in out) == len(groups) == exact_dedup.keep_first(docs).count()
    assert exact_dedup.keep_first(docs).columns == docs.columns


def test_cuckoo_index():
    r, index, held = random.Random(1), exact_dedup.CuckooIndex(2), {}
    for _ in range(4000):
        key = r.randrange(900).to_bytes(8, "little") * 4
        if r.random() < 0.6:
            index.insert(key, len(held))
            held[key] = True
        else:
            assert index.delete(key) == (held.pop(key, None) is not None)
        assert (key in index) == (key in held)
    assert dict.fromkeys(k for k, _ in index.items()) == dict.fromkeys(k for k, _ in index.items()) and {k for k, _ in index.items()} == set(held) and index.resizes


def test_index_changes(spark):
    """Random rows come and go; the index then is that of the live rows, first rows included."""
    r = random.Random(7)
    rows = [(bytes([r.randrange(12)]) * 32, r.randrange(50), k, 1) for k in range(120)]
    table = lambda x: spark.createDataFrame(x, "digest binary, first_id bigint, first_row bigint, copies bigint")
    held, new = rows[:80], [x for x in rows[80:] if x[0][0] > 1]
    gone = [x for x in held if x[0][0] < 2 or r.random() < 0.4]
    live = [x for x in held + new if x not in gone]
    index = exact_dedup.build_index(table(held), 3)
    now = exact_dedup.update_index(index, table(new), table(gone), table(live), 3)
    want = {}
    for d, i, k, _ in live:
        first, n = want.get(d, ((i, k), 0))
        want[d] = min(first, (i, k)), n + 1
    assert {bytes(x.digest): ((x.first_id, x.first_row), x.copies) for x in now.collect()} == want and len(want) < 12


def test_near(unique):
    rows = [(r.doc_id, r.text) for r in unique.collect()]
    for n in (4, 5):
        want = brute.near(rows, n)
        assert {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in near_dup.near_duplicates(unique, words=n).collect()} == want
    assert {r.doc_id for r in near_dup.keep_one(unique).collect()} == {i for i, v in brute.near(rows, 5).items() if v[2]}


def test_near_with_nulls_and_repeats(docs):
    out = near_dup.near_duplicates(docs).collect()
    assert len(out) == len(corpus())
    assert all(x.component_id == x.doc_id and x.kept for x in out if x.n_shingles == 0)


@pytest.mark.parametrize("f", (near_dup.keep_one, near_dup.near_duplicates, exact_dedup.keep_first, passages.repeated_passages))
def test_rows_are_numbered_once(spark, unique, f, monkeypatch):
    """The input's files are read by one write alone: later reads could number its rows otherwise."""
    from kindred.llm import common

    source, reads = set(unique.inputFiles()), []

    def counted(df, name, own=common.cut):
        reads.append(bool(source & set(df.inputFiles())))
        return own(df, name)

    for m in (common, exact_dedup, near_dup, passages):
        monkeypatch.setattr(m, "cut", counted)
    out = f(unique)
    assert reads.count(True) == 1 and not source & set(out.inputFiles())


def test_mix(docs):
    out = mixing.mix_sources(docs).collect()
    assert len(out) == len(corpus()) and all(x["size"] == 0 or x.taken <= 3 * x["size"] for x in out)
    by = {}
    for x in out:
        t, n, big = by.get((x.source_size, x.target), (0, 0, 0))
        by[x.source_size, x.target] = t + x.taken, n + x["size"], max(big, x["size"])
    for (size, target), (taken, n, big) in by.items():
        assert n == size and taken <= target + 1e-6 and taken > target - big - 1
    assert sum(t for _, t in by) == pytest.approx(sum(s for s, _ in by))
    assert mixing.take_mix(docs).count() == sum(x.copies for x in out)


def test_targets_stop_at_three_times(spark):
    s = spark.createDataFrame([("a", 1), ("b", 100), (None, 100)], "source string, source_size bigint")
    assert [(r.source, r.target) for r in mixing.source_targets(s).orderBy(F.col("source").asc_nulls_last()).collect()] == [("a", 3.0), ("b", 132.0), (None, 66.0)]


def test_shards(docs):
    out = sharding.shard_documents(docs, shards=5).collect()
    assert len(out) == len(corpus())
    text = {i: t or "" for i, t, _ in corpus() if i is not None}
    where = {}
    for x in out:
        if x.doc_id is not None:
            assert x["size"] == len(text[x.doc_id].encode()) + 8 and x.text_crc32 == zlib.crc32(text[x.doc_id].encode())
            assert where.setdefault(text[x.doc_id], x.shard) == x.shard
    for s in range(5):
        assert sorted(x.slot for x in out if x.shard == s) == list(range(sum(x.shard == s for x in out)))


def test_lpt():
    placed = sharding.lpt([(5, "a"), (4, "b"), (3, "c"), (3, "d"), (3, "e")], 2)
    assert placed == {"a": 0, "b": 1, "c": 1, "d": 0, "e": 1}


def test_pack(docs):
    pieces = packing.pack_documents(docs, window=256).collect()
    encode = tokens.load(tokens.folder(), "byte_bpe_50k")
    ids = {i: np.append(encode(t or ""), np.uint32(0)) for i, t, _ in corpus() if i is not None and i != 5}
    got = {}
    for p in pieces:
        if p.doc_id in ids:
            own = ids[p.doc_id]
            assert p.doc_tokens == len(own) and p.ids_crc32 == zlib.crc32(own[p.start : p.start + p.length].astype("<u4").tobytes())
            got.setdefault(p.doc_id, []).append((p.start, p.length))
    for i, own in ids.items():
        at = 0
        for s, n in sorted(got[i]):
            assert s == at
            at += n
        assert at == len(own)
    by = {}
    for p in pieces:
        by.setdefault(p.sequence_id, []).append((p.offset, p.length))
    for v in by.values():
        at = 0
        for o, n in sorted(v):
            assert o == at
            at += n
        assert at <= 256
    assert sum(sum(n for _, n in v) < 256 for v in by.values()) <= docs.rdd.getNumPartitions()


def test_ids_agree():
    encode = tokens.load(tokens.folder(), "byte_bpe_50k")
    for t in ("", "a  b\n\n c ", "it's", "naïve – “x”", "日本語 text", "x <|endoftext|> y", "tab\t\tx  ", "Привет мир"):
        assert encode(t).tolist() == encode.exact.encode(t, add_special_tokens=False).ids


@pytest.mark.parametrize("rule", attribution.RULES)
def test_attribution(spark, tmp_path, rule):
    r = random.Random(2)
    rows = [(i, t, "s") for i, t in enumerate([None, "", "one line", "a\nb\n\nc", "né à\n日本語 text", words(r, 300).replace("a ", "\n")])]
    df = table(spark, rows, str(tmp_path / "t")).withColumn("at", F.when(F.col("doc_id") > 3, F.array(F.lit(3), F.lit(7), F.lit(None), F.lit(7), F.lit(-1), F.lit(10**6))))
    encode = tokens.load(tokens.folder(), "byte_bpe_50k")
    for starts_col in (None, "at"):
        out = attribution.section_tokens(df, rule, starts_col).collect()
        for i, t, _ in rows:
            t, own = t or "", sorted((x for x in out if x.doc_id == i), key=lambda x: x.section)
            edges = [len(t[: x.start_char].encode()) for x in own] + [len(t.encode())]
            counts, at = [0] * len(own), 0
            for n in encode.bytes_of[encode(t)]:
                held = [max(0, min(b, at + n) - max(a, at)) for a, b in zip(edges, edges[1:])]
                hit = [k for k, h in enumerate(held) if h]
                counts[hit[0] if rule == "first" else hit[-1] if rule == "last" else max(hit, key=lambda k: (held[k], -k))] += 1
                at += n
            assert counts == [x.n_tokens for x in own] and own[0].start_char == 0 and own[-1].end_char == len(t)


def test_quality(spark, tmp_path):
    r = random.Random(3)
    rows = [(i, words(r, 80) if i % 3 else words(r, 80).upper().replace(" ", "!! "), "s") for i in range(600)] + [(None, None, None), (7000, "", "s")]
    labels = spark.createDataFrame([(i, int(i % 3 > 0)) for i in range(600)] + [(None, 1), (5, None)], "doc_id bigint, quality int")
    docs = table(spark, rows, str(tmp_path / "t"))
    out = {x.doc_id: x for x in quality.score_quality(docs, labels).collect()}
    held = [x for i, x in out.items() if i is not None and i < 600 and x.held_out]
    assert len(out) == 602 and all(x.held_out == (zlib.crc32(str(x.doc_id).encode()) % 3 == 1) for x in held)
    assert np.mean([x.predicted == int(x.doc_id % 3 > 0) for x in held]) > 0.97 and all(0 <= x.score <= 1 for x in out.values())
    assert quality.keep_good(docs, labels).count() == sum(x.predicted for x in out.values())


def test_trees_match_a_plain_walk():
    r = np.random.default_rng(0)
    x = r.normal(size=(300, quality.STATISTICS))
    forest = quality.fit(x, (x[:, 0] + x[:, 3] > 0).astype(float), trees=5)
    for row, got in zip(x[:50], forest.score(x[:50])):
        total = forest.base
        for at in forest.roots:
            for _ in range(forest.depth):
                at = forest.child[at] + int(row[forest.feature[at]] > forest.limit[at])
            total += forest.value[at]
        assert got == pytest.approx(1 / (1 + np.exp(-total)))


def test_passages(spark, tmp_path):
    r = random.Random(4)
    shared = words(r, 70).split()
    fuzzy = list(shared)
    fuzzy[20] = fuzzy[45] = "other"
    rows = [(i, words(r, 150), "s") for i in range(20)] + [(30, None, None), (31, "", "s"), (32, "short", "s")]
    for k, own in ((40, shared), (41, shared), (42, fuzzy)):
        rows.append((k, words(r, 60) + " " + " ".join(own) + " " + words(r, 50), "s"))
    out = passages.repeated_passages(table(spark, rows, str(tmp_path / "t"))).collect()
    assert {x.doc_id for x in out} | {x.other_doc_id for x in out} == {40, 41, 42}
    assert all(x.start_word <= 61 and x.end_word >= 129 for x in out)


@pytest.mark.parametrize("length", (50, 60, 100))
def test_passages_of_low_similarity(spark, tmp_path, length):
    r = random.Random(length)
    rows = []
    for i in range(300):
        own = words(r, length).split()
        changed = list(own)
        for k in r.sample(range(length), length * (10 + i % 11) // 100):
            changed[k] = f"changed{r.randrange(10**6)}"
        rows += [(2 * i, f"{words(r, 60)} {' '.join(own)} {words(r, 60)}", "s"), (2 * i + 1, f"{words(r, 60)} {' '.join(changed)} {words(r, 60)}", "s")]
    out = passages.repeated_passages(table(spark, rows, str(tmp_path / "t"))).collect()
    found = {tuple(sorted((x.doc_id, x.other_doc_id))) for x in out}
    assert found == {(2 * i, 2 * i + 1) for i in range(300)}


def test_chains_against_all_orders():
    r = np.random.default_rng(3)
    for _ in range(30):
        x, y = r.integers(0, 60, 8), r.integers(0, 60, 8)
        best = [0.0] * 8
        order = sorted(range(8), key=lambda i: (x[i], -y[i]))
        for k, i in enumerate(order):
            best[i] = passages.K
            for j in order[:k]:
                if x[j] < x[i] and y[j] < y[i]:
                    best[i] = max(best[i], best[j] - passages.COST * (x[i] - x[j] + y[i] - y[j]) + min(passages.K, x[i] - x[j], y[i] - y[j]))
        assert passages.chains(x, y)[0][0] >= 0.8 * max(best)


def test_personal_data_rules():
    text = "a.b@c.de, x@y, +1 (555) 010-2222; 1.2.3.4 and 1.2.3.400; 4111 1111 1111 1111; 4111111111111112; +12"
    assert [(pii.KINDS[k], text[s:e]) for s, k, e in pii.by_rule(text)] == [("email", "a.b@c.de"), ("phone", "+1 (555) 010-2222"), ("ip", "1.2.3.4"), ("card", "4111 1111 1111 1111")]


def test_network_gradient():
    r, net = np.random.default_rng(0), pii.Network.new(1, hidden=3)
    net.p = {k: v.astype(np.float64) for k, v in net.p.items()}
    ids, tags = r.integers(0, pii.VOCABULARY, (6, 4)), r.integers(0, pii.TAGS, (6, 4))
    _, g = net.loss(ids, tags)
    for k, at in (("out", (1, 2)), ("move", (0, 1)), ("hf", (1, 5)), ("hb", (2, 7)), ("xf", (int(ids[2, 1]), 4)), ("xb", (int(ids[3, 2]), 9)), ("bias", (3,))):
        was, d = net.p[k][at], 1e-2
        net.p[k][at] = was + d
        up = net.loss(ids, tags)[0]
        net.p[k][at] = was - d
        down = net.loss(ids, tags)[0]
        net.p[k][at] = was
        assert g[k][at] == pytest.approx((up - down) / (2 * d), rel=0.05, abs=2e-4)


def test_personal_data(spark, tmp_path):
    net = pii.standard()
    made = pii.examples(200, seed=11)
    found = [set(x) for x in pii.by_network(net, [t for t, _ in made])]
    assert sum(len(f & set(s)) for f, (_, s) in zip(found, made)) > 0.7 * sum(len(s) for _, s in made)
    rows = [(1, None, None), (2, "", "s"), (3, "é mail a@b.cd now", "s"), (4, "call 1.2.3.4 " * 2000, "s"), (None, "x", "s")]
    out = {x.doc_id: x for x in pii.find_personal_data(table(spark, rows, str(tmp_path / "t"))).collect()}
    assert out[3].spans == "email:7:13" and out[4].n_ip == 2000 and out[1].spans == out[None].spans == ""


def test_media(docs):
    import hashlib

    text = {i: t or "" for i, t, _ in corpus() if i is not None}
    for x in media.store_media(docs).collect():
        if x.doc_id is not None:
            n, data = media.payload(text[x.doc_id])
            assert (x.n_bytes, x.payload_bytes, x.payload_sha256, x.tail_crc32) == (n, len(data), hashlib.sha256(data).hexdigest(), zlib.crc32(data[-64:]))
            assert x.media_bytes == len(x.media) and x.media_sha256 == hashlib.sha256(x.media).hexdigest()


def test_pipeline(spark, tmp_path):
    import corpus_pipeline as c

    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    for name, stage in c.STAGES:
        out = stage(spark, docs, "/root/testdata/sf0.001")
        if name != "packing":
            assert out.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        out.write.parquet(str(tmp_path / name))
        was, docs = docs, spark.read.parquet(str(tmp_path / name))
        if name == "near":
            rows = [(r.doc_id, r.text) for r in was.collect()]
            assert {r.doc_id for r in docs.collect()} == {i for i, v in brute.near(rows, 5).items() if v[2]}
