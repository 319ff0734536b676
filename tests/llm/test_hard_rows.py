"""Rows that repeat an id or have none, hot sources, balance, and whole tables against plain versions."""

import hashlib
import random
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from kindred.llm import attribution, exact_dedup, media, mixing, near_dup, packing, passages, pii, quality, sharding, tokens
from kindred.llm.queries import ORACLE_SQL, QUERIES

SF = "/root/testdata/sf0.01"


def saved(spark, rows, at, schema="doc_id bigint, text string, source string"):
    spark.createDataFrame(rows, schema).repartition(3).write.parquet(str(at))
    return spark.read.parquet(str(at))


@pytest.fixture(scope="module")
def texts(spark):
    return {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()}


@pytest.mark.parametrize("ids, same", [("null", False), ("one", False), ("one", True), ("null", True)])
@pytest.mark.parametrize("many", [False, True])
def test_mix_of_repeated_ids(spark, tmp_path, monkeypatch, ids, same, many):
    """The words taken come within one document of the target, whatever the ids and texts."""
    if many:
        monkeypatch.setattr(mixing, "BROADCAST_SOURCES", 0)
    r = random.Random(1)
    rows = [(None if ids == "null" else 5, "a b c" if same else " ".join("w" for _ in range(1 + r.randrange(20))) + f" {i}", "s0" if i % 3 else f"s{i % 4}") for i in range(300)]
    docs = saved(spark, rows, tmp_path / "t")
    out = mixing.mix_sources(docs).collect()
    by = {}
    for x in out:
        t, big = by.get((x.source_size, x.target), (0, 0))
        by[x.source_size, x.target] = t + x.taken, max(big, x["size"])
    assert len(out) == 300 and all(target - big < taken <= target + 1e-6 for (_, target), (taken, big) in by.items())
    assert mixing.take_mix(docs).count() == sum(x.copies for x in out)


def test_one_row_of_an_id_is_learned_from(spark, tmp_path):
    """An id that nearly all rows have is one row of the training sample."""
    train_ids = [i for i in range(400) if zlib.crc32(str(i).encode()) % 3 != 1]
    rows = [(i, "good words here" if i % 2 else "BAD!! BAD!!", "s") for i in train_ids] + [(train_ids[0], f"copy {k}", "s") for k in range(3000)]
    docs = saved(spark, rows, tmp_path / "t")
    labels = spark.createDataFrame([(i, i % 2) for i in train_ids], "doc_id bigint, quality int")
    seen, fit = [], quality.fit
    quality.fit = lambda x, y, **k: seen.append(len(y)) or fit(x, y, **k)
    try:
        quality.train(docs, labels)
    finally:
        quality.fit = fit
    assert seen == [len(train_ids)]


@pytest.mark.parametrize("hot", [False, True])
def test_exact_with_nulls(spark, tmp_path, hot):
    rows = [(None if i % 5 == 0 else i % 90, None if i % 7 == 0 else f"t {' ' * (i % 3)}{0 if hot else i % 30}", "s") for i in range(400)]
    out = exact_dedup.exact_duplicates(saved(spark, rows, tmp_path / "t")).collect()
    key = lambda t: re.sub(r"[\x20\x09-\x0D]+", " ", t or "")
    groups = {}
    for i, t, _ in rows:
        groups.setdefault(hashlib.sha256(key(t).encode()).hexdigest(), []).append(i)
    want = Counter((i, min((j for j in v if j is not None), default=None), len(v), h) for h, v in groups.items() for i in v)
    assert Counter((x.doc_id, x.keep_id, x.group_size, x.text_sha256) for x in out) == want
    kept = [x for x in out if x.kept]
    assert len(kept) == len(groups) and all(x.doc_id == x.keep_id for x in kept)


def test_shards_are_balanced(spark, texts):
    """Near what longest-first gives all groups at once."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = sharding.shard_documents(docs).collect()
    load = np.zeros(24, np.int64)
    for x in out:
        load[x.shard] += x["size"]
    groups = Counter()
    for t in texts.values():
        groups[t] += len(t.encode()) + 8
    best = Counter()
    for name, s in sharding.lpt([(n, t) for t, n in groups.items()], 24).items():
        best[s] += groups[name]
    assert max(load) <= 1.01 * max(best.values()) and min(load) >= 0.99 * min(best.values())


def test_ids_of_all_documents(texts):
    """Against the vocabulary's own tokenizer, on all texts and on made ones."""
    encode, own = tokens.load(tokens.folder(), "byte_bpe_50k"), Tokenizer.from_file(f"{tokens.folder()}/byte_bpe_50k.json")
    r = random.Random(3)
    made = ["".join(r.choice("ab  \n\t'é1.,<|>-ß€日  A") for _ in range(r.randrange(60))) for _ in range(3000)]
    for t in [*texts.values(), *made]:
        assert encode(t).tolist() == own.encode(t, add_special_tokens=False).ids


def plain_rules(text):
    """The patterns as they are stated."""
    kinds = (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", r"[0-9]([\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]")
    out = []
    for k, p in enumerate(kinds):
        for m in re.finditer(p, text):
            d = [int(c) for c in m[0] if c in "0123456789"]
            if k == 1 and any(int(x) > 255 for x in m[0].split(".")) or k == 3 and not 10 <= len(d) <= 15:
                continue
            if k == 2 and not (14 <= len(d) <= 19 and sum(v if i % 2 == 0 else v * 2 - 9 * (v > 4) for i, v in enumerate(reversed(d))) % 10 == 0):
                continue
            out.append((m.start(), k, m.end()))
    return sorted(out)


def test_rules_against_plain_patterns(texts):
    r = random.Random(4)
    made = ["".join(r.choice("0123456789 .-+@()ab_%é") for _ in range(r.randrange(40))) for _ in range(40_000)]
    assert all(pii.by_rule(t) == plain_rules(t) for t in [*made, *texts.values()])


@pytest.fixture(scope="module")
def network(texts):
    """Trained on the windows of half of the documents."""
    own = {}
    for i, t in texts.items():
        if i % 2:
            own |= {w[0]: w[1] for m in pii.SIGN.finditer(t) if (w := pii.shaped(t, m.start()))}
    return pii.trained(list(own.items())[: pii.SAMPLE])


def test_network_on_held_out_documents(texts, network):
    """It finds what the rules find, nearly all and nearly nothing else, and numbers side by side, which rules miss."""
    held = [t for i, t in texts.items() if i % 2 == 0]
    base, found = [set(pii.by_rule(t)) for t in held], [set(x) for x in pii.by_network(network, held)]
    both = sum(len(a & b) for a, b in zip(base, found))
    assert both >= 0.8 * sum(map(len, base))
    added = [(t, x) for t, a, b in zip(held, base, found) for x in set(pii.settle(sorted(a), sorted(b))) - a]
    assert len(added) <= 0.2 * both
    card = "4465758382889437"
    text = f"un {card} {card} the"
    assert pii.by_rule(text) == [] and pii.settle([], pii.by_network(network, [text])[0]) == [(3, 2, 19), (20, 2, 36)]


def test_network_on_other_forms(network):
    made = pii.examples(400, seed=99)
    found = [set(x) for x in pii.by_network(network, [t for t, _ in made])]
    missed = [set(s) - set(pii.by_rule(t)) for t, s in made]
    hit = sum(len(m & f) for m, f in zip(missed, found))
    assert hit >= 0.3 * sum(map(len, missed)) and sum(len(f & set(s)) for f, (_, s) in zip(found, made)) >= 0.8 * sum(map(len, found))


def test_a_lattice_decodes_long_spans_once(network):
    """A span over the border of windows is one span, also far into a text."""
    for lead in range(30, 120, 7):
        text = "word " * 40 + "so " * (lead // 3) + "mail an.on@example.com now " + "word " * 40
        at = text.index("an.on")
        assert (at, 0, at + 17) in pii.by_network(network, [text])[0]


def test_media_of_all_documents(spark, texts):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for x in media.store_media(docs).collect():
        raw = texts[x.doc_id].encode()
        want = raw + bytes(-len(raw) % 64 if raw else 64)
        assert (x.n_bytes, x.payload_bytes, x.payload_sha256, x.tail_crc32) == (len(raw), len(want), hashlib.sha256(want).hexdigest(), zlib.crc32(want[-64:]))
        assert x.media_sha256 == hashlib.sha256(x.media).hexdigest() and x.media_bytes == len(x.media)


def test_null_ids_are_kept(spark, tmp_path):
    rows = [(None, "one two", "s"), (None, "one two", "s"), (1, "a\nb", "s"), (1, "a\nb", "s"), (None, None, None)]
    docs = saved(spark, rows, tmp_path / "t")
    assert sorted((str(x.doc_id), x.section, x.n_tokens) for x in attribution.section_tokens(docs).collect()) == sorted([("None", 0, 2)] * 2 + [("None", 0, 0)] + [("1", 0, 2), ("1", 1, 1)] * 2)
    pieces = packing.pack_documents(docs).collect()
    assert Counter(str(x.doc_id) for x in pieces) == {"None": 3, "1": 2} and sum(x.length for x in pieces) == 3 + 3 + 4 + 4 + 1
    near = near_dup.near_duplicates(docs).collect()
    assert Counter((x.doc_id, x.component_id) for x in near) == {(None, None): 3, (1, 1): 2}


def test_passages_against_all_windows(spark, tmp_path):
    """Nearly all words of 50 in a row that two texts share lie in passages, long repeats of few words among them."""
    r = random.Random(6)
    words = lambda n, k=400: [f"w{r.randrange(k)}" for _ in range(n)]
    shared = [words(60), words(200), ("ha " * 300).split(), (" ".join(words(12)) + " ").split() * 20, words(90, 30)]
    rows = []
    for i in range(80):
        own = words(60 + r.randrange(100))
        for s in r.sample(shared, r.randrange(3)):
            a = r.randrange(max(1, len(s) - 55))
            own[r.randrange(len(own)) : 0] = s[a : a + 50 + r.randrange(len(s))]
        rows.append((i, " ".join(own), "s"))
    spark.createDataFrame(rows, "doc_id bigint, text string, source string").coalesce(1).write.parquet(str(tmp_path / "t"))
    out = passages.repeated_passages(spark.read.parquet(str(tmp_path / "t"))).collect()
    covered = {}
    for x in out:
        covered.setdefault(x.doc_id, set()).update(range(x.start_word, x.end_word))
    seen, want = {}, {}
    for i, text, _ in rows:
        w = text.split()
        grams = {tuple(w[k : k + 50]): k for k in range(len(w) - 49)}
        for k in range(len(w) - 49):
            if seen.get(tuple(w[k : k + 50]), i) != i:
                want.setdefault(i, set()).update(range(k, k + 50))
        for g in grams:
            seen.setdefault(g, i)
    total = sum(map(len, want.values()))
    assert sum(len(v & covered.get(i, set())) for i, v in want.items()) >= 0.95 * total
    assert len(set(want) - set(covered)) <= 0.05 * len(want)


def test_words_in_common():
    r = random.Random(5)
    for _ in range(60):
        a, b = ([r.randrange(6) for _ in range(r.randrange(90))] for _ in range(2))
        row = [0] * (len(b) + 1)
        for v in a:
            row = [0] + [max(row[j + 1], row[j] + (v == w)) for j, w in enumerate(b)] if not b else _step(row, v, b)
        assert passages.common(np.array(a), np.array(b)) == row[-1]


def _step(row, v, b):
    out = [0]
    for j, w in enumerate(b):
        out.append(max(out[-1], row[j + 1], row[j] + (v == w)))
    return out


def test_a_shared_folder_is_asked_for(spark, monkeypatch):
    from kindred.sources import tables

    class Elsewhere:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        class conf:
            get = staticmethod(lambda *_: None)

        sparkContext = Elsewhere()

    with pytest.raises(ValueError):
        tables.shared_folder(Session())


def test_hot_keys_meet_their_rows(spark, tmp_path):
    """A join by key is the same whichever keys are hot."""
    left = spark.range(500).select((F.col("id") % 7 * (F.col("id") % 3)).alias("k"), F.col("id").alias("v"))
    right = spark.range(20).select(F.col("id").alias("k"), F.concat(F.lit("r"), "id").alias("w"))
    want = Counter(map(tuple, left.join(right, "k").select("k", "v", "w").collect()))
    for most in (0, 1 << 26):
        passages.BROADCAST_BYTES, was = most, passages.BROADCAST_BYTES
        try:
            got = passages._by_key(left, right, ["k"], F.lit(8)).select("k", "v", "w").collect()
        finally:
            passages.BROADCAST_BYTES = was
        assert Counter(map(tuple, got)) == want


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_queries_against_their_sql(spark, name):
    con = duckdb.connect()
    at = "/root/testdata/sf0.001"
    con.execute(f"create view documents as select * from read_parquet('{at}/documents.parquet')")
    want = con.execute(ORACLE_SQL[name])
    columns = sorted(c[0] for c in want.description)
    order = [c[0] for c in want.description]
    got = QUERIES[name](spark, at)
    assert sorted(got.columns) == columns
    assert Counter(map(tuple, got.select(*order).collect())) == Counter(want.fetchall())
