"""Secrets against plain patterns over whole texts, and entropies against plain counts of every window."""

import hashlib
import math
import random
import re
from collections import Counter

from hypothesis import given, settings
from hypothesis import strategies as st

from kindred.llm import secret_scan
from kindred.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"
BASE = (
    r"""((?:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    "AKIA[A-Z0-9]+",
    "[0-9a-f]+",
)


def plain_base(text):
    out = [(m.start(), 0, m.end()) for m in re.finditer(BASE[0], text, re.I | re.A) if len(m[2]) >= 6]
    out += [(m.start(), 1, m.end()) for m in re.finditer(BASE[1], text) if len(m[0]) >= 20]
    return sorted(out + [(m.start(), 2, m.end()) for m in re.finditer(BASE[2], text) if len(m[0]) >= 24])


def bits(s):
    return -sum(c / len(s) * math.log2(c / len(s)) for c in Counter(s).values())


def plain_added(text, base):
    """Places of hot windows, grown over letters and digits; entropy is counted anew for each window."""
    hot, allowed = set(), re.compile("|".join(p.decode() for p in secret_scan.ALLOWED))
    plain = [m.span() for f in re.finditer("[A-Za-z0-9+/_=-]+", text) for m in re.compile(allowed.pattern).finditer(text, f.start(), f.end())]
    kinds = {k: v.decode() for k, v in secret_scan._KINDS.items()}
    for c in secret_scan.CLASSES:
        own = c.characters.decode()
        for a in range(len(text) - c.window + 1):
            w = text[a : a + c.window]
            if all(x in own for x in w) and bits(w) >= c.bits - 1e-9 and all(any(x in kinds[k] for x in w) for k in c.mixes) and not any(a < y and x < a + c.window for x, y in plain):
                hot |= set(range(a, a + c.window))
    is_word = lambda i: 0 <= i < len(text) and re.fullmatch("[A-Za-z0-9]", text[i])
    for step in (1, -1):
        for i in sorted(hot, reverse=step < 0):
            while is_word(i + step):
                hot.add(i := i + step)
    edges = [(i, "s") for i in sorted(hot) if i - 1 not in hot]
    spans = [(i, next(j for j in range(i, len(text) + 1) if j not in hot)) for i, _ in edges]
    return [(s, 3, e) for s, e in spans if not any(s < y and x < e for x, _, y in base)]


def found(text):
    raw = text.encode("utf-8")
    base = secret_scan.by_rule(raw)
    return secret_scan.in_points(raw, base), secret_scan.in_points(raw, secret_scan.apart(base, secret_scan.Scanner().spans(raw)))


MADE = st.lists(st.one_of(st.sampled_from(["token", "PassWord", "api_key", "ApiKey", "secret", "ſecret", "toKen", " = ", ":", "\"", "'", "=", "AKIA", "é", " ", "\n", "0123456789", "-", "/"]), st.text("ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789", max_size=26), st.text("0123456789abcdef", max_size=40), st.text("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/_=-", max_size=45)), max_size=12)


@settings(max_examples=300, deadline=None)
@given(MADE)
def test_spans_are_the_plain_ones(parts):
    text = "".join(parts)
    base, added = found(text)
    assert base == plain_base(text) and added == plain_added(text, base)


def keys(r):
    full = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
    return [
        "".join(r.choice(full + "+/") for _ in range(40)), "".join(r.choice("0123456789ABCDEF") for _ in range(32)), "ghp_" + "".join(r.choice(full) for _ in range(36)),
        "".join(r.choice("abcdefghijklmnopqrstuvwxyz0123456789") for _ in range(32)), "xoxb-" + "".join(r.choice(full) for _ in range(24)),
    ]


def test_keys_that_no_rule_knows():
    r, n, hit, whole = random.Random(2), 0, 0, 0
    for _ in range(200):
        for key in keys(r):
            if plain_base(key):
                continue
            text = f"é look at {key}, and at home."
            base, added = found(text)
            n, hit, whole = n + 1, hit + bool(added), whole + any(text[s:e].endswith(key[-20:]) for s, _, e in added)
            assert not base
    assert hit >= 0.98 * n and whole >= 0.95 * n


def test_what_is_no_secret():
    for text in (
        "123e4567-e89b-12d3-a456-426614174000", "2024-01-02T03:04:05", "sha256-47DEQpj8HBSa+/TImW+5JCeuQeRkm5NMpJWZG3hSuFU=", "abcdefghijklmnopqrstuvwxyz0123456789", "Geschwindigkeitsbegrenzungen", "4111-1111-1111-1111-1111",
        "https://www.example.com/some/long/path-of-words/2024/01/02/index.html", "first.last@some-longer-domain-name.example.com", "ThisIsAVeryLongClassNameForATest", "state-of-the-art-and-then-some-more", "wJalrXUtnFEMI/K7MDENG/bPxRfiCYEXAMPLEKEY", "__________________________", "10000000000000000000000",
    ):
        assert found(text) == ([], []), text


def test_query_on_hard_rows(spark, tmp_path):
    r = random.Random(3)
    key = keys(r)[0]
    long = " ".join(["wort"] * 60_000) + f" token: {key}\n{key} ä " + "0a1b2c" * 5
    rows = [(1, None), (2, ""), (3, "é" * 5 + " token = abcdef " + key), (3, "twice"), (None, f"AKIA{'A' * 16} {key}"), (4, long), (5, key * 400), (6, f"PASSWORD='x{key}'")]
    spark.createDataFrame([(i, t, "x", "x", "x") for i, t in rows], "doc_id bigint, text string, spans string, n_hex string, base string").repartition(2).write.parquet(str(tmp_path / "d"))
    out = secret_scan.find_secrets(spark.read.parquet(str(tmp_path / "d")))
    got = Counter(map(tuple, out.select("doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans").collect()))
    want = Counter()
    for i, t in rows:
        base, added = plain_base(t or ""), found(t or "")[1]
        if len(t or "") < 1000:
            assert added == plain_added(t or "", base)
        write = lambda x: ",".join(f"{('assign', 'access', 'hex', 'entropy')[k]}:{s}:{e}" for s, k, e in x)
        want[i, *(sum(k == n for _, k, _ in base) for n in range(3)), hashlib.sha256(write(base).encode()).hexdigest(), write(sorted(base + added))] += 1
    assert got == want
    assert secret_scan.find_secrets(spark.createDataFrame([], "doc_id bigint, text string")).count() == 0


def test_query_on_whole_tables(spark):
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()}
    seen = 0
    for r in QUERIES["op12_find_secrets"](spark, SF).collect():
        base = plain_base(texts[r.doc_id])
        seen += len(base)
        spans = {tuple(x.split(":")) for x in r.spans.split(",") if x}
        assert {(("assign", "access", "hex")[k], str(s), str(e)) for s, k, e in base} <= spans and len(spans) == len(base) + r.n_added
        assert (r.n_assign, r.n_access, r.n_hex) == tuple(sum(k == n for _, k, _ in base) for n in range(3))
    assert seen
