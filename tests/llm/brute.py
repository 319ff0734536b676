"""Plain versions that the operators' results are held against."""

import re


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def shingle_set(text, n):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    w = words(low)
    if not w:
        return frozenset()
    return frozenset(tuple(w[i : i + n]) for i in range(max(1, len(w) - n + 1)))


def near(rows, n, similar=80):
    """{doc_id: (size, component, kept)} of (doc_id, text) by comparing all pairs that share a shingle."""
    sets = {i: shingle_set(t, n) for i, t in rows}
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    by = {}
    for i, s in sets.items():
        for x in s:
            by.setdefault(x, []).append(i)
    pairs = {(a, b) for v in by.values() for k, a in enumerate(v) for b in v[k + 1 :]}
    for a, b in pairs:
        both = len(sets[a] & sets[b])
        if 100 * both >= similar * (len(sets[a]) + len(sets[b]) - both):
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
    return {i: (len(s), find(i), find(i) == i) for i, s in sets.items()}
