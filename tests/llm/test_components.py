"""Components of links against union-find."""

import random

from kindred.llm.near_dup import components


def brute(pairs):
    up = {}

    def top(x):
        while up.setdefault(x, x) != x:
            x = up[x]
        return x

    for a, b in pairs:
        a, b = top(a), top(b)
        up[max(a, b)] = min(a, b)
    return {x: top(x) for x in up}


def test_components(spark):
    r = random.Random(3)
    chain = [(i, i + 1) for i in range(100, 160)]
    star = [(300, i) for i in range(301, 330)]
    some = [(r.randrange(400, 480), r.randrange(400, 480)) for _ in range(50)]
    pairs = [p for p in chain + star + some if p[0] != p[1]]
    pairs = [p if r.random() < 0.5 else p[::-1] for p in pairs] + pairs[:5]
    got = [tuple(x) for x in components(spark.createDataFrame(pairs, "a bigint, b bigint")).collect()]
    assert len(got) == len(dict(got)) and dict(got) == brute(pairs)


def test_no_links(spark):
    assert components(spark.createDataFrame([], "a bigint, b bigint")).collect() == []
