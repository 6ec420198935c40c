import random

from weftline.operators.components import connected_components


def union_find(edges):
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {x: find(x) for x in root}


def test_components_equal_union_find(spark):
    rng = random.Random(13)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(170)] + [(400 + i, 401 + i) for i in range(40)] + [(999, 500 + i) for i in range(30)]
    got = connected_components(spark.createDataFrame([*edges, (5, None), (7, 7)], "src int, dst int"))
    want = {x: c for x, c in union_find([e for e in edges if e[0] != e[1]]).items()}
    assert {r.node: r.component for r in got.collect()} == want


def test_no_edges(spark):
    assert connected_components(spark.createDataFrame([], "src int, dst int")).collect() == []
