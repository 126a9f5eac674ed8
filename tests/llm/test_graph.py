"""Components and bucket linking against plain Python."""

import random

from tandem.llm.graph import connected_components


def components(edges):
    parent = {}
    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x
    for u, v in edges:
        a, b = find(u), find(v)
        parent[max(a, b)] = min(a, b)
    return {x: find(x) for x in parent}


def test_random_graphs_chains_and_stars(spark):
    rnd = random.Random(5)
    edges = [(rnd.randrange(60), rnd.randrange(60)) for _ in range(45)]
    edges += [(1000 + i, 1001 + i) for i in range(40)]            # a chain in id order
    edges += [(5000, 5001 + i) for i in range(200)] + [(5000, 5001)]  # a star, one edge twice
    edges += [(-7, -9), (-9, 2**62)]
    df = spark.createDataFrame([*edges, (None, 3), (4, None)], "u long, v long")
    got = {r.node: r.component for r in connected_components(df).collect()}
    want = {k: v for k, v in components([e for e in edges if e[0] != e[1]]).items()}
    assert got == want


def test_no_edges(spark):
    df = spark.createDataFrame([(1, 1)], "u long, v long")
    assert connected_components(df).count() == 0
