"""Zone-map clustering against plain integer k-means and SQL."""

import hashlib
import math

import duckdb
import numpy as np
import pytest

from tandem.llm.zone_maps import OP12_SQL, candidates, cluster, hilbert_keys, nearest, op12_hilbert_zone_clusters
from tests.llm.helpers import vectors


def brute(rows, dim, k=16, rounds=3):
    kept = []
    for i, v, _ in rows:
        if v is not None and len(v) == dim and all(c is not None and math.isfinite(np.float32(c)) for c in v):
            x = [max(-2**27, min(2**27, math.floor(64 * float(np.float32(c))))) for c in v]
            kept.append((hashlib.sha256(f"1:{'' if i is None else i}".encode()).hexdigest(), x, i))
    centroids = [x for _, x, _ in sorted(kept, key=lambda t: t[:2])[:k]]

    def assign():
        return [min((sum((a - b) ** 2 for a, b in zip(x, c)), j) for j, c in enumerate(centroids)) for _, x, _ in kept]

    for _ in range(rounds):
        got = assign()
        for j in range(len(centroids)):
            own = [x for (_, x, _), (_, g) in zip(kept, got) if g == j]
            if own:
                centroids[j] = [sum(col) // len(own) for col in zip(*own)]
    return [(i, g, dist) for (_, _, i), (dist, g) in zip(kept, assign())], centroids


def clumps(seed, n, dim, spread=0.02):
    rng = np.random.default_rng(seed)
    middles = rng.normal(size=(6, dim))
    return [(i, (middles[i % 6] + spread * rng.normal(size=dim)).tolist(), None) for i in range(n)]


def same(spark, rows, dim, **params):
    out, centroids, shares = cluster(vectors(spark, rows), dim=dim, **params)
    want, middle = brute(rows, dim)
    key = lambda t: (t[0] is None, t[0] or 0, *t[1:])
    assert sorted(map(tuple, out.collect()), key=key) == sorted(want, key=key)
    assert centroids.tolist() == middle
    return shares


def test_clumps_are_pruned(spark):
    shares = same(spark, clumps(1, 400, 8), 8, block=16)
    assert max(shares) < 0.8


def test_random_and_copies(spark):
    rng = np.random.default_rng(2)
    rows = [(i, rng.normal(size=8).tolist(), 1) for i in range(150)]
    rows += [(1000 + i, rows[0][1], 1) for i in range(150)]      # a third and more are one vector
    same(spark, rows, 8, block=32)


def test_edge_cases(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, None, 1), (2, [], 1), (3, [1, 2, 3], 1), (4, [1, None], 1), (5, [nan, 0], 1), (6, [inf, 0], 1),
            (7, [0, 0], None), (8, [-0.001, 0.001], 1), (8, [-0.001, 0.001], 1), (8, [3, 4], 1), (None, [1, 1], 1),
            (None, [1, 1], 1), (9, [1e9, -1e9], 1), (10, [3e5, 1], 1), (11, [1e-30, -1e-30], 1)]
    same(spark, rows, 2)                                         # fewer rows than centroids
    same(spark, rows + [(20 + i, [i % 5, i % 3], 1) for i in range(40)], 2, block=4)


def test_empty(spark):
    out, centroids, shares = cluster(vectors(spark, [(1, None, 1)]))
    assert out.columns == ["id", "cluster", "distance"] and out.count() == 0 and not len(centroids) and not shares


@pytest.mark.parametrize("dims,bits", [(2, 3), (3, 2), (4, 2)])
def test_hilbert_curve_is_a_path(dims, bits):
    """Every cell once, and each step moves one axis by one."""
    grid = np.stack(np.meshgrid(*[np.arange(1 << bits)] * dims, indexing="ij"), axis=-1).reshape(-1, dims)
    padded = [int.from_bytes(k, "big") for k in hilbert_keys(grid, bits)]
    assert len(set(padded)) == len(grid)
    path = grid[np.argsort(padded)]
    assert (np.abs(np.diff(path, axis=0)).sum(axis=1) == 1).all()


def test_box_bounds_keep_the_nearest():
    rng = np.random.default_rng(3)
    for _ in range(300):
        c = rng.integers(-40, 40, size=(9, 4))
        x = rng.integers(-40, 40, size=4) + rng.integers(0, int(rng.integers(1, 30)) + 1, size=(12, 4))
        near = candidates(x.min(axis=0), x.max(axis=0), c)
        assert set(nearest(x, c)[0]) <= set(near)
        best, dist = nearest(x, c[near])
        assert (near[best] == nearest(x, c)[0]).all() and (dist == nearest(x, c)[1]).all()


def test_large_integers_are_exact():
    c = np.array([[1 << 27, 0], [(1 << 27) - 1, 1]])
    x = np.array([[-(1 << 27), 1], [-(1 << 27), 0]])
    want = [[sum((int(a) - int(b)) ** 2 for a, b in zip(r, m)) for m in c] for r in x]
    best, dist = nearest(x, c)
    assert dist.tolist() == [min(w) for w in want] and best.tolist() == [w.index(min(w)) for w in want]


def test_query_matches_sql(spark, tmp_path):
    rows = clumps(5, 120, 64, spread=0.3) + [(500, None, 1), (501, [1.0] * 63, 1), (502, [None] + [1.0] * 63, 1)]
    rows += [(600 + i, rows[3][1], 2) for i in range(30)]
    spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").write.parquet(str(tmp_path / "embeddings.parquet"))
    names = ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    got = {tuple(r) for r in op12_hilbert_zone_clusters(spark, str(tmp_path)).select(*names).collect()}
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{tmp_path}/embeddings.parquet/*.parquet'")
    assert got == set(con.execute(f"SELECT {', '.join(names)} FROM ({OP12_SQL})").fetchall())
