"""The metric range join against all pairs."""

import random

import duckdb
import numpy as np
import pytest

from tandem.llm.range_join import (OP11_SQL, choose_pivots, distances, group_roots, near_duplicates,
                                   op11_metric_range_join, unit, visits)
from tests.llm.helpers import vectors


def brute(rows, threshold=0.98):
    """Row number -> (n_links, component id) by all pairs."""
    def good(v, g):
        return g is not None and v and all(c is not None and np.isfinite(np.float32(c)) for c in v) and any(v)
    units = [unit(np.array([np.float32(v)], dtype=np.float64))[0] if good(v, g) else None for _, v, g in rows]
    links = [set() for _ in rows]
    for a in range(len(rows)):
        for b in range(a):
            if (units[a] is not None and units[b] is not None and rows[a][2] == rows[b][2]
                    and len(units[a]) == len(units[b]) and float(units[a] @ units[b]) >= threshold):
                links[a].add(b)
                links[b].add(a)
    out = []
    for a in range(len(rows)):
        seen, todo = {a}, [a]
        while todo:
            for b in links[todo.pop()] - seen:
                seen.add(b)
                todo.append(b)
        ids = [rows[i][0] for i in seen if rows[i][0] is not None]
        out.append((rows[a][0], len(links[a]), min(ids) if ids else None))
    return out


def check(spark, rows, **params):
    got = near_duplicates(vectors(spark, rows), **params).collect()
    key = lambda t: tuple((x is None, x or 0) for x in t)
    assert sorted(((r.id, r.n_links, r.component_id) for r in got), key=key) == sorted(brute(rows), key=key)
    assert all(r.kept == (r.id == r.component_id) for r in got)


def cloud(rnd, n, dim=8, labels=(1, 2), first=0):
    """Random vectors, chains of near copies and one dense group of near copies."""
    rows = []
    base = [rnd.gauss(0, 1) for _ in range(dim)]
    for i in range(n):
        kind = rnd.random()
        if kind < 0.35:                                   # dense group round one vector
            v = [c + rnd.gauss(0, 0.12) for c in base]
        elif kind < 0.6 and rows:                         # a step from an earlier one: chains
            v = [c + rnd.gauss(0, 0.06) for c in rnd.choice(rows)[1]]
        elif kind < 0.7 and rows:                         # an exact copy
            v = list(rnd.choice(rows)[1])
        elif kind < 0.75 and rows:                        # another length of the same direction
            v = [c * 7.5 for c in rnd.choice(rows)[1]]
        else:
            v = [rnd.gauss(0, 1) for _ in range(dim)]
        rows.append((first + i, v, rnd.choice(labels)))
    return rows


@pytest.mark.parametrize("params", [{}, {"cell_rows": 5, "block": 7}])
def test_all_pairs(spark, params):
    check(spark, cloud(random.Random(3), 220), **params)


def test_edge_cases(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, None, 1), (2, [], 1), (3, [0, 0], 1), (4, [1, None], 1), (5, [nan, 1], 1), (6, [inf, 1], 1),
            (7, [1, 2], None), (8, [1, 2], 1), (9, [2, 4], 1), (10, [1, 2], 2), (11, [1, 2, 0], 1),
            (11, [1, 2, 0], 1),                               # a repeated row: a vector of its own
            (None, [1, 2.001], 1), (None, [5, -1], 3),        # null ids
            (12, [-1, -2], 1), (13, [1e30, 2e30], 1), (14, [1e-38, 2e-38], 1), (15, [-0.0, 1], 4), (16, [0.0, 1], 4)]
    check(spark, rows)
    check(spark, rows, cell_rows=1, block=2)


def test_empty(spark):
    got = near_duplicates(vectors(spark, []))
    assert got.columns == ["id", "n_links", "component_id", "kept"] and got.count() == 0


def test_bounds_lose_no_pair():
    """Any two points within r meet in the cell of the lower-numbered home."""
    rng = np.random.default_rng(4)
    x = unit(np.vstack([rng.normal(size=(300, 5)), rng.normal(size=(1, 5)) + 0.05 * rng.normal(size=(100, 5))]))
    r = 0.5
    pivots = choose_pivots(list(x), 12, 0.6)
    assert len(pivots) == 12
    dist = distances(x, pivots)
    own = dist.argmin(axis=1)
    low = np.array([dist[own == q, q].min() for q in range(12)])
    high = np.array([dist[own == q, q].max() for q in range(12)])
    own, go = visits(dist, distances(pivots, pivots), low, high, r)
    near = distances(x, x) <= r
    for a, b in zip(*np.nonzero(np.triu(near, 1))):
        a, b = (a, b) if own[a] >= own[b] else (b, a)
        assert own[a] == own[b] or go[a, own[b]]
    assert go.sum() < 0.7 * (own.sum())  # the bounds keep rows out


def test_dense_cell_is_cut(spark):
    """A group of near copies, far above a block: links stay whole, rows out follow the items."""
    rng = np.random.default_rng(1)
    rows = [(i, (np.ones(6) + 0.02 * rng.normal(size=6)).tolist(), 1) for i in range(400)]
    got = near_duplicates(vectors(spark, rows), block=50).collect()
    assert {r.n_links for r in got} == {399} and {r.component_id for r in got} == {0}


def test_group_roots():
    a = np.zeros((5, 5), dtype=bool)
    a[0, 3] = a[3, 0] = a[3, 4] = a[4, 3] = True
    assert group_roots(a).tolist() == [0, -1, -1, 0, 0]


def test_query_matches_sql(spark, tmp_path):
    rows = cloud(random.Random(8), 150, dim=64, labels=(1, 2, None))
    rows += [(900, None, 1), (901, [1.0] * 63, 1), (902, [0.0] * 64, 1), (903, [None] + [1.0] * 63, 1)]
    spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").write.parquet(str(tmp_path / "embeddings.parquet"))
    got = {tuple(r) for r in op11_metric_range_join(spark, str(tmp_path)).select("vec_id", "n_links", "component_id", "kept").collect()}
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{tmp_path}/embeddings.parquet/*.parquet'")
    assert got == set(con.execute(OP11_SQL).fetchall())
    assert any(n for _, n, _, _ in got)
