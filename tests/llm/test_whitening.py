"""Incremental eigendecomposition and whitening against dense linear algebra."""

import numpy as np
import pytest

from tandem.llm.whitening import OFFSET, Spectrum, deviations, op13_incremental_whitening, rank_one, whiten, whitening
from tests.llm.helpers import vectors


def plain(x):
    y = x - x.mean(axis=0)
    return y.T @ y


def close(s, scatter):
    size = max(np.abs(scatter).max(), 1.0)
    assert np.abs(s.vecs.T @ s.vecs - np.eye(len(s.lam))).max() < 1e-12
    assert np.abs((s.vecs * s.lam) @ s.vecs.T - scatter).max() < 1e-12 * size
    assert np.abs(s.lam - np.linalg.eigvalsh(scatter)).max() < 1e-12 * size


def tables():
    rng = np.random.default_rng(7)
    x = np.floor(20 * rng.normal(size=(200, 12)))
    copies = x.copy()
    copies[50:150] = copies[0]                     # copies of one row
    flat = x.copy()
    flat[:, 3], flat[:, 5] = 4, flat[:, 6]         # a constant and a repeated dimension
    axes = np.vstack([np.eye(12), -np.eye(12)])    # all eigenvalues equal
    return {"random": x, "copies": copies, "flat": flat, "axes": axes, "one": x[:1], "two": x[:2],
            "wide": x * np.logspace(0, 6, 12)}


@pytest.mark.parametrize("name", list(tables()))
def test_rank_one_updates(name):
    x = tables()[name]
    s = Spectrum.empty(x.shape[1])
    for row in x:
        s.add(row)
    assert s.m == len(x) and np.allclose(s.mean, x.mean(axis=0))
    close(s, plain(x))


@pytest.mark.parametrize("name", list(tables()))
def test_rows_at_once(name):
    x = tables()[name]
    s = Spectrum.empty(x.shape[1])
    for part in np.array_split(x, 3):
        s.add_rows(part)
    assert s.m == len(x) and np.allclose(s.mean, x.mean(axis=0))
    close(s, plain(x))


@pytest.mark.parametrize("name", list(tables()))
def test_merged_spectra(name):
    x = tables()[name]
    whole = Spectrum.empty(x.shape[1])
    for part in np.array_split(x, 5):
        s = Spectrum.empty(x.shape[1])
        for row in part:
            s.add(row)
        whole.merge(s)
    close(whole, plain(x))


def test_one_update():
    rng = np.random.default_rng(1)
    for _ in range(200):
        k = int(rng.integers(1, 9))
        lam = np.sort(rng.integers(0, 4, size=k).astype(float))      # many equal
        vecs = np.linalg.qr(rng.normal(size=(k, k)))[0]
        v = rng.normal(size=k) * (rng.random(k) < 0.7)               # many zero
        rho = float(rng.random() * 3)
        l2, u2 = rank_one(lam, vecs, rho, v)
        want = (vecs * lam) @ vecs.T + rho * np.outer(v, v)
        assert np.abs((u2 * l2) @ u2.T - want).max() < 1e-12 and (np.diff(l2) >= 0).all()


def check(spark, rows, dim, components=32):
    kept = [(i, v) for i, v, _ in rows if v is not None and len(v) == dim and all(c is not None and np.isfinite(c) for c in v)]
    x = np.floor(64 * np.array([v for _, v in kept], dtype=np.float32).astype(np.float64)).astype(np.int64) + OFFSET
    n, z = len(x), len(x) * x - x.sum(axis=0)
    cov = (z / n).T @ (z / n) / n
    values, vecs = (a[..., ::-1] for a in np.linalg.eigh(cov))
    k = min(components, int((values > 1e-11 * values[0]).sum()))
    got = whiten(vectors(spark, rows), components=components).toPandas()
    assert len(got) == n * k
    want = (z / n) @ vecs[:, :k] / np.sqrt(values[:k])
    by = got.pivot_table(index="id", columns="component", values="whitened", dropna=False)
    sign = np.sign((want * by.loc[[i for i, _ in kept]].to_numpy()).sum(axis=0))
    assert np.abs(by.loc[[i for i, _ in kept]].to_numpy() * sign - want).max() < 1e-8
    one = got[got.component == 1].set_index("id")
    assert [one.deviation[i] for i, _ in kept] == [int((r * r).sum()) for r in z]
    assert set(got.n) == {n} and got.identity_error.nunique() == 1 and got.identity_error.iloc[0] < 1e-8
    for c in range(k):
        assert abs(got[got.component == c + 1].explained.iloc[0] / (values[c] / values.sum()) - 1) < 1e-9


def test_whole_table(spark):
    rng = np.random.default_rng(3)
    rows = [(i, (rng.normal(size=40) * np.linspace(0.2, 2, 40)).tolist(), 1) for i in range(300)]
    rows += [(1000 + i, rows[0][1], 1) for i in range(80)]
    check(spark, rows, 40)


def test_dropped_rows_and_flat_dimensions(spark):
    rng = np.random.default_rng(4)
    rows = [(i, [*rng.normal(size=4).tolist(), 2.0], None) for i in range(50)]
    rows += [(100, None, 1), (101, [], 1), (102, [1, None, 0, 0, 0], 1), (103, [float("nan"), 0, 0, 0, 0], 1),
             (104, [float("inf"), 0, 0, 0, 0], 1), (105, [1, 2, 3], 1)]
    check(spark, rows, 5)
    check(spark, rows, 5, components=2)


def test_partitions_do_not_matter(spark):
    rng = np.random.default_rng(5)
    rows = [(i, rng.normal(size=6).tolist(), 1) for i in range(120)]
    df = vectors(spark, rows)
    a, b = whitening(df.repartition(1)), whitening(df.repartition(23), fan_in=3)
    assert a.total == b.total and np.allclose(a.values, b.values, rtol=1e-13)
    assert np.allclose(np.abs((a.vecs * b.vecs).sum(axis=0)), 1.0, atol=1e-12)


def test_nothing_to_whiten(spark):
    for rows in ([], [(1, None, 1)], [(1, [1.0, 2.0], 1)], [(1, [1.0, 2.0], 1)] * 3):
        got = whiten(vectors(spark, rows))
        assert got.count() == 0 and got.columns[:3] == ["id", "component", "n"]


def test_repeated_and_null_ids(spark):
    rng = np.random.default_rng(6)
    rows = [(7 if i % 2 else None, rng.normal(size=3).tolist(), 1) for i in range(20)]
    got = whiten(vectors(spark, rows)).toPandas()
    assert len(got) == 60 and got.id.isna().sum() == 30


def test_deviation_beyond_a_long():
    assert deviations(np.array([[3_000_000_000, 1], [4, 5]])) == [9_000_000_000_000_000_001, 41]
    assert deviations(np.array([[3_100_000_000, 1], [4, 5]])) == [None, 41]


def test_query_columns(spark, tmp_path):
    rng = np.random.default_rng(9)
    spark.createDataFrame([(i, rng.normal(size=64).tolist(), 1) for i in range(100)],
                          "vec_id long, embedding array<float>, label int").write.parquet(str(tmp_path / "embeddings.parquet"))
    got = op13_incremental_whitening(spark, str(tmp_path))
    assert got.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    assert got.count() == 3200
