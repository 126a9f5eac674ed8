"""Targets against step-by-step resharing; rounding keeps sums and means."""

import random

import pytest

from tandem.llm import mixing as M
from tests.llm.helpers import documents, edge_rows, space_words

SF = "/root/testdata/sf0.01"


def reshare(sizes, weights=(1, 2, 3)):
    names = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    cap, done, total = {s: 3.0 * sizes[s] for s in names}, {}, float(sum(sizes.values()))
    while True:
        left = [s for s in names if s not in done]
        rest, ws = total - sum(done.values()), sum(w[s] for s in left)
        over = [s for s in left if rest * w[s] / ws > cap[s]]
        if not over:
            return {**done, **{s: rest * w[s] / ws for s in left}}
        done.update({s: cap[s] for s in over})


def test_targets(spark):
    rnd = random.Random(1)
    for sizes in ({"a": 10, "b": 1000, "c": 3, "é": 50, "Z": 7, None: 20}, {"x": 5}, {"x": 0, "y": 0},
                  {f"s{i}": rnd.randrange(1, 10 ** rnd.randrange(1, 6)) for i in range(40)}):
        df = spark.createDataFrame([(s, n) for s, n in sizes.items()], "source string, size long")
        got = {r.source: r.target for r in M.source_targets(df).collect()}
        want = reshare(sizes)
        assert got.keys() == want.keys()
        assert all(got[s] == pytest.approx(want[s], rel=1e-9, abs=1e-9) for s in want)


def test_chain_keeps_words_and_means():
    rnd = random.Random(2)
    size = [rnd.randrange(1, 50) for _ in range(12)]
    p = [rnd.random() for _ in size]
    p[3], p[4] = 0.0, 1.0
    mean, runs = [0.0] * 12, 4000
    for _ in range(runs):
        take, left, lp = M.pivot_chain(size, p, [rnd.random() for _ in size])
        final = [lp if t is None else t for t in take]
        assert sum(a * b for a, b in zip(size, final)) == pytest.approx(sum(a * b for a, b in zip(size, p)))
        assert sum(t is None for t in take) == (left >= 0)
        mean = [m + f / runs for m, f in zip(mean, final)]
    assert all(m == pytest.approx(q, abs=0.04) for m, q in zip(mean, p))


def test_mixture_of_a_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = M.mixture(docs).collect()
    again = M.mixture(docs.repartition(7)).collect()
    assert sorted((r.id, r.copies) for r in rows) == sorted((r.id, r.copies) for r in again)
    text = {r.doc_id: (r.text, r.source) for r in docs.collect()}
    sizes, taken, target, biggest = {}, {}, {}, {}
    for r in rows:
        n, s = len(space_words(text[r.id][0])), text[r.id][1]
        assert r.size == n and 0 <= r.taken == r.copies * n <= 3 * n
        sizes[s] = sizes.get(s, 0) + n
        taken[s] = taken.get(s, 0) + r.taken
        target[s] = r.target
    want = reshare(sizes)
    for s in sizes:
        assert target[s] == pytest.approx(want[s])
        assert abs(taken[s] - target[s]) <= 0.05 * target[s]


def test_mixed_documents_are_repeated(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    want = {r.id: r.copies for r in M.mixture(docs).collect() if r.copies}
    out = M.mix_documents(docs)
    assert out.columns == docs.columns
    assert {r.doc_id: r["count"] for r in out.groupBy("doc_id").count().collect()} == want


def test_edges_of_the_input(spark):
    rows = [(i, t, None, "s" if (i or 0) % 2 else None) for i, t in edge_rows()]
    docs = documents(spark, rows)
    got = M.mixture(docs).collect()
    assert len(got) == len(rows)
    assert all(r.taken == 0 for r in got if r.size == 0) and all(r.taken <= 3 * r.size for r in got)
    total = sum(r.copies for r in got)
    assert M.mix_documents(docs).count() == total
    assert M.mixture(docs.where("false")).count() == 0
    assert all(r.taken == 0 for r in M.mixture(docs.where("text is null")).collect())
