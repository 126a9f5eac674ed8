"""Probabilities add up; scores match a plain trie; base scores match plain counts."""

import math
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tandem.llm import ppm as P
from tandem.llm.common import fold, lower_ascii
from tests.llm.helpers import documents, edge_rows

SF = "/root/testdata/sf0.001"


class PlainTrie:
    """The same model by dictionaries, one byte at a time."""

    def __init__(self, seqs, order, least):
        self.order, self.n, self.all = order, {}, {}
        for s in seqs:
            s = P.END * order + s
            for i in range(order, len(s)):
                for k in range(order + 1):
                    c = s[i - k:i]
                    self.n.setdefault(c, {}).setdefault(s[i], 0)
                    self.n[c][s[i]] += 1
                    self.all[c] = self.all.get(c, 0) + 1
        self.n = {c: {b: x for b, x in d.items() if x >= least} for c, d in self.n.items()}

    def log10(self, seq):
        total, s = 0.0, P.END * self.order + seq
        for i in range(self.order, len(s)):
            gone, p = set(), 0.0
            for k in range(self.order, -1, -1):
                c = s[i - k:i]
                seen = self.n.get(c)
                if not seen:
                    continue
                new = {b: x for b, x in seen.items() if b not in gone}
                pruned = self.all[c] - sum(seen.values())
                weight = sum(new.values()) + len(new) + pruned
                if s[i] in new:
                    p += math.log10(new[s[i]] / weight)
                    break
                if new:
                    p += math.log10((len(new) + pruned) / weight)
                gone |= set(seen)
            else:
                p -= math.log10(256 - len(gone))
            total += p
        return total


@pytest.mark.parametrize("min_share", [0.0, 1e-3])
def test_scores_match_a_plain_trie(spark, min_share):
    texts = [r.text for r in spark.read.parquet(f"{SF}/documents.parquet").where("length(text) < 900").limit(12).collect()]
    train, rest = texts[:9], [*texts[9:], "", "ab qqq zzz \x01", None]
    model = P.train_ppm(documents(spark, list(enumerate(train))), order=3, min_share=min_share)
    seqs = [P.sequence((t or "").encode()) for t in train]
    n = sum(map(len, seqs))
    plain = PlainTrie(seqs, 3, max(1, math.ceil(min_share * n)))
    scorer = model.scorer()
    want = [plain.log10(P.sequence((t or "").encode())) for t in texts + rest]
    got = scorer.texts([P.sequence((t or "").encode()) for t in texts + rest])
    assert got == pytest.approx(want, rel=1e-9)
    for context in (b"\n\n\n", b"the", b"zqx", b" de"):
        g = np.array([(int.from_bytes(context, "big") << 8) | b for b in range(256)], dtype=np.uint64)
        assert (10 ** scorer.log10(g)).sum() == pytest.approx(1.0)


def test_model_size_is_bounded_by_the_share(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = P.train_ppm(docs, order=4, min_share=1e-3)
    assert all(len(g) <= 1000 for g in model.grams)


def test_adaptive_learns_repetition():
    a = P.AdaptivePpm(4)
    once, twice = a.log10(b"abcdefgh" * 4), a.log10(b"abcdefgh" * 8)
    assert twice - once > 0.5 * once  # the second half costs less than half
    assert a.log10(b"x") == pytest.approx(-math.log10(256))


def test_base_score_and_tokens(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    rows += [(1000 + (i or 0), t) for i, t in edge_rows()] + [(None, "alone inthenullrow")]
    docs = documents(spark, rows)
    learn = fold(F.col("doc_id"), 10) != 0
    model = P.train_ppm(docs.where(learn), order=2)
    got = P.score_texts(docs, learn, model).collect()
    count = {}
    def tokens(t):
        return lower_ascii((t or "").encode()).split() + [None]
    for i, t in rows:
        if i is not None and zlib.crc32(str(i).encode()) % 10:
            for w in tokens(t):
                count[w] = count.get(w, 0) + 1
    n, v = sum(count.values()), len(count)
    want = sorted((-1 if i is None else i, len(tokens(t)), sum(w in count for w in tokens(t)),
                   round(sum(math.log10((count.get(w, 0) + 0.1) / (n + 0.1 * (v + 1))) for w in tokens(t)), 5))
                  for i, t in rows)
    have = sorted((-1 if r.doc_id is None else r.doc_id, r.n_tokens, r.n_known, round(r.base_score, 5)) for r in got)
    assert have == want and {r.train_tokens for r in got} == {n}
    assert all(math.isfinite(r.score) and r.score < 0 for r in got)


def test_nothing_to_learn_from(spark):
    docs = documents(spark, [(1, "a b"), (2, None)])
    model = P.train_ppm(docs.where("false"))
    got = P.score_texts(docs, F.lit(False), model).collect()
    assert {(r.doc_id, r.n_tokens, r.n_known, r.train_tokens) for r in got} == {(1, 3, 0, 0), (2, 1, 0, 0)}
    assert P.score_texts(docs.where("false"), F.lit(True), model).count() == 0


def test_scores_use_every_counted_context(spark):
    """No context is pruned, however small its share: scores are those of the whole trie."""
    few = spark.read.parquet(f"{SF}/documents.parquet").orderBy("doc_id").limit(120).collect()
    rows = [(r.doc_id, r.text) for r in few] + [(9001, "common text " * 200_000), (9000, "zq\x01 ab qqq")]
    rows += [(i, t) for i, t in edge_rows() if i != 4]
    docs, learn = documents(spark, rows), fold(F.col("doc_id"), 10) != 0
    train = [P.sequence((t or "").encode()) for i, t in rows if i is not None and zlib.crc32(str(i).encode()) % 10]
    assert sum(map(len, train)) > 2 * 2 ** 20  # a gram seen once or twice falls under a share of 2^-20
    for order in (3, 6):
        scorer = P.train_ppm(docs.where(learn), order=order, min_share=0.0).scorer()
        want = sorted((-1 if i is None else i, x) for (i, _), x in zip(
            rows, scorer.texts([P.sequence((t or "").encode()) for _, t in rows]).tolist()))
        got = sorted((-1 if r.doc_id is None else r.doc_id, r.score)
                     for r in P.score_texts(docs, learn, order=order).collect())
        assert [i for i, _ in got] == [i for i, _ in want]
        assert [x for _, x in got] == pytest.approx([x for _, x in want], rel=1e-9)


def test_the_query_has_no_driver_model(spark, monkeypatch):
    monkeypatch.delattr(P, "train_ppm")
    assert P.op6_ppm_scores(spark, SF).where("score < 0").count() == spark.read.parquet(f"{SF}/documents.parquet").count()


def test_scores_without_training_text(spark):
    docs = documents(spark, [(1, "a b"), (2, None)])
    got = {r.doc_id: r.score for r in P.score_texts(docs, F.lit(False)).collect()}
    assert got == pytest.approx({1: -5 * math.log10(256), 2: -math.log10(256)})
    assert P.score_texts(docs.where("false"), F.lit(True)).count() == 0


@pytest.mark.parametrize("ranges", [1, 16, 100_000, 2**31 - 1])
def test_dealing_does_not_grow_with_the_ranges(ranges):
    rng = np.random.default_rng(3)
    d = np.unique(rng.integers(0, 2**64, 500, dtype=np.uint64))
    full, cut = P.word_ranges(d, ranges)
    assert full.tolist() == sorted({int(x) * ranges >> 32 for x in d >> np.uint64(32)}) and len(full) <= len(d)
    assert [len(x) > 0 for x in np.split(d, cut)] == [True] * len(full)
    g = np.unique(rng.integers(0, 2**56, 500, dtype=np.uint64))
    by, part = P._by_range(g, ranges)
    assert len(part) == len(g) and (np.diff(part) >= 0).all() and 0 <= part[0] and part[-1] < ranges
    for r in np.unique(part):
        assert (np.diff(g[by][part == r].astype(object)) > 0).all()  # ascending within a range
