"""Counts against plain Python, Viterbi against enumeration, and what is kept."""

import itertools
import random

import numpy as np
import pytest

from tandem.llm import quality as Q
from tests.llm.helpers import documents, edge_rows, space_words

SF = "/root/testdata/sf0.01"


def base(text):
    w = space_words(text)
    tri = [tuple(w[i:i + 3]) for i in range(len(w) - 2)]
    hit = {i + k for i, t in enumerate(tri) if tri.count(t) > 1 for k in range(3)}
    lines, dup = (text or "").split("\n"), 0
    for i, line in enumerate(lines):
        dup += bool(space_words(line)) and line in lines[:i]
    n, rep = len(w), len(hit)
    return (n, sum(map(len, w)), sum(c in "#*$%&|<>" for c in text or ""), dup, rep, n < 50 or 100 * rep > 50 * n)


def test_counts_match_plain_python(spark):
    rnd = random.Random(1)
    words = ["a", "b", "é", "x#", "<y>", "A!!", "z z"]
    rows = [(i, "".join(rnd.choice(words) + rnd.choice([" ", " ", "\t", "\n"]) for _ in range(rnd.randrange(120))))
            for i in range(60)] + [r for r in edge_rows() if r[0] != 4]
    got = Q.quality_scores(documents(spark, rows), Q.LineCrf.prior()).collect()
    assert len(got) == len(rows)
    want = sorted((-1 if i is None else i, *base(t)) for i, t in rows)
    have = sorted((-1 if r.doc_id is None else r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines,
                   r.n_repeat_words, r.base_failed) for r in got)
    assert have == want
    assert all(not r.kept for r in got if r.base_failed)


def test_viterbi_is_the_best_path():
    rng = np.random.default_rng(0)
    for n in (1, 2, 5, 8):
        s, t = rng.normal(size=(n, 2)), rng.normal(size=(2, 2))
        def score(y):
            return sum(s[i, y[i]] for i in range(n)) + sum(t[y[i - 1], y[i]] for i in range(1, n))
        best = max(itertools.product((0, 1), repeat=n), key=score)
        assert tuple(Q.viterbi(s, t)) == best


def test_crf_gradient_raises_the_likelihood_of_its_labels():
    good, _, _ = Q.line_features([b"This is a fine line of text."] * 6)
    bad, _, _ = Q.line_features([b"$$$ ### || BUY!! NOW!!"] * 6)
    crf = Q.fit_crf([good, bad] * 5, [1, 0] * 5)
    assert (good @ crf.weights > 0).all() and (bad @ crf.weights < 0).all()
    assert np.array_equal(Q.fit_crf([good], [1]).weights, Q.PRIOR_WEIGHTS)  # one class only: the prior


def test_junk_goes_and_clean_documents_stay(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    crf = Q.train_line_crf(docs, labels, per_class=40)
    got = Q.quality_scores(docs, crf).join(labels, "doc_id").toPandas()
    long = got[got.n_words >= 50]
    assert long[long.quality == 1].kept.mean() >= 0.98
    assert long[long.quality == 0].kept.mean() <= 0.05


def test_filter_keeps_columns_and_empty_tables(spark):
    rnd = random.Random(3)
    plain = "\n".join(" ".join("".join(rnd.choices("aeioustrnl", k=5)) for _ in range(9)) + "." for _ in range(9))
    docs = documents(spark, [*edge_rows(), (50, plain), (50, plain), (None, plain)])
    out = Q.keep_quality(docs, Q.LineCrf.prior())
    # the long text of the edge rows is all digits and codes: boilerplate to the prior
    assert out.columns == docs.columns and sorted(r.doc_id or 0 for r in out.collect()) == [0, 50, 50]
    empty = docs.where("false")
    assert Q.quality_scores(empty, Q.LineCrf.prior()).count() == 0
    no_labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert np.array_equal(Q.train_line_crf(docs, no_labels).weights, Q.PRIOR_WEIGHTS)


def _fit_on(spark, rows, monkeypatch):
    """The (rows of lines, label) that the fit gets."""
    seen = []
    monkeypatch.setattr(Q, "fit_crf", lambda x, y: seen.append((x, y)))
    labels = spark.createDataFrame([(1, 0, 0), (2, 1, 0), (2, 1, 0)], "doc_id long, quality int, toxic int")
    Q.train_line_crf(documents(spark, rows), labels, per_class=2)
    return sorted((y, len(x)) for x, y in zip(*seen[0]))


def test_whole_texts_are_learned_from(spark, monkeypatch):
    rows = [(1, "BUY ## NOW"), (2, "\n".join(f"line {i} of a long text." for i in range(700)))]
    assert _fit_on(spark, rows, monkeypatch) == [(0, 1), (1, 700)]


def test_repeated_rows_leave_both_classes(spark, monkeypatch):
    rows = [(1, "BUY ## NOW")] * 40 + [(2, "A fine line.")]
    assert _fit_on(spark, rows, monkeypatch) == [(0, 1), (1, 1)]


def test_long_sequences_do_not_change_how_short_ones_count():
    good, _, _ = Q.line_features([b"This is a fine line of text."] * 300)
    bad, _, _ = Q.line_features([b"$$$ ### || BUY!! NOW!!"] * 6)
    crf = Q.fit_crf([good, bad, good[:5]], [1, 0, 1])
    assert (good @ crf.weights > 0).all() and (bad @ crf.weights < 0).all()
