"""Held-out accuracy, mixtures, EM against direct likelihood, edge rows."""

import numpy as np
from pyspark.sql import functions as F

from tandem.llm import language as L
from tandem.llm.common import fold
from tests.llm.helpers import documents, edge_rows

SF = "/root/testdata/sf0.01"


def test_held_out_accuracy_and_mixtures(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    fifth = fold(F.col("doc_id"), 5)
    model = L.train_languages(docs.where(fifth != 0))
    got = L.predict_languages(docs, model).join(docs.select("doc_id", "lang"), "doc_id").where(fifth == 0).toPandas()
    assert (got.lang == got.lang_pred).mean() >= 0.98 and got.score.between(0, 1).all()
    long = {r.lang: r.text for r in docs.where("length(text) > 4000 and length(text) < 9000").collect()}
    rows = [(0, long["fr"]), (1, long["fr"][:3900] + " " + long["de"][:1500]), (2, "12 34 !?"), (3, None), (4, "")]
    mixed = {r.doc_id: r for r in L.predict_languages(documents(spark, rows), model).collect()}
    assert mixed[0].lang_pred == "fr" and mixed[0].score > 0.95
    assert mixed[1].lang_pred == "fr" and 0.55 < mixed[1].score < 0.9
    assert all((mixed[i].lang_pred, mixed[i].score) == ("und", 0.0) for i in (2, 3, 4))


def test_inference_on_known_mixtures():
    rng = np.random.default_rng(1)
    own = np.log(np.array([[0.9, 0.05, 0.05], [0.05, 0.9, 0.05], [0.05, 0.05, 0.9]]))
    docs = [rng.choice(3, 400, p=[0.7, 0.3, 0.0]), rng.choice(3, 50, p=[0, 0, 1.0]), rng.choice(3, 3, p=[0, 1.0, 0])]
    scores = own[np.concatenate(docs)]
    starts = np.array([0, 400, 450])
    best, score = L.infer(scores, np.ones(len(scores)), starts)
    assert best.tolist() == [0, 2, 1] and 0.6 < score[0] < 0.8 and score[1] > 0.99
    one, sure = L.infer(scores[:, :1], np.ones(len(scores)), starts)
    assert one.tolist() == [0, 0, 0] and (sure == 1).all()


def test_counts_cover_every_row(spark):
    docs = documents(spark, [(1, "ab ab", "x"), (2, "Ab.", "x"), (3, None, "y"), (4, "zz", None), (5, "q1", "y")])
    got = {(r.lang, r.bucket): r.n for r in L.ngram_counts(docs.where("lang is not null"), "doc_id", "text", "lang").collect()}
    want = {}
    for lang, word, n in (("x", b"ab", 3), ("y", b"q", 1)):
        for b in L.bucket_runs([word])[0].tolist():
            want[lang, b] = want.get((lang, b), 0) + n
    assert got == want


def test_buckets_of_many_words_are_those_of_each():
    words = ["a", "été", "x" * 40, "ÀB", "中文", "zz"]
    words = [w.encode() for w in words]
    all_, starts = L.bucket_runs(words)
    ends = [*starts[1:].tolist(), len(all_)]
    for w, a, b in zip(words, starts.tolist(), ends):
        s = w.decode()
        assert L.bucket_runs([w])[0].tolist() == all_[a:b].tolist()
        assert b - a == len(s) + (len(s) + 1) + len(s)  # 1-, 2- and 3-grams, edges marked


def test_edges_of_the_input(spark):
    docs = documents(spark, [(i, t, "en" if t else None) for i, t in edge_rows()])
    model = L.train_languages(docs)
    got = L.predict_languages(docs, model).collect()
    assert len(got) == len(edge_rows()) and {r.lang_pred for r in got} == {"en", "und"}
    nothing = L.train_languages(docs.where("false"))
    assert {(r.lang_pred, r.score) for r in L.predict_languages(docs, nothing).collect()} == {("und", 0.0)}
    assert L.predict_languages(docs.where("false"), model).count() == 0
