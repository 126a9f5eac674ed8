"""Held-out accuracy, unseen misspellings and edge rows."""

from pyspark.sql import functions as F

from tandem.llm import toxicity as T
from tandem.llm.common import fold
from tests.llm.helpers import documents, edge_rows

SF = "/root/testdata/sf0.01"


def test_held_out_accuracy_and_misspellings(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    model = T.train_toxicity(docs, labels, learn=fold(F.col("doc_id"), 5) != 0)
    got = T.toxicity_scores(docs, model).join(labels, "doc_id").where(fold(F.col("doc_id"), 5) == 0).toPandas()
    assert ((got.score >= 0.5) == (got.toxic == 1)).mean() >= 0.95
    filler = "the of and anre eder whed inth onon thst " * 6
    texts = [filler, filler + "patheticc", filler + "morrons losers", filler + "STUPID!", None, ""]
    s = {r.doc_id: r.score for r in T.toxicity_scores(documents(spark, list(enumerate(texts))), model).collect()}
    assert s[0] < 0.5 < min(s[1], s[2], s[3]) and s[4] == s[5] < 0.5


def test_screening_leaves_chance_subwords_out():
    import numpy as np
    rng = np.random.default_rng(0)
    cache = {}
    words = [("w%d" % i).encode() for i in range(400)]
    bags, y = [], []
    for i in range(200):
        text = [words[j] for j in rng.integers(0, 400, 40)] + ([b"badword"] if i % 2 else [])
        bags.append(T.document_bag(text, cache))
        y.append(i % 2)
    m = T.fit_toxicity(bags, np.array(y), steps=100)
    assert set(m.subword_ids.tolist()) <= T.subwords(b"badword") | T.subwords(b"bad") and len(m.subword_ids) > 5


def test_edges_of_the_input(spark):
    docs = documents(spark, edge_rows())
    labels = spark.createDataFrame([(1, 0, 1), (5, 1, 0), (None, 1, 1), (99, 0, 0), (6, None, None)],
                                   "doc_id long, quality int, toxic int")
    model = T.train_toxicity(docs, labels)
    got = T.toxicity_scores(docs, model).collect()
    assert len(got) == len(edge_rows()) and all(0 <= r.score <= 1 for r in got)
    assert T.train_toxicity(docs, labels.where("toxic = 1")) is None
    assert {r.score for r in T.toxicity_scores(docs, None).collect()} == {0.0}
    assert T.toxicity_scores(docs.where("false"), model).count() == 0


def test_a_repeated_document_counts_once(spark):
    import numpy as np
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    docs, labels = docs.where("doc_id < 100"), labels.where("doc_id < 100")
    once, more = T.train_toxicity(docs, labels), T.train_toxicity(docs.unionByName(docs), labels)
    assert np.array_equal(once.subword_ids, more.subword_ids) and np.allclose(once.embeddings, more.embeddings)
