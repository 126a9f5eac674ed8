"""Toxicity: averaged subword-bag embeddings and a linear softmax, in numpy.

A word is the bag of its character n-grams (3 to 6, with word-edge marks) and
itself, hashed to buckets; a document is the average of its words' embeddings
(lower-cased words of letters and digits), and a linear softmax over that
average gives the score.  Embeddings and softmax are trained jointly, so an
unseen misspelling is scored by the n-grams it shares with known words.

Training (:func:`train_toxicity`) uses at most ``per_class`` toxic and twice as
many clean labelled documents (a documented bound; lowest id hash first),
whole texts.  Subwords are screened before: only buckets whose document
frequency is higher in toxic than in clean documents by ``screen`` standard
errors get an embedding (at most ``max_subwords``, the strongest), the others
stay at the zero vector.  This keeps chance n-grams out of long documents.

As the softmax is linear, a word's share of the score is one number; workers
remember it per word, so scoring is one table look-up a word.

Cases: null and empty texts get the score of the bias alone; rows without a
label, or with a null id, are not learned from; of rows that repeat an id the
smallest text is learned from; without both classes every score is 0; repeated rows are scored alike; extra columns are ignored.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tandem.llm.common import alnum_words, fold, load, pieces, utf8

BUCKETS = 1 << 17
DIM = 8
GAIN = 100.0  # averages are small; a fixed factor before the softmax


def subwords(word: bytes) -> set[int]:
    s = "<" + word.decode(errors="replace") + ">"
    grams = {s[i:i + n] for n in (3, 4, 5, 6) for i in range(len(s) - n + 1)} | {s}
    return {xxhash.xxh32_intdigest(g) % BUCKETS for g in grams}


def document_bag(words: list[bytes], cache: dict) -> tuple[np.ndarray, np.ndarray]:
    """Buckets and their weights in the average of the word vectors."""
    if not words:
        return np.zeros(0, dtype=np.int32), np.zeros(0, dtype=np.float32)
    counts = Counter(words)
    grams = []
    for w in counts:
        g = cache.get(w)
        if g is None:
            if len(cache) > 100_000:
                cache.clear()
            g = cache[w] = np.fromiter(subwords(w), dtype=np.int32)
        grams.append(g)
    size = np.array([len(g) for g in grams])
    weight = np.repeat(np.fromiter(counts.values(), dtype=np.float64, count=len(grams)) / size / len(words), size)
    ids, at = np.unique(np.concatenate(grams), return_inverse=True)
    return ids, np.bincount(at, weights=weight).astype(np.float32)


@dataclass(frozen=True)
class ToxicityModel:
    subword_ids: np.ndarray   # ascending buckets with an embedding
    embeddings: np.ndarray    # (subwords, DIM)
    softmax: np.ndarray       # (DIM, 2)
    bias: np.ndarray          # (2,)

    def word_scores(self) -> dict[int, float]:
        """Per bucket, its part of logit(toxic) - logit(clean)."""
        w = (self.softmax[:, 1] - self.softmax[:, 0]) * GAIN
        return dict(zip(self.subword_ids.tolist(), (self.embeddings @ w).tolist()))


def fit_toxicity(bags: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, screen: float = 7.0,
                 max_subwords: int = 2048, steps: int = 400, rate: float = 0.05, l2: float = 1e-3,
                 seed: int = 1) -> ToxicityModel | None:
    """Screen subwords, then train embeddings and softmax jointly (Adam, full batch)."""
    n1, n0 = int((labels == 1).sum()), int((labels == 0).sum())
    if not n1 or not n0:
        return None
    df = np.zeros((2, BUCKETS))
    for (ids, _), y in zip(bags, labels):
        df[y, ids] += 1
    p1, p0, p = (df[1] + 0.5) / (n1 + 1), (df[0] + 0.5) / (n0 + 1), (df.sum(0) + 1) / (n1 + n0 + 2)
    z = (p1 - p0) / np.sqrt(p * (1 - p) * (1 / n1 + 1 / n0))
    top = np.argsort(-z, kind="stable")[:max_subwords]
    chosen = np.sort(top[z[top] >= screen])
    x = np.zeros((len(bags), len(chosen)), dtype=np.float32)
    column = np.full(BUCKETS, -1)
    column[chosen] = np.arange(len(chosen))
    for i, (ids, weights) in enumerate(bags):
        at = column[ids]
        x[i, at[at >= 0]] = weights[at >= 0] * GAIN
    rng = np.random.default_rng(seed)
    par = [rng.normal(0, 0.1, (len(chosen), DIM)), rng.normal(0, 0.5, (DIM, 2)), np.zeros(2)]
    m, v = [np.zeros_like(a) for a in par], [np.zeros_like(a) for a in par]
    share = np.where(labels == 1, 0.5 / n1, 0.5 / n0)
    gold = np.eye(2)[labels]
    for step in range(1, steps + 1):
        e, w, b = par
        h = x @ e.astype(np.float32)
        q = h @ w + b
        q = np.exp(q - q.max(axis=1, keepdims=True))
        d = (q / q.sum(axis=1, keepdims=True) - gold) * share[:, None]
        grads = [x.T @ (d @ w.T).astype(np.float32) + l2 * e, h.T @ d + l2 * w, d.sum(axis=0)]
        for i, g in enumerate(grads):
            m[i] = 0.9 * m[i] + 0.1 * g
            v[i] = 0.999 * v[i] + 0.001 * g * g
            par[i] = par[i] - rate * (m[i] / (1 - 0.9 ** step)) / (np.sqrt(v[i] / (1 - 0.999 ** step)) + 1e-8)
    return ToxicityModel(chosen, *par)


def train_toxicity(docs: DataFrame, labels: DataFrame, learn: Column | None = None, per_class: int = 1500,
                   id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> ToxicityModel | None:
    """Fit on a bounded sample of labelled documents; ``learn`` is a condition
    on the id that says which rows may be learned from (default: all).  The
    sample (at most 3 * ``per_class`` texts) is fitted in one task."""
    known = labels.where(F.col(id_col).isNotNull() & (learn if learn is not None else F.lit(True)))
    order = [F.xxhash64(F.col(id_col)), F.col(id_col)]
    picked = [known.where(F.col(label_col) == y).select(F.col(id_col).alias("_id"), F.lit(y).alias("_y"))
              .orderBy(*order).limit(n) for y, n in ((1, per_class), (0, 2 * per_class))]
    sample = F.broadcast(picked[0].unionByName(picked[1]).distinct())  # 3 * per_class rows at most

    def bags(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache: dict = {}
        for batch in pieces(batches, 2):
            got = [document_bag(alnum_words(t), cache) for t in utf8(batch.column(2))]
            yield pa.RecordBatch.from_arrays(
                [pa.array([0] * len(got), pa.int32()), batch.column(0), batch.column(1),
                 pa.array([g[0] for g in got], pa.list_(pa.int32())),
                 pa.array([g[1] for g in got], pa.list_(pa.float32()))], names=["g", "id", "y", "ids", "weights"])

    def fit(table: pa.Table) -> pa.Table:
        table = table.sort_by([("id", "ascending"), ("y", "ascending")])
        rows = [(ids.values.to_numpy(), w.values.to_numpy()) for ids, w in
                zip(table.column("ids"), table.column("weights"))]
        got = fit_toxicity(rows, table.column("y").to_numpy())
        if got is None:
            return pa.table({"name": pa.array([], pa.string()), "v": pa.array([], pa.list_(pa.float64()))})
        return pa.table({"name": ["subword_ids", "embeddings", "softmax", "bias"],
                         "v": pa.array([np.asarray(a, dtype=np.float64).ravel() for a in (
                             got.subword_ids, got.embeddings, got.softmax, got.bias)], pa.list_(pa.float64()))})

    src = docs.select(F.col(id_col).alias("_id"), F.col(text_col).cast("string").alias("_text"))
    kind = docs.schema[id_col].dataType.simpleString()
    fitted = (src.join(sample, "_id").groupBy("_id", "_y").agg(F.min("_text").alias("_text"))
              .mapInArrow(bags, f"g int, id {kind}, y int, ids array<int>, weights array<float>")
              .groupBy("g").applyInArrow(fit, "name string, v array<double>").collect())
    if not fitted:
        return None
    v = {r.name: np.array(r.v) for r in fitted}
    return ToxicityModel(v["subword_ids"].astype(np.int64), v["embeddings"].reshape(-1, DIM),
                         v["softmax"].reshape(DIM, 2), v["bias"])


class _WordScores(dict):
    def __init__(self, by_subword: dict[int, float]):
        super().__init__()
        self.by_subword = by_subword

    def __missing__(self, word: bytes) -> float:
        if len(self) >= 300_000:
            self.clear()
        grams = subwords(word)
        got = sum(self.by_subword.get(g, 0.0) for g in sorted(grams)) / len(grams)
        if len(word) <= 64:
            self[word] = got
        return got


def toxicity_scores(docs: DataFrame, model: ToxicityModel | None, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """(id, score) of every document."""
    shared = docs.sparkSession.sparkContext.broadcast(
        (model.word_scores(), float(model.bias[1] - model.bias[0])) if model else None)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words_of, bias = shared.value if shared.value else ({}, -math.inf)
        scores = _WordScores(words_of)
        for batch in pieces(batches, 1):
            out = []
            for text in utf8(batch.column(1)):
                words = alnum_words(text)
                z = bias + (math.fsum(map(scores.__getitem__, words)) / len(words) if words else 0.0)
                out.append(1.0 / (1.0 + math.exp(-z)) if z > -700 else 0.0)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.float64())], names=[id_col, "score"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(id_col, F.col(text_col).cast("string")).mapInArrow(run, f"`{id_col}` {kind}, score double")


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents")
    fifth = fold(F.col("doc_id"), 5)
    model = train_toxicity(docs, load(spark, sf_dir, "labels"), learn=fifth != 0)
    scores = toxicity_scores(docs, model)
    return scores.select("doc_id", F.coalesce(fifth == 0, F.lit(False)).alias("held_out"), "score",
                         F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"))
