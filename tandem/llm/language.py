"""Language identification as multilingual mixture inference.

Every language has a distribution over hashed character n-grams (1 to 3, with
word-edge marks; lower-cased words without digits), counted over all training
documents.  A word's likelihood in a language is that of its n-grams.  A
document is a mixture: expectation-maximisation estimates the proportions of
the languages, its words being the hidden draws.  The language set is chosen by
penalised likelihood: starting from the single best language, the next one by
proportion is added while the mixture's log-likelihood gains more than the
penalty (a BIC term per extra language, times ``penalty``).  If even the mixture
of all languages gains less, no set can win, and the single language stands.
The prediction is the language with the largest proportion in the set.

``score`` is that proportion, for a single language its posterior probability.

The model is a dense table, 65,536 counts a language, so its size is bounded by
the number of languages and not by the corpus.

Cases: ``und`` (score 0) if the text is null or has no letter, or if nothing
was learned; rows with a null language or a null id are not learned from; a tie
goes to the language that comes first; repeated rows are predicted alike; extra
columns are ignored.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tandem.llm.common import fold, load, mix64, pieces, utf8

BUCKETS = 1 << 16
UNKNOWN = "und"
_NO_DIGITS = bytes(32 if 48 <= c <= 57 else c + 32 if 65 <= c <= 90 else c if c >= 128 or 97 <= c <= 122 else 32
                   for c in range(256))


def split_words(text: bytes) -> list[bytes]:
    """Lower-cased (A-Z) runs of letters and non-ASCII code points."""
    return text.translate(_NO_DIGITS).split()


def has_letter(word: bytes) -> bool:
    return word.isascii() or any(c.isalpha() for c in word.decode())


def bucket_runs(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The n-gram buckets of all words, one after the other, and where each
    word's run starts.  Every word has at least one."""
    text = "\x02" + "\x03\x02".join(w.decode().lower() for w in words) + "\x03"
    c = np.frombuffer(text.encode("utf-32-le"), dtype=np.uint32).astype(np.uint64)
    first, last = c == 2, c == 3
    pad = np.zeros(2, dtype=np.uint64)
    c1, c2 = np.concatenate([c[1:], pad[:1]]), np.concatenate([c[2:], pad])
    grams = np.stack([c, (c << np.uint64(21)) | c1, (((c << np.uint64(21)) | c1) << np.uint64(21)) | c2], axis=1)
    end_next = np.concatenate([last[1:], [True]])
    valid = np.stack([~first & ~last, ~last, ~last & ~end_next], axis=1)
    kinds = np.array([1, 2, 3], dtype=np.uint64) << np.uint64(61)
    hashed = (mix64(grams ^ kinds) >> np.uint64(48)).astype(np.int64)
    per_char = valid.sum(axis=1)
    at = np.cumsum(per_char) - per_char
    return hashed[valid], at[first]


@dataclass(frozen=True)
class LanguageModel:
    languages: list           # ascending
    log_p: np.ndarray         # (languages, BUCKETS) float32


def ngram_counts(docs: DataFrame, id_col: str, text_col: str, lang_col: str) -> DataFrame:
    """(lang, bucket, n) over all rows of ``docs``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[str, np.ndarray] = {}
        words: dict[str, Counter] = defaultdict(Counter)

        def fold_in() -> None:
            for lang, c in words.items():
                known = [w for w in c if has_letter(w)]
                if known:
                    buckets, starts = bucket_runs(known)
                    size = np.diff(np.append(starts, len(buckets)))
                    n = np.repeat(np.array([c[w] for w in known], dtype=np.float64), size)
                    total.setdefault(lang, np.zeros(BUCKETS, dtype=np.int64))
                    total[lang] += np.bincount(buckets, weights=n, minlength=BUCKETS).astype(np.int64)
            words.clear()

        for batch in pieces(batches, 1):
            for lang, text in zip(batch.column(0).to_pylist(), utf8(batch.column(1))):
                words[lang].update(split_words(text))
            if sum(map(len, words.values())) > 300_000:  # bounds memory; sums are the same
                fold_in()
        fold_in()
        for lang, counts in total.items():
            at = np.flatnonzero(counts)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(at), pa.string()), pa.array(at.astype(np.int32)), pa.array(counts[at])],
                names=["lang", "bucket", "n"])

    parts = docs.select(F.col(lang_col).cast("string"), F.col(text_col).cast("string")).mapInArrow(
        run, "lang string, bucket int, n long")
    return parts.groupBy("lang", "bucket").agg(F.sum("n").alias("n"))


def train_languages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    lang_col: str = "lang", smooth: float = 0.5) -> LanguageModel:
    """At most 65,536 counts a language reach the driver."""
    counts = ngram_counts(docs.where(F.col(lang_col).isNotNull()), id_col, text_col, lang_col).toPandas()
    languages = sorted(counts["lang"].unique().tolist())
    table = np.zeros((len(languages), BUCKETS))
    for i, lang in enumerate(languages):
        own = counts[counts["lang"] == lang]
        table[i, own["bucket"].to_numpy()] = own["n"].to_numpy()
    table += smooth
    return LanguageModel(languages, np.log(table / table.sum(axis=1, keepdims=True)).astype(np.float32))


def _mixture(p: np.ndarray, top: np.ndarray, count: np.ndarray, starts: np.ndarray, doc: np.ndarray,
             allowed: np.ndarray, rounds: int) -> tuple[np.ndarray, np.ndarray]:
    """EM for many documents at once; ``p`` (tokens, L) likelihoods relative to
    exp(top); ``allowed`` (docs, L).  Returns proportions and log-likelihoods."""
    n = np.add.reduceat(count, starts)
    pi = allowed / allowed.sum(axis=1, keepdims=True)
    for _ in range(rounds):
        r = p * pi[doc]
        norm = r.sum(axis=1)
        r *= (count / np.maximum(norm, 1e-300))[:, None]
        pi = np.add.reduceat(r, starts, axis=0) / n[:, None]
    norm = np.maximum((p * pi[doc]).sum(axis=1), 1e-300)
    return pi, np.add.reduceat(count * (np.log(norm) + top), starts)


def infer(scores: np.ndarray, count: np.ndarray, starts: np.ndarray, penalty: float = 3.0,
          rounds: int = 8) -> tuple[np.ndarray, np.ndarray]:
    """Best language and score per document.  ``scores`` (tokens, L) are word
    log-likelihoods, tokens lie document by document from ``starts`` on."""
    n_docs, n_lang = len(starts), scores.shape[1]
    sizes = np.diff(np.append(starts, len(count)))
    doc = np.repeat(np.arange(n_docs), sizes)
    top = scores.max(axis=1)
    p = np.exp(scores - top[:, None])
    single = np.add.reduceat(scores * count[:, None], starts, axis=0)
    best = single.argmax(axis=1)
    best_ll = single[np.arange(n_docs), best]
    score = 1.0 / np.exp(np.clip(single - best_ll[:, None], -700, 0)).sum(axis=1)
    if n_lang == 1:
        return best, score
    cost = 0.5 * penalty * np.log(np.add.reduceat(count, starts) + 1.0)
    pi, ll = _mixture(p, top, count, starts, doc, np.ones((n_docs, n_lang)), rounds)
    open_ = np.flatnonzero(ll - best_ll > cost)
    if not len(open_):
        return best, score
    order = np.argsort(-pi[open_], axis=1, kind="stable")
    allowed = np.zeros((n_docs, n_lang))
    allowed[np.arange(n_docs), best] = 1.0
    now = best_ll.copy()
    for k in range(n_lang):
        if not len(open_):
            break
        add = order[:, k]
        trial = allowed[open_].copy()
        new = trial[np.arange(len(open_)), add] == 0
        trial[np.arange(len(open_)), add] = 1.0
        rows = np.concatenate([np.arange(starts[d], starts[d] + sizes[d]) for d in open_])
        at = np.concatenate([[0], np.cumsum(sizes[open_])[:-1]])
        sub = np.repeat(np.arange(len(open_)), sizes[open_])
        pi_k, ll_k = _mixture(p[rows], top[rows], count[rows], at, sub, trial, rounds)
        wins = new & (ll_k - now[open_] > cost[open_])
        won = open_[wins]
        allowed[won], now[won] = trial[wins], ll_k[wins]
        best[won] = pi_k[wins].argmax(axis=1)
        score[won] = pi_k[wins].max(axis=1)
        go_on = wins | ~new
        open_, order = open_[go_on], order[go_on]
    return best, score


def predict_languages(docs: DataFrame, model: LanguageModel, id_col: str = "doc_id",
                      text_col: str = "text") -> DataFrame:
    """(id, lang_pred, score) of every document."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        languages, log_p = shared.value.languages, shared.value.log_p.T.copy()
        n_lang = max(1, len(languages))
        room = max(1 << 16, (12 << 20) // n_lang)          # bytes of text at a time
        limit = max(20_000, min(600_000, (64 << 20) // (4 * n_lang)))  # words remembered
        index: dict[bytes, int] = {}
        table = np.zeros((0, n_lang), dtype=np.float32)
        for batch in pieces(batches, 1, 500, room):
            if len(index) > limit:
                index.clear()
                table = table[:0]
            counters = [Counter(split_words(t)) if languages else {} for t in utf8(batch.column(1))]
            new = {w for c in counters for w in c if w not in index}
            known = [w for w in new if has_letter(w)]
            index.update((w, -1) for w in new)
            index.update(zip(known, range(len(table), len(table) + len(known))))
            for i in range(0, len(known), 20_000):
                buckets, starts = bucket_runs(known[i:i + 20_000])
                table = np.concatenate([table, np.add.reduceat(log_p[buckets], starts, axis=0)])
            at, count, starts, docs_at = [], [], [], []
            for i, words in enumerate(counters):
                rows = list(map(index.__getitem__, words))
                if rows and -1 in rows:
                    pairs = [(r, n) for r, n in zip(rows, words.values()) if r >= 0]
                    rows, numbers = [r for r, _ in pairs], [n for _, n in pairs]
                else:
                    numbers = words.values() if rows else ()
                if rows:
                    docs_at.append(i)
                    starts.append(len(at))
                    at.extend(rows)
                    count.extend(numbers)
            langs, scores = [UNKNOWN] * batch.num_rows, [0.0] * batch.num_rows
            if docs_at:
                best, score = infer(table[at].astype(np.float64), np.array(count, dtype=np.float64), np.array(starts))
                for i, b, s in zip(docs_at, best.tolist(), score.tolist()):
                    langs[i], scores[i] = languages[b], min(1.0, s)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(langs, pa.string()), pa.array(scores, pa.float64())],
                names=[id_col, "lang_pred", "score"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(id_col, F.col(text_col).cast("string")).mapInArrow(
        run, f"`{id_col}` {kind}, lang_pred string, score double")


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents")
    fifth = fold(F.col("doc_id"), 5)
    model = train_languages(docs.where(fifth != 0))
    return predict_languages(docs, model).select(
        "doc_id", F.coalesce(fifth == 0, F.lit(False)).alias("held_out"), "lang_pred", "score")
