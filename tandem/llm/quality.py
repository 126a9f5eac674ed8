"""Quality rules: a linear-chain CRF marks each line content or boilerplate.

Every document is one sequence of lines.  A line has a small feature vector
(:data:`FEATURES`); two label scores per line plus a 2 x 2 transition matrix
make a linear-chain conditional random field, and Viterbi decoding gives the
best label sequence.  A document is kept when at least ``min_share`` of its
words are in content lines and it passes the base rules.

Training (:func:`train_line_crf`) is maximum a posteriori with the expert
weights :data:`PRIOR` as the mean of the prior, on at most ``per_class``
labelled documents of each quality class (a documented bound; lowest id hash
first), with all their lines; equal (id, label, text) rows count once.  Lines of quality-1 documents count as content, those of quality-0
documents as boilerplate.  Without usable labels the prior itself is used.

Cases: null text has no words (all counts 0, ``base_failed`` true); a line
without a word takes part in the chain but carries no words; repeated rows are
scored alike; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tandem.llm.common import SPACES, load, pieces, utf8

SYMBOLS = b"#*$%&|<>"
_NOT_SYMBOL = bytes(c for c in range(256) if c not in SYMBOLS)
_NOT_UPPER = bytes(c for c in range(256) if not 65 <= c <= 90)
_NOT_DIGIT = bytes(c for c in range(256) if not 48 <= c <= 57)
_NOT_LOUD = bytes(c for c in range(256) if c not in b"!?")
_CONT = bytes(range(0x80, 0xC0))  # UTF-8 continuation bytes
_SPACE_CONT = SPACES + _CONT

FEATURES = ("bias", "symbols", "upper", "loud", "digits", "repeats", "short", "long_word",
            "ends_sentence", "duplicate", "wordless")
# Expert prior, score of the content label per feature (the
# boilerplate label has the negative), and the transition scores.
PRIOR_WEIGHTS = np.array([1.5, -6.0, -3.0, -4.0, -3.0, -3.0, -0.2, -1.0, 0.5, -1.0, -1.0])
PRIOR_TRANSITIONS = np.array([[0.8, -0.8], [-0.8, 0.8]])  # [from][to]; 0 boilerplate, 1 content


@dataclass(frozen=True)
class LineCrf:
    weights: np.ndarray = None       # (features,): content score; boilerplate has its negative
    transitions: np.ndarray = None   # (2, 2)

    @staticmethod
    def prior() -> "LineCrf":
        return LineCrf(PRIOR_WEIGHTS.copy(), PRIOR_TRANSITIONS.copy())


def code_points(data: bytes) -> int:
    return len(data.translate(None, _CONT))


def line_features(lines: list[bytes]) -> tuple[np.ndarray, np.ndarray, int]:
    """Feature rows, words per line, and the number of duplicate lines."""
    seen: set[bytes] = set()
    rows, counts, n_dup = [], [], 0
    for line in lines:
        words = line.split()
        n = len(words)
        counts.append(n)
        if not n:
            rows.append((1.0, 0.0, 0.0, 0.0, 0.0, 0.0, 0.0, 0.0, 0.0, 0.0, 1.0))
            continue
        dup = line in seen
        if dup:
            n_dup += 1
        else:
            seen.add(line)
        size = len(line)
        rows.append((
            1.0,
            len(line.translate(None, _NOT_SYMBOL)) / n,
            len(line.translate(None, _NOT_UPPER)) / size,
            len(line.translate(None, _NOT_LOUD)) / n,
            len(line.translate(None, _NOT_DIGIT)) / size,
            1.0 - len(set(words)) / n,
            1.0 if n < 6 else 0.0,
            1.0 if size > 40 * n else 0.0,
            1.0 if words[-1][-1:] in (b".", b"!", b"?", b":", b'"') else 0.0,
            1.0 if dup else 0.0,
            0.0,
        ))
    return np.clip(np.array(rows), 0.0, 2.0), np.array(counts, dtype=np.int64), n_dup


def viterbi(scores: np.ndarray, transitions: np.ndarray) -> np.ndarray:
    """Best label sequence; ``scores`` are (lines, 2).  A tie prefers content."""
    (bb, bc), (cb, cc) = transitions.tolist()
    back = []
    pairs = scores.tolist()
    b, c = pairs[0]
    for sb, sc in pairs[1:]:
        from_b, from_c = b + bb, c + cb
        to_b, pb = (from_b, 0) if from_b > from_c else (from_c, 1)
        from_b, from_c = b + bc, c + cc
        to_c, pc = (from_b, 0) if from_b > from_c else (from_c, 1)
        back.append((pb, pc))
        b, c = to_b + sb, to_c + sc
    label = 0 if b > c else 1
    out = [label]
    for step in reversed(back):
        label = step[label]
        out.append(label)
    return np.array(out[::-1], dtype=np.int8)


def repeated_trigram_words(words: list[bytes]) -> int:
    """Words inside a 3-word window that occurs twice or more, first included."""
    windows = list(zip(words, words[1:], words[2:]))
    if len(set(windows)) == len(windows):
        return 0
    often = Counter(windows)
    hit = np.zeros(len(words) + 1, dtype=np.int32)
    at = np.flatnonzero(np.fromiter((often[w] > 1 for w in windows), dtype=bool, count=len(windows)))
    np.add.at(hit, at, 1)
    np.add.at(hit, np.minimum(at + 3, len(words)), -1)
    return int(np.count_nonzero(np.cumsum(hit[:-1])))


def judge(text: bytes, crf: LineCrf, min_share: float) -> tuple:
    """(n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, content_share)"""
    words = text.split()
    n = len(words)
    if not n:
        return 0, 0, len(text.translate(None, _NOT_SYMBOL)), 0, 0, True, False, 0.0
    x, counts, n_dup = line_features(text.split(b"\n"))
    content = x @ crf.weights
    labels = viterbi(np.stack([-content, content], axis=1), crf.transitions)
    share = float(counts[labels == 1].sum() / n)
    n_repeat = repeated_trigram_words(words)
    failed = n < 50 or 100 * n_repeat > 50 * n
    return (n, len(text.translate(None, _SPACE_CONT)), len(text.translate(None, _NOT_SYMBOL)), n_dup, n_repeat,
            failed, not failed and share >= min_share, share)


SCHEMA = ("n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
          "base_failed boolean, kept boolean, content_share double")
_ARROW = [("n_words", pa.int64()), ("word_chars", pa.int64()), ("n_symbols", pa.int64()), ("n_dup_lines", pa.int64()),
          ("n_repeat_words", pa.int64()), ("base_failed", pa.bool_()), ("kept", pa.bool_()),
          ("content_share", pa.float64())]


def quality_scores(docs: DataFrame, crf: LineCrf, min_share: float = 0.5,
                   id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, counts, base rule, verdict and content share."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, 1):
            got = [judge(t, crf, min_share) for t in utf8(batch.column(1))]
            cols = list(zip(*got))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0)] + [pa.array(v, kind) for v, (_, kind) in zip(cols, _ARROW)],
                names=[id_col] + [n for n, _ in _ARROW])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(id_col, F.col(text_col).cast("string")).mapInArrow(run, f"`{id_col}` {kind}, {SCHEMA}")


def keep_quality(docs: DataFrame, crf: LineCrf, min_share: float = 0.5, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that are kept, with all their columns."""
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, at):
            keep = [judge(t, crf, min_share)[6] for t in utf8(batch.column(at))]
            yield batch.filter(pa.array(keep, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


# -- training ---------------------------------------------------------------

def fit_crf(sequences: list[np.ndarray], labels: list[int], steps: int = 120, rate: float = 0.1,
            prior_weight: float = 0.02) -> LineCrf:
    """Adam on the mean log-likelihood of the line labels (a document's label
    repeated for its lines) plus a Gaussian prior around the expert weights.
    Forward-backward runs, step by step, over all sequences of like length at
    once, so that a long one does not pad the short ones."""
    if not sequences or len(set(labels)) < 2:
        return LineCrf.prior()
    y_all = np.array(labels)
    weight = np.where(y_all == 1, 0.5 / (y_all == 1).sum(), 0.5 / (y_all == 0).sum())
    groups: dict[int, list[int]] = {}
    for i, s in enumerate(sequences):
        groups.setdefault(max(7, len(s).bit_length()), []).append(i)  # up to 127 lines: one group
    blocks = []
    for _, at in sorted(groups.items()):
        n, length = len(at), max(len(sequences[i]) for i in at)
        x = np.zeros((n, length, len(FEATURES)))
        mask = np.zeros((n, length), dtype=bool)
        for row, i in enumerate(at):
            x[row, :len(sequences[i])], mask[row, :len(sequences[i])] = sequences[i], True
        y = y_all[at]
        blocks.append((x, mask, np.where(y == 1, 1.0, -1.0), weight[at] / mask.sum(1)))
    w, t = PRIOR_WEIGHTS.copy(), PRIOR_TRANSITIONS.copy()
    m, v = np.zeros(len(w) + 4), np.zeros(len(w) + 4)
    gold_t = np.zeros((2, 2))
    for _, mask, gold_sign, share in blocks:
        for label, sign in ((0, -1.0), (1, 1.0)):
            gold_t[label, label] += (share * (mask.sum(1) - 1))[gold_sign == sign].sum()
    for step in range(1, steps + 1):
        g_w, g_t = np.zeros(len(w)), gold_t.copy()
        for x, mask, gold_sign, share in blocks:
            (n, length), s = mask.shape, x @ w
            e = np.stack([-s, s], axis=2)
            alpha, beta = np.zeros((n, length, 2)), np.zeros((n, length, 2))
            alpha[:, 0] = e[:, 0]
            for i in range(1, length):
                nxt = np.logaddexp(alpha[:, i - 1, :1] + t[0], alpha[:, i - 1, 1:] + t[1]) + e[:, i]
                alpha[:, i] = np.where(mask[:, i, None], nxt, alpha[:, i - 1])
            z = np.logaddexp(alpha[:, -1, 0], alpha[:, -1, 1])
            for i in range(length - 2, -1, -1):
                ahead = e[:, i + 1] + beta[:, i + 1]
                nxt = np.stack([np.logaddexp(t[k, 0] + ahead[:, 0], t[k, 1] + ahead[:, 1]) for k in (0, 1)], axis=1)
                beta[:, i] = np.where(mask[:, i + 1, None], nxt, 0.0)
            p_content = np.exp(alpha[:, :, 1] + beta[:, :, 1] - z[:, None])
            expect = np.where(mask, 2 * p_content - 1, 0.0)
            g_w += np.einsum("nlf,nl,n->f", x, np.where(mask, gold_sign[:, None], 0.0) - expect, share)
            for a in (0, 1):
                for b in (0, 1):
                    joint = np.exp(alpha[:, :-1, a] + t[a, b] + e[:, 1:, b] + beta[:, 1:, b] - z[:, None])
                    g_t[a, b] -= float((np.where(mask[:, 1:], joint, 0.0) * share[:, None]).sum())
        g = np.concatenate([g_w - prior_weight * (w - PRIOR_WEIGHTS),
                            (g_t - prior_weight * (t - PRIOR_TRANSITIONS)).ravel()])
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        d = rate * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-8)
        w, t = w + d[:len(w)], t + d[len(w):].reshape(2, 2)
    return LineCrf(w, t)


def train_line_crf(docs: DataFrame, labels: DataFrame, per_class: int = 300,
                   id_col: str = "doc_id", text_col: str = "text") -> LineCrf:
    """Fit on the whole texts of at most ``per_class`` labelled documents of
    each class (a bound of the training sample only)."""
    order = [F.xxhash64(F.col(id_col)), F.col(id_col)]
    picked = [labels.where((F.col("quality") == q) & F.col(id_col).isNotNull())
              .select(id_col, "quality").distinct().orderBy(*order).limit(per_class) for q in (0, 1)]
    sample = F.broadcast(picked[0].unionByName(picked[1]))  # 2 * per_class rows at most

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, 1):
            rows = [line_features(t.split(b"\n"))[0].ravel().tolist() for t in utf8(batch.column(1))]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(rows, pa.list_(pa.float64()))],
                                             names=["quality", "x"])

    got = (docs.select(id_col, F.col(text_col).cast("string").alias("_text")).join(sample, id_col)
           .where(F.length("_text") > 0).distinct()  # repeats do not reach the driver
           .select(F.col("quality").cast("int"), "_text")
           .mapInArrow(features, "quality int, x array<double>").collect())
    got = sorted(((r.quality, r.x) for r in got))  # the fit must not depend on task order
    return fit_crf([np.array(x).reshape(-1, len(FEATURES)) for _, x in got], [q for q, _ in got])


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents")
    return quality_scores(docs, train_line_crf(docs, load(spark, sf_dir, "labels")))


def stage_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: documents that the rules reject go."""
    return keep_quality(docs, train_line_crf(docs, load(spark, sf_dir, "labels")))
