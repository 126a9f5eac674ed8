"""MinHash near-dedup with ProbMinHash signatures.

A document is a weighted set: its shingles of ``shingle`` consecutive words
(lower-cased words of letters and digits; a shorter document is one shingle),
weighted by how often they occur.  ProbMinHash lets every shingle send
exponential arrivals, at a rate equal to its weight, to random registers; a
register keeps the earliest arrival.  Arrivals are generated round by round
and a shingle stops as soon as its clock has passed the latest register of its
document.  Two registers agree with a probability equal to the probability
Jaccard similarity of the documents.  ``bands`` bands of ``rows`` registers
form buckets; documents that share one are verified by their exact probability
Jaccard similarity, and connected groups become classes.

Exact copies (same words) are collapsed before banding, so a group of copies
of any size is one item.  See :func:`tandem.llm.graph.link_buckets` for how
large buckets of near copies are linked without all their pairs.

Cases: texts without any word (null, empty) are alone in their class; texts of
punctuation only use space-separated words; the class id is the smallest
``doc_id`` of the class (null only if all are null); repeated rows (also of
texts without a word) share a class, and only one of them is kept.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tandem.llm.common import WordDigests, alnum_words, fresh, load, mix64, pieces, stored, utf8
from tandem.llm.graph import across_in_blocks, link_buckets

SHINGLE, BANDS, ROWS, THRESHOLD = 5, 24, 5, 0.8
_GOLD = np.uint64(0x9E3779B97F4A7C15)


def words_of(text: bytes) -> list[bytes]:
    return alnum_words(text) or text.split()


def weighted_shingles(words: list[bytes], digests: WordDigests, shingle: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes, ascending, and their counts."""
    h = digests.array(words)
    if len(h) < shingle:
        h = np.concatenate([h, np.zeros(shingle - len(h), dtype=np.uint64)])
    n = len(h) - shingle + 1
    s = np.zeros(n, dtype=np.uint64)
    for i in range(shingle):
        s = mix64(s + _GOLD) + h[i:i + n]
    return np.unique(mix64(s), return_counts=True)


def signatures(sets: list[tuple[np.ndarray, np.ndarray]], registers: int) -> np.ndarray:
    """ProbMinHash of many weighted sets at once: (sets, registers) of shingle hashes."""
    doc = np.repeat(np.arange(len(sets)), [len(s) for s, _ in sets])
    item = np.concatenate([s for s, _ in sets])
    rate = np.concatenate([c for _, c in sets]).astype(np.float64)
    best = np.full(len(sets) * registers, np.inf)
    owner = np.zeros(len(sets) * registers, dtype=np.uint64)
    clock = np.zeros(len(item))
    k = 0
    while len(item):
        k += 1
        bits = mix64(item + np.full(1, k, dtype=np.uint64) * _GOLD)
        # 53 high bits give the waiting time, another mix the register.
        clock = clock - np.log(((bits >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0 ** -53) / rate
        at = doc * registers + (mix64(bits + _GOLD) % np.uint64(registers)).astype(np.int64)
        np.minimum.at(best, at, clock)
        won = best[at] == clock
        owner[at[won]] = item[won]
        latest = best.reshape(-1, registers).max(axis=1)
        alive = clock < latest[doc]  # early termination
        doc, item, rate, clock = doc[alive], item[alive], rate[alive], clock[alive]
    return owner.reshape(-1, registers)


def probability_jaccard(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Sum over common d of 1 / sum over all e of max(a_e/a_d, b_e/b_d)."""
    common, ia, ib = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    if not len(common):
        return 0.0
    wa, wb = a[1][ia].astype(np.float64), b[1][ib].astype(np.float64)
    only_a, only_b = float(a[1].sum() - wa.sum()), float(b[1].sum() - wb.sum())
    # sum of max(a_e, b_e * r) with r = a_d / b_d: sort the common items by a/b.
    q = wa / wb
    order = np.argsort(q)
    qs, ca, cb = q[order], np.cumsum(wa[order]), np.cumsum(wb[order])
    low = np.searchsorted(qs, q, side="right") - 1  # up to here b_e * r is the larger (or equal)
    total = only_a + only_b * q + (ca[-1] - ca[low]) + cb[low] * q
    return float((wa / total).sum())


def similar_pairs(left: list[bytes], right: list[bytes], wanted: np.ndarray, shingle: int,
                  threshold: float) -> list[tuple[int, int]]:
    """Index pairs, of those wanted, whose probability Jaccard reaches the threshold.

    With no repeated shingle on either side that is the plain Jaccard
    similarity, counted for a whole row of the block at once.
    """
    digests = WordDigests.shared()
    a = [weighted_shingles(words_of(t), digests, shingle) for t in left]
    b = [weighted_shingles(words_of(t), digests, shingle) for t in right]
    sizes = np.array([len(s) for s, _ in b])
    plain = np.array([bool((c == 1).all()) for _, c in b])
    pool = np.concatenate([s for s, _ in b])
    owner = np.repeat(np.arange(len(b)), sizes)
    order = np.argsort(pool, kind="stable")
    pool, owner = pool[order], owner[order]
    out = []
    for i, (items, counts) in enumerate(a):
        todo = wanted[i]
        if not todo.any():
            continue
        lo, hi = np.searchsorted(pool, items, "left"), np.searchsorted(pool, items, "right")
        n = hi - lo
        at = np.repeat(lo - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum())
        common = np.bincount(owner[at], minlength=len(b))
        if (counts == 1).all():
            jaccard = common / (len(items) + sizes - common)
            out.extend((i, int(j)) for j in np.flatnonzero(todo & plain & (jaccard >= threshold)))
            todo = todo & ~plain
        out.extend((i, int(j)) for j in np.flatnonzero(todo & (common > 0))
                   if probability_jaccard((items, counts), b[j]) >= threshold)
    return out


def document_bands(docs: DataFrame, shingle: int, bands: int, rows: int, id_col: str, text_col: str) -> DataFrame:
    """(id, row_key, key, bands): row_key identifies (id, text); key the words,
    or the row where there are none (and no bands)."""
    registers = bands * rows

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digests = WordDigests.shared()
        for batch in pieces(batches, 2):
            sets, at, keys = [], [], []
            for i, (text, row_key) in enumerate(zip(utf8(batch.column(2)), batch.column(1).to_pylist())):
                words = words_of(text)
                if words:
                    sets.append(weighted_shingles(words, digests, shingle))
                    at.append(i)
                    keys.append(xxhash.xxh3_64_intdigest(b" ".join(words)) - (1 << 63))
                else:
                    keys.append(row_key)
            out = [None] * len(keys)
            if sets:
                sig = signatures(sets, registers).reshape(len(sets), bands, rows)
                band = np.broadcast_to(np.arange(1, bands + 1, dtype=np.uint64) * _GOLD, (len(sets), bands))
                for r in range(rows):
                    band = mix64(band + sig[:, :, r])
                for i, row in zip(at, band.view(np.int64).tolist()):
                    out[i] = row
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(keys, pa.int64()), pa.array(out, pa.list_(pa.int64()))],
                names=["id", "row_key", "key", "bands"])

    src = docs.select(F.col(id_col).alias("id"), F.xxhash64(F.col(id_col), F.col(text_col)).alias("row_key"),
                      F.col(text_col).cast("string").alias("text"))
    kind = docs.schema[id_col].dataType.simpleString()
    return src.mapInArrow(run, f"id {kind}, row_key long, key long, bands array<long>")


def near_duplicate_classes(docs: DataFrame, shingle: int = SHINGLE, bands: int = BANDS, rows: int = ROWS,
                           threshold: float = THRESHOLD, id_col: str = "doc_id",
                           text_col: str = "text") -> DataFrame:
    """One row per document row: (id, row_key, class_id, kept); ``kept`` marks
    the smallest (id, row_key) of the class, one row of those that repeat it."""
    marked = stored(document_bands(docs, shingle, bands, rows, id_col, text_col)
                    .withColumn("uid", F.monotonically_increasing_id()), "neardup-bands")
    # Exact copies: one item per distinct word sequence, kept by partial aggregation.
    reps = stored(marked.groupBy("key")
                  .agg(F.min(F.struct("id", "row_key", "uid")).alias("first"), F.first("bands").alias("bands")),
                  "neardup-reps")
    items = reps.select(F.explode("bands").alias("bucket"), "key")

    def texts(nodes: DataFrame) -> DataFrame:
        wanted = reps.join(nodes, "key").select("key", F.col("first.row_key").alias("row_key"))
        return (docs.select(F.xxhash64(F.col(id_col), F.col(text_col)).alias("row_key"),
                            F.col(text_col).cast("string").alias("body"))
                .join(wanted, "row_key").groupBy("key").agg(F.first("body").alias("body")))

    def verify(pairs: DataFrame) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            digests = WordDigests.shared()
            last, kept = None, None
            for batch in pieces(batches, 2):
                us, vs = [], []
                for u, v, tu, tv in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(),
                                        utf8(batch.column(2)), utf8(batch.column(3))):
                    if v != last:
                        last, kept = v, weighted_shingles(words_of(tv), digests, shingle)
                    if probability_jaccard(weighted_shingles(words_of(tu), digests, shingle), kept) >= threshold:
                        us.append(u)
                        vs.append(v)
                yield pa.RecordBatch.from_arrays([pa.array(us, pa.int64()), pa.array(vs, pa.int64())], names=["u", "v"])

        return pairs.select("a", "b", "body_a", "body_b").mapInArrow(run, "u long, v long")

    def compare(left: list[bytes], right: list[bytes], wanted: np.ndarray) -> list[tuple[int, int]]:
        return similar_pairs(left, right, wanted, shingle, threshold)

    comp = link_buckets(items, texts, verify, lambda o, b: across_in_blocks(o, b, compare), "neardup")
    of_key = (reps.select("key", "first").join(comp.withColumnRenamed("node", "key"), "key", "left")
              .select("key", "first", F.coalesce("component", "key").alias("comp")))
    lead = of_key.groupBy("comp").agg(F.min("first").alias("lead"))
    of_key = of_key.join(lead, "comp").select("key", "lead")
    out = marked.select("id", "row_key", "key", "uid").join(of_key, "key")
    return out.select("id", "row_key", F.col("lead.id").alias("class_id"),
                      (F.col("uid") == F.col("lead.uid")).alias("kept"))


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **params) -> DataFrame:
    """``docs`` with one document of each class; columns unchanged."""
    keep = near_duplicate_classes(docs, id_col=id_col, text_col=text_col, **params).where("kept")
    name = fresh(docs, "_row_key")
    keyed = docs.withColumn(name, F.xxhash64(F.col(id_col), F.col(text_col)))
    kept = keyed.join(keep.select(F.col("row_key").alias(name)), name, "left_semi")
    return kept.dropDuplicates([name]).select(*[F.col(f"`{c}`") for c in docs.columns])


def op10_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    classes = near_duplicate_classes(load(spark, sf_dir, "documents"))
    return classes.select(F.col("id").alias("doc_id"), "class_id", "kept")


def stage_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: one document of each near-duplicate class stays."""
    return drop_near_duplicates(docs)
