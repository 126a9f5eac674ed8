"""LM scoring by prediction by partial matching (PPM) over bytes.

A text is its lower-cased (A-Z) words, each followed by a space, then an end
mark.  The byte-context trie has the contexts of up to ``ORDER`` bytes.  A byte
is predicted by the longest known context; if that context has not seen it, an
escape is paid and the next shorter context is asked, where the bytes already
ruled out are excluded (symbol exclusion).  Escapes follow method C: the weight
of an escape is the number of distinct bytes seen, plus the count of what was
pruned.  Below order 0 the bytes left are equally likely.  All probabilities of
a context add up to one.

Two modes: pretrained (:func:`score_texts`: counts over all training documents)
and adaptive (:class:`AdaptivePpm`: one document's own code length, learned as
it goes, starting from an empty trie).

**Counting** covers every byte of every training document, and every context
counts: nothing is pruned.  The probability of a byte depends only on it and its
``ORDER`` predecessors (a gram).  Each chunk of text (about ``CHUNK`` bytes)
sends its distinct grams with their training counts, packed by a hash of the
context; each hash range adds up the counts, writes its part of the trie, and
sends the probabilities back to the chunks that asked.  A gram the training
texts do not have (only texts held out have such) goes down the orders by joins
with the written tables of shorter contexts, which are sums of the longer ones.
The trie grows with the corpus and never passes through the driver or a
broadcast; only successors of contexts of up to one byte (257 rows at most) are
broadcast.

:func:`train_ppm` makes a model for use outside Spark instead, which the driver
holds: there a trie node stays if its share of all counts is at least
``min_share``.  The query does not use it.

**Base score** needs the training count of every word.  Words are never
broadcast: each chunk of text (about ``CHUNK`` bytes) sends its distinct words,
as 64-bit digests packed by digest range; ranges add up counts and send them
back, without the digests, to the chunks that asked; chunk and answers meet in
one task.  A chunk sends at most one row a distinct word and one a distinct
gram, and takes no step that grows with the number of ranges.

Cases: null is an empty text (one end token); rows with a null id are scored,
not learned from, and not held out; without training text all counts are 0;
an empty table gives an empty result; repeated rows are scored alike; extra
columns are ignored.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tandem.llm.common import WordDigests, fold, load, lower_ascii, mix64, pieces, stored, utf8

ORDER = 6
MIN_SHARE = 2.0 ** -20  # of train_ppm only
CHUNK = 4 << 20
END = b"\n"  # no word holds it
_END_DIGEST = np.uint64(0)  # words are never empty, so no word digest is meant by it


def sequence(text: bytes) -> bytes:
    words = lower_ascii(text).split()
    return b" ".join(words) + b" " + END if words else END


def grams(texts: list[bytes], order: int) -> tuple[np.ndarray, np.ndarray]:
    """Per byte of the sequences, it and its ``order`` predecessors as one
    integer (start of text: end marks); and where each text starts."""
    pad = END * order
    # eight bytes that end at each byte, read as one big-endian integer
    flat = bytes(7 - order) + b"".join([pad + s for s in texts])
    g = np.ndarray((len(flat) - 7,), ">u8", flat, 0, (1,)).astype(np.uint64) & _mask(order + 1)
    lengths = np.array([len(s) for s in texts], dtype=np.int64)
    keep = np.ones(len(g) + order, dtype=bool)
    starts = np.concatenate([[0], np.cumsum(lengths + order)[:-1]]).astype(np.int64)
    for i in range(order):
        keep[starts + i] = False
    return g[keep[order:]], np.concatenate([[0], np.cumsum(lengths)[:-1]]).astype(np.int64)


class GramTable:
    """Integer -> row number, by open addressing over whole arrays."""

    EMPTY = np.uint64(0xFFFFFFFFFFFFFFFF)

    def __init__(self, keys: np.ndarray):
        bits = max(4, int(len(keys) * 2).bit_length())
        self.shift, self.mask = np.uint64(64 - bits), np.uint64((1 << bits) - 1)
        self.keys = np.full(1 << bits, self.EMPTY, dtype=np.uint64)
        self.rows = np.full(1 << bits, -1, dtype=np.int32)
        todo, slot = np.arange(len(keys)), self._slot(keys)
        while len(todo):
            free = self.keys[slot] == self.EMPTY
            _, first = np.unique(slot, return_index=True)
            put = np.zeros(len(todo), dtype=bool)
            put[first] = True
            put &= free
            self.keys[slot[put]], self.rows[slot[put]] = keys[todo[put]], todo[put]
            todo, slot = todo[~put], (slot[~put] + np.uint64(1)) & self.mask

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys ^ (keys >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15)) >> self.shift

    def find(self, wanted: np.ndarray) -> np.ndarray:
        """Row per wanted integer; -1 where it is unknown."""
        slot = self._slot(wanted)
        got = self.keys[slot]
        out = self.rows[slot]  # -1 in an empty slot
        todo = np.flatnonzero((got != wanted) & (got != self.EMPTY))
        out[todo] = -1
        slot = slot[todo]
        while len(todo):
            slot = (slot + np.uint64(1)) & self.mask
            got = self.keys[slot]
            hit = got == wanted[todo]
            out[todo[hit]] = self.rows[slot[hit]]
            more = ~hit & (got != self.EMPTY)
            todo, slot = todo[more], slot[more]
        return out


def _mask(n_bytes: int) -> np.uint64:
    return np.uint64((1 << (8 * n_bytes)) - 1)


@dataclass
class PpmModel:
    """Per order k: kept grams (context and byte, ascending) with counts, and
    per context the count of all its bytes, pruned ones included."""
    grams: list
    counts: list
    totals: list     # aligned with the distinct contexts of ``grams``, ascending

    def scorer(self) -> "PpmScorer":
        return PpmScorer(self)


class PpmScorer:
    def __init__(self, model: PpmModel):
        self.order = len(model.grams) - 1
        self.gram_table, self.count, self.ctx_table, self.stats = [], [], [], []
        for k in range(self.order + 1):
            g, n = model.grams[k], model.counts[k].astype(np.float64)
            ctx, first = np.unique(g >> np.uint64(8), return_index=True)
            kept = np.add.reduceat(n, first) if len(g) else np.zeros(0)
            distinct = np.diff(np.append(first, len(g))).astype(np.float64)
            below = np.zeros(len(ctx))  # what this context's bytes weigh one order lower
            if k and len(g):
                low = np.searchsorted(model.grams[k - 1], g & _mask(k))
                below = np.add.reduceat(model.counts[k - 1][low].astype(np.float64), first)
            pruned = np.maximum(0.0, model.totals[k].astype(np.float64) - kept)
            self.gram_table.append(GramTable(g))
            self.count.append(n)
            self.ctx_table.append(GramTable(ctx))
            self.stats.append((kept, distinct, pruned, below))
        # the longest contexts exclude nothing: their predictions are ready
        if len(model.grams[-1]):
            at = np.searchsorted(np.unique(model.grams[-1] >> np.uint64(8)), model.grams[-1] >> np.uint64(8))
            kept, distinct, pruned, _ = self.stats[-1]
            self.ready = np.log10(self.count[-1] / (kept + distinct + pruned)[at])
        else:
            self.ready = np.zeros(1)

    def log10(self, g: np.ndarray) -> np.ndarray:
        """log10 probability of each gram's last byte after its others."""
        row = self.gram_table[-1].find(g)
        out = self.ready[row]  # row -1 reads some value, replaced below
        todo = np.flatnonzero(row < 0)
        lost = np.zeros(len(todo))       # log10 of the escapes so far
        seen_n = np.zeros(len(todo))     # excluded bytes: how many,
        seen_w = np.zeros(len(todo))     # and their count in the next context
        for k in range(self.order, -1, -1):
            if not len(todo):
                break
            gk = g[todo] & _mask(k + 1)
            kept, distinct, pruned, below = self.stats[k]
            c = self.ctx_table[k].find(gk >> np.uint64(8))
            known = c >= 0
            cc = np.where(known, c, 0)
            if len(kept):
                new_n = np.where(known, distinct[cc] - seen_n, 0.0)
                weight = np.where(known, kept[cc] - seen_w, 0.0)
                gone = np.where(known, pruned[cc], 0.0)
            else:
                new_n = weight = gone = np.zeros(len(todo))
            row = self.gram_table[k].find(gk)
            hit = (row >= 0) & known
            total = weight + new_n + gone
            if hit.any():
                out[todo[hit]] = lost[hit] + np.log10(self.count[k][row[hit]] / total[hit])
            go = ~hit
            escapes = go & (new_n > 0)  # nothing new here: the escape is certain
            lost[escapes] += np.log10((new_n + gone)[escapes] / total[escapes])
            if len(kept):
                seen_n = np.where(known, distinct[cc], seen_n)
                seen_w = np.where(known, below[cc], seen_w)
            todo, lost, seen_n, seen_w = todo[go], lost[go], seen_n[go], seen_w[go]
        if len(todo):
            out[todo] = lost - np.log10(np.maximum(1.0, 256.0 - seen_n))
        return out

    def texts(self, seqs: list[bytes]) -> np.ndarray:
        g, starts = grams(seqs, self.order)
        return np.add.reduceat(self.log10(g), starts) if len(seqs) else np.zeros(0)


class AdaptivePpm:
    """Code length of one sequence by a trie that learns as it reads it."""

    def __init__(self, order: int = ORDER):
        self.order = order

    def log10(self, seq: bytes) -> float:
        trie: dict[bytes, dict[int, int]] = defaultdict(dict)
        total = 0.0
        for i, byte in enumerate(seq):
            excluded: set[int] = set()
            p = 0.0
            for k in range(min(self.order, i), -1, -1):
                seen = trie.get(seq[i - k:i])
                if not seen:
                    continue
                fresh = {b: n for b, n in seen.items() if b not in excluded}
                weight = sum(fresh.values()) + len(fresh)
                if byte in fresh:
                    p += np.log10(fresh[byte] / weight)
                    break
                if fresh:
                    p += np.log10(len(fresh) / weight)
                    excluded |= seen.keys()
            else:
                p -= np.log10(256 - len(excluded))
            total += p
            for k in range(min(self.order, i) + 1):
                seen = trie[seq[i - k:i]]
                seen[byte] = seen.get(byte, 0) + 1
        return float(total)


# -- training ---------------------------------------------------------------

def train_ppm(texts: DataFrame, text_col: str = "text", order: int = ORDER,
              min_share: float = MIN_SHARE) -> PpmModel:
    """A model the driver holds: at most 1 / min_share nodes an order reach it."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys: list[np.ndarray] = []
        counts: list[np.ndarray] = []

        def merged() -> pa.RecordBatch:
            key = np.concatenate(keys)
            order_ = np.argsort(key, kind="stable")  # runs that are sorted already
            key, n = key[order_], np.concatenate(counts)[order_]
            first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
            return pa.RecordBatch.from_arrays(
                [pa.array(key[first].view(np.int64)), pa.array(np.add.reduceat(n, first))], names=["gram", "n"])

        for batch in pieces(batches, 0):
            g = grams([sequence(t) for t in utf8(batch.column(0))], order)[0]
            u, c = np.unique(g, return_counts=True)
            keys.append(u)
            counts.append(c.astype(np.int64))
            if sum(map(len, keys)) > 4_000_000:  # bounds memory; the sums are the same
                yield merged()
                keys.clear()
                counts.clear()
        if keys:
            yield merged()

    src = texts.select(F.col(text_col).cast("string"))
    cur = stored(src.mapInArrow(run, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n")), f"ppm-{order}")
    n_all = cur.agg(F.sum("n")).first()[0] or 0
    least = max(1, int(np.ceil(min_share * n_all)))
    got: list[tuple] = []
    for k in range(order, -1, -1):
        if k < order:
            cur = stored(cur.select(F.col("gram").bitwiseAND(int(_mask(k + 1))).alias("gram"), "n")
                         .groupBy("gram").agg(F.sum("n").alias("n")), f"ppm-{k}")
        kept = cur.where(F.col("n") >= least).toPandas()
        g = kept["gram"].to_numpy(dtype=np.int64).view(np.uint64)
        at = np.argsort(g)
        # context totals, pruned bytes included; few contexts can pass the bound
        totals = (cur.groupBy(F.shiftright("gram", 8).alias("ctx"))
                  .agg(F.sum("n").alias("total"), F.max("n").alias("most")).where(F.col("most") >= least)
                  .select("ctx", "total").toPandas().sort_values("ctx"))
        got.append((g[at], kept["n"].to_numpy(dtype=np.int64)[at], totals["total"].to_numpy(dtype=np.int64)))
    got.reverse()
    return PpmModel([x[0] for x in got], [x[1] for x in got], [x[2] for x in got])


# -- scoring ----------------------------------------------------------------

def _chunked(docs: DataFrame, id_col: str, text_col: str, learn: Column) -> DataFrame:
    return docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"),
                       F.coalesce(learn, F.lit(False)).alias("learn"))


def _chunk_id(part: int, at: int) -> int:
    return (part << 32) | at


def word_counts(src: DataFrame, ranges: int) -> DataFrame:
    """What each chunk must know: (chunk, range, counts) in pieces, where
    ``counts`` are the training counts of the chunk's distinct words in that
    range, ascending by digest (the chunk knows the digests), and ``check`` is
    half the sum of the digests.  A row with chunk -1 has in ``counts`` the two
    sums of its range: N and V."""
    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digests, part = WordDigests.shared(), TaskContext.get().partitionId()
        for at, batch in enumerate(pieces(batches, 1, 1 << 30, CHUNK)):
            d, learned = chunk_words(batch, digests)
            full, cut = word_ranges(d, ranges)
            yield pa.RecordBatch.from_arrays(
                [pa.array(full), pa.array([_chunk_id(part, at)] * len(full), pa.int64()),
                 pa.array([x.tobytes() for x in np.split(d, cut)], pa.binary()),
                 pa.array([_pack(x) for x in np.split(learned, cut)], pa.binary())],
                names=["range", "chunk", "digests", "counts"])

    def answer(table: pa.Table) -> pa.Table:
        here, chunk = table.column("range")[0].as_py(), table.column("chunk").to_pylist()
        d = [np.frombuffer(x, dtype=np.uint64) for x in table.column("digests").to_pylist()]
        n = [_unpack(x) for x in table.column("counts").to_pylist()]
        words, at = np.unique(np.concatenate(d), return_inverse=True)
        total = np.bincount(at, weights=np.concatenate(n)).astype(np.int64)
        back = np.split(total[at], np.cumsum([len(x) for x in d])[:-1])
        sums = np.array([total.sum(), np.count_nonzero(total)])
        return pa.table({
            "chunk": pa.array([*chunk, -1], pa.int64()),
            "range": pa.array([here] * (len(chunk) + 1), pa.int32()),
            "check": pa.array([*(int(x.sum() >> np.uint64(1)) for x in d), 0], pa.int64()),
            "counts": pa.array([*map(_pack, back), _pack(sums)], pa.binary())})

    asked = src.mapInArrow(ask, "range int, chunk long, digests binary, counts binary")
    return asked.groupBy("range").applyInArrow(answer, "chunk long, range int, check long, counts binary")


def word_ranges(d: np.ndarray, ranges: int) -> tuple[np.ndarray, np.ndarray]:
    """The ranges that have some of the ascending digests, and where all but
    the first of them start: work by the digests, not by the ranges."""
    part = (((d >> np.uint64(32)) * np.uint64(ranges)) >> np.uint64(32)).astype(np.int32)
    cut = np.flatnonzero(part[1:] != part[:-1]) + 1
    return part[np.concatenate([[0], cut])], cut


def chunk_words(batch: pa.RecordBatch, digests: WordDigests) -> tuple[np.ndarray, np.ndarray]:
    """Distinct tokens of a chunk, ascending by digest, and how often its training texts have them."""
    learn = batch.column(2).to_pylist()
    parts, flags = [], []
    for text, yes in zip(utf8(batch.column(1)), learn):
        words = lower_ascii(text).split()
        parts += [digests.array(words), np.array([_END_DIGEST])]
        flags.append(np.full(len(words) + 1, 1 if yes else 0))
    d, at = np.unique(np.concatenate(parts), return_inverse=True)
    return d, np.bincount(at, weights=np.concatenate(flags), minlength=len(d)).astype(np.int64)


def chunk_grams(seqs: list[bytes], learn: list, order: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct grams of a chunk, ascending, and how often its training texts have them."""
    g, starts = grams(seqs, order)
    flag = np.repeat(np.array([1 if x else 0 for x in learn], dtype=np.uint64), np.diff(np.append(starts, len(g))))
    key = np.sort((g << np.uint64(1)) | flag)
    g = key >> np.uint64(1)
    first = np.flatnonzero(np.concatenate([[True], g[1:] != g[:-1]]))
    return g[first], np.add.reduceat((key & np.uint64(1)).astype(np.int64), first)


def _by_range(g: np.ndarray, ranges: int) -> tuple[np.ndarray, np.ndarray]:
    """The order that deals ascending grams to ranges by their context's hash,
    and the range of each gram in it."""
    part = (mix64(g >> np.uint64(8)) % np.uint64(ranges)).astype(np.int32)
    at = np.argsort(part, kind="stable")
    return at, part[at]


def _new_context(g: np.ndarray) -> np.ndarray:
    """True where an ascending run of grams comes to another context."""
    ctx = g >> np.uint64(8)
    return np.concatenate([[True], ctx[1:] != ctx[:-1]])


def _pack(x: np.ndarray) -> bytes:
    """Non-negative integers, byte planes apart: the high ones are mostly zeros."""
    planes = np.ascontiguousarray(x.astype("<u8").view(np.uint8).reshape(-1, 8).T)
    return len(x).to_bytes(8, "little") + pa.compress(planes.tobytes(), "zstd", asbytes=True)


def _unpack(data: bytes) -> np.ndarray:
    n = int.from_bytes(data[:8], "little")
    planes = np.frombuffer(pa.decompress(data[8:], 8 * n, "zstd", asbytes=True), dtype=np.uint8)
    return np.ascontiguousarray(planes.reshape(8, n).T).view("<u8").ravel()


_ANSWER, _TRAINED, _MISS, _ASKED = range(4)
_GRAM_ROWS = "kind int, range int, chunk long, gram long, n long, value double, data binary"


def gram_answers(src: DataFrame, ranges: int, order: int) -> DataFrame:
    """All chunks' grams, counted.  Rows by ``kind``: _ANSWER: the counts of the
    grams that a chunk sent to a range, then what each of their contexts weighs,
    escape included (``data``), and half the sum of these grams; _TRAINED: a gram and its
    count; _MISS: a gram without a count, the log10 of the escape from its
    longest context and the bytes seen there; _ASKED: a chunk that asked for
    such a gram."""
    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        for at, batch in enumerate(pieces(batches, 1, 1 << 30, CHUNK)):
            g, learned = chunk_grams([sequence(t) for t in utf8(batch.column(1))], batch.column(2).to_pylist(), order)
            by, dealt = _by_range(g, ranges)
            cut = np.flatnonzero(dealt[1:] != dealt[:-1]) + 1
            full = dealt[np.concatenate([[0], cut])]
            yield pa.RecordBatch.from_arrays(
                [pa.array(full), pa.array([_chunk_id(part, at)] * len(full), pa.int64()),
                 pa.array([_pack(np.diff(x, prepend=np.uint64(0))) for x in np.split(g[by], cut)], pa.binary()),
                 pa.array([_pack(x) for x in np.split(learned[by], cut)], pa.binary())],
                names=["range", "chunk", "grams", "counts"])

    def answer(table: pa.Table) -> pa.Table:
        here, chunk = table.column("range")[0].as_py(), table.column("chunk").to_pylist()
        sent = [np.cumsum(_unpack(x), dtype=np.uint64) for x in table.column("grams").to_pylist()]
        counts = np.concatenate([_unpack(x) for x in table.column("counts").to_pylist()])
        g, at = np.unique(np.concatenate(sent), return_inverse=True)
        n = np.bincount(at, weights=counts).astype(np.int64)
        new = _new_context(g)
        first, of = np.flatnonzero(new), np.cumsum(new) - 1
        distinct = np.add.reduceat((n > 0).astype(np.int64), first)
        total = np.add.reduceat(n, first) + distinct
        known = n > 0
        miss = np.flatnonzero(~known)
        lost = np.zeros(len(miss))
        some = distinct[of[miss]] > 0  # else the context is unknown: nothing is lost there
        lost[some] = np.log10(distinct[of[miss[some]]] / total[of[miss[some]]])
        low = (g & np.uint64(255)).astype(np.uint8)
        ends = np.append(first[1:], len(g))
        seen = {c: low[first[c]:ends[c]][known[first[c]:ends[c]]].tobytes() for c in np.unique(of[miss]).tolist()}
        cut = np.cumsum([len(x) for x in sent])[:-1]
        back = np.split(at, cut)
        gone = [x[~known[x]] for x in back]
        asked = np.concatenate([g[x] for x in gone])
        rows = {
            _ANSWER: {"chunk": chunk, "gram": [int(x.sum() >> np.uint64(1)) for x in sent],
                      "data": [_pack(np.concatenate([n[x], total[of[x][_new_context(y)]]])) for x, y in zip(back, sent)]},
            _TRAINED: {"gram": g[known].view(np.int64), "n": n[known]},
            _MISS: {"gram": g[miss].view(np.int64), "value": lost, "data": [seen[c] for c in of[miss].tolist()]},
            _ASKED: {"chunk": np.repeat(np.array(chunk, dtype=np.int64), [len(x) for x in gone]),
                     "gram": asked.view(np.int64)}}
        kinds = {"chunk": pa.int64(), "gram": pa.int64(), "n": pa.int64(), "value": pa.float64(), "data": pa.binary()}
        parts = []
        for kind, cols in rows.items():
            size = len(cols["gram"])
            parts.append(pa.table({
                "kind": pa.array(np.full(size, kind, dtype=np.int32)),
                "range": pa.array(np.full(size, here, dtype=np.int32)),
                **{c: pa.array(cols[c], t) if c in cols else pa.nulls(size, t) for c, t in kinds.items()}}))
        return pa.concat_tables(parts)

    asked = src.mapInArrow(ask, "range int, chunk long, grams binary, counts binary")
    return asked.groupBy("range").applyInArrow(answer, _GRAM_ROWS)


def missed_grams(rows: DataFrame, order: int) -> DataFrame:
    """(gram, value): log10 probability of the grams that training does not have."""
    cur = rows.where(F.col("kind") == _TRAINED).select("gram", "n")
    left = (rows.where(F.col("kind") == _MISS)
            .select("gram", F.col("value").alias("lost"),
                    F.transform(F.filter(F.split(F.hex("data"), "(?<=\\G..)"), lambda x: x != ""),
                                lambda x: F.conv(x, 16, 10).cast("int")).alias("gone")))
    got = []
    for k in range(order - 1, -1, -1):
        if left.isEmpty():
            break
        cur = stored(cur.select(F.col("gram").bitwiseAND(int(_mask(k + 1))).alias("gram"), "n")
                     .groupBy("gram").agg(F.sum("n").alias("n")), f"ppm-{k}")
        left = left.withColumn("ctx", F.shiftright(F.col("gram").bitwiseAND(int(_mask(k + 1))), 8))
        nodes = cur.select(F.shiftright("gram", 8).alias("ctx"),
                           F.struct(F.col("gram").bitwiseAND(255).cast("int").alias("b"), "n").alias("node"))
        nodes = (nodes.join(left.select("ctx").distinct(), "ctx", "left_semi")
                 .groupBy("ctx").agg(F.collect_list("node").alias("seen")))
        # contexts of at most one byte: at most 256 rows
        here = left.join(F.broadcast(nodes) if k < 2 else nodes, "ctx", "left")
        here = here.withColumn("new", F.filter("seen", lambda x: ~F.array_contains(F.col("gone"), x["b"])))
        here = here.select(
            "gram", "lost", "gone", "seen", F.size("new").cast("double").alias("n_new"),
            F.aggregate("new", F.lit(0).cast("long"), lambda acc, x: acc + x["n"]).alias("weight"),
            F.expr("get(filter(new, x -> x.b = cast(gram & 255 as int)), 0).n").alias("n"))
        total = F.col("weight") + F.col("n_new")
        here = here.select(
            "gram",
            (F.col("lost") + F.log10(F.col("n") / total)).alias("value"),
            # nothing new here: the escape is certain
            (F.col("lost") + F.when(F.col("n_new") > 0, F.log10(F.col("n_new") / total)).otherwise(0.0)).alias("lost"),
            F.coalesce(F.transform("seen", lambda x: x["b"]), "gone").alias("gone"))
        here = stored(here, f"ppm-down{k}")
        got.append(here.where("value is not null").select("gram", "value"))
        left = here.where("value is null").select("gram", "lost", "gone")
    out = left.select("gram", (F.col("lost") - F.log10(F.greatest(F.lit(1.0), 256.0 - F.size("gone")))).alias("value"))
    for part in got:
        out = out.unionByName(part)
    return out


def score_texts(docs: DataFrame, learn: Column, model: PpmModel | None = None, id_col: str = "doc_id",
                text_col: str = "text", order: int = ORDER) -> DataFrame:
    """(id, n_tokens, n_known, train_tokens, base_score, score); ``learn`` says
    which rows count as training text.  A ``model`` given replaces the contexts
    of the training text, not the base score's words."""
    src = _chunked(docs, id_col, text_col, learn)
    size = src.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    ranges, gram_ranges = max(16, -(-size // CHUNK)), max(16, -(-size // (2 * CHUNK)))
    counts = stored(word_counts(src, ranges), "ppm-words")
    sums = [_unpack(r.counts) for r in counts.where("chunk = -1").select("counts").toLocalIterator()]
    n_all, v_all = (sum(int(s[i]) for s in sums) for i in (0, 1))
    shared = docs.sparkSession.sparkContext.broadcast(model) if model else None
    kind = docs.schema[id_col].dataType.simpleString()
    empty = F.lit(None).cast("binary")
    answers = counts.where("chunk >= 0").select(
        "chunk", "range", F.col("check").alias("gram"), F.lit(None).cast("double").alias("value"),
        empty.alias("data"), "counts")
    if model is None:
        got = stored(gram_answers(src, gram_ranges, order), "ppm-grams")
        back = got.where(F.col("kind") == _ANSWER).select("chunk", "range", "gram", "value", "data")
        missed = (got.where(F.col("kind") == _ASKED).select("chunk", "gram").join(missed_grams(got, order), "gram")
                  .select("chunk", F.lit(-1).alias("range"), "gram", "value", empty.alias("data")))
        for part in (back, missed):
            answers = answers.unionByName(part.withColumn("counts", empty))

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        for at, batch in enumerate(pieces(batches, 1, 1 << 30, CHUNK)):
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array([_chunk_id(part, at)] * batch.num_rows, pa.int64())],
                names=["id", "text", "learn", "chunk"])

    def split_anew() -> RuntimeError:
        return RuntimeError("the input was split differently in two scans; store it as a table first")

    def gram_scores(seqs: list[bytes], rows: pa.Table) -> np.ndarray:
        g, starts = grams(seqs, order)
        g, at = np.unique(g, return_inverse=True)
        by, part = _by_range(g, gram_ranges)
        dealt, value = g[by], np.full(len(g), np.nan)
        got = rows.filter(pc.is_valid(rows.column("data")))
        for r, check, data in zip(got.column("range").to_pylist(), got.column("gram").to_pylist(),
                                  got.column("data").to_pylist()):
            piece = slice(*np.searchsorted(part, [r, r + 1]))
            here = dealt[piece]
            if not len(here) or int(here.sum() >> np.uint64(1)) != check:
                raise split_anew()
            new = _new_context(here)
            n, total = np.split(_unpack(data).astype(np.float64), [len(here)])
            if len(total) != np.count_nonzero(new):
                raise split_anew()
            at_, known = by[piece], n > 0
            value[at_[known]] = np.log10(n[known] / total[np.cumsum(new) - 1][known])
        late = rows.filter(pc.is_valid(rows.column("value")))
        if late.num_rows:
            value[np.searchsorted(g, late.column("gram").to_numpy().view(np.uint64))] = late.column("value").to_numpy()
        if np.isnan(value).any():
            raise split_anew()
        return np.add.reduceat(value[at], starts)

    def score(texts: pa.Table, rows: pa.Table) -> pa.Table:
        out = {"id": texts.column("id"), "n_tokens": [], "n_known": [], "base_score": []}
        if texts.num_rows:
            digests, seqs, tokens = WordDigests.shared(), [], []
            for text in utf8(texts.column("text")):
                words_ = lower_ascii(text).split()
                seqs.append(b" ".join(words_) + b" " + END if words_ else END)
                tokens += [digests.array(words_), np.array([_END_DIGEST])]
            sizes = np.array([len(x) for x in tokens[::2]]) + 1
            starts = np.cumsum(sizes) - sizes
            d, at = np.unique(np.concatenate(tokens), return_inverse=True)
            full, cut = word_ranges(d, ranges)
            halves = {r: int(x.sum() >> np.uint64(1)) for r, x in zip(full.tolist(), np.split(d, cut))}
            words = rows.filter(pc.is_valid(rows.column("counts")))
            if dict(zip(words.column("range").to_pylist(), words.column("gram").to_pylist())) != halves:
                raise split_anew()
            sent = dict(zip(words.column("range").to_pylist(), words.column("counts").to_pylist()))
            c = np.concatenate([_unpack(sent[r]) for r in full.tolist()]).astype(np.int64)
            part = np.log10((c + 0.1) / (n_all + 0.1 * (v_all + 1)))
            out["n_tokens"] = sizes
            out["n_known"] = np.add.reduceat((c > 0).astype(np.int64)[at], starts)
            out["base_score"] = np.add.reduceat(part[at], starts)
            out["score"] = scorer_of(shared).texts(seqs) if shared else gram_scores(seqs, rows)
        else:
            out["score"] = []
        return pa.table({"id": out["id"], "n_tokens": pa.array(out["n_tokens"], pa.int64()),
                         "n_known": pa.array(out["n_known"], pa.int64()),
                         "base_score": pa.array(out["base_score"], pa.float64()),
                         "score": pa.array(out["score"], pa.float64())})

    numbered = src.mapInArrow(number, f"id {kind}, text string, learn boolean, chunk long")
    got = numbered.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(
        score, f"id {kind}, n_tokens long, n_known long, base_score double, score double")
    return got.select(F.col("id").alias(id_col), "n_tokens", "n_known", F.lit(n_all).cast("long").alias("train_tokens"),
                      "base_score", "score")


_SCORERS: dict[int, PpmScorer] = {}


def scorer_of(shared) -> PpmScorer:
    """The tables are built once per worker process."""
    if id(shared) not in _SCORERS:
        _SCORERS.clear()
        _SCORERS[id(shared)] = shared.value.scorer()
    return _SCORERS[id(shared)]


def op6_ppm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents")
    tenth = fold(F.col("doc_id"), 10)
    return score_texts(docs, tenth != 0).select(
        "doc_id", F.coalesce(fold(F.col("doc_id"), 10) == 0, F.lit(False)).alias("held_out"), "n_tokens", "n_known",
        "train_tokens", "base_score", "score")
