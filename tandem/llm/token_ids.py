"""Token ids in ORC files, written in ascending document order and read back.

Every text is encoded with a public tokenizer file of the ``tokenizers``
library and gets an end id.  Rows are range-partitioned and sorted by document
id, so each ORC file holds a range of ids and each stripe a narrower one.
The ids are an ``array<int>`` column: ORC stores it as integer run lengths in
stripes, with a row index (min and max every ``row_index_stride`` rows) and a
Bloom filter on the document id.  :func:`read_tokens` reads stripes in
parallel, and with ``doc_ids`` the filter is pushed down, so stripes and row
groups whose metadata exclude the ids are not decoded.

Words between ASCII spaces are encoded once per worker and remembered: the
default tokenizer drops white space and never joins across it, so a text's ids
are those of its words in order (a test holds this against whole-text encoding).
A tokenizer file with another normaliser or pre-tokenizer encodes whole texts.

Memory: a worker's word table is bounded and given up when the files are read,
and Spark sends the workers batches of at most 1,000 rows.

Cases: null is an empty text and gives just the end id; null document ids come
last; rows with equal ids are ordered by a hash of the text, so reruns agree;
an empty table gives an empty ORC table; extra columns are not written.
"""

from __future__ import annotations

import json
import os
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tandem.llm.common import WordDigests, load, pieces, small_batches, stored, utf8
from tandem.session import scratch_path

END_ID = 1
_WORKERS: dict[str, "WordEncoder"] = {}


def tokenizer_path() -> str:
    import public_tokenizers
    return public_tokenizers.path("word_bpe_49k.json")


def _byte_letters() -> dict[int, str]:
    """The character that byte-level BPE puts for each byte: itself if it is
    printable, else the next unused one from U+0100 on."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    spare = iter(range(256, 512))
    return {b: chr(b if b in printable else next(spare)) for b in range(256)}


_LETTERS = _byte_letters()


def drops_white_space(tokenizer) -> bool:
    """The tokenizer lower-cases, splits by a pattern without white space, drops
    what is between, and spells bytes by byte-level letters: words are independent."""
    d = json.loads(tokenizer.to_str())
    steps = (d.get("pre_tokenizer") or {}).get("pretokenizers", [])
    return ([n["type"] for n in (d.get("normalizer") or {}).get("normalizers", [])] == ["NFC", "Replace", "Lowercase"]
            and [p["type"] for p in steps] == ["Split", "ByteLevel"] and d["model"]["type"] == "BPE"
            and steps[0]["behavior"] == "Removed" and steps[0]["invert"] and "[^\\s" in steps[0]["pattern"].get("Regex", "")
            and not steps[1]["add_prefix_space"] and not steps[1]["use_regex"])


class WordEncoder(dict):
    """word -> its ids as little-endian unsigned 32-bit integers.

    ``limit`` bounds the memory: when half of it is full, the words kept before
    that are dropped, but for those met since, so frequent words stay.  A word of
    Latin letters is one piece for the tokenizer, so its lower-case form goes to
    the tokenizer's BPE model at once; the ASCII marks after it are a piece of
    their own.  All other words take the tokenizer's whole path.
    """

    limit = 400_000
    marks = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"  # an apostrophe may begin a piece with letters

    def __init__(self, path: str):
        super().__init__()
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark spreads the work
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.by_words = drops_white_space(self.tokenizer)
        self.older: dict[bytes, bytes] = {}

    def encode(self, word: str) -> bytes:
        ids = self.tokenizer.encode(word, add_special_tokens=False).ids
        return np.array(ids, dtype="<u4").tobytes()

    def _letters(self, word: str) -> bytes:
        """Ids of a lower-case word of Latin letters."""
        piece = word if word.isascii() else word.encode().decode("latin-1").translate(_LETTERS)
        return b"".join([t.id.to_bytes(4, "little") for t in self.model.tokenize(piece)])

    def _encoded(self, word: bytes) -> bytes:
        s = word.decode()
        core = s.rstrip(self.marks)
        # below U+0250 letters have one lower-case form (but U+0130) and no combining marks
        if core.isalpha() and (core.isascii() or (max(core) < "\u0250" and "\u0130" not in core)):
            low = core.lower()
            if low == s:
                return self._letters(low)
            return self[low.encode()] + (self[s[len(core):].encode()] if len(core) < len(s) else b"")
        return self.encode(s)

    def __missing__(self, word: bytes) -> bytes:
        got = self.older.get(word)
        if got is None:
            got = self._encoded(word)
        if len(word) <= 64:
            if 2 * len(self) >= self.limit:
                self.older = dict(self)
                self.clear()
            self[word] = got
        return got

    def text(self, text: bytes) -> bytes:
        if not self.by_words:
            return self.encode(text.decode())
        return b"".join(map(self.__getitem__, text.split()))

    @staticmethod
    def of(path: str) -> "WordEncoder":
        """One per worker process, kept between tasks until files are read."""
        if path not in _WORKERS:
            WordDigests.shared().clear()  # an earlier step's words
            _WORKERS[path] = WordEncoder(path)
        return _WORKERS[path]


def write_tokens(docs: DataFrame, path: str, tokenizer: str | None = None, end_id: int = END_ID,
                 row_index_stride: int = 1000, stripe_bytes: int = 64 << 20,
                 id_col: str = "doc_id", text_col: str = "text") -> None:
    """ORC files below ``path``: (id, part, pos, ids), ascending in (part, pos)."""
    tokenizer = tokenizer or tokenizer_path()
    end = np.array([end_id], dtype="<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = WordEncoder.of(tokenizer)
        part, pos = TaskContext.get().partitionId(), 0
        for batch in pieces(batches, 1):
            rows = [encoder.text(t) + end for t in utf8(batch.column(1))]
            offsets = np.zeros(len(rows) + 1, dtype=np.int32)
            np.cumsum([len(r) // 4 for r in rows], out=offsets[1:])
            ids = np.frombuffer(b"".join(rows), dtype="<i4")
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(np.full(len(rows), part, dtype=np.int32)),
                 pa.array(np.arange(pos, pos + len(rows), dtype=np.int64)),
                 pa.ListArray.from_arrays(pa.array(offsets), pa.array(ids))],
                names=[id_col, "part", "pos", "ids"])
            pos += len(rows)

    kind = docs.schema[id_col].dataType.simpleString()
    ordered = (docs.select(F.col(id_col), F.col(text_col).cast("string"))
               .orderBy(F.col(id_col).asc_nulls_last(), F.xxhash64(text_col)))
    with small_batches(docs.sparkSession):
        (ordered.mapInArrow(run, f"`{id_col}` {kind}, part int, pos long, ids array<int>")
         .write.option("orc.bloom.filter.columns", id_col).option("orc.bloom.filter.fpp", "0.01")
         .option("orc.row.index.stride", str(row_index_stride)).option("orc.stripe.size", str(stripe_bytes))
         .option("orc.create.index", "true").orc(path))


def read_tokens(spark: SparkSession, path: str, doc_ids: list | None = None, id_col: str = "doc_id") -> DataFrame:
    """The rows of ``path``; with ``doc_ids`` only theirs, pruned by metadata."""
    df = spark.read.orc(path)
    return df if doc_ids is None else df.where(F.col(id_col).isin(list(doc_ids)))


def token_digest(tokens: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """(id, start, n_tokens, ids_crc32) of every row, from the files alone.

    ``start`` is a prefix sum in two levels: totals per written part (one row
    each) and running sums within a part, so no task sees all rows.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _WORKERS.clear()  # the writers' word tables
        for batch in batches:
            ids = batch.column(3)
            flat = np.ascontiguousarray(ids.flatten().to_numpy(zero_copy_only=False).astype("<u4"))
            ends = np.cumsum(ids.value_lengths().to_numpy(zero_copy_only=False))
            starts = np.concatenate([[0], ends[:-1]]) if len(ends) else ends
            crc = [zlib.crc32(flat[a:b].data) for a, b in zip(starts, ends)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), batch.column(2),
                 pa.array(ends - starts, pa.int64()), pa.array(crc, pa.int64())],
                names=["id", "part", "pos", "n_tokens", "ids_crc32"])

    kind = tokens.schema[id_col].dataType.simpleString()
    with small_batches(tokens.sparkSession):
        rows = stored(tokens.select(id_col, "part", "pos", "ids").mapInArrow(
            run, f"id {kind}, part int, pos long, n_tokens long, ids_crc32 long"), "token-digest")
    before = W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    parts = (rows.groupBy("part").agg(F.sum("n_tokens").alias("total"))
             .select("part", F.coalesce(F.sum("total").over(before), F.lit(0)).alias("offset")))
    inside = W.partitionBy("part").orderBy("pos").rowsBetween(W.unboundedPreceding, -1)
    return (rows.withColumn("inner", F.coalesce(F.sum("n_tokens").over(inside), F.lit(0)))
            .join(parts, "part")
            .select(F.col("id").alias(id_col), (F.col("offset") + F.col("inner")).alias("start"),
                    "n_tokens", "ids_crc32"))


def op8_token_ids_orc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stage_token_ids(spark, load(spark, sf_dir, "documents"), sf_dir)


def stage_token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: the corpus as token ids in ORC; returns their digest."""
    path = scratch_path(spark, "token-ids")
    write_tokens(docs, path)
    return token_digest(read_tokens(spark, path))
