"""Helpers shared by the operators: tables, word splitting, id folds, scratch tables."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tandem.session import scratch_path, ship_code

SPACES = b" \t\n\x0b\x0c\r"
# Java regex for the same six characters.
SPACE_RE = r"[\x20\x09-\x0D]+"

# Bytes of words ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`` after lower-casing A-Z:
# every other ASCII byte becomes a space; bytes of longer code points stay.
_ALNUM = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32
    for c in range(256)
)
_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def space_words(text: bytes) -> list[bytes]:
    """Words ``[^\\x20\\x09-\\x0D]+``: bytes.split() cuts at just these six."""
    return text.split()


def alnum_words(text: bytes) -> list[bytes]:
    """Lower-cased (A-Z) words of digits, letters and non-ASCII code points."""
    return text.translate(_ALNUM).split()


def lower_ascii(text: bytes) -> bytes:
    return text.translate(_LOWER)


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship_code(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold(doc_id: Column, n: int) -> Column:
    """crc32 of the id as text, mod n; null for a null id."""
    return F.crc32(doc_id.cast("string").cast("binary")) % n


def utf8(column: pa.ChunkedArray | pa.Array) -> list[bytes]:
    """A string column as bytes, null as b''."""
    return [b"" if x is None else x for x in column.cast(pa.binary()).to_pylist()]


def pieces(batches: Iterator[pa.RecordBatch], text: int, rows: int = 1000,
           size: int = 6 << 20) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of at most ``rows`` rows and about ``size``
    bytes of column ``text`` (a longer text comes alone), so that working
    memory follows neither the batch size nor the mix of long texts."""
    for batch in batches:
        lengths = pc.fill_null(pc.binary_length(batch.column(text).cast(pa.binary())), 0).to_numpy()
        ends = np.cumsum(lengths)
        at = 0
        while at < batch.num_rows:
            fits = int(np.searchsorted(ends, (ends[at - 1] if at else 0) + size, side="right"))
            to = max(at + 1, min(at + rows, fits))
            yield batch.slice(at, to - at)
            at = to


@contextmanager
def small_batches(spark: SparkSession, rows: int = 1000) -> Iterator[None]:
    """Jobs started inside send Python at most ``rows`` rows at once: a batch is
    held by both sides, and 10,000 long texts are large."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    was = spark.conf.get(key)
    spark.conf.set(key, str(min(int(was), rows) if int(was) > 0 else rows))
    try:
        yield
    finally:
        spark.conf.set(key, was)


def stored(df: DataFrame, name: str, compression: str = "snappy") -> DataFrame:
    """``df`` written to the shared checkpoint folder and read back: cuts the
    lineage, and survives lost executors."""
    path = scratch_path(df.sparkSession, name)
    df.write.option("compression", compression).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def fresh(df: DataFrame, name: str) -> str:
    """A column name that ``df`` does not have (names compare without case)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


class WordDigests(dict):
    """word -> 8-byte digest, filled on demand and emptied when large, so a
    worker's memory stays bounded whatever the vocabulary."""

    limit = 300_000

    def __missing__(self, word: bytes) -> bytes:
        if len(self) >= self.limit:
            self.clear()
        out = xxhash.xxh3_64_digest(word)
        if len(word) <= 64:
            self[word] = out
        return out

    def array(self, words: list[bytes]) -> np.ndarray:
        return np.frombuffer(b"".join(map(self.__getitem__, words)), dtype=np.uint64)

    @staticmethod
    def shared() -> "WordDigests":
        """One per worker process, kept between tasks and groups."""
        return _SHARED_DIGESTS


_SHARED_DIGESTS = WordDigests()


def mix64(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser: a bijection of 64-bit integers."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))
