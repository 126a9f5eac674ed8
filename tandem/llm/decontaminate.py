"""Benchmark decontamination by Wu-Manber multi-pattern search over words.

Patterns are the windows of ``window`` consecutive words of every benchmark
item (an item with fewer words is one shorter window).  Windows of one length
m share a matcher: its shift table maps a block of two words to the distance
from the block's last occurrence in any pattern to the pattern's end, so a
block unknown to all patterns skips m - 1 words at once; a block that ends a
pattern has shift 0 and leads, by a hash of the pattern's last words, to a
bucket of candidate patterns, which are compared word by word.  Words are
lower-cased (A-Z) runs of digits, letters and non-ASCII code points.

Spark makes the distinct windows, numbers them and notes whose they are
(:func:`pattern_tables`).  They are dealt to chunks of about ``max_windows``
windows and ``max_bytes`` bytes, in runs of up to 1,024 windows of an item, so a
long item lies in several.  A chunk's plain windows are broadcast (the driver
hands on one chunk at a time and builds nothing); a worker makes the matchers of
its chunk.  A chunk is one read of the documents, and what it leaves is a table
of spans and window numbers, never texts.  Items are looked up once for each
distinct set of windows, not for each document.

Cases: a null or empty document has no words and is clean; an item without
words has no window; with ``null_ids`` (the query, OP4_SQL and the pipeline) the
windows of items with a null id count for hits and verdict, but such items are in
neither ``n_items`` nor the id list; equal item ids count once; repeated
document rows are judged alike; an empty benchmark leaves everything clean.
"""

from __future__ import annotations

import uuid
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tandem.llm.common import alnum_words, fresh, load, pieces, stored, utf8
from tandem.session import scratch_path

WINDOW = 10
MAX_WINDOWS = 200_000
MAX_BYTES = 64 << 20
_RUN = 1024                    # windows of an item that stay in one chunk
_BROADCAST_ROWS = 2_000_000    # up to here, keys of hit documents (16 bytes each) are sent to the documents


class WuManber:
    """Matcher for patterns of one length (in words)."""

    def __init__(self, length: int):
        self.length = length
        self.block = min(2, length)
        self.shift: dict = {}
        self.buckets: dict = defaultdict(dict)  # suffix -> {pattern: set of items}

    def _suffix(self, pattern: tuple) -> tuple | bytes:
        return pattern[-1] if self.block == 1 else (pattern[-2], pattern[-1])

    def add(self, pattern: tuple, item: str) -> None:
        m, b = self.length, self.block
        found = self.buckets[self._suffix(pattern)]
        if pattern in found:
            found[pattern].add(item)
            return
        found[pattern] = {item}
        for end in range(b, m + 1):
            key = pattern[end - 1] if b == 1 else (pattern[end - 2], pattern[end - 1])
            self.shift[key] = min(self.shift.get(key, m), m - end)

    def search(self, words: list[bytes]) -> Iterator[tuple[int, set]]:
        """(start, items) of every occurrence."""
        m, get, buckets = self.length, self.shift.get, self.buckets
        n, pos = len(words), self.length - 1
        if self.block == 1:
            while pos < n:
                step = get(words[pos], m)
                if not step:
                    yield from self._compare(words, pos)
                pos += step or 1
            return
        skip = m - 1  # an unknown block may still hold a pattern's first word
        while pos < n:
            step = get((words[pos - 1], words[pos]), skip)
            if not step:
                yield from self._compare(words, pos)
            pos += step or 1

    def _compare(self, words: list[bytes], pos: int) -> Iterator[tuple[int, set]]:
        start = pos - self.length + 1
        suffix = words[pos] if self.block == 1 else (words[pos - 1], words[pos])
        here = tuple(words[start:pos + 1])
        for pattern, items in self.buckets.get(suffix, {}).items():
            if pattern == here:
                yield start, items


def item_windows(words: list[bytes], window: int = WINDOW) -> Iterator[bytes]:
    """Windows of an item, words joined by a blank (which no word holds)."""
    for i in range(max(1, len(words) - window + 1) if words else 0):
        yield b" ".join(words[i:i + window])


def matchers(windows: Iterator[tuple[bytes, int]]) -> list[WuManber]:
    """A matcher for every length that occurs, of (window, number)."""
    by_length: dict[int, WuManber] = {}
    known: dict[bytes, bytes] = {}  # a word's one copy
    for text, pid in windows:
        words = tuple(known.setdefault(w, w) for w in text.split(b" "))
        by_length.setdefault(len(words), WuManber(len(words))).add(words, pid)
    return list(by_length.values())


def spans(words: list[bytes], found: list[WuManber]) -> tuple[list[tuple[int, int]], list[int]]:
    """Hit words as disjoint spans [from, to) in order, and the numbers of the windows that occur."""
    seen: set[int] = set()
    at = []
    for m in found:
        for start, which in m.search(words):
            at.append((start, start + m.length))
            seen |= which
    merged: list[tuple[int, int]] = []
    for start, end in sorted(at):
        if merged and start <= merged[-1][1]:
            merged[-1] = (merged[-1][0], max(end, merged[-1][1]))
        else:
            merged.append((start, end))
    return merged, sorted(seen)


@dataclass(frozen=True)
class Patterns:
    """Written tables: (chunk, pat, pid) and whose a window is, (pid, item)."""
    windows: DataFrame
    owners: DataFrame
    chunks: int


def pattern_tables(benchmark: DataFrame, window: int = WINDOW, max_windows: int = MAX_WINDOWS,
                   max_bytes: int = MAX_BYTES, id_col: str = "item_id", text_col: str = "text",
                   null_ids: bool = False) -> Patterns:
    src = (benchmark.where(F.col(id_col).isNotNull() | F.lit(null_ids))
           .select(F.col(id_col).cast("string").alias("item"), F.col(text_col).cast("string").alias("text"))
           .where("text is not null"))
    run_length = min(_RUN, max_windows)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def batch_of(rows: list) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(
                zip(*rows), (pa.binary(), pa.string(), pa.int64()))], names=["pat", "item", "run"])

        for batch in pieces(batches, 1):
            rows = []
            for item, text in zip(batch.column(0).to_pylist(), utf8(batch.column(1))):
                seed = xxhash.xxh64_intdigest(text)
                for i, pat in enumerate(item_windows(alnum_words(text), window)):
                    rows.append((pat, item, xxhash.xxh64_intdigest(b"%d" % (i // run_length), seed) >> 1))
                    if len(rows) >= 20_000:
                        yield batch_of(rows)
                        rows = []
            if rows:
                yield batch_of(rows)

    spark = benchmark.sparkSession
    owned = stored(src.mapInArrow(cut, "pat binary, item string, run long")
                   .groupBy("pat", "item").agg(F.min("run").alias("run")), "decontaminate-owned")
    numbered = stored(owned.groupBy("pat").agg(F.min("run").alias("run"))
                      .withColumn("pid", F.monotonically_increasing_id()), "decontaminate-numbered")
    n, size = numbered.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.length("pat")), F.lit(0))).first()
    chunks = max(1, -(-n // max_windows), -(-size // max_bytes))
    path = scratch_path(spark, "decontaminate-windows")
    (numbered.select("pat", "pid", F.pmod("run", F.lit(chunks)).cast("int").alias("chunk"))
     .repartition(chunks, "chunk").write.partitionBy("chunk").parquet(path))
    windows = spark.read.schema("pat binary, pid long, chunk int").parquet(path)
    owners = stored(owned.where("item is not null").join(numbered, "pat").select("pid", "item"), "decontaminate-owners")
    return Patterns(windows, owners, chunks)


_BUILT: dict[str, list[WuManber]] = {}  # in a worker: the matchers of the chunk at hand


class _Chunk:
    """One chunk's windows for the workers, which build its matchers once each."""

    def __init__(self, patterns: Patterns, i: int):
        got = patterns.windows.where(F.col("chunk") == i).select("pat", "pid").toArrow()
        self.name, self.shared = uuid.uuid4().hex, patterns.windows.sparkSession.sparkContext.broadcast(got)

    def matchers(self) -> list[WuManber]:
        if self.name not in _BUILT:
            _BUILT.clear()
            table = self.shared.value
            _BUILT[self.name] = matchers(zip(table.column("pat").to_pylist(), table.column("pid").to_pylist()))
        return _BUILT[self.name]


def _searched(docs: DataFrame, chunk: _Chunk, id_col: str, text_col: str, every: bool) -> DataFrame:
    """(id, key, n_words, spans, pids) of the documents with a hit, or of every one; written."""
    text = F.col(text_col).cast("string")
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = chunk.matchers()
        for batch in pieces(batches, 2):
            counts, at, pids = [], [], []
            for t in utf8(batch.column(2)):
                words = alnum_words(t)
                hit, which = spans(words, found)
                counts.append(len(words))
                at.append([{"s": s, "e": e} for s, e in hit])
                pids.append(which)
            out = pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(counts, pa.int64()),
                 pa.array(at, pa.list_(pa.struct([("s", pa.int32()), ("e", pa.int32())]))),
                 pa.array(pids, pa.list_(pa.int64()))], names=["id", "key", "n_words", "spans", "pids"])
            yield out if every else out.filter(pa.array([bool(p) for p in pids], pa.bool_()))

    found = (docs.select(F.col(id_col).alias("id"), F.xxhash64(text).alias("key"), text.alias("text"))
             .mapInArrow(run, f"id {kind}, key long, n_words long, spans array<struct<s:int,e:int>>, pids array<long>"))
    return stored(found, "decontaminate-hits")


def _covered(all_spans: Column) -> Column:
    """Number of words in the union of the spans."""
    zero = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).alias("to"))
    return F.aggregate(
        F.array_sort(all_spans), zero,
        lambda a, x: F.struct((a["n"] + F.greatest(F.lit(0), x["e"] - F.greatest(x["s"], a["to"]))).alias("n"),
                              F.greatest(a["to"], x["e"]).alias("to")),
        lambda a: a["n"])


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, max_windows: int = MAX_WINDOWS,
                  id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
                  item_text_col: str = "text", null_ids: bool = False, max_bytes: int = MAX_BYTES) -> DataFrame:
    """One row per document: id, words, hit words, items found and the verdict."""
    patterns = pattern_tables(benchmark, window, max_windows, max_bytes, item_col, item_text_col, null_ids)
    first, *others = [_searched(docs, _Chunk(patterns, i), id_col, text_col, i == 0) for i in range(patterns.chunks)]
    found = first
    if others:
        rest = others[0].withColumn("chunk", F.lit(1))
        for i, other in enumerate(others[1:], 2):
            rest = rest.unionByName(other.withColumn("chunk", F.lit(i)))
        # repeated rows fold first, so a group is at most one row a chunk
        rest = (rest.groupBy("id", "key", "chunk").agg(F.first("spans").alias("spans"), F.first("pids").alias("pids"))
                .groupBy(F.col("id").alias("_id"), F.col("key").alias("_key"))
                .agg(F.flatten(F.collect_list("spans")).alias("_spans"), F.flatten(F.collect_list("pids")).alias("_pids")))
        both = first.join(rest, F.col("id").eqNullSafe(F.col("_id")) & (F.col("key") == F.col("_key")), "left")

        def and_more(c: str) -> Column:
            return F.when(F.col(f"_{c}").isNull(), F.col(c)).otherwise(F.concat(c, f"_{c}")).alias(c)

        found = stored(both.select("id", "n_words", and_more("spans"), F.array_sort(and_more("pids")).alias("pids")),
                       "decontaminate-merged")
    found = found.select("id", "n_words", _covered(F.col("spans")).alias("n_hit"), "pids")
    hit, clean = found.where("n_hit > 0"), found.where("n_hit = 0")
    sets = hit.select("pids").distinct()
    lists = (sets.select("pids", F.explode("pids").alias("pid")).join(patterns.owners, "pid")
             .groupBy("pids").agg(F.array_sort(F.collect_set("item")).alias("items")))
    no_items = F.array().cast("array<string>")
    out = (hit.join(lists, "pids", "left").select("id", "n_words", "n_hit", F.coalesce("items", no_items).alias("items"))
           .unionByName(clean.select("id", "n_words", "n_hit", no_items.alias("items"))))
    return out.select(F.col("id").alias(id_col), "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                      F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
                      (F.col("n_hit") > 0).alias("contaminated"))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, max_windows: int = MAX_WINDOWS,
                      text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text",
                      null_ids: bool = False, max_bytes: int = MAX_BYTES) -> DataFrame:
    """The rows of ``docs`` without any hit word, with all their columns.  One
    chunk filters as it reads; of more, the keys of hit texts are gathered and
    taken out by one anti join."""
    patterns = pattern_tables(benchmark, window, max_windows, max_bytes, item_col, item_text_col, null_ids)
    if patterns.chunks == 1:
        at, chunk = docs.columns.index(text_col), _Chunk(patterns, 0)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            found = chunk.matchers()
            for batch in pieces(batches, at):
                keep = [not spans(alnum_words(t), found)[1] for t in utf8(batch.column(at))]
                yield batch.filter(pa.array(keep, pa.bool_()))

        return docs.mapInArrow(run, docs.schema)
    text = F.col(text_col).cast("string")
    names = [fresh(docs, f"_text_{x}") for x in ("a", "b")]
    keys = [F.xxhash64(text).alias(names[0]), F.xxhash64(F.lit(1), text).alias(names[1])]
    marked = docs.select("*", *keys)
    gone = None
    for i in range(patterns.chunks):
        # the two hashes stand for the text: its rows are judged alike
        got = _searched(marked.select(F.struct(*names).alias("id"), text.alias("text")), _Chunk(patterns, i),
                        "id", "text", False).select("id.*")
        gone = got if gone is None else gone.unionByName(got)
    gone = stored(gone.distinct(), "decontaminate-gone")
    gone = F.broadcast(gone) if gone.count() <= _BROADCAST_ROWS else gone
    return marked.join(gone, names, "left_anti").select(*docs.columns)


def op4_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination(load(spark, sf_dir, "documents"), load(spark, sf_dir, "benchmark"), null_ids=True)


OP4_SQL = r"""
WITH d AS (
  SELECT rowid_ AS r, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM (SELECT row_number() OVER () AS rowid_, doc_id, text FROM documents)
), b AS (
  SELECT CAST(item_id AS VARCHAR) AS item,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark
), p AS (
  SELECT DISTINCT item, least(10, len(w)) AS m, array_to_string(w[i:i + least(10, len(w)) - 1], ' ') AS pat
  FROM (SELECT item, w, unnest(range(1, greatest(1, len(w) - 9) + 1)) AS i FROM b WHERE len(w) > 0)
), lens AS (SELECT DISTINCT m FROM p),
pos AS (
  SELECT r, m, i, array_to_string(w[i:i + m - 1], ' ') AS win
  FROM (SELECT r, w, m, unnest(range(1, len(w) - m + 2)) AS i FROM d, lens WHERE len(w) >= m)
), occ AS (SELECT r, i, pos.m, item FROM pos JOIN p ON pos.m = p.m AND win = pat),
hit AS (SELECT r, count(DISTINCT k) AS n_hit FROM (SELECT r, unnest(range(i, i + m)) AS k FROM occ) GROUP BY r),
its AS (SELECT r, count(item) AS n_items, string_agg(item, ',' ORDER BY item) AS s
        FROM (SELECT DISTINCT r, item FROM occ) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(s, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit USING (r) LEFT JOIN its USING (r)
"""


def stage_decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: documents that hold a benchmark window go."""
    return drop_contaminated(docs, load(spark, sf_dir, "benchmark"), null_ids=True)
