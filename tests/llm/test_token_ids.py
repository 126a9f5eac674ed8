"""Ids against whole-text encoding; order, offsets and pruned reads."""

import zlib

import numpy as np
import pyarrow as pa

from tandem.llm import token_ids as T
from tandem.llm.common import small_batches
from tandem.session import scratch_path
from tests.llm.helpers import documents, edge_rows

SF = "/root/testdata/sf0.001"


def whole(text):
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(T.tokenizer_path())
    return t.encode(text or "", add_special_tokens=False).ids + [1]


def test_words_give_the_ids_of_the_text():
    e = T.WordEncoder(T.tokenizer_path())
    texts = ["Don't I'M we'Re. it's, x' 'll", "<|endoftext|> a<|startoftext|>b", "Ünïcödé, ÉTÉ. ŉa ß. İstanbul, ǰ J\u030ca",
             "e\u0301 x\u0301. 中文。ok, 12,3.4 a.b, c.. ..d", "\x00a b\x1fc\u2003d\u00a0e. \ufeffz ﬁ Ａ", "", " ", ".", "a" * 300 + "."]
    for t in texts:
        assert np.frombuffer(e.text(t.encode()), "<u4").tolist() + [1] == whole(t), t
    e.limit = 3  # a table that is emptied again and again
    for t in texts:
        assert np.frombuffer(e.text(t.encode()), "<u4").tolist() + [1] == whole(t), t


def test_other_tokenizers_encode_whole_texts():
    import public_tokenizers
    from tokenizers import Tokenizer
    path = public_tokenizers.path("byte_bpe_50k.json")
    plain, e = Tokenizer.from_file(path), T.WordEncoder(path)
    assert not e.by_words and T.WordEncoder(T.tokenizer_path()).by_words
    for t in ["Hello World, again", " two  spaces\n\nand lines ", "", "Ünï 中文"]:
        assert np.frombuffer(e.text(t.encode()), "<u4").tolist() == plain.encode(t, add_special_tokens=False).ids


def test_query_round_trip(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    path = scratch_path(spark, "ids")
    T.write_tokens(docs, path)
    tokens = T.read_tokens(spark, path)
    got = {r.doc_id: r for r in T.token_digest(tokens).collect()}
    ids = {r.doc_id: list(r.ids) for r in tokens.collect()}
    start = 0
    for r in docs.orderBy("doc_id").collect():
        want = whole(r.text)
        assert ids[r.doc_id] == want
        crc = zlib.crc32(np.array(want, dtype="<u4").tobytes())
        assert (got[r.doc_id].start, got[r.doc_id].n_tokens, got[r.doc_id].ids_crc32) == (start, len(want), crc)
        start += len(want)


def test_reads_are_pruned_by_id(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    path = scratch_path(spark, "ids")
    T.write_tokens(docs, path)
    some = T.read_tokens(spark, path, doc_ids=[3, 77, 10**9])
    assert "PushedFilters: [In(doc_id, [" in some._jdf.queryExecution().executedPlan().toString()
    assert sorted(r.doc_id for r in some.collect()) == [3, 77]


def test_edges_of_the_input(spark):
    docs = documents(spark, edge_rows())
    path = scratch_path(spark, "ids")
    T.write_tokens(docs, path)
    rows = sorted(T.token_digest(T.read_tokens(spark, path)).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in rows] == [1, 2, 3, 4, 5, 5, 6, 7, 8, None, None]
    at = 0
    for r in rows:
        assert r.start == at
        at += r.n_tokens
    assert rows[0].n_tokens == 1
    path = scratch_path(spark, "ids")
    T.write_tokens(docs.where("false"), path)
    assert T.token_digest(spark.read.schema("doc_id long, part int, pos long, ids array<int>").orc(path)).count() == 0


def test_frequent_words_stay_in_a_full_table():
    e, seen = T.WordEncoder(T.tokenizer_path()), []
    e.limit = 40
    encode = e.encode
    e.encode = lambda s: seen.append(s) or encode(s)
    for i in range(300):
        text = f"7often7 a{i}b{i} Letters,;; Ends."
        assert np.frombuffer(e.text(text.encode()), "<u4").tolist() + [1] == whole(text)
        assert len(e) + len(e.older) <= e.limit
    assert seen.count("7often7") == 1


def test_workers_get_small_batches(spark, monkeypatch):
    """The texts and the ids come to Python in batches of at most 1,000 rows."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    was, seen, stored = spark.conf.get(key), [], T.stored
    monkeypatch.setattr(T, "stored", lambda df, name: seen.append(spark.conf.get(key)) or stored(df, name))
    docs = spark.range(2500).selectExpr("id doc_id", "concat('a ', id) text").coalesce(1)
    path = scratch_path(spark, "ids")
    T.write_tokens(docs, path)
    assert T.token_digest(T.read_tokens(spark, path)).count() == 2500
    assert seen == ["1000"] and spark.conf.get(key) == was
    with small_batches(spark):
        sizes = docs.mapInArrow(lambda bs: (pa.RecordBatch.from_pydict({"n": [b.num_rows]}) for b in bs), "n long").collect()
    assert max(r.n for r in sizes) == 1000
