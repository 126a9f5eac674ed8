"""Wu-Manber against naive search, in one chunk and in many."""

import hashlib
import random

from tandem.llm import decontaminate as D
from tests.llm.helpers import documents, edge_rows, lower_words


def brute(text, items):
    w = lower_words(text)
    hit, found = set(), set()
    for item, t in items:
        p = lower_words(t)
        if item is None or not p:
            continue
        m = min(10, len(p))
        for k in range(len(p) - m + 1):
            for i in range(len(w) - m + 1):
                if w[i:i + m] == p[k:k + m]:
                    hit.update(range(i, i + m))
                    found.add(str(item))
    digest = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
    return len(w), len(hit), len(found), digest, bool(hit)


def tables(spark):
    rnd = random.Random(3)
    voc = ["a", "b", "c", "D", "é"]
    items = [(i, " ".join(rnd.choice(voc) for _ in range(n))) for i, n in
             enumerate([1, 2, 3, 4, 9, 10, 11, 14, 12, 10])]
    items[0] = (0, "rareword")
    items[1] = (1, "c, rare")
    items += [(20, None), (21, ""), (None, "a b"), (5, items[5][1]), (22, "!!")]
    rows = [(i, " ".join(rnd.choice(voc) for _ in range(rnd.randrange(60)))) for i in range(40)]
    rows += [(100, "x " + items[7][1].upper() + " y " + items[7][1]), (101, "C rare rareword"), (102, "c  RARE.")]
    rows += edge_rows()
    return rows, items, documents(spark, rows), spark.createDataFrame(items, "item_id long, text string")


def test_matches_naive_search(spark):
    rows, items, docs, bench = tables(spark)
    want = sorted((-1 if i is None else i, *brute(t, items)) for i, t in rows)
    for max_windows in (200_000, 4):
        got = D.contamination(docs, bench, max_windows=max_windows).collect()
        assert sorted((-1 if r[0] is None else r[0], *r[1:]) for r in got) == want
        left = D.drop_contaminated(docs, bench, max_windows=max_windows)
        assert left.columns == docs.columns
        assert sorted((-1 if r.doc_id is None else r.doc_id) for r in left.collect()) == \
            [i for i, *_, bad in want if not bad]


def test_shifts_skip_and_find_overlaps():
    rnd = random.Random(8)
    for length in range(1, 11):
        m = D.WuManber(length)
        pats = [tuple(rnd.choice([b"a", b"b", b"c"]) for _ in range(length)) for _ in range(5)]
        for i, p in enumerate(pats):
            m.add(p, str(i))
        words = [rnd.choice([b"a", b"b", b"c", b"d"]) for _ in range(400)] + list(pats[0])
        want = sorted((i, str(k)) for i in range(len(words) - length + 1) for k, p in enumerate(pats)
                      if tuple(words[i:i + length]) == p)
        got = sorted((i, x) for i, items in m.search(words) for x in items)
        assert got == want


def test_empty_benchmark(spark):
    _, _, docs, bench = tables(spark)
    got = D.contamination(docs, bench.where("false")).collect()
    assert not any(r.contaminated for r in got)
    assert D.contamination(docs.where("false"), bench).count() == 0


def test_items_without_an_id_hit_in_query_and_stage(spark, tmp_path):
    docs = documents(spark, [(1, "x secret passage y"), (2, "clean"), (3, "named one secret passage")])
    bench = spark.createDataFrame([(None, "Secret passage"), (None, "named"), (7, "named one"), (None, None)],
                                  "item_id long, text string")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    bench.write.parquet(f"{tmp_path}/benchmark.parquet")
    none, seven = (hashlib.sha256(x).hexdigest() for x in (b"", b"7"))
    got = sorted(tuple(r) for r in D.op4_benchmark_decontamination(spark, str(tmp_path)).collect())
    assert got == [(1, 4, 2, 0, none, True), (2, 1, 0, 0, none, False), (3, 4, 4, 1, seven, True)]
    assert [r.doc_id for r in D.stage_decontaminate(spark, docs, str(tmp_path)).collect()] == [2]
    for max_windows in (1, 2):  # over several passes
        again = D.contamination(docs, bench, max_windows=max_windows, null_ids=True).collect()
        assert sorted(tuple(r) for r in again) == got


def test_query_and_sql_agree_on_items_without_an_id(spark, tmp_path):
    import duckdb
    rows, items, docs, bench = tables(spark)
    # the longest text is left to the brute-force test: the SQL unnests its words for every window
    docs.where("doc_id <> 4").write.parquet(f"{tmp_path}/documents.parquet")
    bench.write.parquet(f"{tmp_path}/benchmark.parquet")
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{tmp_path}/{t}.parquet/*.parquet'")
    want = sorted(con.execute(D.OP4_SQL).fetchall())
    got = D.op4_benchmark_decontamination(spark, str(tmp_path))
    assert sorted(tuple(r) for r in got.collect()) == want
    assert any(hit and not n for _, _, hit, n, _, _ in want)


def test_a_long_item_lies_in_several_bounded_chunks(spark):
    words = [f"w{i}" for i in range(6000)]
    bench = spark.createDataFrame([(1, " ".join(words)), (2, " ".join(words[:50]))], "item_id long, text string")
    found = D.pattern_tables(bench, max_windows=1500)
    sizes = [r["count"] for r in found.windows.groupBy("chunk").count().collect()]
    assert found.chunks == 4 and len(sizes) > 1 and sum(sizes) == 5991 and max(sizes) < 5991
    assert D.pattern_tables(bench, max_bytes=100_000).chunks > 1
    docs = documents(spark, [(1, " ".join(words[20:5000])), (2, " ".join(words[100:109])), (2, " ".join(words[100:111]))])
    got = sorted(tuple(r)[:4] for r in D.contamination(docs, bench, max_windows=1500).collect())
    assert got == [(1, 4980, 4980, 2), (2, 9, 0, 0), (2, 11, 11, 1)]
