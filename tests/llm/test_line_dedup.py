"""Decisions against brute force over all pairs of lines of a small table."""

import os
import random
import re

import pytest
from pyspark.sql import functions as F

from tandem.llm import line_dedup as D
from tests.llm.helpers import documents, edge_rows

SF = "/root/testdata/sf0.01"


def norm(line):
    return re.sub(r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", " ", line.lower()).strip()


def edit(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        prev, row = row, [i]
        for j, y in enumerate(b, 1):
            row.append(min(row[-1] + 1, prev[j] + 1, prev[j - 1] + (x != y)))
    return row[-1]


def brute(rows, threshold):
    """Groups by edit similarity alone, over all pairs of lines."""
    lines = [(i, n, norm(x)) for i, t in rows for n, x in enumerate((t or "").split("\n"))]
    texts = sorted({x for *_, x in lines if x})
    parent = list(range(len(texts)))
    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for a in range(len(texts)):
        for b in range(a):
            longer = max(len(texts[a]), len(texts[b]))
            far = int((1 - threshold) * longer + 1e-9)
            if abs(len(texts[a]) - len(texts[b])) <= far and edit(texts[a], texts[b]) <= far:
                parent[find(a)] = find(b)
    first = {}
    for i, n, x in sorted(l for l in lines if l[2]):
        first.setdefault(find(texts.index(x)), (i, n))
    out = {}
    for i, n, x in lines:
        d = out.setdefault(i, [0, []])
        if x:
            d[0] += 1
            if first[find(texts.index(x))] != (i, n):
                d[1].append(n)
    return {i: (n, n - len(g), g) for i, (n, g) in out.items()}


def table():
    rnd = random.Random(6)
    stems = [[f"{rnd.choice('abcdefgh')}{rnd.randrange(999)}" for _ in range(30)] for _ in range(6)]
    rows = []
    for i in range(40):
        lines = []
        for _ in range(rnd.randrange(1, 5)):
            t = list(rnd.choice(stems))
            for _ in range(rnd.choice((0, 0, 1, 1, 2))):  # two changed words: found for sure
                t[rnd.randrange(30)] = f"n{rnd.randrange(50)}"
            lines.append(rnd.choice((" ".join(t), " ".join(t).upper() + "!", "  ".join(t))))
        lines += rnd.sample(["Home | About", "home, about", "", "***", "only here %d" % i], 2)
        rows.append((i, "\n".join(lines)))
    return rows


def summary(spark, rows, **params):
    got = D.line_summary(documents(spark, rows), **params).collect()
    return {r.id: (r.n_lines, r.n_kept, list(r.dropped_lines)) for r in got}


def test_decisions_match_brute_force(spark):
    rows = table()
    have = summary(spark, rows)
    assert have == brute(rows, 0.8)
    assert any(k[2] for k in have.values())


def test_large_bucket_in_blocks(spark, monkeypatch):
    """Lines that share two runs and differ beyond the threshold elsewhere, a few
    of them alike: found whatever the blocks."""
    monkeypatch.setattr(D, "_BLOCK", 3)
    rnd = random.Random(8)
    tail = lambda: " ".join(f"{rnd.randrange(10**7)}" for _ in range(8))
    tails = [tail() for _ in range(14)]
    rows = [(i, f"same eight words open each of these lines {t}") for i, t in enumerate(tails)]
    rows += [(100 + i, f"same eight words open each of these lines {t[:-1]}x") for i, t in enumerate(tails[5:9])]
    have = summary(spark, rows)
    assert have == brute(rows, 0.8)
    assert [have[100 + i] for i in range(4)] == [(1, 0, [0])] * 4


def typo(rnd, line):
    i = rnd.randrange(len(line))
    return line[:i] + rnd.choice("abcdefghijklmnopqrstuvwxyz") + line[i + 1:]


def test_copies_with_a_typo_each(spark):
    """No two of them are one typo apart."""
    rnd = random.Random(4)
    line = "when in the course of human events it becomes necessary to dissolve bands"
    rows = [(i, typo(rnd, line)) for i in range(3)]
    assert sorted(summary(spark, rows).values()) == [(1, 0, [0]), (1, 0, [0]), (1, 1, [])]


@pytest.mark.skipif(not os.path.isdir(SF), reason="driver test data not present")
def test_recall_against_edit_similarity_alone(spark):
    """Every distinct line of the table and a copy with one letter changed, at an
    edit similarity of 0.8 or more: nearly all pairs share a bucket."""
    rnd = random.Random(3)
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    lines = [r.norm for r in D.document_lines(docs, "doc_id", "text").where("norm <> ''").select("norm").distinct().collect()]
    pairs = [(x, norm(typo(rnd, x))) for x in lines if len(x) >= 6]
    df = spark.createDataFrame([(x, y) for x, y in pairs if x != y], "x string, y string").where(D.similar("x", "y", 0.8))
    df = df.withColumn("key", F.xxhash64("x", "y"))
    sides = [D.buckets(D.with_hashes(df.select("key", F.col(c).alias("norm")))).select("bucket", "key") for c in ("x", "y")]
    found, n = sides[0].join(sides[1], ["bucket", "key"]).select("key").distinct().count(), df.count()
    assert n > 6000 and found / n >= 0.99


def test_similarity_is_that_of_the_edit_distance(spark):
    rnd = random.Random(5)
    line = lambda: " ".join("".join(rnd.choice("abc") for _ in range(rnd.randint(1, 4))) for _ in range(rnd.randint(1, 6)))
    pairs = [(line(), line()) for _ in range(150)]
    pairs += [(x, typo(rnd, typo(rnd, x))) for x in (line() for _ in range(150))]
    got = spark.createDataFrame(pairs, "x string, y string").select("x", "y", D.similar("x", "y", 0.8).alias("s")).collect()
    for r in got:
        assert r.s == (edit(r.x, r.y) <= int(0.2 * max(len(r.x), len(r.y)) + 1e-9)), r


def test_cleaned_documents(spark):
    rows = [(1, "Alpha beta gamma delta.\nkeep me"), (2, "alpha  BETA gamma delta\nown line\n\n--"), (3, None)]
    docs = documents(spark, rows)
    out = D.clean_documents(docs)
    assert out.columns == docs.columns
    assert {r.doc_id: r.text for r in out.collect()} == {
        1: "Alpha beta gamma delta.\nkeep me", 2: "own line\n\n--", 3: None}


def test_blocks_are_the_majority_of_their_runs(spark):
    words, many = ([f"w{i}" for i in range(n)] for n in (13, 270))
    df = spark.createDataFrame([(" ".join(words),), (" ".join(many),), ("abcdefgh ij",), ("a b",)], "norm string")
    rows = {r.norm: r for r in D.with_hashes(df).collect()}
    units = {" ".join(words): words, " ".join(many): many, "abcdefgh ij": ["abcdefgh ij"[i:i + 3] for i in range(9)]}
    texts = sorted({u for x in units.values() for u in x})
    h = {r.w: r.h & (2**64 - 1) for r in spark.createDataFrame([(t,) for t in texts], "w string")
         .selectExpr("w", "xxhash64(w) AS h").collect()}
    for line, x in units.items():
        q = len(x) // 4
        runs = [x[:q], x[q:2 * q], x[len(x) - 2 * q:len(x) - q], x[len(x) - q:]]
        lanes, width = (8, 7) if q <= 63 else (4, 15)
        want = [sum(1 << (width * lane + bit) for lane in range(lanes) for bit in range(16 // lanes)
                    if 2 * sum((h[u] >> (width * lane + bit)) & 1 for u in run) > q) for run in runs]
        assert rows[line].q == q and rows[line].sig == want, line
    assert rows["a b"].sig is None and rows["a b"].chars == 3 and rows[" ".join(words)].sig_less is None


def test_edges_of_the_input(spark):
    docs = documents(spark, edge_rows())
    got = D.line_summary(docs).collect()
    by = {r.id: r for r in got if r.id is not None}
    # equal (id, text) rows are one document
    assert len(got) == len(edge_rows()) - 1
    assert by[1].n_lines == by[2].n_lines == by[7].n_lines == 0 and by[5].n_kept == 1 and by[6].n_kept == 0
    assert D.line_summary(docs.where("false")).count() == 0
    assert D.clean_documents(docs).count() == len(edge_rows())


def test_runs_of_one_unit_less(spark):
    """``sig_less`` is ``sig`` of the line with a unit less, whichever way it is found."""
    rnd = random.Random(9)
    for n in (8, 12, 40, 252, 256, 260):
        words = [f"w{rnd.randrange(10**6)}" for _ in range(n)]
        q = n // 4 - 1
        # a line of 4 q words with the same four runs of q
        runs = [words[:q], words[q:2 * q], words[n - 2 * q:n - q], words[n - q:]]
        fewer = " ".join(w for r in runs for w in r)
        rows = {r.norm: r for r in D.with_hashes(spark.createDataFrame([(" ".join(words),), (fewer,)], "norm string")).collect()}
        if q * 4 >= D.FEW_WORDS:
            assert rows[fewer].q == q and rows[" ".join(words)].sig_less == rows[fewer].sig, n
        assert len(rows[" ".join(words)].sig_less) == 4


def test_common_ends_are_left_out_of_the_distance(spark):
    """Pairs that differ in the middle, at one end, by a word or by a blank; the
    expensive distance is asked of what is left only."""
    rnd = random.Random(10)
    word = lambda: "".join(rnd.choice("abcd") for _ in range(rnd.randint(1, 5)))
    pairs = [("a b c", "a b"), ("a b", "a b c"), ("a", "a a"), ("a a", "a a a"), ("ab c d", "abc d"), ("x", "x"), ("a b a", "a a")]
    for _ in range(200):
        x = [word() for _ in range(rnd.randint(1, 14))]
        y, at = list(x), rnd.randrange(len(x) + 1)
        y[at:at + rnd.randint(0, 3)] = [word() for _ in range(rnd.randint(0, 3))]
        if y:
            pairs.append((" ".join(x), " ".join(y)))
    got = spark.createDataFrame(pairs, "x string, y string").select("x", "y", D.similar("x", "y", 0.8).alias("s")).collect()
    assert {r.s for r in got} == {True, False}
    for r in got:
        assert r.s == (edit(r.x, r.y) <= int(0.2 * max(len(r.x), len(r.y)) + 1e-9)), r
