"""Fuzzy line dedup across documents (native: DataFrame functions only).

Lines are normalised (lower case; runs of ASCII characters other than letters
and digits become one space) once, and kept in a table.  Equal normalised lines
are one item from the start (a partial aggregate, so a line of any frequency
costs one row a task).

Every distinct line gets a 64-bit SimHash of four blocks of 16 bits.  Its units
(words, or character trigrams in lines of fewer than eight words) are cut into
four runs of q = units div 4: two counted from the start, two from the end; a
block is the SimHash of one run, each bit the majority of its units' hash bits.
So a changed word touches one block, not the whole hash, and a word more or less
shifts only the runs on its side.  Lines that agree in two blocks (one of six
tables) are candidates: by the pigeonhole principle that holds for all pairs with
up to two changed words, or one added, dropped, split or joined (where that
changes q, the line is listed under both), if both have eight words or more.  More changes often leave two runs, or
the majorities, as they are.  Candidates with an edit similarity, 1 - distance /
longer length, of at least ``threshold`` are linked, and one occurrence per
connected group stays: the smallest (id, row, line number).

Buckets are not expanded into all their pairs: members meet the bucket's head
first, and after that only members of different components meet, one of them
outside the bucket's largest component, in blocks of about ``_BLOCK`` by hash, so
that a large bucket is the work of many tasks.

Item identity is a 64-bit hash of the normalised line.  Cases: null or empty
text has no lines with a word; a line of ASCII marks and blanks only is never
dropped; lines of fewer than six characters link with equal ones only; null ids
sort first; equal (id, text) rows are one document (one output row); an empty
table gives an empty result; in :func:`clean_documents` extra columns are kept.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from operator import add, sub

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tandem.llm.common import fresh, load, stored
from tandem.llm.graph import connected_components

THRESHOLD = 0.8
FEW_WORDS = 8
_BLOCK = 2000
_LANES = sum(1 << (7 * j) for j in range(8))  # the lowest bits of eight counters of 7 bits
_BROADCAST_KEYS = 2_000_000   # up to here, keys (16 MB) are sent to the texts, else texts are shuffled


# one by one: the engine looks up single characters in a table, ranges one after the other
_NO_WORD = "[" + "".join(f"\\x{c:02X}" for c in (*range(0x30), *range(0x3A, 0x61), *range(0x7B, 0x80))) + "]+"


def normalise(line: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(line), _NO_WORD, " "))


def document_lines(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, row_key, line_no, norm): every line, at least one per document."""
    return (docs.select(F.col(id_col).alias("id"), F.xxhash64(id_col, text_col).alias("row_key"),
                        F.posexplode(F.split(F.coalesce(F.col(text_col), F.lit("")), "\n")).alias("line_no", "line"))
            .select("id", "row_key", "line_no", normalise(F.col("line")).alias("norm")))


def unit_hashes(norm: Column, words: Column) -> Column:
    """Hashes of a line's words, in order; of its trigrams if the words are few."""
    grams = F.transform(F.sequence(F.lit(1), F.greatest(F.char_length(norm) - 2, F.lit(1))),
                        lambda i: F.xxhash64(norm.substr(i, F.lit(3))))
    return F.when(F.size(words) >= FEW_WORDS, F.transform(words, lambda w: F.xxhash64(w))).otherwise(grams)


def block_hash(hashes: Column, start: Column, q: Column) -> Column:
    """16-bit SimHash of the run of ``q`` hashes from ``start`` (from 1).

    Sums hold several counters each; adding half of a counter's range, less one
    and less q div 2, sets its top bit if more than half of the units have the
    bit.  Up to 63 units take two sums of eight counters of 7 bits, longer runs
    four of four counters of 15 bits (over 2^14 units they run over; the hash is
    coarser then)."""
    run = F.slice(hashes, start, q)

    def count(i: int, mask: int):
        return lambda a, h: F.try_add(a, F.shiftrightunsigned(h, i).bitwiseAND(mask))

    def majorities(width: int, lanes: int) -> Column:
        mask, half = sum(1 << (width * j) for j in range(lanes)), 1 << (width - 1)
        room = (F.lit(half - 1) - F.least(F.floor(q / 2), F.lit(half - 1))).cast("long") * F.lit(mask)
        bits = None
        for i in range(16 // lanes):
            total = F.aggregate(run, F.lit(0).cast("long"), count(i, mask))
            top = F.shiftrightunsigned(F.coalesce(F.try_add(total, room), F.lit(0).cast("long")), width - 1).bitwiseAND(mask)
            bits = top if bits is None else bits.bitwiseOR(F.shiftleft(top, i))
        return bits

    return F.when(q <= 63, majorities(7, 8)).otherwise(majorities(15, 4))


def _run_sums(hashes: Column, start: Column, q: Column) -> list[Column]:
    """The two sums of :func:`block_hash` for a run of up to 63 hashes, the second one bit higher up."""
    run = F.slice(hashes, start, q)
    return [F.aggregate(run, F.lit(0).cast("long"), lambda a, h: a + h.bitwiseAND(_LANES << i)) for i in (0, 1)]


def _majorities(sums: tuple[Column, Column], q: Column) -> Column:
    """The 16 bits from the sums of a run of ``q`` hashes."""
    room = (F.lit(63) - F.floor(q / 2)).cast("long") * F.lit(_LANES)
    top = [F.shiftrightunsigned(F.shiftrightunsigned(s, i) + room, 6).bitwiseAND(_LANES) for i, s in enumerate(sums)]
    return top[0].bitwiseOR(F.shiftleft(top[1], 1))


def with_hashes(lines: DataFrame) -> DataFrame:
    """Adds ``chars``, ``q`` and ``sig``, the hashes of the four runs of ``q``
    units (two from each end), and ``sig_less`` for runs of q - 1 where a line
    with one unit less would have them; null if there are no runs."""
    def bind(d: DataFrame, value: Column, name: str) -> DataFrame:  # found once, then a column
        return d.select("*", F.inline(F.array(F.struct(value.alias(name)))))

    units = F.col("_units")
    n = F.size(units)
    q = F.floor(n / 4).cast("int")
    d = bind(bind(lines, F.split("norm", " "), "_words"), unit_hashes(F.col("norm"), F.col("_words")), "_units")
    d = d.select(*lines.columns, "_units", F.char_length("norm").alias("chars"),
                 F.when(F.char_length("norm") > 5, q).otherwise(0).alias("q"))
    q = F.col("q")
    short = (q > 0) & (q <= 63)

    def starts(q: Column) -> list[Column]:
        return [F.lit(1), q + 1, n - 2 * q + 1, n - q + 1]

    d = bind(d, F.when(short, F.array(*[s for at in starts(q) for s in _run_sums(units, at, q)])), "_sums")
    # the runs of q - 1 are those of q without some units at their ends, and with one of the next run
    gone = [[q - 1], [2 * q - 2, 2 * q - 1], [n - 2 * q, n - 2 * q + 1], [n - q]]
    more = [[], [q - 1], [n - q], []]

    def less(r: int, i: int) -> Column:
        at = lambda p: F.get(units, p).bitwiseAND(_LANES << i)
        return reduce(sub, map(at, gone[r]), reduce(add, map(at, more[r]), F.get("_sums", F.lit(2 * r + i))))

    sig, sig_less = (F.array(*[_majorities((f(r, 0), f(r, 1)), k) for r in range(4)]) for f, k in (
        (lambda r, i: F.get("_sums", F.lit(2 * r + i)), q), (less, q - 1)))
    long_sig, long_less = (F.array(*[block_hash(units, at, k) for at in starts(k)]) for k in (q, q - 1))
    fewer = (q > 1) & (n % 4 == 0)
    return d.select(*lines.columns, "chars", "q", F.when(short, sig).when(q > 0, long_sig).alias("sig"),
                    F.when(short & fewer, sig_less).when(fewer, long_less).alias("sig_less"))


def buckets(sigs: DataFrame) -> DataFrame:
    """(key, chars, q, sig, sig_less) -> (bucket, key, chars): a row for each two blocks."""
    def keys(sig: Column, q: Column) -> list[Column]:
        return [F.when(sig.isNotNull(), F.xxhash64(F.lit(4 * i + j), q, sig[i], sig[j]))
                for i in range(4) for j in range(i + 1, 4)]

    all_keys = keys(F.col("sig"), F.col("q")) + keys(F.col("sig_less"), F.col("q") - 1)
    return sigs.where("sig IS NOT NULL").select(F.explode(F.array_compact(F.array(*all_keys))).alias("bucket"), "key", "chars")


def _edits(a: Column, b: Column, threshold: float) -> Column:
    # the epsilon keeps 0.2 * 10 from rounding down to one edit
    return F.floor((1 - threshold) * F.greatest(a, b) + 1e-9).cast("int")


def _lengths_fit(a: str, b: str, threshold: float) -> Column:
    return F.abs(F.col(a) - F.col(b)) <= _edits(F.col(a), F.col(b), threshold)


def _let(value: Column, then: Callable[[Column], Column]) -> Column:
    """``then(value)``, with ``value`` found once."""
    return F.transform(F.array(value), then)[0]


def _rest(u: Column, v: Column) -> Column:
    """(u, v) without the words that both begin with, the other way round."""
    differ = F.array_position(F.zip_with(u, v, lambda i, j: ~i.eqNullSafe(j)), True).cast("int")  # 0: all equal

    def cut(words: Column, at: Column) -> Column:
        return F.reverse(F.slice(words, F.greatest(at, F.lit(1)), F.when(at > 0, F.size(words)).otherwise(0)))

    return _let(differ, lambda at: F.struct(cut(u, at).alias("u"), cut(v, at).alias("v")))


def similar(a: str, b: str, threshold: float) -> Column:
    """Edit similarity of at least ``threshold``.  Words that both lines begin or
    end with do not change the distance and are left out.  Word by word
    replacement is one way to edit a line into one of as many words; if it is
    short enough, the distance need not be found."""
    x, y = F.col(a), F.col(b)
    most = _edits(F.char_length(x), F.char_length(y), threshold)

    def text(words: Column) -> Column:  # every word with the blank before it
        return F.when(F.size(words) > 0, F.concat(F.lit(" "), F.array_join(words, " "))).otherwise("")

    def near(w: Column) -> Column:
        replaced = F.aggregate(F.zip_with(w.u, w.v, lambda i, j: F.when(i == j, 0).otherwise(
            F.greatest(F.char_length(i), F.char_length(j)))), F.lit(0), lambda s, c: s + c)
        return ((F.size(w.u) == F.size(w.v)) & (replaced <= most)) | _let(
            F.struct(text(w.u).alias("u"), text(w.v).alias("v")),
            lambda t: F.call_function("levenshtein", t.u, t.v, most) >= 0)

    words = F.struct(F.split(x, " ").alias("u"), F.split(y, " ").alias("v"))
    both = _let(_let(words, lambda w: _rest(w.u, w.v)), lambda w: _rest(w.u, w.v))  # from the start, then from the end
    return (F.abs(F.char_length(x) - F.char_length(y)) <= most) & _let(both, near)


def line_links(first: DataFrame, lines: DataFrame, threshold: float) -> DataFrame:
    """Components of fuzzy links, (node, component), of the distinct lines
    ``first`` (key, chars, q, sig, sig_less); ``lines`` (key, norm) has their texts."""
    here = Window.partitionBy("bucket")
    tied = stored(buckets(first).withColumn("n", F.count(F.lit(1)).over(here)).where("n > 1")
                  .withColumn("top", F.max(F.struct("key", "chars")).over(here))
                  .select("bucket", "key", "chars", "n", F.col("top.key").alias("head"), F.col("top.chars").alias("head_chars")),
                  "lines-tied")
    star = (tied.where((F.col("key") != F.col("head")) & _lengths_fit("chars", "head_chars", threshold))
            .select(F.col("key").alias("a"), F.col("head").alias("b")).distinct())
    star = stored(star, "lines-star")
    # texts of all that share a bucket with a line of a like length, once for both rounds
    near = Window.partitionBy("bucket").orderBy("chars", "key")
    like = [_lengths_fit("chars", "_next", threshold), _lengths_fit("chars", "_last", threshold)]
    need = (tied.withColumn("_next", F.lead("chars").over(near)).withColumn("_last", F.lag("chars").over(near))
            .where(F.coalesce(like[0], F.lit(False)) | F.coalesce(like[1], F.lit(False))).select("key").distinct())
    need = stored(need, "lines-need")
    need = F.broadcast(need) if need.count() <= _BROADCAST_KEYS else need
    body = stored(lines.join(need, "key").groupBy("key").agg(F.first("norm").alias("norm")), "lines-bodies")

    def verified(pairs: DataFrame) -> DataFrame:
        both = (pairs.join(body.select(F.col("key").alias("a"), F.col("norm").alias("na")), "a")
                .join(body.select(F.col("key").alias("b"), F.col("norm").alias("nb")), "b"))
        return both.where(similar("na", "nb", threshold)).select(F.col("a").alias("u"), F.col("b").alias("v"))

    edges = stored(verified(star), "lines-links")
    comp = connected_components(edges, "lines-cc")
    placed = (tied.where("n > 2").select("bucket", "key", "chars")
              .join(comp.withColumnRenamed("node", "key"), "key", "left")
              .select("bucket", "key", "chars", F.coalesce("component", "key").alias("comp")))
    sizes = placed.groupBy("bucket", "comp").agg(F.count(F.lit(1)).alias("n"))
    mixed = (sizes.groupBy("bucket")
             .agg(F.max(F.struct("n", "comp")).alias("top"), F.count(F.lit(1)).alias("n_comp"), F.sum("n").alias("n_all"))
             .where("n_comp > 1")
             .select("bucket", F.col("top.comp").alias("major"), (F.col("n_all") - F.col("top.n")).alias("n_minor"), "n_all"))
    open_ = stored(placed.join(mixed, "bucket"), "lines-open")
    cut = {c: F.ceil(F.col(f"n_{c}") / _BLOCK).cast("int") for c in ("minor", "all")}

    def side(c: str, other: str, name: str) -> DataFrame:
        """Members in their block, once for every block of the other side."""
        own, opposite = f"_{c}", f"_{other}"
        return (open_.withColumn(own, F.pmod(F.xxhash64("key"), cut[c]).cast("int"))
                .withColumn(opposite, F.explode(F.sequence(F.lit(0), cut[other] - 1)))
                .select("bucket", "_minor", "_all", F.col("key").alias(name), F.col("chars").alias(f"{name}_chars"),
                        F.col("comp").alias(f"{name}_comp"), *(["major"] if name == "b" else [])))

    minor = side("minor", "all", "a").join(mixed.select("bucket", "major"), "bucket").where("a_comp <> major").drop("major")
    cross = (minor.join(side("all", "minor", "b"), ["bucket", "_minor", "_all"])
             .where((F.col("a_comp") != F.col("b_comp")) & _lengths_fit("a_chars", "b_chars", threshold)
                    & ((F.col("b_comp") == F.col("major")) | (F.col("a") < F.col("b"))))
             .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
    tried = star.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    cross = stored(cross.join(tried, ["a", "b"], "left_anti"), "lines-cross")
    if cross.isEmpty():
        return comp
    more = stored(verified(cross), "lines-links2")
    return comp if more.isEmpty() else connected_components(edges.unionByName(more), "lines-cc2")


def line_decisions(docs: DataFrame, threshold: float = THRESHOLD,
                   id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, row_key, line_no, key, dropped): one row per line; ``key`` is null
    for a line without a word."""
    lines = document_lines(docs, id_col, text_col)
    keyed = with_hashes(lines.withColumn("key", F.when(F.col("norm") != "", F.xxhash64("norm"))))
    table = stored(keyed, "lines-table", "zstd")  # readers take only the columns they need
    worded = table.where("key IS NOT NULL")
    here = F.struct("id", "row_key", "line_no")
    first = stored(worded.groupBy("key").agg(F.min(here).alias("first"), *[F.max(c).alias(c) for c in (
        "chars", "q", "sig", "sig_less")]), "lines-first")
    comp = line_links(first.drop("first"), worded.select("key", "norm"), threshold)
    placed = (first.select("key", "first").join(comp.withColumnRenamed("node", "key"), "key", "left")
              .withColumn("comp", F.coalesce("component", "key")))
    lead = placed.groupBy("comp").agg(F.min("first").alias("lead"))
    lead = stored(placed.select("key", "comp").join(lead, "comp").select("key", "lead"), "lines-lead")
    slim = table.select("id", "row_key", "line_no", "key")
    decided = (slim.where("key IS NOT NULL").join(lead, "key")
               .select("id", "row_key", "line_no", "key", (here != F.col("lead")).alias("dropped")))
    return decided.unionByName(slim.where("key IS NULL").withColumn("dropped", F.lit(False)))


def line_summary(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **params) -> DataFrame:
    """(id, row_key, n_lines, n_kept, dropped_lines) per document; lines count if they hold a word."""
    d = line_decisions(docs, id_col=id_col, text_col=text_col, **params)
    # equal rows repeat line numbers
    out = d.groupBy("id", "row_key").agg(
        F.size(F.collect_set(F.when(F.col("key").isNotNull(), F.col("line_no")))).alias("n_lines"),
        F.sort_array(F.collect_set(F.when(F.col("dropped"), F.col("line_no")))).alias("dropped_lines"))
    return out.select("id", "row_key", F.col("n_lines").cast("long").alias("n_lines"),
                      (F.col("n_lines") - F.size("dropped_lines")).cast("long").alias("n_kept"),
                      "dropped_lines")


def clean_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **params) -> DataFrame:
    """``docs`` without the dropped lines; all columns and rows kept."""
    name, gone = fresh(docs, "_row_key"), fresh(docs, "_dropped")
    found = line_summary(docs, id_col, text_col, **params).select(
        F.col("row_key").alias(name), F.col("dropped_lines").alias(gone))
    kept = F.filter(F.split(F.col(text_col), "\n"), lambda x, i: ~F.array_contains(F.col(gone), i))
    out = docs.withColumn(name, F.xxhash64(id_col, text_col)).join(found, name, "left")
    return out.select(*[F.when(F.col(text_col).isNotNull(), F.array_join(kept, "\n")).alias(text_col)
                        if c == text_col else F.col(f"`{c}`") for c in docs.columns])


def op5_fuzzy_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = line_summary(load(spark, sf_dir, "documents"))
    return out.select(F.col("id").alias("doc_id"), "n_lines", "n_kept", "dropped_lines")
