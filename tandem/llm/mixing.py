"""Mixing sources to target weights by pivotal dependent rounding.

A document of a source with target / size ratio r is copied floor(r) times,
plus once more with the fractional probability.  The fractions are rounded
together, not one by one: two documents meet, a random amount of probability
mass (counted in words) moves from one to the other until one of them is 0 or
1, and the other goes on to meet the next.  Every document keeps its own
probability on average, and the words of a source stay exactly constant; only
its very last undecided document is drawn on its own.

Meetings run inside chunks of rows dealt by hash (so a hot source is spread
over all of them); each chunk leaves at most one undecided document per
source, and those meet again in groups of ``fan_in`` chunks, level by level,
until a source has one left: a distributed reduction tree.

To end near the target even where single documents are long, a source's long
documents are rounded first, and its short ones (size classes that hold at
least ``fine_share`` of its words) are given what is then left of the target;
the last undecided document is so a short one.

Random numbers are hashes of row content, level and seed: reruns agree.

Cases: null text has size 0; documents of size 0 are never taken; a null
source is a source of its own (last in order); repeated rows are separate
candidates; an empty table gives an empty result; in :func:`mix_documents`
extra columns are kept.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tandem.llm.common import fresh, load, mix64, stored

WEIGHTS = (1, 2, 3)
MAX_REPEAT = 3
_EPS = 1e-12


def word_count(text: Column) -> Column:
    """Number of ``[^\\x20\\x09-\\x0D]+``; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights: tuple = WEIGHTS, max_repeat: float = MAX_REPEAT) -> DataFrame:
    """(source, size) -> one row per source: (grp, source, source_size, target).

    Weighted water filling: target = min(cap, weight * level) with the level
    at which targets add up to all words.  With sources in order of cap /
    weight, level(i) = (total - caps before i) / (weights from i on) grows while
    sources are capped and falls after, so the right level is the largest one.
    The windows run over one row per source.
    """
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    order = W.orderBy(F.col("source").asc_nulls_last())
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]),
                     ((F.row_number().over(order) - 1) % len(weights) + 1).cast("int"))
    per = (per.withColumn("grp", F.row_number().over(order)).withColumn("w", w)
           .withColumn("cap", F.col("source_size") * F.lit(float(max_repeat))))
    every = W.partitionBy()
    by_cap = W.orderBy(F.col("cap") / F.col("w"), "grp").rowsBetween(W.unboundedPreceding, -1)
    level = ((F.sum("source_size").over(every) - F.coalesce(F.sum("cap").over(by_cap), F.lit(0.0)))
             / (F.sum("w").over(every) - F.coalesce(F.sum("w").over(by_cap), F.lit(0.0))))
    per = per.withColumn("level", level)
    return per.select("grp", "source", "source_size",
                      F.least("cap", F.col("w") * F.max("level").over(every)).alias("target"))


def pivot_chain(size: list, p: list, u: list) -> tuple[list, int, float]:
    """Sequential pivotal rounding of one source within one chunk.

    Returns 0/1 per document (None for the one left), the index of the one
    left (-1 if none) and its probability.
    """
    take: list = [None] * len(p)
    left, lp, ls = -1, 0.0, 0.0
    for i, (si, pi) in enumerate(zip(size, p)):
        if pi <= _EPS or pi >= 1 - _EPS:
            take[i] = int(pi > 0.5)
            continue
        if left < 0:
            left, lp, ls = i, pi, si
            continue
        up_l, up_i = (1 - lp) * ls, pi * si        # words that can move from i to the one left
        down_l, down_i = lp * ls, (1 - pi) * si    # and back
        up, down = min(up_l, up_i), min(down_l, down_i)
        if u[i] * (up + down) < down:
            l_done, i_done = up_l <= up_i, up_i <= up_l
            lp, pi = lp + up / ls, pi - up / si
        else:
            l_done, i_done = down_l <= down_i, down_i <= down_l
            lp, pi = lp - down / ls, pi + down / si
        if i_done or pi <= _EPS or pi >= 1 - _EPS:
            take[i] = int(pi > 0.5)
            if l_done or lp <= _EPS or lp >= 1 - _EPS:
                take[left], left = int(lp > 0.5), -1
        else:
            take[left] = int(lp > 0.5)
            left, lp, ls = i, pi, si
    return take, left, lp


def _meet(level: int, seed: int, last: bool):
    """Round one chunk: an Arrow table in, the same rows with ``p``/``take`` out."""
    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by([("grp", "ascending"), ("size", "descending"), ("row_key", "ascending")])
        grp = table.column("grp").to_numpy()
        size = table.column("size").to_numpy().astype(np.float64).tolist()
        p = table.column("p").to_numpy().tolist()
        salt = np.full(1, (seed * 1_000_003 + level + 1) % (1 << 63), dtype=np.uint64)
        bits = mix64(table.column("row_key").to_numpy().view(np.uint64) ^ mix64(salt))
        u = ((bits >> np.uint64(11)).astype(np.float64) * 2.0 ** -53).tolist()
        take: list = []
        edges = [0, *(np.flatnonzero(np.diff(grp)) + 1).tolist(), len(grp)]
        for a, b in zip(edges, edges[1:]):
            got, left, lp = pivot_chain(size[a:b], p[a:b], u[a:b])
            if left >= 0:
                p[a + left] = lp
                if last:  # nobody is left to meet
                    got[left] = int(mix64(bits[a + left:a + left + 1])[0] / 2.0 ** 64 < lp)
            take.extend(got)
        table = table.set_column(table.schema.get_field_index("p"), "p", pa.array(p, pa.float64()))
        return table.set_column(table.schema.get_field_index("take"), "take", pa.array(take, pa.int32()))
    return run


def pivotal_round(rows: DataFrame, n_rows: int, seed: int, chunk_rows: int = 20_000, least_chunks: int = 64,
                  fan_in: int = 16) -> DataFrame:
    """Round column ``p`` of (grp, row_key, size, p, ...) within each ``grp``;
    adds ``take`` (0 or 1).  ``n_rows`` only sets the number of chunks."""
    chunks = max(least_chunks, -(-n_rows // chunk_rows))
    cur = rows.withColumn("chunk", F.pmod(F.xxhash64("row_key", F.lit(seed)), F.lit(chunks)))
    cur = cur.withColumn("take", F.lit(None).cast("int"))
    schema, done, level = cur.schema, [], 0
    while True:
        last = chunks == 1
        cur = stored(cur.groupBy("chunk").applyInArrow(_meet(level, seed, last), schema), f"mixing-level{level}")
        done.append(cur.where("take is not null"))
        if last:
            break
        chunks = -(-chunks // fan_in)
        cur = cur.where("take is null").withColumn("chunk", F.floor(F.col("chunk") / fan_in))
        level += 1
    out = done[0]
    for d in done[1:]:
        out = out.unionByName(d)
    return out.drop("chunk")


def mixture(docs: DataFrame, weights: tuple = WEIGHTS, max_repeat: int = MAX_REPEAT, seed: int = 7,
            fine_share: float = 0.25, id_col: str = "doc_id", text_col: str = "text",
            source_col: str = "source") -> DataFrame:
    """One row per document: (id, row_key, size, source_size, target, copies, taken)."""
    slim = stored(docs.select(
        F.col(id_col).alias("id"), F.xxhash64(id_col, text_col, source_col).alias("row_key"),
        F.col(source_col).cast("string").alias("source"), word_count(F.col(text_col)).alias("size")), "mixing-sizes")
    n_rows = slim.count()
    targets = stored(source_targets(slim, weights, max_repeat), "mixing-targets")

    # Per source, the size classes (powers of two) that count as short.
    kind = F.floor(F.log2(F.col("size").cast("double"))).cast("int")
    known = (slim.join(targets, slim["source"].eqNullSafe(targets["source"]))
             .select("id", "row_key", "size", "grp", "source_size", "target", kind.alias("kind")))
    classes = known.where("size > 0").groupBy("grp", "kind").agg(F.sum("size").alias("words"))
    ascending = W.partitionBy("grp").orderBy("kind")
    cum = classes.withColumn("cum", F.sum("words").over(ascending)).withColumn(
        "all_words", F.sum("words").over(W.partitionBy("grp")))
    limit = (cum.where(F.col("cum") >= F.lit(fine_share) * F.col("all_words"))
             .groupBy("grp").agg(F.min("kind").alias("fine_kind"), F.min("cum").alias("fine_size")))
    limit = stored(limit, "mixing-classes")
    known = stored(known.join(limit, "grp", "left"), "mixing-rows")

    def rounded(part: DataFrame, ratio: Column, at: int) -> DataFrame:
        base = F.floor(ratio).cast("int")
        part = part.withColumn("base", base).withColumn("p", ratio - base)
        part = part.select("id", "row_key", "size", "grp", "source_size", "target", "base", "p")
        out = pivotal_round(part, n_rows, at)
        copies = F.col("base") + F.col("take")
        return out.select("id", "row_key", "grp", "size", "source_size", "target", copies.alias("copies"),
                          (copies * F.col("size")).alias("taken"))

    none = known.where("size = 0").select(
        "id", "row_key", "grp", "size", "source_size", "target", F.lit(0).alias("copies"),
        F.lit(0).cast("long").alias("taken"))
    long_ = rounded(known.where("size > 0 and kind > fine_kind"), F.col("target") / F.col("source_size"), seed)
    spent = long_.groupBy("grp").agg(F.sum("taken").alias("spent"))
    rest = stored(limit.join(targets.select("grp", F.col("target").alias("_t")), "grp").join(spent, "grp", "left")
                  .select("grp", ((F.col("_t") - F.coalesce("spent", F.lit(0))) / F.col("fine_size")).alias("ratio")),
                  "mixing-rest")
    short = known.where("size > 0 and kind <= fine_kind").join(rest, "grp")
    # an overdraft of the long documents can at most empty (or fill) the short ones
    short = rounded(short, F.greatest(F.lit(0.0), F.least(F.lit(float(max_repeat)), F.col("ratio"))), seed + 1)
    return long_.unionByName(short).unionByName(none)


def mix_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
                  **params) -> DataFrame:
    """``docs`` with every row repeated as often as the mixture takes it."""
    taken = mixture(docs, id_col=id_col, text_col=text_col, source_col=source_col, **params)
    key, copies, each = fresh(docs, "_row_key"), fresh(docs, "_copies"), fresh(docs, "_copy")
    often = (taken.where("copies > 0").groupBy(F.col("row_key").alias(key))
             .agg(F.sum("copies").cast("int").alias(copies)))
    keyed = docs.withColumn(key, F.xxhash64(id_col, text_col, source_col))
    once = keyed.join(often, key).dropDuplicates([key])  # repeated rows share one entry of ``often``
    return (once.withColumn(each, F.explode(F.sequence(F.lit(1), F.col(copies))))
            .select(*[F.col(f"`{c}`") for c in docs.columns]))


def op1_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = mixture(load(spark, sf_dir, "documents"))
    return out.select(F.col("id").alias("doc_id"), "size", "source_size", "target", "taken")


def stage_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: rows repeated (or left out) as the mixture takes them."""
    return mix_documents(docs)
