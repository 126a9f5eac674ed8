"""Links between distributed items: connected components and bucket linking."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tandem.llm.common import stored


def connected_components(edges: DataFrame, name: str = "components", rows_per_task: int = 50_000) -> DataFrame:
    """``edges`` (u long, v long) -> (node, component): every node that has an
    edge to another, and the smallest node of its component.

    Contraction: each node takes the first node of its neighbourhood, in order
    of degree (most first) and then at random, as representative; the edges are
    rewritten to representatives and made distinct, until none is left.  A star
    folds in one round, any graph (long chains too) shrinks by a constant
    factor on average, so rounds are logarithmic.  A round is partial
    aggregates and joins; only the number of edges reaches the driver, which
    sets how many tasks write (``rows_per_task``).
    Null ends and loops are ignored; an empty table gives an empty result.
    """
    def clean(e: DataFrame) -> DataFrame:
        return (e.where(F.col("u") != F.col("v"))
                .select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct())

    e = stored(clean(edges.select(F.col("u").cast("long"), F.col("v").cast("long"))), f"{name}-edges")
    maps: list[DataFrame] = []
    while n := e.count():
        r, tasks = len(maps), -(-n // rows_per_task)
        both = e.select("u", "v").unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        degree = both.groupBy("u").agg(F.count(F.lit(1)).alias("d"))

        def rank(node: str) -> Column:
            return F.struct((-F.col("d")).alias("d"), F.xxhash64(F.col(node), F.lit(r)).alias("k"),
                            F.col(node).alias("id"))

        near = (both.join(degree.withColumnRenamed("u", "v"), "v").groupBy("u").agg(F.min(rank("v")).alias("m")))
        rep = near.join(degree, "u").select(F.col("u").alias("node"),
                                            F.least(rank("u"), F.col("m")).getField("id").alias("rep"))
        rep = stored(rep.coalesce(tasks), f"{name}-rep{r}")
        maps.append(rep)
        a = rep.select(F.col("node").alias("u"), F.col("rep").alias("ru"))
        b = rep.select(F.col("node").alias("v"), F.col("rep").alias("rv"))
        moved = e.join(a, "u").join(b, "v").select(F.col("ru").alias("u"), F.col("rv").alias("v"))
        e = stored(clean(moved).coalesce(tasks), f"{name}-edges{r}")
    if not maps:
        return e.select(F.col("u").alias("node"), F.col("v").alias("component"))
    out = maps[0]
    for m in maps[1:]:
        nxt = m.select(F.col("node").alias("rep"), F.col("rep").alias("_next"))
        out = out.join(nxt, "rep", "left").select("node", F.coalesce("_next", "rep").alias("rep"))
    low = out.groupBy("rep").agg(F.min("node").alias("component"))
    return stored(out.join(low, "rep").select("node", "component"), f"{name}-out")


def link_buckets(items: DataFrame, bodies: Callable[[DataFrame], DataFrame],
                 verify: Callable[[DataFrame], DataFrame],
                 across: Callable[[DataFrame, DataFrame], DataFrame], name: str) -> DataFrame:
    """Components of the links between items that share a bucket and verify.

    ``items``: (bucket long, key long), distinct.  ``bodies`` gets the keys
    that share a bucket, (key), and returns what is needed to compare them,
    (key, body).  ``verify`` takes pairs (a, b, body_a, body_b) and returns
    the true ones as edges (u, v).  Returns (node, component).

    No link is lost and no bucket is expanded into all its pairs.  First every
    member of a bucket is compared with the bucket's head, its member in the
    most and largest buckets (for copies of one text, likely that text).  Then
    only members of *different* components that share a bucket are left, and
    one of the two always lies outside the bucket's largest component;
    ``across`` compares them: it gets (bucket, key, comp, major, n_minor, n_all)
    and the bodies, and returns edges.
    """
    full = stored(items.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), f"{name}-full")
    tied = stored(items.join(full, "bucket"), f"{name}-tied")
    weight = tied.groupBy("key").agg(F.sum("n").alias("weight"))
    # written before the join on the bucket, which can then split a large one
    heads = stored(tied.join(weight, "key").groupBy("bucket").agg(
        F.max(F.struct("weight", "key")).getField("key").alias("head")), f"{name}-heads")
    star = (tied.join(heads, "bucket").where("key <> head")
            .select(F.least("key", "head").alias("a"), F.greatest("key", "head").alias("b"),
                    F.col("head").alias("h")).groupBy("a", "b").agg(F.min("h").alias("h")))
    # the head comes second, so that its body is prepared once for a run of pairs
    star = stored(star.select(F.when(F.col("a") == F.col("h"), F.col("b")).otherwise(F.col("a")).alias("a"),
                              F.col("h").alias("b")), f"{name}-star")
    body = stored(bodies(tied.select("key").distinct()), f"{name}-bodies")
    edges = stored(verify(star.join(body.select(F.col("key").alias("a"), F.col("body").alias("body_a")), "a")
                          .join(body.select(F.col("key").alias("b"), F.col("body").alias("body_b")), "b")),
                   f"{name}-links")
    comp = connected_components(edges, f"{name}-cc")
    placed = (tied.where("n > 2").select("bucket", "key")
              .join(comp.withColumnRenamed("node", "key"), "key", "left")
              .select("bucket", "key", F.coalesce("component", "key").alias("comp")))
    sizes = placed.groupBy("bucket", "comp").agg(F.count(F.lit(1)).alias("n"))
    mixed = stored(sizes.groupBy("bucket")
                   .agg(F.max(F.struct("n", "comp")).alias("top"), F.count(F.lit(1)).alias("n_comp"),
                        F.sum("n").alias("n_all"))
                   .where("n_comp > 1")
                   .select("bucket", F.col("top.comp").alias("major"),
                           (F.col("n_all") - F.col("top.n")).alias("n_minor"), "n_all"), f"{name}-mixed")
    open_ = stored(placed.join(mixed, "bucket"), f"{name}-open")
    if open_.isEmpty():
        return comp
    more = stored(across(open_, body), f"{name}-links2")
    if more.isEmpty():
        return comp
    return connected_components(edges.unionByName(more), f"{name}-cc2")


def across_in_blocks(open_: DataFrame, body: DataFrame, compare: Callable, block: int = 256) -> DataFrame:
    """Pairs of different components in shared buckets, compared block by block.

    The members outside a bucket's largest component are cut into blocks of
    about ``block`` rows, all its members likewise, and each block of the one
    meets each block of the other in a task of its own: rows made grow with
    members / ``block``, and no task holds more than two blocks.  A pair that
    shares several buckets is compared in the smallest of them only.
    ``compare(left bodies, right bodies, wanted)`` returns the index pairs of
    true links among those that the boolean matrix ``wanted`` asks for.
    """
    shared = open_.groupBy("key").agg(F.sort_array(F.collect_list("bucket")).alias("buckets"))
    rich = stored(open_.join(shared, "key"), "across-open")
    n_left = F.ceil(F.col("n_minor") / block).cast("long")
    n_right = F.ceil(F.col("n_all") / block).cast("long")
    cols = ["bucket", "key", "comp", "major", "buckets"]
    left = rich.where("comp <> major").select(
        *cols, F.pmod(F.xxhash64("key"), n_left).alias("lb"),
        F.explode(F.sequence(F.lit(0).cast("long"), n_right - 1)).alias("rb"), F.lit(True).alias("is_left"))
    right = rich.select(
        *cols, F.explode(F.sequence(F.lit(0).cast("long"), n_left - 1)).alias("lb"),
        F.pmod(F.xxhash64("key"), n_right).alias("rb"), F.lit(False).alias("is_left"))
    rows = left.unionByName(right).join(body, "key")

    def run(table: pa.Table) -> pa.Table:
        key = table.column("key").to_numpy()
        comp = table.column("comp").to_numpy()
        is_left = table.column("is_left").to_numpy(zero_copy_only=False)
        here, major = table.column("bucket")[0].as_py(), table.column("major")[0].as_py()
        lists = [np.array(x) for x in table.column("buckets").to_pylist()]
        at_l, at_r = np.flatnonzero(is_left), np.flatnonzero(~is_left)
        wanted = (comp[at_l][:, None] != comp[at_r][None, :]) & (
            (comp[at_r] == major)[None, :] | (key[at_l][:, None] < key[at_r][None, :]))
        # smaller buckets than this one that a left and a right member share
        names: dict[int, int] = {}
        low = [[names.setdefault(b, len(names)) for b in x[x < here].tolist()] for x in lists]
        if names:
            has = np.zeros((len(lists), len(names)), dtype=np.float32)
            for i, x in enumerate(low):
                has[i, x] = 1.0
            wanted &= (has[at_l] @ has[at_r].T) == 0
        text = [b"" if x is None else x for x in table.column("body").cast(pa.binary()).to_pylist()]
        pairs = compare([text[i] for i in at_l], [text[i] for i in at_r], wanted) if wanted.any() else []
        return pa.table({"u": pa.array([key[at_l[i]] for i, _ in pairs], pa.int64()),
                         "v": pa.array([key[at_r[j]] for _, j in pairs], pa.int64())})

    return rows.groupBy("bucket", "lb", "rb").applyInArrow(run, "u long, v long")
