"""Embedding near-dedup by an exact metric range join.

Two vectors of one label link if their cosine is at least ``threshold``, that
is, if their unit vectors are at most r = sqrt(2 - 2 * threshold) apart.

* Equal vectors of a label are one item from the start (a partial aggregate by
  a 128-bit hash), so a vector of any frequency costs one row a task.
* Pivots, at least three r apart, are chosen from a bounded sample; the sample
  sets where the cells lie, never what is found.  Every item is at home in the
  cell of its nearest pivot, and visits the cells of lower-numbered pivots that
  may hold an item within r.  Three bounds keep it out of cell q: the triangle
  inequality with the least and the greatest distance of q's items from q
  (d(x, q) - r above the greatest, or d(x, q) + r below the least), and the
  distance of x from the plane halfway between its own pivot and q, which the
  items of q lie behind.  So any pair within r meets in exactly one cell.
* Cells join independently, home items with all.  A cell of more than ``block``
  rows is cut into blocks by hash and each two blocks are a group of their own,
  so no task holds more than two blocks, however dense a cell.
* A group returns, for every item with a link, the number of vectors it links
  with and one edge towards the group's component: rows in proportion to its
  items, not to its pairs.  Connected components follow.

Cases: a vector that is null, empty, zero, or holds a null or non-finite
component, or whose label is null, links with nothing; so do vectors of
different lengths.  Equal rows are vectors of their own (each counts the
others); a null id never names a component that has another id, and a component
of null ids only has a null id and is kept.  An empty table gives an empty
result; other columns are ignored and may have any name.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tandem.llm.common import load, stored
from tandem.llm.graph import connected_components
from tandem.llm.vectors import matrices, whole_vector

THRESHOLD = 0.98
CANDIDATES = 2048      # vectors among which pivots are chosen
MAX_PIVOTS = 512
CELL_ROWS = 500        # wished for in a cell of the largest label
BLOCK = 1024
_SLACK = 1e-6          # for rounding, on distances


def unit(m: np.ndarray) -> np.ndarray:
    """Rows scaled to length 1 (first by the largest component, so that squares stay in range)."""
    m = m / np.abs(m).max(axis=1, keepdims=True)
    return m / np.sqrt((m * m).sum(axis=1, keepdims=True))


def fit(m: np.ndarray, d: int) -> np.ndarray:
    """Rows cut to ``d`` components or filled with zeros: never farther apart than before."""
    if m.shape[1] >= d:
        return m[:, :d]
    return np.hstack([m, np.zeros((len(m), d - m.shape[1]))])


def choose_pivots(candidates: list[np.ndarray], wanted: int, apart: float) -> np.ndarray:
    """Up to ``wanted`` of the candidates (in their order) that are ``apart`` of
    each other, in the length most of them have."""
    if not candidates:
        return np.zeros((0, 1))
    sizes = [len(c) for c in candidates]
    d = max(set(sizes), key=lambda s: (sizes.count(s), s))
    pool = unit(np.array([c for c in candidates if len(c) == d], dtype=np.float64))
    chosen, free = [], np.ones(len(pool), dtype=bool)
    for i in range(len(pool)):
        if free[i]:
            chosen.append(i)
            if len(chosen) == wanted:
                break
            free &= ((pool - pool[i]) ** 2).sum(axis=1) > apart * apart
    return pool[chosen]


def distances(m: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    sq = (m * m).sum(axis=1)[:, None] + (pivots * pivots).sum(axis=1)[None, :] - 2.0 * (m @ pivots.T)
    return np.sqrt(np.maximum(sq, 0.0))


def homes(pivots: np.ndarray):
    """Task function: (pivot, dist) of every item's own cell."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, _, m in matrices(batch.column("vec")):
                dist = distances(fit(unit(m), pivots.shape[1]), pivots)
                own = dist.argmin(axis=1)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(own, pa.int32()), pa.array(dist[np.arange(len(m)), own], pa.float64())],
                    names=["pivot", "dist"])
    return run


def visits(dist: np.ndarray, gaps: np.ndarray, low: np.ndarray, high: np.ndarray,
           r: float) -> tuple[np.ndarray, np.ndarray]:
    """Own cell of each row, and the matrix of the other cells it has to visit.
    ``gaps``: distances of the pivots; ``low``, ``high``: least and greatest
    distance of the items at home in each cell from its pivot (nan: no item)."""
    own = dist.argmin(axis=1)
    at = dist[np.arange(len(dist)), own][:, None]
    reach = r + _SLACK
    with np.errstate(invalid="ignore", divide="ignore"):
        go = (dist - reach <= high) & (dist + reach >= low)
        plane = (dist * dist - at * at) / (2.0 * gaps[own])
        go &= ~(plane > reach)
    return own, go & (np.arange(dist.shape[1])[None, :] < own[:, None])


def spread(pivots: np.ndarray, low: np.ndarray, high: np.ndarray, r: float):
    """Task function: items -> (cell, home, dim, label, cid, n, vec), one row
    for the own cell and one for every visited one."""
    gaps = distances(pivots, pivots)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for d, rows, m in matrices(batch.column("vec")):
                own, go = visits(distances(fit(unit(m), pivots.shape[1]), pivots), gaps, low, high, r)
                go[np.arange(len(own)), own] = True
                # a copy of a row for every cell, at most about 64k at a time
                counts = np.cumsum(go.sum(axis=1))
                i = 0
                while i < len(own):
                    to = max(i + 1, int(np.searchsorted(counts, (counts[i - 1] if i else 0) + (1 << 16), side="right")))
                    x, cell = np.nonzero(go[i:to])
                    x += i
                    part = batch.take(pa.array(rows[x]))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(cell, pa.int32()), pa.array(cell == own[x]), pa.array(np.full(len(x), d), pa.int32()),
                         part.column("label"), part.column("cid"), part.column("n"), part.column("vec")],
                        names=["cell", "home", "dim", "label", "cid", "n", "vec"])
                    i = to
    return run


def group_roots(linked: np.ndarray) -> np.ndarray:
    """Of a symmetric boolean matrix: the first row of each row's component, -1 for a row without links."""
    root = np.full(len(linked), -1)
    for s in np.flatnonzero(linked.any(axis=1)):
        if root[s] >= 0:
            continue
        front = np.zeros(len(linked), dtype=bool)
        front[s] = True
        while front.any():
            root[front] = s
            front = linked[front].any(axis=0) & (root < 0)
    return root


def join_group(threshold: float):
    """Task function: the rows of one group -> (cid, links, root)."""
    def run(table: pa.Table) -> pa.Table:
        cid, n = table.column("cid").to_numpy(), table.column("n").to_numpy()
        home = table.column("home").to_numpy(zero_copy_only=False)
        own, i, j = (table.column(c).to_numpy() for c in ("own", "i", "j"))
        (_, _, m), = matrices(table.column("vec"), values=1 << 62)
        x = unit(m)
        linked = np.zeros((len(x), len(x)), dtype=bool)
        if i[0] == j[0]:
            linked[:] = x @ x.T >= threshold
            linked &= home[:, None] | home[None, :]
            np.fill_diagonal(linked, False)
        else:
            a, b = np.flatnonzero(own == i[0]), np.flatnonzero(own == j[0])
            near = (x[a] @ x[b].T >= threshold) & (home[a][:, None] | home[b][None, :])
            linked[np.ix_(a, b)] = near
            linked[np.ix_(b, a)] = near.T
        linked |= linked.T
        root = group_roots(linked)
        at = np.flatnonzero(root >= 0)
        links = np.array([n[row].sum() for row in linked[at]], dtype=np.int64)
        return pa.table({"cid": pa.array(cid[at], pa.int64()), "links": pa.array(links, pa.int64()),
                         "root": pa.array(cid[root[at]], pa.int64())})
    return run


def range_join(items: DataFrame, threshold: float = THRESHOLD, cell_rows: int = CELL_ROWS,
               max_pivots: int = MAX_PIVOTS, block: int = BLOCK) -> DataFrame:
    """``items`` (cid long, n long, label, vec), one row a distinct vector ->
    (cid, links, root) rows: ``links`` add up to the vectors (``n`` each) an
    item links with, (cid, root) are edges that span all its components."""
    session = items.sparkSession
    r = float(np.sqrt(2.0 - 2.0 * threshold))
    most = items.groupBy("label").agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0] or 0
    near = items.select("vec", F.xxhash64("cid").alias("k")).orderBy("k").limit(CANDIDATES)
    candidates = [np.array(x.vec, dtype=np.float64) for x in near.collect()]
    # pivots are at most 16 MB whatever the length of the vectors
    bound = (16 << 20) // (8 * max([len(c) for c in candidates], default=1))
    wanted = max(1, min(-(-most // cell_rows), max_pivots, bound))
    pivots = choose_pivots(candidates, wanted, 3.0 * r)
    if not len(pivots):
        return session.createDataFrame([], "cid long, links long, root long")
    low, high = np.full(len(pivots), np.nan), np.full(len(pivots), np.nan)
    for x in (items.select("vec").mapInArrow(homes(pivots), "pivot int, dist double").groupBy("pivot")
              .agg(F.min("dist").alias("low"), F.max("dist").alias("high")).collect()):
        low[x.pivot], high[x.pivot] = x.low, x.high
    kind = {f.name: f.dataType.simpleString() for f in items.schema.fields}
    rows = stored(items.select("cid", "n", "label", "vec").mapInArrow(
        spread(pivots, low, high, r),
        f"cell int, home boolean, dim int, label {kind['label']}, cid long, n long, vec {kind['vec']}"), "range-rows")
    cell = ["label", "dim", "cell"]
    sizes = rows.groupBy(*cell).agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    cut = F.ceil(F.col("size") / block).cast("int")
    dealt = (rows.join(sizes, cell).withColumn("own", F.pmod(F.xxhash64("cid"), cut).cast("int"))
             .withColumn("other", F.explode(F.sequence(F.lit(0), cut - 1)))
             .select(*cell, F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"),
                     "own", "home", "cid", "n", "vec"))
    return stored(dealt.groupBy(*cell, "i", "j").applyInArrow(join_group(threshold), "cid long, links long, root long"),
                  "range-links")


def near_duplicates(df: DataFrame, threshold: float = THRESHOLD, id_col: str = "vec_id", vec_col: str = "embedding",
                    label_col: str = "label", **params) -> DataFrame:
    """(id, n_links, component, kept), one row per row of ``df``."""
    vec = F.col(vec_col)
    good = F.col(label_col).isNotNull() & whole_vector(vec) & F.exists(vec, lambda c: c != 0)
    rows = df.select(F.col(id_col).alias("id"), F.col(label_col).alias("label"), vec.alias("vec"),
                     F.coalesce(good, F.lit(False)).alias("good"))
    keyed = (rows.where("good").withColumn("h1", F.xxhash64("vec")).withColumn("h2", F.xxhash64(F.lit(1), F.reverse("vec"))))
    key = ["label", "h1", "h2"]
    items = stored(keyed.groupBy(*key).agg(F.count(F.lit(1)).alias("n"), F.min("id").alias("first"),
                                           F.first("vec").alias("vec"))
                   .withColumn("cid", F.monotonically_increasing_id()), "range-items")
    found = range_join(items.select("cid", "n", "label", "vec"), threshold, **params)
    links = found.groupBy("cid").agg(F.sum("links").alias("links"))
    comp = connected_components(found.select(F.col("cid").alias("u"), F.col("root").alias("v")), "range-cc")
    placed = (items.drop("vec").join(links, "cid", "left").join(comp.withColumnRenamed("node", "cid"), "cid", "left")
              .withColumn("component", F.coalesce("component", "cid")))
    named = placed.groupBy("component").agg(F.min("first").alias("component_id"))
    known = stored(placed.join(named, "component").select(
        *key, (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"), "component_id"), "range-known")
    linked = keyed.select("id", *key).join(known, key).select("id", "n_links", "component_id")
    alone = rows.where("not good").select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    return linked.unionByName(alone).withColumn("kept", F.col("id").eqNullSafe(F.col("component_id")))


def op11_metric_range_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = near_duplicates(load(spark, sf_dir, "embeddings"))
    return out.select(F.col("id").cast("long").alias("vec_id"), "n_links",
                      F.col("component_id").cast("long").alias("component_id"), "kept")


# ids are distinct and not null here
OP11_SQL = f"""
WITH RECURSIVE v AS (
  SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings
), good AS (
  SELECT * FROM v WHERE label IS NOT NULL AND len(e) > 0
    AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(e, lambda x: x <> 0)) > 0
), links AS (
  SELECT a.vec_id AS u, b.vec_id AS v
  FROM good a JOIN good b ON a.label = b.label AND len(a.e) = len(b.e) AND a.vec_id <> b.vec_id
  WHERE list_cosine_similarity(a.e, b.e) >= {THRESHOLD}
), reach AS (
  SELECT vec_id AS u, vec_id AS v FROM embeddings
  UNION
  SELECT r.u, l.v FROM reach r JOIN links l ON l.u = r.v
), named AS (
  SELECT u AS vec_id, min(v) AS component_id FROM reach GROUP BY u
)
SELECT n.vec_id, (SELECT count(*) FROM links l WHERE l.u = n.vec_id) AS n_links, n.component_id,
       n.vec_id = n.component_id AS kept
FROM named n
"""
