"""Centroid clustering over space-filling-curve zone maps.

Vectors become integers floor(64 * x).  They are laid out once: ordered along
a Hilbert curve (2 bits of every dimension, those with the largest variance
first) by a range sort, and cut into blocks of up to ``block`` neighbours, each
with its least and greatest value a dimension (its box), its sum and its count.
Ties on the curve are parted by a hash, so copies of one vector spread over
tasks like any other rows.

Every pass sends the centroids (k rows, in the closure of the tasks) to the
blocks.  A box gives a lower and an upper bound of the distance of its vectors
from a centroid; a centroid whose lower bound is above the least upper bound is
no candidate, nor is one that is farther than the centroid in the box's middle
from every point of the box (the difference of the two squared distances is
linear, so its least value lies in a corner).  A block with one candidate adds its stored sum, without a look
at its vectors; else the vectors are compared with the candidates.  Distances
are whole numbers (exact in doubles below 2^53, else in 64-bit integers), sums
and floors of means are exact, so results do not depend on layout or order.
A pass returns k rows a task, which Spark adds up by (cluster, dimension).

Cases: vectors that are null, of another length, or that hold a null or
non-finite component are dropped; components beyond +-2^21 (integers beyond
+-2^27) count as that bound, which keeps distances in a long; equal ids count
by row, first by the hash, then by the vector; a null id hashes as an empty
one; with fewer rows than ``k`` every row is a centroid; an empty table gives
an empty result; an inertia above a long stays at the greatest long.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tandem.llm.common import load, stored
from tandem.llm.vectors import grid, matrices

DIM, K, ROUNDS = 64, 16, 3
BLOCK = 256
BITS = 2
_MOST = 1 << 27
_DOUBLE = 1 << 22      # up to here all terms of a distance are exact in doubles
_LONG = (1 << 63) - 1


def hilbert_keys(cells: np.ndarray, bits: int = BITS) -> list[bytes]:
    """Place on the Hilbert curve, as bytes that sort, of rows of cell numbers
    below 2^bits: axes are turned to the transposed index plane by plane
    (inversions and exchanges from the top bit down, then Gray decoding)."""
    x = cells.T.astype(np.uint32).copy()
    n, top = len(x), 1 << (bits - 1)
    q = top
    while q > 1:
        p = np.uint32(q - 1)
        for i in range(n):
            hit = (x[i] & np.uint32(q)) != 0
            swap = np.where(hit, np.uint32(0), (x[0] ^ x[i]) & p)
            x[0] ^= np.where(hit, p, swap)
            x[i] ^= swap
        q >>= 1
    for i in range(1, n):
        x[i] ^= x[i - 1]
    turn = np.zeros(x.shape[1], dtype=np.uint32)
    q = top
    while q > 1:
        turn ^= np.where((x[n - 1] & np.uint32(q)) != 0, np.uint32(q - 1), np.uint32(0))
        q >>= 1
    x ^= turn
    planes = [np.packbits(((x >> b) & 1).astype(np.uint8).T, axis=1) for b in range(bits - 1, -1, -1)]
    return [row.tobytes() for row in np.hstack(planes)]


def _kept(column, dim: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(row numbers, integers) of the vectors that count."""
    for d, rows, m in matrices(column):
        if d == dim:
            ok = np.isfinite(m).all(axis=1)
            if ok.any():
                yield rows[ok], grid(m[ok], _MOST)


def _spreads(dim: int):
    """Task function: (dim, n, s, s2) of what the task has read; used for the layout only."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, s, s2 = 0, np.zeros(dim), np.zeros(dim)
        for batch in batches:
            for _, x in _kept(batch.column("vec"), dim):
                n, s, s2 = n + len(x), s + x.sum(axis=0), s2 + (x.astype(np.float64) ** 2).sum(axis=0)
        if n:
            yield pa.RecordBatch.from_arrays([pa.array(range(dim), pa.int32()), pa.array([n] * dim, pa.int64()),
                                              pa.array(s), pa.array(s2)], names=["d", "n", "s", "s2"])
    return run


def _keyed(dim: int, mean: np.ndarray, width: np.ndarray):
    """Task function: rows -> (id, key, x): place on the curve, integers as bytes."""
    order = np.argsort(-width, kind="stable")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, x in _kept(batch.column("vec"), dim):
                z = (x - mean) / width
                cells = (z > -0.67).astype(np.uint32) + (z > 0) + (z > 0.67)  # quarters of a bell curve
                yield pa.RecordBatch.from_arrays(
                    [batch.column("id").take(pa.array(rows)), pa.array(hilbert_keys(cells[:, order]), pa.binary()),
                     pa.array([r.tobytes() for r in x.astype(np.int32)], pa.binary())], names=["id", "key", "x"])
    return run


def _zones(block: int, dim: int):
    """Task function: ordered rows -> one row a block: ids, packed integers, box, sum."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def zone(rows: pa.RecordBatch | pa.Table) -> pa.RecordBatch:
            packed = b"".join(rows.column("x").to_pylist())
            x = np.frombuffer(packed, dtype=np.int32).reshape(-1, dim)
            ids = rows.column("id")
            ids = ids.combine_chunks() if isinstance(ids, pa.ChunkedArray) else ids
            one = lambda v, t: pa.array([v], pa.list_(t))
            return pa.RecordBatch.from_arrays(
                [pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids), pa.array([packed], pa.binary()),
                 one(x.min(axis=0), pa.int32()), one(x.max(axis=0), pa.int32()),
                 one(x.sum(axis=0, dtype=np.int64), pa.int64())], names=["ids", "x", "low", "high", "total"])

        rest = None
        for batch in batches:
            rest = pa.Table.from_batches([batch]) if rest is None else pa.concat_tables([rest, pa.Table.from_batches([batch])])
            while rest.num_rows >= block:
                yield zone(rest.slice(0, block))
                rest = rest.slice(block)
        if rest is not None and rest.num_rows:
            yield zone(rest)
    return run


def zone_table(df: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", dim: int = DIM,
               block: int = BLOCK) -> DataFrame:
    """Blocks of neighbours on the curve: (ids, x, low, high, total), written once."""
    rows = df.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).alias("vec"))
    mean, width = np.zeros(dim), np.ones(dim)
    for r in (rows.select("vec").mapInArrow(_spreads(dim), "d int, n long, s double, s2 double").groupBy("d")
              .agg(F.sum("n").alias("n"), F.sum("s").alias("s"), F.sum("s2").alias("s2")).collect()):
        mean[r.d] = r.s / r.n
        width[r.d] = max(r.s2 / r.n - mean[r.d] ** 2, 1e-9) ** 0.5
    keyed = rows.mapInArrow(_keyed(dim, mean, width), "id long, key binary, x binary")
    along = ["key", "tie"]
    ordered = keyed.withColumn("tie", F.xxhash64("id", "x")).repartitionByRange(*along).sortWithinPartitions(*along)
    return stored(ordered.select("id", "x").mapInArrow(
        _zones(block, dim), "ids array<long>, x binary, low array<int>, high array<int>, total array<long>"), "zones")


def candidates(low: np.ndarray, high: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Centroids that may be nearest (or tie) to some vector in the box, ascending."""
    below, above = centroids - low, high - centroids
    least = (np.maximum(0, np.maximum(-below, -above)) ** 2).sum(axis=1)
    most = (np.maximum(np.abs(below), np.abs(above)) ** 2).sum(axis=1)
    near = np.flatnonzero(least <= most.min())
    if len(near) == 1:
        return near
    # |x - c|^2 - |x - m|^2 is linear in x: its least value over the box is exact
    c = centroids[near]
    m = c[((2 * c - low - high).astype(np.float64) ** 2).sum(axis=1).argmin()]
    turn = 2 * (m - c)
    least = np.where(turn >= 0, turn * low, turn * high).sum(axis=1) + (c * c).sum(axis=1) - (m * m).sum()
    return near[least <= 0]


def nearest(x: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number of the nearest centroid (ties: the first) and the squared distance, exact."""
    if max(np.abs(x).max(), np.abs(centroids).max()) <= _DOUBLE and x.shape[1] <= 128:
        a, c = x.astype(np.float64), centroids.astype(np.float64)
        dist = (a * a).sum(axis=1)[:, None] - 2.0 * (a @ c.T) + (c * c).sum(axis=1)[None, :]
        dist = dist.astype(np.int64)
    else:
        dist = np.stack([((x - c) ** 2).sum(axis=1) for c in centroids], axis=1)
    best = dist.argmin(axis=1)
    return best, dist[np.arange(len(x)), best]


def _box(batch: pa.RecordBatch, i: int, name: str) -> np.ndarray:
    return batch.column(name)[i].values.to_numpy(zero_copy_only=False).astype(np.int64)


def _unpack(batch: pa.RecordBatch, i: int, dim: int) -> np.ndarray:
    return np.frombuffer(batch.column("x")[i].as_py(), dtype=np.int32).reshape(-1, dim).astype(np.int64)


def _sums(centroids: np.ndarray):
    """Task function: blocks -> (cluster, d, n, s) of the task, and how many
    distances it took (cluster -1)."""
    k, dim = centroids.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, s, seen, took = np.zeros(k, dtype=np.int64), np.zeros((k, dim), dtype=np.int64), 0, 0
        for batch in batches:
            for i in range(batch.num_rows):
                near = candidates(_box(batch, i, "low"), _box(batch, i, "high"), centroids)
                size = len(batch.column("ids")[i])
                seen += size
                if len(near) == 1:
                    n[near[0]] += size
                    s[near[0]] += _box(batch, i, "total")
                    continue
                took += size * len(near)
                x = _unpack(batch, i, dim)
                best = near[nearest(x, centroids[near])[0]]
                n += np.bincount(best, minlength=k)
                for c in np.unique(best):
                    s[c] += x[best == c].sum(axis=0)
        if seen:
            cluster = np.append(np.repeat(np.arange(k), dim), -1)
            yield pa.RecordBatch.from_arrays(
                [pa.array(cluster, pa.int32()), pa.array(np.append(np.tile(np.arange(dim), k), 0), pa.int32()),
                 pa.array(np.append(np.repeat(n, dim), seen), pa.int64()), pa.array(np.append(s.ravel(), took), pa.int64())],
                names=["cluster", "d", "n", "s"])
    return run


def _assign(centroids: np.ndarray):
    """Task function: blocks -> (id, cluster, distance)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                near = candidates(_box(batch, i, "low"), _box(batch, i, "high"), centroids)
                best, dist = nearest(_unpack(batch, i, centroids.shape[1]), centroids[near])
                yield pa.RecordBatch.from_arrays(
                    [batch.column("ids")[i].values, pa.array(near[best], pa.int32()), pa.array(dist, pa.int64())],
                    names=["id", "cluster", "distance"])
    return run


def first_centroids(zones: DataFrame, k: int, dim: int, seed: str) -> np.ndarray:
    """The ``k`` vectors with the smallest sha256 of ``seed<id>``; ties by the vector."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: list[tuple[str, list[int]]] = []
        for batch in batches:
            for i in range(batch.num_rows):
                ids, x = batch.column("ids")[i].as_py(), None
                for j, v in enumerate(ids):
                    h = hashlib.sha256(f"{seed}{'' if v is None else v}".encode()).hexdigest()
                    if len(best) < k or h <= best[-1][0]:
                        x = _unpack(batch, i, dim) if x is None else x
                        best = sorted([*best, (h, x[j].tolist())])[:k]
        yield pa.RecordBatch.from_arrays([pa.array([b[0] for b in best], pa.string()),
                                          pa.array([b[1] for b in best], pa.list_(pa.int64()))], names=["h", "v"])
    top = zones.select("ids", "x").mapInArrow(run, "h string, v array<long>").orderBy("h", "v").limit(k).collect()
    return np.array([r.v for r in top], dtype=np.int64).reshape(-1, dim)


def cluster(df: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", k: int = K, rounds: int = ROUNDS,
            dim: int = DIM, block: int = BLOCK, seed: str = "1:") -> tuple[DataFrame, np.ndarray, list[float]]:
    """(id, cluster, distance) of every vector that counts, the final centroids,
    and for each round the share of distances the boxes left to compute."""
    zones = zone_table(df, id_col, vec_col, dim, block)
    centroids = first_centroids(zones, k, dim, seed)
    if not len(centroids):
        return df.sparkSession.createDataFrame([], "id long, cluster int, distance long"), centroids, []
    shares = []
    for _ in range(rounds):
        sums = (zones.mapInArrow(_sums(centroids), "cluster int, d int, n long, s long").groupBy("cluster", "d")
                .agg(F.sum("n").alias("n"), F.sum("s").alias("s")).collect())  # k * dim rows and one
        moved = centroids.copy()
        for r in sums:
            if r.cluster < 0:
                shares.append(r.s / (r.n * len(centroids)))
            elif r.n:
                moved[r.cluster, r.d] = r.s // r.n
        centroids = moved
    return (stored(zones.select("ids", "x", "low", "high").mapInArrow(_assign(centroids), "id long, cluster int, distance long"),
                   "zones-assigned"), centroids, shares)


def op12_hilbert_zone_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    out, centroids, _ = cluster(load(spark, sf_dir, "embeddings"))
    k = len(centroids)
    names = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids.tolist()]
    inertia = [0] * k
    for r in out.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("s")).collect():  # k rows
        inertia[r.cluster] = int(r.s)
    place = F.col("cluster") + 1

    def of(values: list) -> Column:
        return F.element_at(F.array(*[F.lit(v) for v in values]), place)

    if not k:
        names, inertia = [""], [0]
    return out.select(F.col("id").alias("vec_id"), "cluster", "distance",
                      of([min(v, _LONG) for v in inertia]).cast("long").alias("cluster_inertia"),
                      F.lit(min(sum(inertia), _LONG)).cast("long").alias("inertia"), of(names).alias("centroid_sha256"))


def _op12_sql(dim: int = DIM, k: int = K, rounds: int = ROUNDS) -> str:
    parts = [f"""kept AS (
  SELECT row_number() OVER () AS r, vec_id, embedding AS e FROM embeddings
  WHERE len(embedding) = {dim} AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
)""", f"""x AS (
  SELECT r, d, greatest(least(floor(64 * e[d]::DOUBLE), {_MOST}), -{_MOST})::BIGINT AS x
  FROM kept, range(1, {dim + 1}) t(d)
)""", f"""c0 AS (
  SELECT k, d, x AS c FROM (
    SELECT r, row_number() OVER (ORDER BY sha256('1:' || coalesce(vec_id::VARCHAR, '')), e) - 1 AS k FROM kept
    QUALIFY k < {k}) JOIN x USING (r)
)"""]
    for i in range(rounds + 1):
        parts.append(f"""a{i} AS (
  SELECT r, k, dist FROM (SELECT r, k, sum((x - c) * (x - c)) AS dist FROM x JOIN c{i} USING (d) GROUP BY r, k)
  QUALIFY row_number() OVER (PARTITION BY r ORDER BY dist, k) = 1
)""")
        if i < rounds:
            parts.append(f"""c{i + 1} AS (
  SELECT k, d, coalesce(m, c) AS c FROM c{i} LEFT JOIN (
    SELECT k, d, ((s - ((s % n) + n) % n) // n)::BIGINT AS m
    FROM (SELECT k, d, sum(x) AS s, count(*) AS n FROM a{i} JOIN x USING (r) GROUP BY k, d)) USING (k, d)
)""")
    return "WITH " + ", ".join(parts) + f"""
SELECT vec_id, k::INTEGER AS cluster, dist::BIGINT AS distance, sum(dist) OVER (PARTITION BY k)::BIGINT AS cluster_inertia,
       sum(dist) OVER ()::BIGINT AS inertia, h AS centroid_sha256
FROM a{rounds} JOIN kept USING (r)
JOIN (SELECT k, sha256(string_agg(c::VARCHAR, ',' ORDER BY d)) AS h FROM c{rounds} GROUP BY k) USING (k)
"""


OP12_SQL = _op12_sql()
