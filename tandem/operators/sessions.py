"""Batch session join, built to survive a hot key.

A session is a maximal run of a key's readings (both sides together) with
no silence longer than the gap.  Partitioning the whole key into one window
partition would put a hot key (say a third of all rows) into one task, so
the work is split by time:

1. Each row gets a time bucket.  Sessions are numbered locally inside every
   (key, bucket) with ``lag`` + running sum: a hot key is spread over all
   its buckets.  Only keys with more than ``target_rows`` rows are cut, at
   quantiles of their own times, so a burst is cut as finely as it is dense.
   Any cut is exact - a session may run through many buckets.
2. Only a bucket's first and last local session can go on in its neighbour.
   At most two summary rows per non-empty (key, bucket) are chained in time
   order; that gives each of them the first and last time of its session
   (its size is keys x buckets, not rows).  A session inside a bucket has its
   bounds already.
3. (key, first time) names a session.  Both sides carry it, the GPS side
   also the end, and they are equi-joined on it.  That join is the last
   operator: AQE can split a skewed session, and ``salt`` spreads one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tandem.session import scratch_path

DEFAULT_TARGET_ROWS = 2_000_000


GRID = 1000  # quantile steps taken of a hot key's times


def hot_key_cuts(tagged: DataFrame, *, key: str = "_k", time_us: str = "_t",
                 target_rows: int = DEFAULT_TARGET_ROWS) -> DataFrame:
    """(key, _cuts): for every key with more than ``target_rows`` rows, the
    ascending times that cut it into pieces of about ``target_rows`` rows
    (approximate quantiles; at most ``GRID`` pieces, readings of one instant
    stay together).  Two partial aggregates, the second over hot keys only."""
    hot = (tagged.groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
           .where(F.col("_n") > target_rows).withColumnRenamed(key, "_hot"))
    of_hot = tagged.select(key, time_us).join(hot, F.col(key).eqNullSafe(F.col("_hot"))).drop("_hot")
    grid = [i / GRID for i in range(1, GRID)]
    cuts = of_hot.groupBy(key).agg(F.max("_n").alias("_n"),
                                   F.percentile_approx(time_us, grid, 10_000).alias("_q"))
    step = F.greatest(F.lit(1), F.floor(F.lit(GRID) * F.lit(target_rows) / F.col("_n"))).cast("int")
    return cuts.withColumn("_step", step).select(
        key, F.array_distinct(F.filter("_q", lambda x, i: (i + 1) % F.col("_step") == 0)).alias("_cuts"))


def local_sessions(tagged: DataFrame, gap_ms: int, *, key: str = "_k", time_us: str = "_t",
                   bucket_ms: int | None = None,
                   target_rows: int = DEFAULT_TARGET_ROWS) -> DataFrame:
    """Add ``_b`` (time bucket) and ``_ls`` (session number inside the
    (key, bucket), from 1) - one shuffle on (key, bucket).  Buckets are
    ``bucket_ms`` long, or cut by ``hot_key_cuts``."""
    gap_us = gap_ms * 1000
    t = F.col(time_us)
    if bucket_ms:
        rows = tagged.withColumn("_b", F.floor(t / F.lit(bucket_ms * 1000)))
    else:
        cuts = hot_key_cuts(tagged, key=key, time_us=time_us, target_rows=target_rows)
        cuts = cuts.withColumnRenamed(key, "_ck")
        below = F.size(F.filter("_cuts", lambda x: x <= t)).cast("bigint")
        rows = (tagged.join(cuts, F.col(key).eqNullSafe(F.col("_ck")), "left")
                .withColumn("_b", F.coalesce(F.when(F.col("_cuts").isNotNull(), below), F.lit(0).cast("bigint")))
                .drop("_ck", "_cuts"))
    local = Window.partitionBy(key, "_b").orderBy(time_us)
    prev = F.lag(t).over(local)
    rows = rows.withColumn("_start", F.when(prev.isNull() | (t - prev > gap_us), 1).otherwise(0))
    return rows.withColumn("_ls", F.sum("_start").over(
        local.rowsBetween(Window.unboundedPreceding, Window.currentRow))).drop("_start")


def bucket_offsets(rows: DataFrame, gap_ms: int, *, key: str = "_k",
                   time_us: str = "_t") -> DataFrame:
    """One row per non-empty (key, bucket): ``_goff``, the global number of
    the bucket's first local session (it continues the previous bucket's
    last session when the silence between them is <= gap)."""
    gap_us = gap_ms * 1000
    summary = rows.groupBy(key, "_b").agg(F.min(time_us).alias("_first"),
                                          F.max(time_us).alias("_last"),
                                          F.max("_ls").alias("_n"))
    by_key = Window.partitionBy(key).orderBy("_b")
    cont = F.when(F.col("_first") - F.lag("_last").over(by_key) <= gap_us, 1).otherwise(0)
    before = F.coalesce(F.sum("_n").over(
        by_key.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    merged = F.sum(cont).over(by_key.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return summary.select(key, "_b", (F.lit(1) + before - merged).alias("_goff"))


def assign_sessions(tagged: DataFrame, gap_ms: int, *, key: str = "_k", time_us: str = "_t",
                    bucket_ms: int | None = None,
                    target_rows: int = DEFAULT_TARGET_ROWS) -> DataFrame:
    """Add ``_sid`` (session number within the key, from 1) to every row."""
    rows = local_sessions(tagged, gap_ms, key=key, time_us=time_us, bucket_ms=bucket_ms,
                          target_rows=target_rows)
    return _with_sid(rows, bucket_offsets(rows, gap_ms, key=key, time_us=time_us), key)


def _with_sid(rows: DataFrame, offsets: DataFrame, key: str = "_k") -> DataFrame:
    out = rows.join(offsets, on=[key, "_b"], how="inner")
    keep = [c for c in rows.columns if c not in ("_b", "_ls")]
    return out.select(*keep, (F.col("_goff") + F.col("_ls") - 1).cast("bigint").alias("_sid"))


def local_bounds(rows: DataFrame, *, key: str = "_k", time_us: str = "_t") -> DataFrame:
    """Locally numbered rows plus ``_lo``, ``_hi``: first and last time of the
    local session, from the (key, bucket) partition at hand (no shuffle)."""
    local = Window.partitionBy(key, "_b", "_ls")
    return rows.withColumn("_lo", F.min(time_us).over(local)).withColumn("_hi", F.max(time_us).over(local))


def edge_sessions(rows: DataFrame, gap_ms: int, *, key: str = "_k") -> DataFrame:
    """(key, _b, _lo, _glo, _ghi) of the local sessions that go on beyond
    their bucket: their local first time and the whole session's bounds."""
    gap_us = gap_ms * 1000
    per = rows.groupBy(key, "_b").agg(F.min("_lo").alias("lo1"), F.min("_hi").alias("hi1"),
                                      F.max("_lo").alias("lo2"), F.max("_hi").alias("hi2"))
    first = F.struct(F.lit(0).alias("last"), F.col("lo1").alias("lo"), F.col("hi1").alias("hi"))
    last = F.struct(F.lit(1).alias("last"), F.col("lo2").alias("lo"), F.col("hi2").alias("hi"))
    ends = per.select(key, "_b", F.explode(F.when(F.col("lo1") == F.col("lo2"), F.array(first))
                                           .otherwise(F.array(first, last))).alias("e"))
    ends = ends.select(key, "_b", "e.last", "e.lo", "e.hi")
    by_key = Window.partitionBy(key).orderBy("_b", "last")
    goes_on = (F.col("last") == 0) & (F.col("lo") - F.lag("hi").over(by_key) <= gap_us)
    chain = F.sum(F.when(goes_on, 0).otherwise(1)).over(
        by_key.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    whole = Window.partitionBy(key, "chain")
    ends = (ends.withColumn("chain", chain).withColumn("_glo", F.min("lo").over(whole))
            .withColumn("_ghi", F.max("hi").over(whole)))
    return (ends.where((F.col("_glo") != F.col("lo")) | (F.col("_ghi") != F.col("hi")))
            .select(key, "_b", F.col("lo").alias("_lo"), "_glo", "_ghi"))


def batch_session_pairs(s: DataFrame, g: DataFrame, gap_ms: int,
                        bucket_ms: int | None = None, materialize: bool = True,
                        salt: int = 1, target_rows: int = DEFAULT_TARGET_ROWS,
                        salt_keys=None) -> DataFrame:
    """Pairs of sensor rows ``s`` and GPS rows ``g`` (both: _k, _et, carried
    columns) that share a session; adds window_start / window_end.

    With ``materialize`` the locally numbered rows with their local bounds are
    written once as a parquet table under ``spark.checkpoint.dir``: the
    consumers (each side of the join and the edge summary) then read only the
    columns they need instead of re-running the source scan, the decoding and
    the sort, and the lineage is cut there.
    """
    s_cols = [c for c in s.columns if c not in ("_k", "_et")]
    g_cols = [c for c in g.columns if c not in ("_k", "_et")]
    s_type = s.select(F.struct(*s_cols).alias("x")).schema["x"].dataType
    g_type = g.select(F.struct(*g_cols).alias("x")).schema["x"].dataType
    # One frame with a payload struct per side, so both sides are sessionized together.
    s_t = s.select("_k", F.unix_micros("_et").alias("_t"), F.struct(*s_cols).alias("_s"),
                   F.lit(None).cast(g_type).alias("_g"))
    g_t = g.select("_k", F.unix_micros("_et").alias("_t"), F.lit(None).cast(s_type).alias("_s"),
                   F.struct(*g_cols).alias("_g"))
    # a null key or time is in no window
    tagged = s_t.unionByName(g_t).where(F.col("_k").isNotNull() & F.col("_t").isNotNull())
    rows = local_bounds(local_sessions(tagged, gap_ms, bucket_ms=bucket_ms, target_rows=target_rows))
    rows = rows.drop("_ls", "_t")
    if materialize:
        spark = rows.sparkSession
        path = scratch_path(spark, "session-rows")
        rows.write.parquet(path)
        rows = spark.read.schema(rows.schema).parquet(path)
    edges = edge_sessions(rows, gap_ms)
    whole = rows.join(edges, ["_k", "_b", "_lo"], "left").select(
        "_k", F.coalesce("_glo", "_lo").alias("_start"), F.coalesce("_ghi", "_hi").alias("_end"), "_s", "_g")
    left = whole.where(F.col("_s").isNotNull()).select("_k", "_start", "_s.*")
    right = whole.where(F.col("_g").isNotNull()).select("_k", "_start", "_end", "_g.*")
    from tandem.operators.windows import salted_equi_join
    pairs = salted_equi_join(left, right, ["_k", "_start"], salt, salt_keys)
    return pairs.select(
        "_k", *s_cols, *g_cols, F.timestamp_micros("_start").alias("window_start"),
        F.timestamp_micros(F.col("_end") + F.lit(gap_ms * 1000)).alias("window_end"))
