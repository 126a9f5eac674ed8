"""Streaming session join over both sides' readings of a key.

A session of a key is [first reading, last reading + gap) over the sensor
and GPS readings together; a reading at exactly ``gap`` after the last one
still belongs to it.  When the watermark passes a session's end, every
sensor reading of the session is paired with every GPS reading of it.

Built on ``transformWithStateInPandas`` with row-level state, the stream
processor's window buffer:

* ``sensor`` / ``gps`` list state: the open readings, as Arrow chunks (one
  entry per side and input batch of a key, with its first and last time).
  New readings are appended (no rewrite of what is already held), and
  chunks are encoded and decoded whole, not row by row.
* ``sessions`` state: bounds and per-side counts of the open sessions, one
  Arrow batch (a handful per key).
* A group is a key, or with ``buckets`` many keys, and ``who`` tells them apart.
* One timer per group, at its earliest open session's end.  When it fires,
  every session behind the watermark closes: the side with fewer readings
  in them is held in memory, the other side is streamed from state, and
  output is made in chunks of about ``chunk_pairs`` pairs.  Readings of
  sessions still open are written back.

A reading whose own window [t, t + gap) lies behind the watermark is kept if
it falls into (or touches) a session that is still open, as its session has
not been emitted; otherwise it is late and dropped.  The batch path in
``tandem.operators.sessions`` is fully distributed and is the one to use
for backfills; in a stream, a key's open sessions live in one task, as in
any keyed stream processor.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import LongType, StringType, StructField, StructType

from tandem.session import ship_code

SESSION_COLS = ["who", "start", "end", "n_s", "n_g"]
CHUNK_STATE = "t_min long, t_max long, n long, data binary"
SESSION_ARROW = pa.schema([(c, pa.string() if c == "who" else pa.int64()) for c in SESSION_COLS])
# input tags: a sensor reading, a GPS reading, a sensor reading's time alone
# (sent to the other salt groups of its key)
SENSOR, GPS, MARK = 0, 1, 2
PROVIDER_KEY = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
CHANGELOG_KEY = "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled"


def use_rocksdb_state(spark) -> None:
    """List state needs the RocksDB state store.  Queries restarted from a
    checkpoint keep the provider recorded there, so setting it here only
    affects queries started from now on.  When the store is switched here,
    changelog checkpointing is turned on too (unless the session chose), so
    a commit writes the batch's changes rather than a full snapshot."""
    if spark.conf.get(PROVIDER_KEY, None) != ROCKSDB:
        spark.conf.set(PROVIDER_KEY, ROCKSDB)
        if spark.conf.get(CHANGELOG_KEY, None) is None:
            spark.conf.set(CHANGELOG_KEY, "true")


def merge_table(t: pd.DataFrame) -> pd.DataFrame:
    """(who, start, end, n_s, n_g) with the sessions of a ``who`` that overlap or
    touch merged, in order of (who, start)."""
    t = t.sort_values(["who", "start"], kind="stable", ignore_index=True)
    if len(t) < 2:
        return t
    who, start = t["who"].to_numpy(), t["start"].to_numpy(dtype=np.int64)
    end = t.groupby("who", sort=False)["end"].cummax().to_numpy(dtype=np.int64)
    new = np.concatenate(([True], (who[1:] != who[:-1]) | (start[1:] > end[:-1])))
    at = np.flatnonzero(new)
    return pd.DataFrame({"who": who[at], "start": start[at], "end": np.maximum.reduceat(end, at),
                         "n_s": np.add.reduceat(t["n_s"].to_numpy(dtype=np.int64), at),
                         "n_g": np.add.reduceat(t["n_g"].to_numpy(dtype=np.int64), at)})


def point_table(who: np.ndarray, t: np.ndarray, side: np.ndarray, gap: int) -> pd.DataFrame:
    """Sessions of these readings alone.  ``side`` is SENSOR, GPS or MARK; marks
    shape the bounds but are not counted."""
    return merge_table(pd.DataFrame({"who": who, "start": t, "end": t + gap, "n_s": (side == SENSOR).astype(np.int64),
                                     "n_g": (side == GPS).astype(np.int64)}))


def merge_sessions(bounds: list[tuple[int, int, int, int]]) -> list[list[int]]:
    """Merge (start, end, n_s, n_g) intervals of one key that overlap or touch."""
    t = pd.DataFrame(bounds, columns=SESSION_COLS[1:]).assign(who="")
    return merge_table(t[SESSION_COLS])[SESSION_COLS[1:]].to_numpy().tolist()


def point_sessions(t: np.ndarray, side: np.ndarray, gap: int) -> list[tuple[int, int, int, int]]:
    """Sessions of one key's readings alone: (start, end, n_s, n_g)."""
    table = point_table(np.full(len(t), "", dtype=object), np.asarray(t, dtype=np.int64), np.asarray(side), gap)
    return list(table[SESSION_COLS[1:]].itertuples(index=False, name=None))


def join_open(late: pd.DataFrame, open_: list, gap: int) -> pd.DataFrame:
    """The late readings that belong to an open session: their own window
    [t, t + gap) overlaps or touches it, directly or through other late
    readings of the batch.  Late readings lie before the end of every open
    session, so one pass from the latest to the earliest settles all."""
    order = np.argsort(-late["t_us"].to_numpy(dtype=np.int64), kind="stable")
    spans = merge_sessions(open_)
    keep = []
    for i in order:
        t = int(late["t_us"].iloc[i])
        hit = next((s for s in spans if s[0] <= t + gap and t <= s[1]), None)
        if hit is not None:
            hit[0] = min(hit[0], t)
            keep.append(i)
    return late.iloc[sorted(keep)]


class SessionPairs(StatefulProcessor):
    """Pairs of sensor x GPS readings per key and session (times in micros).

    Readings are kept in list state as Arrow chunks: one state entry per
    side and input batch of a key (at most ``maxRecordsPerBatch`` rows),
    with its first and last time, so appends and the close are vectorized.
    One event-time timer per key, at the end of its earliest open session;
    when it fires, every session of the key that the watermark has passed
    is closed in one pass over each side's chunks."""

    def __init__(self, s_schema: StructType, g_schema: StructType, gap_us: int,
                 chunk_pairs: int = 200_000):
        self.s_schema, self.g_schema = s_schema, g_schema
        self.s_names = [f.name for f in s_schema.fields]
        self.g_names = [f.name for f in g_schema.fields]
        self.gap = gap_us
        self.chunk_pairs = chunk_pairs

    def init(self, handle: StatefulProcessorHandle) -> None:
        head = [StructField("t_us", LongType()), StructField("who", StringType())]
        self.handle = handle
        self.s_arrow = to_arrow_schema(StructType(head + self.s_schema.fields))
        self.g_arrow = to_arrow_schema(StructType(head + self.g_schema.fields))
        self.sensor = handle.getListState("sensor", CHUNK_STATE)
        self.gps = handle.getListState("gps", CHUNK_STATE)
        # the open sessions and the timer that is set, at the first end of all
        self.sessions = handle.getValueState("sessions", "timer_ms long, data binary")

    def _open(self) -> tuple[int | None, pd.DataFrame]:
        timer, data = tuple(self.sessions.get() or (None, None))
        if data is None:
            return timer, pd.DataFrame({c: pd.Series(dtype=object if c == "who" else np.int64) for c in SESSION_COLS})
        return timer, pa.ipc.read_record_batch(pa.py_buffer(bytes(data)), SESSION_ARROW).to_pandas()

    def _put(self, old: int | None, table: pd.DataFrame) -> None:
        new = _timer_ms(int(table["end"].min())) if len(table) else None
        if old is not None and old != new:
            self.handle.deleteTimer(old)
        if new is not None and old != new:
            self.handle.registerTimer(new)
        if new is None:
            self.sessions.clear()
        else:
            batch = pa.RecordBatch.from_pandas(table[SESSION_COLS], schema=SESSION_ARROW, preserve_index=False)
            self.sessions.update((new, batch.serialize().to_pybytes()))

    # -- input ------------------------------------------------------------
    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        wm = timerValues.getCurrentWatermarkInMs() * 1000
        s_chunks, g_chunks = [], []
        timer, table = self._open()
        behind = []

        def take(pdf: pd.DataFrame) -> None:
            nonlocal table
            side = pdf["side"].to_numpy(dtype=np.int64)
            is_s, is_g = side == SENSOR, side == GPS
            if is_s.any():
                s_chunks.append(_chunk(pdf[is_s], self.s_arrow))
            if is_g.any():
                g_chunks.append(_chunk(pdf[is_g], self.g_arrow))
            fresh = point_table(pdf["who"].to_numpy(), pdf["t_us"].to_numpy(dtype=np.int64), side, self.gap)
            table = merge_table(pd.concat([table, fresh], ignore_index=True)) if len(table) else fresh

        for pdf in rows:
            in_time = pdf["t_us"].to_numpy() + self.gap > wm if wm > 0 else np.ones(len(pdf), dtype=bool)
            if in_time.any():
                take(pdf[in_time])
            if not in_time.all():
                behind.append(pdf[~in_time])
        if behind and len(table):
            late = pd.concat(behind, ignore_index=True)
            late = late[late["who"].isin(table["who"])]
            spans = {w: list(g[SESSION_COLS[1:]].itertuples(index=False, name=None))
                     for w, g in table[table["who"].isin(late["who"])].groupby("who")}
            kept = [join_open(g, spans[w], self.gap) for w, g in late.groupby("who")]
            if any(len(k) for k in kept):
                take(pd.concat(kept, ignore_index=True))
        if s_chunks:
            self.sensor.appendList(s_chunks)
        if g_chunks:
            self.gps.appendList(g_chunks)
        if s_chunks or g_chunks or len(table):
            self._put(timer, table)
        return iter([])

    # -- session close ------------------------------------------------------
    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        wm = timerValues.getCurrentWatermarkInMs() * 1000
        _, table = self._open()
        done = table["end"].to_numpy(dtype=np.int64) <= wm
        self._put(None, table[~done])  # the timer that fired is gone
        closing = table[done].reset_index(drop=True)  # in order of (who, start)
        if not len(closing):
            return
        small_is_gps = int(closing["n_g"].sum()) <= int(closing["n_s"].sum())
        small_state, big_state = (self.gps, self.sensor) if small_is_gps else (self.sensor, self.gps)
        small_arrow, big_arrow = ((self.g_arrow, self.s_arrow) if small_is_gps
                                  else (self.s_arrow, self.g_arrow))

        # the smaller side of the closing sessions is held, in order of sessions
        keep: list = []
        ends = ClosingSessions(closing)
        parts = list(_split_chunks(small_state, small_arrow, ends, keep))
        _write_back(small_state, keep)
        if parts:
            small = pd.concat(parts, ignore_index=True).drop(columns=["t_us", "who"]).sort_values("sess", kind="stable")
            per_sess = np.bincount(small["sess"].to_numpy(dtype=np.int64), minlength=len(closing))
        else:
            small, per_sess = None, np.zeros(len(closing), dtype=np.int64)
        first = np.concatenate(([0], np.cumsum(per_sess)))

        # the larger side is streamed from state chunk by chunk; pairs of all
        # closing sessions are made by one merge on the session index
        keep = []
        for inside in _split_chunks(big_state, big_arrow, ends, keep):
            weight = per_sess[inside["sess"].to_numpy(dtype=np.int64)]
            inside = inside[weight > 0].drop(columns=["t_us", "who"]).sort_values("sess", kind="stable")
            if inside.empty:
                continue
            sess = inside["sess"].to_numpy(dtype=np.int64)
            total = np.cumsum(per_sess[sess])
            cut = np.searchsorted(total, np.arange(self.chunk_pairs, total[-1], self.chunk_pairs))
            for lo, hi in zip(np.concatenate(([0], cut)), np.concatenate((cut, [len(inside)]))):
                if hi > lo:
                    # only the sessions that this piece touches
                    part = small.iloc[first[sess[lo]]:first[sess[hi - 1] + 1]]
                    yield self._pairs(inside.iloc[lo:hi], part, ends.start, ends.end, small_is_gps)
        _write_back(big_state, keep)

    def _pairs(self, big, small, starts, ends, small_is_gps) -> pd.DataFrame:
        out = big.merge(small, on="sess") if small_is_gps else small.merge(big, on="sess")
        sess = out["sess"].to_numpy(dtype=np.int64)
        out.insert(0, "window_end", ends[sess])
        out.insert(0, "window_start", starts[sess])
        return out[["window_start", "window_end", *self.s_names, *self.g_names]]

    def close(self) -> None:
        pass


def _chunk(pdf: pd.DataFrame, schema: pa.Schema) -> tuple:
    """One state entry: (first time, last time, rows, Arrow record batch
    message).  The schema is not stored; the processor knows it."""
    batch = pa.RecordBatch.from_pandas(pdf[schema.names], schema=schema, preserve_index=False)
    t = pdf["t_us"].to_numpy(dtype=np.int64)
    return int(t.min()), int(t.max()), len(pdf), batch.serialize().to_pybytes()


_NULLABLE_INTS = {pa.int8(): pd.Int8Dtype(), pa.int16(): pd.Int16Dtype(),
                  pa.int32(): pd.Int32Dtype(), pa.int64(): pd.Int64Dtype()}


def _unchunk(entry, schema: pa.Schema) -> pd.DataFrame:
    batch = pa.ipc.read_record_batch(pa.py_buffer(entry[3]), schema)
    return batch.to_pandas(types_mapper=_NULLABLE_INTS.get)


class ClosingSessions:
    """Sessions in order of (who, start), to be found by a reading's who and time."""

    def __init__(self, table: pd.DataFrame):
        self.start, self.end = table["start"].to_numpy(dtype=np.int64), table["end"].to_numpy(dtype=np.int64)
        self.names = pd.Index(table["who"].unique())
        self.code = self.names.get_indexer(table["who"])
        self.first, self.last = int(self.start.min()), int(self.end.max())

    def index(self, who: pd.Series, t: np.ndarray) -> np.ndarray:
        """Index of the session holding each reading, else -1."""
        code = self.names.get_indexer(who)
        n = len(self.start)
        # bounds and readings in one order; a start comes before a reading at its time
        order = np.lexsort((np.repeat([0, 1], [n, len(t)]), np.concatenate((self.start, t)), np.concatenate((self.code, code))))
        at = np.cumsum(order < n) - 1
        i = np.empty(len(t), dtype=np.int64)
        i[order[order >= n] - n] = at[order >= n]
        j = np.maximum(i, 0)
        return np.where((code >= 0) & (i >= 0) & (self.code[j] == code) & (t < self.end[j]), i, -1)


def _split_chunks(state, schema: pa.Schema, closing: ClosingSessions, keep: list) -> Iterator[pd.DataFrame]:
    """Yield the rows of each chunk that lie in a closing session, with
    their session index in ``sess``; rows outside them are appended to
    ``keep`` as chunks.  A chunk wholly outside is kept without decoding."""
    for entry in state.get():
        entry = tuple(entry)
        if entry[1] < closing.first or entry[0] >= closing.last:
            keep.append(entry)
            continue
        df = _unchunk(entry, schema)
        idx = closing.index(df["who"], df["t_us"].to_numpy(dtype=np.int64))
        if (idx < 0).any():
            keep.append(entry if (idx < 0).all() else _chunk(df[idx < 0], schema))
        if (idx >= 0).any():
            inside = df[idx >= 0].copy()
            inside.insert(0, "sess", idx[idx >= 0])
            yield inside


def _write_back(state, keep: list) -> None:
    if keep:
        state.put(keep)
    else:
        state.clear()


def _timer_ms(end_us: int) -> int:
    """The timer fires once the watermark is at or past the session end."""
    return -(-end_us // 1000)


def stream_session_pairs(s: DataFrame, g: DataFrame, gap_ms: int,
                         chunk_pairs: int = 200_000, salt: int = 1,
                         salt_keys=None, buckets: int | None = None) -> DataFrame:
    """``s`` and ``g`` carry ``_k``, ``_et`` (watermarked) and their own
    columns; the result has ``window_start``, ``window_end`` and both sides'
    columns, one row per pair.

    ``salt=N`` spreads each key over N groups (tasks): sensor readings are
    hashed into one group, GPS readings are copied to all N, and every
    sensor reading also sends a time-only marker to all N, so every group
    sees the key's full timeline and forms the same sessions.  Each group
    pairs only its own sensor readings: the union is the unsalted result.
    ``salt_keys`` limits this to the named (hot) join keys; the others keep
    one group and are not copied.

    Each call for a group costs several exchanges with the state store, whatever
    its rows.  With ``buckets`` keys share that many groups, dealt by a hash, so
    the calls follow the buckets instead of the keys.  Sessions stay those of a
    key; when some close, the group's other open readings are written back, so
    this is for replays and large micro-batches.  It has to stay the same for a
    checkpoint."""
    use_rocksdb_state(s.sparkSession)
    ship_code(s.sparkSession)
    # the state schema is read in a driver-side worker that gets no shipped files
    cloudpickle.register_pickle_by_value(sys.modules[__name__])
    s_cols = [c for c in s.columns if c not in ("_k", "_et")]
    g_cols = [c for c in g.columns if c not in ("_k", "_et")]
    s_schema = StructType([s.schema[c] for c in s_cols])
    g_schema = StructType([g.schema[c] for c in g_cols])
    s_null = [F.lit(None).cast(f.dataType).alias(f.name) for f in s_schema.fields]
    g_null = [F.lit(None).cast(f.dataType).alias(f.name) for f in g_schema.fields]
    hot = F.col("_k").isin(list(salt_keys)) if salt_keys else F.lit(True)
    groups = F.sequence(F.lit(0), F.lit(salt - 1))
    everywhere = (F.explode(F.when(hot, groups).otherwise(F.array(F.lit(0)))) if salt > 1
                  else F.lit(0))
    # plain names: the Arrow-to-pandas step renames columns starting with "_"
    head = [F.col("_k").alias("key"), F.unix_micros("_et").alias("t_us")]
    own = (F.when(hot, F.pmod(F.xxhash64(*s_cols, "_et"), F.lit(salt))).otherwise(F.lit(0))
           if salt > 1 else F.lit(0))
    s_t = s.select(*head, F.lit(SENSOR).alias("side"), own.cast("int").alias("salt"),
                   *s_cols, *g_null)
    g_t = g.select(*head, F.lit(GPS).alias("side"), everywhere.alias("salt"),
                   *s_null, *g_cols)
    tagged = s_t.unionByName(g_t)
    if salt > 1:
        marks = s.where(hot).select(*head, F.lit(MARK).alias("side"), everywhere.alias("salt"),
                         *s_null, *g_null)
        tagged = tagged.unionByName(marks)
    tagged = tagged.withColumn("who", F.concat_ws(":", F.col("salt"), F.col("key")))
    if buckets:  # key and salt group are in who
        tagged = (tagged.withColumn("key", F.pmod(F.xxhash64("who"), F.lit(buckets)).cast("string"))
                  .withColumn("salt", F.lit(0)))
    out_schema = StructType([StructField("window_start", LongType()),
                             StructField("window_end", LongType()),
                             *[f for f in s_schema.fields], *[f for f in g_schema.fields]])
    pairs = (tagged.groupBy("key", "salt")
             .transformWithStateInPandas(SessionPairs(s_schema, g_schema, gap_ms * 1000, chunk_pairs),
                                         out_schema, "Append", "EventTime"))
    return pairs.select(F.timestamp_micros("window_start").alias("window_start"),
                        F.timestamp_micros("window_end").alias("window_end"), *s_cols, *g_cols)
