"""All sensors of a job joined with GPS in one streaming query.

The feed is read and decoded once (``all_readings``), GPS positions get their
region once, and one keyed processor per user holds one buffer of GPS readings
for every sensor kind.  The fixed-window joins of ``tandem.operators.windows``
run as one query a sensor instead, each of which reads the feed twice and keeps
GPS state of its own.

* ``gps`` and ``sensors`` list state: open readings as Arrow chunks, appended as
  they come and each kept once, whatever the number of windows it lies in.
* One event-time timer a key, at the next window end.  When it fires, the
  windows that ended since the last time are joined, window by window of each
  kind, and readings whose last window has ended go.
* Tagged output: ``weather`` and ``multi`` pairs, ``gps`` readings (with region,
  as they come) and ``late`` readings, whose last window had ended when they came.

There is one watermark, of all readings together: a silent sensor holds nothing
back, and ``delay`` has to cover how far one kind of reading lags another.

Hot users: with ``hot_rows`` a first keyed operator (``DealHot``) deals a user's
sensor readings to more and more groups as they exceed that many a window; it
buffers nothing, and no key is named by anyone.  The groups' GPS copies, the
pairs and the window state are then spread over tasks.

Many users: each call for a group costs some ten exchanges between the Python
worker and the state store, whatever its rows.  With ``buckets`` users share that
many groups, dealt by a hash, and the calls follow the buckets instead of the
users; pairs still meet within a user only.
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import StructType

from tandem.functions.coerce import java_trim
from tandem.functions.labels import join_type_label
from tandem.operators.messages import gps_region_value, multi_value, weather_value
from tandem.operators.parse import all_readings, parse_feed
from tandem.operators.polygons import position_region
from tandem.operators.windows import to_ms
from tandem.plans.pipeline import GPS_WITH_REGION, JobConfig
from tandem.session import checkpoint_root, ship_code
from tandem.sources.feed import read_kafka
from tandem.streaming.sessions import CHUNK_STATE, _chunk, _timer_ms, _unchunk, _write_back, use_rocksdb_state

GPS_KIND, WEATHER_KIND, MULTI_KIND = 0, 1, 2
KINDS = {"gps": GPS_KIND, "weather": WEATHER_KIND, "multi": MULTI_KIND}
TAGS = ("gps", "weather", "multi", "late")
GPS_TAG, LATE_TAG = 0, 3
BUCKETS = 128
NEVER = -(1 << 62)

SENSOR_FIELDS = ("userId string, userEmail string, deviceId string, sensorType string, temp int, humd int, CO2 int, "
                 "CO int, hour int, name1 string, value1 float, name2 string, value2 float, name3 string, "
                 "value3 float, obs_us long, ingest_us long")
GPS_FIELDS = ("userId string, userEmail string, deviceId string, sensorType string, lat float, lng float, "
              "region string, obs_us long")
SENSOR_COLS = [f.split()[0] for f in SENSOR_FIELDS.split(", ")]
GPS_COLS = [f.split()[0] for f in GPS_FIELDS.split(", ")]
PAIR_SCHEMA = ("tag int, window_start long, window_end long, "
               + ", ".join("s_" + f for f in SENSOR_FIELDS.split(", ")) + ", "
               + ", ".join("g_" + f for f in GPS_FIELDS.split(", ")))
PAIR_COLS = [f.split()[0] for f in PAIR_SCHEMA.split(", ")]
READING_COLS = list(dict.fromkeys(SENSOR_COLS + GPS_COLS))
LATE = TAGS[LATE_TAG]


class Windows:
    """Window ends of the kinds, in micros: kind -> (size, slide)."""

    def __init__(self, sizes: dict[int, tuple[int, int]]):
        self.sizes = sizes

    def next_end(self, kind: int, t: int) -> int:
        """First window end after ``t``."""
        size, slide = self.sizes[kind]
        return ((t - size) // slide + 1) * slide + size

    def last_end(self, kind: int, t: np.ndarray) -> np.ndarray:
        """End of the last window that holds each time; a GPS reading's is the latest of all kinds."""
        if kind == GPS_KIND:
            return np.max([self.last_end(k, t) for k in self.sizes], axis=0)
        size, slide = self.sizes[kind]
        return t // slide * slide + size

    def first_timer(self, kind: int, t: int, edge: int | None) -> int:
        """Next end that may concern a reading at ``t`` once all ends up to ``edge`` are done."""
        t = t if edge is None else max(t, edge)
        return min(self.next_end(k, t) for k in ([kind] if kind != GPS_KIND else self.sizes))

    def ended(self, kind: int, t: np.ndarray, since: int | None, now: int) -> tuple[np.ndarray, np.ndarray]:
        """(row, window number) of every window that holds a row and ended after ``since``, up to ``now``."""
        size, slide = self.sizes[kind]
        low = (t - size) // slide + 1
        if since is not None:
            low = np.maximum(low, (since - size) // slide + 1)
        high = np.minimum(t // slide, (now - size) // slide)
        n = np.maximum(high - low + 1, 0)
        row = np.repeat(np.arange(len(t)), n)
        return row, low[row] + np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)


class SharedPairs(StatefulProcessor):
    """Pairs of every kind of sensor reading with the user's GPS readings."""

    def __init__(self, windows: Windows, gps_out: bool = True, chunk_pairs: int = 200_000):
        self.windows, self.gps_out, self.chunk_pairs = windows, gps_out, chunk_pairs
        # who: the user and salt group, of which a bucket holds many
        self.s_schema = StructType.fromDDL("t_us long, from_us long, who string, kind int, " + SENSOR_FIELDS)
        self.g_schema = StructType.fromDDL("t_us long, from_us long, who string, " + GPS_FIELDS)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.s_arrow, self.g_arrow = to_arrow_schema(self.s_schema), to_arrow_schema(self.g_schema)
        self.sensors = handle.getListState("sensors", CHUNK_STATE)
        self.gps = handle.getListState("gps", CHUNK_STATE)
        # the end up to which windows are joined, and the timer that is set
        self.clock = handle.getValueState("clock", "done_us long, timer_ms long")

    def _times(self) -> tuple[int | None, int | None]:
        return tuple(self.clock.get() or (None, None))  # one call to the store, not two

    def _set_timer(self, done: int | None, old: int | None, first: int | None) -> None:
        new = None if first is None else _timer_ms(first)
        if old is not None and (new is None or new < old):
            self.handle.deleteTimer(old)
            old = None
        if new is not None and old is None:
            self.handle.registerTimer(new)
            old = new
        self.clock.update((done, old))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        wm = timerValues.getCurrentWatermarkInMs() * 1000
        done, timer = self._times()
        edge = max(wm, done or 0) or None
        firsts, s_chunks, g_chunks = [], [], []
        for pdf in rows:
            t, kind = pdf["t_us"].to_numpy(dtype=np.int64), pdf["kind"].to_numpy(dtype=np.int64)
            # windows that had ended when a reading came are not its own
            pdf = pdf.assign(from_us=NEVER if edge is None else edge)
            is_gps = kind == GPS_KIND
            # a salted copy of a GPS reading is told by its group 0 only
            lead = pdf["lead"].to_numpy(dtype=bool)
            if self.gps_out and (is_gps & lead).any():
                yield _tagged(pdf[is_gps & lead], GPS_TAG, "g_", GPS_COLS)
            late = np.zeros(len(pdf), dtype=bool)
            for k in np.unique(kind):
                at = kind == k
                if edge is not None:
                    late[at] = self.windows.last_end(int(k), t[at]) <= edge
                if (at & ~late).any():
                    firsts.append(self.windows.first_timer(int(k), int(t[at & ~late].min()), edge))
            for at, prefix, cols in ((is_gps, "g_", GPS_COLS), (~is_gps, "s_", SENSOR_COLS)):
                if (late & lead & at).any():
                    yield _tagged(pdf[late & lead & at], LATE_TAG, prefix, cols)
            if (~late & is_gps).any():
                g_chunks.append(_chunk(pdf[~late & is_gps], self.g_arrow))
            if (~late & ~is_gps).any():
                s_chunks.append(_chunk(pdf[~late & ~is_gps], self.s_arrow))
        if s_chunks:
            self.sensors.appendList(s_chunks)
        if g_chunks:
            self.gps.appendList(g_chunks)
        if firsts:
            self._set_timer(done, timer, min(firsts + ([timer * 1000] if timer is not None else [])))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        now = timerValues.getCurrentWatermarkInMs() * 1000
        done, timer = self._times()
        if done is not None and now <= done:
            return
        keep_g: list = []
        parts = [df for df in self._due(self.gps, self.g_arrow, now, keep_g, lambda df: GPS_KIND)]
        gps = pd.concat(parts, ignore_index=True) if parts else None
        by_kind: dict[int, GpsSide] = {}
        if gps is not None:
            t, since = gps["t_us"].to_numpy(dtype=np.int64), self._since(gps, done)
            names = pd.Index(gps["who"].unique())
            body, code = gps[GPS_COLS].add_prefix("g_"), names.get_indexer(gps["who"])
            for k in self.windows.sizes:
                row, win = self.windows.ended(k, t, since, now)
                if len(row):
                    by_kind[k] = GpsSide(names, body.iloc[row].reset_index(drop=True), code[row], win)
        keep_s: list = []
        for df in self._due(self.sensors, self.s_arrow, now, keep_s, lambda df: df["kind"].to_numpy(dtype=np.int64)):
            kind = df["kind"].to_numpy(dtype=np.int64)
            for k in np.unique(kind).tolist():
                if k in by_kind:
                    yield from self._pairs(df[kind == k], by_kind[k], k, done, now)
        _write_back(self.gps, keep_g)
        _write_back(self.sensors, keep_s)
        # chunks that are kept have rows for ends after now
        firsts = [self.windows.first_timer(GPS_KIND, c[0], now) for c in keep_g + keep_s]
        if firsts:
            self._set_timer(now, None, min(firsts))
        else:
            self.clock.update((now, None))

    def _due(self, state, schema, now: int, keep: list, kind_of: Callable) -> Iterator[pd.DataFrame]:
        """Rows at times before ``now``; those with a window that ends later are kept as well."""
        for entry in state.get():
            entry = tuple(entry)
            if entry[0] >= now:
                keep.append(entry)
                continue
            df = _unchunk(entry, schema)
            t = df["t_us"].to_numpy(dtype=np.int64)
            kind = kind_of(df)
            if np.isscalar(kind):
                last = self.windows.last_end(kind, t)
            else:
                last = np.empty(len(t), dtype=np.int64)
                for k in np.unique(kind).tolist():
                    last[kind == k] = self.windows.last_end(k, t[kind == k])
            open_ = last > now
            if open_.any():
                keep.append(entry if open_.all() else _chunk(df[open_], schema))
            yield df

    @staticmethod
    def _since(df: pd.DataFrame, done: int | None) -> np.ndarray:
        """The end up to which the windows of each row are joined or not its own."""
        came = df["from_us"].to_numpy(dtype=np.int64)
        return came if done is None else np.maximum(came, done)

    def _pairs(self, sensors: pd.DataFrame, gps: "GpsSide", kind: int, done: int | None, now: int) -> Iterator[pd.DataFrame]:
        row, win = self.windows.ended(kind, sensors["t_us"].to_numpy(dtype=np.int64), self._since(sensors, done), now)
        at = gps.group_of(gps.names.get_indexer(sensors["who"])[row], win)
        weight = gps.size_of(at)
        row, win, at, weight = row[weight > 0], win[weight > 0], at[weight > 0], weight[weight > 0]
        if not len(row):
            return
        size, slide = self.windows.sizes[kind]
        body = sensors[SENSOR_COLS].add_prefix("s_")
        total = np.cumsum(weight)
        cut = np.searchsorted(total, np.arange(self.chunk_pairs, total[-1], self.chunk_pairs))
        for lo, hi in zip(np.concatenate(([0], cut)), np.concatenate((cut, [len(row)]))):
            if hi > lo:
                left = body.iloc[row[lo:hi]].reset_index(drop=True)
                left["win"], left["at"] = win[lo:hi], at[lo:hi]
                out = left.merge(gps.rows_of(at[lo:hi]), on="at")
                start = out["win"].to_numpy(dtype=np.int64) * slide
                out["window_start"], out["window_end"], out["tag"] = start, start + size, kind
                yield out[PAIR_COLS]

    def close(self) -> None:
        pass


class GpsSide:
    """GPS readings of the windows of one kind, in order of (who, window)."""

    def __init__(self, names: pd.Index, rows: pd.DataFrame, code: np.ndarray, win: np.ndarray):
        self.names, self.low = names, int(win.min())
        self.width = int(win.max()) - self.low + 1
        at = self.group_of(code, win)
        order = np.argsort(at, kind="stable")
        self.rows, self.at = rows.iloc[order].reset_index(drop=True).assign(at=at[order]), at[order]

    def group_of(self, code: np.ndarray, win: np.ndarray) -> np.ndarray:
        """Number of each (who, window); -1 where this side has no such who or window."""
        inside = (code >= 0) & (win >= self.low) & (win < self.low + self.width)
        return np.where(inside, code.astype(np.int64) * self.width + win - self.low, -1)

    def size_of(self, at: np.ndarray) -> np.ndarray:
        """GPS readings of each group number."""
        return np.searchsorted(self.at, at, side="right") - np.searchsorted(self.at, at)

    def rows_of(self, at: np.ndarray) -> pd.DataFrame:
        """The readings of these groups, each once."""
        at = np.unique(at)
        lo, n = np.searchsorted(self.at, at), self.size_of(at)
        return self.rows.iloc[np.repeat(lo, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)]


def _tagged(pdf: pd.DataFrame, tag: int, prefix: str, cols: list[str]) -> pd.DataFrame:
    out = pdf[cols].add_prefix(prefix)
    return out.assign(**{c: None for c in PAIR_COLS if c not in out and c != "tag"}, tag=tag)[PAIR_COLS]


class DealHot(StatefulProcessor):
    """Deals the readings of a user that come fast to several groups.

    The rule of a user is a short list of (from, groups): n(x) is the number of
    groups of the last entry with from <= x.  It only ever grows, and an entry
    starts after the latest reading seen so far.  A sensor reading at t goes to
    one of n(t - window) groups, a GPS reading to all n(t).  If both lie in one
    window [a, a + size), then t - size < a <= t', so the sensor reading's groups
    are among the GPS reading's, under the rule of the time either came: entries
    made in between start after the earlier one of the two.  So each pair meets
    in exactly one group, also in windows that are open while the rule changes.
    """

    def __init__(self, sizes: dict[int, tuple[int, int]], schema: StructType, hot_rows: int, max_groups: int):
        self.sizes, self.hot_rows, self.max_groups = sizes, hot_rows, max_groups
        self.names = [f.name for f in schema.fields]

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.rules = handle.getListState("rules", "from_us long, groups int")
        self.seen = handle.getValueState("seen", "last_us long, slot long, rows long")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        wm = timerValues.getCurrentWatermarkInMs()
        rules = sorted(tuple(r) for r in self.rules.get())
        last, slot, count = tuple(self.seen.get() or (None, None, 0))
        longest = max(size for size, _ in self.sizes.values())
        froms, groups = np.array([r[0] for r in rules], dtype=np.int64), np.array([1] + [r[1] for r in rules])
        for pdf in rows:
            t, kind = pdf["t_us"].to_numpy(dtype=np.int64), pdf["kind"].to_numpy(dtype=np.int64)
            is_gps = kind == GPS_KIND
            size = np.array([0 if k == GPS_KIND else self.sizes[k][0] for k in range(max(self.sizes) + 1)])[kind] \
                if len(self.sizes) else np.zeros(len(kind), dtype=np.int64)
            n = groups[np.searchsorted(froms, t - size, side="right")]
            own = pdf["mix"].to_numpy(dtype=np.int64) % n
            take = np.where(is_gps, n, 1)
            row = np.repeat(np.arange(len(pdf)), take)
            copy = np.arange(len(row)) - np.repeat(np.cumsum(take) - take, take)
            out = pdf.iloc[row].copy()
            out["salt"] = np.where(is_gps[row], copy, own[row])
            out["lead"] = ~is_gps[row] | (copy == 0)
            # the next operator refuses rows behind the watermark; the reading's own time is t_us
            out["et"] = pd.to_datetime(np.maximum(t[row], wm * 1000 + 1000), unit="us", utc=True)
            yield out[self.names]
            if (~is_gps).any():
                here = int(t[~is_gps].max() // longest)
                if slot is None or here > slot:
                    slot, count = here, 0
                count += int((t[~is_gps] // longest == slot).sum())
            last = int(t.max()) if last is None else max(last, int(t.max()))
        wanted = min(self.max_groups, -(-count // self.hot_rows))
        if last is not None:
            if wanted > groups[-1]:
                self.rules.appendValue((last + 1, int(wanted)))
            self.seen.update((last, slot, count))

    def close(self) -> None:
        pass


def shared_pairs(parsed: DataFrame, cfg: JobConfig, regions=None, ingest: str | None = None, *,
                 hot_rows: int | None = None, max_groups: int = 64, chunk_pairs: int = 200_000,
                 buckets: int | None = None) -> DataFrame:
    """Tagged pairs (``PAIR_SCHEMA``) of all sensors of ``cfg``, from one pass over a decoded stream.

    Tumbling and sliding windows; multi-value sensors take ``cfg.multi_window``.
    ``cfg.salt`` and ``cfg.salt_keys`` deal named users to that many groups;
    ``hot_rows`` does it by itself for users with more sensor readings a window.
    ``buckets`` lets users share that many groups (default: a group each); a
    group's GPS readings of the windows that end together are held in memory.
    It has to stay the same for a checkpoint."""
    cfg.validate()
    if cfg.window_type == "Session":
        raise ValueError("session windows have a query of their own a sensor: use run_pipeline")
    spark = parsed.sparkSession
    use_rocksdb_state(spark)
    ship_code(spark)
    for name in (__name__, "tandem.streaming.sessions"):  # a driver-side worker reads the state schema
        cloudpickle.register_pickle_by_value(sys.modules[name])
    size = cfg.window_size * 1_000_000
    slide = size if cfg.window_type == "Tumble" else cfg.window_size // 2 * 1_000_000
    multi = to_ms(cfg.multi_window) * 1000
    sizes = {}
    if cfg.single_sensors:
        sizes[WEATHER_KIND] = (size, slide)
    if cfg.multi_sensors:
        sizes[MULTI_KIND] = (multi, multi)
    if not sizes:
        raise ValueError("no sensors configured")
    rows = all_readings(parsed, cfg.single_sensors, cfg.multi_sensors, ingest)
    rows = rows.withWatermark("eventTs", cfg.delay)
    rows = position_region(rows, regions) if regions is not None else rows.withColumn("region", F.lit(""))
    weather = F.col("kind") == "weather"
    kind = F.when(F.col("kind") == "gps", GPS_KIND).when(weather, WEATHER_KIND).otherwise(MULTI_KIND)
    head = [F.when(weather, java_trim("userId")).otherwise(F.col("userId")).alias("key"),
            kind.cast("int").alias("kind"), F.unix_micros("eventTs").alias("t_us")]
    times = [F.unix_micros("obsTs").alias("obs_us"), F.unix_micros("ingestTs").alias("ingest_us")]
    body = [c for c in READING_COLS if c not in ("obs_us", "ingest_us")]
    mix = F.shiftrightunsigned(F.xxhash64(*body, "eventTs"), 1)
    if hot_rows:
        flat = rows.select(*head, mix.alias("mix"), *body, *times)
        schema = StructType(flat.select("key", "kind", "t_us", *body, "obs_us", "ingest_us").schema.fields)
        schema = schema.add("salt", "integer").add("lead", "boolean").add("et", "timestamp")
        flat = flat.groupBy("key").transformWithStateInPandas(
            DealHot(sizes, schema, hot_rows, max_groups), schema, "Append", "EventTime", eventTimeColumnName="et").drop("et")
    else:
        hot = F.col("key").isin(list(cfg.salt_keys)) if cfg.salt_keys else F.lit(True)
        n = F.when(hot, F.lit(cfg.salt)).otherwise(F.lit(1))
        groups = F.when(F.col("kind") == GPS_KIND, F.sequence(F.lit(0), n - 1)).otherwise(
            F.array(F.pmod(F.col("mix"), n).cast("int")))
        flat = (rows.select(*head, mix.alias("mix"), *body, *times).withColumn("salt", F.explode(groups))
                .withColumn("lead", (F.col("kind") != GPS_KIND) | (F.col("salt") == 0)).drop("mix"))
    flat = flat.withColumn("who", F.concat_ws(":", F.col("salt"), F.col("key")))
    if buckets:  # user and salt group are in who
        flat = (flat.withColumn("key", F.pmod(F.xxhash64("who"), F.lit(buckets)).cast("string"))
                .withColumn("salt", F.lit(0)))
    pairs = flat.groupBy("key", "salt").transformWithStateInPandas(
        SharedPairs(Windows(sizes), True, chunk_pairs), PAIR_SCHEMA, "Append", "EventTime")
    return pairs.withColumn("tag", F.element_at(F.array(*[F.lit(t) for t in TAGS]), F.col("tag") + 1))


def late_readings(pairs: DataFrame) -> DataFrame:
    """The readings that came after their last window had ended."""
    late = pairs.where(F.col("tag") == LATE)
    return late.select(*[F.coalesce("s_" + c, "g_" + c).alias(c) for c in ("userId", "userEmail", "deviceId", "sensorType")],
                       F.timestamp_micros(F.coalesce("s_obs_us", "g_obs_us")).alias("obsTs"),
                       F.timestamp_micros("s_ingest_us").alias("ingestTs"),
                       *[F.col("g_" + c).alias(c) for c in ("lat", "lng")],
                       *[F.col("s_" + c).alias(c) for c in SENSOR_COLS[4:15]])


def shared_messages(pairs: DataFrame, cfg: JobConfig) -> DataFrame:
    """(name, value): the message of every tagged row; ``name`` is the sensor
    type, ``GPS_WITH_REGION`` or ``late``.  GPS readings have a message only
    when ``cfg.gps_region_topic`` is set."""
    if not cfg.gps_region_topic:
        pairs = pairs.where(F.col("tag") != TAGS[GPS_TAG])
    tag = F.col("tag")
    is_weather, is_multi, is_gps = (tag == k for k in ("weather", "multi", "gps"))
    us = lambda c: F.timestamp_micros(c)
    flat = pairs.select(
        "tag", F.when(is_weather | is_multi, F.col("s_sensorType")).when(is_gps, F.lit(GPS_WITH_REGION))
        .otherwise(F.lit(LATE)).alias("name"),
        *[F.coalesce("g_" + c, "s_" + c).alias(c) for c in ("userId", "userEmail", "deviceId")],
        F.when(is_weather | is_multi, join_type_label(F.col("s_sensorType"), F.col("g_sensorType")))
        .otherwise(F.coalesce("g_sensorType", "s_sensorType")).alias("sensorType"),
        *[F.col("g_" + c).alias(c) for c in ("lat", "lng", "region")], *[F.col("s_" + c).alias(c) for c in SENSOR_COLS[4:15]],
        us(F.when(is_multi, F.col("g_obs_us")).otherwise(F.coalesce("s_obs_us", "g_obs_us"))).alias("obsTs"),
        us("s_ingest_us").alias("ingestTs"))
    reading = F.struct(*[c for c in flat.columns if c not in ("tag", "name", "obsTs", "ingestTs")],
                       F.unix_millis("obsTs").alias("observationTimestamp"), F.unix_millis("ingestTs").alias("ingestTimestamp"))
    value = (F.when(is_weather, weather_value(flat, job_name=cfg.job_name, window_type=cfg.window_type,
                                              window_size=cfg.window_size))
             .when(is_multi, multi_value(flat, quoted_keys=cfg.quoted_keys))
             .when(is_gps, gps_region_value(flat)).otherwise(F.to_json(reading)))
    return flat.select("name", value.alias("value"))


def topic_of(cfg: JobConfig, late_topic: str | None = None):
    """Output topic of a message by its ``name``: sensors go to ``cfg.des_topic``."""
    return (F.when(F.col("name") == GPS_WITH_REGION, F.lit(cfg.gps_region_topic))
            .when(F.col("name") == LATE, F.lit(late_topic)).otherwise(F.lit(cfg.des_topic)))


def run_shared_pipeline(spark: SparkSession, cfg: JobConfig, *, source: DataFrame | None = None, regions=None,
                        ingest: str | None = "timestamp", sink: Callable[[DataFrame, str, str], object] | None = None,
                        checkpoint_dir: str | None = None, late_topic: str | None = None, hot_rows: int | None = None,
                        buckets: int | None = BUCKETS):
    """Start the whole job as one streaming query and return it.

    ``sink(messages, name, checkpoint)`` gets (name, value); by default messages
    go to Kafka, late readings to ``late_topic`` (None: they are left out);
    ``buckets`` as in :func:`shared_pairs`."""
    if source is None:
        if not cfg.topic:
            raise ValueError("a Kafka source needs a topic")
        source = read_kafka(spark, cfg.topic, cfg.bootstrap_servers, group_id=cfg.group_id,
                            starting_offsets=cfg.starting_offsets, extra=cfg.kafka_extra)
    msgs = shared_messages(shared_pairs(parse_feed(source), cfg, regions, ingest, hot_rows=hot_rows,
                                        buckets=buckets), cfg)
    root = (checkpoint_dir or f"{checkpoint_root(spark).rstrip('/')}/{cfg.job_name}").rstrip("/")
    if sink is not None:
        return sink(msgs, cfg.job_name, f"{root}/shared")
    out = msgs.withColumn("topic", topic_of(cfg, late_topic)).where("topic IS NOT NULL").select("topic", "value")
    return (out.writeStream.format("kafka").option("kafka.bootstrap.servers", cfg.bootstrap_servers)
            .option("checkpointLocation", f"{root}/shared").queryName(cfg.job_name).outputMode("append").start())
