"""Event-time windowed inner joins of a sensor stream with GPS positions.

For every key and window, every sensor reading pairs with every GPS reading
of the same key.  One code path serves batch and streaming DataFrames:

* tumbling / sliding: both sides get ``window(event_time, size[, slide])``
  and are equi-joined on (key, window).  In batch that is a plain shuffle
  join on (key, window) - a hot key is spread over its windows and AQE
  splits a skewed partition; in a stream it is Spark's symmetric hash join
  whose state is evicted by the per-side watermarks.  A pair appears once
  per window the two readings share.
* session: sessions are formed over both sides' readings of a key together
  (a step of at most the gap stays in the session).  Batch: see
  ``tandem.operators.sessions``; stream: ``tandem.streaming.sessions``.

Pair shapes (which side gives which field) follow the three sensor kinds:
weather (keys: trimmed sensor userId = GPS userId; event time: sensor
ingest time), multi (raw userId = userId) and scalar (trimmed sensor
deviceId = GPS deviceId).
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tandem.functions.coerce import java_trim
from tandem.functions.labels import join_type_label


_UNIT_MS = {"ms": 1, "millisecond": 1, "milliseconds": 1, "s": 1000, "second": 1000,
            "seconds": 1000, "minute": 60_000, "minutes": 60_000, "hour": 3_600_000,
            "hours": 3_600_000, "day": 86_400_000, "days": 86_400_000}


def to_ms(size) -> int:
    """Window length in ms: a number is seconds; text like '10 seconds' or
    '10000 milliseconds' is parsed."""
    if isinstance(size, bool):
        raise ValueError("window size must be a number of seconds or a duration text")
    if isinstance(size, (int, float)):
        return int(round(size * 1000))
    m = re.fullmatch(r"\s*(-?\d+)\s*([a-z]+)\s*", str(size))
    if not m or m.group(2) not in _UNIT_MS:
        raise ValueError(f"cannot read window size {size!r}")
    return int(m.group(1)) * _UNIT_MS[m.group(2)]


@dataclass(frozen=True)
class PairKind:
    """How a sensor kind meets GPS: keys, event time, carried fields."""
    name: str
    sensor_key: str            # sensor column holding the key
    trim_sensor_key: bool      # strip blanks/controls from the sensor key
    gps_key: str               # GPS column holding the key (used raw)
    sensor_cols: tuple         # sensor columns carried into the pair
    sensor_time_cols: tuple    # sensor timestamp columns, carried as epoch micros


WEATHER_PAIR = PairKind("weather", "userId", True, "userId",
                        ("sensorType", "temp", "humd", "CO2", "CO", "hour"),
                        ("obsTs", "ingestTs"))
MULTI_PAIR = PairKind("multi", "userId", False, "userId",
                      ("sensorType", "name1", "value1", "name2", "value2", "name3", "value3"), ())
SCALAR_PAIR = PairKind("scalar", "deviceId", True, "deviceId", ("sensorType", "value"), ())

GPS_COLS = ("userId", "userEmail", "deviceId", "sensorType", "lat", "lng")


def pair_kind_of(sensor: DataFrame) -> PairKind:
    cols = set(sensor.columns)
    if {"temp", "humd", "CO2", "CO"} <= cols:
        return WEATHER_PAIR
    if {"name1", "value1"} <= cols:
        return MULTI_PAIR
    if "value" in cols:
        return SCALAR_PAIR
    raise ValueError(f"not a sensor reading frame: {sensor.columns}")


def _default_time(kind: PairKind) -> str:
    return "ingestTs" if kind is WEATHER_PAIR else "obsTs"


def _sides(sensor: DataFrame, gps: DataFrame, kind: PairKind, sensor_time: str,
           delay: str | None):
    """Key + event time + carried columns (prefixed s_/g_) for each side;
    ``delay`` None sets no watermark.

    The event time is the only timestamp kept on each side (a streaming join
    allows one event-time column per side); other times travel as ms."""
    skey = F.col(kind.sensor_key)
    skey = java_trim(skey) if kind.trim_sensor_key else skey
    s = sensor.withWatermark(sensor_time, delay) if sensor.isStreaming and delay is not None else sensor
    s_cols = [skey.alias("_k"), F.col(sensor_time).alias("_et")]
    s_cols += [F.col(c).alias("s_" + c) for c in kind.sensor_cols]
    s_cols += [F.unix_micros(F.col(c)).alias("s_" + c) for c in kind.sensor_time_cols]
    s = s.select(*s_cols)

    g = gps.withWatermark("obsTs", delay) if gps.isStreaming and delay is not None else gps
    g_keep = [c for c in GPS_COLS if c in gps.columns]
    g_cols = [F.col(kind.gps_key).alias("_k"), F.col("obsTs").alias("_et")]
    g_cols += [F.col(c).alias("g_" + c) for c in g_keep]
    g_cols += [F.unix_micros(F.col("obsTs")).alias("g_obsTs")]
    if "region" in gps.columns:
        g_cols.append(F.col("region").alias("g_region"))
    g = g.select(*g_cols)
    return s, g


def project_pair(joined: DataFrame, kind: PairKind) -> DataFrame:
    """Shape of one joined pair (with window_start / window_end)."""
    ts = lambda c: F.timestamp_micros(F.col(c))
    label = join_type_label(F.col("s_sensorType"), F.col("g_sensorType"))
    win = [F.col("window_start"), F.col("window_end")]
    region = [F.col("g_region").alias("region")] if "g_region" in joined.columns else []
    if kind is WEATHER_PAIR:
        cols = [F.col("g_userId").alias("userId"), F.col("g_userEmail").alias("userEmail"),
                F.col("g_deviceId").alias("deviceId"), label.alias("sensorType"),
                F.col("g_lat").alias("lat"), F.col("g_lng").alias("lng"), *region,
                *[F.col("s_" + c).alias(c) for c in ("temp", "humd", "CO2", "CO", "hour")],
                ts("s_obsTs").alias("obsTs"), ts("s_ingestTs").alias("ingestTs")]
    elif kind is MULTI_PAIR:
        cols = [F.col("g_userId").alias("userId"), F.col("g_userEmail").alias("userEmail"),
                F.col("g_deviceId").alias("deviceId"), label.alias("sensorType"),
                F.col("g_lat").alias("lat"), F.col("g_lng").alias("lng"), *region,
                *[F.col("s_" + c).alias(c) for c in
                  ("name1", "value1", "name2", "value2", "name3", "value3")],
                ts("g_obsTs").alias("obsTs")]
    else:
        # the scalar pair keeps the GPS sensorType (no joined label)
        cols = [F.col("g_deviceId").alias("deviceId"), F.col("g_sensorType").alias("sensorType"),
                F.col("g_lat").alias("lat"), F.col("g_lng").alias("lng"), *region,
                F.col("s_value").alias("value"), ts("g_obsTs").alias("obsTs")]
    if "window" in joined.columns:  # with the watermark, for a stateful operator behind the join
        win.append(F.col("window"))
    return joined.select(*cols, *win)


def salted_equi_join(left: DataFrame, right: DataFrame, keys: list, salt: int = 1,
                     salt_keys=None, hot_col: str = "_k") -> DataFrame:
    """Inner equi-join on ``keys``; with ``salt`` > 1 each left row goes to
    one of ``salt`` sub-groups (a hash of the row) and every right row is
    copied to all of them, so one hot key group is spread over ``salt``
    tasks / state partitions.  The output is the same pairs, once each.
    ``salt_keys`` limits this to rows whose ``hot_col`` is one of them; the
    other rows keep sub-group 0 and are not copied."""
    if salt <= 1:
        return left.join(right, on=keys, how="inner")
    hot_l = F.col(hot_col).isin(list(salt_keys)) if salt_keys else F.lit(True)
    hot_r = F.col(hot_col).isin(list(salt_keys)) if salt_keys else F.lit(True)
    own = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in left.columns]), F.lit(salt))
    lt = left.select("*", F.when(hot_l, own).otherwise(F.lit(0).cast("bigint")).alias("_salt"))
    groups = F.sequence(F.lit(0), F.lit(salt - 1)).cast("array<bigint>")
    rt = right.select("*", F.explode(F.when(hot_r, groups).otherwise(
        F.array(F.lit(0).cast("bigint")))).alias("_salt"))
    return lt.join(rt, on=list(keys) + ["_salt"], how="inner").drop("_salt")


FOLD_ROWS = 1024


def _folded(df: DataFrame) -> DataFrame:
    """Equal rows as one row with their number ``_n``; more than ``FOLD_ROWS``
    of them as several such rows.  Rows with floating-point columns stay as
    they are: grouping makes -0.0 and 0.0 one value."""
    if any(t in ("float", "double") for _, t in df.dtypes):
        return df.select("*", F.lit(1).cast("bigint").alias("_n"))
    f = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("_all"))
    f = f.select("*", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("_all") - 1, F.lit(FOLD_ROWS).cast("bigint"))).alias("_from"))
    return f.select(*df.columns, F.least(F.lit(FOLD_ROWS), F.col("_all") - F.col("_from")).alias("_n"))


def _dense_batch_join(s: DataFrame, g: DataFrame, salt: int, salt_keys) -> DataFrame:
    """Equal sensor rows of a (key, window) meet a GPS row once and are repeated
    behind the join: the same pairs, those of a GPS reading next to each other."""
    j = salted_equi_join(g, _folded(s), ["_k", "_w"], salt, salt_keys)
    return j.select("*", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("_n"))).alias("_i")).drop("_n", "_i")


def _fixed_window_join(sensor, gps, size_ms, slide_ms, kind, sensor_time, delay, salt=1,
                       salt_keys=None, keep_window=False, dense=False):
    kind = kind or pair_kind_of(sensor)
    sensor_time = sensor_time or _default_time(kind)
    size = f"{size_ms} milliseconds"
    slide = f"{slide_ms} milliseconds"
    if dense and (sensor.isStreaming or gps.isStreaming):
        from tandem.streaming.packs import packed_join

        s, g = _sides(sensor, gps, kind, sensor_time, None)
        j = packed_join(s, g, size, delay, salt, salt_keys)
    else:
        s, g = _sides(sensor, gps, kind, sensor_time, delay)
        s = s.select("*", F.window("_et", size, slide).alias("_w")).drop("_et")
        g = g.select("*", F.window("_et", size, slide).alias("_w")).drop("_et")
        j = _dense_batch_join(s, g, salt, salt_keys) if dense else salted_equi_join(s, g, ["_k", "_w"], salt, salt_keys)
    j = j.select("*", F.col("_w.start").alias("window_start"), F.col("_w.end").alias("window_end"),
                 *([F.col("_w").alias("window")] if keep_window else []))
    return project_pair(j, kind)


def tumbling_join(sensor: DataFrame, gps: DataFrame, size, *, kind: PairKind | None = None,
                  sensor_time: str | None = None, delay: str = "0 seconds",
                  salt: int = 1, salt_keys=None, keep_window: bool = False,
                  dense: bool = False) -> DataFrame:
    """Epoch-aligned tumbling windows of ``size`` (seconds, or duration text).

    ``delay`` is the watermark delay of a stream (0: readings arrive in time
    order per side); ``salt`` > 1 spreads each (key, window) group over that
    many sub-groups (see ``salted_equi_join``) - useful in a stream, where
    AQE cannot split a skewed join partition; ``salt_keys`` salts only the
    named hot join keys; ``keep_window`` adds the window as column ``window``
    (see ``tandem.operators.grouping``).

    ``dense`` is for keys with many readings a window, whose pairs outnumber
    the readings by far (readings by device): the same pairs, of a GPS reading
    next to each other.  Batch: equal sensor rows are joined once and repeated
    behind the join.  Stream: see ``tandem.streaming.packs``."""
    size_ms = to_ms(size)
    if size_ms < 1:
        raise ValueError("window size must be positive")
    return _fixed_window_join(sensor, gps, size_ms, size_ms, kind, sensor_time, delay, salt,
                              salt_keys, keep_window, dense)


def sliding_join(sensor: DataFrame, gps: DataFrame, size, slide=None, *,
                 kind: PairKind | None = None, sensor_time: str | None = None,
                 delay: str = "0 seconds", salt: int = 1, salt_keys=None,
                 panes: bool | None = None) -> DataFrame:
    """Sliding windows; ``slide`` defaults to size/2 in whole seconds
    (integer division of the size in seconds, so 5 s slides by 2 s).

    ``panes`` (batch) keeps readings once instead of copying them into every
    window (``tandem.operators.panes``); by default it does so when a reading
    lies in more than three windows."""
    size_ms = to_ms(size)
    if slide is None:
        if size_ms % 1000:
            raise ValueError("default slide needs a size in whole seconds")
        slide_ms = (size_ms // 1000 // 2) * 1000
    else:
        slide_ms = to_ms(slide)
    if size_ms < 1 or slide_ms < 1:
        raise ValueError("sliding windows need size >= 2 s (slide = size/2 >= 1 s)")
    if slide_ms > size_ms:
        raise ValueError("slide must not exceed size")
    streaming = sensor.isStreaming or gps.isStreaming
    if panes is None:
        panes = not streaming and size_ms > 3 * slide_ms
    if panes:
        from tandem.operators.panes import pane_pairs

        if streaming:
            raise ValueError("panes are for batch frames; see tandem.streaming.shared for streams")
        kind = kind or pair_kind_of(sensor)
        s, g = _sides(sensor, gps, kind, sensor_time or _default_time(kind), delay)
        return project_pair(pane_pairs(s, g, size_ms, slide_ms, salt, salt_keys), kind)
    return _fixed_window_join(sensor, gps, size_ms, slide_ms, kind, sensor_time, delay, salt,
                              salt_keys)


def session_join(sensor: DataFrame, gps: DataFrame, gap, *, kind: PairKind | None = None,
                 sensor_time: str | None = None, delay: str = "0 seconds",
                 bucket=None, materialize: bool = True, salt: int = 1,
                 target_rows: int | None = None, chunk_pairs: int = 200_000,
                 salt_keys=None, buckets: int | None = None) -> DataFrame:
    """Session windows over both sides' readings of a key; a new session
    starts after a silence longer than ``gap``.  Window bounds are
    [first reading, last reading + gap).

    Batch (see ``tandem.operators.sessions``): ``bucket`` fixes the time
    bucket of the local numbering (default: every key with more than
    ``target_rows`` readings is cut at quantiles of its times);
    ``materialize`` writes the numbered rows once under the checkpoint
    folder; ``salt`` spreads a hot session in the final pair join.
    Stream (see ``tandem.streaming.sessions``): list state per key, pairs
    emitted in chunks of about ``chunk_pairs`` when a session closes;
    ``salt`` spreads a key over that many groups (GPS readings and sensor
    times are copied to each); ``salt_keys`` limits salting to the named
    hot join keys (batch and stream); ``buckets`` (stream) lets keys share
    that many state groups."""
    from tandem.operators.sessions import batch_session_pairs
    from tandem.streaming.sessions import stream_session_pairs

    gap_ms = to_ms(gap)
    if gap_ms < 1:
        raise ValueError("session gap must be positive")
    kind = kind or pair_kind_of(sensor)
    sensor_time = sensor_time or _default_time(kind)
    s, g = _sides(sensor, gps, kind, sensor_time, delay)
    if s.isStreaming or g.isStreaming:
        j = stream_session_pairs(s, g, gap_ms, chunk_pairs=chunk_pairs, salt=salt,
                                 salt_keys=salt_keys, buckets=buckets)
    else:
        extra = {"target_rows": target_rows} if target_rows else {}
        j = batch_session_pairs(s, g, gap_ms, bucket_ms=to_ms(bucket) if bucket else None,
                                materialize=materialize, salt=salt, salt_keys=salt_keys, **extra)
    return project_pair(j, kind)


WINDOW_KINDS = ("Tumble", "Sliding", "Session")


def window_join(window_type: str, sensor: DataFrame, gps: DataFrame, size, **kw) -> DataFrame:
    """Dispatch on the window type name: Tumble, Sliding or Session."""
    if window_type == "Tumble":
        return tumbling_join(sensor, gps, size, **kw)
    if window_type == "Sliding":
        return sliding_join(sensor, gps, size, **kw)
    if window_type == "Session":
        return session_join(sensor, gps, size, **kw)
    raise ValueError(f"unknown window type {window_type!r}; expected one of {WINDOW_KINDS}")
