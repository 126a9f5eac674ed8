"""Decode the mixed JSON feed and split it into typed readings.

One message per row in a ``value`` column.  Every reader keeps zero or one
row per message and drops a message that lacks a field it needs, instead of
failing the job.  All work is built-in Spark expressions; nothing runs in
Python per row.

Message: {"userAccount": {"userId", "userEmail"}, "deviceId", "sensorType",
          "sensorValue": <object or scalar>, "observationTimestamp": epoch ms}
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tandem.functions.coerce import (
    as_long, as_text, json_float, json_int, member_names, node_kind, variant_number, with_once,
)

GPS = "TYPE_GPS"
WEATHER = "TYPE_WEATHER"
PROXIMITY = "TYPE_PROXIMITY"
ACCELEROMETER = "TYPE_ACCELEROMETER"
GRAVITY = "TYPE_GRAVITY"

# sensorValue stays JSON text so that member order and kinds are not lost;
# observationTimestamp is text so that numbers and numeric text both read.
ENVELOPE = ("userAccount struct<userId: string, userEmail: string>, deviceId string, "
            "sensorType string, sensorValue string, observationTimestamp string")
WEATHER_FIELDS = ("temp", "humd", "CO2", "CO", "hour")


def parse_feed(feed: DataFrame, value_col: str = "value") -> DataFrame:
    """Decode each message once.

    Output: userId, userEmail, deviceId, sensorType, sensorValue (JSON text),
    obsMs (bigint, null when absent), raw (the message), plus every other
    input column (e.g. a broker ``timestamp``).  Messages that are not JSON
    objects are dropped here and listed by ``bad_records``.
    """
    extra = [c for c in feed.columns if c != value_col]
    d = with_once(feed.select(F.col(value_col).alias("raw"), *extra),
                  _j=F.from_json(F.col("raw"), ENVELOPE))
    decoded = (F.col("_j.userAccount").isNotNull() | F.col("_j.deviceId").isNotNull()
               | F.col("_j.sensorType").isNotNull() | F.col("_j.sensorValue").isNotNull()
               | F.col("_j.observationTimestamp").isNotNull())
    return d.where(decoded).select(
        as_text("_j.userAccount.userId", "raw", "$.userAccount.userId").alias("userId"),
        as_text("_j.userAccount.userEmail", "raw", "$.userAccount.userEmail").alias("userEmail"),
        as_text("_j.deviceId", "raw", "$.deviceId").alias("deviceId"),
        as_text("_j.sensorType", "raw", "$.sensorType").alias("sensorType"),
        F.col("_j.sensorValue").alias("sensorValue"),
        _obs_ms(F.col("_j.observationTimestamp"), F.col("raw")).alias("obsMs"),
        "raw", *extra,
    )


def slim_parsed(parsed: DataFrame) -> DataFrame:
    """Decoded messages for storage: the raw message is needed only to read
    a scalar value's JSON kind; an object value (decoded text always starts
    with '{') never needs it, so it is dropped there."""
    return parsed.withColumn("raw", F.when(F.col("sensorValue").startswith("{"), F.lit(None))
                             .otherwise(F.col("raw")))


def stage_parsed(parsed: DataFrame, path: str | None = None, types: tuple | None = None) -> DataFrame:
    """Write decoded messages once as parquet partitioned by ``sensorType``
    (under ``spark.checkpoint.dir`` unless ``path`` is given) and read them
    back.  Batch only.  Every reader of the result then scans only its own
    sensor type's partition and only the columns it needs, instead of
    re-reading and re-decoding the whole feed once per sensor and once for
    GPS; the lineage is cut there too.  ``sensorType`` is text from outside:
    with ``types`` only messages of those types are written, so a topic with
    many unknown types does not make a folder for each.
    """
    from tandem.session import scratch_path

    spark = parsed.sparkSession
    path = path or scratch_path(spark, "parsed-feed")
    if types is not None:
        parsed = parsed.where(F.col("sensorType").isin(list(types)))
    slim = slim_parsed(parsed)
    slim.write.partitionBy("sensorType").parquet(path)
    back = spark.read.schema(slim.schema).parquet(path)  # known schema: also when empty
    return back.select(*parsed.columns)


def _obs_ms(text, raw):
    """Epoch ms: a present JSON null reads as 0, only a missing member gives
    null (the key scan runs only for the rare null rows)."""
    present = F.array_contains(F.json_object_keys(raw), "observationTimestamp")
    truth = (text == "true") & (node_kind(raw, "$.observationTimestamp") == "BOOLEAN")
    return (F.when(truth, F.lit(1).cast("bigint")).when(text.isNotNull(), as_long(text))
            .when(present, F.lit(0).cast("bigint")))


def bad_records(feed: DataFrame, value_col: str = "value") -> DataFrame:
    """Messages that are not a JSON object (broken text, arrays, scalars)."""
    return feed.where(F.json_object_keys(F.col(value_col)).isNull())


def _ids_present() -> Column:
    return (F.col("userId").isNotNull() & F.col("userEmail").isNotNull()
            & F.col("deviceId").isNotNull() & F.col("obsMs").isNotNull())


def _has(keys: Column, *names: str) -> Column:
    cond = keys.isNotNull()
    for n in names:
        cond = cond & F.array_contains(keys, n)
    return cond


def _obs_ts() -> Column:
    return F.timestamp_millis(F.col("obsMs")).alias("obsTs")


def gps_readings(parsed: DataFrame, by_device: bool = False) -> DataFrame:
    """GPS positions: userId, userEmail, deviceId, sensorType, lat, lng (f32), obsTs.

    ``by_device=True`` gives the narrower deviceId, sensorType, lat, lng,
    obsTs row (the account must still be present).
    """
    keys = F.json_object_keys(F.col("sensorValue"))
    sv = F.from_json(F.col("sensorValue"), "attr_lat double, attr_lng double")
    g = with_once(parsed.where((F.col("sensorType") == GPS) & _ids_present()),
                  _keys=keys, _sv=sv).where(_has(F.col("_keys"), "attr_lat", "attr_lng"))
    head = [] if by_device else ["userId", "userEmail"]
    return g.select(*head, "deviceId", "sensorType",
                    json_float(F.col("_sv.attr_lat")).alias("lat"),
                    json_float(F.col("_sv.attr_lng")).alias("lng"), _obs_ts())


def weather_readings(parsed: DataFrame, sensor_type: str = WEATHER,
                     ingest: str | None = None) -> DataFrame:
    """Five-number readings: userId, userEmail, deviceId, sensorType, temp,
    humd, CO2, CO, hour (int), obsTs, ingestTs.

    All five members must be present (so the object has more than one
    member); a member that is not a number reads as 0, 31.9 reads as 31.
    ``ingest`` names a timestamp column to use as the ingest time (e.g. a
    broker timestamp); by default it is the time of processing.
    """
    keys = F.json_object_keys(F.col("sensorValue"))
    sv = F.from_json(F.col("sensorValue"), ", ".join(f"{f} double" for f in WEATHER_FIELDS))
    w = with_once(parsed.where((F.col("sensorType") == sensor_type) & _ids_present()),
                  _keys=keys, _sv=sv).where(_has(F.col("_keys"), *WEATHER_FIELDS))
    ingest_col = F.col(ingest) if ingest else F.current_timestamp()
    return w.select("userId", "userEmail", "deviceId", "sensorType",
                    *[json_int(F.col(f"_sv.{f}"), F.get_json_object("sensorValue", f"$.{f}")).alias(f)
                      for f in WEATHER_FIELDS],
                    _obs_ts(), ingest_col.cast("timestamp").alias("ingestTs"))


def multi_readings(parsed: DataFrame, sensor_type: str = ACCELEROMETER) -> DataFrame:
    """Three-axis readings: userId, userEmail, deviceId, sensorType,
    name1, value1, name2, value2, name3, value3 (f32), obsTs.

    Member names are free; the first three distinct names in document order
    are kept (a repeated name keeps its first place and its last value).
    Fewer than three members: dropped.  Non-numbers read as 0.
    """
    names = member_names(F.col("sensorValue"))
    vmap = F.from_json(F.col("sensorValue"), "map<string, variant>")
    m = (with_once(parsed.where((F.col("sensorType") == sensor_type) & _ids_present()),
                   _names=names)
         .where(F.size(F.col("_names")) >= 3))
    m = with_once(m, _entries=F.map_entries(vmap))

    def value_of(i: int) -> Column:
        name = F.col("_names")[i]
        last = F.element_at(F.filter(F.col("_entries"), lambda e: e["key"] == name), -1)
        return json_float(variant_number(last["value"]))

    cols = []
    for i in range(3):
        cols += [F.col("_names")[i].alias(f"name{i + 1}"), value_of(i).alias(f"value{i + 1}")]
    return m.select("userId", "userEmail", "deviceId", "sensorType", *cols, _obs_ts())


def scalar_readings(parsed: DataFrame, sensor_type: str = PROXIMITY) -> DataFrame:
    """Scalar readings: deviceId, sensorType, value (int), obsTs.

    The account must be present though it is not kept.  A JSON number is
    truncated to int; text, booleans, objects read as 0; no value: dropped.
    """
    num = F.from_json(F.col("raw"), "sensorValue double")["sensorValue"]
    # a JSON null value is present (reads as 0); only a missing member drops
    present = (F.col("sensorValue").isNotNull()
               | F.array_contains(F.json_object_keys(F.col("raw")), "sensorValue"))
    s = parsed.where((F.col("sensorType") == sensor_type) & _ids_present() & present)
    text = F.get_json_object("raw", "$.sensorValue")
    return s.select("deviceId", "sensorType", json_int(num, text).alias("value"), _obs_ts())


def all_readings(parsed: DataFrame, single: tuple = (WEATHER,), multi: tuple = (), ingest: str | None = None) -> DataFrame:
    """GPS, five-number and three-axis readings in one frame, in one pass over
    the messages: the rows of ``gps_readings``, of ``weather_readings`` for the
    types in ``single`` and of ``multi_readings`` for those in ``multi``.

    ``kind`` (gps, weather, multi) tells which columns are filled: lat, lng;
    temp, humd, CO2, CO, hour, ingestTs; name1, value1, ... value3.  Every row
    has userId, userEmail, deviceId, sensorType, obsTs and ``eventTs``, the
    ingest time of a weather reading and the observation time of the others.
    A type named twice is read as the first of gps, single, multi.
    """
    sv, stype = F.col("sensorValue"), F.col("sensorType")
    kind = F.when(stype == GPS, "gps")
    for types, name in ((single, "weather"), (multi, "multi")):
        kind = kind.when(stype.isin(list(types)), name) if types else kind
    d = parsed.where(_ids_present()).withColumn("kind", kind).where("kind IS NOT NULL")
    is_gps, is_weather, is_multi = (F.col("kind") == k for k in ("gps", "weather", "multi"))
    d = with_once(d, _keys=F.when(~is_multi, F.json_object_keys(sv)),
                  _gps=F.when(is_gps, F.from_json(sv, "attr_lat double, attr_lng double")),
                  _wea=F.when(is_weather, F.from_json(sv, ", ".join(f"{f} double" for f in WEATHER_FIELDS))),
                  _names=F.when(is_multi, member_names(sv)))
    d = d.where((is_gps & _has(F.col("_keys"), "attr_lat", "attr_lng"))
                | (is_weather & _has(F.col("_keys"), *WEATHER_FIELDS)) | (is_multi & (F.size("_names") >= 3)))
    d = with_once(d, _entries=F.when(is_multi, F.map_entries(F.from_json(sv, "map<string, variant>"))))

    def value_of(i: int) -> Column:
        last = F.element_at(F.filter("_entries", lambda e: e["key"] == F.col("_names")[i]), -1)
        return json_float(variant_number(last["value"]))

    axes = []
    for i in range(3):
        axes += [F.when(is_multi, F.col("_names")[i]).alias(f"name{i + 1}"),
                 F.when(is_multi, value_of(i)).alias(f"value{i + 1}")]
    ingest_ts = (F.col(ingest) if ingest else F.current_timestamp()).cast("timestamp")
    obs = F.timestamp_millis(F.col("obsMs"))
    return d.select(
        "kind", "userId", "userEmail", "deviceId", "sensorType",
        *[F.when(is_gps, json_float(F.col(f"_gps.attr_{c}"))).alias(c) for c in ("lat", "lng")],
        *[F.when(is_weather, json_int(F.col(f"_wea.{f}"), F.get_json_object("sensorValue", f"$.{f}"))).alias(f)
          for f in WEATHER_FIELDS], *axes, obs.alias("obsTs"), F.when(is_weather, ingest_ts).alias("ingestTs"),
        F.when(is_weather, ingest_ts).otherwise(obs).alias("eventTs"))
