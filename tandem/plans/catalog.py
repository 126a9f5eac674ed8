"""Registered queries over the driver's tables (one callable per operator).

Every query derives the sensor feed from ``events`` (and regions from
``nation``) with Spark, so its work grows with the tables.  Output times
are epoch milliseconds (bigint) so that any engine can check them exactly.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tandem.functions.alerts import fire_alert
from tandem.operators.grouping import joined_by_device
from tandem.operators.messages import gps_region_message, multi_message, weather_message
from tandem.operators.parse import (
    ACCELEROMETER, GPS, PROXIMITY, WEATHER, bad_records, gps_readings, multi_readings, parse_feed, scalar_readings, stage_parsed,
    weather_readings,
)
from tandem.operators.polygons import polygon_lookup
from tandem.operators.region import region_lookup
from tandem.operators.windows import session_join, sliding_join, tumbling_join, window_join
from tandem.sources.events import events_feed, polygons_from_nation, regions_from_nation

# Window sizes used on the events-derived feed (seconds).  The fixed 10 s
# windows of the multi and scalar joins match nothing on data spread over a
# month, so those joins are run with a day here.
DAY = 86_400
QUARTER_DAY = 21_600
HALF_HOUR = 1_800


def _parsed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse_feed(events_feed(spark, sf_dir))


def _staged(spark: SparkSession, sf_dir: str, *types: str) -> DataFrame:
    """Decoded messages of the named types, written once (partitioned by
    sensor type) for queries that read more than one kind of reading."""
    return stage_parsed(_parsed(spark, sf_dir), types=types)


def _gps_weather(spark, sf_dir):
    p = _staged(spark, sf_dir, GPS, WEATHER)
    return gps_readings(p), weather_readings(p, ingest="timestamp")


def _gps_multi(spark, sf_dir):
    p = _staged(spark, sf_dir, GPS, ACCELEROMETER)
    return gps_readings(p), multi_readings(p)


def out_weather_pairs(df: DataFrame) -> DataFrame:
    return df.select("userId", "userEmail", "deviceId", "sensorType", "lat", "lng", "temp",
                     "humd", "CO2", "CO", "hour",
                     F.unix_millis("obsTs").alias("obs_ms"),
                     F.unix_millis("ingestTs").alias("ingest_ms"),
                     F.unix_millis("window_start").alias("window_start_ms"),
                     F.unix_millis("window_end").alias("window_end_ms"))


def out_multi_pairs(df: DataFrame) -> DataFrame:
    return df.select("userId", "userEmail", "deviceId", "sensorType", "lat", "lng",
                     "name1", "value1", "name2", "value2", "name3", "value3",
                     F.unix_millis("obsTs").alias("obs_ms"),
                     F.unix_millis("window_start").alias("window_start_ms"),
                     F.unix_millis("window_end").alias("window_end_ms"))


def out_scalar_pairs(df: DataFrame) -> DataFrame:
    return df.select("deviceId", "sensorType", "lat", "lng", "value",
                     F.unix_millis("obsTs").alias("obs_ms"),
                     F.unix_millis("window_start").alias("window_start_ms"),
                     F.unix_millis("window_end").alias("window_end_ms"))


def q_parse_feed(spark, sf_dir):
    p = _parsed(spark, sf_dir)
    return p.select("userId", "userEmail", "deviceId", "sensorType",
                    F.col("obsMs").alias("obs_ms"),
                    F.array_join(F.json_object_keys("sensorValue"), ",").alias("sv_keys"))


def q_bad_records(spark, sf_dir):
    return bad_records(events_feed(spark, sf_dir)).select("value")


def q_gps_readings(spark, sf_dir):
    g = gps_readings(_parsed(spark, sf_dir))
    return g.select("userId", "userEmail", "deviceId", "sensorType", "lat", "lng",
                    F.unix_millis("obsTs").alias("obs_ms"))


def q_gps_readings_by_device(spark, sf_dir):
    g = gps_readings(_parsed(spark, sf_dir), by_device=True)
    return g.select("deviceId", "sensorType", "lat", "lng", F.unix_millis("obsTs").alias("obs_ms"))


def q_weather_readings(spark, sf_dir):
    w = weather_readings(_parsed(spark, sf_dir), ingest="timestamp")
    return w.select("userId", "userEmail", "deviceId", "sensorType", "temp", "humd", "CO2", "CO",
                    "hour", F.unix_millis("obsTs").alias("obs_ms"),
                    F.unix_millis("ingestTs").alias("ingest_ms"))


def q_multi_readings(spark, sf_dir):
    m = multi_readings(_parsed(spark, sf_dir))
    return m.select("userId", "userEmail", "deviceId", "sensorType", "name1", "value1", "name2",
                    "value2", "name3", "value3", F.unix_millis("obsTs").alias("obs_ms"))


def q_scalar_readings(spark, sf_dir):
    s = scalar_readings(_parsed(spark, sf_dir))
    return s.select("deviceId", "sensorType", "value", F.unix_millis("obsTs").alias("obs_ms"))


def q_tumbling_join_weather(spark, sf_dir):
    g, w = _gps_weather(spark, sf_dir)
    return out_weather_pairs(tumbling_join(w, g, DAY))


def q_tumbling_join_multi(spark, sf_dir):
    g, m = _gps_multi(spark, sf_dir)
    return out_multi_pairs(tumbling_join(m, g, DAY))


def q_tumbling_join_scalar(spark, sf_dir):
    p = _staged(spark, sf_dir, GPS, PROXIMITY)
    return out_scalar_pairs(tumbling_join(scalar_readings(p), gps_readings(p, by_device=True), DAY))


def q_sliding_join_weather(spark, sf_dir):
    g, w = _gps_weather(spark, sf_dir)
    return out_weather_pairs(sliding_join(w, g, QUARTER_DAY))


def q_sliding_join_panes(spark, sf_dir):
    """Twelve windows a reading: joined by panes, each reading kept once."""
    g, w = _gps_weather(spark, sf_dir)
    return out_weather_pairs(sliding_join(w, g, QUARTER_DAY, HALF_HOUR))


def out_by_device(df: DataFrame) -> DataFrame:
    return df.select("deviceId", "n_pairs", "value_sum", "value_min", "value_max", "lat_min", "lat_max", "lng_min",
                     "lng_max", F.unix_millis("first_obs").alias("first_obs_ms"), F.unix_millis("last_obs").alias("last_obs_ms"),
                     F.unix_millis("window_start").alias("window_start_ms"), F.unix_millis("window_end").alias("window_end_ms"))


def q_joined_by_device(spark, sf_dir):
    """Proximity x GPS pairs of quarter days, grouped by trimmed device and day."""
    p = _staged(spark, sf_dir, GPS, PROXIMITY)
    pairs = tumbling_join(scalar_readings(p), gps_readings(p, by_device=True), QUARTER_DAY, keep_window=True)
    return out_by_device(joined_by_device(pairs, DAY))


def q_session_join_weather(spark, sf_dir):
    g, w = _gps_weather(spark, sf_dir)
    return out_weather_pairs(session_join(w, g, QUARTER_DAY))


def q_window_join_dispatch(spark, sf_dir):
    g, w = _gps_weather(spark, sf_dir)
    parts = [out_weather_pairs(window_join(k, w, g, QUARTER_DAY)).select(F.lit(k).alias("kind"), "*")
             for k in ("Tumble", "Sliding", "Session")]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def _alerts(spark, sf_dir, strict):
    w = weather_readings(_parsed(spark, sf_dir), ingest="timestamp")
    return w.select("userId", "deviceId", F.unix_millis("obsTs").alias("obs_ms"), "temp", "humd",
                    "CO2", "CO", fire_alert(strict=strict).alias("fire_alert"))


def q_fire_alert(spark, sf_dir):
    return _alerts(spark, sf_dir, False)


def q_fire_alert_strict(spark, sf_dir):
    return _alerts(spark, sf_dir, True)


def q_region_lookup(spark, sf_dir):
    g = gps_readings(_parsed(spark, sf_dir))
    r = region_lookup(g, regions_from_nation(spark, sf_dir))
    return r.select("userId", "deviceId", F.unix_millis("obsTs").alias("obs_ms"), "lat", "lng",
                    "region")


def out_region(df: DataFrame) -> DataFrame:
    return df.select("userId", "deviceId", F.unix_millis("obsTs").alias("obs_ms"), "lat", "lng", "region")


def q_region_polygons(spark, sf_dir):
    """Regions with outlines and holes."""
    return out_region(polygon_lookup(gps_readings(_parsed(spark, sf_dir)), polygons_from_nation(spark, sf_dir)))


def q_region_versions(spark, sf_dir):
    """Regions as they were at the time of each reading."""
    changing = polygons_from_nation(spark, sf_dir, changes=True)
    return out_region(polygon_lookup(gps_readings(_parsed(spark, sf_dir)), changing, at="obsTs"))


WEATHER_MSG_SCHEMA = (
    "WindowConfig struct<JobName: string, WindowType: string, WindowSize: string>, "
    "userAccount struct<userId: string, userEmail: string>, deviceId string, sensorType string, "
    "sensorValue struct<attr_lat: float, attr_lng: float, Hour: int, Temperature: int, "
    "Humidity: int, CO2: int, CO: int, regoin: string, FireAlert: string>, "
    "Time struct<ObservationTimestamp: bigint, IngestTime: bigint, ProcessedTimestamp: bigint>")


def q_weather_message(spark, sf_dir):
    g, w = _gps_weather(spark, sf_dir)
    g = region_lookup(g, regions_from_nation(spark, sf_dir))
    msgs = weather_message(tumbling_join(w, g, DAY), job_name="SensorJoin",
                           window_type="Tumble", window_size=DAY)
    m = msgs.select(F.from_json("value", WEATHER_MSG_SCHEMA).alias("m"))
    return m.select("m.WindowConfig.*", "m.userAccount.*", "m.deviceId", "m.sensorType",
                    "m.sensorValue.*", "m.Time.ObservationTimestamp", "m.Time.IngestTime")


def q_multi_message(spark, sf_dir):
    g, mr = _gps_multi(spark, sf_dir)
    g = region_lookup(g, regions_from_nation(spark, sf_dir))
    msgs = multi_message(tumbling_join(mr, g, DAY))
    schema = ("userAccount struct<userId: string, userEmail: string>, deviceId string, "
              "sensorType string, sensorValue struct<x: float, y: float, z: float, "
              "attr_lat: float, attr_lng: float, regoin: string>, observationTimestamp bigint")
    m = msgs.select(F.from_json("value", schema).alias("m"))
    return m.select("m.userAccount.*", "m.deviceId", "m.sensorType", "m.sensorValue.*",
                    "m.observationTimestamp")


def q_gps_region_message(spark, sf_dir):
    g = region_lookup(gps_readings(_parsed(spark, sf_dir)), regions_from_nation(spark, sf_dir))
    schema = ("userAccount struct<userId: string, userEmail: string>, deviceId string, "
              "sensorType string, sensorValue struct<attr_lat: float, attr_lng: float, "
              "regoin: string>")
    m = gps_region_message(g).select(F.from_json("value", schema).alias("m"))
    return m.select("m.userAccount.*", "m.deviceId", "m.sensorType", "m.sensorValue.*")


BATCH_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "parse_feed": q_parse_feed,
    "bad_records": q_bad_records,
    "gps_readings": q_gps_readings,
    "gps_readings_by_device": q_gps_readings_by_device,
    "weather_readings": q_weather_readings,
    "multi_readings": q_multi_readings,
    "scalar_readings": q_scalar_readings,
    "tumbling_join_weather": q_tumbling_join_weather,
    "tumbling_join_multi": q_tumbling_join_multi,
    "tumbling_join_scalar": q_tumbling_join_scalar,
    "sliding_join_weather": q_sliding_join_weather,
    "sliding_join_panes": q_sliding_join_panes,
    "joined_by_device": q_joined_by_device,
    "session_join_weather": q_session_join_weather,
    "window_join_dispatch": q_window_join_dispatch,
    "fire_alert": q_fire_alert,
    "fire_alert_strict": q_fire_alert_strict,
    "region_lookup": q_region_lookup,
    "region_polygons": q_region_polygons,
    "region_versions": q_region_versions,
    "weather_message": q_weather_message,
    "multi_message": q_multi_message,
    "gps_region_message": q_gps_region_message,
}
