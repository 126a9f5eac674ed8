"""Outgoing JSON messages (one ``value`` string per joined pair / reading).

Field names are the wire names, including the ``regoin`` spelling and the
string-typed ``WindowSize``; times are epoch milliseconds.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tandem.functions.alerts import fire_alert

_JSON_OPTS = {"ignoreNullFields": "false"}


def _region(df: DataFrame) -> Column:
    return F.coalesce(F.col("region"), F.lit("")) if "region" in df.columns else F.lit("")


def _now_ms(processed) -> Column:
    return F.unix_millis(F.current_timestamp()) if processed is None else F.lit(processed).cast("bigint")


def weather_value(pairs: DataFrame, *, job_name: str, window_type: str, window_size,
                  strict_alert: bool = False, processed_ms: int | None = None) -> Column:
    msg = F.struct(
        F.struct(F.lit(job_name).alias("JobName"), F.lit(window_type).alias("WindowType"),
                 F.lit(str(window_size)).alias("WindowSize")).alias("WindowConfig"),
        F.struct("userId", "userEmail").alias("userAccount"),
        F.col("deviceId"), F.col("sensorType"),
        F.struct(F.col("lat").alias("attr_lat"), F.col("lng").alias("attr_lng"),
                 F.col("hour").alias("Hour"), F.col("temp").alias("Temperature"),
                 F.col("humd").alias("Humidity"), F.col("CO2"), F.col("CO"),
                 _region(pairs).alias("regoin"),
                 fire_alert(strict=strict_alert).alias("FireAlert")).alias("sensorValue"),
        F.struct(F.unix_millis("obsTs").alias("ObservationTimestamp"),
                 F.unix_millis("ingestTs").alias("IngestTime"),
                 _now_ms(processed_ms).alias("ProcessedTimestamp")).alias("Time"),
    )
    return F.to_json(msg, _JSON_OPTS)


def weather_message(pairs: DataFrame, **params) -> DataFrame:
    """Weather x GPS pair -> message with WindowConfig, userAccount, deviceId,
    sensorType, sensorValue (position, five readings, region, FireAlert) and
    Time (observation, ingest, processed).  Parameters: see ``weather_value``."""
    return pairs.select(weather_value(pairs, **params).alias("value"))


def _sensor_value_object(pairs: DataFrame, quoted_keys: bool) -> Column:
    """JSON object: the three sensor members, then attr_lat, attr_lng, regoin.
    A repeated name keeps its first place and takes the last value."""
    def key(c):
        return F.concat(F.lit('"'), F.col(c), F.lit('"')) if quoted_keys else F.col(c)
    entries = F.array(
        F.struct(key("name1").alias("k"), F.col("value1").cast("variant").alias("v")),
        F.struct(key("name2").alias("k"), F.col("value2").cast("variant").alias("v")),
        F.struct(key("name3").alias("k"), F.col("value3").cast("variant").alias("v")),
        F.struct(F.lit("attr_lat").alias("k"), F.col("lat").cast("variant").alias("v")),
        F.struct(F.lit("attr_lng").alias("k"), F.col("lng").cast("variant").alias("v")),
        F.struct(F.lit("regoin").alias("k"), _region(pairs).cast("variant").alias("v")),
    )
    keys = F.array_distinct(F.transform(entries, lambda e: e["k"]))
    vals = F.transform(keys, lambda k: F.element_at(F.filter(entries, lambda e: e["k"] == k), -1)["v"])
    return F.map_from_arrays(keys, vals)


def multi_value(pairs: DataFrame, *, quoted_keys: bool = False) -> Column:
    msg = F.struct(
        F.struct("userId", "userEmail").alias("userAccount"),
        F.col("deviceId"), F.col("sensorType"),
        _sensor_value_object(pairs, quoted_keys).alias("sensorValue"),
        F.unix_millis("obsTs").alias("observationTimestamp"),
    )
    return F.to_json(msg, _JSON_OPTS)


def multi_message(pairs: DataFrame, *, quoted_keys: bool = False) -> DataFrame:
    """Multi-value x GPS pair -> {userAccount, deviceId, sensorType,
    sensorValue{<name1>, <name2>, <name3>, attr_lat, attr_lng, regoin},
    observationTimestamp}.  ``quoted_keys=True`` writes the sensor member
    names wrapped in quote marks, as the original serializer did."""
    return pairs.select(multi_value(pairs, quoted_keys=quoted_keys).alias("value"))


def gps_region_value(gps: DataFrame, *, processed_ms: int | None = None) -> Column:
    msg = F.struct(
        F.struct("userId", "userEmail").alias("userAccount"),
        F.col("deviceId"),
        F.concat(F.col("sensorType"), F.lit("_withRegion")).alias("sensorType"),
        F.struct(F.col("lat").alias("attr_lat"), F.col("lng").alias("attr_lng"),
                 _region(gps).alias("regoin")).alias("sensorValue"),
        _now_ms(processed_ms).alias("observationTimestamp"),
    )
    return F.to_json(msg, _JSON_OPTS)


def gps_region_message(gps: DataFrame, *, processed_ms: int | None = None) -> DataFrame:
    """GPS reading (with ``region``) -> {userAccount, deviceId,
    sensorType + '_withRegion', sensorValue{attr_lat, attr_lng, regoin},
    observationTimestamp = time of processing}."""
    return gps.select(gps_region_value(gps, processed_ms=processed_ms).alias("value"))
