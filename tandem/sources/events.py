"""A sensor feed derived from the ``events`` table (test and benchmark input).

Every row of ``events`` becomes one JSON message; the work grows with the
table.  The rules are plain integer arithmetic so that a SQL engine can
derive the same readings without going through JSON.

Fixed values (they must equal the oracle's):
  event_type -> sensorType: view -> TYPE_GPS; purchase, signup -> TYPE_WEATHER;
  error -> TYPE_ACCELEROMETER; click -> TYPE_PROXIMITY.
  cents = round(value * 100); k = first integer in props.
  userId 'u' || user_id (non-GPS rows with event_id % 7 = 0 get one trailing
  space); userEmail 'u' || user_id || '@example.org'; deviceId 'd' || user_id % 40.
  GPS: attr_lat (53000 + 5k) / 1000, attr_lng (-9500 + 10 (event_id % 50)) / 1000.
  weather: temp 15 + cents % 30; humd 5 + (cents div 7) % 60;
  CO2 100 + 70 a^2 with a = (cents div 11) % 10; CO b^2 with b = (cents div 13) % 8;
  hour = hour(ts).
  accelerometer: x = cents / 128, y = k / 8, z = -(cents % 1000) / 16.
  proximity: cents % 10.
  Spoiled lines: event_id % 97 = 0 -> cut after deviceId (not JSON);
  otherwise event_id % 89 = 0 -> no userAccount member.
Regions: 25 boxes from ``nation`` (n = n_nationkey), lat from
  (53000 + 80 (n % 5)) / 1000, lng from (-9500 + 80 (n div 5)) / 1000, both
  0.080 wide, name n_name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

TYPE_BY_EVENT = {
    "view": "TYPE_GPS",
    "purchase": "TYPE_WEATHER",
    "signup": "TYPE_WEATHER",
    "error": "TYPE_ACCELEROMETER",
    "click": "TYPE_PROXIMITY",
}


def _dbl_text(numerator: Column, denominator: int) -> Column:
    return (numerator.cast("double") / F.lit(float(denominator))).cast("string")


def spread_small_input(df: DataFrame, min_partitions: int | None = None) -> DataFrame:
    """Round-robin a source that has fewer splits than the cluster has cores
    (e.g. one small file), so that decoding runs on every core.  A large
    input already has many more splits and is left as it is - no shuffle."""
    try:
        want = min_partitions or df.sparkSession.sparkContext.defaultParallelism
        have = df.rdd.getNumPartitions()
    except Exception:  # e.g. a Spark Connect session has no RDD view
        return df
    return df.repartition(want) if have < want else df


def events_feed(spark: SparkSession, sf_dir: str, min_partitions: int | None = None) -> DataFrame:
    """``value string`` (one JSON message) + ``timestamp`` (the reading's time,
    standing in for a broker's ingest time), one row per event."""
    ev = spread_small_input(spark.read.parquet(f"{sf_dir}/events.parquet").select(
        "event_id", "ts", "user_id", "event_type", "value", "props"), min_partitions)
    stype = F.col("event_type")
    mapping = None
    for ev_name, t in TYPE_BY_EVENT.items():
        mapping = (F.when(stype == ev_name, t) if mapping is None
                   else mapping.when(stype == ev_name, t))
    micros = F.expr("timestampdiff(MICROSECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', ts)")
    d = ev.select(
        "event_id", "ts", "user_id",
        mapping.alias("stype"),
        F.round(F.col("value") * 100).cast("bigint").alias("cents"),
        F.regexp_extract("props", r"([0-9]+)", 1).cast("int").alias("k"),
        F.floor(micros / 1000).cast("bigint").alias("obs_ms"),
    )
    uid = F.concat(F.lit("u"), F.col("user_id").cast("string"),
                   F.when((F.col("stype") != "TYPE_GPS") & (F.col("event_id") % 7 == 0), " ")
                   .otherwise(""))
    email = F.concat(F.lit("u"), F.col("user_id").cast("string"), F.lit("@example.org"))
    dev = F.concat(F.lit("d"), (F.col("user_id") % 40).cast("string"))
    c, k = F.col("cents"), F.col("k")
    a = F.expr("(cents div 11) % 10")
    b = F.expr("(cents div 13) % 8")
    gps_sv = F.concat(F.lit('{"attr_lat":'), _dbl_text(53000 + k * 5, 1000),
                      F.lit(',"attr_lng":'), _dbl_text(-9500 + (F.col("event_id") % 50) * 10, 1000),
                      F.lit("}"))
    weather_sv = F.concat(
        F.lit('{"temp":'), (15 + c % 30).cast("string"),
        F.lit(',"humd":'), (5 + F.expr("(cents div 7) % 60")).cast("string"),
        F.lit(',"CO2":'), (100 + a * a * 70).cast("string"),
        F.lit(',"CO":'), (b * b).cast("string"),
        F.lit(',"hour":'), F.hour("ts").cast("string"), F.lit("}"))
    accel_sv = F.concat(F.lit('{"x":'), _dbl_text(c, 128), F.lit(',"y":'), _dbl_text(k, 8),
                        F.lit(',"z":'), _dbl_text(-(c % 1000), 16), F.lit("}"))
    prox_sv = (c % 10).cast("string")
    st = F.col("stype")
    sv = (F.when(st == "TYPE_GPS", gps_sv).when(st == "TYPE_WEATHER", weather_sv)
          .when(st == "TYPE_ACCELEROMETER", accel_sv).when(st == "TYPE_PROXIMITY", prox_sv))
    account = F.concat(F.lit('"userAccount":{"userId":"'), uid, F.lit('","userEmail":"'),
                       email, F.lit('"},'))
    head = F.concat(F.lit("{"),
                    F.when(F.col("event_id") % 89 == 0, F.lit("")).otherwise(account),
                    F.lit('"deviceId":"'), dev, F.lit('"'))
    full = F.concat(head, F.lit(',"sensorType":"'), st, F.lit('","sensorValue":'), sv,
                    F.lit(',"observationTimestamp":'), F.col("obs_ms").cast("string"), F.lit("}"))
    truncated = F.concat(F.lit("{"), account, F.lit('"deviceId":"'), dev, F.lit('"'))
    value = F.when(F.col("event_id") % 97 == 0, truncated).otherwise(full)
    return d.select(value.alias("value"), F.timestamp_millis("obs_ms").alias("timestamp"))


def regions_from_nation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Region boxes ``region, min_lat, max_lat, min_lng, max_lng`` (half-open)."""
    n = spark.read.parquet(f"{sf_dir}/nation.parquet").select("n_nationkey", "n_name")
    key = F.col("n_nationkey")
    lat0 = 53000 + (key % 5) * 80
    lng0 = -9500 + F.expr("n_nationkey div 5") * 80
    return n.select(
        F.col("n_name").alias("region"),
        (lat0.cast("double") / 1000).alias("min_lat"),
        ((lat0 + 80).cast("double") / 1000).alias("max_lat"),
        (lng0.cast("double") / 1000).alias("min_lng"),
        ((lng0 + 80).cast("double") / 1000).alias("max_lng"),
    )


# Corners of a region's outline and of the hole in it, in thousandths of a degree
# (lat, lng) from its box's lower corner; nations are 1, 2 or 3 times this size.
OUTLINE = (((0, 0), (0, 120), (50, 120), (30, 40), (100, 30), (60, -20)), ((10, 10), (20, 30), (25, 10)))
CHANGE_MS = 1_705_276_800_000  # 2024-01-15: regions of even nations move


def polygons_from_nation(spark: SparkSession, sf_dir: str, changes: bool = False) -> DataFrame:
    """Regions as outlines with a hole: ``region, rings, valid_from, valid_to``.
    With ``changes``, an even nation's lies 40 thousandths further north from
    ``CHANGE_MS`` on (two versions)."""
    n = spark.read.parquet(f"{sf_dir}/nation.parquet").select("n_nationkey", "n_name")
    key, move = F.col("n_nationkey"), F.col("move")
    never, change = F.lit(None).cast("timestamp"), F.timestamp_millis(F.lit(CHANGE_MS))

    def version(move: int, start: Column, end: Column) -> Column:
        return F.struct(F.lit(move).alias("move"), start.alias("valid_from"), end.alias("valid_to"))

    always = F.array(version(0, never, never))
    versions = F.when(key % 2 == 0, F.array(version(0, never, change), version(40, change, never))).otherwise(always)
    n = n.select("*", F.inline(versions if changes else always))
    lat0, lng0 = 53000 + (key % 5) * 80 + move, -9500 + F.expr("n_nationkey div 5") * 80
    rings = F.array(*[F.array(*[F.struct(((lat0 + dy * (1 + key % 3)).cast("double") / 1000).alias("lat"),
                                         ((lng0 + dx * (1 + key % 3)).cast("double") / 1000).alias("lng"))
                                for dy, dx in ring]) for ring in OUTLINE])
    return n.select(F.col("n_name").alias("region"), rings.alias("rings"), "valid_from", "valid_to")
