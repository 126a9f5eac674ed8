"""Streaming forms of the joins, replayed over the events-derived feed.

The feed is staged as parquet files, read with ``readStream`` and run to
completion with an ``availableNow`` trigger; the sink table is returned as
a batch DataFrame so it can be checked against the same SQL as the batch
joins.
"""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tandem.operators.grouping import joined_by_device
from tandem.operators.intake import clean_feed, dead_letters, good_messages, run_intake
from tandem.operators.parse import GPS, PROXIMITY, WEATHER, gps_readings, parse_feed, scalar_readings, weather_readings
from tandem.operators.polygons import RegionTable, start_region_stream
from tandem.operators.windows import session_join, sliding_join, tumbling_join
from tandem.plans.catalog import DAY, QUARTER_DAY, out_by_device, out_region, out_scalar_pairs, out_weather_pairs
from tandem.plans.pipeline import JobConfig, build_pipeline, decoded_stream, run_pipeline, start_decoder
from tandem.sources.events import CHANGE_MS, events_feed, polygons_from_nation, regions_from_nation
from tandem.sources.sinks import read_csv, write_csv
from tandem.session import scratch_path
from tandem.streaming.replay import FEED_SCHEMA, run_available_now, stage_feed, stream_feed
from tandem.streaming.shared import BUCKETS, late_readings, run_shared_pipeline, shared_pairs

# A reading far after all data, on both sides, closes the last open session
# windows (a session is emitted once the watermark passes its end).
FLUSH_USER = "__flush__"
FLUSH_MS = 4_102_444_800_000  # 2100-01-01


def flush_lines(spark: SparkSession) -> DataFrame:
    acct = f'"userAccount":{{"userId":"{FLUSH_USER}","userEmail":"-"}},"deviceId":"-"'
    gps = (f'{{{acct},"sensorType":"TYPE_GPS","sensorValue":{{"attr_lat":0,"attr_lng":0}},'
           f'"observationTimestamp":{FLUSH_MS}}}')
    wea = (f'{{{acct},"sensorType":"TYPE_WEATHER","sensorValue":{{"temp":0,"humd":0,"CO2":0,'
           f'"CO":0,"hour":0}},"observationTimestamp":{FLUSH_MS}}}')
    prox = f'{{{acct},"sensorType":"TYPE_PROXIMITY","sensorValue":0,"observationTimestamp":{FLUSH_MS}}}'
    return spark.createDataFrame([(gps,), (wea,), (prox,)], "value string").select(
        "value", F.timestamp_millis(F.lit(FLUSH_MS)).alias("timestamp"))


def _decoded_once(spark: SparkSession, source: DataFrame, types: tuple) -> DataFrame:
    """The messages of ``types`` of a stream, decoded once by a query of its own
    and written by sensor type: each side of a join reads its type's files only,
    instead of decoding the whole feed again."""
    path, ckpt = scratch_path(spark, "decoded"), scratch_path(spark, "decoder-ckpt")
    q = start_decoder(source, path, ckpt, {"availableNow": True}, types)
    q.awaitTermination()
    if q.exception() is not None:
        raise q.exception()
    return decoded_stream(spark, path, source)


def _stream_parsed(spark: SparkSession, sf_dir: str, flush: bool = False, sensor: str = WEATHER) -> DataFrame:
    feed = events_feed(spark, sf_dir)
    if flush:
        feed = feed.unionByName(flush_lines(spark))
    return _decoded_once(spark, stream_feed(spark, stage_feed(feed)), (GPS, sensor))


def _sink(df: DataFrame) -> DataFrame:
    return df.sparkSession.read.parquet(run_available_now(df))


def q_stream_tumbling_join(spark, sf_dir):
    p = _stream_parsed(spark, sf_dir)
    j = tumbling_join(weather_readings(p, ingest="timestamp"), gps_readings(p), DAY)
    return _sink(out_weather_pairs(j))


def q_stream_tumbling_join_scalar(spark, sf_dir):
    p = _stream_parsed(spark, sf_dir, sensor=PROXIMITY)
    j = tumbling_join(scalar_readings(p), gps_readings(p, by_device=True), DAY, dense=True)
    return _sink(out_scalar_pairs(j))


def q_stream_sliding_join(spark, sf_dir):
    p = _stream_parsed(spark, sf_dir)
    j = sliding_join(weather_readings(p, ingest="timestamp"), gps_readings(p), QUARTER_DAY)
    return _sink(out_weather_pairs(j))


def q_stream_session_join(spark, sf_dir):
    """The session join switches the session to the RocksDB state store for
    the queries it starts; this replay puts the caller's settings back
    afterwards, so later queries in the same session are unaffected."""
    from tandem.streaming.sessions import CHANGELOG_KEY, PROVIDER_KEY
    before = {k: spark.conf.get(k, None) for k in (PROVIDER_KEY, CHANGELOG_KEY)}
    try:
        p = _stream_parsed(spark, sf_dir, flush=True)
        j = session_join(weather_readings(p, ingest="timestamp"), gps_readings(p), QUARTER_DAY,
                         buckets=BUCKETS)
        return _sink(out_weather_pairs(j)).where(F.col("userId") != FLUSH_USER)
    finally:
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def q_stream_late_rows(spark, sf_dir):
    """Two replays into one query: first the later half of the feed, then the
    earlier half.  The earlier rows are behind the watermark and dropped, so
    only pairs of the later half come out (late data is not joined)."""
    feed = events_feed(spark, sf_dir)
    ms = F.unix_millis("timestamp")
    cut = feed.agg(F.expr("(min(unix_millis(timestamp)) + max(unix_millis(timestamp))) div 2")
                   .alias("m")).first()["m"]
    path = scratch_path(spark, "late-feed")
    stage_feed(feed.where(ms >= cut), path + "/part=1")
    src = spark.readStream.schema("value string, timestamp timestamp").parquet(path + "/*")
    p = parse_feed(src)
    j = out_weather_pairs(tumbling_join(weather_readings(p, ingest="timestamp"), gps_readings(p), DAY))
    out, ckpt = scratch_path(spark, "late-sink"), scratch_path(spark, "late-ckpt")
    run_available_now(j, out, ckpt)
    stage_feed(feed.where(ms < cut), path + "/part=2")
    run_available_now(j, out, ckpt)
    return spark.read.parquet(out)


def q_stream_joined_by_device(spark, sf_dir):
    """Two stateful operators: the join's windows, then days by device."""
    p = _stream_parsed(spark, sf_dir, flush=True, sensor=PROXIMITY)
    pairs = tumbling_join(scalar_readings(p), gps_readings(p, by_device=True), QUARTER_DAY, keep_window=True)
    return _sink(out_by_device(joined_by_device(pairs, DAY))).where(F.col("deviceId") != "-")


@contextmanager
def _state_settings(spark: SparkSession):
    """Puts the caller's state store settings back after a replay that switches them."""
    from tandem.streaming.sessions import CHANGELOG_KEY, PROVIDER_KEY
    before = {k: spark.conf.get(k, None) for k in (PROVIDER_KEY, CHANGELOG_KEY)}
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def q_stream_shared_job_messages(spark, sf_dir):
    """The whole job as one query: the feed read once, one GPS buffer for all sensors."""
    with _state_settings(spark):
        feed = events_feed(spark, sf_dir).unionByName(flush_lines(spark))
        out = scratch_path(spark, "shared-out")
        run_shared_pipeline(spark, JOB_CFG, source=stream_feed(spark, stage_feed(feed)),
                            regions=regions_from_nation(spark, sf_dir), checkpoint_dir=scratch_path(spark, "shared-ckpt"),
                            sink=lambda msgs, name, ckpt: run_available_now(msgs, out, ckpt))
        return parse_messages(spark.read.parquet(out)).where(F.col("userId") != FLUSH_USER)


def q_stream_late_readings(spark, sf_dir):
    """The later half of the feed, then the earlier half: the readings that
    come out as late are those whose windows the watermark had passed."""
    with _state_settings(spark):
        feed = events_feed(spark, sf_dir)
        ms = F.unix_millis("timestamp")
        cut = feed.agg(F.expr("(min(unix_millis(timestamp)) + max(unix_millis(timestamp))) div 2").alias("m")).first()["m"]
        path = scratch_path(spark, "late-readings")
        out, ckpt = scratch_path(spark, "late-readings-out"), scratch_path(spark, "late-readings-ckpt")
        stage_feed(feed.where(ms >= cut), path + "/part=1")
        src = spark.readStream.schema("value string, timestamp timestamp").parquet(path + "/*")
        late = late_readings(shared_pairs(parse_feed(src), JOB_CFG, ingest="timestamp", buckets=BUCKETS))
        run_available_now(late, out, ckpt)
        stage_feed(feed.where(ms < cut), path + "/part=2")
        run_available_now(late, out, ckpt)
        return spark.read.parquet(out).select("userId", "deviceId", "sensorType", F.unix_millis("obsTs").alias("obs_ms"))


def _delivered_twice(spark, sf_dir) -> str:
    """The intake of the feed, each message of which comes twice, in two runs
    of one query."""
    feed = events_feed(spark, sf_dir)
    src, path, ckpt = (scratch_path(spark, f"intake-{x}") for x in ("in", "out", "ckpt"))
    for part in (1, 2):
        # the second delivery is the first one's messages as they were written
        feed = feed if part == 1 else spark.read.schema(FEED_SCHEMA).parquet(f"{src}/part=1")
        stage_feed(feed, f"{src}/part={part}")
        stream = spark.readStream.schema("value string, timestamp timestamp").parquet(src + "/*")
        # the replay goes through all of the feed's time at once
        q = run_intake(clean_feed(stream, "36500 days", also=("timestamp",)), path, ckpt, {"availableNow": True})
        q.awaitTermination()
        if q.exception() is not None:
            raise q.exception()
    return path


def q_stream_deduplicated_join(spark, sf_dir):
    """Each message delivered twice: the pairs are those of the feed."""
    p = _decoded_once(spark, good_messages(spark, _delivered_twice(spark, sf_dir)), (GPS, WEATHER))
    j = tumbling_join(weather_readings(p, ingest="timestamp"), gps_readings(p), DAY)
    return _sink(out_weather_pairs(j))


def q_stream_dead_letters(spark, sf_dir):
    """Bad messages of the feed, each once though delivered twice, with the reason."""
    return (dead_letters(spark, _delivered_twice(spark, sf_dir))
            .select(F.regexp_extract("value", '"deviceId":"([^"]*)"', 1).alias("deviceId"),
                    F.unix_millis("timestamp").alias("ms"), "reason"))


def q_stream_region_versions(spark, sf_dir):
    """GPS readings with the region of their time; the region table is changed
    between the halves of the feed, while the query runs."""
    feed = events_feed(spark, sf_dir)
    change = F.timestamp_millis(F.lit(CHANGE_MS))
    path, table, out = (scratch_path(spark, x) for x in ("feed", "regions", "region-readings"))
    polygons_from_nation(spark, sf_dir).write.parquet(table)
    stage_feed(feed.where(F.col("timestamp") < change), path)
    query = start_region_stream(gps_readings(parse_feed(stream_feed(spark, path))), RegionTable(spark, table), out,
                                scratch_path(spark, "region-ckpt"), trigger={"processingTime": "0 seconds"})
    try:
        query.processAllAvailable()
        polygons_from_nation(spark, sf_dir, changes=True).write.mode("overwrite").parquet(table)
        stage_feed(feed.where(~F.coalesce(F.col("timestamp") < change, F.lit(False))), path, mode="append")
        query.processAllAvailable()
    finally:
        query.stop()
    return out_region(spark.read.parquet(out))


def q_write_csv(spark, sf_dir):
    """Scalar x GPS pairs written as '|'-separated text and read back."""
    p = parse_feed(events_feed(spark, sf_dir))
    # all pairs of a device's day, many times the feed: alike lines next to each other, packed
    pairs = out_scalar_pairs(tumbling_join(scalar_readings(p), gps_readings(p, by_device=True), DAY, dense=True))
    path = scratch_path(spark, "csv")
    write_csv(pairs, path, compression="gzip")
    return read_csv(spark, path, pairs.schema)


# --- whole job -------------------------------------------------------------

JOB_CFG = JobConfig(window_size=DAY, window_type="Tumble", job_name="SensorJoin",
                         single_sensors=("TYPE_WEATHER",), multi_sensors=("TYPE_ACCELEROMETER",),
                         multi_window=f"{DAY} seconds", des_topic="joined",
                         gps_region_topic="gps-regions")

MESSAGE_FIELDS = ("userAccount struct<userId: string, userEmail: string>, deviceId string, "
                  "sensorType string, sensorValue struct<attr_lat: float, attr_lng: float, "
                  "regoin: string>, observationTimestamp bigint, "
                  "Time struct<ObservationTimestamp: bigint>")


def parse_messages(msgs: DataFrame) -> DataFrame:
    m = msgs.select(F.from_json("value", MESSAGE_FIELDS).alias("m"))
    return m.select("m.sensorType", "m.userAccount.userId", "m.userAccount.userEmail",
                    "m.deviceId", "m.sensorValue.attr_lat", "m.sensorValue.attr_lng",
                    "m.sensorValue.regoin",
                    # GPS-with-region messages carry the time of processing
                    F.when(F.col("m.sensorType").endswith("_withRegion"), F.lit(0).cast("bigint"))
                    .otherwise(F.coalesce("m.Time.ObservationTimestamp", "m.observationTimestamp"))
                    .alias("obs_ms"))


def q_job_messages(spark, sf_dir):
    msgs = build_pipeline(events_feed(spark, sf_dir), JOB_CFG,
                          regions=regions_from_nation(spark, sf_dir), ingest="timestamp")
    return parse_messages(msgs)


def q_stream_job_messages(spark, sf_dir):
    src = stream_feed(spark, stage_feed(events_feed(spark, sf_dir)))
    root = scratch_path(spark, "job-out")

    def sink(msgs, name, ckpt):
        return run_available_now(msgs, f"{root}/{name}", ckpt)

    run_pipeline(spark, JOB_CFG, decoded=_decoded_once(spark, src, JOB_CFG.sensor_types()), regions=regions_from_nation(spark, sf_dir),
                 sink=sink, checkpoint_dir=scratch_path(spark, "job-ckpt"))
    return parse_messages(spark.read.parquet(f"{root}/*"))


STREAM_QUERIES = {
    "stream_tumbling_join": q_stream_tumbling_join,
    "stream_tumbling_join_scalar": q_stream_tumbling_join_scalar,
    "stream_sliding_join": q_stream_sliding_join,
    "stream_session_join": q_stream_session_join,
    "stream_late_rows": q_stream_late_rows,
    "stream_late_readings": q_stream_late_readings,
    "stream_joined_by_device": q_stream_joined_by_device,
    "stream_deduplicated_join": q_stream_deduplicated_join,
    "stream_dead_letters": q_stream_dead_letters,
    "stream_shared_job_messages": q_stream_shared_job_messages,
    "stream_region_versions": q_stream_region_versions,
    "write_csv": q_write_csv,
    "job_messages": q_job_messages,
    "stream_job_messages": q_stream_job_messages,
}

# Streams check against the same SQL as the batch queries they replay.
STREAM_ORACLE_OF = {
    "stream_tumbling_join": "tumbling_join_weather",
    "stream_tumbling_join_scalar": "tumbling_join_scalar",
    "stream_sliding_join": "sliding_join_weather",
    "stream_deduplicated_join": "tumbling_join_weather",
    "stream_session_join": "session_join_weather",
    "write_csv": "tumbling_join_scalar",
    "stream_job_messages": "job_messages",
    "stream_shared_job_messages": "job_messages",
    "stream_joined_by_device": "joined_by_device",
    "stream_region_versions": "region_versions",
}
