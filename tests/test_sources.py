import os

import pytest

from tandem.plans.pipeline import JobConfig
from tandem.sources.feed import kafka_source_options, read_lines
from tandem.sources.sinks import kafka_sink_options, write_csv
from tandem.session import scratch_path


def test_kafka_option_maps():
    o = kafka_source_options("android-sensor", "localhost:9092", group_id="g2",
                             extra={"zookeeper.connect": "localhost:2181"})
    assert o == {"kafka.bootstrap.servers": "localhost:9092", "subscribe": "android-sensor",
                 "groupIdPrefix": "g2", "startingOffsets": "latest",
                 "kafka.zookeeper.connect": "localhost:2181"}
    assert "startingOffsets" not in kafka_source_options("t", "b", starting_offsets=None)
    assert kafka_sink_options("joinedstreams", "b") == {"kafka.bootstrap.servers": "b",
                                                        "topic": "joinedstreams"}


def test_job_config_validation():
    JobConfig(window_type="Session", window_size=2).validate()
    with pytest.raises(ValueError):
        JobConfig(window_type="Hop").validate()
    with pytest.raises(ValueError):
        JobConfig(window_type="Sliding", window_size=1).validate()


def test_csv_round_trip_and_lines(spark, tmp_path):
    df = spark.createDataFrame([("a|b", 1), ("c", 2)], "s string, n int")
    path = scratch_path(spark, "csv")
    write_csv(df, path)
    back = spark.read.schema(df.schema).option("sep", "|").csv(path)
    assert sorted(tuple(r) for r in back.collect()) == [("a|b", 1), ("c", 2)]
    p = tmp_path / "feed.txt"
    p.write_text('{"a":1}\n{"b":2}\n')
    assert read_lines(spark, str(p)).count() == 2


def test_pipeline_streams_per_sensor_and_gps_region(spark):
    from pyspark.sql import functions as F

    from tandem.plans.pipeline import sensor_streams
    from tandem.operators.parse import parse_feed
    from tests.helpers import EDGE_MS, feed, gps, msg, weather
    lines = [weather(EDGE_MS + 1000), gps(EDGE_MS + 2000),
             msg("TYPE_GRAVITY", {"gx": 1, "gy": 2, "gz": 3}, EDGE_MS + 3000)]
    cfg = JobConfig(window_size=5, window_type="Sliding", single_sensors=("TYPE_WEATHER",),
                    multi_sensors=("TYPE_GRAVITY",), gps_region_topic="android-sensor")
    regions = spark.createDataFrame([("R", 53.0, 54.0, -10.0, -9.0)],
                                    "region string, min_lat double, max_lat double, "
                                    "min_lng double, max_lng double")
    out = dict(sensor_streams(parse_feed(feed(spark, lines)), cfg, regions, "timestamp"))
    assert list(out) == ["TYPE_WEATHER", "TYPE_GRAVITY", "TYPE_GPS_withRegion"]
    assert out["TYPE_WEATHER"].count() == 2  # sliding 5/2: two shared windows
    assert out["TYPE_GRAVITY"].count() == 1
    reg = out["TYPE_GPS_withRegion"].select(F.get_json_object("value", "$.sensorValue.regoin")).first()[0]
    assert reg == "R"


def _to_file(path):
    """Appends lines to a folder, one file per worker process (pickled by value)."""
    def emit(line):
        import os
        with open(os.path.join(path, str(os.getpid())), "a") as f:
            f.write(line + "\n")
    return emit


def _lines(path):
    return sorted(x for p in os.listdir(path) for x in open(os.path.join(path, p)).read().splitlines())


def test_console_sink_prints_every_row(spark, tmp_path):
    """More rows than any table printer shows, in a batch and in one micro-batch."""
    from tandem.session import scratch_path
    from tandem.sources.sinks import write_console
    want = sorted('{"a":%d}' % i for i in range(50))
    df = spark.range(50).selectExpr("cast(id as int) a")
    for kind in ("batch", "stream"):
        out = tmp_path / kind
        out.mkdir()
        if kind == "batch":
            write_console(df, emit=_to_file(str(out)))
        else:
            path = scratch_path(spark, "console-in")
            df.coalesce(1).write.parquet(path)
            q = write_console(spark.readStream.schema("a int").parquet(path), emit=_to_file(str(out)))
            q.processAllAvailable()
            q.stop()
        assert _lines(out) == want


def test_csv_keeps_blanks_and_tells_empty_from_null(spark):
    from tandem.session import scratch_path
    from tandem.sources.sinks import read_csv, write_csv
    rows = [(1, " a "), (2, "b\tc "), (3, ""), (4, None), (5, 'q"|x')]
    df = spark.createDataFrame(rows, "i int, t string")
    path = scratch_path(spark, "csv-exact")
    write_csv(df, path)
    assert sorted(map(tuple, read_csv(spark, path, df.schema).collect())) == rows


def test_checkpoint_folder_is_required_off_local():
    from tandem.session import checkpoint_root, is_local

    class Conf(dict):
        def get(self, key, default=None):
            return dict.get(self, key, default)

    class Session:
        conf = Conf({"spark.master": "spark://host:7077"})

        class sparkContext:
            @staticmethod
            def getCheckpointDir():
                return None

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        checkpoint_root(Session())
    assert is_local("local[4]") and not is_local("local-cluster[2,1,1024]") and not is_local("yarn")


def test_junk_types_make_no_folder(spark):
    from tandem.operators.parse import gps_readings, parse_feed, stage_parsed
    from tandem.session import scratch_path
    from tests.helpers import EDGE_MS, feed, gps
    lines = [gps(EDGE_MS)] + [gps(EDGE_MS).replace("TYPE_GPS", f"JUNK_{i}") for i in range(50)]
    path = scratch_path(spark, "junk")
    staged = stage_parsed(parse_feed(feed(spark, lines)), path, types=("TYPE_GPS",))
    assert [x for x in os.listdir(path.replace("file:", "")) if "=" in x] == ["sensorType=TYPE_GPS"]
    assert gps_readings(staged).count() == 1


def test_job_options_reach_the_joins(spark):
    from tandem.operators.parse import parse_feed
    from tandem.plans.pipeline import JobConfig, pipeline_outputs, sensor_streams
    from tests.helpers import EDGE_MS, feed, gps, msg, weather
    lines = [gps(EDGE_MS + 1000), weather(EDGE_MS + 2000),
             msg("TYPE_ACCELEROMETER", {"x": 1.0, "y": 2.0, "z": 3.0}, EDGE_MS + 3000)]
    f = feed(spark, lines)
    base = dict(window_size=10, single_sensors=("TYPE_WEATHER",), multi_sensors=("TYPE_ACCELEROMETER",),
                des_topic="out", gps_region_topic="regions")
    plain = JobConfig(**base)
    salted = JobConfig(**base, salt=3, salt_keys=("u1",), delay="5 seconds", quoted_keys=True)
    a = {k: sorted(r[0] for r in v.collect()) for k, v in
         pipeline_outputs(f, plain, ingest="timestamp").items()}
    b = dict(sensor_streams(parse_feed(f), salted, None, "timestamp"))
    assert set(a) == {"out", "regions"} and len(a["out"]) == 2 and len(a["regions"]) == 1
    assert "_salt" in b["TYPE_WEATHER"]._jdf.queryExecution().analyzed().toString()
    quoted = b["TYPE_ACCELEROMETER"].collect()
    assert len(quoted) == 1 and quoted[0].value not in a["out"]
    with pytest.raises(ValueError):
        JobConfig(**base, salt=0).validate()


def test_streaming_text_source_and_csv_sink(spark):
    from pyspark.sql import functions as F

    from tandem.operators.parse import gps_readings, parse_feed
    from tests.helpers import EDGE_MS, gps
    folder = scratch_path(spark, "lines")
    spark.createDataFrame([(gps(EDGE_MS + i, user=f"u{i}"),) for i in range(5)], "value string") \
        .write.text(folder)
    src = read_lines(spark, folder, streaming=True, max_files_per_trigger=1)
    assert src.isStreaming
    g = gps_readings(parse_feed(src)).select("userId", F.unix_millis("obsTs").alias("ms"))
    out, ckpt = scratch_path(spark, "csv-out"), scratch_path(spark, "csv-ckpt")
    q = write_csv(g, out, checkpoint=ckpt, trigger={"availableNow": True})
    q.awaitTermination(300)
    back = spark.read.schema("userId string, ms long").option("sep", "|").csv(out)
    assert sorted((r.userId, r.ms) for r in back.collect()) == [(f"u{i}", EDGE_MS + i) for i in range(5)]


def test_job_config_from_original_parameters():
    cfg = JobConfig.from_params({
        "topic": "android-sensor", "bootstrap.servers": "localhost:9092",
        "zookeeper.connect": "localhost:2181", "group.id": "test-consumer-group2",
        "desTopic": "joinedstreams", "WindowSize": "2", "WindowType": "Tumble",
        "JobName": "J"})
    assert (cfg.topic, cfg.des_topic, cfg.window_size, cfg.window_type, cfg.group_id) == (
        "android-sensor", "joinedstreams", 2, "Tumble", "test-consumer-group2")
    assert cfg.kafka_extra == {"zookeeper.connect": "localhost:2181"}
    with pytest.raises(ValueError):
        JobConfig.from_params({"topic": "t", "bootstrap.servers": "b"})  # older argument line


def test_run_pipeline_session_stream(spark):
    from pyspark.sql import functions as F

    from tandem.plans.pipeline import run_pipeline
    from tandem.plans.streams import flush_lines
    from tandem.streaming.replay import run_available_now, stage_feed, stream_feed
    from tests.helpers import EDGE_MS, feed, gps, weather
    lines = [weather(EDGE_MS + 1000), gps(EDGE_MS + 3000), weather(EDGE_MS + 6000),
             gps(EDGE_MS + 60_000)]
    src = stream_feed(spark, stage_feed(feed(spark, lines).unionByName(flush_lines(spark))))
    out = scratch_path(spark, "job-session")
    cfg = JobConfig(window_size=5, window_type="Session", job_name="S")
    run_pipeline(spark, cfg, source=src, checkpoint_dir=scratch_path(spark, "job-ckpt"),
                 sink=lambda msgs, name, ckpt: run_available_now(msgs, f"{out}/{name}", ckpt))
    msgs = spark.read.parquet(f"{out}/*").select(
        F.get_json_object("value", "$.userAccount.userId").alias("u"),
        F.get_json_object("value", "$.WindowConfig.WindowType").alias("t"),
        F.get_json_object("value", "$.Time.ObservationTimestamp").cast("long").alias("ms"))
    rows = sorted((r.u, r.t, r.ms - EDGE_MS) for r in msgs.where(F.col("u") == "u1").collect())
    assert rows == [("u1", "Session", 1000), ("u1", "Session", 6000)]


def test_csv_packed(spark):
    """Packed part files hold the same rows; the query's pairs are written so."""
    import glob

    from tandem.plans import streams
    from tandem.session import scratch_path
    from tandem.sources.sinks import read_csv, write_csv
    df = spark.range(2000).selectExpr("id", "concat('d', id % 7) AS d", "CASE WHEN id % 5 = 0 THEN ' x ' WHEN id % 5 = 1 THEN '' END AS t")
    sizes = {}
    for how in ("none", "gzip"):
        path = scratch_path(spark, f"csv-{how}")
        write_csv(df, path, compression=how)
        assert sorted(map(repr, read_csv(spark, path, df.schema).collect())) == sorted(map(repr, df.collect()))
        sizes[how] = sum(os.path.getsize(f) for f in glob.glob(f"{path}/part-*"))
    assert sizes["gzip"] * 2 < sizes["none"]
    out = streams.q_write_csv(spark, "/root/testdata/sf0.001")
    assert out.inputFiles() and all(f.endswith(".csv.gz") for f in out.inputFiles())


def _one_device_day(spark, folder, n_gps, n_prox):
    """Events of one device's day: GPS positions and proximity readings."""
    from pyspark.sql import functions as F
    ev = spark.range(1, 400).where("id % 97 <> 0 AND id % 89 <> 0").limit(n_gps + n_prox).select(
        F.col("id").alias("event_id"), F.expr("timestampadd(SECOND, cast(id as int), TIMESTAMP_NTZ'2024-01-03 00:00:00')").alias("ts"),
        F.lit(5).cast("bigint").alias("user_id"), F.expr(f"CASE WHEN id <= {n_gps} THEN 'view' ELSE 'click' END").alias("event_type"),
        F.expr("(id * 7 % 100) / 100D").alias("value"), F.expr("concat('{\"k\": ', id * 13 % 100, '}')").alias("props"))
    ev.write.parquet(f"{folder}/events.parquet")
    return str(folder)


def test_csv_query_keeps_alike_lines_together(spark, tmp_path):
    """The pairs of a GPS reading stand next to each other, equal lines too: the
    packer, which sees some 400 lines at a time, finds them whatever a day's readings."""
    import glob
    import gzip

    from tandem.plans import streams
    from tandem.plans.catalog import q_tumbling_join_scalar
    d = _one_device_day(spark, tmp_path, 40, 120)
    out = streams.q_write_csv(spark, d)
    assert sorted(map(tuple, out.collect())) == sorted(map(tuple, q_tumbling_join_scalar(spark, d).collect()))
    folder = os.path.dirname(out.inputFiles()[0].removeprefix("file:"))
    lines = [x for f in glob.glob(f"{folder}/part-*") for x in gzip.open(f, "rt").read().splitlines()]
    assert len(lines) == out.count() >= 40 * 100
    runs = 1 + sum(a != b for a, b in zip(lines, lines[1:]))
    assert runs == len(set(lines)) and runs * 5 < len(lines)
