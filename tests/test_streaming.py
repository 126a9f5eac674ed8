"""Streams give the same pairs as batch; late rows are dropped."""

import pytest
from pyspark.sql import functions as F

from tandem.operators.parse import gps_readings, parse_feed, weather_readings
from tandem.operators.windows import session_join, sliding_join, tumbling_join
from tandem.plans.catalog import out_weather_pairs
from tandem.plans.streams import FLUSH_MS, FLUSH_USER, flush_lines
from tandem.session import scratch_path
from tandem.streaming.replay import run_available_now, stage_feed, stream_feed
from tests.helpers import EDGE_MS, feed, gps, weather

LINES = [weather(EDGE_MS + s * 1000, user=u) for s, u in
         [(1, "u1"), (3, "u1 "), (12, "u1"), (31, "u2"), (44, "u1")]] + \
        [gps(EDGE_MS + s * 1000, user=u) for s, u in
         [(2, "u1"), (6, "u1"), (15, "u1"), (33, "u2"), (47, "u1"), (70, "u1")]]


def _rows(df):
    return sorted(tuple(r) for r in out_weather_pairs(df).collect())


def _both(spark, join, *args, flush=False):
    f = feed(spark, LINES)
    p = parse_feed(f)
    batch = _rows(join(weather_readings(p, ingest="timestamp"), gps_readings(p), *args))
    if flush:
        f = f.unionByName(flush_lines(spark))
    sp = parse_feed(stream_feed(spark, stage_feed(f)))
    sj = out_weather_pairs(join(weather_readings(sp, ingest="timestamp"), gps_readings(sp), *args))
    out = spark.read.parquet(run_available_now(sj)).where(F.col("userId") != FLUSH_USER)
    return batch, sorted(tuple(r) for r in out.collect())


def test_stream_equals_batch_tumbling(spark):
    b, s = _both(spark, tumbling_join, 10)
    assert b == s and len(b) > 0


def test_stream_equals_batch_sliding(spark):
    b, s = _both(spark, sliding_join, 10)
    assert b == s and len(b) > 0


def test_stream_equals_batch_session(spark):
    b, s = _both(spark, session_join, 5, flush=True)
    assert b == s and len(b) > 0


def test_stream_session_salted_equals_batch(spark):
    b, s = _both(spark, lambda w, g, n: session_join(w, g, n, salt=3), 5, flush=True)
    assert b == s and len(b) > 0


def test_stream_session_salting_only_hot_keys(spark):
    b, s = _both(spark, lambda w, g, n: session_join(w, g, n, salt=3, salt_keys=["u1"]), 5,
                 flush=True)
    assert b == s and len(b) > 0


def test_stream_session_tiny_output_chunks(spark):
    b, s = _both(spark, lambda w, g, n: session_join(w, g, n, chunk_pairs=1), 5, flush=True)
    assert b == s and len(b) > 1


def test_late_row_dropped(spark):
    path = scratch_path(spark, "late")
    stage_feed(feed(spark, [weather(EDGE_MS + 100_000), gps(EDGE_MS + 101_000)]), path + "/p=1")
    src = spark.readStream.schema("value string, timestamp timestamp").parquet(path + "/*")
    p = parse_feed(src)
    j = tumbling_join(weather_readings(p, ingest="timestamp"), gps_readings(p), 10)
    out, ckpt = scratch_path(spark, "late-out"), scratch_path(spark, "late-ckpt")
    run_available_now(j, out, ckpt)
    # a pair far behind the watermark arrives in the next micro-batch
    stage_feed(feed(spark, [weather(EDGE_MS + 1000), gps(EDGE_MS + 2000)]), path + "/p=2")
    run_available_now(j, out, ckpt)
    starts = [r.s for r in spark.read.parquet(out).select(
        F.unix_millis("window_start").alias("s")).collect()]
    assert starts == [EDGE_MS + 100_000]


def test_stream_salted_equals_batch(spark):
    b, s = _both(spark, lambda w, g, n: tumbling_join(w, g, n, salt=3), 10)
    assert b == s and len(b) > 0


def test_stream_salting_only_hot_keys_fixed_windows(spark):
    b, s = _both(spark, lambda w, g, n: sliding_join(w, g, n, salt=3, salt_keys=["u1"]), 10)
    assert b == s and len(b) > 0


def test_late_rows_are_counted(spark):
    from tandem.streaming.replay import dropped_by_watermark
    path = scratch_path(spark, "late2")
    stage_feed(feed(spark, [weather(EDGE_MS + 100_000), gps(EDGE_MS + 101_000)]), path + "/p=1")
    src = spark.readStream.schema("value string, timestamp timestamp").parquet(path + "/*")
    p = parse_feed(src)
    j = tumbling_join(weather_readings(p, ingest="timestamp"), gps_readings(p), 10)
    out, ckpt = scratch_path(spark, "late2-out"), scratch_path(spark, "late2-ckpt")
    q = j.writeStream.format("parquet").option("path", out).option("checkpointLocation", ckpt)
    q.trigger(availableNow=True).start().awaitTermination()
    stage_feed(feed(spark, [weather(EDGE_MS + 1000), gps(EDGE_MS + 2000)]), path + "/p=2")
    q2 = q.trigger(availableNow=True).start()
    q2.awaitTermination()
    assert dropped_by_watermark(q2) == 2


def test_proximity_job_stream(spark):
    from tandem.plans.pipeline import JobConfig, run_proximity_job
    from tests.helpers import msg
    lines = [msg("TYPE_PROXIMITY", 4, EDGE_MS + 1000, device="d1 "), gps(EDGE_MS + 3000, device="d1"),
             msg("TYPE_PROXIMITY", 6, EDGE_MS + 12_000, device="d1"), gps(EDGE_MS + 25_000, device="d1")]
    src = stream_feed(spark, stage_feed(feed(spark, lines)))
    out = scratch_path(spark, "prox")
    run_proximity_job(spark, JobConfig(), source=src, checkpoint_dir=scratch_path(spark, "prox-ckpt"),
                      sink=lambda pairs, name, ckpt: run_available_now(pairs, out, ckpt))
    rows = spark.read.parquet(out).collect()
    assert [(r.deviceId, r.sensorType, r.value) for r in rows] == [("d1", "TYPE_GPS", 4)]


def test_staged_decoder_gives_same_messages(spark):
    from tandem.plans.pipeline import JobConfig, decoded_stream, run_pipeline, start_decoder
    from tests.helpers import msg
    lines = [weather(EDGE_MS + 1000, user="u1 "), gps(EDGE_MS + 2000),
             msg("TYPE_ACCELEROMETER", {"x": 1, "y": 2, "z": 3}, EDGE_MS + 3000), gps(EDGE_MS + 4000)]
    cfg = JobConfig(window_size=10, window_type="Tumble", multi_sensors=("TYPE_ACCELEROMETER",),
                    multi_window="10 seconds")
    results = []
    for staged in (False, True):
        src = stream_feed(spark, stage_feed(feed(spark, lines)))
        out = scratch_path(spark, "staged-out")
        decoded = None
        if staged:
            table = scratch_path(spark, "decoded")
            start_decoder(src, table, scratch_path(spark, "dec-ckpt"),
                          trigger={"availableNow": True}).awaitTermination()
            decoded = decoded_stream(spark, table, src)
        run_pipeline(spark, cfg, source=src, decoded=decoded,
                     checkpoint_dir=scratch_path(spark, "staged-ckpt"),
                     sink=lambda m, name, ckpt: run_available_now(m, f"{out}/{name}", ckpt))
        vals = spark.read.parquet(f"{out}/*").select(
            F.get_json_object("value", "$.sensorType").alias("t"),
            F.get_json_object("value", "$.sensorValue.attr_lng").alias("g")).collect()
        results.append(sorted(map(tuple, vals)))
    assert results[0] == results[1] and len(results[0]) == 4


@pytest.mark.parametrize("salt", [1, 4])
def test_stream_session_across_micro_batches(spark, salt):
    """Sessions that grow and merge over many micro-batches give the batch
    result (a long watermark delay keeps every reading in time), also with
    each key spread over several salt groups."""
    from tandem.sources.events import events_feed
    f = events_feed(spark, "/root/testdata/sf0.001")
    p = parse_feed(f)
    batch = _rows(session_join(weather_readings(p, ingest="timestamp"), gps_readings(p), 3600))
    path = scratch_path(spark, "multi-batch")
    stage_feed(f.repartition(6), path + "/p=1")
    stage_feed(flush_lines(spark), path + "/p=2")  # newest file: read last
    src = (spark.readStream.schema("value string, timestamp timestamp")
           .option("maxFilesPerTrigger", "1").parquet(path + "/*"))
    sp = parse_feed(src)
    sj = session_join(weather_readings(sp, ingest="timestamp"), gps_readings(sp), 3600,
                      delay="3650 days", salt=salt)
    out = spark.read.parquet(run_available_now(out_weather_pairs(sj)))
    stream = sorted(tuple(r) for r in out.where(F.col("userId") != FLUSH_USER).collect())
    assert stream == batch and len(batch) > 0


def test_session_bounds_merge_like_brute_force():
    import random

    import numpy as np

    from tandem.streaming.sessions import merge_sessions, point_sessions
    rnd = random.Random(7)
    for _ in range(200):
        gap = rnd.randint(1, 5)
        t = [rnd.randint(0, 40) for _ in range(rnd.randint(1, 12))]
        side = [rnd.randint(0, 1) for _ in t]
        # brute force: sort, cut where the step exceeds the gap
        order = sorted(range(len(t)), key=lambda i: t[i])
        want, cur = [], None
        for i in order:
            if cur and t[i] - cur[4] <= gap:
                cur[1], cur[4] = t[i] + gap, t[i]
            else:
                cur = [t[i], t[i] + gap, 0, 0, t[i]]
                want.append(cur)
            cur[3 if side[i] else 2] += 1
        want = [w[:4] for w in want]
        # the same readings fed in two arbitrary halves, merged
        k = rnd.randint(0, len(t))
        a = point_sessions(np.array(t[:k] or [0]), np.array(side[:k] or [0]), gap) if k else []
        b = point_sessions(np.array(t[k:]), np.array(side[k:]), gap) if k < len(t) else []
        assert merge_sessions(a + b) == want


def test_stream_session_drops_late_rows(spark):
    path = scratch_path(spark, "late-sess")
    stage_feed(feed(spark, [weather(EDGE_MS + 100_000), gps(EDGE_MS + 101_000)]), path + "/p=1")
    src = spark.readStream.schema("value string, timestamp timestamp").parquet(path + "/*")
    p = parse_feed(src)
    j = session_join(weather_readings(p, ingest="timestamp"), gps_readings(p), 5)
    out, ckpt = scratch_path(spark, "late-sess-out"), scratch_path(spark, "late-sess-ckpt")
    run_available_now(j, out, ckpt)
    # readings whose session would have ended long before the watermark,
    # then the far-future pair that closes the open session
    late = feed(spark, [weather(EDGE_MS + 1000), gps(EDGE_MS + 2000)])
    stage_feed(late.unionByName(flush_lines(spark)), path + "/p=2")
    run_available_now(j, out, ckpt)
    rows = (spark.read.parquet(out).where(F.col("userId") != FLUSH_USER)
            .select(F.unix_millis("window_start").alias("s"), F.unix_millis("window_end").alias("e"))
            .collect())
    assert [(r.s, r.e) for r in rows] == [(EDGE_MS + 100_000, EDGE_MS + 106_000)]


def test_stream_session_closes_while_others_stay_open(spark):
    """The feed replayed in time slices, one per micro-batch: sessions close
    batch by batch while later ones of the same key are still open."""
    from tandem.sources.events import events_feed
    f = events_feed(spark, "/root/testdata/sf0.001")
    p = parse_feed(f)
    batch = _rows(session_join(weather_readings(p, ingest="timestamp"), gps_readings(p), 3600))
    path = scratch_path(spark, "slices")
    day = F.dayofmonth("timestamp")
    for i, (lo, hi) in enumerate([(1, 6), (6, 12), (12, 18), (18, 24), (24, 32)]):
        stage_feed(f.where((day >= lo) & (day < hi)).coalesce(1), f"{path}/p={i}")
    stage_feed(flush_lines(spark), f"{path}/p=9")
    src = (spark.readStream.schema("value string, timestamp timestamp")
           .option("maxFilesPerTrigger", "1").parquet(path + "/*"))
    sp = parse_feed(src)
    sj = session_join(weather_readings(sp, ingest="timestamp"), gps_readings(sp), 3600,
                      delay="1 day")
    out = spark.read.parquet(run_available_now(out_weather_pairs(sj)))
    stream = sorted(tuple(r) for r in out.where(F.col("userId") != FLUSH_USER).collect())
    assert stream == batch and len(batch) > 0


def test_stream_session_resumes_from_checkpoint(spark):
    """Stop after part of the feed, start again on the same checkpoint:
    open sessions, their readings and timers come back from state."""
    from tandem.sources.events import events_feed
    f = events_feed(spark, "/root/testdata/sf0.001")
    p = parse_feed(f)
    batch = _rows(session_join(weather_readings(p, ingest="timestamp"), gps_readings(p), 3600))
    path = scratch_path(spark, "resume")
    day = F.dayofmonth("timestamp")
    src = (spark.readStream.schema("value string, timestamp timestamp")
           .option("maxFilesPerTrigger", "1").parquet(path + "/*"))
    sp = parse_feed(src)
    sj = out_weather_pairs(session_join(weather_readings(sp, ingest="timestamp"), gps_readings(sp),
                                        3600, delay="1 day"))
    out, ckpt = scratch_path(spark, "resume-out"), scratch_path(spark, "resume-ckpt")
    for i, (lo, hi) in enumerate([(1, 11), (11, 21)]):
        stage_feed(f.where((day >= lo) & (day < hi)).coalesce(1), f"{path}/p={i}")
    run_available_now(sj, out, ckpt)
    stage_feed(f.where(day >= 21).coalesce(1), f"{path}/p=2")
    stage_feed(flush_lines(spark), f"{path}/p=9")
    run_available_now(sj, out, ckpt)
    stream = sorted(tuple(r) for r in spark.read.parquet(out)
                    .where(F.col("userId") != FLUSH_USER).collect())
    assert stream == batch and len(batch) > 0


def _late_session(spark, salt):
    """Weather 0 s, GPS 8 s (open to 18 s at a 10 s gap); readings of another
    user move the watermark to 12 s; then weather at 1 s: its own window ended
    at 11 s, but its session is open."""
    name = f"late-in-session{salt}"
    path = scratch_path(spark, name)
    stage_feed(feed(spark, [weather(EDGE_MS), gps(EDGE_MS + 8000), weather(EDGE_MS + 12_000, user="o"),
                            gps(EDGE_MS + 12_000, user="o")]), path + "/p=1")
    src = spark.readStream.schema("value string, timestamp timestamp").parquet(path + "/*")
    p = parse_feed(src)
    j = session_join(weather_readings(p, ingest="timestamp"), gps_readings(p), 10, salt=salt)
    out, ckpt = scratch_path(spark, name + "-out"), scratch_path(spark, name + "-ckpt")
    sel = j.select("userId", F.unix_millis("ingestTs").alias("ms"), F.unix_millis("window_start").alias("a"),
                   F.unix_millis("window_end").alias("b"))
    run_available_now(sel, out, ckpt)
    # 1 s falls into the open session; user "z" has no open session at 1 s
    stage_feed(feed(spark, [weather(EDGE_MS + 1000), weather(EDGE_MS + 1000, user="z"),
                            gps(EDGE_MS + 1000, user="z")]), path + "/p=2")
    run_available_now(sel, out, ckpt)
    stage_feed(feed(spark, [weather(FLUSH_MS, user=FLUSH_USER), gps(FLUSH_MS, user=FLUSH_USER)]), path + "/p=3")
    run_available_now(sel, out, ckpt)
    rows = spark.read.parquet(out).where("userId = 'u1' OR userId = 'z'").collect()
    return sorted((r.ms - EDGE_MS, r.a - EDGE_MS, r.b - EDGE_MS) for r in rows)


def test_reading_inside_an_open_session_is_not_late(spark):
    want = [(0, 0, 18_000), (1000, 0, 18_000)]
    assert _late_session(spark, 1) == want
    assert _late_session(spark, 3) == want


def test_late_reading_of_no_open_session_is_dropped():
    import pandas as pd
    from tandem.streaming.sessions import join_open
    late = pd.DataFrame({"t_us": [5, 31, 18, 40], "side": [0, 0, 0, 0]})
    # open [50, 70), gap 10: 40 touches it, 31 follows through 40; 18 and 5 are alone
    assert join_open(late, [(50, 70, 1, 1)], 10)["t_us"].tolist() == [31, 40]
    assert join_open(late, [], 10).empty


def test_stream_with_processing_time_ingest(spark):
    """``ingest=None``: the ingest time is the time of processing."""
    import time
    now = int(time.time() * 1000)
    path = scratch_path(spark, "ingest-none")
    stage_feed(feed(spark, [gps(now + d * 1000) for d in range(0, 600, 5)] + [weather(EDGE_MS)]), path)
    p = parse_feed(stream_feed(spark, path))
    j = tumbling_join(weather_readings(p), gps_readings(p), 3600)
    out = run_available_now(j.select(F.unix_millis("ingestTs").alias("ms"), F.unix_millis("obsTs").alias("obs")))
    rows = spark.read.parquet(out).collect()
    assert rows and all(now <= r.ms <= int(time.time() * 1000) and r.obs == EDGE_MS for r in rows)


@pytest.mark.parametrize("kw", [{}, {"salt": 3}])
def test_stream_session_keys_share_groups(spark, kw):
    """Two groups for all users, in time slices: sessions stay those of a user."""
    from tandem.sources.events import events_feed
    f = events_feed(spark, "/root/testdata/sf0.001")
    p = parse_feed(f)
    batch = _rows(session_join(weather_readings(p, ingest="timestamp"), gps_readings(p), 3600))
    path = scratch_path(spark, "few-groups")
    day = F.dayofmonth("timestamp")
    for i, (lo, hi) in enumerate([(1, 16), (16, 32)]):
        stage_feed(f.where((day >= lo) & (day < hi)).coalesce(1), f"{path}/p={i}")
    stage_feed(flush_lines(spark), f"{path}/p=9")
    src = (spark.readStream.schema("value string, timestamp timestamp")
           .option("maxFilesPerTrigger", "1").parquet(path + "/*"))
    sp = parse_feed(src)
    sj = session_join(weather_readings(sp, ingest="timestamp"), gps_readings(sp), 3600, delay="1 day", buckets=2,
                      chunk_pairs=3, **kw)
    out, ckpt = scratch_path(spark, "few-groups-out"), scratch_path(spark, "few-groups-ckpt")
    run_available_now(out_weather_pairs(sj), out, ckpt)
    stream = sorted(tuple(r) for r in spark.read.parquet(out).where(F.col("userId") != FLUSH_USER).collect())
    assert stream == batch and len(batch) > 0
    state = spark.read.format("statestore").option("stateVarName", "sessions").load(ckpt)
    assert {r.k for r in state.selectExpr("key.key AS k").collect()} <= {"0", "1"}


class _Stop(Exception):
    pass


@pytest.mark.parametrize("query, step", [("stream_job_messages", "run_pipeline"), ("stream_deduplicated_join", "tumbling_join")])
def test_replays_decode_the_feed_once(spark, monkeypatch, query, step):
    """What the joins get is the decoded table, not a parse of the feed a side."""
    from tandem.plans import streams

    def seen(*frames, decoded=None, **kw):
        for df in [decoded] if decoded is not None else [f for f in frames if hasattr(f, "_jdf")]:
            assert df.isStreaming and "userAccount" not in df._jdf.queryExecution().logical().toString()
        raise _Stop

    monkeypatch.setattr(streams, step, seen)
    with pytest.raises(_Stop):
        streams.STREAM_QUERIES[query](spark, "/root/testdata/sf0.001")
