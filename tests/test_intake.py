"""Redelivered messages count once; bad ones land with their reason."""

from pyspark.sql import functions as F

from tandem.operators import intake as I
from tandem.session import scratch_path
from tandem.streaming.replay import stage_feed
from tests.helpers import EDGE_MS, gps, msg, weather

BAD = {
    '{"deviceId": "d1"': I.NOT_AN_OBJECT, "[1, 2]": I.NOT_AN_OBJECT, "": I.NOT_AN_OBJECT, "7": I.NOT_AN_OBJECT,
    msg("TYPE_GPS", {"attr_lat": 1, "attr_lng": 2}, EDGE_MS, account=False): I.NO_ID,
    '{"userAccount": {"userId": null, "userEmail": "e"}, "deviceId": "d", "sensorType": "T", "observationTimestamp": 1}':
        I.NO_ID,
    '{"userAccount": {"userId": "u", "userEmail": "e"}, "deviceId": "d", "observationTimestamp": 1}': I.NO_TYPE,
    '{"userAccount": {"userId": "u", "userEmail": "e"}, "deviceId": "d", "sensorType": "T"}': I.NO_TIME,
}
GOOD = [gps(EDGE_MS), gps(EDGE_MS + 1), weather(EDGE_MS)]


def at(spark, rows):
    """(value, seconds after EDGE_MS) -> a feed."""
    return spark.createDataFrame(rows, "value string, s long").select(
        "value", F.timestamp_millis(F.col("s") * 1000 + EDGE_MS).alias("timestamp"))


def test_reasons_and_repeats_in_a_batch(spark):
    rows = [(v, i) for i, v in enumerate([*BAD, *GOOD, None])]
    got = I.clean_feed(at(spark, rows + [(v, s + 50) for v, s in rows])).collect()
    assert {r.value: r.reason for r in got} == {**BAD, **dict.fromkeys(GOOD), None: I.NOT_AN_OBJECT}
    assert len(got) == len(rows)
    both = I.clean_feed(at(spark, [(GOOD[0], 0), (GOOD[0], 0), (GOOD[0], 5)]), also=("timestamp",))
    assert both.count() == 2
    assert I.clean_feed(at(spark, rows).where("false")).count() == 0


def run(spark, src, path, ckpt, delay):
    stream = spark.readStream.schema("value string, timestamp timestamp").parquet(src + "/*")
    q = I.run_intake(I.clean_feed(stream, delay), path, ckpt, {"availableNow": True})
    q.awaitTermination()
    assert q.exception() is None
    return q


def test_stream_redelivery_late_messages_and_bounded_state(spark):
    src, path, ckpt = (scratch_path(spark, f"intake-{x}") for x in ("src", "out", "ckpt"))
    batches = [
        [(GOOD[0], 0), (GOOD[0], 3), ("[]", 1)],   # again within one micro-batch
        [(GOOD[0], 30), ("[]", 40), (GOOD[1], 60)],  # again in the next one
        [(GOOD[2], 5000)],
        [(GOOD[1], 5100), ("{", 10), ("{}", 5050)],  # after its state went; too late; new
    ]
    for i, rows in enumerate(batches):
        stage_feed(at(spark, rows), f"{src}/part={i}")
        q = run(spark, src, path, ckpt, "100 seconds")
    good = [r.value for r in I.good_messages(spark, path, streaming=False).collect()]
    assert sorted(good) == sorted([GOOD[0], GOOD[1], GOOD[2], GOOD[1]])
    assert sorted((r.value, r.reason) for r in I.dead_letters(spark, path).collect()) == [
        ("[]", I.NOT_AN_OBJECT), ("{}", I.NO_ID)]
    left = [op["numRowsTotal"] for p in q.recentProgress for op in p["stateOperators"]]
    assert left and left[-1] <= 3  # messages of long ago are forgotten


def test_only_the_wanted_folder_is_read(spark):
    path, ckpt, src = (scratch_path(spark, f"intake-{x}") for x in ("out", "ckpt", "src"))
    stage_feed(at(spark, [(GOOD[0], 0), ("[]", 0)]), src + "/part=0")
    run(spark, src, path, ckpt, "1 hour")
    plan = I.good_messages(spark, path, streaming=False)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "NOT bad" in plan
