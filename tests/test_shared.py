"""One query for all sensors: same pairs as the joins of their own, whatever
the micro-batches, window kinds, hot users and late readings."""

import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tandem.operators.parse import all_readings, gps_readings, multi_readings, parse_feed, weather_readings
from tandem.plans.pipeline import JobConfig, build_pipeline
from tandem.plans.streams import FLUSH_MS, FLUSH_USER
from tandem.session import scratch_path
from tandem.streaming.replay import run_available_now, stage_feed, stream_feed
from tandem.streaming.shared import (
    GPS_KIND, MULTI_KIND, WEATHER_KIND, DealHot, Windows, late_readings, run_shared_pipeline, shared_messages,
    shared_pairs,
)
from tests.helpers import EDGE_MS, feed, gps, msg, weather

ACC = "TYPE_ACCELEROMETER"


def acc(ms, user="u1", x=1):
    return msg(ACC, {"x": x, "y": 2, "z": 3}, ms, user=user)


def cfg(**kw):
    base = dict(window_size=10, window_type="Tumble", multi_sensors=(ACC,), multi_window="20 seconds", des_topic="out")
    return JobConfig(**{**base, **kw})


def random_lines(seed, n, span_s, users=("hot", "hot", "hot", "a", "b")):
    rnd, out = random.Random(seed), []
    for i in range(n):
        ms, user = EDGE_MS + rnd.randrange(0, span_s * 1000), rnd.choice(users)
        out.append((ms, rnd.choice([lambda: gps(ms, user=user, lat=round(50 + i / 1000, 3)), lambda: weather(ms, user=user + " "),
                                    lambda: acc(ms, user=user, x=i)])()))
    return out


def flush():
    return [weather(FLUSH_MS, user=FLUSH_USER), gps(FLUSH_MS, user=FLUSH_USER)]


def replay(spark, batches, frame_of, name):
    """Each list of lines as one micro-batch of one query; rows out, and the progress reports."""
    path, out, ckpt = (scratch_path(spark, f"{name}-{x}") for x in ("in", "out", "ckpt"))
    src = spark.readStream.schema("value string, timestamp timestamp").parquet(path + "/*")
    df = frame_of(parse_feed(src))
    progress = []
    for i, lines in enumerate(batches):
        stage_feed(feed(spark, lines).coalesce(1), f"{path}/p={i}")
        q = (df.writeStream.format("parquet").option("path", out).option("checkpointLocation", ckpt)
             .trigger(availableNow=True).start())
        q.awaitTermination()
        progress += q.recentProgress
    return spark.read.parquet(out), progress, ckpt


def messages(df):
    """(sensor type, user, lat, temp or x, observation) of each message."""
    js = lambda p: F.get_json_object("value", p)
    rows = df.where(js("$.userAccount.userId") != FLUSH_USER).select(
        js("$.sensorType").alias("t"), js("$.userAccount.userId").alias("u"), js("$.sensorValue.attr_lat").alias("lat"),
        js("$.sensorValue.x").alias("x"), F.coalesce(js("$.Time.ObservationTimestamp"), js("$.observationTimestamp")).alias("o"))
    return sorted(map(tuple, rows.where("t NOT LIKE '%withRegion'").collect()), key=repr)


def test_all_readings_are_those_of_the_readers(spark):
    lines = [gps(EDGE_MS), weather(EDGE_MS, user="u1 "), acc(EDGE_MS), msg("TYPE_PROXIMITY", 3, EDGE_MS),
             msg("TYPE_GPS", {"attr_lat": 1}, EDGE_MS), msg("TYPE_GPS", {"attr_lat": "x", "attr_lng": 2}, EDGE_MS),
             msg("TYPE_WEATHER", {"temp": 1}, EDGE_MS), msg(ACC, {"x": 1, "y": 2}, EDGE_MS),
             msg(ACC, {"b": 1.5, "a": "t", "c": None, "d": 4}, EDGE_MS), msg("TYPE_WEATHER", {}, EDGE_MS, account=False),
             msg("TYPE_WEATHER", {"temp": 31.9, "humd": "x", "CO2": 5e12, "CO": None, "hour": 1}, EDGE_MS), "broken"]
    p = parse_feed(feed(spark, lines))
    got = all_readings(p, ("TYPE_WEATHER",), (ACC,), "timestamp")
    for kind, want in (("gps", gps_readings(p)), ("weather", weather_readings(p, ingest="timestamp")), ("multi", multi_readings(p))):
        own = got.where(F.col("kind") == kind).select(*want.columns)
        assert sorted(map(repr, own.collect())) == sorted(map(repr, want.collect())) and own.count() > 0
    assert got.where("eventTs IS NULL").count() == 0


def test_windows_model():
    rnd = random.Random(1)
    for _ in range(300):
        slide = rnd.randint(1, 9)
        size = slide * rnd.randint(1, 4) if rnd.random() < 0.5 else slide + rnd.randint(0, 20)
        w = Windows({WEATHER_KIND: (size, slide), MULTI_KIND: (7, 7)})
        t = np.array([rnd.randint(-40, 60) for _ in range(5)])
        since, now = rnd.choice([None, rnd.randint(-20, 30)]), rnd.randint(30, 70)
        ends = [i * slide + size for i in range(-200, 200)]
        want = [(r, i) for r, x in enumerate(t) for i in range(-200, 200)
                if i * slide <= x < i * slide + size and i * slide + size <= now and (since is None or i * slide + size > since)]
        row, win = w.ended(WEATHER_KIND, t, since, now)
        assert list(zip(row.tolist(), win.tolist())) == want
        assert w.next_end(WEATHER_KIND, int(t[0])) == min(e for e in ends if e > t[0])
        assert w.last_end(WEATHER_KIND, t).tolist() == [max(e for e in ends if e - size <= x) for x in t]


@pytest.mark.parametrize("kw", [{"window_type": "Sliding", "window_size": 9}, {"salt": 3, "salt_keys": ("hot",)}])
def test_stream_equals_batch(spark, kw):
    """Micro-batches in time order: windows close while others stay open."""
    lines = sorted(random_lines(4, 150, 120))
    c = cfg(**kw)
    want = messages(build_pipeline(feed(spark, [x for _, x in lines]), c, ingest="timestamp"))
    cuts = [lines[i:i + 75] for i in range(0, len(lines), 75)]
    got, progress, _ = replay(spark, [[x for _, x in part] for part in cuts] + [flush()], lambda p: shared_messages(
        shared_pairs(p, c, ingest="timestamp"), c).where("name <> 'late'"), "shared-" + "-".join(map(str, kw)))
    assert messages(got) == want and len(want) > 50
    assert sum(p["numInputRows"] for p in progress) == len(lines) + 2  # every message is read once


def test_hot_users_are_found(spark):
    """No key is named: a fast user gets groups of its own, pairs stay the same."""
    lines = sorted(random_lines(5, 320, 240))
    c = cfg(window_type="Sliding", window_size=10)
    want = messages(build_pipeline(feed(spark, [x for _, x in lines]), c, ingest="timestamp"))
    cuts = [[x for _, x in lines[i:i + 110]] for i in range(0, len(lines), 110)]
    got, _, ckpt = replay(spark, cuts + [flush()], lambda p: shared_messages(shared_pairs(
        p, c, ingest="timestamp", hot_rows=4, max_groups=6, chunk_pairs=50), c).where("name <> 'late'"), "shared-hot")
    assert messages(got) == want and len(want) > 200
    rules = (spark.read.format("statestore").option("operatorId", 1).option("stateVarName", "rules").load(ckpt)
             .selectExpr("key.key AS k", "list_element.groups AS n").collect())
    most = {k: max(r.n for r in rules if r.k == k) for k in {r.k for r in rules}}
    assert most.get("hot", 0) >= 4 and most["hot"] > most.get("a", 1)


class FakeState:
    def __init__(self, value=None):
        self.value = value

    def exists(self):
        return self.value is not None

    def get(self):
        return self.value

    def update(self, v):
        self.value = v

    def appendValue(self, v):  # noqa: N802
        self.value = [*self.value, v]


class FakeTimer:
    def __init__(self, ms):
        self.ms = ms

    def getCurrentWatermarkInMs(self):  # noqa: N802
        return self.ms


def test_dealt_pairs_meet_once():
    """Any order of arrival: readings that share a window meet in exactly one group."""
    rnd, most = random.Random(2), []
    for _ in range(60):
        size = rnd.choice([4, 10])
        sizes = {WEATHER_KIND: (size, rnd.choice([size, size // 2])), MULTI_KIND: (7, 7)}
        deal = DealHot.__new__(DealHot)
        deal.sizes, deal.hot_rows, deal.max_groups = sizes, rnd.randint(1, 4), 8
        deal.names = ["kind", "t_us", "no", "salt", "lead"]
        deal.rules, deal.seen = FakeState([]), FakeState()
        rows, dealt = [], []
        for no in range(80):
            rows.append({"kind": rnd.choice([GPS_KIND, WEATHER_KIND, MULTI_KIND]), "t_us": max(0, no + rnd.randint(-9, 9)),
                         "no": no, "mix": rnd.randrange(1 << 40)})
        at = 0
        while at < len(rows):
            n = rnd.randint(1, 20)
            for out in deal.handleInputRows(("k",), [pd.DataFrame(rows[at:at + n])], FakeTimer(0)):
                dealt += out.to_dict("records")
            at += n
        groups = {}
        for d in dealt:
            groups.setdefault(d["no"], []).append(d["salt"])
        for s in rows:
            if s["kind"] == GPS_KIND:
                assert sorted(groups[s["no"]]) == list(range(len(groups[s["no"]])))
                continue
            assert len(groups[s["no"]]) == 1
            for g in rows:
                if g["kind"] == GPS_KIND and abs(g["t_us"] - s["t_us"]) < sizes[s["kind"]][0]:
                    assert groups[g["no"]].count(groups[s["no"]][0]) == 1 or not _share(s, g, sizes)
        assert sum(d["lead"] for d in dealt) == len(rows)
        most.append(max(len(g) for g in groups.values()))
    assert max(most) == 8 and sum(m > 1 for m in most) > 30


def _share(s, g, sizes):
    size, slide = sizes[s["kind"]]
    return any(i * slide <= min(s["t_us"], g["t_us"]) and max(s["t_us"], g["t_us"]) < i * slide + size
               for i in range(-20, 120))


def test_late_readings_come_out(spark):
    c = cfg()
    first = [weather(EDGE_MS + 105_000), gps(EDGE_MS + 106_000)]            # the watermark stands at 106 s
    late = [weather(EDGE_MS + 95_000, user="w"), acc(EDGE_MS + 70_000, user="m"), gps(EDGE_MS + 50_000, user="g")]
    in_time = [gps(EDGE_MS + 101_000, user="u1"), acc(EDGE_MS + 100_500, user="u1"), gps(EDGE_MS + 99_000, user="u1")]
    rows, _, _ = replay(spark, [first, late + in_time, flush()], lambda p: shared_pairs(p, c, ingest="timestamp"), "shared-late")
    late_rows = late_readings(rows).collect()
    # a GPS reading at 99 s is late: its windows of either kind ended at 100 s
    assert sorted((r.userId, r.sensorType) for r in late_rows) == [
        ("g", "TYPE_GPS"), ("m", ACC), ("u1", "TYPE_GPS"), ("w", "TYPE_WEATHER")]
    assert {r.userId: r.temp for r in late_rows}["w"] == 31 and {r.userId: r.name1 for r in late_rows}["m"] == "x"
    pairs = rows.where("tag IN ('weather', 'multi')").selectExpr("tag", "s_obs_us div 1000 AS s", "g_obs_us div 1000 AS g").collect()
    assert sorted((r.tag, r.s - EDGE_MS, r.g - EDGE_MS) for r in pairs) == [
        ("multi", 100_500, 101_000), ("multi", 100_500, 106_000), ("weather", 105_000, 101_000), ("weather", 105_000, 106_000)]
    assert rows.where("tag = 'gps'").count() == 5                             # every GPS reading, late or not


def test_a_silent_sensor_holds_no_state(spark):
    """GPS readings alone move the watermark on; what they leave behind is theirs only."""
    c = cfg(window_type="Tumble")
    batches = [[gps(EDGE_MS + s * 1000) for s in range(0, 60, 5)], [gps(EDGE_MS + s * 1000) for s in range(60, 120, 5)],
               [gps(EDGE_MS + 121_000, user="other")]]
    _, _, ckpt = replay(spark, batches, lambda p: shared_pairs(p, c, ingest="timestamp"), "shared-idle")
    open_ = (spark.read.format("statestore").option("stateVarName", "gps").load(ckpt)
             .selectExpr("key.key AS k", "list_element.t_min AS t").collect())
    assert {r.k for r in open_} == {"other"}


def test_session_windows_have_their_own_query(spark):
    with pytest.raises(ValueError):
        shared_pairs(parse_feed(feed(spark, flush())), cfg(window_type="Session"))


def _groups(spark, ckpt, var):
    state = spark.read.format("statestore").option("stateVarName", var).load(ckpt)
    return {r.k for r in state.selectExpr("key.key AS k").collect()}


@pytest.mark.parametrize("kw", [{"window_type": "Sliding", "window_size": 9}, {"salt": 3, "salt_keys": ("u1", "u2")}])
def test_users_share_groups(spark, kw):
    """Many users, two groups: pairs stay those of a user (and of a salt group), late readings too."""
    lines = sorted(random_lines(6, 150, 90, users=[f"u{i}" for i in range(12)]))
    c = cfg(**kw)
    want = messages(build_pipeline(feed(spark, [x for _, x in lines]), c, ingest="timestamp"))
    cuts = [[x for _, x in lines[i:i + 75]] for i in range(0, len(lines), 75)]
    late = [gps(EDGE_MS, user="u3"), weather(EDGE_MS, user="u4")]
    got, _, ckpt = replay(spark, [*cuts, late, flush()], lambda p: shared_messages(shared_pairs(
        p, c, ingest="timestamp", buckets=2), c), "shared-few-" + "-".join(map(str, kw)))
    assert messages(got.where("name <> 'late'")) == want and len(want) > 20
    assert got.where("name = 'late'").count() == 2
    assert _groups(spark, ckpt, "clock") == {"0", "1"}


def test_the_shared_job_deals_users_to_groups(spark):
    """State groups of the job follow ``buckets``, not the users."""
    path, ckpt = scratch_path(spark, "shared-job"), scratch_path(spark, "shared-job-ckpt")
    lines = [m for i in range(30) for m in (gps(EDGE_MS, user=f"u{i}"), weather(EDGE_MS, user=f"u{i}"))]
    src = stream_feed(spark, stage_feed(feed(spark, lines), path))
    out = run_shared_pipeline(spark, cfg(), source=src, checkpoint_dir=ckpt, buckets=3,
                              sink=lambda msgs, name, at: run_available_now(msgs, scratch_path(spark, "shared-job-out"), at))
    assert spark.read.parquet(out).count() == 0  # the windows are open
    assert _groups(spark, f"{ckpt}/shared", "gps") <= {"0", "1", "2"}
