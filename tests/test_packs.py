"""Dense stream joins: readings meet in packs, pairs and times stay those of the plain join."""

from collections import Counter

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tandem.operators.grouping import joined_by_device
from tandem.operators.parse import gps_readings, parse_feed, scalar_readings
from tandem.operators.windows import tumbling_join
from tandem.plans.catalog import out_by_device, out_scalar_pairs, q_tumbling_join_scalar
from tandem.session import scratch_path
from tandem.streaming import packs
from tandem.streaming.replay import run_available_now, stage_feed, stream_feed
from tests.helpers import EDGE_MS, feed, gps, msg
from tests.test_sources import _one_device_day


def _prox(s, device="d1", value=1):
    return msg("TYPE_PROXIMITY", value, EDGE_MS + s * 1000, device=device)


def _gps(s, device="d1", lat=53.5):
    return gps(EDGE_MS + s * 1000, device=device, lat=lat)


LINES = [_prox(s, d, v) for s, d, v in [(1, "d1", 1), (1, "d1", 1), (3, "d1 ", 2), (12, "d1", 1), (14, "d2", 5), (31, "d2", 0)]] + \
        [_gps(s, d) for s, d in [(2, "d1"), (2, "d1"), (6, "d1"), (15, "d1"), (16, "d2"), (33, "d2"), (47, "d1")]]


def _sides(p):
    return scalar_readings(p), gps_readings(p, by_device=True)


@pytest.mark.parametrize("salt", [1, 3])
def test_dense_stream_equals_plain_batch(spark, salt):
    f = feed(spark, LINES)
    want = sorted(map(tuple, out_scalar_pairs(tumbling_join(*_sides(parse_feed(f)), 10)).collect()))
    sp = parse_feed(stream_feed(spark, stage_feed(f)))
    j = out_scalar_pairs(tumbling_join(*_sides(sp), 10, dense=True, salt=salt))
    got = sorted(map(tuple, spark.read.parquet(run_available_now(j)).collect()))
    assert got == want and len(got) > len(set(got))


def test_query_keeps_packs_in_its_state(spark, tmp_path, monkeypatch):
    """One state row a pack, not a reading: what is read for each pair is a pack."""
    from tandem.plans import streams
    d = _one_device_day(spark, tmp_path, 40, 120)
    ckpt = scratch_path(spark, "packs-ckpt")
    monkeypatch.setattr(streams, "_sink", lambda df: spark.read.parquet(run_available_now(df, checkpoint=ckpt)))
    rows = sorted(map(tuple, streams.q_stream_tumbling_join_scalar(spark, d).collect()))
    assert rows == sorted(map(tuple, q_tumbling_join_scalar(spark, d).collect())) and len(rows) > 4000
    for side, readings in (("left", 100), ("right", 30)):
        kept = spark.read.format("statestore").option("joinSide", side).load(ckpt).count()
        assert 0 < kept * 3 < readings


def test_late_packs_are_dropped(spark):
    """As in the plain join: the next micro-batch's pairs behind the watermark do
    not come, those of a window that is still open do."""
    got = {}
    for dense in (False, True):
        path = scratch_path(spark, "late-packs")
        stage_feed(feed(spark, [_prox(100), _gps(103), _gps(102)]), path + "/p=1")
        src = spark.readStream.schema("value string, timestamp timestamp").parquet(path + "/*")
        j = tumbling_join(*_sides(parse_feed(src)), 10, dense=dense).select(F.unix_millis("obsTs").alias("o"))
        out, ckpt = scratch_path(spark, "late-packs-out"), scratch_path(spark, "late-packs-ckpt")
        run_available_now(j, out, ckpt)
        stage_feed(feed(spark, [_prox(1), _gps(2), _gps(101), _prox(105)]), path + "/p=2")
        run_available_now(j, out, ckpt)
        got[dense] = Counter((r.o - EDGE_MS) // 1000 for r in spark.read.parquet(out).collect())
    assert got[True] == got[False] == {103: 2, 102: 2, 101: 2}


def test_dense_pairs_grouped_behind_the_join(spark):
    """The pairs keep their window's watermark: a stateful operator may follow."""
    far = [_prox(500_000, "-"), _gps(500_000, "-")]
    p = parse_feed(feed(spark, LINES + far))
    want = sorted(map(tuple, out_by_device(joined_by_device(tumbling_join(*_sides(p), 10, keep_window=True), 20))
                      .where("deviceId <> '-'").collect()))
    sp = parse_feed(stream_feed(spark, stage_feed(feed(spark, LINES + far))))
    j = out_by_device(joined_by_device(tumbling_join(*_sides(sp), 10, keep_window=True, dense=True), 20))
    got = sorted(map(tuple, spark.read.parquet(run_available_now(j)).where("deviceId <> '-'").collect()))
    assert got == want and len(got) == 3


def test_packs_hold_every_row_once(monkeypatch):
    monkeypatch.setattr(packs, "BUFFER_ROWS", 1000)
    rows = [(None if i % 13 == 0 else f"d{i % 3}", i * 7 % 2, i, None if i % 5 == 0 else i % 4, i * 0.5) for i in range(3300)]
    cols = ["_k", "_win", "_us", "s_value", "s_x"]
    batch = lambda part: pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*part)], cols)
    out = list(packs.pack_batches(iter([batch(rows[i:i + 300]) for i in range(0, 3300, 300)])))
    assert len(out) == 3
    back = Counter()
    for b in out:
        for r in b.to_pylist():
            assert len(r["_rows"]) <= packs.PACK_ROWS
            own = [rows[int(x["s_x"] * 2)] for x in r["_rows"]]
            assert {x[0] for x in own} == {r["_k"]} and len({x[1] for x in own}) == 1 and max(x[2] for x in own) == r["_us"]
            back.update((r["_k"], x["s_value"], x["s_x"]) for x in r["_rows"])
    assert back == Counter((r[0], r[3], r[4]) for r in rows)
    assert list(packs.pack_batches(iter([]))) == []
