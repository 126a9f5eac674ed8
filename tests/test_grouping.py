"""Joined rows by device, and the sliding join by panes."""

import random

import pytest
from pyspark.sql import functions as F

from tandem.operators.grouping import joined_by_device
from tandem.operators.panes import pane_pairs
from tandem.operators.parse import gps_readings, parse_feed, scalar_readings, weather_readings
from tandem.operators.windows import sliding_join, tumbling_join
from tests.helpers import EDGE_MS, feed, gps, msg, weather


def test_joined_by_device(spark):
    lines = [msg("TYPE_PROXIMITY", v, EDGE_MS + s * 1000, device=d) for s, v, d in
             [(1, 5, "d1 "), (2, 7, "d1"), (12, 1, "d1"), (95, 9, "d1"), (3, 4, "d2")]]
    lines += [gps(EDGE_MS + s * 1000, device=d, lat=float(s)) for s, d in [(4, "d1"), (15, "d1"), (16, "d1"), (97, "d1"), (50, "d2")]]
    p = parse_feed(feed(spark, lines))
    pairs = tumbling_join(scalar_readings(p), gps_readings(p, by_device=True), 10, keep_window=True)
    rows = joined_by_device(pairs, 30).orderBy("window_start").collect()
    got = [(r.deviceId, r.n_pairs, r.value_sum, r.value_min, r.value_max, r.lat_min, r.lat_max,
            int(r.first_obs.timestamp() * 1000) - EDGE_MS, int(r.last_obs.timestamp() * 1000) - EDGE_MS) for r in rows]
    # EDGE_MS is 20 s into its window of 30 s: the first pairs' window ends there
    assert got == [("d1", 2, 12, 5, 7, 4.0, 4.0, 4000, 4000), ("d1", 2, 2, 1, 1, 15.0, 16.0, 15_000, 16_000),
                   ("d1", 1, 9, 9, 9, 97.0, 97.0, 97_000, 97_000)]
    with pytest.raises(ValueError):
        joined_by_device(pairs.drop("window"), 30)
    with pytest.raises(ValueError):
        joined_by_device(pairs, 0)


@pytest.mark.parametrize("size,slide", [(12, 1), (7, 3), (10, 10), (5, 4)])
def test_panes_give_the_sliding_pairs(spark, size, slide):
    rnd = random.Random(size)
    lines = [make(EDGE_MS * rnd.choice([0, 1]) + rnd.randrange(-40_000, 40_000), user=rnd.choice(["a", "b"]))
             for make in (weather, gps) for _ in range(40)]
    p = parse_feed(feed(spark, lines))
    w, g = weather_readings(p, ingest="timestamp"), gps_readings(p)
    rows = lambda **kw: sorted(map(tuple, sliding_join(w, g, size, slide, **kw).collect()))
    plain = rows(panes=False)
    assert rows(panes=True) == plain == rows(panes=True, salt=3) and len(plain) > 0


def test_panes_keep_readings_once(spark):
    """One row a sensor reading and three a GPS reading are dealt, at any slide."""
    s = spark.range(50).select(F.lit("k").alias("_k"), F.timestamp_millis(F.col("id") * 700).alias("_et"), F.col("id").alias("s_id"))
    g = spark.range(40).select(F.lit("k").alias("_k"), F.timestamp_millis(F.col("id") * 900).alias("_et"), F.col("id").alias("g_id"))
    for slide in (5000, 500, 100):
        plan = pane_pairs(s, g, 5000, slide)._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("Generate") == 2  # the copies of GPS, and the windows behind the join
        assert plan.index("Generate explode(sequence") < plan.index("Join Inner")
        assert f"{slide}" in plan


def test_panes_are_the_default_for_many_windows(spark):
    p = parse_feed(feed(spark, [weather(EDGE_MS), gps(EDGE_MS)]))
    w, g = weather_readings(p, ingest="timestamp"), gps_readings(p)
    plan = lambda *a: sliding_join(w, g, *a)._jdf.queryExecution().optimizedPlan().toString()
    assert "_pane" in plan(12, 1) and "_pane" not in plan(12, 6)
    assert sliding_join(w, g, 12, 1).count() == 12
