"""Window joins against a plain-Python model of their pairs."""

import random

from pyspark.sql import functions as F

from tandem.operators.parse import gps_readings, parse_feed, weather_readings
from tandem.operators.windows import session_join, sliding_join, tumbling_join
from tests.helpers import EDGE_MS, feed, gps, weather


def model_fixed(s_rows, g_rows, size, slide):
    """(sensor ms, gps index, window start) for every window [k*slide, k*slide+size)
    holding both readings, keys matched with the sensor key trimmed."""
    out = []
    for sk, st in s_rows:
        for gi, (gk, gt) in enumerate(g_rows):
            if sk.strip() != gk:
                continue
            k = -(-(max(st, gt) - size + 1) // slide)  # first start covering both
            while k * slide <= min(st, gt):
                out.append((st, gi, k * slide))
                k += 1
    return sorted(out)


def model_session(s_rows, g_rows, gap):
    """Sessions over both sides of a key: a step > gap starts a new one."""
    events = sorted([(k.strip(), t, "S", None) for k, t in s_rows]
                    + [(k, t, "G", i) for i, (k, t) in enumerate(g_rows)])
    out = []
    for key in sorted({e[0] for e in events}):
        ts = [e for e in events if e[0] == key]
        groups, cur = [], [ts[0]]
        for e in ts[1:]:
            if e[1] - cur[-1][1] > gap:
                groups.append(cur)
                cur = []
            cur.append(e)
        groups.append(cur)
        for grp in groups:
            for a in grp:
                for b in grp:
                    if a[2] == "S" and b[2] == "G":
                        out.append((a[1], b[3], grp[0][1]))
    return sorted(out)


def _pairs(spark, s_rows, g_rows, join, *args):
    # every GPS reading gets a unique whole-number longitude, which the pair keeps
    lines = ([weather(t, user=k) for k, t in s_rows]
             + [gps(t, user=k, lng=float(i)) for i, (k, t) in enumerate(g_rows)])
    p = parse_feed(feed(spark, lines))
    j = join(weather_readings(p, ingest="timestamp"), gps_readings(p), *args)
    rows = j.select(F.unix_millis("obsTs").alias("s"), F.col("lng").cast("int").alias("g"),
                    F.unix_millis("window_start").alias("w")).collect()
    return sorted((r.s, r.g, r.w) for r in rows)


def _random_rows(rnd, n, keys, span_ms):
    return [(rnd.choice(keys), EDGE_MS + rnd.randrange(span_ms)) for _ in range(n)]


def test_fixed_windows_match_model(spark):
    rnd = random.Random(21)
    for size_s in (3, 5, 7):
        s_rows = _random_rows(rnd, 25, ["a", "a ", "b", "c\t"], 40_000)
        g_rows = _random_rows(rnd, 15, ["a", "b", "c", "a "], 40_000)
        assert _pairs(spark, s_rows, g_rows, tumbling_join, size_s) == \
            model_fixed(s_rows, g_rows, size_s * 1000, size_s * 1000), size_s
        slide = size_s // 2 * 1000
        assert _pairs(spark, s_rows, g_rows, sliding_join, size_s) == \
            model_fixed(s_rows, g_rows, size_s * 1000, slide), size_s


def test_sessions_match_model(spark):
    rnd = random.Random(22)
    for gap_s in (1, 4):
        s_rows = _random_rows(rnd, 25, ["a", "a ", "b"], 60_000)
        g_rows = _random_rows(rnd, 15, ["a", "b", "b "], 60_000)
        got = _pairs(spark, s_rows, g_rows, session_join, gap_s)
        assert got == model_session(s_rows, g_rows, gap_s * 1000), gap_s
