"""Randomised messages checked against a plain-Python statement of the
reading rules (tree-model reads: text, long, int, float with defaults)."""

import json
import math
import random

from pyspark.sql import functions as F

from tandem.operators.parse import gps_readings, multi_readings, parse_feed, weather_readings
from tests.helpers import feed

W = ("temp", "humd", "CO2", "CO", "hour")


def _num(v, kind):
    """int/float value of a JSON node; non-numbers give 0."""
    if isinstance(v, bool) or not isinstance(v, (int, float)):
        return 0
    if kind == "int":
        if isinstance(v, float):
            if math.isnan(v):
                return 0
            return int(max(min(v, 2147483647), -2147483648))
        return v
    import struct
    return struct.unpack("f", struct.pack("f", float(v)))[0]


def _as_long(v):
    if isinstance(v, bool):
        return None  # not modelled (booleans read as 1/0)
    if v is None:
        return 0
    if isinstance(v, (int, float)):
        return int(v)
    if isinstance(v, str):
        t = v.strip()
        try:
            return int(t)
        except ValueError:
            try:
                return int(float(t))
            except ValueError:
                return 0
    return 0


def model(line):
    try:
        n = json.loads(line)
    except ValueError:
        return None
    if not isinstance(n, dict) or n.get("sensorType") != "TYPE_WEATHER":
        return None
    acct = n.get("userAccount")
    if not isinstance(acct, dict):
        return None
    uid, email, dev = acct.get("userId"), acct.get("userEmail"), n.get("deviceId")
    if not all(isinstance(x, str) for x in (uid, email, dev)):
        return None
    if "observationTimestamp" not in n or "sensorValue" not in n:
        return None
    sv = n["sensorValue"]
    if not isinstance(sv, dict) or not all(k in sv for k in W):
        return None
    ms = _as_long(n["observationTimestamp"])
    return (uid, tuple(_num(sv[k], "int") for k in W), ms)


def _value(rnd):
    return rnd.choice([rnd.randint(-50, 5000), round(rnd.uniform(-100, 100), 2), "40", "x",
                       True, None, {"a": 1}, [1]])


def _line(rnd, i):
    d = {}
    if rnd.random() > 0.1:
        d["userAccount"] = rnd.choice([{"userId": f"u{i}", "userEmail": "e"}, None,
                                       {"userId": f"u{i}"}, {"userId": f"u{i}", "userEmail": "e"}])
    if rnd.random() > 0.05:
        d["deviceId"] = "d"
    d["sensorType"] = rnd.choice(["TYPE_WEATHER"] * 6 + ["TYPE_GPS", None])
    keys = [k for k in W if rnd.random() > 0.1]
    if rnd.random() > 0.9:
        keys.append("extra")
    rnd.shuffle(keys)
    sv = {k: _value(rnd) for k in keys}
    d["sensorValue"] = rnd.choice([sv] * 8 + [[1, 2, 3], 5])
    if rnd.random() > 0.05:
        d["observationTimestamp"] = rnd.choice([1_700_000_000_000 + i, str(1_700_000_000_000 + i),
                                                "junk", None, 1.7e12])
    line = json.dumps(d)
    return line if rnd.random() > 0.03 else line[:-3]


def test_weather_reader_matches_model(spark):
    rnd = random.Random(11)
    lines = [_line(rnd, i) for i in range(600)]
    want = sorted(m for m in map(model, lines) if m is not None and m[2] is not None)
    p = parse_feed(feed(spark, lines))
    got = sorted((r.userId, (r.temp, r.humd, r.CO2, r.CO, r.hour), r.ms) for r in
                 weather_readings(p, ingest="timestamp")
                 .select("*", F.unix_millis("obsTs").alias("ms")).collect())
    assert len(want) > 50
    assert got == want


def test_gps_and_multi_models(spark):
    rnd = random.Random(5)
    lines, want_gps, want_multi = [], [], []
    for i in range(300):
        names = rnd.sample(["a", "b", "c", "d", "attr_lat", "attr_lng"], rnd.randint(1, 5))
        sv = {k: _value(rnd) for k in names}
        t = rnd.choice(["TYPE_GPS", "TYPE_ACCELEROMETER"])
        lines.append(json.dumps({"userAccount": {"userId": f"u{i}", "userEmail": "e"},
                                 "deviceId": "d", "sensorType": t, "sensorValue": sv,
                                 "observationTimestamp": i}))
        if t == "TYPE_GPS" and "attr_lat" in sv and "attr_lng" in sv:
            want_gps.append((f"u{i}", _num(sv["attr_lat"], "f"), _num(sv["attr_lng"], "f")))
        if t == "TYPE_ACCELEROMETER" and len(sv) >= 3:
            ks = list(sv)[:3]
            want_multi.append((f"u{i}",) + tuple(x for k in ks for x in (k, _num(sv[k], "f"))))
    p = parse_feed(feed(spark, lines))
    got_gps = sorted((r.userId, r.lat, r.lng) for r in gps_readings(p).collect())
    got_multi = sorted((r.userId, r.name1, r.value1, r.name2, r.value2, r.name3, r.value3)
                       for r in multi_readings(p).collect())
    assert got_gps == sorted(want_gps) and len(want_gps) > 10
    assert got_multi == sorted(want_multi) and len(want_multi) > 10
