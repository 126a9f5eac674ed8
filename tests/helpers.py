"""Message builders for golden tests."""

from __future__ import annotations

import json

from pyspark.sql import functions as F

EDGE_MS = 1_700_000_000_000  # a multiple of 10 s


def msg(sensor_type, value, ms, user="u1", device="d1", email="u1@example.org", account=True,
        raw_value=None):
    d = {}
    if account:
        d["userAccount"] = {"userId": user, "userEmail": email}
    d["deviceId"] = device
    d["sensorType"] = sensor_type
    body = json.dumps(d)[:-1]
    sv = raw_value if raw_value is not None else json.dumps(value)
    ts = ms if isinstance(ms, str) else str(ms)
    return f'{body}, "sensorValue": {sv}, "observationTimestamp": {ts}}}'


def gps(ms, user="u1", device="d1", lat=53.290075, lng=-9.0743801):
    return msg("TYPE_GPS", {"attr_lat": lat, "attr_lng": lng}, ms, user=user, device=device)


def weather(ms, user="u1", device="d2", temp=31, humd=40, co2=300, co=5, hour=14):
    return msg("TYPE_WEATHER", {"temp": temp, "humd": humd, "CO2": co2, "CO": co, "hour": hour},
               ms, user=user, device=device)


def feed(spark, lines, ingest_from_obs=True):
    """(value, timestamp) frame; timestamp = the message's observation time."""
    rows = []
    for line in lines:
        try:
            ms = int(json.loads(line).get("observationTimestamp", 0))
        except Exception:
            ms = 0
        rows.append((line, ms))
    df = spark.createDataFrame(rows, "value string, ms long")
    return df.select("value", F.timestamp_millis("ms").alias("timestamp"))
