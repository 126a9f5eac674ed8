import json

from pyspark.sql import functions as F

from tandem.operators.messages import gps_region_message, multi_message, weather_message
from tandem.operators.parse import gps_readings, multi_readings, parse_feed, weather_readings
from tandem.operators.windows import tumbling_join
from tests.helpers import EDGE_MS, feed, gps, msg, weather


def test_weather_message_shape(spark):
    p = parse_feed(feed(spark, [weather(EDGE_MS + 1000, user="u1 "), gps(EDGE_MS + 2000)]))
    pairs = tumbling_join(weather_readings(p, ingest="timestamp"), gps_readings(p), 5)
    m = json.loads(weather_message(pairs, job_name="J", window_type="Tumble", window_size=5,
                                   processed_ms=7).first().value)
    assert list(m) == ["WindowConfig", "userAccount", "deviceId", "sensorType", "sensorValue", "Time"]
    assert m["WindowConfig"] == {"JobName": "J", "WindowType": "Tumble", "WindowSize": "5"}
    assert m["userAccount"] == {"userId": "u1", "userEmail": "u1@example.org"}
    assert m["sensorType"] == "TYPE_Join_WEATHER_GPS"
    sv = m["sensorValue"]
    assert list(sv) == ["attr_lat", "attr_lng", "Hour", "Temperature", "Humidity", "CO2", "CO",
                        "regoin", "FireAlert"]
    assert (sv["Temperature"], sv["FireAlert"], sv["regoin"]) == (31, "Yellow", "")
    assert m["Time"] == {"ObservationTimestamp": EDGE_MS + 1000, "IngestTime": EDGE_MS + 1000,
                         "ProcessedTimestamp": 7}


def test_multi_message_dynamic_and_quoted_keys(spark):
    lines = [msg("TYPE_ACCELEROMETER", None, EDGE_MS + 1000,
                 raw_value='{"ax":1.5,"attr_lat":2,"az":3}'), gps(EDGE_MS + 2000)]
    p = parse_feed(feed(spark, lines))
    pairs = tumbling_join(multi_readings(p), gps_readings(p), "10000 milliseconds")
    m = json.loads(multi_message(pairs).first().value)
    # a sensor member named like a position member keeps its place, GPS value wins (last)
    assert list(m["sensorValue"]) == ["ax", "attr_lat", "az", "attr_lng", "regoin"]
    assert m["sensorValue"]["ax"] == 1.5 and abs(m["sensorValue"]["attr_lat"] - 53.29) < 1e-3
    assert m["observationTimestamp"] == EDGE_MS + 2000
    q = json.loads(multi_message(pairs, quoted_keys=True).first().value)
    assert list(q["sensorValue"])[:3] == ['"ax"', '"attr_lat"', '"az"']


def test_gps_region_message(spark):
    p = parse_feed(feed(spark, [gps(EDGE_MS)]))
    g = gps_readings(p).withColumn("region", F.lit("R"))
    m = json.loads(gps_region_message(g, processed_ms=9).first().value)
    assert m["sensorType"] == "TYPE_GPS_withRegion" and m["observationTimestamp"] == 9
    assert m["sensorValue"]["regoin"] == "R"
