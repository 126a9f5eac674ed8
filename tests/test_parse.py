from pyspark.sql import functions as F

from tandem.operators.parse import (
    bad_records, gps_readings, multi_readings, parse_feed, scalar_readings, weather_readings,
)
from tests.helpers import EDGE_MS, feed, msg, weather

GOLDEN = [
    '{"userAccount":{"userId":"u1","userEmail":"u1@example.org"},"deviceId":"d1","sensorType":"TYPE_GPS","sensorValue":{"attr_lat":53.290075,"attr_lng":-9.0743801},"observationTimestamp":1700000001000}',
    '{"userAccount":{"userId":"u1 ","userEmail":"u1@example.org"},"deviceId":"d2","sensorType":"TYPE_WEATHER","sensorValue":{"temp":31,"humd":40,"CO2":300,"CO":5,"hour":14},"observationTimestamp":1700000002000}',
    '{"userAccount":{"userId":"u1","userEmail":"u1@example.org"},"deviceId":"d1","sensorType":"TYPE_ACCELEROMETER","sensorValue":{"x":0.5,"y":-1.25,"z":9.75},"observationTimestamp":1700000002500}',
    '{"userAccount":{"userId":"u1","userEmail":"u1@example.org"},"deviceId":"d1 ","sensorType":"TYPE_PROXIMITY","sensorValue":5,"observationTimestamp":1700000003000}',
]


def _p(spark, lines):
    return parse_feed(feed(spark, lines))


def test_golden_messages(spark):
    p = _p(spark, GOLDEN)
    g = gps_readings(p).collect()
    assert len(g) == 1 and g[0].userId == "u1"
    # 32-bit float, as the original tuple kept it
    assert abs(g[0].lat - 53.290073) < 1e-5 and g[0].lat != 53.290075
    w = weather_readings(p, ingest="timestamp").collect()
    assert [(r.temp, r.humd, r.CO2, r.CO, r.hour) for r in w] == [(31, 40, 300, 5, 14)]
    m = multi_readings(p).collect()
    assert [(r.name1, r.value1, r.name2, r.value2, r.name3, r.value3) for r in m] == [
        ("x", 0.5, "y", -1.25, "z", 9.75)]
    s = scalar_readings(p).collect()
    assert [(r.deviceId, r.value) for r in s] == [("d1 ", 5)]
    assert m[0].obsTs.timestamp() * 1000 == 1700000002500


def test_bad_records(spark):
    lines = ['{"a":', "[1,2]", "garbage", GOLDEN[0]]
    f = feed(spark, lines)
    assert sorted(r.value for r in bad_records(f).collect()) == sorted(lines[:3])
    assert parse_feed(f).count() == 1


def test_missing_account_type_and_unknown(spark):
    lines = [
        msg("TYPE_GPS", {"attr_lat": 1, "attr_lng": 2}, EDGE_MS, account=False),
        '{"userAccount":null,"deviceId":"d1","sensorType":"TYPE_GPS","sensorValue":{"attr_lat":1,"attr_lng":2},"observationTimestamp":1}',
        '{"userAccount":{"userId":"u1","userEmail":"e"},"deviceId":"d1","sensorValue":{"attr_lat":1,"attr_lng":2},"observationTimestamp":1}',
        msg("TYPE_UNKNOWN", {"attr_lat": 1, "attr_lng": 2}, EDGE_MS),
    ]
    p = _p(spark, lines)
    assert gps_readings(p).count() == 0
    assert weather_readings(p).count() == 0
    assert scalar_readings(p).count() == 0


def test_weather_coercions(spark):
    lines = [
        msg("TYPE_WEATHER", {"temp": 5}, EDGE_MS),  # one member
        msg("TYPE_WEATHER", {"temp": 5, "humd": 1, "CO2": 1, "CO": 1}, EDGE_MS),  # hour missing
        msg("TYPE_WEATHER", None, EDGE_MS,
            raw_value='{"temp":31.9,"humd":"40","CO2":true,"CO":null,"hour":-3.7}'),
        msg("TYPE_WEATHER", None, EDGE_MS, raw_value='[1,2,3,4,5]'),
        msg("TYPE_WEATHER", None, EDGE_MS,
            raw_value='{"temp":1e20,"humd":-1e20,"CO2":{"a":1},"CO":[1],"hour":"NaN"}'),
    ]
    rows = weather_readings(_p(spark, lines)).collect()
    got = sorted((r.temp, r.humd, r.CO2, r.CO, r.hour) for r in rows)
    assert got == sorted([(31, 0, 0, 0, -3), (2147483647, -2147483648, 0, 0, 0)])


def test_gps_scalar_value_dropped_and_text_numbers(spark):
    lines = [
        msg("TYPE_GPS", 5, EDGE_MS),
        msg("TYPE_GPS", {"attr_lat": "53.1", "attr_lng": 7}, EDGE_MS),
        msg("TYPE_GPS", {"attr_lat": 1}, EDGE_MS),
    ]
    rows = gps_readings(_p(spark, lines)).collect()
    assert [(r.lat, r.lng) for r in rows] == [(0.0, 7.0)]


def test_multi_rules(spark):
    lines = [
        msg("TYPE_ACCELEROMETER", {"x": 1, "y": 2}, EDGE_MS, user="two"),
        msg("TYPE_ACCELEROMETER", None, EDGE_MS, user="four",
            raw_value='{"b":1,"a":2,"c":3,"d":4}'),
        msg("TYPE_ACCELEROMETER", None, EDGE_MS, user="kinds",
            raw_value='{"x":1.5,"y":"2","z":true,"q":9}'),
        msg("TYPE_ACCELEROMETER", None, EDGE_MS, user="dup",
            raw_value='{"x":1,"x":2,"y":3,"z":4}'),
        msg("TYPE_ACCELEROMETER", None, EDGE_MS, user="array", raw_value='[1,2,3]'),
        msg("TYPE_GRAVITY", {"gx": 1, "gy": 2, "gz": 3}, EDGE_MS, user="grav"),
    ]
    p = _p(spark, lines)
    rows = {r.userId: (r.name1, r.value1, r.name2, r.value2, r.name3, r.value3)
            for r in multi_readings(p).collect()}
    assert rows == {
        "four": ("b", 1.0, "a", 2.0, "c", 3.0),
        "kinds": ("x", 1.5, "y", 0.0, "z", 0.0),
        "dup": ("x", 2.0, "y", 3.0, "z", 4.0),
    }
    assert multi_readings(p, "TYPE_GRAVITY").count() == 1


def test_timestamp_text_and_unreadable(spark):
    lines = [msg("TYPE_PROXIMITY", 3, '"1700000001000"'), msg("TYPE_PROXIMITY", 4, '"abc"'),
             msg("TYPE_PROXIMITY", 7, "1700000001000")]
    rows = scalar_readings(_p(spark, lines)).select(
        "value", F.unix_millis("obsTs").alias("ms")).collect()
    assert sorted((r.value, r.ms) for r in rows) == [(3, 1700000001000), (4, 0),
                                                    (7, 1700000001000)]


def test_scalar_kinds(spark):
    lines = [msg("TYPE_PROXIMITY", "5", EDGE_MS, user="text"),
             msg("TYPE_PROXIMITY", None, EDGE_MS, user="null", raw_value="null"),
             msg("TYPE_PROXIMITY", 7.9, EDGE_MS, user="num"),
             '{"userAccount":{"userId":"u","userEmail":"e"},"deviceId":"d","sensorType":"TYPE_PROXIMITY","observationTimestamp":1}']
    rows = sorted(r.value for r in scalar_readings(_p(spark, lines)).collect())
    assert rows == [0, 0, 7]


def test_weather_ingest_default_is_now(spark):
    p = _p(spark, [weather(EDGE_MS)])
    r = weather_readings(p).collect()[0]
    assert r.ingestTs.year >= 2024 and r.ingestTs != r.obsTs


def test_staged_parse_gives_same_readings(spark):
    from tandem.operators.parse import stage_parsed
    lines = GOLDEN + [msg("TYPE_PROXIMITY", "5", EDGE_MS, user="text"),
                      msg("TYPE_PROXIMITY", None, EDGE_MS, user="null", raw_value="null"),
                      msg("TYPE_PROXIMITY", None, EDGE_MS, user="obj", raw_value='{"a":1}')]
    p = _p(spark, lines)
    s = stage_parsed(p)
    for reader in (gps_readings, scalar_readings, multi_readings):
        assert sorted(map(tuple, reader(p).collect())) == sorted(map(tuple, reader(s).collect()))
    a = weather_readings(p, ingest="timestamp").collect()
    b = weather_readings(s, ingest="timestamp").collect()
    assert sorted(map(tuple, a)) == sorted(map(tuple, b))
    assert sorted(r.value for r in scalar_readings(s).collect()) == [0, 0, 0, 5]


def test_empty_feed_flows_through(spark):
    from tandem.operators.parse import stage_parsed
    from tandem.operators.windows import session_join, tumbling_join
    f = feed(spark, ['{"a":'])  # nothing decodes
    p = stage_parsed(parse_feed(f))
    w, g = weather_readings(p, ingest="timestamp"), gps_readings(p)
    assert p.count() == 0 and tumbling_join(w, g, 5).count() == 0
    assert session_join(w, g, 5).count() == 0


def test_coercion_edges(spark):
    """An object where text is due reads as ''; a long beyond the int range
    keeps its low 32 bits, a fraction saturates; true reads as 1."""
    from tandem.operators.parse import parse_feed, scalar_readings, weather_readings
    from tests.helpers import EDGE_MS, feed, msg
    w = {"temp": 3000000000, "humd": 3000000000.5, "CO2": -3000000000, "CO": 4294967296, "hour": 12345678901234567890}
    lines = [msg("TYPE_WEATHER", w, EDGE_MS, user={"a": 1}, device=["d"]),
             msg("TYPE_WEATHER", {"temp": 1, "humd": 2, "CO2": 3, "CO": 4, "hour": 5}, "true", user="{not json"),
             msg("TYPE_WEATHER", {"temp": 1, "humd": 2, "CO2": 3, "CO": 4, "hour": 6}, '"true"', user="[x]"),
             msg("TYPE_PROXIMITY", 3000000000, EDGE_MS), msg("TYPE_PROXIMITY", 3e9 + 0.5, EDGE_MS)]
    p = parse_feed(feed(spark, lines))
    rows = {r.hour: r for r in weather_readings(p, ingest="timestamp").collect()}
    r = rows[12345678901234567890 % 2**32 - (2**32 if 12345678901234567890 % 2**32 >= 2**31 else 0)]
    assert (r.userId, r.deviceId) == ("", "")
    assert (r.temp, r.humd, r.CO2, r.CO) == (3000000000 - 2**32, 2147483647, 2**32 - 3000000000, 0)
    ms = {r.hour: (r.userId, r.obsMs) for r in p.where("sensorType = 'TYPE_WEATHER'").selectExpr(
        "userId", "obsMs", "try_cast(get_json_object(sensorValue, '$.hour') as int) hour").collect()}
    assert ms[5] == ("{not json", 1) and ms[6] == ("[x]", 0)
    assert sorted(r.value for r in scalar_readings(p).collect()) == [3000000000 - 2**32, 2147483647]
