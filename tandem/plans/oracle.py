"""Oracle SQL (DuckDB dialect) for the registered queries.

The readings are derived straight from ``events`` with the same integer
rules as ``tandem.sources.events`` - no JSON detour - so these statements
check the Spark parsers, joins and enrichment independently.
"""

from __future__ import annotations

from tandem.sources.events import CHANGE_MS, OUTLINE

DAY_MS = 86_400_000
QUARTER_DAY_MS = 21_600_000
HALF_QUARTER_MS = 10_800_000
HALF_HOUR_MS = 1_800_000

_BASE = """
ev AS (
  SELECT event_id AS eid, user_id AS uid, ts,
         CAST(round(value * 100) AS BIGINT) AS cents,
         CAST(regexp_extract(props, '([0-9]+)', 1) AS INTEGER) AS k,
         CASE event_type WHEN 'view' THEN 'TYPE_GPS' WHEN 'purchase' THEN 'TYPE_WEATHER'
              WHEN 'signup' THEN 'TYPE_WEATHER' WHEN 'error' THEN 'TYPE_ACCELEROMETER'
              WHEN 'click' THEN 'TYPE_PROXIMITY' END AS sensorType,
         CAST(epoch_us(ts) // 1000 AS BIGINT) AS obs_ms
  FROM events
),
feed AS (
  SELECT *, 'u' || CAST(uid AS VARCHAR)
              || CASE WHEN sensorType <> 'TYPE_GPS' AND eid % 7 = 0 THEN ' ' ELSE '' END AS userId,
         'u' || CAST(uid AS VARCHAR) || '@example.org' AS userEmail,
         'd' || CAST(uid % 40 AS VARCHAR) AS deviceId
  FROM ev
),
good AS (SELECT * FROM feed WHERE eid % 97 <> 0 AND eid % 89 <> 0 AND sensorType IS NOT NULL),
gps AS (
  SELECT userId, userEmail, deviceId, sensorType,
         CAST(CAST(53000 + k * 5 AS DOUBLE) / 1000 AS FLOAT) AS lat,
         CAST(CAST(-9500 + (eid % 50) * 10 AS DOUBLE) / 1000 AS FLOAT) AS lng, obs_ms
  FROM good WHERE sensorType = 'TYPE_GPS'
),
weather AS (
  SELECT userId, userEmail, deviceId, sensorType,
         CAST(15 + cents % 30 AS INTEGER) AS temp,
         CAST(5 + (cents // 7) % 60 AS INTEGER) AS humd,
         CAST(100 + ((cents // 11) % 10) * ((cents // 11) % 10) * 70 AS INTEGER) AS CO2,
         CAST(((cents // 13) % 8) * ((cents // 13) % 8) AS INTEGER) AS CO,
         CAST(hour(ts) AS INTEGER) AS hour, obs_ms, obs_ms AS ingest_ms
  FROM good WHERE sensorType = 'TYPE_WEATHER'
),
multi AS (
  SELECT userId, userEmail, deviceId, sensorType,
         'x' AS name1, CAST(CAST(cents AS DOUBLE) / 128 AS FLOAT) AS value1,
         'y' AS name2, CAST(CAST(k AS DOUBLE) / 8 AS FLOAT) AS value2,
         'z' AS name3, CAST(CAST(-(cents % 1000) AS DOUBLE) / 16 AS FLOAT) AS value3, obs_ms
  FROM good WHERE sensorType = 'TYPE_ACCELEROMETER'
),
scalar AS (
  SELECT deviceId, sensorType, CAST(cents % 10 AS INTEGER) AS value, obs_ms
  FROM good WHERE sensorType = 'TYPE_PROXIMITY'
),
regions AS (
  SELECT n_name AS region,
         CAST(53000 + (n_nationkey % 5) * 80 AS DOUBLE) / 1000 AS min_lat,
         CAST(53000 + (n_nationkey % 5) * 80 + 80 AS DOUBLE) / 1000 AS max_lat,
         CAST(-9500 + (n_nationkey // 5) * 80 AS DOUBLE) / 1000 AS min_lng,
         CAST(-9500 + (n_nationkey // 5) * 80 + 80 AS DOUBLE) / 1000 AS max_lng
  FROM nation
),
gps_region AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT g.*, coalesce(r.region, '') AS region,
           row_number() OVER (PARTITION BY g.rid ORDER BY
               (r.max_lat - r.min_lat) * (r.max_lng - r.min_lng), r.region) AS rn
    FROM (SELECT *, row_number() OVER () AS rid FROM gps) g
    LEFT JOIN regions r
      ON CAST(g.lat AS DOUBLE) >= r.min_lat AND CAST(g.lat AS DOUBLE) < r.max_lat
     AND CAST(g.lng AS DOUBLE) >= r.min_lng AND CAST(g.lng AS DOUBLE) < r.max_lng
  ) WHERE rn = 1
)"""

TRIM = "regexp_replace({c}, '^[\\x00-\\x20]+|[\\x00-\\x20]+$', '', 'g')"

WEATHER_PAIR_COLS = """g.userId, g.userEmail, g.deviceId,
       'TYPE_Join_' || substr(w.sensorType, 6) || '_' || substr(g.sensorType, 6) AS sensorType,
       g.lat, g.lng, w.temp, w.humd, w.CO2, w.CO, w.hour, w.obs_ms, w.ingest_ms"""


def _with(body: str) -> str:
    return f"WITH {_BASE}\n{body}"


def tumbling_weather(size_ms: int, gps_table: str = "gps", extra: str = "",
                     where: str = "") -> str:
    return f"""
SELECT {WEATHER_PAIR_COLS}{extra},
       CAST(w.ingest_ms // {size_ms} * {size_ms} AS BIGINT) AS window_start_ms,
       CAST(w.ingest_ms // {size_ms} * {size_ms} + {size_ms} AS BIGINT) AS window_end_ms
FROM weather w JOIN {gps_table} g
  ON {TRIM.format(c='w.userId')} = g.userId
 AND w.ingest_ms // {size_ms} = g.obs_ms // {size_ms}
{where}"""


def sliding_weather(size_ms: int, slide_ms: int) -> str:
    return f"""
SELECT {WEATHER_PAIR_COLS},
       CAST(w.i * {slide_ms} AS BIGINT) AS window_start_ms,
       CAST(w.i * {slide_ms} + {size_ms} AS BIGINT) AS window_end_ms
FROM (SELECT *, unnest(generate_series((ingest_ms - {size_ms}) // {slide_ms} + 1,
                                       ingest_ms // {slide_ms})) AS i FROM weather) w
JOIN (SELECT *, unnest(generate_series((obs_ms - {size_ms}) // {slide_ms} + 1,
                                       obs_ms // {slide_ms})) AS i FROM gps) g
  ON {TRIM.format(c='w.userId')} = g.userId AND w.i = g.i"""


def session_ctes(gap_ms: int) -> str:
    """Sessions over both sides of a key: a new one after a step > gap."""
    return f"""
, wk AS (SELECT *, {TRIM.format(c='userId')} AS _k, row_number() OVER () AS rid FROM weather),
gk AS (SELECT *, userId AS _k, row_number() OVER () AS rid FROM gps),
tagged AS (
  SELECT _k, ingest_ms AS t, 'S' AS side, rid FROM wk
  UNION ALL SELECT _k, obs_ms AS t, 'G' AS side, rid FROM gk
),
stepped AS (
  SELECT *, CASE WHEN lag(t) OVER (PARTITION BY _k ORDER BY t) IS NULL
                   OR t - lag(t) OVER (PARTITION BY _k ORDER BY t) > {gap_ms}
                 THEN 1 ELSE 0 END AS new_s
  FROM tagged
),
sess AS (
  SELECT *, sum(new_s) OVER (PARTITION BY _k ORDER BY t
                             ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS sid
  FROM stepped
),
bounds AS (SELECT _k, sid, min(t) AS s_start, max(t) + {gap_ms} AS s_end FROM sess GROUP BY _k, sid)"""


SESSION_SELECT = f"""
SELECT {WEATHER_PAIR_COLS},
       CAST(b.s_start AS BIGINT) AS window_start_ms, CAST(b.s_end AS BIGINT) AS window_end_ms
FROM sess ss JOIN wk w ON ss.side = 'S' AND ss.rid = w.rid
JOIN sess sg ON sg.side = 'G' AND sg._k = ss._k AND sg.sid = ss.sid
JOIN gk g ON g.rid = sg.rid
JOIN bounds b ON b._k = ss._k AND b.sid = ss.sid"""


def _fire_alert_case(strict: bool) -> str:
    j = " AND " if strict else " OR "
    yellow = j.join(["(temp >= 30 AND temp < 37)", "(humd > 20 AND humd <= 30)",
                     "(CO2 >= 350 AND CO2 < 2000)", "(CO >= 10 AND CO < 25)"])
    orange = j.join(["(temp >= 37 AND temp < 40)", "(humd > 10 AND humd <= 20)",
                     "(CO2 >= 2000 AND CO2 < 5000)", "(CO >= 25 AND CO < 50)"])
    red = ("temp >= 40 AND humd <= 10 AND CO2 >= 5000 AND CO >= 50" if strict
           else "(temp >= 40 AND humd <= 10) OR (CO2 >= 5000 AND CO >= 50)")
    return (f"CASE WHEN temp < 30 AND humd > 30 AND CO2 < 350 AND CO < 10 THEN 'Green' "
            f"WHEN {yellow} THEN 'Yellow' WHEN {orange} THEN 'Orange' "
            f"WHEN {red} THEN 'Red' ELSE '' END")


def _alerts(strict: bool) -> str:
    return _with(f"SELECT userId, deviceId, obs_ms, temp, humd, CO2, CO, "
                 f"{_fire_alert_case(strict)} AS fire_alert FROM weather")


ORACLE_SQL: dict[str, str] = {
    "parse_feed": _with("""
SELECT CASE WHEN eid % 89 = 0 THEN NULL ELSE userId END AS userId,
       CASE WHEN eid % 89 = 0 THEN NULL ELSE userEmail END AS userEmail,
       deviceId, sensorType, obs_ms,
       CASE sensorType WHEN 'TYPE_GPS' THEN 'attr_lat,attr_lng'
                       WHEN 'TYPE_WEATHER' THEN 'temp,humd,CO2,CO,hour'
                       WHEN 'TYPE_ACCELEROMETER' THEN 'x,y,z' END AS sv_keys
FROM feed WHERE eid % 97 <> 0"""),
    "bad_records": _with("""
SELECT '{"userAccount":{"userId":"' || userId || '","userEmail":"' || userEmail
       || '"},"deviceId":"' || deviceId || '"' AS value
FROM feed WHERE eid % 97 = 0"""),
    "gps_readings": _with("SELECT * FROM gps"),
    "gps_readings_by_device": _with("SELECT deviceId, sensorType, lat, lng, obs_ms FROM gps"),
    "weather_readings": _with("SELECT * FROM weather"),
    "multi_readings": _with("SELECT * FROM multi"),
    "scalar_readings": _with("SELECT * FROM scalar"),
    "tumbling_join_weather": _with(tumbling_weather(DAY_MS)),
    "tumbling_join_multi": _with(f"""
SELECT g.userId, g.userEmail, g.deviceId,
       'TYPE_Join_' || substr(m.sensorType, 6) || '_' || substr(g.sensorType, 6) AS sensorType,
       g.lat, g.lng, m.name1, m.value1, m.name2, m.value2, m.name3, m.value3, g.obs_ms,
       CAST(m.obs_ms // {DAY_MS} * {DAY_MS} AS BIGINT) AS window_start_ms,
       CAST(m.obs_ms // {DAY_MS} * {DAY_MS} + {DAY_MS} AS BIGINT) AS window_end_ms
FROM multi m JOIN gps g ON m.userId = g.userId AND m.obs_ms // {DAY_MS} = g.obs_ms // {DAY_MS}"""),
    "tumbling_join_scalar": _with(f"""
SELECT g.deviceId, g.sensorType, g.lat, g.lng, s.value, g.obs_ms,
       CAST(s.obs_ms // {DAY_MS} * {DAY_MS} AS BIGINT) AS window_start_ms,
       CAST(s.obs_ms // {DAY_MS} * {DAY_MS} + {DAY_MS} AS BIGINT) AS window_end_ms
FROM scalar s JOIN gps g
  ON {TRIM.format(c='s.deviceId')} = g.deviceId AND s.obs_ms // {DAY_MS} = g.obs_ms // {DAY_MS}"""),
    "sliding_join_weather": _with(sliding_weather(QUARTER_DAY_MS, HALF_QUARTER_MS)),
    "sliding_join_panes": _with(sliding_weather(QUARTER_DAY_MS, HALF_HOUR_MS)),
    "joined_by_device": _with(f"""
SELECT {TRIM.format(c='g.deviceId')} AS deviceId, count(*) AS n_pairs, CAST(sum(s.value) AS BIGINT) AS value_sum,
       min(s.value) AS value_min, max(s.value) AS value_max, min(g.lat) AS lat_min, max(g.lat) AS lat_max,
       min(g.lng) AS lng_min, max(g.lng) AS lng_max, min(g.obs_ms) AS first_obs_ms, max(g.obs_ms) AS last_obs_ms,
       CAST(s.obs_ms // {DAY_MS} * {DAY_MS} AS BIGINT) AS window_start_ms,
       CAST(s.obs_ms // {DAY_MS} * {DAY_MS} + {DAY_MS} AS BIGINT) AS window_end_ms
FROM scalar s JOIN gps g
  ON {TRIM.format(c='s.deviceId')} = g.deviceId AND s.obs_ms // {QUARTER_DAY_MS} = g.obs_ms // {QUARTER_DAY_MS}
GROUP BY {TRIM.format(c='g.deviceId')}, s.obs_ms // {DAY_MS}"""),
    "session_join_weather": f"WITH {_BASE}{session_ctes(QUARTER_DAY_MS)}{SESSION_SELECT}",
    "fire_alert": _alerts(False),
    "fire_alert_strict": _alerts(True),
    "region_lookup": _with("SELECT userId, deviceId, obs_ms, lat, lng, region FROM gps_region"),
    "weather_message": _with(f"""
SELECT 'SensorJoin' AS JobName, 'Tumble' AS WindowType, '{DAY_MS // 1000}' AS WindowSize,
       p.userId, p.userEmail, p.deviceId, p.sensorType, p.lat AS attr_lat, p.lng AS attr_lng,
       p.hour AS Hour, p.temp AS Temperature, p.humd AS Humidity, p.CO2, p.CO,
       p.region AS regoin, {_fire_alert_case(False)} AS FireAlert,
       p.obs_ms AS ObservationTimestamp, p.ingest_ms AS IngestTime
FROM ({tumbling_weather(DAY_MS, 'gps_region', ', g.region')}) p"""),
    "multi_message": _with(f"""
SELECT g.userId, g.userEmail, g.deviceId,
       'TYPE_Join_' || substr(m.sensorType, 6) || '_' || substr(g.sensorType, 6) AS sensorType,
       m.value1 AS x, m.value2 AS y, m.value3 AS z, g.lat AS attr_lat, g.lng AS attr_lng,
       g.region AS regoin, g.obs_ms AS observationTimestamp
FROM multi m JOIN gps_region g
  ON m.userId = g.userId AND m.obs_ms // {DAY_MS} = g.obs_ms // {DAY_MS}"""),
    "gps_region_message": _with("""
SELECT userId, userEmail, deviceId, sensorType || '_withRegion' AS sensorType,
       lat AS attr_lat, lng AS attr_lng, region AS regoin
FROM gps_region"""),
}



def _outline_edges() -> str:
    """VALUES rows (y1, x1, y2, x2) of the outline's edges, in thousandths, lower end first."""
    rows = [(*min(p, q), *max(p, q)) for ring in OUTLINE for p, q in zip(ring, ring[1:] + ring[:1]) if p[0] != q[0]]
    return ", ".join(str(r) for r in rows)


def region_polygons(changes: bool) -> str:
    """The region of every GPS reading by a ray over all edges of all regions."""
    ys, xs = zip(*(p for ring in OUTLINE for p in ring))
    versions = f"""SELECT *, 0 AS move, CAST(NULL AS BIGINT) AS from_ms, CASE WHEN n_nationkey % 2 = 0 THEN {CHANGE_MS} END AS to_ms FROM nation
    UNION ALL SELECT *, 40, {CHANGE_MS}, NULL FROM nation WHERE n_nationkey % 2 = 0"""
    always = "SELECT *, 0 AS move, CAST(NULL AS BIGINT) AS from_ms, CAST(NULL AS BIGINT) AS to_ms FROM nation"

    def corner(base: str, c: str) -> str:
        return f"CAST({base} + {c} * (1 + n_nationkey % 3) AS DOUBLE) / 1000"

    return _with(f"""
, v AS (
  SELECT n_name AS region, n_nationkey, from_ms, to_ms, 53000 + (n_nationkey % 5) * 80 + move AS lat0,
         -9500 + (n_nationkey // 5) * 80 AS lng0
  FROM ({versions if changes else always})
), e AS (
  SELECT region, from_ms, to_ms, {corner('lat0', 'y1')} AS y1, {corner('lng0', 'x1')} AS x1,
         {corner('lat0', 'y2')} AS y2, {corner('lng0', 'x2')} AS x2,
         round(({corner('lat0', str(max(ys)))} - {corner('lat0', str(min(ys)))})
               * ({corner('lng0', str(max(xs)))} - {corner('lng0', str(min(xs)))}), 9) AS area
  FROM v, (VALUES {_outline_edges()}) o(y1, x1, y2, x2)
), g AS (SELECT *, row_number() OVER () AS rid, CAST(lat AS DOUBLE) AS y, CAST(lng AS DOUBLE) AS x FROM gps),
inside AS (
  SELECT rid, region, area FROM g JOIN e
    ON y >= y1 AND y < y2 AND x < x1 + (y - y1) * (x2 - x1) / (y2 - y1)
   AND (from_ms IS NULL OR obs_ms >= from_ms) AND (to_ms IS NULL OR obs_ms < to_ms)
  GROUP BY rid, region, from_ms, area HAVING count(*) % 2 = 1
), best AS (SELECT rid, arg_min(region, (area, region)) AS region FROM inside GROUP BY rid)
SELECT userId, deviceId, obs_ms, lat, lng, coalesce(region, '') AS region FROM g LEFT JOIN best USING (rid)""")


ORACLE_SQL["region_polygons"] = region_polygons(False)
ORACLE_SQL["region_versions"] = region_polygons(True)
ORACLE_SQL["window_join_dispatch"] = f"""WITH {_BASE}{session_ctes(QUARTER_DAY_MS)}
SELECT 'Tumble' AS kind, * FROM ({tumbling_weather(QUARTER_DAY_MS)})
UNION ALL SELECT 'Sliding' AS kind, * FROM ({sliding_weather(QUARTER_DAY_MS, HALF_QUARTER_MS)})
UNION ALL SELECT 'Session' AS kind, * FROM ({SESSION_SELECT})"""

ORACLE_SQL["job_messages"] = _with(f"""
SELECT p.sensorType, p.userId, p.userEmail, p.deviceId, p.lat AS attr_lat, p.lng AS attr_lng,
       p.region AS regoin, p.obs_ms
FROM ({tumbling_weather(DAY_MS, 'gps_region', ', g.region')}) p
UNION ALL
SELECT 'TYPE_Join_' || substr(m.sensorType, 6) || '_' || substr(g.sensorType, 6) AS sensorType,
       g.userId, g.userEmail, g.deviceId, g.lat AS attr_lat, g.lng AS attr_lng,
       g.region AS regoin, g.obs_ms
FROM multi m JOIN gps_region g
  ON m.userId = g.userId AND m.obs_ms // {DAY_MS} = g.obs_ms // {DAY_MS}
UNION ALL
SELECT sensorType || '_withRegion' AS sensorType, userId, userEmail, deviceId, lat AS attr_lat, lng AS attr_lng,
       region AS regoin, CAST(0 AS BIGINT) AS obs_ms
FROM gps_region""")

# Late rows: the later half (from the midpoint of the time range) is
# replayed first; the earlier half then arrives behind the watermark and is
# dropped, so only pairs whose readings are both in the later half remain.
ORACLE_SQL["stream_late_rows"] = _with(tumbling_weather(
    DAY_MS, where="WHERE w.ingest_ms >= (SELECT (min(obs_ms) + max(obs_ms)) // 2 FROM ev)\n"
                  "  AND g.obs_ms >= (SELECT (min(obs_ms) + max(obs_ms)) // 2 FROM ev)"))

# Late readings: after the later half the watermark stands at the last reading
# of the job's types; a reading of the earlier half is late if its day is over.
ORACLE_SQL["stream_late_readings"] = _with(f"""
, readings AS (
  SELECT userId, deviceId, sensorType, obs_ms FROM gps UNION ALL SELECT userId, deviceId, sensorType, obs_ms FROM weather
  UNION ALL SELECT userId, deviceId, sensorType, obs_ms FROM multi
)
SELECT userId, deviceId, sensorType, obs_ms FROM readings
WHERE obs_ms < (SELECT (min(obs_ms) + max(obs_ms)) // 2 FROM ev)
  AND (obs_ms // {DAY_MS} + 1) * {DAY_MS} <= (SELECT max(obs_ms) FROM readings)""")

ORACLE_SQL["stream_dead_letters"] = _with("""
SELECT deviceId, obs_ms AS ms, CASE WHEN eid % 97 = 0 THEN 'not an object' ELSE 'no id' END AS reason
FROM feed WHERE eid % 97 = 0 OR eid % 89 = 0""")
