"""tandem - windowed joins of sensor feeds with GPS positions on Spark.

A mixed JSON feed (Kafka, files or a table) is decoded once, split into
typed readings, and each sensor stream is inner-joined to the same user's or
device's GPS positions in tumbling, sliding or session event-time windows.
Pairs can be given a region name and a fire-alert colour and written out as
JSON.  Everything works on batch and streaming DataFrames.
"""

from tandem.functions import fire_alert, java_trim, join_type_label
from tandem.operators.parse import (
    bad_records, gps_readings, multi_readings, parse_feed, scalar_readings,
    weather_readings,
)
from tandem.operators.windows import (
    MULTI_PAIR, SCALAR_PAIR, WEATHER_PAIR, session_join, sliding_join,
    tumbling_join, window_join,
)
from tandem.operators.polygons import polygon_lookup
from tandem.operators.region import region_lookup
from tandem.operators.messages import gps_region_message, multi_message, weather_message
from tandem.session import checkpoint_root, get_session

__all__ = [
    "fire_alert", "java_trim", "join_type_label", "bad_records", "gps_readings",
    "multi_readings", "parse_feed", "scalar_readings", "weather_readings",
    "MULTI_PAIR", "SCALAR_PAIR", "WEATHER_PAIR", "session_join", "sliding_join",
    "tumbling_join", "window_join", "polygon_lookup", "region_lookup",
    "gps_region_message",
    "multi_message", "weather_message", "checkpoint_root", "get_session",
]
