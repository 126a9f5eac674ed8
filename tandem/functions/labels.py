"""Joined-stream type label."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def join_type_label(sensor_type, gps_type) -> Column:
    """'TYPE_Join_' + sensor type without its first 5 chars + '_' + same for GPS,
    e.g. TYPE_WEATHER x TYPE_GPS -> TYPE_Join_WEATHER_GPS."""
    s = F.col(sensor_type) if isinstance(sensor_type, str) else sensor_type
    g = F.col(gps_type) if isinstance(gps_type, str) else gps_type
    return F.concat(F.lit("TYPE_Join_"), F.substring(s, 6, 1 << 30), F.lit("_"),
                    F.substring(g, 6, 1 << 30))
