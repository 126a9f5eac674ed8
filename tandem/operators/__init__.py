from tandem.operators.parse import (
    bad_records, gps_readings, multi_readings, parse_feed, scalar_readings,
    weather_readings,
)

__all__ = [
    "bad_records", "gps_readings", "multi_readings", "parse_feed",
    "scalar_readings", "weather_readings",
]
