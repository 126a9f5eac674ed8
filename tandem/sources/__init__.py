from tandem.sources.feed import kafka_source_options, read_kafka, read_lines
from tandem.sources.events import events_feed, regions_from_nation
from tandem.sources.sinks import (
    kafka_sink_options, write_console, write_csv, write_kafka,
)

__all__ = [
    "kafka_source_options", "read_kafka", "read_lines", "events_feed",
    "regions_from_nation", "kafka_sink_options", "write_console", "write_csv",
    "write_kafka",
]
