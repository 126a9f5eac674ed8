"""The whole job: one feed -> GPS + every configured sensor -> windowed
join -> enrichment -> JSON messages -> one output topic.

``build_pipeline`` gives the messages as one DataFrame (batch, or a stream
per sensor); ``run_pipeline`` starts one streaming query per sensor, all
writing the same topic, with its own checkpoint under
``spark.checkpoint.dir`` so each restarts where it stopped.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tandem.operators.messages import gps_region_message, multi_message, weather_message
from tandem.operators.parse import (
    gps_readings, multi_readings, parse_feed, scalar_readings, slim_parsed, stage_parsed,
    weather_readings,
)
from tandem.operators.polygons import position_region
from tandem.operators.windows import WINDOW_KINDS, to_ms, tumbling_join, window_join
from tandem.session import checkpoint_root
from tandem.sources.feed import read_kafka
from tandem.sources.sinks import write_console, write_kafka


GPS_WITH_REGION = "TYPE_GPS_withRegion"


@dataclass(frozen=True)
class JobConfig:
    """Job parameters (what the original took on its command line)."""
    topic: str = ""                           # required for a Kafka source
    bootstrap_servers: str = "localhost:9092"
    group_id: str | None = None               # prefix of each query's consumer group
    des_topic: str = ""                       # required for the Kafka sink
    window_size: int = 2                      # seconds
    window_type: str = "Tumble"               # Tumble | Sliding | Session
    job_name: str = "SensorJoin"
    single_sensors: tuple = ("TYPE_WEATHER",)
    multi_sensors: tuple = ()                 # e.g. ("TYPE_ACCELEROMETER", "TYPE_GRAVITY")
    multi_window: str = "10000 milliseconds"  # fixed for multi-value sensors
    starting_offsets: str | None = "latest"
    kafka_extra: dict = field(default_factory=dict)
    # when set, GPS readings with their region are also published there
    gps_region_topic: str | None = None
    delay: str = "0 seconds"                  # watermark delay of both sides
    salt: int = 1                             # groups a hot key is spread over
    salt_keys: tuple = ()                     # only these join keys are salted (empty: all)
    quoted_keys: bool = False                 # wire form of the member names in multi messages

    # Parameter names of the original job; every other entry is passed on to
    # the Kafka consumer as a property (e.g. zookeeper.connect).
    PARAM_NAMES = {"topic": "topic", "bootstrap.servers": "bootstrap_servers",
                   "group.id": "group_id", "desTopic": "des_topic", "WindowSize": "window_size",
                   "WindowType": "window_type", "JobName": "job_name"}

    @classmethod
    def from_params(cls, params: dict, **overrides) -> "JobConfig":
        """Build from the original job's parameter names (values as text).
        desTopic, WindowSize, WindowType and JobName are required."""
        missing = [k for k in ("desTopic", "WindowSize", "WindowType", "JobName") if k not in params]
        if missing:
            raise ValueError(f"missing required parameters: {missing}")
        kw, extra = {}, {}
        for k, v in params.items():
            if k in cls.PARAM_NAMES:
                kw[cls.PARAM_NAMES[k]] = int(v) if k == "WindowSize" else str(v)
            else:
                extra[k] = str(v)
        kw["kafka_extra"] = extra
        kw.update(overrides)
        cfg = cls(**kw)
        cfg.validate()
        return cfg

    def validate(self) -> None:
        if self.window_type not in WINDOW_KINDS:
            raise ValueError(f"WindowType must be one of {WINDOW_KINDS}, got {self.window_type!r}")
        if self.window_size < 1 or (self.window_type == "Sliding" and self.window_size < 2):
            raise ValueError("WindowSize too small for the window type")
        to_ms(self.multi_window)
        if self.salt < 1:
            raise ValueError("salt must be at least 1")

    def sensor_types(self) -> tuple:
        return ("TYPE_GPS", *self.single_sensors, *self.multi_sensors)


def sensor_streams(parsed: DataFrame, cfg: JobConfig, regions: DataFrame | None = None,
                   ingest: str | None = None) -> list[tuple[str, DataFrame]]:
    """(name, message frame) for every configured sensor, plus
    (GPS_WITH_REGION, ...) when ``cfg.gps_region_topic`` is set."""
    cfg.validate()
    gps = gps_readings(parsed)
    if regions is not None:
        gps = position_region(gps, regions)
    out = []
    spread = {"delay": cfg.delay, "salt": cfg.salt, "salt_keys": cfg.salt_keys or None}
    for t in cfg.single_sensors:
        pairs = window_join(cfg.window_type, weather_readings(parsed, t, ingest=ingest), gps,
                            cfg.window_size, **spread)
        out.append((t, weather_message(pairs, job_name=cfg.job_name,
                                       window_type=cfg.window_type,
                                       window_size=cfg.window_size)))
    for t in cfg.multi_sensors:
        pairs = tumbling_join(multi_readings(parsed, t), gps, cfg.multi_window, **spread)
        out.append((t, multi_message(pairs, quoted_keys=cfg.quoted_keys)))
    if cfg.gps_region_topic:
        out.append((GPS_WITH_REGION, gps_region_message(gps)))
    return out


def pipeline_outputs(feed: DataFrame, cfg: JobConfig, regions: DataFrame | None = None,
                     ingest: str | None = None, stage: bool = True) -> dict[str, DataFrame]:
    """Messages of a batch feed by output topic: the joined sensors on
    ``cfg.des_topic`` and, when configured, GPS readings with their region on
    ``cfg.gps_region_topic`` (one frame if both name the same topic).

    With ``stage`` the feed is decoded once and written partitioned by
    sensor type (``stage_parsed``); GPS and every sensor then read their own
    partition instead of decoding the whole feed again."""
    parsed = parse_feed(feed)
    if stage and not parsed.isStreaming:
        parsed = stage_parsed(parsed, types=cfg.sensor_types())
    out: dict[str, DataFrame] = {}
    for name, df in sensor_streams(parsed, cfg, regions, ingest):
        topic = cfg.gps_region_topic if name == GPS_WITH_REGION else cfg.des_topic
        out[topic] = out[topic].unionByName(df) if topic in out else df
    if not out:
        raise ValueError("no sensors configured")
    return out


def build_pipeline(feed: DataFrame, cfg: JobConfig, regions: DataFrame | None = None,
                   ingest: str | None = None, stage: bool = True) -> DataFrame:
    """All messages of all outputs of a batch feed as one ``value`` frame."""
    outputs = list(pipeline_outputs(feed, cfg, regions, ingest, stage).values())
    out = outputs[0]
    for df in outputs[1:]:
        out = out.unionByName(df)
    return out


def start_decoder(source: DataFrame, path: str, checkpoint: str, trigger: dict | None = None,
                  types: tuple | None = None):
    """Streaming counterpart of ``stage_parsed``: one query decodes the feed
    and appends it as parquet partitioned by ``sensorType``.  Returns the
    query; ``decoded_stream`` reads the table back as a stream."""
    parsed = parse_feed(source)
    if types is not None:
        parsed = parsed.where(F.col("sensorType").isin(list(types)))
    w = (slim_parsed(parsed).writeStream.format("parquet").partitionBy("sensorType")
         .option("path", path).option("checkpointLocation", checkpoint).outputMode("append"))
    if trigger:
        w = w.trigger(**trigger)
    return w.start()


def decoded_stream(spark: SparkSession, path: str, source: DataFrame) -> DataFrame:
    """The decoded table written by ``start_decoder`` as a stream, with the
    decoded schema of ``source`` (partition pruning on ``sensorType``)."""
    schema = parse_feed(source).schema
    return spark.readStream.schema(schema).parquet(path).select(*schema.fieldNames())


def run_pipeline(spark: SparkSession, cfg: JobConfig, *, source: DataFrame | None = None,
                 regions: DataFrame | None = None, ingest: str | None = "timestamp",
                 sink: Callable[[DataFrame, str, str], object] | None = None,
                 checkpoint_dir: str | None = None, staged: bool = False,
                 decoded: DataFrame | None = None) -> list:
    """Start one streaming query per sensor; return the queries.

    ``source`` defaults to the Kafka topic (``value``, ``timestamp``);
    ``sink(messages, name, checkpoint)`` defaults to the Kafka output topic.
    ``ingest`` names the source column used as ingest time (the broker
    timestamp by default; None = time of processing).  Checkpoints go to
    ``checkpoint_dir/<sensor>`` (default: ``<spark.checkpoint.dir>/<job>``),
    a fixed place so that a restarted job resumes each query.

    Each sensor query decodes the feed itself (lowest latency).  With
    ``staged`` one more query decodes it once into a parquet table under
    the checkpoint folder and the sensor queries stream from that table
    (each message decoded once instead of once per sensor, one more hop of
    latency).  ``decoded`` passes such a decoded stream in directly.
    """
    root = (checkpoint_dir or f"{checkpoint_root(spark).rstrip('/')}/{cfg.job_name}").rstrip("/")
    queries = []
    if decoded is None:
        if source is None:
            if not cfg.topic:
                raise ValueError("a Kafka source needs a topic")
            source = read_kafka(spark, cfg.topic, cfg.bootstrap_servers, group_id=cfg.group_id,
                                starting_offsets=cfg.starting_offsets, extra=cfg.kafka_extra)
        if staged:
            queries.append(start_decoder(source, f"{root}/decoded", f"{root}/decoder",
                                         types=cfg.sensor_types()))
            decoded = decoded_stream(spark, f"{root}/decoded", source)
        else:
            decoded = parse_feed(source)
    for t, msgs in sensor_streams(decoded, cfg, regions, ingest):
        name = f"{cfg.job_name}-{t}"
        ckpt = f"{root}/{t}"
        if sink is None:
            topic = cfg.gps_region_topic if t == GPS_WITH_REGION else cfg.des_topic
            queries.append(write_kafka(msgs, topic, cfg.bootstrap_servers,
                                       checkpoint=ckpt, query_name=name))
        else:
            queries.append(sink(msgs, name, ckpt))
    return queries


def proximity_pairs(parsed: DataFrame, window="10000 milliseconds",
                    sensor_type: str = "TYPE_PROXIMITY") -> DataFrame:
    """Scalar readings x GPS positions of the same (trimmed) device in fixed
    tumbling windows (10 s in the original job)."""
    return tumbling_join(scalar_readings(parsed, sensor_type), gps_readings(parsed, by_device=True),
                         window)


def run_proximity_job(spark: SparkSession, cfg: JobConfig, *, source: DataFrame | None = None,
                      window="10000 milliseconds", sink: Callable | None = None,
                      checkpoint_dir: str | None = None):
    """The proximity job: one streaming query printing the pairs (or handing
    them to ``sink(pairs, name, checkpoint)``, e.g. ``write_csv``)."""
    if source is None:
        source = read_kafka(spark, cfg.topic, cfg.bootstrap_servers, group_id=cfg.group_id,
                            starting_offsets=None, extra=cfg.kafka_extra)
    pairs = proximity_pairs(parse_feed(source), window)
    root = (checkpoint_dir or f"{checkpoint_root(spark).rstrip('/')}/{cfg.job_name}").rstrip("/")
    ckpt = f"{root}/TYPE_PROXIMITY"
    if sink is None:
        return write_console(pairs, checkpoint=ckpt)
    return sink(pairs, f"{cfg.job_name}-TYPE_PROXIMITY", ckpt)
