"""Feed sources: one JSON message per record in a ``value`` string column.

Both sources work for batch (``spark.read``) and streaming
(``spark.readStream``).  Kafka also gives a ``timestamp`` column (broker
time), which the weather reader can use as the ingest time.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def kafka_source_options(topic: str, bootstrap_servers: str, group_id: str | None = None,
                         starting_offsets: str | None = "latest",
                         extra: dict | None = None, min_partitions: int | None = None) -> dict:
    """Option map for the Kafka source.

    ``starting_offsets="latest"`` starts at the end of the topic.  With
    ``None`` no start is set; Spark then resumes from the offsets kept in the
    query checkpoint (its equivalent of a consumer group's committed offset).
    ``group_id`` becomes the prefix of each query's own consumer group.
    Any other consumer property can be passed in ``extra`` (``kafka.`` prefix
    is added when missing).  ``min_partitions`` splits the offset ranges of
    a topic with few partitions over more tasks (Spark's ``minPartitions``).
    """
    opts = {"kafka.bootstrap.servers": bootstrap_servers, "subscribe": topic}
    if group_id:  # a prefix: queries that share one group id would each get a part of the data
        opts["groupIdPrefix"] = group_id
    if starting_offsets is not None:
        opts["startingOffsets"] = starting_offsets
    if min_partitions:
        opts["minPartitions"] = str(min_partitions)
    for k, v in (extra or {}).items():
        opts[k if k.startswith("kafka.") or k in ("failOnDataLoss", "maxOffsetsPerTrigger",
                                                  "minPartitions", "includeHeaders", "groupIdPrefix")
             else f"kafka.{k}"] = str(v)
    return opts


def read_kafka(spark: SparkSession, topic: str, bootstrap_servers: str, *,
               group_id: str | None = None, starting_offsets: str | None = "latest",
               streaming: bool = True, extra: dict | None = None,
               min_partitions: int | None = None) -> DataFrame:
    """Kafka topic as ``value string, timestamp timestamp`` (needs the
    spark-sql-kafka package on the classpath)."""
    opts = kafka_source_options(topic, bootstrap_servers, group_id,
                                starting_offsets if streaming else None, extra, min_partitions)
    reader = spark.readStream if streaming else spark.read
    raw = reader.format("kafka").options(**opts).load()
    return raw.select(F.col("value").cast("string").alias("value"), F.col("timestamp"))


def read_lines(spark: SparkSession, path: str, *, streaming: bool = False,
               max_files_per_trigger: int | None = None) -> DataFrame:
    """Text files with one JSON message per line, as ``value string``."""
    if streaming:
        reader = spark.readStream.format("text")
        if max_files_per_trigger:
            reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
        return reader.load(path)
    return spark.read.text(path)
