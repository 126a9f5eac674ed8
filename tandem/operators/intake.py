"""Intake of a feed: messages delivered again go, bad ones get a place of their own.

``clean_feed`` passes every message once, with the reason why no reader can
use it (null for a good one).  In a stream the result is written once
(:func:`run_intake`) and the joins read the good part of that table, so the
source is read and its state kept once, whatever the number of sensors; bad
messages lie beside it with their reason.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tandem.functions.coerce import as_text, with_once
from tandem.operators.parse import ENVELOPE

NOT_AN_OBJECT, NO_ID, NO_TYPE, NO_TIME = "not an object", "no id", "no sensor type", "no time"


def _reason(value: Column, name: str) -> Column:
    keys = F.json_object_keys(value)
    ids = [as_text(f"_j.{p}", name, f"$.{p}") for p in ("userAccount.userId", "userAccount.userEmail", "deviceId")]
    return (F.when(keys.isNull(), NOT_AN_OBJECT)
            .when(ids[0].isNull() | ids[1].isNull() | ids[2].isNull(), NO_ID)
            .when(as_text("_j.sensorType", name, "$.sensorType").isNull(), NO_TYPE)
            .when(~F.array_contains(keys, "observationTimestamp"), NO_TIME))


def tag_messages(feed: DataFrame, value_col: str = "value") -> DataFrame:
    """``feed`` with ``reason``: why no reader takes the message, or null."""
    d = with_once(feed, _j=F.from_json(F.col(value_col), ENVELOPE))
    return d.select(*feed.columns, _reason(F.col(value_col), value_col).alias("reason"))


def clean_feed(feed: DataFrame, delay: str = "1 hour", value_col: str = "value", time_col: str = "timestamp",
               also: tuple = ()) -> DataFrame:
    """Every message of ``feed`` once, with its ``reason``.

    Two messages are the same if their texts are (by SHA-256, so state holds 32
    bytes a message, not its text) and the columns ``also`` are.  In a stream a
    message delivered again within ``delay`` of the first, by ``time_col``, is
    dropped and the state of older ones goes; a message more than ``delay``
    behind the latest is late and dropped as well, so ``delay`` has to cover
    the feed's disorder and the longest time to a redelivery.  In a batch all
    repeats go.  A null message is 'not an object'."""
    ident = ["_message", *also]
    d = tag_messages(feed, value_col).withColumn("_message", F.unhex(F.sha2(F.col(value_col), 256)))
    if d.isStreaming:
        d = d.withWatermark(time_col, delay).dropDuplicatesWithinWatermark(ident)
    else:
        d = d.dropDuplicates(ident)
    return d.drop("_message")


def run_intake(cleaned: DataFrame, path: str, checkpoint: str, trigger: dict | None = None):
    """Write a cleaned stream to ``path``, good and bad messages in folders of
    their own; returns the query.  The file sink's log makes a replayed
    micro-batch count once."""
    w = (cleaned.withColumn("bad", F.col("reason").isNotNull()).writeStream.format("parquet").partitionBy("bad")
         .option("path", path).option("checkpointLocation", checkpoint).outputMode("append"))
    return (w.trigger(**trigger) if trigger else w).start()


def _intake(spark: SparkSession, path: str, streaming: bool, schema: str) -> DataFrame:
    reader = spark.readStream if streaming else spark.read
    return reader.schema(f"{schema}, reason string, bad boolean").parquet(path)


def good_messages(spark: SparkSession, path: str, streaming: bool = True,
                  schema: str = "value string, timestamp timestamp") -> DataFrame:
    """The feed that the joins read: only the good folder is scanned."""
    return _intake(spark, path, streaming, schema).where("not bad").drop("reason", "bad")


def dead_letters(spark: SparkSession, path: str, streaming: bool = False,
                 schema: str = "value string, timestamp timestamp") -> DataFrame:
    """The messages that no reader takes, with ``reason``."""
    return _intake(spark, path, streaming, schema).where("bad").drop("bad")
