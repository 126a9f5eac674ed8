"""Joined rows grouped again: by device (or another id), in event-time windows.

The key of the joined row is its device id without blanks at the ends.  In a
stream this is a second stateful operator behind the join: the join's window
column carries the watermark on (``keep_window=True``), and a group comes out
once the watermark has passed the end of its window.  In batch it is one partial
aggregate and one shuffle of groups, whatever the number of pairs of a device.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tandem.functions.coerce import java_trim
from tandem.operators.windows import to_ms


def joined_by(pairs: DataFrame, size, *, by: str = "deviceId", values: tuple = ("value",)) -> DataFrame:
    """``pairs`` of a fixed-window join (made with ``keep_window=True``) per
    trimmed ``by`` and tumbling window of ``size``: the number of pairs, sum,
    least and greatest of each of ``values``, the box of the positions, and the
    first and last observation.

    A pair lies in the window that holds the end of its join window (its last
    microsecond), so ``size`` is best a multiple of the join's."""
    if "window" not in pairs.columns:
        raise ValueError("make the pairs with keep_window=True")
    size_ms = to_ms(size)
    if size_ms < 1:
        raise ValueError("window size must be positive")
    # the end of the join window is the event time of a pair
    timed = pairs.withColumn("_end", F.window_time("window")).drop("window", "window_start", "window_end")
    parts = [F.count(F.lit(1)).alias("n_pairs")]
    for v in values:
        parts += [F.sum(v).alias(f"{v}_sum"), F.min(v).alias(f"{v}_min"), F.max(v).alias(f"{v}_max")]
    for c in ("lat", "lng"):
        parts += [F.min(c).alias(f"{c}_min"), F.max(c).alias(f"{c}_max")]
    parts += [F.min("obsTs").alias("first_obs"), F.max("obsTs").alias("last_obs")]
    out = timed.groupBy(java_trim(by).alias(by), F.window("_end", f"{size_ms} milliseconds").alias("_g")).agg(*parts)
    return out.select(by, *[c for c in out.columns if c not in (by, "_g")],
                      F.col("_g.start").alias("window_start"), F.col("_g.end").alias("window_end"))


def joined_by_device(pairs: DataFrame, size, values: tuple = ("value",)) -> DataFrame:
    return joined_by(pairs, size, by="deviceId", values=values)
