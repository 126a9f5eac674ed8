"""Sliding-window join that keeps every reading once.

The plain sliding join copies both sides into each of the size / slide windows a
reading lies in and finds a pair once a window.  Here time is cut into panes as
long as a window.  Two readings that share a window lie in the same or in
neighbouring panes, so a sensor reading goes to its own pane and a GPS reading to
its own and both neighbours: one and three rows, whatever the slide.  Each pair is
found once; the windows it shares follow from the two times and are listed only
then, behind the join.  Batch only; the shared streaming job keeps its readings
once as well.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _div(x: Column, n: int) -> Column:
    """Floor of x / n of whole numbers, also below zero."""
    return ((x - F.pmod(x, F.lit(n))) / n).cast("long")


def pane_pairs(s: DataFrame, g: DataFrame, size_ms: int, slide_ms: int, salt: int = 1, salt_keys=None) -> DataFrame:
    """``s`` and ``g`` carry ``_k``, ``_et`` and their own columns; the result has
    ``window_start``, ``window_end`` and both sides' columns, one row per pair
    and window they share."""
    from tandem.operators.windows import salted_equi_join

    size, slide = size_ms * 1000, slide_ms * 1000
    micros = F.unix_micros("_et")
    left = s.select("*", micros.alias("_st"), _div(micros, size).alias("_pane")).drop("_et")
    own = _div(micros, size)
    right = g.select("*", micros.alias("_gt"), F.explode(F.array(own - 1, own, own + 1)).alias("_pane")).drop("_et")
    j = salted_equi_join(left, right, ["_k", "_pane"], salt, salt_keys)
    first = _div(F.greatest("_st", "_gt") - size, slide) + 1
    last = _div(F.least("_st", "_gt"), slide)
    j = j.where(first <= last).select("*", F.explode(F.sequence(first, last)).alias("_i"))
    return (j.withColumn("window_start", F.timestamp_micros(F.col("_i") * slide))
            .withColumn("window_end", F.timestamp_micros(F.col("_i") * slide + size))
            .drop("_st", "_gt", "_pane", "_i"))
