"""Stream joins of dense windows: readings packed before the join.

Spark's stream-stream join reads one row of the other side's state for each
pair.  Where a key has many readings a window on both sides, that is most of
the time.  Here each task first gathers up to ``BUFFER_ROWS`` of its own
readings and sends those of one key and window together, at most ``PACK_ROWS``
a pack.  The join keeps and meets packs, and every two packs that meet are
unpacked to all their pairs.

The pairs and the time at which they come out are those of the plain join: no
reading waits for a later micro-batch, and a pack lies in one window, so the
watermark (the latest time in a pack is its event time) drops a pack exactly
when it would drop its readings.  The count of dropped rows is one of packs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tandem.session import ship_code

BUFFER_ROWS = 100_000
PACK_ROWS = 128  # two packs give at most 128 x 128 pairs at once


def _pack(t: pa.Table) -> pa.RecordBatch:
    """One row per key and window of ``t``: ``_k``, ``_us`` (latest time) and its rows, alike ones together."""
    cols = t.column_names[3:]
    t = t.append_column("_id", pc.dictionary_encode(t["_k"], null_encoding="encode").combine_chunks().indices)
    t = t.sort_by([(c, "ascending") for c in ("_id", "_win", *cols)]).combine_chunks()
    key, win = (t[c].to_numpy() for c in ("_id", "_win"))
    new = np.ones(t.num_rows, bool)
    new[1:] = (key[1:] != key[:-1]) | (win[1:] != win[:-1])
    first = np.maximum.accumulate(np.where(new, np.arange(t.num_rows), 0))
    start = np.flatnonzero((np.arange(t.num_rows) - first) % PACK_ROWS == 0)
    rows = pa.StructArray.from_arrays([t[c].combine_chunks() for c in cols], cols)
    rows = pa.ListArray.from_arrays(pa.array(np.append(start, t.num_rows), pa.int32()), rows)
    return pa.RecordBatch.from_arrays([t["_k"].take(pa.array(start)).combine_chunks(),
                                       pa.array(np.maximum.reduceat(t["_us"].to_numpy(), start)), rows], ["_k", "_us", "_rows"])


def pack_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held, n = [], 0
    for b in batches:
        if b.num_rows:
            held.append(b)
            n += b.num_rows
        if n >= BUFFER_ROWS:
            yield _pack(pa.Table.from_batches(held))
            held, n = [], 0
    if held:
        yield _pack(pa.Table.from_batches(held))


def _packed(side: DataFrame, size: str, delay: str, rows: str) -> DataFrame:
    """The readings of a side as packs: ``_k``, ``_w`` (the window) and the array ``rows``."""
    win = F.unix_millis(F.window("_et", size)["start"])
    d = side.select("_k", win.alias("_win"), F.unix_micros("_et").alias("_us"), *[c for c in side.columns if c not in ("_k", "_et")])
    struct = ", ".join(f"`{f.name}`: {f.dataType.simpleString()}" for f in d.schema.fields[3:])
    p = d.mapInArrow(pack_batches, f"_k string, _us bigint, _rows array<struct<{struct}>>")
    p = p.select("_k", F.timestamp_micros("_us").alias("_et"), F.col("_rows").alias(rows))
    p = p.withWatermark("_et", delay) if p.isStreaming else p
    return p.select("_k", rows, F.window("_et", size).alias("_w"))


def packed_join(sensor: DataFrame, gps: DataFrame, size: str, delay: str, salt: int = 1, salt_keys=None) -> DataFrame:
    """Pairs of the two sides (``_k``, ``_et`` and their own columns) in tumbling windows of ``size``."""
    from tandem.operators.windows import salted_equi_join

    ship_code(sensor.sparkSession)
    j = salted_equi_join(_packed(sensor, size, delay, "_s"), _packed(gps, size, delay, "_g"), ["_k", "_w"], salt, salt_keys)
    return j.select("_k", "_w", "_s", F.inline("_g")).select("*", F.inline("_s")).drop("_s")
