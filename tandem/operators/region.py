"""Region name for a position, from a table of region boxes.

Regions: ``region string, min_lat, max_lat, min_lng, max_lng`` (half-open
boxes [min, max)).  Every input row gets exactly one name: the smallest box
containing the point, ties broken by name; '' when no box holds it.

The boxes are indexed by a multi-level grid.  Level ``l`` has square cells
of ``top_cell_deg / 2**l`` degrees; each box is listed at the finest level
whose cell is at least as large as the box, so it touches at most 2 x 2
cells there (a box larger than the top cell touches a few more).  One row
per (level, cell) holds that cell's boxes, so a cell only lists boxes of
about its own size: a city's many small districts and a country's box sit
at different levels, and a point in a dense city checks a short list.

A point probes one cell per level present in the table: one left
equi-join per level on the integer cell (no range or cross join), then the
box test runs on the candidates.  The index is broadcast only after its
size in bytes is checked against ``broadcast_max_bytes``; above that every
level is a shuffle join on the cell.

The index is written once to the shared folder (``build_region_index``) and
read from there by every level, micro-batch and query.  Refresh rule: an index
is a snapshot of the region table; after the table has changed, build a new
one and restart the streams that use it.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tandem.session import scratch_path

REGION_COLS = ("region", "min_lat", "max_lat", "min_lng", "max_lng")
BOX_FIELDS = ("area", "region", "min_lat", "max_lat", "min_lng", "max_lng")


def _cell_size(top_cell_deg: float, level) -> F.Column:
    return F.lit(float(top_cell_deg)) / F.pow(F.lit(2.0), level)


def region_cells(regions: DataFrame, top_cell_deg: float = 16.0, max_level: int = 20) -> DataFrame:
    """``_lvl, _cy, _cx, _boxes`` - the multi-level grid index."""
    r = regions.select(
        F.col("region"),
        *[F.col(x).cast("double").alias(x) for x in REGION_COLS[1:]],
    ).where(F.col("min_lat") < F.col("max_lat")).where(F.col("min_lng") < F.col("max_lng"))
    extent = F.greatest(F.col("max_lat") - F.col("min_lat"), F.col("max_lng") - F.col("min_lng"))
    # finest level whose cell is at least the box's extent
    level = F.least(F.lit(max_level), F.greatest(
        F.lit(0), F.floor(F.log2(F.lit(float(top_cell_deg)) / extent)))).cast("int")
    r = r.select("*", ((F.col("max_lat") - F.col("min_lat"))
                       * (F.col("max_lng") - F.col("min_lng"))).alias("area"),
                 level.alias("_lvl"))
    c = _cell_size(top_cell_deg, F.col("_lvl"))
    r = r.select("*", F.explode(F.sequence(F.floor(F.col("min_lat") / c),
                                           F.floor(F.col("max_lat") / c))).alias("_cy"))
    r = r.select("*", F.explode(F.sequence(F.floor(F.col("min_lng") / c),
                                           F.floor(F.col("max_lng") / c))).alias("_cx"))
    return r.groupBy("_lvl", "_cy", "_cx").agg(
        F.collect_list(F.struct(*BOX_FIELDS)).alias("_boxes"))


@dataclass(frozen=True)
class RegionIndex:
    """A written index: its rows, its levels and its size in bytes."""
    cells: DataFrame
    levels: tuple
    n_bytes: int
    top_cell_deg: float


def build_region_index(regions: DataFrame, top_cell_deg: float = 16.0, max_level: int = 20) -> RegionIndex:
    """Write the index once.  At most ``max_level + 1`` rows reach the driver."""
    spark = regions.sparkSession
    cells = region_cells(regions, top_cell_deg, max_level)
    path = scratch_path(spark, "region-index")
    cells.write.parquet(path)
    cells = spark.read.schema(cells.schema).parquet(path)
    # per box five doubles, its name and row overhead; per cell its key
    names = F.aggregate("_boxes", F.lit(0).cast("long"), lambda a, b: a + F.coalesce(F.octet_length(b["region"]), F.lit(0)))
    per_level = (cells.groupBy("_lvl").agg(F.sum(F.size("_boxes") * 80 + names + 64).alias("n"))
                 .orderBy("_lvl").collect())
    return RegionIndex(cells, tuple(int(r["_lvl"]) for r in per_level), sum(int(r["n"]) for r in per_level),
                       top_cell_deg)


def region_lookup(df: DataFrame, regions: DataFrame | RegionIndex, *, lat: str = "lat", lng: str = "lng",
                  out: str = "region", top_cell_deg: float = 16.0, max_level: int = 20,
                  broadcast_max_bytes: int = 64 << 20) -> DataFrame:
    """``df`` plus column ``out`` (string, never null).

    ``regions`` is a region table, indexed here, or an index made before.
    The index is broadcast only up to ``broadcast_max_bytes`` bytes."""
    index = regions if isinstance(regions, RegionIndex) else build_region_index(regions, top_cell_deg, max_level)
    cells, top_cell_deg = index.cells, index.top_cell_deg
    y, x = F.col(lat).cast("double"), F.col(lng).cast("double")
    j = df
    candidates = []
    for i, lvl in enumerate(index.levels):
        c = float(top_cell_deg) / 2.0 ** lvl
        side = cells.where(F.col("_lvl") == lvl).select(
            F.col("_cy").alias(f"_cy{i}"), F.col("_cx").alias(f"_cx{i}"),
            F.col("_boxes").alias(f"_b{i}"))
        side = F.broadcast(side) if index.n_bytes <= broadcast_max_bytes else side
        j = j.select("*", F.floor(y / c).alias(f"_cy{i}"), F.floor(x / c).alias(f"_cx{i}"))
        j = j.join(side, on=[f"_cy{i}", f"_cx{i}"], how="left")
        candidates.append(F.coalesce(F.col(f"_b{i}"), F.array().cast(side.schema[f"_b{i}"].dataType)))
    if not candidates:
        return df.select("*", F.lit("").alias(out))
    boxes = F.concat(*candidates) if len(candidates) > 1 else candidates[0]
    inside = F.filter(boxes, lambda b: (y >= b["min_lat"]) & (y < b["max_lat"])
                      & (x >= b["min_lng"]) & (x < b["max_lng"]))
    best = F.array_min(F.transform(inside, lambda b: F.struct(b["area"].alias("area"),
                                                               b["region"].alias("region"))))
    return j.select(*[F.col(c) for c in df.columns],
                    F.coalesce(best["region"], F.lit("")).alias(out))
