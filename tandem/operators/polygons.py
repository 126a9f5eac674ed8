"""Region name for a position and time, from regions with any outline.

Regions: ``region string, rings array<array<struct<lat: double, lng: double>>>``
and, optionally, ``valid_from`` and ``valid_to`` (timestamp; null: open).  A ring
is closed by itself; a point is inside if a ray to larger ``lng`` crosses the
rings an odd number of times, so a second ring cuts a hole or adds an island.
An edge covers latitudes [lower end, upper end), a point on an edge is not left
of it.  Every input row gets one name: of the regions that hold the point (and
are valid at its time, from inclusive to exclusive) the one with the smallest
bounding box (in square degrees, to nine places), ties broken by name; '' when
none does.

The index is a grid of levels like that of the boxes.  A region lies on one
level, with more cells the more edges it has (4 to 256 across).  A cell keeps
the edges that touch it, and the latitudes in it at which the number of
crossings *behind* it changes between odd and even: changes at a shared corner
of two edges cancel, so a cell well inside the region keeps a single latitude,
its lower side, and no edge.  A ray is thus cast over a cell's own edges only,
and the answer is the same, bit by bit, as over all edges.

A point probes one cell per level in use: a left equi-join each.  The index is
broadcast only after its size is checked against ``broadcast_max_bytes``.  All of
it is built-in expressions.

Cases: a null position, or one that is no number, gets ''; without ``at`` only
versions without an end count; a region with a null name, without rings, or with a null or
non-finite corner is left out; repeated regions count once; rows of an empty
region table all get ''.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tandem.operators.region import RegionIndex, region_lookup
from tandem.session import scratch_path

RINGS = "array<array<struct<lat:double,lng:double>>>"
_MARGIN = 1e-9        # degrees; an edge this near a cell counts as touching it
_EDGE = ("y1", "x1", "y2", "x2")


def _crossing(y: Column, e: Callable[[str], Column]) -> Column:
    """Where the edge has latitude ``y``."""
    return e("x1") + (y - e("y1")) * (e("x2") - e("x1")) / (e("y2") - e("y1"))


def polygon_edges(regions: DataFrame, top_cell_deg: float, max_level: int) -> DataFrame:
    """One row an edge (lower end first), with its region's box, version and level."""
    for c in ("valid_from", "valid_to"):
        if c not in regions.columns:
            regions = regions.withColumn(c, F.lit(None).cast("timestamp"))
    r = regions.select("region", F.col("rings").cast(RINGS).alias("rings"), "valid_from", "valid_to").distinct()
    r = r.withColumn("_pts", F.flatten("rings"))

    def bad(v: Column) -> Column:
        return v.isNull() | F.isnan(v) | (F.abs(v) > 1e6)

    r = r.where(F.col("region").isNotNull() & (F.size("_pts") > 0)
                & ~F.exists("_pts", lambda p: p.isNull() | bad(p["lat"]) | bad(p["lng"])))
    for c, lo, hi in (("lat", "y_lo", "y_hi"), ("lng", "x_lo", "x_hi")):
        axis = F.col("_pts").getField(c)
        r = r.withColumn(lo, F.array_min(axis)).withColumn(hi, F.array_max(axis))
    extent = F.greatest(F.col("y_hi") - F.col("y_lo"), F.col("x_hi") - F.col("x_lo"))
    finer = F.least(F.lit(8), F.greatest(F.lit(2), F.ceil(F.log2(F.sqrt(F.size("_pts"))))))
    level = F.least(F.lit(max_level), F.greatest(F.lit(0), F.floor(F.log2(F.lit(float(top_cell_deg)) / extent)) + finer))
    r = r.where(extent > 0).select(
        "region", "valid_from", "valid_to", "x_lo", level.cast("int").alias("lvl"), "rings",
        F.round((F.col("y_hi") - F.col("y_lo")) * (F.col("x_hi") - F.col("x_lo")), 9).alias("area"),
        F.xxhash64("region", "rings", "valid_from", "valid_to").alias("rid"))
    ring = r.select("*", F.explode("rings").alias("_r")).drop("rings").where("size(_r) > 0")
    ends = F.explode(F.zip_with("_r", F.concat(F.slice("_r", 2, F.size("_r")), F.slice("_r", 1, 1)),
                                lambda p, q: F.struct(F.least(p, q).alias("p"), F.greatest(p, q).alias("q"))))
    return (ring.select("*", ends.alias("_e")).drop("_r").where("_e.p.lat < _e.q.lat")
            .select("*", F.col("_e.p.lat").alias("y1"), F.col("_e.p.lng").alias("x1"),
                    F.col("_e.q.lat").alias("y2"), F.col("_e.q.lng").alias("x2")).drop("_e"))


def polygon_cells(regions: DataFrame, top_cell_deg: float = 16.0, max_level: int = 20) -> DataFrame:
    """``_lvl, _cy, _cx, _parts``: per cell the regions that touch or fill it."""
    e = polygon_edges(regions, top_cell_deg, max_level)
    c = F.lit(float(top_cell_deg)) / F.pow(F.lit(2.0), F.col("lvl"))
    e = e.withColumn("c", c)
    e = e.select("*", F.explode(F.sequence(F.floor(F.col("y1") / F.col("c")), F.floor(F.col("y2") / F.col("c")))).alias("cy"))
    e = (e.withColumn("top", (F.col("cy") + 1) * F.col("c"))
         .withColumn("ya", F.greatest("y1", F.col("cy") * F.col("c"))).withColumn("yb", F.least("y2", "top"))
         .where("ya < yb"))
    xa, xb = (_crossing(F.col(y), F.col) for y in ("ya", "yb"))
    e = (e.withColumn("from_x", F.floor((F.least(xa, xb) - _MARGIN) / F.col("c")))
         .withColumn("to_x", F.floor((F.greatest(xa, xb) + _MARGIN) / F.col("c"))))
    e = e.select("*", F.explode(F.sequence(F.floor((F.col("x_lo") - _MARGIN) / F.col("c")), F.col("to_x"))).alias("cx"))
    cell = ["rid", "region", "valid_from", "valid_to", "area", "lvl", "cy", "cx"]
    touching = e.where("cx >= from_x").select(*cell, F.struct(*_EDGE).alias("edge"), F.lit(None).cast("double").alias("flip"))
    flips = (e.where("cx < from_x").select(*cell, "top", F.explode(F.array("ya", "yb")).alias("flip")).where("flip < top")
             .groupBy(*cell, "flip").agg((F.count(F.lit(1)) % 2).alias("odd")).where("odd = 1")
             .select(*cell, F.lit(None).cast(touching.schema["edge"].dataType).alias("edge"), "flip"))
    parts = touching.unionByName(flips).groupBy(*cell).agg(
        F.collect_list("edge").alias("edges"), F.sort_array(F.collect_list("flip")).alias("flips"))
    return (parts.groupBy(F.col("lvl").alias("_lvl"), F.col("cy").alias("_cy"), F.col("cx").alias("_cx"))
            .agg(F.collect_list(F.struct("area", "region", "valid_from", "valid_to", "edges", "flips")).alias("_parts")))


@dataclass(frozen=True)
class PolygonIndex:
    """A written index: its rows, its levels and its size in bytes."""
    cells: DataFrame
    levels: tuple
    n_bytes: int
    top_cell_deg: float


def build_polygon_index(regions: DataFrame, top_cell_deg: float = 16.0, max_level: int = 20) -> PolygonIndex:
    """Write the index once.  ``top_cell_deg`` has to be a power of two, so that
    cell sides are exact.  At most ``max_level + 1`` rows reach the driver."""
    if float(top_cell_deg).hex().split("p")[0] != "0x1.0000000000000":
        raise ValueError(f"top_cell_deg has to be a power of two: {top_cell_deg}")
    spark = regions.sparkSession
    cells = polygon_cells(regions, top_cell_deg, max_level)
    path = scratch_path(spark, "polygon-index")
    cells.write.parquet(path)
    cells = spark.read.schema(cells.schema).parquet(path)
    size = F.aggregate("_parts", F.lit(64).cast("long"), lambda n, p: n + 96 + F.octet_length(p["region"])
                       + F.size(p["edges"]) * 48 + F.size(p["flips"]) * 8)
    per_level = cells.groupBy("_lvl").agg(F.sum(size).alias("n")).orderBy("_lvl").collect()
    return PolygonIndex(cells, tuple(int(r["_lvl"]) for r in per_level), sum(int(r["n"]) for r in per_level), float(top_cell_deg))


def polygon_lookup(df: DataFrame, regions: DataFrame | PolygonIndex, *, lat: str = "lat", lng: str = "lng",
                   at: str | None = None, out: str = "region", broadcast_max_bytes: int = 64 << 20) -> DataFrame:
    """``df`` plus column ``out`` (string, never null): the region of the position,
    as of the time in column ``at``."""
    index = regions if isinstance(regions, PolygonIndex) else build_polygon_index(regions)
    y, x = F.col(lat).cast("double"), F.col(lng).cast("double")
    j, found = df, []
    for i, lvl in enumerate(index.levels):
        c = index.top_cell_deg / 2.0 ** lvl
        side = index.cells.where(F.col("_lvl") == lvl).select(
            F.col("_cy").alias(f"_cy{i}"), F.col("_cx").alias(f"_cx{i}"), F.col("_parts").alias(f"_p{i}"))
        side = F.broadcast(side) if index.n_bytes <= broadcast_max_bytes else side
        j = j.select("*", F.floor(y / c).alias(f"_cy{i}"), F.floor(x / c).alias(f"_cx{i}"))
        j = j.join(side, on=[f"_cy{i}", f"_cx{i}"], how="left")
        found.append(F.coalesce(F.col(f"_p{i}"), F.array().cast(side.schema[f"_p{i}"].dataType)))
    if not found:
        return df.select("*", F.lit("").alias(out))

    def holds(p: Column) -> Column:
        crossed = F.filter(p["edges"], lambda e: (e["y1"] <= y) & (y < e["y2"]) & (x < _crossing(y, lambda n: e[n])))
        odd = (F.size(crossed) + F.size(F.filter(p["flips"], lambda f: f <= y))) % 2 == 1
        if at is None:
            return odd & p["valid_to"].isNull()
        t = F.col(at)
        return odd & (p["valid_from"].isNull() | (t >= p["valid_from"])) & (p["valid_to"].isNull() | (t < p["valid_to"]))

    parts = F.concat(*found) if len(found) > 1 else found[0]
    usable = ~(F.isnan(y) | F.isnan(x))
    best = F.array_min(F.transform(F.filter(parts, lambda p: usable & holds(p)),
                                   lambda p: F.struct(p["area"].alias("area"), p["region"].alias("region"))))
    return j.select(*[F.col(f"`{c}`") for c in df.columns], F.coalesce(best["region"], F.lit("")).alias(out))


def position_region(df: DataFrame, regions: DataFrame | PolygonIndex | RegionIndex, at: str = "obsTs") -> DataFrame:
    """``df`` plus ``region``, from a table or index of boxes or of outlines (as of
    the time in column ``at``, if there is one)."""
    if isinstance(regions, PolygonIndex) or (isinstance(regions, DataFrame) and "rings" in regions.columns):
        return polygon_lookup(df, regions, at=at if at in df.columns else None)
    return region_lookup(df, regions)


class RegionTable:
    """A parquet table of regions that others may change while streams run: the
    index is built again when the table's files are others than before."""

    def __init__(self, spark: SparkSession, path: str, **index_params):
        self.spark, self.path, self.params = spark, path, index_params
        self._files, self._index = None, None

    def index(self) -> PolygonIndex:
        table = self.spark.read.parquet(self.path)  # lists the folder anew
        files = sorted(table.inputFiles())
        if files != self._files:
            self._index, self._files = build_polygon_index(table, **self.params), files
        return self._index


def start_region_stream(readings: DataFrame, table: RegionTable, out_path: str, checkpoint: str, *, at: str = "obsTs",
                        trigger: dict | None = None, **lookup_params):
    """Start a query that writes ``readings`` with the region they had at their
    time, each micro-batch by the region table as it is then.  A micro-batch that
    is run again replaces its own folder, so no row is written twice."""
    def write(batch: DataFrame, batch_id: int) -> None:
        done = polygon_lookup(batch, table.index(), at=at, **lookup_params)
        done.write.mode("overwrite").parquet(f"{out_path}/batch={batch_id}")

    return (readings.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
            .trigger(**(trigger or {"availableNow": True})).start())
