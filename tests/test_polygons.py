"""Outlines, holes and versions against a plain ray over all edges."""

import math
import random
from datetime import datetime, timedelta

import pytest

from tandem.operators.polygons import RegionTable, build_polygon_index, polygon_lookup, start_region_stream

SCHEMA = ("region string, rings array<array<struct<lat:double,lng:double>>>, valid_from timestamp, valid_to timestamp")
T0 = datetime(2024, 1, 10)


def star(rnd, y, x, size, n):
    """A ragged outline around (y, x)."""
    return [(y + size * rnd.uniform(0.3, 1) * math.sin(2 * math.pi * i / n),
             x + size * rnd.uniform(0.3, 1) * math.cos(2 * math.pi * i / n)) for i in range(n)]


def crossings(y, x, rings):
    n = 0
    for ring in rings:
        for p, q in zip(ring, ring[1:] + ring[:1]):
            (y1, x1), (y2, x2) = min(p, q), max(p, q)
            if y1 <= y < y2 and x < x1 + (y - y1) * (x2 - x1) / (y2 - y1):
                n += 1
    return n


def brute(y, x, t, regions):
    hits = []
    for name, rings, a, b in regions:
        pts = [p for r in rings for p in r]
        if y is None or not pts or (a and t < a) or (b and t >= b) or crossings(y, x, rings) % 2 == 0:
            continue
        ys, xs = zip(*pts)
        hits.append((round((max(ys) - min(ys)) * (max(xs) - min(xs)), 9), name))
    return min(hits)[1] if hits else ""


def made():
    rnd = random.Random(2)
    regions = []
    for i in range(25):
        y, x, size = rnd.uniform(40, 60), rnd.uniform(-20, 10), 10 ** rnd.uniform(-2, 0.9)
        rings = [star(rnd, y, x, size, rnd.choice((3, 5, 12, 90)))]
        if i % 3 == 0:
            rings.append(star(rnd, y, x, size * 0.25, 6))      # a hole
        if i % 4 == 0:
            rings.append(star(rnd, y + 3 * size, x, size, 7))  # an island
        regions.append((f"r{i}", rings, T0 if i % 5 == 1 else None, T0 if i % 5 == 2 else None))
    regions.append(("box", [[(50.0, 0.0), (50.0, 2.0), (52.0, 2.0), (52.0, 0.0)]], None, None))  # on cell sides
    regions.append(("grid", [[(50.5, 0.5), (51.0, 0.5), (51.0, 1.0), (50.75, 0.75), (50.5, 1.0), (50.5, 0.5)]], None, None))
    corners = [p for r in regions for ring in r[1] for p in ring]
    pts = corners[::3] + [(rnd.uniform(39, 61), rnd.uniform(-21, 11)) for _ in range(300)]
    pts += [(c[0] + rnd.gauss(0, 0.05), c[1] + rnd.gauss(0, 0.05)) for c in corners]
    pts += [(50 + i / 8, j / 8) for i in range(17) for j in range(17)] + [(corners[i][0], corners[j][1]) for i in range(9) for j in range(9)]
    rows = [(i, y, x, T0 + timedelta(hours=rnd.randrange(-3, 3))) for i, (y, x) in enumerate(pts)]
    return regions, rows


def table(spark, regions):
    return spark.createDataFrame([(n, [[{"lat": y, "lng": x} for y, x in r] for r in rings], a, b)
                                  for n, rings, a, b in regions], SCHEMA)


def test_matches_a_ray_over_all_edges(spark):
    regions, rows = made()
    df = spark.createDataFrame(rows, "id int, lat double, lng double, t timestamp")
    want = {i: brute(y, x, t, regions) for i, y, x, t in rows}
    assert len(set(want.values())) > 20
    for index, kw in ((build_polygon_index(table(spark, regions)), {"broadcast_max_bytes": 0}),
                      (build_polygon_index(table(spark, regions), top_cell_deg=2.0, max_level=5), {})):
        got = {r.id: r.region for r in polygon_lookup(df, index, at="t", **kw).collect()}
        assert got == want
    # most cells of a large outline need no ray
    cells = build_polygon_index(table(spark, [r for r in regions if r[0] == "box"])).cells
    assert cells.selectExpr("inline(_parts)").where("size(edges) = 0").count() >= 4


def test_edges_of_the_input(spark):
    regions = [("a", [[(0.0, 0.0), (0.0, 1.0), (1.0, 1.0), (1.0, 0.0)]], None, None)]
    odd = [("none", [], None, None), ("point", [[(0.5, 0.5)]], None, None), ("line", [[(0.0, 0.0), (1.0, 1.0)]], None, None),
           ("nan", [[(0.0, 0.0), (float("nan"), 1.0), (1.0, 1.0)]], None, None), ("gone", regions[0][1], None, T0),
           ("empty ring", [[]], None, None), (None, regions[0][1], None, None)]
    rows = [(1, 0.5, 0.25), (2, None, 0.5), (3, float("nan"), 0.5), (4, 1.0, 0.5), (5, 0.0, 0.0), (6, 0.5, 1.0), (1, 0.5, 0.25)]
    df = spark.createDataFrame(rows, "id int, lat double, lng double").selectExpr("*", "'x' AS edges", "0 AS lvl")
    got = polygon_lookup(df, table(spark, regions * 2 + odd))
    assert got.columns == [*df.columns, "region"]
    assert sorted((r.id, r.region) for r in got.collect()) == [(1, "a"), (1, "a"), (2, ""), (3, ""), (4, ""), (5, "a"), (6, "")]
    assert {r.region for r in polygon_lookup(df, table(spark, regions).where("false")).collect()} == {""}
    with pytest.raises(ValueError):
        build_polygon_index(table(spark, regions), top_cell_deg=3.0)


def test_stream_sees_a_changed_region(spark, tmp_path):
    box = [[(0.0, 0.0), (0.0, 1.0), (1.0, 1.0), (1.0, 0.0)]]
    path, feed, out = f"{tmp_path}/regions", f"{tmp_path}/feed", f"{tmp_path}/out"
    table(spark, [("old", box, None, None)]).write.parquet(path)
    schema = "id int, lat double, lng double, obsTs timestamp"

    def send(i, t):
        spark.createDataFrame([(i, 0.5, 0.5, t)], schema).coalesce(1).write.mode("append").parquet(feed)

    send(1, T0 + timedelta(hours=2))
    regions = RegionTable(spark, path)
    q = start_region_stream(spark.readStream.schema(schema).parquet(feed), regions, out, f"{tmp_path}/ckpt",
                            trigger={"processingTime": "1 second"})
    try:
        q.processAllAvailable()
        first = regions.index()
        assert regions.index() is first  # nothing changed
        table(spark, [("old", box, None, T0), ("new", box, T0, None)]).write.mode("overwrite").parquet(path)
        send(2, T0 + timedelta(hours=1))
        send(3, T0 - timedelta(hours=1))
        q.processAllAvailable()
    finally:
        q.stop()
    assert sorted((r.id, r.region) for r in spark.read.parquet(out).collect()) == [(1, "old"), (2, "new"), (3, "old")]
