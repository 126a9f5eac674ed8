from tandem.operators.region import region_lookup

REGIONS = [
    ("Big", 53.0, 54.0, -10.0, -9.0),
    ("Small", 53.2, 53.3, -9.1, -9.0),
    ("AlsoSmall", 53.2, 53.3, -9.1, -9.0),   # same box: name breaks the tie
    ("East", 53.0, 54.0, -9.0, -8.0),
]


def _lookup(spark, pts, **kw):
    regions = spark.createDataFrame(REGIONS, "region string, min_lat double, max_lat double, "
                                              "min_lng double, max_lng double")
    df = spark.createDataFrame(pts, "id int, lat float, lng float")
    return {r.id: r.region for r in region_lookup(df, regions, **kw).collect()}


def test_boxes_half_open_smallest_then_name(spark):
    pts = [(1, 53.29, -9.07), (2, 53.5, -9.5), (3, 53.5, -9.0), (4, 60.0, 0.0), (5, None, None),
           (6, 53.0, -10.0), (7, 54.0, -9.5)]
    for cell in (1.0, 0.05, 7.0, 16.0):
        got = _lookup(spark, pts, top_cell_deg=cell)
        assert got == {1: "AlsoSmall", 2: "Big", 3: "East", 4: "", 5: "", 6: "Big", 7: ""}, cell


def test_one_row_out_per_row_in(spark):
    pts = [(i, 53.25, -9.05) for i in range(50)]
    got = _lookup(spark, pts, broadcast_max_bytes=0)  # force the shuffle-join path
    assert len(got) == 50 and set(got.values()) == {"AlsoSmall"}


def test_multi_level_grid_matches_brute_force(spark):
    """Boxes from 0.001 to 40 degrees, nested and overlapping, and points
    on and off their edges: the smallest holding box, then the name."""
    import random
    rnd = random.Random(11)
    boxes = []
    for i in range(60):
        ext = 10 ** rnd.uniform(-3, 1.6)
        lat0 = round(rnd.uniform(40, 60), 3)
        lng0 = round(rnd.uniform(-20, 10), 3)
        boxes.append((f"r{i:02d}", lat0, lat0 + round(ext, 3) + 0.001, lng0,
                      lng0 + round(ext * rnd.uniform(0.2, 1.0), 3) + 0.001))
    pts = []
    for i in range(400):
        if i % 4 == 0:  # exactly on a box corner
            b = boxes[rnd.randrange(len(boxes))]
            pts.append((i, b[1 + rnd.randint(0, 1)], b[3 + rnd.randint(0, 1)]))
        else:
            pts.append((i, round(rnd.uniform(39, 61), 4), round(rnd.uniform(-21, 11), 4)))
    regions = spark.createDataFrame(boxes, "region string, min_lat double, max_lat double, "
                                           "min_lng double, max_lng double")
    df = spark.createDataFrame(pts, "id int, lat double, lng double")

    def brute(la, ln):
        hits = [((b[2] - b[1]) * (b[4] - b[3]), b[0]) for b in boxes
                if b[1] <= la < b[2] and b[3] <= ln < b[4]]
        return min(hits)[1] if hits else ""

    want = {i: brute(la, ln) for i, la, ln in pts}
    for kw in ({}, {"top_cell_deg": 2.0, "max_level": 6}, {"broadcast_max_bytes": 0}):
        got = {r.id: r.region for r in region_lookup(df, regions, **kw).collect()}
        assert got == want, kw
    assert len(set(want.values())) > 10
