import itertools

from tandem.functions.alerts import fire_alert


def rule(t, h, c2, c1, strict=False):
    """Plain-Python statement of the alert rule."""
    if t < 30 and h > 30 and c2 < 350 and c1 < 10:
        return "Green"
    y = [30 <= t < 37, 20 < h <= 30, 350 <= c2 < 2000, 10 <= c1 < 25]
    o = [37 <= t < 40, 10 < h <= 20, 2000 <= c2 < 5000, 25 <= c1 < 50]
    if strict:
        if all(y):
            return "Yellow"
        if all(o):
            return "Orange"
        if t >= 40 and h <= 10 and c2 >= 5000 and c1 >= 50:
            return "Red"
        return ""
    if any(y):
        return "Yellow"
    if any(o):
        return "Orange"
    if (t >= 40 and h <= 10) or (c2 >= 5000 and c1 >= 50):
        return "Red"
    return ""


def _grid():
    ts = sorted({v + d for v in (30, 37, 40) for d in (-1, 0, 1)} | {0, 45})
    hs = sorted({v + d for v in (30, 20, 10) for d in (-1, 0, 1)} | {0, 50})
    c2s = sorted({v + d for v in (350, 2000, 5000) for d in (-1, 0, 1)} | {0})
    c1s = sorted({v + d for v in (10, 25, 50) for d in (-1, 0, 1)} | {0})
    return list(itertools.product(ts, hs, c2s, c1s))


def test_fixture_examples(spark):
    cases = {(25, 40, 300, 5): "Green", (31, 40, 300, 5): "Yellow", (45, 5, 400, 1): "Yellow",
             (38, 40, 100, 1): "Orange", (45, 5, 100, 1): "Red", (45, 50, 5000, 50): "Red",
             (45, 50, 100, 1): ""}
    df = spark.createDataFrame(list(cases), "temp int, humd int, CO2 int, CO int")
    got = {(r.temp, r.humd, r.CO2, r.CO): r.a for r in df.select("*", fire_alert().alias("a")).collect()}
    assert got == cases


def test_band_edges_match_rule(spark):
    grid = _grid()
    df = spark.createDataFrame(grid, "temp int, humd int, CO2 int, CO int")
    out = df.select("*", fire_alert().alias("a"), fire_alert(strict=True).alias("s")).collect()
    assert len(out) == len(grid)
    for r in out:
        assert r.a == rule(r.temp, r.humd, r.CO2, r.CO), r
        assert r.s == rule(r.temp, r.humd, r.CO2, r.CO, strict=True), r
