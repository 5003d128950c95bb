import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from ecoledger.operators import hull, rings


def brute_hull(points):
    """Corners by testing every directed edge against every point."""
    points = sorted(set(points))
    corners = set()
    for a in points:
        for b in points:
            if a == b:
                continue
            side = [(b[0] - a[0]) * (c[1] - a[1]) - (b[1] - a[1]) * (c[0] - a[0]) for c in points]
            beyond = [
                (c[0] - a[0]) * (c[0] - b[0]) + (c[1] - a[1]) * (c[1] - b[1]) > 0
                for c, s in zip(points, side) if s == 0
            ]
            if min(side) >= 0 and not any(beyond):
                corners |= {a, b}
    return corners


@pytest.mark.parametrize("n, span", [(3, 5), (12, 4), (60, 1000), (300, 12)])
def test_hull_equals_brute_force(n, span):
    rng = random.Random(n)
    points = [(float(rng.randrange(span)), float(rng.randrange(span))) for _ in range(n)]
    got = {tuple(p) for p in hull.hull_points(np.array(points)).tolist()}
    assert got == brute_hull(points)


def test_octagon_keeps_every_corner():
    rng = np.random.default_rng(5)
    points = rng.normal(size=(5000, 2))
    kept = hull._outside_octagon(points)
    assert len(kept) < 2500
    assert {tuple(p) for p in hull.hull_points(points)} == brute_hull([tuple(p) for p in hull.hull_points(kept)])


def test_hulls_merge_over_batches(monkeypatch):
    rng = np.random.default_rng(1)
    points = rng.random((900, 2))
    codes = ["a" if i % 3 else "b" for i in range(900)]
    table = pa.table({"code": codes, "lon": points[:, 0], "lat": points[:, 1]})
    for fold in (50, 10_000):
        monkeypatch.setattr(hull, "ROWS_PER_FOLD", fold)
        out = pa.Table.from_batches(hull._task_hulls(iter(table.to_batches(max_chunksize=100)))).to_pylist()
        for code in "ab":
            mine = points[[c == code for c in codes]]
            got = [(r["lon"], r["lat"]) for r in out if r["code"] == code]
            assert got == [tuple(p) for p in hull.hull_points(mine)]


def test_island_extent(island):
    got = {r.code: r for r in hull.extent(rings.outer_points(rings.rings(island))).collect()}
    assert got["M1.1.1"].eoo_km2 == pytest.approx(147.708847, abs=1e-6)
    assert got["T6.5.1"].eoo_km2 == pytest.approx(4.166621, abs=1e-6)
    assert (got["M1.1.1"].n_corners, got["T6.5.1"].n_corners) == (4, 9)


def test_few_or_collinear_points_have_no_extent(spark):
    rows = [("one", 1.0, 1.0), ("two", 0.0, 0.0), ("two", 1.0, 1.0)] + [
        ("line", float(i), float(i)) for i in range(5)
    ] + [("same", 2.0, 2.0)] * 4
    points = spark.createDataFrame(rows, "code string, lon double, lat double")
    assert {r.code: r.eoo_km2 for r in hull.extent(points).collect()} == {
        "one": 0.0, "two": 0.0, "line": 0.0, "same": 0.0,
    }


def test_dominant_class_and_many_partitions(spark):
    rng = random.Random(9)
    rows = [("hot", rng.gauss(0, 10), rng.gauss(0, 10)) for _ in range(3000)]
    rows += [(f"c{i % 30}", rng.random(), rng.random()) for i in range(300)]
    points = spark.createDataFrame(rows, "code string, lon double, lat double").repartition(40)
    got = {r.code: r.hull for r in hull.hulls(points).collect()}
    want = hull.hull_points(np.array([(x, y) for c, x, y in rows if c == "hot"]))
    assert [(p.lon, p.lat) for p in got["hot"]] == [tuple(p) for p in want]
    assert len(got) == 31


def test_hulls_of_many_tasks_merge_as_a_tree(spark):
    tasks = 4096
    # one triangle a task on a circle, so every task adds corners
    corners = spark.range(tasks).selectExpr(
        "'a' AS code", "id AS task", "explode(array(0, 1, 2)) AS k", "2 * pi() * id / 4096 AS t"
    ).selectExpr("code", "task", "cos(t) * (10 - k) AS lon", "sin(t) * (10 - k) + k / 100 AS lat")
    assert [hull.merge_levels(n) for n in (1, 64, 65, 4096, 4097, 262_144)] == [0, 0, 1, 1, 2, 2]
    left = tasks
    groups = corners.select("code", "task").distinct()
    for _ in range(hull.merge_levels(tasks)):
        groups = groups.selectExpr("code", "task", f"floor(task / {hull.MERGE_WIDTH}) AS next")
        assert groups.groupBy("code", "next").agg(F.countDistinct("task").alias("n")).agg(F.max("n")).first()[0] <= 64
        groups = groups.selectExpr("code", "next AS task").distinct()
    assert groups.count() <= 64 < left
    (merged,) = hull.merge_hulls(corners, tasks).collect()
    points = corners.select("lon", "lat").toPandas().to_numpy()
    assert sorted(map(tuple, merged.hull)) == sorted(map(tuple, hull.hull_points(points)))
