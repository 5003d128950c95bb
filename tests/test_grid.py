import math
import random

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from conftest import ALPINE, WATER_BOX
from ecoledger.catalog import derive
from ecoledger.functions.projection import easting, northing
from ecoledger.operators import grid, rings, sweep
from ecoledger.plans.assessment import metrics


def cells_of(features, size=grid.CELL_METRES):
    return grid.cell_shares(rings.edges(rings.rings(features)), size)


def as_map(cells):
    return {(r.code, r.grid_col, r.grid_row): r.frac for r in cells.collect()}


def plane(points):
    a, rf = 6378137.0, 298.257223563
    e2 = (1 / rf) * (2 - 1 / rf)
    e = math.sqrt(e2)
    out = []
    for lon, lat in points:
        s = math.sin(math.radians(lat))
        y = a / 2 * (1 - e2) * (s / (1 - e2 * s * s) - math.log((1 - e * s) / (1 + e * s)) / (2 * e))
        out.append((a * math.radians(lon), y))
    return out


def clip(points, keep, cut):
    out = []
    for i, p in enumerate(points):
        q = points[i - 1]
        if keep(p) != keep(q):
            out.append(cut(q, p))
        if keep(p):
            out.append(p)
    return out


def shoelace(points):
    return abs(sum(a[0] * b[1] - b[0] * a[1] for a, b in zip(points, points[1:] + points[:1]))) / 2


def clipped_area(points, x0, y0, x1, y1):
    """Area of a polygon within a box, by clipping at its four sides."""
    def at_x(x):
        return lambda p, q: (x, p[1] + (x - p[0]) * (q[1] - p[1]) / (q[0] - p[0]))

    def at_y(y):
        return lambda p, q: (p[0] + (y - p[1]) * (q[0] - p[0]) / (q[1] - p[1]), y)

    for keep, cut in (
        (lambda p: p[0] >= x0, at_x(x0)), (lambda p: p[0] <= x1, at_x(x1)),
        (lambda p: p[1] >= y0, at_y(y0)), (lambda p: p[1] <= y1, at_y(y1)),
    ):
        points = clip(points, keep, cut)
        if not points:
            return 0.0
    return shoelace(points)


def test_projection_anchors(spark):
    row = spark.range(1).select(
        easting(F.lit(180.0)).alias("x"), northing(F.lit(90.0)).alias("y"),
        easting(F.lit(0.0)).alias("x0"), northing(F.lit(0.0)).alias("y0"),
    ).first()
    assert row.x == pytest.approx(20037508.3428, abs=1e-3)
    assert row.y == pytest.approx(6363885.33, abs=1e-2)
    assert (row.x0, row.y0) == (0.0, 0.0)


def test_island_cells(island):
    got = as_map(cells_of(island))
    want = {(-1, -1): 0.3267, (-1, 0): 1.0927, (0, -1): 0.7755, (0, 0): 1.9718}
    for (col, row), km2 in want.items():
        assert got["T6.5.1", col, row] * 100 == pytest.approx(km2, abs=5e-5)
    assert len(got) == 8


def test_island_occupancy(island):
    coarse = {r.code: r for r in grid.occupancy(cells_of(island)).collect()}
    fine = {r.code: r for r in grid.occupancy(cells_of(island, 1000.0), size=1000.0).collect()}
    assert coarse["T6.5.1"].aoo_cells == 4 and coarse["T6.5.1"].area_km2 == pytest.approx(4.166621, abs=1e-6)
    assert fine["T6.5.1"].n_cells == 9
    for code in coarse:
        assert fine[code].area_km2 == pytest.approx(coarse[code].area_km2, abs=1e-5)


def test_winding_closing_and_order_do_not_matter(make_features):
    turned = ALPINE[::-1]
    shifted = ALPINE[4:] + ALPINE[:4]
    features = make_features(
        ("a", [WATER_BOX, ALPINE]), ("b", [WATER_BOX[::-1], turned + turned[:1]]), ("c", [WATER_BOX, shifted])
    )
    got = as_map(cells_of(features, 1000.0))
    for (code, col, row), frac in got.items():
        assert frac == pytest.approx(got["a", col, row], abs=1e-9)


@pytest.mark.parametrize("seed", range(4))
def test_random_stars_equal_clipping(make_features, seed):
    rng = random.Random(seed)
    lon, lat = rng.uniform(-170, 170), rng.uniform(-80, 80)
    star = [
        [lon + r * math.cos(t), lat + r * math.sin(t)]
        for t, r in ((2 * math.pi * i / 17, rng.uniform(0.1, 0.6)) for i in range(17))
    ]
    got = {(c, r): f for (_, c, r), f in as_map(cells_of(make_features(("s", [star])))).items()}
    flat = plane(star)
    cols = range(math.floor(min(x for x, _ in flat) / 1e4), math.ceil(max(x for x, _ in flat) / 1e4))
    lines = range(math.floor(min(y for _, y in flat) / 1e4), math.ceil(max(y for _, y in flat) / 1e4))
    for c in cols:
        for r in lines:
            want = clipped_area(flat, c * 1e4, r * 1e4, c * 1e4 + 1e4, r * 1e4 + 1e4) / 1e8
            assert got.get((c, r), 0.0) == pytest.approx(want, abs=1e-6)


def test_overlap_is_flagged_and_clamped(make_features):
    big = [[0.0, 0.0], [0.5, 0.0], [0.5, 0.5], [0.0, 0.5]]
    row = grid.occupancy(cells_of(make_features(("a", [big]), ("a", [big])))).first()
    assert row.overlap_cells > 0
    assert cells_of(make_features(("a", [big]), ("a", [big]))).where("frac > 1").count() == 0


def test_copies_count_once(make_features):
    big = [[0.0, 0.0], [0.5, 0.0], [0.5, 0.5], [0.0, 0.5]]
    other = [[1.0, 0.0], [1.5, 0.0], [1.5, 0.5]]
    many = make_features(*[("a", [big])] * 30, ("b", [big]), ("a", [other]))
    kept = rings.without_copies(many).collect()
    assert [(r.code, r.fid) for r in sorted(kept, key=lambda r: r.fid)] == [("a", 0), ("b", 30), ("a", 31)]
    got = {r.code: r for r in metrics(many).collect()}
    once = {r.code: r for r in metrics(make_features(("a", [big]), ("b", [big]), ("a", [other]))).collect()}
    assert got == once and got["a"].overlap_cells == 0


def test_degenerate_rings_cover_nothing(make_features):
    features = make_features(
        ("line", [[[0.0, 0.0], [1.0, 1.0]]]), ("flat", [[[0.0, 5.0], [1.0, 5.0], [2.0, 5.0]]]),
        ("point", [[[0.0, 0.0]]]),
    )
    assert cells_of(features).where("frac > 1e-6").count() == 0


def shares(spark, *fracs, code="a"):
    rows = [(code, i, 0, f, False) for i, f in enumerate(fracs)]
    return spark.createDataFrame(rows, "code string, grid_col bigint, grid_row bigint, frac double, overlap boolean")


@pytest.mark.parametrize(
    "fracs, aoo",
    [
        ((0.004, 0.004, 0.004, 0.988), 2),
        ((0.01, 0.99), 1),
        ((0.3,), 1),
        ((1.0,) * 100, 99),
        ((1.0,) * 99, 99),
        ((0.005,) * 200, 198),
    ],
)
def test_tail_rule(spark, fracs, aoo):
    assert grid.occupancy(shares(spark, *fracs)).first().aoo_cells == aoo


def test_slots_equal_one_running_sum(spark):
    rng = random.Random(3)
    fracs = [rng.choice([1.0, 0.25, rng.random(), rng.random() * 1e-3]) for _ in range(400)]
    cells = spark.createDataFrame(
        [("a", i % 20, i // 20, f, False) for i, f in enumerate(fracs)],
        "code string, grid_col bigint, grid_row bigint, frac double, overlap boolean",
    )
    got = {(r.grid_col, r.grid_row): r.cum_area for r in grid.cumulative_shares(cells).collect()}
    total = 0.0
    for f, row, col in sorted((f, i // 20, i % 20) for i, f in enumerate(fracs)):
        total += f
        assert got[col, row] == pytest.approx(total, abs=1e-9)


def test_occupancy_overlays_the_map_once(island):
    occupancy = grid.occupancy(cells_of(island))
    occupancy.collect()
    final = occupancy._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    # the cells are settled when the selection begins, so no round goes back to the map
    assert "arrays_zip(_p" not in final and "ExistingRDD" in final


def test_occupancy_ignores_scale(spark):
    fracs = [0.5, 0.2, 0.004, 0.003, 0.002, 0.9]
    for scale in (1.0, 0.1, 0.01):
        assert grid.occupancy(shares(spark, *[f * scale for f in fracs])).first().aoo_cells == 3


def test_ramp_of_equal_shares_is_white(spark):
    rows = grid.share_ramp(shares(spark, 0.5, 0.5)).collect()
    assert [(r.ramp, r.colour.g) for r in rows] == [(0.0, 255)] * 2
    red = grid.share_ramp(shares(spark, 0.1, 0.5)).orderBy(F.desc("ramp")).first()
    assert (red.colour.r, red.colour.g, red.colour.b) == (255, 0, 0)


def tail_by_hand(shares, tail):
    """How many of the smallest shares together stay within the tail."""
    total, area, n = math.fsum(shares), 0.0, 0
    for share in sorted(shares):
        area += share
        if area / total > tail:
            break
        n += 1
    return n


@pytest.mark.parametrize("small", [1, 3, 4096])
def test_tail_is_selected_without_sorting(spark, small):
    rng = random.Random(small)
    classes = {
        "full": [1.0] * 250, "one": [0.25], "slivers": [rng.uniform(1e-9, 2e-9) for _ in range(3000)],
        "mixed": [round(10 ** rng.uniform(-7, 0), 9) for _ in range(2000)] + [1.0] * 20,
        "ties": [0.125] * 400 + [0.5] * 30 + [2.0**-12] * 500, "two": [1.0, 1e-12],
        "close": [0.5 + k * 2.0**-40 for k in range(700)],
    }
    rows = [(code, f, f == 1.0) for code, shares in classes.items() for f in shares]
    cells = spark.createDataFrame(rows, "code string, frac double, overlap boolean").repartition(5)
    for tail in (0.01, 0.2, 0.0):
        got = {r.code: r for r in grid.tail_counts(cells, tail, small).collect()}
        for code, shares in classes.items():
            r = got[code]
            assert (r.n_cells, r.tail_cells, r.overlap_cells) == (
                len(shares), tail_by_hand(shares, tail), sum(f == 1.0 for f in shares)
            ), (code, tail)
            assert r.area == pytest.approx(math.fsum(shares))
    assert grid.tail_counts(cells.limit(0), 0.01, small).count() == 0


def test_no_slot_holds_all_slivers(spark):
    n = 40_000
    cells = spark.range(n).selectExpr(
        "'a' AS code", "id AS grid_col", "id % 7 AS grid_row", "pow(10D, -4 - 5 * id / %d) AS frac" % n, "false AS overlap"
    )
    slots = grid._slots(cells).groupBy("code", "_bin", "_line").count()
    assert slots.agg(F.max("count")).first()[0] < n / 500
    running = grid.cumulative_shares(cells).orderBy("frac").collect()
    area = 0.0
    for r in running:
        area += r.frac
        assert r.cum_area == pytest.approx(area, rel=1e-9)


def test_small_polygon_counts_whatever_lies_east(spark, make_features):
    far = [[[x / 3, 0.001], [x / 3 + 0.2, 0.001], [x / 3 + 0.2, 0.06], [x / 3, 0.06]] for x in range(1, 40)]
    tiny = [[0.01, 0.01], [0.01 + 1e-7, 0.01], [0.01 + 1e-7, 0.01 + 1e-7]]
    features = make_features(("a", [[r] for r in far] + [[tiny]]))
    cells = as_map(cells_of(features))
    assert 0 < cells[("a", 0, 0)] < 1e-9
    assert metrics(features).first().n_cells == len(cells)


def test_one_pass_equals_overlay_and_hull(spark, make_features):
    rng = random.Random(7)
    shapes = []
    for k in range(60):
        x, y, w = rng.uniform(-20, 20), rng.uniform(-20, 20), rng.uniform(0.001, 1.5)
        ring = [[x + w * math.cos(t / 9 * 2 * math.pi), y + w * math.sin(t / 9 * 2 * math.pi)] for t in range(9)]
        hole = [[x + w / 3, y], [x, y + w / 3], [x - w / 3, y]]
        ring = ring[::-1] if k % 2 else ring + ring[:1]
        shapes.append((f"c{k % 4}", [[ring, hole], [[[x, y - 3], [x + w, y - 3], [x, y - 3 + w]]]] if k % 3 else [[ring]]))
    shapes += [shapes[5], ("line", [[[[0.0, 0.0], [1.0, 0.0]]]]), ("point", [[[[0.0, 0.0]]]])]
    features = make_features(*shapes).repartition(6)
    plain = metrics(features, cells=cells_of(rings.without_copies(features)))
    swept = {r.code: r for r in metrics(features).collect()}
    for r in plain.collect():
        mine = swept[r.code]
        assert (mine.aoo_cells, mine.n_cells, mine.overlap_cells) == (r.aoo_cells, r.n_cells, r.overlap_cells)
        assert mine.eoo_km2 == pytest.approx(r.eoo_km2, abs=1e-9)
        assert mine.area_km2 is r.area_km2 is None or mine.area_km2 == pytest.approx(r.area_km2, rel=1e-9)


def test_points_without_coordinates_bound_nothing(spark, make_features):
    box = [[0.0, 0.0], [0.5, 0.0], [0.5, 0.5], [0.0, 0.5]]
    odd = spark.createDataFrame(
        [(9, "a", "n", None, 9, [[[[3.0, None], [4.0, 1.0], [4.0, None]]]]), (10, None, "n", None, 10, [[box]]), (11, "a", "n", None, 11, None)],
        make_features(("a", [box])).schema,
    )
    alone = metrics(make_features(("a", [box]))).first()
    both = metrics(make_features(("a", [box])).unionByName(odd)).collect()
    assert len(both) == 1 and both[0].area_km2 == pytest.approx(alone.area_km2)
    assert metrics(odd.limit(0)).count() == 0


def test_a_batch_is_swept_in_slices_of_few_vertices():
    def ring(n):
        return [[float(k), 0.0] for k in range(n)]

    kind = pa.list_(pa.list_(pa.list_(pa.list_(pa.float64()))))
    sizes = [3, 4, 50, 2, 3, 3, 3, 0, 3]
    geometry = pa.array([[[ring(n)]] if n else [] for n in sizes], kind)
    batch = pa.RecordBatch.from_arrays([pa.array([f"N{k}" for k in range(9)]), geometry], ["code", "geometry"])
    for given in (batch, batch.slice(1), batch.slice(3, 0)):
        got = list(sweep._pieces(given, 1, vertices=8))
        assert [c for b in got for c in b["code"].to_pylist()] == given["code"].to_pylist()
        assert all(b.num_rows == 1 or sum(len(f[0][0]) for f in b["geometry"].to_pylist() if f) <= 8 for b in got)
    assert [b.num_rows for b in sweep._pieces(batch, 1, vertices=8)] == [2, 1, 3, 3]


def test_suppliers_are_spread_over_tasks(spark, tmp_path):
    spark.range(1000).withColumnRenamed("id", "s_suppkey").coalesce(1).write.parquet(str(tmp_path / "supplier.parquet"))
    squares = derive.nearly_twice(spark, str(tmp_path))
    in_task = [r["count"] for r in squares.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(in_task) == 4000 and max(in_task) < 2000
