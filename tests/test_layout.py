import datetime
import decimal

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from ecoledger.plans import readiness
from ecoledger.sources import footers, layout

GIB = 1024**3
CHUNKS = (
    "path string, row_group int, group_rows bigint, column string, uncompressed bigint, has_range boolean, "
    "steps_back boolean, low string, high string, geo_primary string, problem string"
)


def codes(order):
    return pa.table({"ecos_general": [f"E{i:03d}" for i in order], "x": list(order)})


def verdict_of_file(spark, path, column="ecos_general"):
    listing = footers.object_listing(spark, str(path), "*.parquet")
    stats = footers.footer_stats(footers.footer_chunks(listing, column), column)
    return readiness.layout_verdicts(stats).collect()


@pytest.mark.parametrize(
    "order, group, groups, optimized",
    [
        (range(100), 10, 10, True),
        (range(100), 1000, 1, False),
        ([i // 2 + 50 * (i % 2) for i in range(100)], 10, 10, False),
    ],
)
def test_verdicts_of_files(spark, tmp_path, order, group, groups, optimized):
    pq.write_table(codes(order), tmp_path / "m.parquet", row_group_size=group)
    (row,) = verdict_of_file(spark, tmp_path)
    assert (row.num_row_groups, row.num_rows, row.optimized) == (groups, 100, optimized)


def test_numbers_are_compared_as_numbers(spark, tmp_path):
    pq.write_table(codes(range(100)), tmp_path / "m.parquet", row_group_size=10)
    (row,) = verdict_of_file(spark, tmp_path, "x")
    assert row.optimized


def test_every_file_gets_a_verdict(spark, tmp_path):
    (tmp_path / "a.parquet").write_text("not parquet")
    pq.write_table(codes(range(5)), tmp_path / "b.parquet")
    pq.write_table(codes([]), tmp_path / "c.parquet")
    a, b, c = sorted(verdict_of_file(spark, tmp_path), key=lambda r: r.path)
    assert a.problem and a.optimized is False and a.num_rows is None and a.geometry_column is None
    assert (b.problem, b.num_rows) == (None, 5)
    assert (c.problem, c.num_rows, c.optimized) == (None, 0, False)


@pytest.mark.parametrize(
    "values",
    [
        [decimal.Decimal(i) for i in range(100)],
        [2**53 + i for i in range(100)],
        [datetime.date(1990 + i, 1, 1) for i in range(100)],
    ],
)
def test_ranges_are_compared_by_type(spark, tmp_path, values):
    pq.write_table(pa.table({"x": values}), tmp_path / "up.parquet", row_group_size=10)
    pq.write_table(pa.table({"x": values[50:] + values[:50]}), tmp_path / "down.parquet", row_group_size=10)
    down, up = sorted(verdict_of_file(spark, tmp_path, "x"), key=lambda r: r.path)
    assert up.optimized and not down.optimized


def test_ranges_only_of_the_wanted_column(spark, tmp_path):
    pq.write_table(codes(range(5)), tmp_path / "b.parquet")
    rows = footers.footer_chunks(footers.object_listing(spark, str(tmp_path)), "x").collect()
    assert {r.column: (r.low, r.high) for r in rows} == {"x": ("0", "4"), "ecos_general": (None, None)}
    want = pq.ParquetFile(tmp_path / "b.parquet").metadata.row_group(0)
    assert {r.column: r.uncompressed for r in rows} == {
        want.column(k).path_in_schema: want.column(k).total_uncompressed_size for k in range(2)
    }


def chunk_rows(max_rows, *ranges):
    before = [None, *ranges]
    return [
        ("f", g, max_rows, "eco", 10, r is not None, bool(r and b and r[0] < b[1]), r and r[0], r and r[1], None, None)
        for g, (b, r) in enumerate(zip(before, ranges))
    ]


@pytest.mark.parametrize(
    "rows, optimized",
    [
        (chunk_rows(1000, ("a", "z")), False),
        (chunk_rows(10, ("a", "c"), ("c", "m"), ("m", "z")), True),
        (chunk_rows(10, ("a", "z"), ("a", "z"), ("a", "z")), False),
        (chunk_rows(200_000, ("a", "m"), ("m", "z")), False),
        (chunk_rows(10, ("a", "c"), None, ("m", "z")), False),
    ],
)
def test_verdicts_of_footers(spark, rows, optimized):
    stats = footers.footer_stats(spark.createDataFrame(rows, CHUNKS), "eco")
    assert readiness.layout_verdicts(stats).first().optimized is optimized


def test_missing_ecosystem_column_is_not_optimized(spark):
    stats = footers.footer_stats(spark.createDataFrame(chunk_rows(10, ("a", "b"), ("b", "c")), CHUNKS), "other")
    row = readiness.layout_verdicts(stats).first()
    assert row.ranges_sorted is None and row.optimized is False


@pytest.mark.parametrize(
    "primary, want", [("shape", ("shape", 5)), ("gone", ("geometry", 7)), (None, ("geometry", 7))]
)
def test_geometry_column_choice(spark, primary, want):
    sizes = {"shape": 5, "geometry": 7, "note": 99}
    rows = [("f", 0, 1, c, n, False, None, None, None, primary, None) for c, n in sizes.items()]
    row = footers.footer_stats(spark.createDataFrame(rows, CHUNKS), "x").first()
    assert (row.geometry_column, row.geometry_bytes) == want


def test_geo_metadata_names_the_column(spark, tmp_path):
    table = pa.table({"shape": [b"x"], "note": ["long " * 100]}).replace_schema_metadata(
        {"geo": '{"primary_column": "shape"}'}
    )
    pq.write_table(table, tmp_path / "m.parquet")
    (row,) = verdict_of_file(spark, tmp_path)
    assert row.geometry_column == "shape"


def test_largest_column_stands_in_for_geometry(spark):
    rows = [("f", 0, 1, c, n, False, None, None, None, None, None) for c, n in (("a", 5), ("b", 9))]
    assert footers.footer_stats(spark.createDataFrame(rows, CHUNKS), "x").first().geometry_bytes == 9


def test_large_remote_load_is_refused(spark):
    schema = "path string, ranges_sorted boolean, num_row_groups bigint, max_rows_per_group bigint, geometry_bytes bigint"
    rows = [
        ("gs://b/a", False, 1, 10, GIB), ("gs://b/b", True, 3, 10, GIB),
        ("/local/c", False, 1, 10, GIB), ("gs://b/d", False, 1, 10, GIB - 1),
    ]
    judged = readiness.layout_verdicts(spark.createDataFrame(rows, schema)).orderBy("path")
    assert "1.0 GB geometry in 1 row groups" in judged.where("path = 'gs://b/a'").first().refusal
    assert judged.where("refusal is not null").count() == 1
    assert {r.path: r.refuse_load for r in judged.collect()} == {
        "gs://b/a": True, "gs://b/b": False, "/local/c": False, "gs://b/d": False,
    }


def test_sorted_copy(spark, tmp_path):
    df = spark.range(3000).select(
        F.when(F.col("id") % 50 != 0, F.concat(F.lit("c"), F.lpad((F.col("id") % 7).cast("string"), 2, "0"))).alias("code"),
        "id",
    )
    path = layout.write_sorted_copy(df, str(tmp_path / "copy"), "code", 100, files=3, tiebreak="id")
    rows = verdict_of_file(spark, path, "code")
    assert all(r.max_rows_per_group <= 100 for r in rows) and sum(r.num_rows for r in rows) == 3000
    files = sorted((tmp_path / "copy").glob("*.parquet"))
    assert [pq.ParquetFile(f).metadata.row_group(0).column(0).compression for f in files] == ["ZSTD"] * len(files)
    held = [c for f in files for c in pq.read_table(f)["code"].to_pylist()]
    known = [c for c in held if c is not None]
    assert held == sorted(known) + [None] * 60
    scan = spark.read.parquet(path).where("code = 'c03'")
    assert "EqualTo(code,c03)" in scan._jdf.queryExecution().executedPlan().toString()


def test_dominant_ecosystem_spreads_over_files(spark, tmp_path):
    df = spark.range(0, 4000, 1, 4).select(
        F.when(F.col("id") % 10 == 0, F.lit("rare")).otherwise(F.lit("hot")).alias("code"), "id"
    )
    path = layout.write_sorted_copy(df, str(tmp_path / "copy"), "code", files=4)
    files = sorted((tmp_path / "copy").glob("*.parquet"))
    tables = [pq.read_table(f) for f in files]
    assert sum("hot" in t["code"].to_pylist() for t in tables) >= 3
    assert [c for t in tables for c in t["code"].to_pylist()] == ["hot"] * 3600 + ["rare"] * 400
    assert sorted(i for t in tables for i in t["id"].to_pylist()) == list(range(4000))
    assert tables[0].column_names == ["code", "id"]


def test_sorted_copy_needs_its_column(spark, tmp_path):
    with pytest.raises(ValueError, match="columns: id"):
        layout.write_sorted_copy(spark.range(3), str(tmp_path / "x"), "code")


STATS = "n_configured bigint, n_missing bigint, size_bytes bigint, geometry_bytes bigint, num_rows bigint, num_row_groups bigint"


@pytest.mark.parametrize(
    "row, limits, ok",
    [
        ((1, 0, 11 * GIB, None, None, None), {}, True),
        ((1, 1, None, None, None, None), {}, False),
        ((0, 0, 11 * GIB, None, None, None), {}, False),
        ((0, 0, 50 * 1024**2, None, None, None), {}, True),
        ((0, 0, None, None, None, None), {}, True),
        ((0, 0, 11 * GIB, None, None, None), {"max_size_gib": 20.0}, True),
        ((0, 0, 2 * GIB, int(2.17 * GIB), 460_350, 1), {}, False),
        ((0, 0, GIB, int(0.2 * GIB), 300_000, 50), {}, False),
        ((0, 0, GIB, int(0.6 * GIB), 50_000, 1), {}, False),
        ((0, 0, GIB, int(0.2 * GIB), 30_000, 1), {}, True),
        ((0, 0, 2 * GIB, int(2.17 * GIB), 100_000, 50), {"max_geometry_gib": 5.0}, True),
    ],
)
def test_readiness(spark, row, limits, ok):
    judged = readiness.readiness(spark.createDataFrame([row], STATS), **limits).first()
    assert judged.ok is ok and bool(judged.reasons) is not ok


def test_readiness_names_its_reasons(spark):
    rows = [(0, 0, 2 * GIB, int(2.17 * GIB), 460_350, 1), (0, 0, 11 * GIB, None, None, None)]
    heavy, large = readiness.readiness(spark.createDataFrame(rows, STATS)).collect()
    assert heavy.reasons == ["geometry is 2.2 GB uncompressed", "460,350 features", "only 1 row groups"]
    assert large.reasons == ["file is 11.0 GB"]


def test_configured_caches(spark):
    sources = spark.createDataFrame(
        [("a", "x", "y"), ("b", "x", None), ("c", None, "")],
        "source string, optimized_data string, aoo_grid_cache_url string",
    )
    counted = readiness.configured_caches(sources, spark.createDataFrame([("x",), ("x",)], "path string"))
    assert {r.source: (r.n_configured, r.n_missing) for r in counted.collect()} == {
        "a": (2, 1), "b": (1, 0), "c": (0, 0),
    }


def test_index_file_keeps_codes_as_text(spark, tmp_path):
    index = spark.createDataFrame([(1, "007", "a, \"b\""), (2, "10", "c")], layout.INDEX_SCHEMA)
    path = layout.write_index(index, str(tmp_path / "index"))
    assert sorted(map(tuple, layout.read_index(spark, path).collect())) == [(1, "007", "a, \"b\""), (2, "10", "c")]


def rows_scanned(df):
    """Rows that the scan of a query hands on, from its own metrics."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    found = []

    def walk(node):
        if node.nodeName().startswith("Scan parquet"):
            found.append(node.metrics().apply("numOutputRows").value())
        inner = node.getClass().getSimpleName()
        if inner == "AdaptiveSparkPlanExec":
            walk(node.executedPlan())
        elif inner.endswith("QueryStageExec"):
            walk(node.plan())
        for k in range(node.children().size()):
            walk(node.children().apply(k))

    walk(plan)
    return sum(found)


@pytest.mark.parametrize("distinct", [3, 500])
def test_row_groups_are_skipped_by_value(spark, tmp_path, distinct):
    # each value stands in one run of rows, and the runs are in no order
    rows = spark.range(40_000).selectExpr("hash(floor(id / 400)) AS k", "id AS v").repartition(1).sortWithinPartitions("v")
    plain, filtered = str(tmp_path / "plain"), str(tmp_path / "filtered")
    rows.write.parquet(plain)
    layout.write_filtered_copy(rows, filtered, "k", 1000, distinct)
    value = rows.where("v = 20000").first().k

    def one(path):
        return spark.read.parquet(path).where(F.col("k") == value)

    assert one(filtered).count() == one(plain).count() == 400
    # ranges tell nothing here, pages of 20,000 rows are all that plain files skip
    assert rows_scanned(one(filtered)) <= 3_000 < 10_000 <= rows_scanned(one(plain))
    with pytest.raises(ValueError, match="no column 'x'"):
        layout.write_filtered_copy(rows, str(tmp_path / "x"), "x")
