import pytest

from ecoledger.plans import caches
from ecoledger.sources import layout, vector
from ecoledger.sources.vector import MapSource, encode_wkb


@pytest.fixture()
def stored_map(island, tmp_path):
    path = str(tmp_path / "map.parquet")
    rows = island.withColumn("geometry", encode_wkb(island["geometry"]))
    rows.selectExpr("code AS ECO_CODE", "name AS ECO_NAME", "geometry").coalesce(1).write.parquet(path)
    (file,) = (tmp_path / "map.parquet").glob("*.parquet")
    return str(file)


def test_caches_are_written_once_each(spark, stored_map, tmp_path):
    source = MapSource(
        stored_map, name_column="ECO_NAME", code_column="ECO_CODE",
        optimized_data=str(tmp_path / "sorted.parquet"), cell_table=str(tmp_path / "cells.parquet"),
    )
    made = caches.build_caches(spark, source)
    assert not made.reused and made.source.optimized_data == source.optimized_data
    assert spark.read.parquet(source.optimized_data).count() == 2
    cells = layout.cells_of_class(spark, source.cell_table, "T6.5.1")
    assert cells.count() == 4
    assert "EqualTo(code,T6.5.1)" in cells._jdf.queryExecution().executedPlan().toString()


def test_only_what_is_configured_is_written(spark, stored_map, tmp_path):
    source = MapSource(stored_map, code_column="ECO_CODE", cell_table=str(tmp_path / "only.parquet"))
    assert caches.build_caches(spark, source).source.optimized_data is None
    assert {p.name for p in tmp_path.iterdir()} == {"map.parquet", "only.parquet"}


def test_unreadable_source_is_named(spark, tmp_path):
    (tmp_path / "x.parquet").write_text("no")
    with pytest.raises(ValueError, match="x.parquet"):
        caches.build_caches(spark, MapSource(str(tmp_path / "x.parquet"), code_column="c"))


def test_readiness_of_sources(spark, stored_map):
    rows = [
        ("map", stored_map, None, None), ("cached", "gs://b/m.parquet", "gs://b/s.parquet", None),
        ("json", "gs://b/m.geojson", None, None), ("lost", "gs://b/lost.parquet", None, None),
    ]
    sources = spark.createDataFrame(rows, "source string, data string, optimized_data string, aoo_grid_cache_url string")
    listing = spark.createDataFrame(
        [(stored_map, 900), ("gs://b/s.parquet", 1), ("gs://b/m.geojson", 3 * 1024**3)], "path string, length bigint"
    )
    got = {r.source: r for r in caches.source_readiness(sources, listing).collect()}
    assert got["map"].ok and got["map"].num_rows == 2 and got["map"].size_bytes == 900
    assert got["cached"].ok and got["cached"].n_configured == 1
    assert not got["json"].ok and got["json"].reasons == ["file is 3.0 GB"]
    assert got["lost"].ok and got["lost"].problem == "the source is not in the listing"
    strict = {r.source: r.ok for r in caches.source_readiness(sources, listing, max_features=2).collect()}
    assert not strict["map"]


def geo_file(path, table, described):
    import json

    import pyarrow.parquet as pq

    meta = {b"geo": json.dumps(described).encode()} if described is not None else {}
    pq.write_table(table.replace_schema_metadata(meta), path)


@pytest.fixture()
def renamed(island):
    """The island map as Arrow, with its geometry under another name."""
    rows = island.withColumn("shape_wkb", encode_wkb(island["geometry"]))
    return rows.selectExpr("code AS ECO_CODE", "name AS ECO_NAME", "shape_wkb").toArrow()


def test_metadata_names_the_geometry(spark, renamed, tmp_path, island):
    path = str(tmp_path / "map.parquet")
    crs84 = {"type": "GeographicCRS", "name": "WGS 84 (CRS84)", "id": {"authority": "OGC", "code": "CRS84"}}
    geo_file(path, renamed, {"primary_column": "shape_wkb", "columns": {"shape_wkb": {"encoding": "WKB", "crs": crs84}}})
    source = MapSource(path, code_column="ECO_CODE")
    assert vector.described(spark, source).geometry_column == "shape_wkb"
    read = vector.load_map(spark, source)
    assert read.count() == island.count() and read.where("size(geometry) = 0").count() == 0
    made = caches.build_caches(spark, MapSource(path, code_column="ECO_CODE", optimized_data=str(tmp_path / "s.parquet"), cell_table=str(tmp_path / "c.parquet")))
    assert made.source.geometry_column == "shape_wkb"
    assert spark.read.parquet(made.source.cell_table).count() == layout.cells_cached(spark, island, None).count()


@pytest.mark.parametrize(
    "crs, told",
    [({"type": "ProjectedCRS", "name": "MAGNA-SIRGAS / Origen-Nacional"}, "Origen-Nacional"), (None, "unknown"), ("EPSG:3857", "3857")],
)
def test_projected_maps_are_refused_by_name(spark, renamed, tmp_path, crs, told):
    path = str(tmp_path / "map.parquet")
    geo_file(path, renamed, {"primary_column": "shape_wkb", "columns": {"shape_wkb": {"crs": crs}}})
    with pytest.raises(ValueError, match=f"map.parquet.*{told}.*longitude"):
        vector.load_map(spark, MapSource(path, code_column="ECO_CODE"))


def test_odd_metadata_tells_nothing(spark, renamed, tmp_path):
    for k, told in enumerate(({"primary_column": 3, "columns": 4}, [], {"columns": {"geometry": {"crs": None}}})):
        path = str(tmp_path / f"{k}.parquet")
        geo_file(path, renamed.rename_columns(["ECO_CODE", "ECO_NAME", "geometry"]) if k < 2 else renamed, told)
        if k < 2:
            assert vector.described(spark, MapSource(path, code_column="ECO_CODE")).geometry_column in ("geometry", "3")
        else:
            with pytest.raises(ValueError, match="unknown"):
                vector.described(spark, MapSource(path, code_column="ECO_CODE"))


def test_files_that_disagree_are_refused(spark, renamed, tmp_path):
    folder = tmp_path / "map.parquet"
    folder.mkdir()
    geo_file(str(folder / "a.parquet"), renamed, {"primary_column": "shape_wkb"})
    geo_file(str(folder / "b.parquet"), renamed, {"primary_column": "ECO_NAME"})
    with pytest.raises(ValueError, match="disagree.*ECO_NAME, shape_wkb"):
        vector.described(spark, MapSource(str(folder), code_column="ECO_CODE"))
    assert vector.described(spark, MapSource(str(folder), code_column="c", geometry_column="g")).geometry_column == "g"


def test_caches_of_a_geojson_map(spark, island, tmp_path):
    import json

    made = [
        {"type": "Feature", "properties": {"ECO_CODE": r.code, "ECO_NAME": r.name},
         "geometry": {"type": "MultiPolygon", "coordinates": r.geometry}}
        for r in island.collect()
    ]
    path = tmp_path / "map.geojson"
    path.write_text(json.dumps({"type": "FeatureCollection", "features": made}))
    for copy in (str(tmp_path / "s.parquet"), None):
        source = MapSource(
            str(path), name_column="ECO_NAME", code_column="ECO_CODE", optimized_data=copy,
            cell_table=str(tmp_path / f"cells-{copy is None}.parquet"),
        )
        built = caches.build_caches(spark, source)
        assert not built.reused and built.source.optimized_data == copy
        cells = spark.read.parquet(source.cell_table)
        assert sorted(map(tuple, cells.collect())) == sorted(map(tuple, layout.cells_cached(spark, island, None).collect()))
    assert spark.read.parquet(str(tmp_path / "s.parquet")).columns == ["ECO_CODE", "ECO_NAME", "geometry"]


def test_a_configured_copy_is_written_though_the_source_is_sorted(spark, stored_map, tmp_path):
    first = caches.build_caches(spark, MapSource(stored_map, code_column="ECO_CODE", optimized_data=str(tmp_path / "one.parquet")))
    (sorted_file,) = [str(p) for p in (tmp_path / "one.parquet").glob("*.parquet")][:1]
    again = MapSource(sorted_file, code_column="ECO_CODE", optimized_data=str(tmp_path / "two.parquet"))
    made = caches.build_caches(spark, again)
    assert first.source.optimized_data and not made.reused and made.source.optimized_data == again.optimized_data
    assert spark.read.parquet(again.optimized_data).count() > 0
