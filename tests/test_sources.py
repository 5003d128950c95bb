import json
import struct

import pytest
from pyspark.sql import functions as F

from conftest import ALPINE, WATER_BOX
from ecoledger.operators import rings
from ecoledger.sources import layout, vector


def feature(code, kind, coordinates, **props):
    return {
        "type": "Feature",
        "properties": {"ECO_CODE": code, "ECO_NAME": f"name {code}", **props},
        "geometry": {"type": kind, "coordinates": coordinates},
    }


MAP = [
    feature("M1", "Polygon", [WATER_BOX + WATER_BOX[:1], ALPINE + ALPINE[:1]], EFG1="M1.1"),
    feature("T6", "MultiPolygon", [[ALPINE + ALPINE[:1]], [[[1, 1], [2, 1], [2, 2], [1, 1]]]], EFG1="T6.5"),
]
SOURCE = dict(name_column="ECO_NAME", code_column="ECO_CODE", group_column="EFG1")


def ring_sizes(features):
    rows = rings.rings(features).orderBy("code", "part", "ring").collect()
    return [(r.code, r.part, r.ring, len(r.points)) for r in rows]


WANT = [("M1", 0, 0, 4), ("M1", 0, 1, 9), ("T6", 0, 0, 9), ("T6", 1, 0, 3)]


def test_geojson_collection(spark, tmp_path):
    path = tmp_path / "map.geojson"
    path.write_text(json.dumps({"type": "FeatureCollection", "features": MAP}, indent=1))
    features = vector.load_geojson(spark, vector.MapSource(str(path), **SOURCE))
    assert ring_sizes(features) == WANT
    first = features.orderBy("src_ordinal").first()
    assert (first.code, first.name, first.fg) == ("M1", "name M1", "M1.1")


def test_geojson_lines(spark, tmp_path):
    path = tmp_path / "map.geojsonl"
    path.write_text("\n".join(json.dumps(f) for f in MAP))
    features = vector.load_geojson(spark, vector.MapSource(str(path), **SOURCE), lines=True)
    assert ring_sizes(features) == WANT
    assert [r.code for r in features.orderBy("src_ordinal").collect()] == ["M1", "T6"]
    assert features.select("fid").distinct().count() == 2


def test_parquet_map_with_nested_and_wkb_geometry(spark, tmp_path, island):
    plain = island.select(
        F.col("code").alias("c"), F.col("name").alias("n"), F.col("geometry").alias("shape")
    )
    plain.coalesce(1).write.parquet(str(tmp_path / "nested"))
    plain.withColumn("shape", vector.encode_wkb(F.col("shape"))).coalesce(1).write.parquet(
        str(tmp_path / "wkb")
    )
    seen = []
    for kind in ("nested", "wkb"):
        source = vector.MapSource(
            str(tmp_path / kind), name_column="n", code_column="c", group_column="no", geometry_column="shape"
        )
        features = vector.load_map(spark, source)
        assert features.select("fg").distinct().collect()[0].fg is None
        seen.append(rings.rings(features).orderBy("code", "ring").select("code", "part", "ring", "points").collect())
    assert seen[0] == seen[1]


def test_attribute_scan_never_reads_geometry(spark, tmp_path, island):
    island.select(F.col("code").alias("c"), "geometry").write.parquet(str(tmp_path / "m"))
    attributes = vector.load_attributes(spark, vector.MapSource(str(tmp_path / "m"), name_column="c"))
    plan = attributes._jdf.queryExecution().executedPlan().toString()
    assert "geometry" not in plan.split("ReadSchema")[-1]
    assert {(r.code, r.name) for r in attributes.collect()} == {("M1.1.1", "M1.1.1"), ("T6.5.1", "T6.5.1")}


def test_one_class_is_pushed_down(spark, tmp_path, island):
    island.select(F.col("code").alias("c"), "geometry").write.parquet(str(tmp_path / "m"))
    features = vector.load_map(spark, vector.MapSource(str(tmp_path / "m"), name_column="c"))
    one = vector.one_class(features, "T6.5.1")
    assert "EqualTo(c,T6.5.1)" in one._jdf.queryExecution().executedPlan().toString()
    assert one.count() == 1


def test_ordinals_follow_file_order(spark, tmp_path):
    path = str(tmp_path / "odd dir é%20x+y")
    for low in (0, 100):
        part = spark.range(low, low + 100, 1, 1).select(F.col("id").cast("string").alias("c"))
        part.write.mode("append").parquet(path)
    rows = vector.load_attributes(spark, vector.MapSource(path, name_column="c")).orderBy("src_ordinal")
    codes = [int(r.code) for r in rows.collect()]
    assert sorted(codes) == list(range(200))
    assert codes in (list(range(200)), list(range(100, 200)) + list(range(100)))


def test_roles():
    assert vector.MapSource("d", name_column="n").key_column == "n"
    assert vector.MapSource("d", name_column="n", code_column="c").key_column == "c"
    assert vector.MapSource("d", "n", optimized_data="o").preferred == "o"
    with pytest.raises(ValueError):
        vector.MapSource("d").key_column


def test_missing_group_column_is_noted(spark):
    df = spark.createDataFrame([("a", "g")], "n string, g string")
    assert vector.missing_group_note(df, vector.MapSource("d", "n", group_column="g")) is None
    assert vector.missing_group_note(df, vector.MapSource("d", "n")) is None
    assert "columns: n, g" in vector.missing_group_note(df, vector.MapSource("d", "n", group_column="h"))


def test_missing_key_column_is_named(spark, tmp_path):
    spark.range(2).write.parquet(str(tmp_path / "m"))
    with pytest.raises(ValueError, match="columns: id"):
        vector.load_attributes(spark, vector.MapSource(str(tmp_path / "m"), name_column="eco"))


@pytest.mark.parametrize("address", ["x_10m.tif", "https://h/ECO.TIFF?token=abc", "a.tif/"])
def test_rasters_are_refused(address):
    with pytest.raises(ValueError, match="cog_url"):
        vector.vector_address(address)
    assert vector.vector_address("https://h/eco.parquet") == "https://h/eco.parquet"


def wkb(order, code, dims, points, srid=b""):
    sign = "<" if order == 1 else ">"
    head = struct.pack(f"{sign}BI", order, code) + srid
    ring = struct.pack(f"{sign}II", 1, len(points))
    return head + ring + b"".join(struct.pack(f"{sign}{dims}d", *p) for p in points)


@pytest.mark.parametrize(
    "data",
    [
        wkb(1, 3, 2, [(0, 0), (1, 0), (1, 1), (0, 0)]),
        wkb(0, 3, 2, [(0, 0), (1, 0), (1, 1), (0, 0)]),
        wkb(1, 1003, 3, [(0, 0, 9), (1, 0, 9), (1, 1, 9), (0, 0, 9)]),
        wkb(1, 3003, 4, [(0, 0, 9, 9), (1, 0, 9, 9), (1, 1, 9, 9), (0, 0, 9, 9)]),
        wkb(1, 0x80000003, 3, [(0, 0, 9), (1, 0, 9), (1, 1, 9), (0, 0, 9)]),
        wkb(1, 0x20000003, 2, [(0, 0), (1, 0), (1, 1), (0, 0)], struct.pack("<I", 4326)),
    ],
)
def test_wkb_forms(data):
    (part,) = vector._parse_wkb(data)
    assert [ring.tolist() for ring in part] == [[[0, 0], [1, 0], [1, 1], [0, 0]]]


def test_wkb_nulls_and_empty_batches(spark):
    rows = [(1, None), (2, bytearray(wkb(1, 3, 2, [(0, 0), (1, 0), (1, 1), (0, 0)])))]
    df = spark.createDataFrame(rows, "id int, geometry binary")
    got = {r.id: r.geometry for r in vector.decode_wkb(df).collect()}
    assert got == {1: None, 2: [[[[0.0, 0.0], [1.0, 0.0], [1.0, 1.0], [0.0, 0.0]]]]}
    assert vector.decode_wkb(df.where("id > 5")).collect() == []
    only_null = vector.decode_wkb(df.where("id = 1")).collect()
    assert [r.geometry for r in only_null] == [None]


def test_other_wkb_is_an_error():
    with pytest.raises(ValueError, match="not a polygon"):
        vector._parse_wkb(struct.pack("<BIdd", 1, 1, 0.0, 0.0))


def test_rings_survive_the_long_form(island):
    made = rings.rings(island)
    back = rings.rings_from_vertices(rings.vertices(made))
    key = ["code", "part", "ring"]
    assert back.orderBy(key).select(*key, "points").collect() == made.orderBy(key).select(*key, "points").collect()


def test_bounds(island):
    assert tuple(rings.bounds(rings.rings(island)).first()) == (-0.06, -0.05, 0.06, 0.05)


def test_cell_table_is_reused(spark, tmp_path, island):
    made = layout.cells_cached(spark, island, None)
    path = layout.write_cells(made, str(tmp_path / "cells"))
    stored = layout.cells_cached(spark, island.limit(0), path)
    assert sorted(map(tuple, stored.collect())) == sorted(map(tuple, made.collect()))
