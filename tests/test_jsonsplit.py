import json
import random

import pytest
from pyspark.sql import functions as F

from ecoledger.sources import jsonsplit, vector

SOURCE = dict(name_column="name", code_column="code")


def features(n, seed=0):
    rng = random.Random(seed)
    texts = ['a"b', "back\\", '\\"', "{[}]", 'x}{"type":"Feature"', "é漢😀", "\\\\\\", "line\nbreak", "", '"}]}', "a" * 900]
    made = []
    for k in range(n):
        ring = [[rng.uniform(-9, 9), rng.uniform(-9, 9)] for _ in range(rng.choice([3, 5, 400]))]
        kind = rng.random() < 0.5
        feature = {
            "properties": {"code": f"c{k % 5}", "name": rng.choice(texts), "more": {"deep": [{"type": "Feature"}, "]"]}},
            "type": "Feature",
            "geometry": {"type": "Polygon" if kind else "MultiPolygon", "coordinates": [ring] if kind else [[ring], [ring[:3]]]},
        }
        keys = list(feature)
        rng.shuffle(keys)
        made.append({key: feature[key] for key in keys})
    return made


def collection(made, **extra):
    return {"type": "FeatureCollection", "bbox": [1, 2, [3]], "crs": {"name": "x", "of": [{"not": "one"}]}, **extra, "features": made}


@pytest.fixture
def small_splits(spark):
    def with_bytes(n):
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(n))
        spark.conf.set("spark.sql.files.openCostInBytes", "1")
        spark.conf.set("spark.sql.files.minPartitionNum", "1")

    yield with_bytes
    for name in ("maxPartitionBytes", "openCostInBytes", "minPartitionNum"):
        spark.conf.unset(f"spark.sql.files.{name}")


@pytest.mark.parametrize("split_bytes, indent", [(2000, None), (5000, 1), (64 << 20, None)])
def test_split_reading_equals_parsing_the_whole(spark, tmp_path, small_splits, split_bytes, indent):
    made = {f"{k}.geojson": features(60, k) for k in range(2)}
    for name, some in made.items():
        ascii_only = name.startswith("0")
        (tmp_path / name).write_text(json.dumps(collection(some), indent=indent, ensure_ascii=ascii_only), encoding="utf-8")
    small_splits(split_bytes)
    rows = jsonsplit.array_objects(spark, str(tmp_path)).collect()
    for name, some in made.items():
        mine = sorted((r for r in rows if r.file.endswith(name)), key=lambda r: (r.block, r.at))
        assert [json.loads(r.value) for r in mine] == some
    assert (len({(r.file, r.block) for r in rows}) > 10) == (split_bytes <= 5000)


def test_split_maps_equal_whole_maps(spark, tmp_path, small_splits):
    path = tmp_path / "map.geojson"
    path.write_text(json.dumps(collection(features(80, 3))))
    source = vector.MapSource(str(path), **SOURCE)
    whole = vector.load_geojson(spark, source).orderBy("src_ordinal").select("code", "name", "geometry").collect()
    small_splits(3000)
    read = vector.load_geojson(spark, source, split=True)
    assert vector.geojson_text(spark, source, split=True).select(F.spark_partition_id()).distinct().count() > 1
    assert read.orderBy("src_ordinal").select("code", "name", "geometry").collect() == whole
    assert whole[0].geometry


def test_odd_documents(spark, tmp_path):
    for k, text in enumerate(["", "\n", "{}", '{"features":[]}', '{"features":[1,"}"]}', '[{"a":1}]', '{"features":[{"a":"}"} , {}]}\n']):
        (tmp_path / f"{k}.json").write_text(text)
    rows = jsonsplit.array_objects(spark, str(tmp_path)).orderBy("block", "at").collect()
    assert [r.value for r in rows] == ['{"a":"}"}', "{}"]


def test_geojson_is_parsed_once(spark):
    text = json.dumps(features(1)[0])
    rows = spark.createDataFrame([(1, 1, text)], "fid long, src_ordinal long, value string")
    from ecoledger.operators import rings

    out = rings.vertices(rings.rings(vector.geojson_features(rows, vector.MapSource("", **SOURCE))))
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    # the feature, and the coordinates by either kind
    assert plan.count("from_json") == 3
