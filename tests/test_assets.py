import os

import pytest

from ecoledger.sources import assets


def rows_of(spark, n, extra=""):
    return spark.range(n).selectExpr("'x' AS path", "md5(string(id % 40)) AS digest", "'js' AS ext", f"repeat(concat('é', id % 40, '{extra}'), 900) AS body")


def test_each_asset_is_stored_once_and_whole(spark, tmp_path):
    folder = str(tmp_path / "deep" / "assets")
    given = rows_of(spark, 400).repartition(6)
    assets.write_assets(given, folder)
    first = {n: os.stat(f"{folder}/{n}").st_mtime_ns for n in os.listdir(folder)}
    assert len(first) == 40 and not any(n.startswith(".") for n in first)
    assets.write_assets(rows_of(spark, 41).unionByName(rows_of(spark, 1).selectExpr("path", "'fresh' AS digest", "'css' AS ext", "'b' AS body")), folder)
    second = {n: os.stat(f"{folder}/{n}").st_mtime_ns for n in os.listdir(folder)}
    # what was there has not been touched
    assert {n: second[n] for n in first} == first and set(second) - set(first) == {"fresh.css"}
    want = {(r.digest, r.ext): r.body.encode() for r in given.collect()} | {("fresh", "css"): b"b"}
    assert {(r.digest, r.ext): bytes(r.body) for r in assets.stored_assets(spark, folder).collect()} == want


def test_empty_and_odd_input(spark, tmp_path):
    folder = str(tmp_path / "assets")
    assets.write_assets(rows_of(spark, 0), folder)
    assets.write_assets(spark.createDataFrame([("d", "js", None), ("e", "js", "")], "digest string, ext string, body string"), f"file:{folder}")
    assert sorted(os.listdir(folder)) == ["d.js", "e.js"] and os.path.getsize(f"{folder}/d.js") == 0
    with pytest.raises(Exception, match="missing: body"):
        spark.range(1).selectExpr("'a' AS digest", "'b' AS ext").write.format(assets.SINK).mode("append").save(folder)
    with pytest.raises(Exception, match="no other version"):
        rows_of(spark, 1).drop("path").write.format(assets.SINK).mode("overwrite").save(folder)
