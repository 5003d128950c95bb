import pytest
from pyspark.sql import functions as F

from ecoledger.functions import text


def column(spark, values, make):
    rows = [(i, v) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, "i int, v string").withColumn("out", make(F.col("v")))
    return [r.out for r in df.orderBy("i").collect()]


def test_natural_order(spark):
    codes = ["T10.1", "t2.10", "T2.9", "T2.1", "M1.1.1", "10", "9", "T2-x", "T2", "x007", "x7a", "X8"]
    df = spark.createDataFrame([(c,) for c in codes], "code string")
    got = [r.code for r in df.orderBy(text.natural_key(F.col("code")), "code").collect()]
    assert got == ["9", "10", "M1.1.1", "T2", "T2-x", "T2.1", "T2.9", "t2.10", "T10.1", "x007", "x7a", "X8"]


def test_natural_order_of_very_long_numbers(spark):
    codes = ["a" + "9" * 20, "a1" + "0" * 20, "a2"]
    df = spark.createDataFrame([(c,) for c in codes], "code string")
    got = [r.code for r in df.orderBy(text.natural_key(F.col("code"))).collect()]
    assert got == ["a2", "a" + "9" * 20, "a1" + "0" * 20]


def test_raster_guard(spark):
    urls = ["https://h/x_10m.tif", "https://h/ECO.TIFF?token=abc", "https://h/eco.parquet", "a.tif/"]
    assert column(spark, urls, text.is_raster) == [True, True, False, True]


def test_stems(spark):
    urls = ["https://h/map.parquet?token=abc", "gs://b/dir/map.parquet/", "a/b.tar.gz", "/", ".parquet", "plain"]
    assert column(spark, urls, text.data_stem) == ["map", "map", "b.tar", "ecosystems", ".parquet", "plain"]


def test_cache_addresses(spark):
    made = text.cache_addresses(F.lit("proj"), F.lit("gs://b/map.parquet"))
    row = spark.range(1).select(*[c.alias(k) for k, c in made.items()]).first()
    assert row.optimized_data == "gs://proj-caches/map_sorted.parquet"
    assert row.aoo_grid_cache_url == "gs://proj-caches/map_aoo_grid.parquet"


def test_schemes(spark):
    urls = ["gs://b/x", "GS://b/x", "s3://b", "/local/x", "https://h"]
    assert column(spark, urls, text.is_remote) == [True, False, True, False, True]
    assert column(spark, urls[:1], text.public_address) == ["https://storage.googleapis.com/b/x"]


@pytest.mark.parametrize(
    "index, code, name, label",
    [
        (1, "M1", "Shelf", "1 · M1 - Shelf"),
        (None, "M1", "Shelf", "M1 - Shelf"),
        (2, "Shelf", "Shelf", "2 · Shelf"),
    ],
)
def test_chapter_label(spark, index, code, name, label):
    df = spark.createDataFrame([(index, code, name)], "i int, c string, n string")
    assert df.select(text.chapter_label(F.col("i"), F.col("c"), F.col("n"))).first()[0] == label


def test_template_is_filled_literally(spark):
    template = "# Shelf (M1)\necosystem_code = \"M1\"\n  ecosystem_code = 'keep'\n## M1 Criterion B\n"
    df = spark.createDataFrame([("a$1\\b", "N$0", "ff"), ("c", "n", None)], "c string, n string, h string")
    filled = df.select(
        text.fill_template(F.lit(template), F.col("c"), F.col("n"), F.col("h"), "M1", "Shelf").alias("t")
    ).collect()
    assert filled[0].t == (
        "# N$0 (a$1\\b)\necosystem_code = 'a$1\\b'  # source-config sha256: ff\n"
        "  ecosystem_code = 'keep'\n## a$1\\b Criterion B\n"
    )
    assert "ecosystem_code = 'c'\n" in filled[1].t


def test_small_rules(spark):
    assert column(spark, ["p.html", "a/b/p.html"], text.relative_prefix) == ["", "../../"]
    assert column(spark, ["12.5", None], lambda c: text.metric_text(c, 1)) == ["12.5", "N/A"]
    assert column(spark, ["x"], lambda c: text.legend_label(c, F.lit(None).cast("string"))) == ["x"]
