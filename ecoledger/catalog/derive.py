"""Maps, records and pages that Spark derives from the given tables.

The tables hold no geometry, so polygons and points are laid out by integer
arithmetic on row keys; every row of a table is used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Offsets in degrees of the three polygon shapes, chosen by key modulo 3.
SHAPES = {
    0: [[(0.02, 0.02), (0.37, 0.02), (0.37, 0.31), (0.02, 0.31)]],
    1: [[(0.03, 0.05), (0.35, 0.08), (0.11, 0.36)]],
    2: [
        [(0.01, 0.01), (0.39, 0.01), (0.39, 0.39), (0.01, 0.39)],
        [(0.1, 0.1), (0.3, 0.12), (0.22, 0.29)],
    ],
}
COUNTRY = "Ruritania"
PROJECT = "sample-project"


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def _spread(df: DataFrame, key: str) -> DataFrame:
    """Spread narrow rows over all cores before they are made wide."""
    return df.repartition(2 * df.sparkSession.sparkContext.defaultParallelism, key)


def _geometry(key: Column, stretch: float) -> Column:
    """One polygon per key in a lattice slot of 0.4 degrees, 400 by 225 slots."""
    lon0 = (key % 400) * 0.4 - 80
    lat0 = (F.floor(key / 400) % 225) * 0.4 - 30

    def shape(rings) -> Column:
        return F.array(
            F.array(
                *[
                    F.array(
                        *[
                            F.array(lon0 + dx * stretch, lat0 + dy * stretch)
                            for dx, dy in ring
                        ]
                    )
                    for ring in rings
                ]
            )
        )

    return (
        F.when(key % 3 == 0, shape(SHAPES[0]))
        .when(key % 3 == 1, shape(SHAPES[1]))
        .otherwise(shape(SHAPES[2]))
    )


def polygon_map(spark: SparkSession, sf: str, stretch: float = 1.0) -> DataFrame:
    """One feature per customer: nation is the code, region the functional group.

    With ``stretch`` above 1 neighbouring polygons overlap.
    """
    customer, nation, region = (table(spark, sf, t) for t in ("customer", "nation", "region"))
    placed = customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey"), "left").join(
        region, F.col("n_regionkey") == F.col("r_regionkey"), "left"
    )
    key = F.col("c_custkey")
    return _spread(placed.select("c_custkey", "c_nationkey", "n_name", "r_name"), "c_custkey").select(
        key.alias("fid"),
        F.concat(F.lit("N"), F.col("c_nationkey").cast("string")).alias("code"),
        F.col("n_name").alias("name"),
        F.col("r_name").alias("fg"),
        key.alias("src_ordinal"),
        _geometry(key, stretch).alias("geometry"),
    )


def order_map(spark: SparkSession, sf: str) -> DataFrame:
    """One feature per order with its customer's polygon: most shapes are repeated."""
    orders = _spread(table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderpriority"), "o_orderkey")
    return orders.select(
        F.col("o_orderkey").alias("fid"),
        F.col("o_orderpriority").alias("code"),
        F.col("o_orderkey").alias("src_ordinal"),
        _geometry(F.col("o_custkey"), 1.0).alias("geometry"),
    )


def nearly_twice(spark: SparkSession, sf: str) -> DataFrame:
    """Four squares a supplier: two far apart, and between them two that are one if its key is even, else nearly coincide."""
    key = F.col("s_suppkey")
    step = 0.01 * (key % 2)

    def square(lon: Column, lat: Column, side: float) -> Column:
        corners = ((0.0, 0.0), (side, 0.0), (side, side), (0.0, side))
        return F.array(F.array(F.array(*[F.array(lon + dx, lat + dy) for dx, dy in corners])))

    lon0, lat0 = (key % 50) * 3.0 - 80, (F.floor(key / 50) % 20) * 3.0 - 30
    each = F.array(
        square(lon0, lat0, 0.03), square(lon0 + 2.0, lat0 + 2.0, 0.03),
        square(lon0 + 1.0, lat0 + 1.0, 0.04), square(lon0 + 1.0 + step, lat0 + 1.0 + step, 0.04),
    )
    return _spread(table(spark, sf, "supplier").select("s_suppkey"), "s_suppkey").select(
        "s_suppkey", F.concat(F.lit("S"), key.cast("string")).alias("code"), F.posexplode(each).alias("n", "geometry")
    ).select(
        (F.col("s_suppkey") * 4 + F.col("n")).alias("fid"), "code",
        (F.col("s_suppkey") * 4 + F.col("n")).alias("src_ordinal"), "geometry",
    )


def point_map(spark: SparkSession, sf: str) -> DataFrame:
    """(code, lon, lat): one wide-spread point per customer."""
    key = F.col("c_custkey")
    return table(spark, sf, "customer").select(
        F.concat(F.lit("N"), F.col("c_nationkey").cast("string")).alias("code"),
        (((key * 7919) % 20000) / 100.0 - 100).alias("lon"),
        (((key * 104729) % 12000) / 100.0 - 60).alias("lat"),
    )


def part_features(spark: SparkSession, sf: str) -> DataFrame:
    """Attribute-only features: brand is the code; names and groups are partly unknown."""
    key = F.col("p_partkey")
    return table(spark, sf, "part").select(
        key.alias("fid"),
        F.col("p_brand").alias("code"),
        F.when(key % 5 != 0, F.concat_ws(" ", "p_type", "p_name")).alias("name"),
        F.when(F.col("p_size") % 3 != 0, F.concat(F.lit("G"), (F.col("p_size") % 7).cast("string"))).alias("fg"),
        key.alias("src_ordinal"),
    )


def group_names(spark: SparkSession, sf: str) -> DataFrame:
    """(language, fg, fg_name, biome, realm) with one row per region and language."""
    region = table(spark, sf, "region")
    languages = F.array(
        F.struct(F.lit("spanish").alias("language"), F.lit("Grupo ").alias("word")),
        F.struct(F.lit("english").alias("language"), F.lit("Group ").alias("word")),
    )
    return region.select("r_regionkey", "r_name", F.inline(languages)).select(
        "language",
        F.col("r_name").alias("fg"),
        F.concat("word", "r_name").alias("fg_name"),
        F.concat(F.lit("B"), (F.col("r_regionkey") % 3).cast("string")).alias("biome"),
        F.when(F.col("r_regionkey") % 2 == 0, F.lit("T")).otherwise(F.lit("M")).alias("realm"),
    )


def customer_records(spark: SparkSession, sf: str) -> DataFrame:
    """(code, name, record_text): one assessment record per customer."""
    return table(spark, sf, "customer").select(
        F.concat(F.lit("C"), F.col("c_custkey").cast("string")).alias("code"),
        F.col("c_name").alias("name"),
        F.concat_ws("|", "c_name", "c_mktsegment").alias("record_text"),
        "c_acctbal",
    )


def rendered_widgets(spark: SparkSession, sf: str) -> DataFrame:
    """(page_id, path, html): the given pages with a state block of map bundles.

    Each page embeds one of seven large scripts twice, a small style and its
    own markup as a second style.
    """
    pages = _spread(table(spark, sf, "pages"), "page_id")
    script = F.concat(
        F.lit("bundle "), (F.col("page_id") % 7).cast("string"),
        F.repeat(F.lit('; call("</script>", \'\\n\')'), 200),
    )
    model = F.struct(F.struct(script.alias("_esm"), F.lit("p{}").alias("_css"), F.lit(3).alias("height")).alias("state"))
    own = F.struct(F.struct(script.alias("_esm"), F.col("html").alias("_css")).alias("state"))
    block = F.to_json(F.struct(F.struct(model.alias("m0"), own.alias("m1")).alias("state")))
    depth = F.repeat(F.lit("d/"), (F.col("page_id") % 4).cast("int"))
    return pages.select(
        "page_id",
        F.concat(depth, F.lit("p"), F.col("page_id").cast("string"), F.lit(".html")).alias("path"),
        F.concat(
            F.lit('<html><script type="application/vnd.jupyter.widget-state+json">'),
            F.replace(block, F.lit("</"), F.lit("<\\/")),
            F.lit("</script>"), F.col("html"), F.lit("</html>"),
        ).alias("html"),
    )


def odd_widgets(spark: SparkSession, sf: str) -> DataFrame:
    """(page_id, path, html): the given pages with state blocks of many kinds, by page_id modulo 6.

    0 a large script beside a model that is text, 1 the script field twice, 2 a lone
    surrogate, 3 no JSON, 4 a model whose state is a list, 5 a script as it should be.
    """
    pages = _spread(table(spark, sf, "pages"), "page_id")
    kind = F.col("page_id") % 6
    large = F.concat(F.lit("bundle "), (F.col("page_id") % 5).cast("string"), F.repeat(F.lit(" x"), 3000))
    block = (
        F.when(kind == 0, F.concat(F.lit('{"state":{"m0":"text","m1":{"state":{"_esm":"'), large, F.lit('"}}}}')))
        .when(kind == 1, F.concat(F.lit('{"state":{"m":{"state":{"_esm":"a","_esm":"'), large, F.lit('"}}}}')))
        .when(kind == 2, F.concat(F.lit('{"state":{"m":{"state":{"_esm":"\\ud800'), large, F.lit('"}}}}')))
        .when(kind == 3, F.concat(F.lit('{"state":{"m":{"state":{"_esm":"'), large))
        .when(kind == 4, F.concat(F.lit('{"state":{"m0":{"state":[1]},"m1":{"state":{"_css":"'), large, F.lit('"}}}}')))
        .otherwise(F.concat(F.lit('{"state":{"m":{"state":{"_esm":"'), large, F.lit('"}}}}')))
    )
    return pages.select(
        "page_id", F.concat(F.lit("p"), F.col("page_id").cast("string"), F.lit(".html")).alias("path"),
        F.concat(
            F.lit('<html><script type="application/vnd.jupyter.widget-state+json">'), block,
            F.lit("</script>"), F.lit("</html>"),
        ).alias("html"),
    )
