"""From configured map sources to a decision, and from one source to its caches."""

from __future__ import annotations

from dataclasses import dataclass, replace

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ecoledger.functions.text import cache_addresses, is_parquet
from ecoledger.plans.readiness import configured_caches, layout_verdicts, readiness
from ecoledger.sources.footers import footer_chunks, footer_stats
from ecoledger.sources.layout import cells_cached, write_cells, write_sorted_copy
from ecoledger.sources.vector import MapSource, described, load_geojson, load_map


def source_readiness(sources: DataFrame, listing: DataFrame, **limits) -> DataFrame:
    """Will each source's build fit? One row a source, with ``ok`` and ``reasons``.

    ``sources`` has (source, data, optimized_data, aoo_grid_cache_url), null where unset;
    ``listing`` has (path, length) of every existing object. Footers are read of the
    Parquet files that exist and whose source has no caches configured; for any other
    file, and where no footer can be read, the listed length decides. ``limits`` are
    those of ``readiness``. ``problem`` says what could not be found or read.
    """
    counted = configured_caches(sources, listing)
    sized = counted.join(
        listing.select(F.col("path").alias("data"), F.col("length").alias("size_bytes")).dropDuplicates(["data"]),
        "data", "left",
    )
    asked = sized.where((F.col("n_configured") == 0) & F.col("size_bytes").isNotNull() & is_parquet(F.col("data")))
    stats = footer_stats(footer_chunks(asked.select(F.col("data").alias("path")).distinct()), F.lit(None).cast("string"))
    known = sized.join(
        stats.select(
            F.col("path").alias("data"), "geometry_bytes", "num_rows", "num_row_groups", F.col("problem").alias("_unread")
        ),
        "data", "left",
    )
    missing = F.when((F.col("n_configured") == 0) & F.col("size_bytes").isNull(), F.lit("the source is not in the listing"))
    return readiness(known, **limits).withColumn("problem", F.coalesce("_unread", missing)).drop("_unread")


@dataclass(frozen=True)
class Caches:
    """Where a source's caches are, whether the source serves as its own sorted copy."""

    source: MapSource
    reused: bool


def build_caches(spark: SparkSession, source: MapSource, project: str = "project") -> Caches:
    """Write the sorted copy and the cell table of one source.

    Parquet and GeoJSON maps are read. A large remote Parquet file that is not optimized is
    refused; a footer that cannot be read refuses nothing, the load decides. Addresses that
    are set are written as they are set. If neither is, both are derived, and a source that is
    sorted already takes the place of its copy. The cell table is made from the copy, or
    from the source where no copy is wanted.
    """
    row = spark.createDataFrame([(source.data,)], "path string")
    parquet = row.select(is_parquet(F.col("path"))).first()[0]
    judged = None
    if parquet:
        judged = layout_verdicts(footer_stats(footer_chunks(row, source.key_column), source.key_column)).first()
        if judged["refuse_load"]:
            raise ValueError(f"{source.data}: {judged['refusal']}")
    chosen = bool(source.optimized_data or source.cell_table)
    if not chosen:
        derived = row.select(
            *[c.alias(n) for n, c in cache_addresses(F.lit(project), F.col("path")).items()]
        ).first()
        source = replace(source, optimized_data=derived["optimized_data"], cell_table=derived["aoo_grid_cache_url"])
    reused = not chosen and bool(judged and judged["optimized"])
    plain = replace(source, optimized_data=None)
    try:
        if parquet:
            plain = described(spark, plain)
            rows = spark.read.parquet(source.data)
        else:
            rows = named_columns(load_geojson(spark, plain, split=True), plain)
    except (PySparkException, Py4JJavaError) as error:
        raise ValueError(f"{source.data}: {error}") from error
    source = replace(source, geometry_column=plain.geometry_column or "geometry")
    if reused:
        source = replace(source, optimized_data=source.data)
    elif source.optimized_data:
        write_sorted_copy(rows, source.optimized_data, source.key_column)
    if source.cell_table:
        if source.optimized_data or parquet:
            features = load_map(spark, source)
        else:
            features = load_geojson(spark, plain, split=True)
        write_cells(cells_cached(spark, features, None), source.cell_table)
    return Caches(source, reused)


def named_columns(features: DataFrame, source: MapSource) -> DataFrame:
    """Features of a map that is no table, under the column names of its source."""
    roles = {source.code_column: "code", source.name_column: "name", source.group_column: "fg"}
    if source.code_column is None:
        roles[source.name_column] = "code"
    columns = [F.col(role).alias(column) for column, role in roles.items() if column]
    return features.select(*columns, "geometry")
