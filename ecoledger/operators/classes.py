"""Class index and per-class lookups."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ecoledger.functions.text import natural_key
from ecoledger.session import broadcast_if_small, settle

# A one-byte raster keeps 255 for nodata, so 254 is the last usable class.
LAST_PIXEL_CLASS = 254


def number_in_order(rows: DataFrame, order: list, name: str = "index") -> DataFrame:
    """1-based position of each row in a global order, without a global sort task.

    Rows are range-partitioned and settled, so both uses below see the same
    slices; each slice is numbered by itself and shifted by the size of the
    slices before it. Runs the job that settles the rows; the order must be total.
    """
    ranged = settle(
        rows.repartitionByRange(*order).withColumn("_slice", F.spark_partition_id())
    )
    earlier = Window.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    shifts = (
        ranged.groupBy("_slice").agg(F.count("*").alias("_n"))
        # one row per slice, so this unpartitioned window is as small as the slice count
        .select("_slice", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_shift"))
    )
    inside = Window.partitionBy("_slice").orderBy(*order)
    return (
        ranged.withColumn("_within", F.row_number().over(inside))
        .join(F.broadcast(shifts), "_slice")
        .withColumn(name, F.col("_within") + F.col("_shift"))
        .drop("_slice", "_within", "_shift")
    )


def first_values(features: DataFrame, *columns: str) -> DataFrame:
    """Value of the first feature of each code in source order.

    A null in the first feature counts as absent; callers choose the default.
    """
    return (
        features.where("code is not null")
        .groupBy("code")
        .agg(*[F.min_by(c, "src_ordinal").alias(c) for c in columns])
    )


def class_index(features: DataFrame) -> DataFrame:
    """(index, code, name): distinct codes in natural order, numbered from 1.

    The name is that of the code's first feature, else the code itself. The result is
    settled, so that those who join it do not number the classes again.
    """
    named = first_values(features, "name").withColumn("_key", natural_key(F.col("code")))
    return settle(number_in_order(named, ["_key", "code"]).select(
        F.col("index").cast("int").alias("index"),
        "code",
        F.coalesce("name", "code").alias("name"),
    ))


def rejected_features(features: DataFrame) -> DataFrame:
    """Features without a code: they cannot be indexed or assessed."""
    return features.where("code is null")


def over_capacity(index: DataFrame) -> DataFrame:
    """Index rows that a one-byte raster cannot hold."""
    return index.where(F.col("index") > LAST_PIXEL_CLASS)


def first_classes(index: DataFrame, n: int) -> DataFrame:
    """The first ``n`` classes; their numbers stay those of the full index."""
    return index.where(F.col("index") <= n)


def with_index(rows: DataFrame, index: DataFrame) -> DataFrame:
    """Add the class number by code; null for codes the index does not have.

    Runs a small job that counts the index: while it is short it is broadcast,
    so rows of a dominant code are not shuffled together.
    """
    return rows.join(broadcast_if_small(index.select("code", "index")), "code", "left")


def class_sizes(features: DataFrame) -> DataFrame:
    """Feature count per code, and thereby which codes have data at all."""
    return features.where("code is not null").groupBy("code").agg(F.count("*").alias("n_features"))


def map_counts(features: DataFrame) -> DataFrame:
    """One row: features, ecosystem types and functional groups of a map."""
    return features.agg(
        F.count("*").alias("n_features"),
        F.count_distinct("code").alias("ecosystem_types"),
        F.count_distinct("fg").alias("functional_groups"),
    )


def type_list(features: DataFrame) -> DataFrame:
    """Distinct (code, name) pairs, the typology list of maps without groups."""
    return features.select("code", "name").distinct()


def typology(features: DataFrame, groups: DataFrame, language: str) -> DataFrame:
    """Ecosystem list placed under functional group, biome and realm.

    ``groups`` is (language, fg, fg_name, biome, realm); codes whose group it
    does not know keep nulls there.
    """
    spoken = groups.where(F.col("language") == language).drop("language")
    types = features.select("code", "name", "fg").distinct()
    return types.join(spoken, "fg", "left")
