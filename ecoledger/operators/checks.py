"""Consistency checks between source, index, records, pages and caches."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def missing_from(rows: DataFrame, known: DataFrame, key: str) -> DataFrame:
    """Distinct keys of ``rows`` that ``known`` does not have.

    Serves pages without a record, records without an index entry and
    configured caches without an object. Both sides shrink to distinct keys
    before they meet, so repeated keys do not skew the join.
    """
    wanted = rows.select(key).where(F.col(key).isNotNull()).distinct()
    return wanted.join(known.select(key).distinct(), key, "left_anti")


def legend_mismatches(legend: DataFrame, index: DataFrame) -> DataFrame:
    """Pixel values whose code differs between a raster legend and the class index."""
    left = legend.select("index", F.col("code").alias("legend_code"))
    right = index.select("index", F.col("code").alias("index_code"))
    return left.join(right, "index", "full_outer").where(
        ~F.col("legend_code").eqNullSafe(F.col("index_code"))
    )


def source_drift(current: DataFrame, recorded: DataFrame, key: str, fields: list[str]) -> DataFrame:
    """Add ``drifted``: the recorded source differs from the current one.

    A source never recorded counts as drifted; fields compare null-safely.
    """
    old = recorded.select(
        key, F.lit(True).alias("_known"), *[F.col(f).alias(f"_old_{f}") for f in fields]
    )
    same = F.coalesce(F.col("_known"), F.lit(False))
    for f in fields:
        same = same & F.col(f).eqNullSafe(F.col(f"_old_{f}"))
    return (
        current.join(old, key, "left")
        .withColumn("drifted", ~same)
        .drop("_known", *[f"_old_{f}" for f in fields])
    )


def backfill_index(records: DataFrame, index: DataFrame) -> DataFrame:
    """Set each record's index from the class index.

    ``change`` tells set, unchanged, or unmatched; an unmatched record keeps
    what it had.
    """
    known = index.select("code", F.col("index").alias("_new"))
    joined = records.join(known, "code", "left")
    change = (
        F.when(F.col("_new").isNull(), F.lit("unmatched"))
        .when(F.col("index").eqNullSafe(F.col("_new")), F.lit("unchanged"))
        .otherwise(F.lit("set"))
    )
    return (
        joined.withColumn("change", change)
        .withColumn("index", F.coalesce("_new", "index"))
        .drop("_new")
    )


def invalid_records(records: DataFrame) -> DataFrame:
    """Records without a code; they stop a build."""
    return records.where(F.col("code").isNull())
