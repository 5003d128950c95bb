"""May the report be rebuilt, and if not, why?"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ecoledger.operators.checks import invalid_records, missing_from, source_drift


def build_gate(
    records: DataFrame,
    pages: DataFrame,
    current: DataFrame,
    recorded: DataFrame,
    key: str,
    fields: list[str],
) -> DataFrame:
    """One row: what the build has to do, with the counts behind it.

    Without records everything is scaffolded from the source. Otherwise a
    drifted source stops the build, then pages without a record, then records
    without a code; else the pages are regenerated.
    """
    counted = {
        "n_records": records,
        "drifted_sources": source_drift(current, recorded, key, fields).where("drifted"),
        "orphan_pages": missing_from(pages, records, "code"),
        "invalid_records": invalid_records(records),
    }
    parts = [
        rows.agg(F.count("*").alias("_n")).select(F.lit(name).alias("_what"), "_n")
        for name, rows in counted.items()
    ]
    one = reduce(DataFrame.unionByName, parts).agg(
        *[F.max(F.when(F.col("_what") == name, F.col("_n"))).alias(name) for name in counted]
    )
    action = (
        F.when(F.col("n_records") == 0, F.lit("scaffold"))
        .when(F.col("drifted_sources") > 0, F.lit("source drift"))
        .when(F.col("orphan_pages") > 0, F.lit("orphan pages"))
        .when(F.col("invalid_records") > 0, F.lit("invalid records"))
        .otherwise(F.lit("regenerate"))
    )
    return one.withColumn("action", action)
