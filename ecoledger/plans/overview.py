"""Facts for the overview page of a report."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ecoledger.operators.classes import map_counts, type_list, typology


def overview(
    features: DataFrame, country: str, groups_known: bool, note: str | None = None
) -> DataFrame:
    """One row of counts with the opening sentence of the overview.

    Counts of types and of functional groups are kept under their own names;
    without a functional-group column the group count is null. ``note`` is passed on;
    see ``vector.missing_group_note``.
    """
    counts = map_counts(features)
    groups = F.when(F.lit(groups_known), F.col("functional_groups"))
    opening = F.concat(
        F.lit(f"The {country} ecosystem typology includes "),
        F.col("ecosystem_types").cast("string"), F.lit(" ecosystem types"),
        F.when(groups.isNotNull(), F.concat(F.lit(" across "), groups.cast("string"),
                                            F.lit(" functional groups"))).otherwise(F.lit("")),
        F.lit("."),
    )
    return counts.select(
        F.lit(country).alias("country"), "n_features", "ecosystem_types",
        groups.alias("functional_groups"), F.lit(groups_known).alias("has_groups"),
        opening.alias("sentence"),
        F.lit(note).cast("string").alias("note"),
    )


def typology_table(
    features: DataFrame, groups: DataFrame | None, language: str = "spanish"
) -> DataFrame:
    """The full typology where groups are known, the plain type list otherwise."""
    return type_list(features) if groups is None else typology(features, groups, language)
