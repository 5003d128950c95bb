"""How often the features of one class cover the ground, along scanlines.

The signed area of a class counts ground as often as features cover it. Along a scanline
the depth of cover is a running sum over crossings, so the length that is covered at all
and the length that is covered twice are sums of the same pass, wherever in the class the
overlap lies.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ecoledger.operators.raster import crossings

# Fixed value: metres between scanlines; an overlap that is less high may lie between two.
SCANLINE_METRES = 100.0
# The part of the covered area up to which twofold cover is put down to rounding.
TOUCHING = 1e-6


def cover(edge_rows: DataFrame, spacing: float = SCANLINE_METRES) -> DataFrame:
    """(code, summed_km2, covered_km2, twice_km2, overlap) of each class.

    ``summed_km2`` counts ground once a feature, ``covered_km2`` once, ``twice_km2`` is the
    ground under two features or more. ``overlap`` says that the last is more than a
    millionth of the second. Boundaries that features share cancel on the map side. A
    window holds the crossings of one class with one scanline.
    """
    met = (
        crossings(edge_rows, spacing).groupBy("code", "row", "x").agg(F.sum("turn").alias("turn")).where("turn <> 0")
    )
    east = Window.partitionBy("row", "code").orderBy("x")
    # going east, a boundary whose interior lies to its right opens with turn -1
    stretches = met.select(
        "code", F.round(-F.sum("turn").over(east.rowsBetween(Window.unboundedPreceding, 0))).alias("depth"),
        (F.lead("x").over(east) - F.col("x")).alias("length"),
    ).where("depth > 0")
    km2 = (spacing / 1000.0) ** 2

    def area(length: Column) -> Column:
        return F.coalesce(F.sum(length), F.lit(0.0)) * km2

    sums = stretches.groupBy("code").agg(
        area(F.col("depth") * F.col("length")).alias("summed_km2"), area(F.col("length")).alias("covered_km2"),
        area(F.when(F.col("depth") > 1, F.col("length"))).alias("twice_km2"),
    )
    return sums.withColumn("overlap", F.col("twice_km2") > F.col("covered_km2") * TOUCHING)
