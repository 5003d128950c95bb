"""The whole criterion B assessment of a map in one plan."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ecoledger.operators.cover import TOUCHING, cover
from ecoledger.operators.criteria import THRESHOLDS, criterion_b
from ecoledger.operators.grid import CELL_METRES, TAIL_SHARE, occupancy
from ecoledger.operators.hull import extent, extent_of_hulls, merge_hulls
from ecoledger.operators.rings import edges, outer_points, rings, without_copies
from ecoledger.operators.sweep import CORNER, cells_of_pass, geometry_pass
from ecoledger.session import settle


def metrics(
    features: DataFrame,
    size: float = CELL_METRES,
    tail: float = TAIL_SHARE,
    cells: DataFrame | None = None,
    drop_copies: bool = True,
    scanline: float | None = None,
) -> DataFrame:
    """(code, eoo_km2, aoo_cells, n_cells, area_km2, overlap_cells) of every class.

    The geometry is read once, for hulls and cells together, after the pass that finds copies.
    Pass ``cells`` to use a stored cell table instead of overlaying the map.
    Shapes repeated within a class count once; ``drop_copies=False`` saves that
    pass over a map known to have none. With ``scanline``, metres between scanlines,
    ``twice_km2`` is added: the ground that features of the class cover more than once,
    wherever it lies. That takes another pass over the map.
    """
    if scanline is not None:
        single = without_copies(features) if drop_copies else features
        twice = cover(edges(rings(single)), scanline).select("code", "twice_km2")
        return metrics(features, size, tail, cells, drop_copies).join(twice, "code", "left").fillna(0.0, "twice_km2")
    if cells is not None:
        return extent(outer_points(rings(features))).select("code", "eoo_km2").join(
            occupancy(cells, tail, size), "code", "full_outer"
        )
    swept = settle(geometry_pass(without_copies(features) if drop_copies else features, size))
    corners = swept.where(F.col("kind") == CORNER).select("code", "task", "lon", "lat")
    eoo = extent_of_hulls(merge_hulls(corners, swept.rdd.getNumPartitions())).select("code", "eoo_km2")
    return eoo.join(occupancy(cells_of_pass(swept), tail, size), "code", "full_outer")


def flag_overlap(measured: DataFrame) -> DataFrame:
    """Add ``overlap``: whether features of the class cover some ground more than once.

    True when a cell is overfilled, and when the summed area exceeds the area of the hull,
    which no map without overlap can do (to a millionth, for curved edges). Overlap that
    fills no cell and lies well inside the hull is seen where ``metrics`` measured
    ``twice_km2`` along scanlines. Null when the area is unknown. Such areas, and the 1 %
    line drawn from them, are too large.
    """
    beyond_hull = F.col("area_km2") > F.col("eoo_km2") * (1 + 1e-6)
    seen = F.lit(False)
    if "twice_km2" in measured.columns:
        seen = F.coalesce(F.col("twice_km2") > F.col("area_km2") * TOUCHING, F.lit(False))
    return measured.withColumn(
        "overlap", (F.col("overlap_cells") > 0) | beyond_hull | seen
    )


def assess(
    index: DataFrame, measured: DataFrame, thresholds: dict = THRESHOLDS
) -> DataFrame:
    """Criterion B for every indexed class; classes without data have null metrics."""
    rows = index.select("index", "code", "name").join(measured, "code", "left")
    graded = criterion_b(rows, thresholds).withColumn("has_data", F.col("eoo_km2").isNotNull())
    return flag_overlap(graded)
