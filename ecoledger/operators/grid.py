"""Map-by-grid overlay and area of occupancy.

The overlay adds up signed boundary contributions per cell and never clips or
joins polygons: every edge is cut into pieces that stay inside one cell, each
piece adds the area on its left within the cell (``part``) and its height
(``cov``), and the height carries over to all cells further left in the row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ecoledger.functions.colour import ramp_colour, ramp_position
from ecoledger.session import BROADCAST_ROWS, broadcast_if_small, settle

# Cell size in metres and the share of area left out as a tail.
CELL_METRES = 10_000.0
TAIL_SHARE = 0.01

# A sum is zero if it is below this part of the summed sizes of its terms.
_ZERO = 1e-12
# Shares are rounded to these digits, so that sums in any order agree; smaller shares
# than a thousand times the last digit stay as they are.
SHARE_DIGITS = 9
_UNROUNDED_BELOW = 1e-6
_SHARE_BINS = 1024
_BINS_PER_OCTAVE = 64
# Cells of a bin that are settled by their distinct shares without another round.
SMALL_BIN = 4096


def _row_pieces(edge_rows: DataFrame, size: float, origin: tuple[float, float]) -> DataFrame:
    """Cut upward edges at grid rows; coordinates in cell units."""
    ox, oy = origin
    scaled = edge_rows.select(
        "code", "turn",
        ((F.col("x0") - ox) / size).alias("x0"), ((F.col("y0") - oy) / size).alias("y0"),
        ((F.col("x1") - ox) / size).alias("x1"), ((F.col("y1") - oy) / size).alias("y1"),
    ).where("y0 < y1")
    first = F.floor("y0")
    last = F.greatest(first, F.ceil("y1") - 1)
    by_row = scaled.select("*", F.explode(F.sequence(first, last)).alias("grid_row"))
    slope = (F.col("x1") - F.col("x0")) / (F.col("y1") - F.col("y0"))
    low = F.greatest(F.col("y0"), F.col("grid_row").cast("double"))
    high = F.least(F.col("y1"), (F.col("grid_row") + 1).cast("double"))

    def at(y: Column) -> Column:
        return (
            F.when(y == F.col("y0"), F.col("x0"))
            .when(y == F.col("y1"), F.col("x1"))
            .otherwise(F.col("x0") + (y - F.col("y0")) * slope)
        )

    return by_row.select(
        "code", "grid_row", ((high - low) * F.col("turn")).alias("height"),
        F.least(at(low), at(high)).alias("left"), F.greatest(at(low), at(high)).alias("right"),
    )


def cell_shares(
    edge_rows: DataFrame,
    size: float = CELL_METRES,
    origin: tuple[float, float] = (0.0, 0.0),
) -> DataFrame:
    """Share of every grid cell covered by every class.

    Gives (code, grid_col, grid_row, frac, overlap). Partial sums are combined on
    the map side, so a class or a cell that holds most of the boundary does not
    skew the shuffle. ``overlap`` marks cells whose features of one class add up
    to more than the cell; their share is reported as 1. Shares are rounded to 9
    digits, which frees them from the order of summation: full cells are exactly 1.
    Shares below 1e-6 keep all their digits, so no cell is lost however small its part.
    """
    pieces = _row_pieces(edge_rows, size, origin)
    first = F.floor("left")
    last = F.greatest(first, F.ceil("right") - 1)
    by_cell = pieces.select("*", F.explode(F.sequence(first, last)).alias("grid_col"))
    lo = F.greatest(F.col("left"), F.col("grid_col").cast("double"))
    hi = F.least(F.col("right"), (F.col("grid_col") + 1).cast("double"))
    height = F.when(F.col("left") == F.col("right"), F.col("height")).otherwise(
        F.col("height") * (hi - lo) / (F.col("right") - F.col("left"))
    )
    sums = (
        by_cell.select(
            "code", "grid_row", "grid_col",
            height.alias("cov"),
            (((lo + hi) / 2.0 - F.col("grid_col")) * height).alias("part"),
        )
        .groupBy("code", "grid_row", "grid_col")
        .agg(F.sum("cov").alias("cov"), F.sum("part").alias("part"), F.sum(F.abs("cov")).alias("_size"))
    )
    return shares_of_sums(sums)


def shares_of_sums(sums: DataFrame) -> DataFrame:
    """Shares as ``cell_shares`` gives them from (code, grid_row, grid_col, cov, part, _size), one row a cell."""
    # numbers first: they settle the sort before codes have to be compared
    leftwards = Window.partitionBy("grid_row", "code").orderBy(F.desc("grid_col"))
    carried = sums.select(
        "code", "grid_row", "grid_col", "part",
        F.sum("cov").over(leftwards.rowsBetween(Window.unboundedPreceding, 0)).alias("_after"),
        F.sum("_size").over(leftwards.rowsBetween(Window.unboundedPreceding, 0)).alias("_size"),
        F.col("cov"), F.col("_size").alias("_own_size"),
        F.lead("grid_col").over(leftwards).alias("_next"),
    )
    gap = F.col("_next").isNotNull() & (F.abs("_after") > F.col("_size") * _ZERO)
    start = F.when(gap, F.col("_next") + 1).otherwise(F.col("grid_col"))
    filled = carried.select(
        "code", "grid_row", "part", "cov", "_after", "_size", "_own_size", F.col("grid_col").alias("_own"),
        F.explode(F.sequence(start, F.col("grid_col"))).alias("grid_col"),
    )
    # what is carried over from the east is nothing if it is within its own rounding; a cell
    # with boundary of its own then counts by that boundary alone, whatever lies east of it
    carry = F.col("_after") - F.col("cov")
    settled_carry = F.when(F.abs(carry) > F.col("_size") * _ZERO, carry).otherwise(0.0)
    own = F.col("grid_col") == F.col("_own")
    exact = F.when(own, F.col("part") + settled_carry).otherwise(F.col("_after"))
    least = F.when(own, F.col("_own_size")).otherwise(F.col("_size")) * _ZERO
    share = F.when(F.col("_exact") < _UNROUNDED_BELOW, F.col("_exact")).otherwise(F.round("_exact", SHARE_DIGITS))
    return (
        filled.select("code", "grid_col", "grid_row", exact.alias("_exact"), least.alias("_least"))
        .where(F.col("_exact") > F.col("_least"))
        .select("code", "grid_col", "grid_row", share.alias("_share"))
        .select(
            "code", "grid_col", "grid_row",
            F.least(F.col("_share"), F.lit(1.0)).alias("frac"),
            (F.col("_share") > 1.0).alias("overlap"),
        )
    )


def _slots(cells: DataFrame) -> DataFrame:
    """Tag cells with a slot whose order agrees with (frac, grid_row, grid_col).

    Slots are bins of the share, below the first bin by its logarithm, so that slivers do
    not share one; full cells, which may be most of a class, are split further by grid row.
    """
    by_size = F.floor(F.log2("frac") * _BINS_PER_OCTAVE)
    share_bin = F.when(F.col("frac") * _SHARE_BINS >= 1.0, F.floor(F.col("frac") * _SHARE_BINS)).otherwise(by_size)
    return cells.withColumn("_bin", share_bin).withColumn(
        "_line", F.when(F.col("frac") == 1.0, F.col("grid_row")).otherwise(F.lit(0).cast("bigint"))
    )


def cumulative_shares(cells: DataFrame) -> DataFrame:
    """Running area of a class over its cells, smallest first.

    Adds cum_area, cum_prop and total_area. A running sum per class would put a
    dominant class into one task; instead cells are summed inside slots, slot
    totals (some thousands per class, plus one per grid row) are summed per
    class, and the two are added. Every running sum uses a ROWS frame: tied
    cells must be added one by one.
    """
    slotted = _slots(cells)
    slots = slotted.groupBy("_bin", "_line", "code").agg(F.sum("frac").alias("_slot"))
    per_class = Window.partitionBy("code").orderBy("_bin", "_line")
    starts = slots.select(
        "code", "_bin", "_line",
        F.coalesce(
            F.sum("_slot").over(per_class.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)
        ).alias("_start"),
        F.sum("_slot").over(Window.partitionBy("code")).alias("total_area"),
    )
    inside = (
        Window.partitionBy("_bin", "_line", "code")
        .orderBy("frac", "grid_row", "grid_col")
        .rowsBetween(Window.unboundedPreceding, 0)
    )
    running = slotted.withColumn("_inside", F.sum("frac").over(inside))
    return (
        running.join(starts, ["_bin", "_line", "code"])
        .withColumn("cum_area", F.col("_start") + F.col("_inside"))
        .withColumn("cum_prop", F.col("cum_area") / F.col("total_area"))
        .drop("_bin", "_line", "_start", "_inside")
    )


def _crossing(bins: DataFrame, tail: float) -> DataFrame:
    """The first bin of each class whose running area passes the tail, and what lies below it.

    ``bins`` has a row per class and bin: code, b, n, area, low, high, with the class's
    ``below_n``, ``below_area`` and ``total`` so far. A class that never passes has no row.
    """
    order = Window.partitionBy("code").orderBy("b")
    running = bins.withColumns(
        {
            "upto": F.col("below_area") + F.sum("area").over(order.rowsBetween(Window.unboundedPreceding, 0)),
            "before": F.coalesce(F.sum("area").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)),
            "count": F.coalesce(F.sum("n").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)),
        }
    ).where(F.col("upto") / F.col("total") > tail)
    first = F.min_by(F.struct(*running.columns), "b").alias("f")
    return running.groupBy("code").agg(first).select(
        "code", "f.low", "f.high", "f.n", "f.total",
        (F.col("f.below_n") + F.col("f.count")).alias("below_n"),
        (F.col("f.below_area") + F.col("f.before")).alias("below_area"),
    )


def tail_counts(cells: DataFrame, tail: float = TAIL_SHARE, small: int = SMALL_BIN) -> DataFrame:
    """(code, n_cells, area, overlap_cells, tail_cells) per class, by weighted selection.

    ``tail_cells`` counts the smallest cells that together stay within the share ``tail`` of
    the class's area. Nothing is sorted but sums: a histogram of areas by the logarithm of
    the share finds the bin that the line falls into, which is binned anew between its own
    limits until it holds ``small`` cells at most or cells of one size; the last bin is
    settled by its distinct shares, cells of one size by division. Each round reads only
    the bin of the round before, and a dominant class is a row a bin and task.
    """
    stored = settle(cells.select("code", "frac", "overlap"))
    size = F.floor(F.log2("frac") * _BINS_PER_OCTAVE)
    per_bin = (F.count("*").alias("n"), F.sum("frac").alias("area"), F.min("frac").alias("low"), F.max("frac").alias("high"))
    first = settle(
        stored.withColumn("b", size).groupBy("code", "b").agg(*per_bin, F.count_if("overlap").alias("overlaps"))
    )
    totals = first.groupBy("code").agg(
        F.sum("n").alias("n_cells"), F.sum("area").alias("area"), F.sum("overlaps").alias("overlap_cells")
    )
    of_class = Window.partitionBy("code")
    start = {"total": F.sum("area").over(of_class), "below_n": F.lit(0).cast("long"), "below_area": F.lit(0.0)}
    line = settle(_crossing(first.withColumns(start), tail))
    known = ["total", "below_n", "below_area"]
    while True:
        state = line.agg(F.count("*").alias("rows"), F.count_if((F.col("n") > small) & (F.col("low") < F.col("high"))).alias("large")).first()
        limits = line.select("code", F.col("low").alias("_low"), F.col("high").alias("_high"), *known)
        # a row a class, broadcast while there are few of them
        limits = F.broadcast(limits) if state.rows <= BROADCAST_ROWS else limits
        inside = stored.join(limits, "code").where("frac between _low and _high")
        if not state.large:
            break
        stored = settle(inside.select("code", "frac", "overlap"))
        place = (F.col("frac") - F.col("_low")) / (F.col("_high") - F.col("_low"))
        finer = F.when(F.col("_low") < F.col("_high"), F.floor(place * _SHARE_BINS)).otherwise(0)
        line = settle(_crossing(inside.withColumn("b", finer).groupBy("code", "b", *known).agg(*per_bin), tail))
    values = inside.groupBy("code", F.col("frac").alias("b"), *known).agg(*per_bin)
    last = _crossing(values, tail)
    # cells of the size at the line that still fit below it; each adds its share
    room = F.floor((F.col("total") * tail - F.col("below_area")) / F.col("low") + 1e-9)
    fits = F.greatest(F.lit(0), F.least(F.col("n") - 1, room)).cast("long")
    return totals.join(last.select("code", (F.col("below_n") + fits).alias("tail_cells")), "code", "left")


def occupancy(cells: DataFrame, tail: float = TAIL_SHARE, size: float = CELL_METRES) -> DataFrame:
    """Area of occupancy per class: (code, aoo_cells, n_cells, area_km2, overlap_cells).

    Counts the cells whose cumulative share is strictly above ``tail``. Runs the jobs of
    ``tail_counts``.
    """
    km2 = (size / 1000.0) ** 2
    return tail_counts(cells, tail).select(
        "code", (F.col("n_cells") - F.coalesce("tail_cells", "n_cells")).alias("aoo_cells"), "n_cells",
        (F.col("area") * km2).alias("area_km2"), "overlap_cells",
    )


def grid_cell_count(cells: DataFrame) -> DataFrame:
    """Number of distinct grid cells any class touches, one row."""
    return (
        cells.groupBy("grid_col", "grid_row").agg(F.count("*").alias("classes"))
        .agg(F.count("*").alias("cell_count"), F.coalesce(F.max("classes"), F.lit(0)).alias("max_classes"))
    )


def share_ramp(cells: DataFrame) -> DataFrame:
    """Cells with their position on the class's own min-max colour ramp.

    Runs the job that finds the limits: one row per class, broadcast while that
    is small, so the cells of a dominant class stay where they are.
    """
    limits = settle(
        cells.groupBy("code").agg(F.min("frac").alias("_low"), F.max("frac").alias("_high"))
    )
    placed = cells.join(broadcast_if_small(limits), "code").withColumn(
        "ramp", ramp_position(F.col("frac"), F.col("_low"), F.col("_high"))
    )
    return placed.withColumn("colour", ramp_colour(F.col("ramp"))).drop("_low", "_high")
