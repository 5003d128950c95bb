"""Polygons as rings, vertices and edges.

A ring stays one row with its points in an array, so closing a ring, projecting
it, finding its winding and pairing its vertices into edges need no shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ecoledger.functions.projection import project_points, rotated, twice_signed_area
from ecoledger.session import BROADCAST_ROWS, settle


def _open(points: Column) -> Column:
    """Drop the repeated last point of a closed ring."""
    closed = (F.size(points) > 1) & (F.get(points, F.lit(0)) == F.element_at(points, -1))
    return F.when(closed, F.slice(points, F.lit(1), F.size(points) - 1)).otherwise(points)


def rings(features: DataFrame, geometry: str = "geometry") -> DataFrame:
    """One row per ring of nested coordinates.

    ``geometry`` is ARRAY<part ARRAY<ring ARRAY<point ARRAY<DOUBLE>>>> in lon/lat;
    ring 0 of a part is its outer boundary. Gives (fid, code, src_ordinal, part,
    ring, points) with ``points`` an open ARRAY<STRUCT<lon,lat>>.
    """
    parts = features.select(
        "fid", "code", "src_ordinal", F.posexplode(geometry).alias("part", "_rings")
    )
    each = parts.select(
        "fid", "code", "src_ordinal", "part", F.posexplode("_rings").alias("ring", "_points")
    )
    points = F.transform(
        _open(F.col("_points")),
        lambda p: F.struct(F.get(p, F.lit(0)).alias("lon"), F.get(p, F.lit(1)).alias("lat")),
    )
    return each.select("fid", "code", "src_ordinal", "part", "ring", points.alias("points"))


def without_copies(features: DataFrame, geometry: str = "geometry") -> DataFrame:
    """Features with repeated shapes of a class dropped; the first in source order stays.

    Shapes are compared by 128 bits of hash and counted on the map side, so a
    shape that makes up much of the map is one row. Runs the job that finds the
    repeated shapes; they are broadcast while they are few, and the map itself
    is then not shuffled. Beyond that the copies are found on rows without geometry.
    """
    shape = ["code", "_shape", "_check"]
    marked = features.withColumns(
        {"_shape": F.xxhash64(geometry), "_check": F.xxhash64(F.lit(1), geometry)}
    )
    repeated = settle(
        marked.groupBy(*shape)
        .agg(F.count("*").alias("_copies"), F.min("src_ordinal").alias("_first"))
        .where("_copies > 1")
        .drop("_copies")
    )
    if repeated.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS:
        return (
            marked.join(F.broadcast(repeated), shape, "left")
            .where("_first is null or src_ordinal = _first")
            .select(*features.columns)
        )
    # geometry moves by ordinal, so the copies of one shape do not meet in one task
    later = marked.select(*shape, "src_ordinal").join(repeated, shape).where("src_ordinal <> _first")
    return features.join(later.select("src_ordinal"), "src_ordinal", "left_anti").select(*features.columns)


def rings_from_vertices(vertices: DataFrame) -> DataFrame:
    """Rebuild rings from long vertices (fid, code, src_ordinal, part, ring, i, lon, lat).

    The group is one ring of one feature, never a whole class.
    """
    gathered = vertices.groupBy("fid", "code", "src_ordinal", "part", "ring").agg(
        F.sort_array(F.collect_list(F.struct("i", "lon", "lat"))).alias("_sorted")
    )
    points = F.transform(
        "_sorted", lambda p: F.struct(p["lon"].alias("lon"), p["lat"].alias("lat"))
    )
    return gathered.withColumn("_points", points).select(
        "fid", "code", "src_ordinal", "part", "ring", _open(F.col("_points")).alias("points")
    )


def vertices(ring_rows: DataFrame) -> DataFrame:
    """Long form: one row per vertex, numbered within its ring."""
    return ring_rows.select(
        "fid", "code", "src_ordinal", "part", "ring", F.posexplode("points").alias("i", "_p")
    ).select(
        "fid", "code", "src_ordinal", "part", "ring", "i",
        F.col("_p.lon").alias("lon"), F.col("_p.lat").alias("lat"),
    )


def outer_points(ring_rows: DataFrame) -> DataFrame:
    """(code, lon, lat) of the outer boundaries; holes cannot reach a hull."""
    return ring_rows.where("ring = 0").select("code", F.inline("points"))


def edges(ring_rows: DataFrame) -> DataFrame:
    """Projected edges that rise or fall, pointing upwards.

    Gives (fid, code, src_ordinal, x0, y0, x1, y1, turn) in metres with y0 < y1.
    ``turn`` is +1 where the interior lies to the left in x (a right-hand
    boundary) and -1 where it lies to the right, whatever the winding of the
    input: outer rings are read counter-clockwise and holes clockwise.
    Horizontal edges bound no area in a row sweep and are left out; rings without
    area keep their edges with a ``turn`` of 0, because a filter on the winding
    would be copied below the explode and walk every ring again.
    """
    # each step is a projection of its own: merged, the ring would be projected per use
    projected = ring_rows.withColumn("_p", project_points(F.col("points")))
    paired = projected.withColumn("_q", rotated(F.col("_p")))
    winding = F.signum(twice_signed_area(F.col("_p"), F.col("_q"))) * F.when(
        F.col("ring") == 0, F.lit(1.0)
    ).otherwise(F.lit(-1.0))
    paired = paired.select("fid", "code", "src_ordinal", winding.alias("_w"), "_p", "_q")
    flat = paired.select(
        "fid", "code", "src_ordinal", "_w", F.explode(F.arrays_zip("_p", "_q")).alias("_e")
    ).where("_e._p.y <> _e._q.y")
    up = F.col("_e._p.y") < F.col("_e._q.y")

    def end(lower: bool, axis: str) -> Column:
        here, there = F.col(f"_e._p.{axis}"), F.col(f"_e._q.{axis}")
        return F.when(up == F.lit(lower), here).otherwise(there)

    return flat.select(
        "fid", "code", "src_ordinal",
        end(True, "x").alias("x0"), end(True, "y").alias("y0"),
        end(False, "x").alias("x1"), end(False, "y").alias("y1"),
        F.when(up, F.col("_w")).otherwise(-F.col("_w")).alias("turn"),
    )


def bounds(ring_rows: DataFrame) -> DataFrame:
    """Longitude and latitude limits of the whole map, one row."""
    pts = outer_points(ring_rows)
    return pts.agg(
        F.min("lon").alias("west"), F.min("lat").alias("south"),
        F.max("lon").alias("east"), F.max("lat").alias("north"),
    )


