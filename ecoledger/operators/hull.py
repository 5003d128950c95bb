"""Extent of occurrence: convex hull in lon/lat, area on the equal-area plane.

The hull of a union is the hull of all outer points, so hulls merge like sums:
each task reduces its own points, and the hulls of tasks merge as a tree whose
levels grow with their number. No merge sees more than a fixed number of hulls,
none the class's points.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ecoledger.functions.projection import project_points, rotated, twice_signed_area
from ecoledger.session import settle

# Hulls that one merge sees at most.
MERGE_WIDTH = 64
ROWS_PER_FOLD = 200_000

_COMPASS = np.array(
    [(1, 0), (1, 1), (0, 1), (-1, 1), (-1, 0), (-1, -1), (0, -1), (1, -1)], dtype=float
)


def _cross(o: np.ndarray, a: np.ndarray, p: np.ndarray) -> np.ndarray:
    return (a[0] - o[0]) * (p[..., 1] - o[1]) - (a[1] - o[1]) * (p[..., 0] - o[0])


def _outside_octagon(points: np.ndarray) -> np.ndarray:
    """Drop points strictly inside the polygon of the eight compass extremes."""
    corner = points[np.argmax(points @ _COMPASS.T, axis=0)]
    kept = [corner[i] for i in range(8) if not np.array_equal(corner[i], corner[i - 1])]
    if len(kept) < 3:
        return points
    inside = np.ones(len(points), dtype=bool)
    for here, after in zip(kept, kept[1:] + kept[:1]):
        inside &= _cross(here, after, points) > 0
    return points[~inside]


def _chain(points: list) -> list:
    """One side of the hull of points in walking order, without collinear ones."""
    side: list = []
    for x, y in points:
        while len(side) > 1:
            (ox, oy), (ax, ay) = side[-2], side[-1]
            if (ax - ox) * (y - oy) - (ay - oy) * (x - ox) > 0:
                break
            side.pop()
        side.append((x, y))
    return side


def hull_points(points: np.ndarray) -> np.ndarray:
    """Corners of the convex hull, counter-clockwise from the lowest lon/lat."""
    if len(points) > 64:
        points = _outside_octagon(points)
    points = points[np.lexsort((points[:, 1], points[:, 0]))]
    repeated = np.all(points[1:] == points[:-1], axis=1)
    points = points[np.append(True, ~repeated)] if len(points) else points
    if len(points) < 3:
        return points
    walk = points.tolist()
    lower, upper = _chain(walk), _chain(walk[::-1])
    return np.array(lower[:-1] + upper[:-1])


def _absorb(held: dict, waiting: list[pa.RecordBatch]) -> None:
    """Fold the waiting points into the hulls held per class."""
    table = pa.Table.from_batches(waiting).combine_chunks()
    coded = table["code"].combine_chunks().dictionary_encode()
    of_row = coded.indices.to_numpy()
    points = np.column_stack([table["lon"].to_numpy(), table["lat"].to_numpy()])
    points = points[np.argsort(of_row, kind="stable")]
    ends = np.cumsum(np.bincount(of_row, minlength=len(coded.dictionary)))
    for code, mine in zip(coded.dictionary.to_pylist(), np.split(points, ends[:-1])):
        held[code] = hull_points(np.vstack([held[code], mine]) if code in held else mine)


def _task_hulls(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Hull of each class within one task, carried from batch to batch."""
    held: dict[str, np.ndarray] = {}
    waiting: list[pa.RecordBatch] = []
    for batch in batches:
        waiting.append(batch)
        if sum(b.num_rows for b in waiting) >= ROWS_PER_FOLD:
            _absorb(held, waiting)
            waiting = []
    if waiting:
        _absorb(held, waiting)
    context = TaskContext.get()
    task = context.partitionId() if context else 0
    for code, points in held.items():
        yield pa.RecordBatch.from_pydict(
            {
                "code": pa.array([code] * len(points), pa.string()),
                "task": pa.array([task] * len(points), pa.int64()),
                "lon": points[:, 0], "lat": points[:, 1],
            }
        )


def _merge_some(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
    corners = hull_points(rows[["lon", "lat"]].to_numpy())
    return pd.DataFrame({"code": key[0], "task": key[1], "lon": corners[:, 0], "lat": corners[:, 1]})


def _merge_class(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
    corners = hull_points(rows[["lon", "lat"]].to_numpy())
    ring = [{"lon": float(x), "lat": float(y)} for x, y in corners]
    return pd.DataFrame({"code": [key[0]], "hull": [ring]})


def merge_levels(tasks: int, width: int = MERGE_WIDTH) -> int:
    """Rounds of merging before the last one, so that no group sees more than ``width`` hulls."""
    levels = 0
    while tasks > width:
        tasks, levels = -(-tasks // width), levels + 1
    return levels


def merge_hulls(corners: DataFrame, tasks: int, width: int = MERGE_WIDTH) -> DataFrame:
    """(code, hull ARRAY<STRUCT<lon,lat>>) of partial hulls: corners (code, task, lon, lat).

    ``tasks`` are numbered from 0 below the given number and hold one hull of a class each.
    They merge as a tree: each level puts ``width`` neighbours together, so the levels grow
    with the logarithm of the tasks and the last group of a class is as small as the others.
    """
    for _ in range(merge_levels(tasks, width)):
        nearby = F.floor(F.col("task") / width).cast("long").alias("task")
        corners = corners.groupBy("code", nearby).applyInPandas(
            _merge_some, "code string, task long, lon double, lat double"
        )
    return corners.groupBy("code").applyInPandas(
        _merge_class, "code string, hull array<struct<lon:double,lat:double>>"
    )


def hulls(points: DataFrame) -> DataFrame:
    """(code, hull ARRAY<STRUCT<lon,lat>>) of points (code, lon, lat).

    Runs the job that reduces the points of each task to hulls, which are settled: the
    number of tasks decides how many levels the merge has.
    """
    known = points.select("code", "lon", "lat").dropna()
    local = settle(known.mapInArrow(_task_hulls, "code string, task long, lon double, lat double"))
    return merge_hulls(local, local.rdd.getNumPartitions())


def hull_area_km2(hull: Column) -> Column:
    """Planar area of a lon/lat hull after projecting its corners."""
    corners = project_points(hull)
    return F.abs(twice_signed_area(corners, rotated(corners))) / 2e6


def extent(points: DataFrame) -> DataFrame:
    """(code, eoo_km2, n_corners, hull); fewer than three corners give 0 km2."""
    return extent_of_hulls(hulls(points))


def extent_of_hulls(merged: DataFrame) -> DataFrame:
    """The extents of ``extent`` from one hull per class."""
    return merged.select(
        "code",
        F.when(F.size("hull") < 3, F.lit(0.0)).otherwise(hull_area_km2(F.col("hull"))).alias("eoo_km2"),
        F.size("hull").alias("n_corners"),
        "hull",
    )
