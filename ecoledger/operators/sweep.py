"""One pass over the geometry for everything an assessment needs.

A task reads features once and yields tagged rows: the boundary sums of grid cells and the
corners of the hulls of what it has read. Both are folded in the task, so what leaves it
grows with cells and classes, not with vertices. Work is on the flat coordinate buffers of
an Arrow batch; there is no loop over features, rings or points.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ecoledger.functions.projection import project_lonlat
from ecoledger.operators.grid import CELL_METRES, shares_of_sums
from ecoledger.operators.hull import hull_points

CELL, CORNER = "cell", "corner"
_TAGGED = (
    "kind string, code string, task long, grid_row long, grid_col long, cov double, part double, size double, "
    "lon double, lat double"
)
# A task cuts a batch into pieces of about so many vertices, folds its cell sums when so many
# rows wait, sends them on beyond so many cells, and so many rows at once.
VERTICES_AT_ONCE = 20_000
ROWS_PER_FOLD = 100_000
CELLS_HELD = 200_000
ROWS_SENT = 50_000


def _levels(geometry: pa.Array, depth: int) -> tuple[list[np.ndarray], pa.Array]:
    """Offsets of ``depth`` nested lists, each from zero, and the flat values below them."""
    offsets = []
    for _ in range(depth):
        offsets.append(geometry.offsets.to_numpy() - geometry.offsets[0].as_py())
        geometry = geometry.flatten()
    return offsets, geometry


def _spread(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For rows that stand for ``counts`` items: the row of every item and its number there."""
    of = np.repeat(np.arange(len(counts)), counts)
    return of, np.arange(len(of)) - np.repeat(np.cumsum(counts) - counts, counts)


def _pieces(batch: pa.RecordBatch, column: int, vertices: int = VERTICES_AT_ONCE) -> Iterator[pa.RecordBatch]:
    """The rows of a batch in slices of about so many vertices; a larger feature is one slice."""
    (by_feature, by_part, by_ring), _ = _levels(batch.column(column), 3)
    before = by_ring[by_part[by_feature]]
    start = 0
    while start < batch.num_rows:
        end = max(start + 1, int(np.searchsorted(before, before[start] + vertices, "right")) - 1)
        yield batch.slice(start, end - start)
        start = end


class _Boundary:
    """Vertices of a batch of features: position, successor, ring, feature."""

    def __init__(self, geometry: pa.Array):
        (by_feature, by_part, by_ring, by_point), values = _levels(geometry, 4)
        flat = values.to_numpy(zero_copy_only=False)
        lon, lat = flat[by_point[:-1]], flat[by_point[:-1] + 1]
        start, end = by_ring[:-1], by_ring[1:].copy()
        size = end - start
        closed = size > 1
        closed[closed] = (lon[start[closed]] == lon[end[closed] - 1]) & (lat[start[closed]] == lat[end[closed] - 1])
        size = size - closed
        ring, k = _spread(size)
        here = start[ring] + k
        after = start[ring] + np.where(k + 1 == size[ring], 0, k + 1)
        ring_of_part = np.repeat(np.arange(len(by_part) - 1), np.diff(by_part))
        feature_of_part = np.repeat(np.arange(len(by_feature) - 1), np.diff(by_feature))
        self.lon, self.lat = lon[here], lat[here]
        self.outer = (np.arange(len(ring_of_part)) == by_part[:-1][ring_of_part])[ring]
        self.feature = feature_of_part[ring_of_part][ring]
        x, y = project_lonlat(lon, lat)
        self.x0, self.y0, self.x1, self.y1 = x[here], y[here], x[after], y[after]
        # trapezoids keep their terms small for small rings far from the origin
        strips = (self.x0 + self.x1) * (self.y1 - self.y0)
        area = np.bincount(ring, strips, minlength=len(size))
        self.winding = np.sign(area)[ring] * np.where(self.outer, 1.0, -1.0)


def _cell_terms(b: _Boundary, codes: np.ndarray, size: float) -> tuple[np.ndarray, ...]:
    """(code, row, column, cov, part) of every piece of boundary inside one cell."""
    up = b.y0 < b.y1
    kept = (b.y0 != b.y1) & np.isfinite(b.x0 + b.y0 + b.x1 + b.y1)
    turn = np.where(up, b.winding, -b.winding)[kept]
    x0, y0 = (np.where(up, p, q)[kept] / size for p, q in ((b.x0, b.x1), (b.y0, b.y1)))
    x1, y1 = (np.where(up, q, p)[kept] / size for p, q in ((b.x0, b.x1), (b.y0, b.y1)))
    first = np.floor(y0).astype(np.int64)
    edge, k = _spread(np.maximum(first, np.ceil(y1).astype(np.int64) - 1) - first + 1)
    row = first[edge] + k
    low, high = np.maximum(y0[edge], row), np.minimum(y1[edge], row + 1)
    slope = ((x1 - x0) / (y1 - y0))[edge]

    def at(y: np.ndarray) -> np.ndarray:
        inside = x0[edge] + (y - y0[edge]) * slope
        return np.where(y == y0[edge], x0[edge], np.where(y == y1[edge], x1[edge], inside))

    a, c = at(low), at(high)
    left, right, height = np.minimum(a, c), np.maximum(a, c), (high - low) * turn[edge]
    first = np.floor(left).astype(np.int64)
    piece, k = _spread(np.maximum(first, np.ceil(right).astype(np.int64) - 1) - first + 1)
    col = first[piece] + k
    lo, hi = np.maximum(left[piece], col), np.minimum(right[piece], col + 1)
    width = (right - left)[piece]
    share = np.divide(hi - lo, width, out=np.ones_like(width), where=width != 0)
    cov = height[piece] * share
    return codes[b.feature][kept][edge][piece], row[piece], col, cov, ((lo + hi) / 2.0 - col) * cov


class _CellSums:
    """Sums of cell terms by class, row and column, folded now and then."""

    def __init__(self):
        self.waiting: list[tuple[np.ndarray, ...]] = []
        self.rows = 0

    def add(self, code, row, col, cov, part, size=None) -> None:
        self.waiting.append((code, row, col, cov, part, np.abs(cov) if size is None else size))
        self.rows += len(code)

    def fold(self) -> tuple[np.ndarray, ...] | None:
        if not self.rows:
            return None
        code, row, col, *sums = (np.concatenate(c) for c in zip(*self.waiting))
        order = np.lexsort((col, row, code))
        code, row, col = code[order], row[order], col[order]
        new = np.ones(len(code), bool)
        new[1:] = (np.diff(code) != 0) | (np.diff(row) != 0) | (np.diff(col) != 0)
        starts = np.flatnonzero(new)
        folded = (code[starts], row[starts], col[starts], *(np.add.reduceat(s[order], starts) for s in sums))
        self.waiting, self.rows = [folded], len(starts)
        return folded

    def take(self) -> tuple[np.ndarray, ...] | None:
        folded = self.fold()
        self.waiting, self.rows = [], 0
        return folded


def geometry_pass(features: DataFrame, size: float) -> DataFrame:
    """Tagged rows of one scan: partial cell sums and the corners of partial hulls.

    Rows of kind ``cell`` hold ``cov``, ``part`` and ``size`` of a class and cell, rows of
    kind ``corner`` the corners of the hull of a class in one ``task``. A null code or
    geometry gives nothing; points with a null coordinate bound no area and no hull. A
    latitude beyond the poles fails the job.
    """

    def tagged(names: list[str], task: int, **columns) -> pa.RecordBatch:
        n = len(names)
        types = {f.name: f.type for f in schema}
        empty = {f.name: pa.nulls(n, f.type) for f in schema}
        given = {k: pa.array(v, types[k]) for k, v in columns.items()}
        base = {"code": pa.array(names, pa.string()), "task": pa.array([task] * n, pa.int64())}
        return pa.RecordBatch.from_pydict(empty | base | given, schema=schema)

    schema = pa.schema(
        [("kind", pa.string()), ("code", pa.string()), ("task", pa.int64()), ("grid_row", pa.int64()), ("grid_col", pa.int64()),
         *[(c, pa.float64()) for c in ("cov", "part", "size", "lon", "lat")]]
    )

    def sweep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        task = context.partitionId() if context else 0
        names: dict[str, int] = {}
        hulls: dict[int, np.ndarray] = {}
        sums = _CellSums()

        def cells(folded) -> Iterator[pa.RecordBatch]:
            if folded is not None:
                listed = np.array(list(names), object)
                for at in range(0, len(folded[0]), ROWS_SENT):
                    code, row, col, cov, part, extent = (c[at : at + ROWS_SENT] for c in folded)
                    yield tagged(listed[code].tolist(), task, kind=[CELL] * len(code), grid_row=row, grid_col=col,
                                 cov=cov, part=part, size=extent)

        for batch in (piece for whole in batches for piece in _pieces(whole, 1)):
            coded = batch.column(0).dictionary_encode()
            numbers = np.array([names.setdefault(c, len(names)) for c in coded.dictionary.to_pylist()], np.int64)
            codes = numbers[coded.indices.to_numpy()]
            boundary = _Boundary(batch.column(1))
            sums.add(*_cell_terms(boundary, codes, size))
            outer = boundary.outer & np.isfinite(boundary.lon + boundary.lat)
            points = np.column_stack([boundary.lon[outer], boundary.lat[outer]])
            of = codes[boundary.feature[outer]]
            order = np.argsort(of, kind="stable")
            bounds = np.flatnonzero(np.diff(of[order])) + 1
            for mine in np.split(order, bounds) if len(order) else ():
                code = int(of[mine[0]])
                seen = points[mine]
                hulls[code] = hull_points(np.vstack([hulls[code], seen]) if code in hulls else seen)
            if sums.rows > ROWS_PER_FOLD:
                sums.fold()
                if sums.rows > CELLS_HELD:
                    yield from cells(sums.take())
        yield from cells(sums.take())
        listed = list(names)
        for code, corners in hulls.items():
            n = len(corners)
            yield tagged([listed[code]] * n, task, kind=[CORNER] * n, lon=corners[:, 0], lat=corners[:, 1])

    known = features.where(F.col("code").isNotNull() & F.col("geometry").isNotNull())
    return known.select("code", "geometry").mapInArrow(sweep, _TAGGED)


def cells_of_pass(tagged: DataFrame) -> DataFrame:
    """Shares of grid cells, as ``grid.cell_shares`` gives them, from the rows of a pass."""
    sums = tagged.where(F.col("kind") == CELL).groupBy("code", "grid_row", "grid_col").agg(
        F.sum("cov").alias("cov"), F.sum("part").alias("part"), F.sum("size").alias("_size")
    )
    return shares_of_sums(sums)


def map_cells(features: DataFrame, size: float = CELL_METRES) -> DataFrame:
    """Share of every grid cell covered by every class, straight from features."""
    return cells_of_pass(geometry_pass(features, size))
