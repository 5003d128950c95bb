"""Categorical raster as run-length spans of equal pixels.

A pixel belongs to a polygon when its centre does. Spans (index, src_ordinal,
row, c0, c1) with inclusive columns replace pixels throughout: at 10 m a country
has some 10^10 pixels but far fewer spans.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# Fixed value: default pixel size in metres.
PIXEL_METRES = 100.0

# Spans are cut at multiples of this many columns, so that work on one pixel row
# is split into pieces of bounded width.
BLOCK_COLUMNS = 1024


def crossings(edge_rows: DataFrame, resolution: float) -> DataFrame:
    """Where each edge crosses pixel-centre rows: (fid, code, src_ordinal, row, x, turn)."""
    scaled = edge_rows.select(
        "fid", "code", "src_ordinal", "turn",
        *[(F.col(c) / resolution).alias(c) for c in ("x0", "y0", "x1", "y1")],
    )
    first = F.ceil(F.col("y0") - 0.5)
    last = F.ceil(F.col("y1") - 0.5) - 1
    rows = scaled.where(first <= last).select("*", F.explode(F.sequence(first, last)).alias("row"))
    slope = (F.col("x1") - F.col("x0")) / (F.col("y1") - F.col("y0"))
    return rows.select(
        "fid", "code", "src_ordinal", "row", "turn",
        (F.col("x0") + (F.col("row") + 0.5 - F.col("y0")) * slope).alias("x"),
    )


def feature_spans(edge_rows: DataFrame, resolution: float = PIXEL_METRES) -> DataFrame:
    """Spans of each feature by the winding rule, cut at column blocks.

    Gives (code, src_ordinal, row, block, c0, c1). The windows hold one pixel row
    of one feature.
    """
    # numbers first: they settle the sort before codes have to be compared
    w = Window.partitionBy("row", "fid", "code").orderBy("x", F.desc("turn"))
    swept = crossings(edge_rows, resolution).select(
        "code", "src_ordinal", "row", "x",
        F.sum("turn").over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("_depth"),
        F.lead("x").over(w).alias("_until"),
    )
    # going east, a boundary whose interior lies to its right opens with turn -1
    spans = swept.where("_depth < 0").select(
        "code", "src_ordinal", "row",
        F.ceil(F.col("x") - 0.5).alias("_from"), (F.ceil(F.col("_until") - 0.5) - 1).alias("_to"),
    ).where("_from <= _to")
    blocks = spans.select(
        "*",
        F.explode(
            F.sequence(F.floor(F.col("_from") / BLOCK_COLUMNS), F.floor(F.col("_to") / BLOCK_COLUMNS))
        ).alias("block"),
    )
    return blocks.select(
        "code", "src_ordinal", "row", "block",
        F.greatest("_from", F.col("block") * BLOCK_COLUMNS).alias("c0"),
        F.least("_to", (F.col("block") + 1) * BLOCK_COLUMNS - 1).alias("c1"),
    )


def raster_spans(edge_rows: DataFrame, resolution: float = PIXEL_METRES) -> DataFrame:
    """Disjoint spans (code, row, block, c0, c1); on overlaps the later feature wins.

    The spans of a pixel row fall into islands at the gaps between them: a span begins an
    island if it begins beyond the running maximum of ends. A span alone on its island, as
    all are on a map that tiles, stays as it is, untouched by what follows. The others are
    swept in source order on a canvas of one block, so a task never holds more than the
    batch it reads and 1,024 columns, however many features cover one place.
    """
    # copies of one shape collapse on the map side; what is left per block is at
    # most one span per class and pair of columns
    spans = (
        feature_spans(edge_rows, resolution)
        .groupBy("row", "block", "c0", "c1", "code")
        .agg(F.max("src_ordinal").alias("src_ordinal"))
    )
    place = Window.partitionBy("row", "block").orderBy("c0", "c1")
    reached = F.max("c1").over(place.rowsBetween(Window.unboundedPreceding, -1))
    opened = spans.withColumn("_opens", F.coalesce(F.col("c0") > reached, F.lit(True)))
    alone = F.col("_opens") & F.coalesce(F.lead("_opens").over(place), F.lit(True))
    marked = opened.withColumn("_alone", alone)
    ordered = F.struct("src_ordinal", "code")
    swept = (
        marked.where(~F.col("_alone")).select("row", "block", "src_ordinal", "code", "c0", "c1")
        .sortWithinPartitions("row", "block", ordered)
        .mapInArrow(_paint, "code string, row long, block long, c0 long, c1 long")
    )
    return marked.where("_alone").select("code", "row", "block", "c0", "c1").unionByName(swept)


def _paint(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Disjoint spans of rows sorted by pixel row, block and age: later ones cover earlier ones."""
    canvas = np.zeros(BLOCK_COLUMNS, np.int64)
    codes: dict[str, int] = {}
    place, done = None, []

    def leave() -> None:
        """Read the runs of one code off the canvas and clear it."""
        row, block = place
        edge = np.flatnonzero(np.diff(canvas, prepend=0, append=0))
        of = canvas[edge[:-1]]
        kept = of > 0
        done.append((np.full(kept.sum(), row), np.full(kept.sum(), block), of[kept],
                     block * BLOCK_COLUMNS + edge[:-1][kept], block * BLOCK_COLUMNS + edge[1:][kept] - 1))
        canvas[:] = 0

    def spans() -> pa.RecordBatch:
        row, block, of, c0, c1 = (np.concatenate(part) for part in zip(*done))
        done.clear()
        named = pa.array(list(codes), pa.string()).take(pa.array(of - 1))
        return pa.RecordBatch.from_arrays(
            [named, *[pa.array(v, pa.int64()) for v in (row, block, c0, c1)]], ["code", "row", "block", "c0", "c1"]
        )

    for batch in batches:
        if not batch.num_rows:
            continue
        coded = batch.column(3).dictionary_encode("encode")
        numbers = np.array([codes.setdefault(c, len(codes) + 1) for c in coded.dictionary.to_pylist()], np.int64)
        row, block, c0, c1 = (batch.column(k).to_numpy() for k in (0, 1, 4, 5))
        begin = (c0 - block * BLOCK_COLUMNS).tolist()
        end = (c1 - block * BLOCK_COLUMNS + 1).tolist()
        number = numbers[coded.indices.to_numpy()].tolist()
        turns = np.flatnonzero((np.diff(row) != 0) | (np.diff(block) != 0)) + 1
        for first, last in zip([0, *turns.tolist()], [*turns.tolist(), len(row)]):
            here = (int(row[first]), int(block[first]))
            if place is not None and here != place:
                leave()
            place = here
            for k in range(first, last):
                canvas[begin[k] : end[k]] = number[k]
        if len(done) >= 10_000:
            yield spans()
    if place is not None:
        leave()
    if done:
        yield spans()


def pixel_counts(spans: DataFrame, resolution: float = PIXEL_METRES) -> DataFrame:
    """Pixels and raster area per class, straight from the spans."""
    return spans.groupBy("code").agg(
        F.sum(F.col("c1") - F.col("c0") + 1).alias("pixels"),
        (F.sum(F.col("c1") - F.col("c0") + 1) * (resolution / 1000.0) ** 2).alias("raster_km2"),
    )


def pixels(spans: DataFrame) -> DataFrame:
    """One row per pixel, for tiles and other small windows."""
    keep = [c for c in spans.columns if c not in ("c0", "c1", "block")]
    return spans.select(*keep, F.explode(F.sequence("c0", "c1")).alias("col"))
