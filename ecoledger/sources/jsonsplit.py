"""Reading one large JSON collection with many tasks.

The objects in the arrays of a document's top level are found without parsing the document
in one place. Text is read in splits at closing braces. A split cannot know whether it
begins inside a string or how deep, so a first pass sums up what it does to either state,
running sums of these give the state at each split, and a second pass cuts the objects out.
An object that crosses splits is put together from its pieces.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ecoledger.session import settle

# Where rows of the text end. A backslash never stands before a row, so no row begins escaped.
_END = "}"
_OBJECT_DEPTH = 3
_PIECES = "file string, block long, at long, whole boolean, head boolean, value binary"


def _splits(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple, bytes]]:
    """The text of each split of a file, with the other columns of its first row."""
    key, held = None, []
    for batch in batches:
        others = [batch.column(k).to_pylist() for k in range(batch.num_columns - 1)]
        for here, text in zip(zip(*others), batch.column(batch.num_columns - 1).cast(pa.binary()).to_pylist()):
            if here != key:
                if held:
                    yield key, _END.encode().join([*held, b""])
                key, held = here, []
            held.append(text)
    if held:
        yield key, _END.encode().join([*held, b""])


def _structure(text: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places of quotes that are not escaped, places of brackets, and their steps in depth."""
    data = np.frombuffer(text, np.uint8)
    quotes = np.flatnonzero(data == 34)
    after_slash = np.flatnonzero((quotes > 0) & (data[quotes - 1] == 92))
    escaped = np.zeros(len(quotes), bool)
    for k in after_slash.tolist():
        escaped[k] = _odd_slashes(text, int(quotes[k]))
    opens = (data == 123) | (data == 91)
    brackets = np.flatnonzero(opens | (data == 125) | (data == 93))
    return quotes[~escaped], brackets, np.where(opens[brackets], 1, -1)


def _odd_slashes(text: bytes, at: int) -> bool:
    """Whether an odd number of backslashes stands right before a place."""
    first = at
    while first and text[first - 1] == 92:
        first -= 1
    return (at - first) % 2 == 1


def _inside(quotes: np.ndarray, places: np.ndarray, in_string: int) -> np.ndarray:
    return (np.searchsorted(quotes, places) + in_string) % 2 == 1


def _summaries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What a split does to the state: quotes, and the change of depth from either side of a string."""
    for (file, block), text in _splits(batches):
        quotes, brackets, step = _structure(text)
        inside = _inside(quotes, brackets, 0)
        yield pa.RecordBatch.from_pydict(
            {"file": [file], "block": [block], "quotes": [len(quotes)],
             "outside": [int(step[~inside].sum())], "inside": [int(step[inside].sum())]}
        )


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Objects of each split, whole or in part, from the state at its start."""
    for (file, block, in_string, depth), text in _splits(batches):
        quotes, brackets, step = _structure(text)
        real = ~_inside(quotes, brackets, in_string)
        brackets, step = brackets[real], step[real]
        after = depth + np.cumsum(step)
        braces = np.frombuffer(text, np.uint8)[brackets]
        starts = brackets[(after == _OBJECT_DEPTH) & (step == 1) & (braces == 123)]
        ends = brackets[(after == _OBJECT_DEPTH - 1) & (step == -1) & (braces == 125)] + 1
        cuts = []
        if depth >= _OBJECT_DEPTH:
            # the rest of an object that began in an earlier split, or a middle of it
            first = int(ends[0]) if len(ends) else len(text)
            cuts.append((0, first, False, False))
            ends = ends[1:]
        cuts += [(s, e, True, True) for s, e in zip(starts.tolist(), ends.tolist())]
        if len(starts) > len(ends):
            cuts.append((int(starts[-1]), len(text), False, True))
        for k in range(0, len(cuts), 1000):
            some = cuts[k : k + 1000]
            n = len(some)
            yield pa.RecordBatch.from_pydict(
                {
                    "file": pa.array([file] * n, pa.string()), "block": pa.array([block] * n, pa.int64()),
                    "at": pa.array([c[0] for c in some], pa.int64()), "whole": [c[2] for c in some],
                    "head": [c[3] for c in some], "value": pa.array([text[c[0] : c[1]] for c in some], pa.binary()),
                }
            )


def array_objects(spark: SparkSession, path: str) -> DataFrame:
    """(file, block, at, value): the objects in top-level arrays of the JSON files at ``path``.

    One file is read by as many tasks as it has splits of ``spark.sql.files.maxPartitionBytes``. Objects are in
    the order of (file, block, at): the split they begin in and the place there. Strings may
    hold brackets and escaped quotes, members may stand in any order, and an object may be
    longer than a split. Runs the job that sums the splits up; their states, a row for each
    split, are broadcast.
    """
    rows = spark.read.option("lineSep", _END).text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), "value"
    )
    summed = settle(rows.mapInArrow(_summaries, "file string, block long, quotes long, outside long, inside long"))
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    so_far = F.coalesce(F.sum("quotes").over(before), F.lit(0))
    stringed = summed.withColumn("in_string", so_far % 2)
    change = F.when(F.col("in_string") == 1, F.col("inside")).otherwise(F.col("outside"))
    states = stringed.withColumn("change", change).select(
        "file", "block", "in_string", F.coalesce(F.sum("change").over(before), F.lit(0)).alias("depth")
    )
    # rows keep their order in a broadcast join
    known = rows.join(F.broadcast(states), ["file", "block"]).select("file", "block", "in_string", "depth", "value")
    pieces = known.mapInArrow(_pieces, _PIECES)
    whole = pieces.where("whole").select("file", "block", "at", F.decode("value", "UTF-8").alias("value"))
    # at most two pieces a split are no whole objects
    order = Window.partitionBy("file").orderBy("block", "at").rowsBetween(Window.unboundedPreceding, 0)
    begun = F.last(F.when(F.col("head"), F.struct("block", "at")), ignorenulls=True).over(order)
    joined = pieces.where(~F.col("whole")).withColumn("begun", begun).groupBy("file", "begun").agg(
        F.array_sort(F.collect_list(F.struct("block", "at", "value"))).alias("parts")
    )
    crossing = joined.select(
        "file", "begun.block", "begun.at",
        F.decode(F.aggregate("parts", F.lit(b""), lambda text, p: F.concat(text, p["value"])), "UTF-8").alias("value"),
    )
    return whole.unionByName(crossing)
