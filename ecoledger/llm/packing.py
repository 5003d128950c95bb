"""Best-fit packing with certified bin counts.

Pieces are packed by best-fit decreasing in partitions of bounded size. Dual feasible
functions bound from below how many bins a partition needs; where a partition uses more
than its bound, or a bin is left with much room, the pieces of those bins are dealt into
other partitions and packed again, until the whole meets its bound or stops gaining.
"""

from __future__ import annotations

import bisect
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ecoledger.llm.common import groups_of, texts_of, with_uid
from ecoledger.llm.tokens import encoder
from ecoledger.session import narrow_batches, settle

PIECES_PER_PARTITION = 65_536
ROUNDS = 3
_PIECE_SCHEMA = "doc_id long, piece int, start long, length long, ids_crc32 long"
_PLACED_SCHEMA = "_uid long, length long, part int, bin int, offset long, room int, bins int, bound int"


def token_pieces(
    docs: DataFrame, vocabulary: str, end_id: int, capacity: int, kept: int | None = None
) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32): every document's ids cut at ``capacity``.

    A document is its ids and ``end_id``; null and empty texts are the end id alone.
    Only documents longer than ``capacity`` are cut. Repeated rows each give pieces.
    A worker keeps ``kept`` pieces of text of each generation, fewer for less memory.
    """

    columns = ("doc_id", "piece", "start", "length", "ids_crc32")
    schema = pa.schema([(c, pa.int32() if c == "piece" else pa.int64()) for c in columns])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_of = encoder(vocabulary, kept)
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch["doc_id"].to_pylist(), texts_of(batch["text"])):
                ids = np.frombuffer(ids_of.encode(text), ids_of.dtype).astype("<u4")
                ids = np.append(ids, np.uint32(end_id)).astype("<u4")
                for n, at in enumerate(range(0, len(ids), capacity)):
                    part = ids[at : at + capacity]
                    rows.append((doc_id, n, at, len(part), zlib.crc32(part.tobytes())))
            if rows:
                yield pa.RecordBatch.from_pydict(dict(zip(columns, zip(*rows))), schema=schema)

    texts = docs.select(F.col("doc_id").cast("long"), "text")
    return narrow_batches(texts).mapInArrow(cut, _PIECE_SCHEMA)


def lower_bound(lengths: np.ndarray, counts: np.ndarray, capacity: int) -> int:
    """Bins that ``counts`` pieces of each of ``lengths`` need at least.

    The largest of the bounds by volume, by the rounding functions u(k) and by the
    functions that drop pieces below a limit and round those above its complement up.
    """
    lengths, counts = lengths.astype(np.int64), counts.astype(np.int64)
    best = -(-int((lengths * counts).sum()) // capacity)
    for k in range(1, 33):
        steps = (k + 1) * lengths
        scaled = np.where(steps % capacity == 0, lengths * k, steps // capacity * capacity)
        best = max(best, -(-int((scaled * counts).sum()) // (k * capacity)))
    for limit in np.unique(np.minimum(lengths, capacity - lengths)):
        if limit > 0:
            kept = np.where(lengths > capacity - limit, capacity, np.where(lengths < limit, 0, lengths))
            best = max(best, -(-int((kept * counts).sum()) // capacity))
    return best


def best_fit_decreasing(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bin of each piece, place in it, room left of each bin), longest pieces first."""
    order = np.argsort(-lengths, kind="stable")
    bins, offsets = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    free: list[int] = []
    with_room: list[list[int]] = [[] for _ in range(capacity + 1)]
    rooms: list[int] = []  # the different rooms of open bins, ascending
    for i in order:
        need = int(lengths[i])
        at = bisect.bisect_left(rooms, need)
        if at == len(rooms):
            chosen, room = len(free), capacity
            free.append(capacity)
        else:
            room = rooms[at]
            chosen = with_room[room].pop()
            if not with_room[room]:
                rooms.pop(at)
        bins[i], offsets[i] = chosen, capacity - room
        free[chosen] = left = room - need
        if left:
            if not with_room[left]:
                bisect.insort(rooms, left)
            with_room[left].append(chosen)
    return bins, offsets, np.array(free, np.int64)


def _pack_part(capacity: int):
    def pack(frame: pd.DataFrame) -> pd.DataFrame:
        lengths = frame["length"].to_numpy()
        bins, offsets, room = best_fit_decreasing(lengths, capacity)
        sizes, counts = np.unique(lengths, return_counts=True)
        return pd.DataFrame(
            {
                "_uid": frame["_uid"], "length": lengths, "part": frame["part"], "bin": bins,
                "offset": offsets, "room": room[bins], "bins": len(room),
                "bound": lower_bound(sizes, counts, capacity),
            }
        )

    return pack


def _packed(pieces: DataFrame, rows: int, first_part: int, turn: int, capacity: int) -> DataFrame:
    """Deal (_uid, length) into partitions of bounded size by hash and pack each."""
    parts = groups_of(rows, PIECES_PER_PARTITION)
    dealt = pieces.select(
        "_uid", "length",
        (F.pmod(F.xxhash64("_uid", F.lit(turn)), F.lit(parts)) + first_part).cast("int").alias("part"),
    )
    return dealt.groupBy("part").applyInPandas(_pack_part(capacity), _PLACED_SCHEMA)


def _bin_count(placed: DataFrame) -> int:
    return placed.select("part", "bins").distinct().agg(F.sum("bins")).first()[0] or 0


def corpus_bound(pieces: DataFrame, capacity: int) -> int:
    """The lower bound of all pieces together, from the histogram of their lengths."""
    # at most ``capacity`` rows
    counts = pieces.groupBy("length").count().toPandas()
    return lower_bound(counts["length"].to_numpy(), counts["count"].to_numpy(), capacity)


def pack(pieces: DataFrame, capacity: int, rounds: int = ROUNDS) -> DataFrame:
    """``pieces`` with (sequence_id, offset), and (part_bins, part_bound) of its partition.

    ``pieces`` has a ``length`` from 1 to ``capacity``; other columns stay. Full pieces fill
    sequences of their own. Runs jobs: the pieces and each round are settled, as narrow
    rows. An empty table gives an empty result.
    """
    pieces = settle(with_uid(pieces))
    narrow = pieces.select("_uid", "length").where(F.col("length") < capacity)
    rows = narrow.count()
    whole = pieces.where(F.col("length") == capacity).select(
        "_uid", (-1 - F.col("_uid")).alias("sequence_id"), F.lit(0).cast("long").alias("offset"),
        F.lit(1).alias("part_bins"), F.lit(1).alias("part_bound"),
    )
    placed = settle(_packed(narrow, rows, 0, 0, capacity))
    bound, used = corpus_bound(narrow, capacity), _bin_count(placed)
    first_part = groups_of(rows, PIECES_PER_PARTITION)
    for turn in range(1, rounds + 1):
        if used <= bound:
            break
        # bins of partitions above their bound, and bins that are left rather empty, trade pieces
        loose = (F.col("bins") > F.col("bound")) | (F.col("room") * 16 > capacity)
        moved, kept = placed.where(loose), placed.where(~loose)
        again_rows = moved.count()
        before = moved.select("part", "bin").distinct().count()
        again = settle(_packed(moved, again_rows, first_part, turn, capacity))
        after = _bin_count(again)
        first_part += groups_of(again_rows, PIECES_PER_PARTITION)
        if after >= before:
            break
        placed, used = settle(kept.unionByName(again)), used - before + after
    dealt = placed.select(
        "_uid", (F.col("part").cast("long") * (1 << 32) + F.col("bin")).alias("sequence_id"),
        "offset", F.col("bins").alias("part_bins"), F.col("bound").alias("part_bound"),
    )
    return pieces.join(dealt.unionByName(whole), "_uid").drop("_uid")
