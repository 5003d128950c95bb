"""Repeated multi-line chunks, wherever their boundaries are.

A hash rolls over every two visible lines in a row. Boundaries chosen by content would find
a passage only where two of them lie within it, which short passages often lack; here each
line begins a window, so a shared passage of two lines is found whatever surrounds it.
Windows that stand earlier in the corpus run together to the chunks that go. Equality is
equality of bytes; hashes only choose what to compare. Everything is DataFrame functions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ecoledger.llm.common import let
from ecoledger.session import broadcast_if_small, settle

LEAST_LINES = 2
_NO_ID = -(1 << 63)


def _keyed(docs: DataFrame) -> DataFrame:
    """The document key: its id and the hash of its text."""
    return docs.select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(_NO_ID)).alias("_id"),
        F.xxhash64("text").alias("_th"), "text",
    )


def _windows(lines: Column, size: int) -> Column:
    """Array of (no, last, body): every ``size`` visible lines in a row, with the blank lines between them."""

    def cut(seen: Column) -> Column:
        at = F.when(F.size(seen) >= size, F.sequence(F.lit(0), F.size(seen) - size))
        return F.transform(at, lambda j: window(F.get(seen, j), F.get(seen, j + size - 1)))

    def window(no: Column, last: Column) -> Column:
        body = F.array_join(F.slice(lines, no + 1, last - no + 1), "\n")
        return F.struct(no.alias("no"), last.alias("last"), body.alias("body"))

    every = F.sequence(F.lit(0), F.size(lines) - 1)
    return let(F.filter(every, lambda i: F.get(lines, i).rlike(r"[^\s]")), cut)


def repeated_chunks(docs: DataFrame, least_lines: int = LEAST_LINES) -> DataFrame:
    """(_id, _th, no, last, earlier) of every ``least_lines`` visible lines in a row that stand twice or more.

    A window begins at every visible line, so no passage of that many falls between
    boundaries; passages that are longer are runs of windows. The first place of a window,
    by doc_id (null first), text hash and line, has ``earlier`` false and appears once. Lines
    of white space alone are part of a window only between two others, and never count.
    """
    pieces = _keyed(docs).select(
        "_id", "_th", F.explode(let(F.split("text", "\n"), lambda lines: _windows(lines, least_lines))).alias("piece")
    ).select("_id", "_th", "piece.no", "piece.last", "piece.body")
    hashed = pieces.select(F.xxhash64("body").alias("h"))
    # a hash that repeats within one task is one row after the map-side part
    repeated = settle(hashed.groupBy("h").agg(F.count("*").alias("_n")).where("_n > 1").select("h"))
    some = pieces.withColumn("h", F.xxhash64("body")).join(broadcast_if_small(repeated), "h")
    place = F.struct("_id", "_th", "no", "last")
    # a row that stands twice is one place
    first = settle(
        some.groupBy("h", "body").agg(F.min(place).alias("first"), F.max(place).alias("final")).where("first <> final")
    )
    # joined on the bodies themselves: texts whose hashes collide stay apart
    later = some.join(first, ["h", "body"]).where(place != F.col("first"))
    return later.select("_id", "_th", "no", "last", F.lit(True).alias("earlier")).unionByName(
        first.select("first.*", F.lit(False).alias("earlier"))
    )


def without_repeated_chunks(docs: DataFrame, least_lines: int = LEAST_LINES) -> DataFrame:
    """``docs`` with ``text`` without repeated chunks, and how much went.

    A line goes if a window of ``repeated_chunks`` that stands earlier covers it, unless the
    first place of a repeated window covers it too: first places keep all their lines, so
    whatever goes stands whole at an earlier place. A chunk is a run of lines that go. New columns: ``lines_removed`` and
    ``chunks_removed``. Every row stays: a text that is all repeats becomes empty, a null
    text stays null. A row that repeats both the id and the text of another is that same
    document and keeps what it keeps. Other columns stay.
    """
    span = F.struct("no", "last")
    # at most two spans a line of one document
    gone = repeated_chunks(docs, least_lines).groupBy("_id", "_th").agg(
        F.collect_set(F.when(F.col("earlier"), span)).alias("_gone"),
        F.collect_set(F.when(~F.col("earlier"), span)).alias("_stay"),
    ).where(F.size("_gone") > 0)
    keyed = docs.withColumns(
        {"_id": F.coalesce(F.col("doc_id").cast("long"), F.lit(_NO_ID)), "_th": F.xxhash64("text")}
    )

    def rest(lines: Column, out: Column) -> Column:
        every = F.sequence(F.lit(0), F.size(lines) - 1)
        return F.struct(
            F.array_join(F.transform(F.array_except(every, out), lambda i: F.get(lines, i)), "\n").alias("text"),
            F.size(out).alias("lines"),
            # a run begins at a line whose line before stays
            F.size(F.array_except(out, F.transform(out, lambda i: i + 1))).alias("chunks"),
        )

    def covered(spans: str) -> Column:
        return F.flatten(F.transform(F.col(spans), lambda g: F.sequence(g["no"], g["last"])))

    out = F.array_except(covered("_gone"), covered("_stay"))
    cut_text = let(F.split("text", "\n"), lambda lines: let(out, lambda o: rest(lines, o)))
    joined = keyed.join(gone, ["_id", "_th"], "left")
    cut = joined.withColumn("_rest", F.when(F.col("_gone").isNotNull(), cut_text))
    return cut.withColumns(
        {
            "text": F.coalesce(F.col("_rest.text"), F.col("text")),
            "lines_removed": F.coalesce(F.col("_rest.lines"), F.lit(0)).cast("long"),
            "chunks_removed": F.coalesce(F.col("_rest.chunks"), F.lit(0)).cast("long"),
        }
    ).drop("_id", "_th", "_gone", "_stay", "_rest")
