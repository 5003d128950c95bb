"""Repeated passages by difference-cover anchors.

A set of residues is a difference cover of a period if any two residues are both carried
into it by one common step. Hashing short windows at cover positions alone therefore
makes any two equal passages of ``window`` words share an anchor at the same place of
both. Windows of full length are looked at only around anchors that two documents share:
there the anchor is extended to the whole window, and the window belongs to the smallest
doc_id that has it.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ecoledger.llm.wordhash import run_hashes, word_hashes

WINDOW = 50
# Perfect difference sets, each residue is one difference.
COVERS = {1: [0], 3: [0, 1], 7: [0, 1, 3], 13: [0, 1, 3, 9], 21: [3, 6, 7, 12, 14], 31: [1, 5, 11, 24, 25, 27]}
_NO_ID = -(1 << 63)
_PLACE_BITS = 32


def cover(window: int) -> tuple[int, list[int], int]:
    """(period, residues, anchor words): the longest period that leaves three fifths of the window."""
    period = max(p for p in COVERS if window - p + 1 >= max(1, 0.6 * window))
    return period, COVERS[period], window - period + 1


def _anchor_places(words: int, window: int) -> np.ndarray:
    period, residues, size = cover(window)
    last = words - size
    if words < window:
        return np.zeros(0, np.int64)
    places = (np.arange(0, last + 1, period)[:, None] + np.array(residues)).ravel()
    return places[places <= last]


def _frames(parts: list[tuple[int, int, np.ndarray, np.ndarray]]) -> pd.DataFrame:
    """(h, _id, spot) of all (id, tag, places, hashes); a spot is the tag above the place."""
    counts = [len(p[2]) for p in parts]
    ids = np.repeat(np.array([p[0] for p in parts], np.int64), counts)
    tags = np.repeat(np.array([p[1] for p in parts], np.int64), counts)
    places = np.concatenate([p[2] for p in parts] or [np.zeros(0, np.int64)])
    hashes = np.concatenate([p[3] for p in parts] or [np.zeros(0, np.uint64)])
    return pd.DataFrame({"h": hashes.view(np.int64), "_id": ids, "spot": (tags << _PLACE_BITS) + places})


def _anchors(texts: DataFrame, window: int) -> DataFrame:
    """(h, _id, spot) of every anchor of texts of ``window`` words or more."""
    size = cover(window)[2]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            parts = []
            for key, tag, body in zip(b["_id"], b["_tag"], b["body"]):
                words = word_hashes(zstandard.decompress(body))
                at = _anchor_places(len(words), window)
                if len(at):
                    parts.append((key, tag, at, run_hashes(words, size, at)))
            yield _frames(parts)

    return texts.select("_id", "_tag", "body").mapInPandas(run, "h long, _id long, spot long")


def _windows(spotted: DataFrame, window: int) -> DataFrame:
    """(h, _id, spot) of every window that holds one of its text's shared anchors."""
    period = cover(window)[0]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            parts = []
            for key, tag, body, spots in zip(b["_id"], b["_tag"], b["body"], b["spots"]):
                words = word_hashes(zstandard.decompress(body))
                starts = len(words) - window + 1
                # windows start up to period - 1 words before an anchor
                mark = np.zeros(starts + period + 1, np.int64)
                at = np.asarray(spots, np.int64)
                np.add.at(mark, np.maximum(at - period + 1, 0), 1)
                np.add.at(mark, np.minimum(at + 1, len(mark) - 1), -1)
                at = np.flatnonzero(np.cumsum(mark)[:starts])
                parts.append((key, tag, at, run_hashes(words, window, at)))
            yield _frames(parts)

    return spotted.select("_id", "_tag", "body", "spots").mapInPandas(run, "h long, _id long, spot long")


def _splittable(keys: DataFrame, by: str = "h") -> DataFrame:
    """``keys`` with a second join key that follows from ``by`` and is always false.

    The join then shuffles this side anew although it is dealt by ``by``, and adaptive
    execution may split a hot key of the other side.
    """
    return keys.withColumn("g", F.isnull(by))


def _by_text(spots: DataFrame, name: str) -> DataFrame:
    """Places of one text as one array; a text has at most as many as words."""
    return spots.groupBy("_id", F.shiftright("spot", _PLACE_BITS).alias("_tag")).agg(
        F.collect_list(F.col("spot").bitwiseAND((1 << _PLACE_BITS) - 1)).alias(name)
    )


def _compressed(texts: DataFrame) -> DataFrame:
    """(_id, _tag, body): texts compressed for the one exchange that all passes share."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        squeeze = zstandard.ZstdCompressor(level=3)
        for b in batches:
            yield b[["_id", "_tag"]].assign(body=[squeeze.compress(t.encode()) for t in b["text"]])

    squeezed = texts.select("_id", "_tag", "text").mapInPandas(run, "_id long, _tag long, body binary")
    # never null; said here, every join of the texts has the same input and shares its exchange
    return squeezed.where("_id is not null and _tag is not null")


def remove_repeats(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_sha256, kept) for every row of ``docs`` (doc_id, text).

    Words are runs without ASCII white space. Every word inside a run of ``window`` words
    that also stands in a document of a smaller doc_id goes; runs are judged on the input.
    ``kept`` is the words that stay, joined by one space. Null texts have no words; a null
    id is smaller than all others. Rows that repeat an id are judged one by one, and do not
    take words from each other. Other columns are ignored.

    Hashes of 64 bits stand for runs of words. One short job looks for repeated ids; the
    rest is one plan: the texts are shuffled once, by id, and that exchange serves all four
    passes over them.
    """
    t2 = F.xxhash64(F.lit(1), "text")
    repeated = docs.groupBy("doc_id").agg(F.count("*").alias("n")).where("n > 1").limit(1).count()
    # where ids are unique nothing else has to tell texts apart, and narrow rows stay narrow
    tag = F.pmod(F.xxhash64("text"), F.lit(1 << 30)) if repeated else F.lit(0).cast("long")
    key = ["_id", "_tag"] if repeated else ["_id"]

    def by_key(found: DataFrame) -> DataFrame:
        return found if repeated else found.drop("_tag")

    keyed = docs.select(
        "doc_id", F.coalesce(F.col("doc_id").cast("long"), F.lit(_NO_ID)).alias("_id"),
        tag.alias("_tag"), F.coalesce("text", F.lit("")).alias("text"),
    )
    narrow = keyed.select("_id", "_tag", F.xxhash64("text").alias("t1"), t2.alias("t2"))
    # of equal texts only the one of the smallest id needs windows; the others go whole
    least = narrow.groupBy("t1", "t2").agg(F.min("_id").alias("first_id"), F.count("*").alias("n")).where("n > 1")
    copies = (
        _splittable(narrow, "t1").join(_splittable(least, "t1"), ["t1", "t2", "g"])
        .where("_id > first_id").select("_id", "_tag").distinct().withColumn("_copy", F.lit(True))
    )
    texts = _compressed(keyed)
    own = texts.join(by_key(copies), key, "left").where("_copy is null")

    anchors = _anchors(own, window)
    shared = _splittable(anchors.groupBy("h").agg(F.count("*").alias("n")).where("n > 1").select("h"))
    spots = _by_text(_splittable(anchors).join(shared, ["h", "g"]).select("_id", "spot"), "spots")
    windows = _windows(texts.join(by_key(spots), key), window)
    owners = _splittable(
        windows.groupBy("h").agg(F.min("_id").alias("owner"), F.max("_id").alias("last"))
        .where("owner < last").select("h", "owner")
    )
    gone = _by_text(_splittable(windows).join(owners, ["h", "g"]).where("_id > owner").select("_id", "spot"), "starts")

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for body, starts, copy in zip(b["body"], b["starts"], b["_copy"]):
                words = zstandard.decompress(body).split()
                n = len(words)
                if copy is True and n >= window:
                    words = []
                elif starts is not None:
                    mark = np.zeros(n + 1, np.int64)
                    at = np.unique(np.asarray(starts, np.int64))
                    mark[at] += 1
                    mark[at + window] -= 1
                    words = [words[k] for k in np.flatnonzero(np.cumsum(mark)[:n] == 0)]
                kept = b" ".join(words)
                rows.append((n, n - len(words), hashlib.sha256(kept).hexdigest(), kept.decode()))
            out = pd.DataFrame(rows, columns=["n_words", "n_removed", "kept_sha256", "kept"])
            out.insert(0, "_id", b["_id"].to_numpy())
            yield out

    marked = texts.join(by_key(copies), key, "left").join(by_key(gone), key, "left")
    result = marked.mapInPandas(cut, "_id long, n_words long, n_removed long, kept_sha256 string, kept string")
    return result.select(
        F.when(F.col("_id") != _NO_ID, F.col("_id")).alias("doc_id"), "n_words", "n_removed", "kept_sha256", "kept"
    )
