"""Fill-in-middle documents, cut in bytes by a sparse index of multibyte characters.

Cuts are counted in code points or lines, texts are moved as UTF-8 bytes. Most bytes are
one character, so a batch records only its exceptions: where each multibyte character
stands and how many bytes more than one the characters up to it take. One ``searchsorted``
over the exceptions turns any number of byte cuts into code points or back; between
exceptions the two differ by a constant.
"""

from __future__ import annotations

import hashlib
import struct
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# What stands before the prefix, the suffix and the middle.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"

_OUT = "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string"


@dataclass(frozen=True)
class Rule:
    """How documents are cut: a seed, shares in percent and the unit of the cuts."""

    seed: int = 7
    rate: int = 100
    suffix_first: int = 50
    unit: str = "line"


class Exceptions:
    """Multibyte characters of a run of UTF-8 bytes, and conversions by them."""

    def __init__(self, data: np.ndarray):
        self.at = np.flatnonzero(data >= 0xC0)
        lead = data[self.at]
        wide = 1 + (lead >= 0xE0).astype(np.int64) + (lead >= 0xF0)
        self.excess = np.concatenate([[0], np.cumsum(wide)])
        # the place of each exception counted in code points
        self.char_at = self.at - self.excess[:-1]

    def to_chars(self, cuts: np.ndarray) -> np.ndarray:
        """Code points before byte offsets that lie between characters."""
        return cuts - self.excess[np.searchsorted(self.at, cuts)]

    def to_bytes(self, cuts: np.ndarray) -> np.ndarray:
        """Byte offsets of cuts given in code points."""
        return cuts + self.excess[np.searchsorted(self.char_at, cuts)]


def _flat(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column and the offsets of its rows; null is empty."""
    wide = texts.fill_null("").cast(pa.large_string())
    ends = np.frombuffer(wide.buffers()[1], np.int64)[wide.offset : wide.offset + len(wide) + 1]
    data = wide.buffers()[2]
    held = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return held[ends[0] : ends[-1]], ends - ends[0]


def _draws(doc_ids: list, seed: int) -> np.ndarray:
    """Four numbers a document, from the hash of seed and id (a null id counts as empty)."""
    hashed = (hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).digest()[:16] for i in doc_ids)
    return np.array([struct.unpack(">4I", h) for h in hashed], np.int64).reshape(-1, 4)


def _cut(doc_ids: pa.Array, texts: pa.Array, rule: Rule) -> pa.RecordBatch:
    data, ends = _flat(texts)
    start, end = ends[:-1], ends[1:]
    index = Exceptions(data)
    if rule.unit == "line":
        breaks = np.flatnonzero(data == 10)
        first = np.searchsorted(breaks, start)
        inside = np.searchsorted(breaks, end) - first
        last = data[np.maximum(end - 1, 0)] if len(data) else np.zeros(len(end), np.uint8)
        n = inside + ((end > start) & (last != 10))
    else:
        n = index.to_chars(end) - index.to_chars(start)
    draw = _draws(doc_ids.to_pylist(), rule.seed)
    a, b = draw[:, 0] % (n + 1), draw[:, 1] % (n + 1)

    def offset(units: np.ndarray) -> np.ndarray:
        """Byte offsets of cuts after so many units of each document."""
        if rule.unit != "line":
            return index.to_bytes(index.to_chars(start) + units)
        padded = np.append(breaks, len(data))
        after = padded[np.minimum(first + units - 1, len(breaks))] + 1
        return np.where(units == 0, start, np.where(units <= inside, after, end))

    low, high = offset(np.minimum(a, b)), offset(np.maximum(a, b))
    body = data.tobytes()
    marks = [m.encode() for m in (PREFIX, SUFFIX, MIDDLE)]
    outputs, forms = [], []
    chosen = draw[:, 2] % 100 < rule.rate
    spm = draw[:, 3] % 100 < rule.suffix_first
    for k, (s, x, y, e) in enumerate(zip(start.tolist(), low.tolist(), high.tolist(), end.tolist())):
        if s == e or not chosen[k] or any(body.find(m, s, e) >= 0 for m in marks):
            outputs.append(body[s:e])
            forms.append("plain")
        elif spm[k]:
            outputs.append(b"".join((marks[1], body[y:e], marks[0], body[s:x], marks[2], body[x:y])))
            forms.append("spm")
        else:
            outputs.append(b"".join((marks[0], body[s:x], marks[1], body[y:e], marks[2], body[x:y])))
            forms.append("psm")
    plain = np.array([f == "plain" for f in forms], bool)
    chars = index.to_chars(low)
    return pa.RecordBatch.from_pydict(
        {
            "doc_id": doc_ids, "n": pa.array(n, pa.int64()), "form": pa.array(forms, pa.string()),
            "prefix_chars": pa.array(chars - index.to_chars(start), pa.int64(), mask=plain),
            "middle_chars": pa.array(index.to_chars(high) - chars, pa.int64(), mask=plain),
            # the bytes come from valid strings cut between characters
            "output": pa.array(outputs, pa.binary()).view(pa.string()),
        }
    )


def transform(docs: DataFrame, rule: Rule = Rule()) -> DataFrame:
    """(doc_id, n, form, prefix_chars, middle_chars, output): every document, cut and reordered.

    ``n`` counts the units of the text: lines, each with the break that ends it, or code
    points. Prefix and middle end after the smaller and the larger of two draws from 0 to n;
    draws are hashes of seed and id, so reruns and repeated rows agree. A text that is empty
    or null, that holds one of the three marks, or that the rate leaves out is ``plain``: the
    output is the text (empty for null) and the two counts are null. Rows are independent: each goes through
    one task with its Arrow batch, nothing is shuffled. Columns besides doc_id and text are
    left behind, whatever their names.
    """

    def cut_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield _cut(batch.column(0), batch.column(1), rule)

    if rule.unit not in ("line", "char"):
        raise ValueError(f"cuts are counted by line or by char, not by {rule.unit}")
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(cut_batches, _OUT)


def restored(output: Column, form: Column) -> Column:
    """The text that an output was made from; exact, as no transformed text holds a mark."""
    body = F.substring(output, len(PREFIX) + 1, (1 << 31) - 1)

    def halves(mark: str) -> tuple[Column, Column]:
        return F.split_part(body, F.lit(mark), F.lit(1)), F.split_part(body, F.lit(mark), F.lit(2))

    def around(rest: Column) -> tuple[Column, Column]:
        return F.split_part(rest, F.lit(MIDDLE), F.lit(1)), F.split_part(rest, F.lit(MIDDLE), F.lit(2))

    prefix, rest = halves(SUFFIX)
    suffix, middle = around(rest)
    by_prefix = F.concat(prefix, middle, suffix)
    suffix, rest = halves(PREFIX)
    prefix, middle = around(rest)
    return F.when(form == "psm", by_prefix).when(form == "spm", F.concat(prefix, middle, suffix)).otherwise(output)
