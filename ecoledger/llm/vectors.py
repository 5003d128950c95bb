"""Vectors as shards: bounded blocks that one task holds as arrays."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def usable(vector: Column) -> Column:
    """Whether a vector has components, all finite, and not all zero; false for null."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.coalesce((F.size(vector) > 0) & finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def as_doubles(vector: Column) -> Column:
    """Components as doubles; adding zero makes the two zeros one."""
    return F.transform(vector.cast("array<double>"), lambda x: x + F.lit(0.0))


def matrix(column: pd.Series) -> np.ndarray:
    """A column of equally long vectors as rows of doubles."""
    return np.array([np.asarray(v, np.float64) for v in column], np.float64)


def unit(x: np.ndarray) -> np.ndarray:
    """Rows scaled to length 1, through their largest component, so that no square overflows."""
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt(np.einsum("ij,ij->i", x, x))[:, None]


def packed(rows: DataFrame, keys: list[str], id_name: str, extra: str | None = None) -> DataFrame:
    """One row per group of ``keys``: ids, vectors (and one extra long column) as bytes.

    Groups must be of bounded size: callers deal rows into shards first.
    """
    schema = ", ".join(f"{k} {rows.schema[k].dataType.simpleString()}" for k in keys)
    schema += ", n int, ids binary, vectors binary" + (", extra binary" if extra else "")

    def pack(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(id_name)
        row = {k: [frame[k].iloc[0]] for k in keys} | {
            "n": [len(frame)], "ids": [frame[id_name].to_numpy(np.int64).tobytes()],
            "vectors": [matrix(frame["vector"]).tobytes()],
        }
        if extra:
            row["extra"] = [frame[extra].to_numpy(np.int64).tobytes()]
        return pd.DataFrame(row)

    return rows.groupBy(*keys).applyInPandas(pack, schema)


def unpacked(ids: bytes, vectors: bytes, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids and vectors of a packed shard."""
    return np.frombuffer(ids, np.int64), np.frombuffer(vectors, np.float64).reshape(n, -1)
