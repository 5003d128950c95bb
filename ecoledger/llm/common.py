"""Helpers shared by the training-data operators."""

from __future__ import annotations

import sys
import types
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The white space between words, as a regular expression class.
SPACES = r"\x20\x09-\x0D"
WORD_PATTERN = rf"[^{SPACES}]+"


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """One input table as Spark reads it, from any store Spark can open."""
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def word_count(text: Column) -> Column:
    """Number of words (runs without white space); 0 for null."""
    inner = F.btrim(text, F.lit(" \t\n\x0b\x0c\r"))
    counted = F.size(F.split(inner, rf"[{SPACES}]+"))
    return F.when(inner.isNull() | (inner == ""), 0).otherwise(counted).cast("long")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once, however often the body names it."""
    return F.transform(F.array(value), body)[0]


def with_uid(df: DataFrame, name: str = "_uid") -> DataFrame:
    """A number per row, so that repeated rows stay apart. Stable once the result is settled."""
    return df.withColumn(name, F.monotonically_increasing_id())


def texts_of(column: pa.Array, at_once: int = 256) -> Iterator[str | None]:
    """The texts of a column of a batch, made into Python strings a few at a time."""
    for k in range(0, len(column), at_once):
        yield from column.slice(k, at_once).to_pylist()


def worker_state(name: str, make: Callable[[], object]) -> object:
    """An object that one Python worker keeps between its tasks.

    Functions travel by value, so their module globals do not outlive a task; a
    module of its own does.
    """
    home = sys.modules.setdefault("_ecoledger_worker", types.ModuleType("_ecoledger_worker"))
    if not hasattr(home, name):
        setattr(home, name, make())
    return getattr(home, name)


def groups_of(rows: int, per_group: int) -> int:
    """How many groups of about ``per_group`` rows hold ``rows`` rows; at least one."""
    return max(1, -(-rows // per_group))
