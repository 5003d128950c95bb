"""Sorted copies, cell tables and the class-index file."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ecoledger.functions.text import lacks_column
from ecoledger.operators.grid import CELL_METRES
from ecoledger.operators.rings import without_copies
from ecoledger.operators.sweep import map_cells

# Fixed value: rows per row group of a sorted copy.
ROW_GROUP_ROWS = 10_000

INDEX_SCHEMA = "index INT, code STRING, name STRING"

# Quotes are doubled, spaces and line breaks kept, and null told apart from empty.
_CSV = {
    "header": True, "quote": '"', "escape": '"', "ignoreLeadingWhiteSpace": False,
    "ignoreTrailingWhiteSpace": False, "nullValue": "\\N",
}

# Fixed value: rows per row group of a cell table, so that one class reads few of them.
CELL_GROUP_ROWS = 10_000


def write_sorted_copy(
    df: DataFrame,
    path: str,
    ecosystem_column: str,
    row_group_rows: int = ROW_GROUP_ROWS,
    files: int | None = None,
    tiebreak: str | None = None,
) -> str:
    """Write ``df`` sorted by ecosystem with small zstd row groups.

    Rows are ranged by the ecosystem and then by ``tiebreak``, or by their place
    in the input when none is given, so one dominant ecosystem spreads over several
    files that still follow each other in order. Null ecosystems come last. Fails
    when the column is missing.
    """
    if ecosystem_column not in df.columns:
        raise ValueError(lacks_column(ecosystem_column, df.columns))
    place = F.col(tiebreak) if tiebreak else F.monotonically_increasing_id()
    placed = df.withColumn("_place", place)
    order = [F.col(ecosystem_column).asc_nulls_last(), F.col("_place").asc_nulls_last()]
    ranged = placed.repartitionByRange(files, *order) if files else placed.repartitionByRange(*order)
    (
        ranged.sortWithinPartitions(*order)
        .drop("_place")
        .write.mode("errorifexists")
        .option("compression", "zstd")
        .option("parquet.block.row.count.limit", row_group_rows)
        .parquet(path)
    )
    return path


def write_filtered_copy(
    df: DataFrame, path: str, column: str, row_group_rows: int = ROW_GROUP_ROWS, distinct: int | None = None
) -> str:
    """Write ``df`` as it lies, with a Bloom filter on ``column`` in every row group.

    For tables that stay in order of arrival: a reader of one value skips the row groups
    whose filter, or dictionary, does not hold it, though their ranges do. ``distinct`` is
    the number of values to expect in a row group, at most its rows. Fails when the column
    is missing.
    """
    if column not in df.columns:
        raise ValueError(lacks_column(column, df.columns))
    (
        df.write.mode("errorifexists").option("compression", "zstd")
        .option("parquet.block.row.count.limit", row_group_rows)
        .option(f"parquet.bloom.filter.enabled#{column}", "true")
        .option(f"parquet.bloom.filter.expected.ndv#{column}", distinct or row_group_rows)
        .parquet(path)
    )
    return path


def write_cells(cells: DataFrame, path: str) -> str:
    """Write the cell table, sorted by class so that one class reads few row groups."""
    order = ["code", "grid_row", "grid_col"]
    (
        cells.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .write.mode("errorifexists").option("compression", "zstd")
        .option("parquet.block.row.count.limit", CELL_GROUP_ROWS).parquet(path)
    )
    return path


def cells_of_class(spark: SparkSession, path: str, code: str) -> DataFrame:
    """The cells of one class from a stored cell table; row groups of others are skipped."""
    return spark.read.parquet(path).where(F.col("code") == code)


def cells_cached(
    spark: SparkSession, features: DataFrame, path: str | None, size: float = CELL_METRES
) -> DataFrame:
    """The cell table at ``path`` when one is given, else computed from the map."""
    if path:
        return spark.read.parquet(path)
    return map_cells(without_copies(features), size)


def write_index(index: DataFrame, path: str) -> str:
    """Write the class index as CSV with a header, in index order.

    Range-partitioned rather than gathered into one file: reading the folder in
    name order gives the whole index in order.
    """
    (
        index.select("index", "code", "name")
        .repartitionByRange("index")
        .sortWithinPartitions("index")
        .write.mode("errorifexists").options(**_CSV, emptyValue='""').csv(path)
    )
    return path


def read_index(spark: SparkSession, path: str) -> DataFrame:
    """Read a class index; codes stay strings even when they look like numbers."""
    return spark.read.schema(INDEX_SCHEMA).options(**_CSV, emptyValue="", multiLine=True).csv(path)
