"""Parquet footers and object listings as tables."""

from __future__ import annotations

import json
from collections.abc import Iterator

import pandas as pd
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Codes of systems whose coordinates are degrees of longitude and latitude.
LONLAT_CODES = ("OGC:CRS84", "EPSG:4326", "EPSG:4979", "EPSG:4269", "EPSG:4258")

_CHUNK_SCHEMA = (
    "path string, row_group int, group_rows bigint, column string, uncompressed bigint, "
    "has_range boolean, steps_back boolean, low string, high string, geo_primary string, problem string"
)
_NAMES = [f.split()[0] for f in _CHUNK_SCHEMA.split(", ")]


def object_listing(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """(path, length) of the objects below ``path``; contents are never read."""
    return (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", pattern)
        .option("recursiveFileLookup", True)
        .load(path)
        .select("path", "length")
    )


def _open_footer(path: str) -> pq.FileMetaData:
    local = path.removeprefix("file:")
    if "://" in path:
        filesystem, inner = fs.FileSystem.from_uri(path)
    else:
        filesystem, inner = fs.LocalFileSystem(), "/" + local.lstrip("/")
    with filesystem.open_input_file(inner) as handle:
        return pq.ParquetFile(handle).metadata


def _primary_column(meta: pq.FileMetaData) -> str | None:
    """The geometry column that the file's own geo metadata names, if it names one."""
    try:
        described = json.loads((meta.metadata or {}).get(b"geo", b"{}"))
    except ValueError:
        return None
    named = described.get("primary_column") if isinstance(described, dict) else None
    return named if isinstance(named, str) else None


def _system_name(meta: pq.FileMetaData, column: str | None) -> tuple[bool, str | None]:
    """Whether the coordinates of a geometry column are lon/lat, and the name of their system.

    A column that names no system is in lon/lat, as the file format lays down; one whose
    system is given as null is not known to be.
    """
    try:
        described = json.loads((meta.metadata or {}).get(b"geo", b"{}"))
        columns = described.get("columns", {})
        told = columns.get(column, {}) if isinstance(columns, dict) else {}
    except (ValueError, AttributeError):
        return True, None
    if not isinstance(told, dict) or "crs" not in told:
        return True, None
    crs = told["crs"]
    if not isinstance(crs, dict):
        return False, "unknown" if crs is None else str(crs)[:100]
    named = crs.get("id") if isinstance(crs.get("id"), dict) else {}
    code = f"{named.get('authority')}:{named.get('code')}"
    name = crs.get("name") or (code if named else "unnamed")
    return crs.get("type") == "GeographicCRS" or code in LONLAT_CODES, str(name)


def map_metadata(paths: DataFrame) -> DataFrame:
    """(path, primary_column, lonlat, system, problem) from the footers of the files at ``path``."""

    def told(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for path in batch["path"]:
                try:
                    meta = _open_footer(path)
                except Exception as error:  # reported with the file, as in footer_chunks
                    rows.append((path, None, None, None, f"{type(error).__name__}: {error}"[:300]))
                    continue
                primary = _primary_column(meta)
                rows.append((path, primary, *_system_name(meta, primary or "geometry"), None))
            if rows:
                yield pd.DataFrame(rows, columns=["path", "primary_column", "lonlat", "system", "problem"], dtype=object)

    return _dealt(paths.select("path")).mapInPandas(
        told, "path string, primary_column string, lonlat boolean, system string, problem string"
    )


def _dealt(paths: DataFrame) -> DataFrame:
    """One small read per file: a fixed number of partitions, because by their bytes all paths would be one."""
    return paths.repartition(int(paths.sparkSession.conf.get("spark.sql.shuffle.partitions")), "path")


def _footer_rows(path: str, wanted: str | None) -> Iterator[dict]:
    """A row for each row group and column; one row with the problem if there is none.

    Ranges are compared as typed values, so decimals, dates and 64-bit numbers keep their
    order: ``steps_back`` says that a group begins below the end of the group before it.
    """
    try:
        meta = _open_footer(path)
    except Exception as error:  # any store, any format: the file is reported, not lost
        yield {"path": path, "problem": f"{type(error).__name__}: {error}"[:300]}
        return
    primary, end = _primary_column(meta), None
    if not meta.num_row_groups:
        yield {"path": path, "geo_primary": primary}
    for g in range(meta.num_row_groups):
        group = meta.row_group(g)
        for c in range(group.num_columns):
            chunk = group.column(c)
            row = {
                "path": path, "row_group": g, "group_rows": group.num_rows, "column": chunk.path_in_schema,
                "uncompressed": chunk.total_uncompressed_size, "geo_primary": primary,
            }
            if chunk.path_in_schema == wanted:
                stats = chunk.statistics
                row["has_range"] = bool(stats and stats.has_min_max)
                if row["has_range"]:
                    row |= {
                        "low": str(stats.min), "high": str(stats.max),
                        "steps_back": end is not None and stats.min < end,
                    }
                    end = stats.max
            yield row


def _read_footers(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        for path, wanted in zip(batch["path"], batch["wanted"]):
            rows = list(_footer_rows(path, wanted))
            # objects, so that numbers that are not known stay null and not NaN
            yield pd.DataFrame({n: pd.Series([r.get(n) for r in rows], dtype=object) for n in _NAMES})


def footer_chunks(paths: DataFrame, wanted: str | Column | None = None) -> DataFrame:
    """One row per (file, row group, column) from footers alone.

    ``paths`` has a column ``path``. Every file gives rows: one that cannot be read gives
    one row with the ``problem``, one without row groups a row without a group. Ranges
    are given for the column ``wanted`` of each file alone (a name, or a Column of names).
    """
    name = F.lit(wanted).cast("string") if wanted is None or isinstance(wanted, str) else wanted
    return _dealt(paths.select("path", name.alias("wanted"))).mapInPandas(_read_footers, _CHUNK_SCHEMA)


def footer_stats(chunks: DataFrame, ecosystem_column: str | Column) -> DataFrame:
    """Per file: row groups, rows, largest group, geometry column and bytes, sort order.

    Every file of ``chunks`` has a row; what its footer does not tell is null, and
    ``problem`` says why a footer could not be read. ``ranges_sorted`` is null when any
    range is unknown or the column is absent. ``ecosystem_column`` is a name, or a Column
    over ``chunks`` that gives each file's.
    """
    wanted = F.lit(ecosystem_column) if isinstance(ecosystem_column, str) else ecosystem_column
    per_column = chunks.where("column is not null").groupBy("path", "column").agg(
        F.sum("uncompressed").alias("bytes"), F.first("geo_primary").alias("geo_primary")
    )
    # the named primary column, else one called geometry, else the largest
    rank = (
        F.when(F.col("column") == F.col("geo_primary"), 3)
        .when(F.col("column") == "geometry", 2)
        .otherwise(1)
    )
    geometry = per_column.groupBy("path").agg(
        F.max(F.struct(rank.alias("rank"), "bytes", "column")).alias("_chosen")
    ).select(
        "path", F.col("_chosen.column").alias("geometry_column"),
        F.col("_chosen.bytes").alias("geometry_bytes"),
    )
    # null in a file without a footer, 0 in one without row groups
    read = F.col("problem").isNull()
    sizes = (
        chunks.groupBy("path", "row_group").agg(F.first("group_rows").alias("_rows"), F.max("problem").alias("problem"))
        .groupBy("path").agg(
            F.when(F.bool_and(read), F.count("row_group")).alias("num_row_groups"),
            F.when(F.bool_and(read), F.coalesce(F.sum("_rows"), F.lit(0))).alias("num_rows"),
            F.max("_rows").alias("max_rows_per_group"),
            F.max("problem").alias("problem"),
        )
    )
    order = chunks.where(F.col("column") == wanted).groupBy("path").agg(
        F.when(
            F.bool_and(F.coalesce("has_range", F.lit(False))), ~F.bool_or(F.coalesce("steps_back", F.lit(False)))
        ).alias("ranges_sorted")
    )
    return sizes.join(geometry, "path", "left").join(order, "path", "left")
