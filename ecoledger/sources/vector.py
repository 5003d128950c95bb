"""Reading ecosystem maps: Parquet, GeoJSON and WKB geometry."""

from __future__ import annotations

from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ecoledger.functions.once import once, pinned
from ecoledger.functions.text import lacks_column, names_raster
from ecoledger.session import BROADCAST_ROWS
from ecoledger.sources import wkb
from ecoledger.sources.footers import map_metadata, object_listing
from ecoledger.sources.jsonsplit import array_objects

GEOMETRY_TYPE = "array<array<array<array<double>>>>"
_GEOMETRY = T.ArrayType(T.ArrayType(T.ArrayType(T.ArrayType(T.DoubleType()))))


@dataclass(frozen=True)
class MapSource:
    """Where a map lies and which of its columns play which role."""

    data: str
    name_column: str | None = None
    code_column: str | None = None
    group_column: str | None = None
    optimized_data: str | None = None
    cell_table: str | None = None
    geometry_column: str | None = None

    @property
    def key_column(self) -> str:
        """The column that identifies ecosystems: the code, else the name."""
        key = self.code_column or self.name_column
        if key is None:
            raise ValueError("a map source needs a code column or a name column")
        return key

    @property
    def preferred(self) -> str:
        """The sorted copy when there is one, else the raw map."""
        return self.optimized_data or self.data


def vector_address(address: str) -> str:
    """The address unchanged; raises for a raster."""
    if names_raster(address):
        raise ValueError(f"polygons cannot be read from pixels: {address}; give rasters as the map's ``cog_url``")
    return address


def _role_columns(df: DataFrame, source: MapSource) -> list[Column]:
    """code, name and fg as strings; a missing optional column gives nulls."""
    if source.key_column not in df.columns:
        raise ValueError(lacks_column(source.key_column, df.columns))

    def role(column: str | None, alias: str) -> Column:
        found = column is not None and column in df.columns
        value = F.col(f"`{column}`") if found else F.lit(None)
        return value.cast("string").alias(alias)

    return [
        role(source.key_column, "code"),
        role(source.name_column, "name"),
        role(source.group_column, "fg"),
    ]


def has_groups(df: DataFrame, source: MapSource) -> bool:
    """True when a functional-group column is both configured and present."""
    return source.group_column is not None and source.group_column in df.columns


def missing_group_note(df: DataFrame, source: MapSource) -> str | None:
    """What to tell the reader when a configured group column is not in the data."""
    if source.group_column is None or has_groups(df, source):
        return None
    return (
        f"functional-group column {source.group_column!r} not found, typology left out "
        f"(columns: {', '.join(df.columns)})"
    )


# Rows of one file stay below 2**40, files below 2**23.
_ROW_BITS = 40


def _file_key(path: Column) -> Column:
    """File address with one spelling of its scheme; listings and scans differ there."""
    return F.regexp_replace(path, "^([^:/]+):/+", "$1:/")


def _numbered(df: DataFrame) -> DataFrame:
    """Add ``src_ordinal``: position in file order, files by path.

    A BIGINT stays small in shuffles and keeps aggregates on it hash-based. The
    file ranks come from the listing the driver already holds, and are broadcast
    while it is short.
    """
    files = sorted(df.inputFiles())
    ranks = df.sparkSession.createDataFrame(
        [(path, n) for n, path in enumerate(files)], "_file string, _rank bigint"
    ).withColumn("_file", _file_key(F.col("_file")))
    if len(files) <= BROADCAST_ROWS:
        ranks = F.broadcast(ranks)
    placed = df.select(
        "*", _file_key(F.col("_metadata.file_path")).alias("_file"),
        F.col("_metadata.row_index").alias("_row"),
    ).join(ranks, "_file", "left")
    rank = F.coalesce("_rank", F.raise_error(F.concat(F.lit("file not listed: "), "_file")).cast("bigint"))
    return placed.withColumn(
        "src_ordinal", F.shiftleft(rank, _ROW_BITS) + F.col("_row")
    ).drop("_file", "_row", "_rank")


def described(spark: SparkSession, source: MapSource) -> MapSource:
    """The source with its geometry column named, as the files themselves describe it.

    Footers are read by tasks, a row a file, before any scan is planned. Unless the source
    names the column, it is the primary column of the files' metadata, or ``geometry``
    where they name none. Files that are not in longitude and latitude are refused by name,
    and so are files that disagree on the column. A footer that cannot be read tells nothing.
    """
    address = vector_address(source.preferred)
    files = object_listing(spark, address).select("path")
    told = map_metadata(files).where("problem is null")
    # a row for each column and system, not for each file
    ways = told.groupBy("primary_column", "lonlat", "system").agg(F.min("path").alias("path")).collect()
    for way in ways:
        if way.lonlat is False:
            raise ValueError(f"{way.path}: coordinates are in {way.system}, not in longitude and latitude; reproject the map first")
    columns = sorted({way.primary_column for way in ways if way.primary_column})
    if source.geometry_column:
        return source
    if len(columns) > 1:
        raise ValueError(f"{address}: files disagree on the geometry column: {', '.join(columns)}")
    return replace(source, geometry_column=columns[0] if columns else "geometry")


def load_map(spark: SparkSession, source: MapSource) -> DataFrame:
    """(fid, code, name, fg, src_ordinal, geometry) of a Parquet map.

    The geometry may be nested coordinates or WKB (binary), which is decoded. Its column
    and its reference system come from the files' own metadata, see ``described``.
    """
    source = described(spark, source)
    raw = spark.read.parquet(vector_address(source.preferred))
    kept = _numbered(raw).select(
        F.col("src_ordinal").alias("fid"), *_role_columns(raw, source), "src_ordinal",
        F.col(source.geometry_column).alias("geometry"),
    )
    if dict(raw.dtypes)[source.geometry_column] == "binary":
        return decode_wkb(kept)
    return kept


def load_attributes(spark: SparkSession, source: MapSource) -> DataFrame:
    """(code, name, fg, src_ordinal) only: the scan never reads geometry."""
    raw = spark.read.parquet(vector_address(source.preferred))
    return _numbered(raw).select(*_role_columns(raw, source), "src_ordinal")


def one_class(features: DataFrame, code: str) -> DataFrame:
    """Features of one ecosystem; on a sorted copy the filter skips row groups."""
    return features.where(F.col("code") == code)


def coordinates(kind: Column, text: Column) -> Column:
    """Nested coordinates of a Polygon or MultiPolygon given as JSON text."""
    multi = F.from_json(text, GEOMETRY_TYPE)
    single = F.from_json(text, "array<array<array<double>>>")
    return F.when(kind == "MultiPolygon", multi).when(kind == "Polygon", F.array(single))


_FEATURE = "type string, properties map<string,string>, geometry struct<type:string,coordinates:string>, _bad string"


def _parsed(features_text: DataFrame) -> DataFrame:
    """Feature rows with (properties, geometry, reason): each text parsed once, coordinates by their kind."""

    def shaped(f: Column) -> Column:
        kind, text = f["geometry"]["type"], f["geometry"]["coordinates"]

        def told(geometry: Column) -> Column:
            broken = F.exists(geometry, lambda part: part.isNull() | F.exists(part, lambda r: r.isNull()))
            reason = (
                F.when(f.isNull() | f["_bad"].isNotNull(), "not a JSON feature")
                .when(f["geometry"].isNull() | kind.isNull(), "no geometry")
                .when(~kind.isin("Polygon", "MultiPolygon"), F.concat(F.lit("unsupported geometry type "), kind))
                .when(geometry.isNull() | broken, "coordinates cannot be read")
            )
            return F.struct(f["properties"].alias("properties"), geometry.alias("geometry"), reason.alias("reason"))

        return once(coordinates(kind, text), told)

    feature = F.from_json("value", _FEATURE, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad"})
    return features_text.select("fid", "src_ordinal", pinned(once(feature, shaped)).alias("_f")).select(
        "fid", "src_ordinal", "_f", F.col("_f.geometry").alias("geometry"), F.col("_f.reason").alias("reason")
    )


def _feature_role(column: str | None, alias: str) -> Column:
    value = F.try_element_at("_f.properties", F.lit(column)) if column else F.lit(None)
    return value.cast("string").alias(alias)


def geojson_rejects(features_text: DataFrame, source: MapSource) -> DataFrame:
    """(fid, code, src_ordinal, reason): features that give no polygon, each with its reason."""
    return _parsed(features_text).where("reason is not null").select(
        "fid", _feature_role(source.key_column, "code"), "src_ordinal", "reason"
    )


def geojson_features(features_text: DataFrame, source: MapSource, strict: bool = True) -> DataFrame:
    """Features of GeoJSON text, one feature object per row (column ``value``).

    ``src_ordinal`` and ``fid`` must already number the rows. A feature without a usable
    polygon fails the job; unless ``strict`` it is left out, and ``geojson_rejects`` lists it.
    """
    parsed = _parsed(features_text)
    if strict:
        told = F.concat(F.lit("feature "), F.col("src_ordinal").cast("string"), F.lit(": "), F.col("reason"))
        # part of the geometry column, so that it is evaluated wherever geometry is used
        parsed = parsed.withColumn(
            "geometry", F.when(F.col("reason").isNull(), F.col("geometry")).otherwise(F.raise_error(told).cast(GEOMETRY_TYPE))
        )
    else:
        parsed = parsed.where("reason is null")
    return parsed.select(
        "fid",
        _feature_role(source.key_column, "code"), _feature_role(source.name_column, "name"),
        _feature_role(source.group_column, "fg"),
        "src_ordinal", "geometry",
    )


def geojson_text(spark: SparkSession, source: MapSource, lines: bool = False, split: bool = False) -> DataFrame:
    """(fid, src_ordinal, value): the features of GeoJSON files as text.

    A feature collection is one JSON document and so one task per file, unless ``split`` is
    set: then many tasks read one collection (``jsonsplit.array_objects``; the objects of all
    top-level arrays are taken as features). Files with one feature per line are read with
    ``lines``. Features are identified by their ordinal.
    """
    path = vector_address(source.preferred)
    if split:
        return array_objects(spark, path).select(
            F.struct("file", "block", "at").alias("fid"), F.struct("file", "block", "at").alias("src_ordinal"), "value"
        )
    if lines:
        # a task reads a block front to back, so this order is the order in the file
        rows = spark.read.text(path).select(
            F.struct(
                F.col("_metadata.file_path").alias("file"),
                F.col("_metadata.file_block_start").alias("block"),
                F.monotonically_increasing_id().alias("row"),
            ).alias("src_ordinal"),
            "value",
        ).where(F.trim("value") != "")
    else:
        documents = spark.read.schema("features array<string>").option("multiLine", True).json(path)
        exploded = documents.select(
            F.col("_metadata.file_path").alias("file"), F.posexplode("features").alias("pos", "value")
        )
        rows = exploded.select(
            F.struct("file", F.col("pos").cast("bigint").alias("row")).alias("src_ordinal"), "value"
        )
    return rows.select(F.col("src_ordinal").alias("fid"), "src_ordinal", "value")


def load_geojson(
    spark: SparkSession, source: MapSource, lines: bool = False, strict: bool = True, split: bool = False
) -> DataFrame:
    """Features of GeoJSON files; see ``geojson_text`` and ``geojson_features``."""
    return geojson_features(geojson_text(spark, source, lines, split), source, strict)


def _parse_wkb(data: bytes) -> list[list[np.ndarray]]:
    """Parts of one WKB polygon or multipolygon, as rings of (n, 2) coordinates."""
    (parts,) = wkb.decode(pa.array([data], pa.binary())).to_pylist()
    return [[np.array(ring, float).reshape(-1, 2) for ring in part] for part in parts]


@F.arrow_udf(T.BinaryType())
def _encode(geometry: pa.Array) -> pa.Array:
    return wkb.encode(geometry)


def encode_wkb(geometry: Column) -> Column:
    """Nested coordinates as WKB, the geometry form of GeoParquet files."""
    return _encode(geometry)


@F.arrow_udf(_GEOMETRY)
def _decode(values: pa.Array) -> pa.Array:
    return wkb.decode(values)


def decode_wkb(features: DataFrame, column: str = "geometry") -> DataFrame:
    """Replace a WKB column by nested coordinates, in Arrow batches."""
    return features.withColumn(column, _decode(F.col(column)))
