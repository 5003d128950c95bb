"""Is a map laid out well enough, and is the build likely to fit?"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ecoledger.functions.text import is_remote
from ecoledger.sources.layout import ROW_GROUP_ROWS

_GIB = 1024**3
_MIB = 1024**2

# Limits above which an uncached map is refused, the smallest
# useful number of row groups, and the geometry size from which it matters.
MAX_SIZE_GIB = 2.0
MAX_GEOMETRY_GIB = 1.0
MAX_FEATURES = 200_000
MIN_ROW_GROUPS = 3
ROW_GROUP_GEOMETRY_FLOOR = 512 * _MIB
LARGE_LOAD_BYTES = _GIB
LARGEST_GROUP_FLOOR = 50_000


def is_optimized(row_group_rows: int = ROW_GROUP_ROWS) -> Column:
    """True for footer rows of a sorted file with several small row groups."""
    limit = max(5 * row_group_rows, LARGEST_GROUP_FLOOR)
    return (
        F.coalesce(F.col("ranges_sorted"), F.lit(False))
        & F.coalesce(F.col("num_row_groups") >= 2, F.lit(False))
        & F.coalesce(F.col("max_rows_per_group") <= limit, F.lit(False))
    )


def layout_verdicts(stats: DataFrame, row_group_rows: int = ROW_GROUP_ROWS) -> DataFrame:
    """Add ``optimized``, ``refuse_load`` and ``refusal`` to footer stats with a ``path``.

    Loading is refused for a large remote file that is not optimized; the refusal
    says why and is null otherwise.
    """
    judged = stats.withColumn("optimized", is_optimized(row_group_rows))
    large = F.coalesce(F.col("geometry_bytes") >= LARGE_LOAD_BYTES, F.lit(False))
    refused = judged.withColumn(
        "refuse_load", ~F.col("optimized") & is_remote(F.col("path")) & large
    )
    why = F.concat(
        F.lit("large remote file that is not optimized: "), _gib(F.col("geometry_bytes")),
        F.lit(" geometry in "), F.col("num_row_groups").cast("string"),
        F.lit(" row groups; write a sorted copy first"),
    )
    return refused.withColumn("refusal", F.when(F.col("refuse_load"), why))


def _gib(value: Column) -> Column:
    return F.format_string("%.1f GB", value / _GIB)


def readiness(
    sources: DataFrame,
    max_size_gib: float = MAX_SIZE_GIB,
    max_geometry_gib: float = MAX_GEOMETRY_GIB,
    max_features: int = MAX_FEATURES,
) -> DataFrame:
    """Add ``ok`` and ``reasons`` to rows describing map sources.

    Needs n_configured and n_missing (caches configured, and those absent),
    size_bytes, geometry_bytes, num_rows and num_row_groups; unknown values are
    null and never count against a source. Configured caches alone decide when
    there are any.
    """
    geometry, rows = F.col("geometry_bytes"), F.col("num_rows")
    groups, size = F.col("num_row_groups"), F.col("size_bytes")
    heavy = F.array_compact(
        F.array(
            F.when(
                geometry >= max_geometry_gib * _GIB,
                F.concat(F.lit("geometry is "), _gib(geometry), F.lit(" uncompressed")),
            ),
            F.when(rows >= max_features, F.concat(F.format_number(rows, 0), F.lit(" features"))),
            F.when(
                (groups < MIN_ROW_GROUPS) & (geometry >= ROW_GROUP_GEOMETRY_FLOOR),
                F.concat(F.lit("only "), groups.cast("string"), F.lit(" row groups")),
            ),
        )
    )
    by_size = F.array_compact(
        F.array(
            F.when(
                geometry.isNull() & (size >= max_size_gib * _GIB), F.concat(F.lit("file is "), _gib(size))
            )
        )
    )
    absent = F.array_compact(
        F.array(
            F.when(
                F.col("n_missing") > 0,
                F.concat(F.col("n_missing").cast("string"), F.lit(" configured caches do not exist")),
            )
        )
    )
    return sources.withColumn(
        "reasons",
        F.when(F.col("n_configured") > 0, absent)
        .when(F.size(heavy) > 0, heavy)
        .otherwise(by_size),
    ).withColumn("ok", F.size("reasons") == 0)


def configured_caches(sources: DataFrame, listing: DataFrame) -> DataFrame:
    """Count configured and missing caches per source (key ``source``).

    ``sources`` has optimized_data and aoo_grid_cache_url, null where unset;
    ``listing`` has the ``path`` of every existing object.
    """
    named = sources.select(
        "source", F.explode(F.array("optimized_data", "aoo_grid_cache_url")).alias("path")
    ).where("path is not null and path <> ''")
    found = named.join(listing.select("path", F.lit(1).alias("_there")).distinct(), "path", "left")
    counts = found.groupBy("source").agg(
        F.count("*").alias("n_configured"), F.count_if(F.col("_there").isNull()).alias("n_missing")
    )
    return sources.join(counts, "source", "left").fillna(0, ["n_configured", "n_missing"])
