"""String rules: natural order, source addresses, labels and page text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# File suffixes of rasters and the schemes that count as remote.
RASTER_SUFFIXES = (".tif", ".tiff")
REMOTE_SCHEMES = ("http://", "https://", "gs://", "s3://", "az://")
PUBLIC_BUCKET_HOST = "https://storage.googleapis.com/"


def natural_key(code: Column) -> Column:
    """Sort key that compares digit runs by value and ignores case.

    A digit run becomes a low marker, its length without leading zeros, and the
    digits: shorter runs are smaller numbers, equal lengths compare as text. The
    marker sorts below every printable character, so a number precedes any text
    that continues the same prefix.
    """
    runs = F.regexp_extract_all(F.lower(code), F.lit("([0-9]+|[^0-9]+)"), F.lit(1))

    def encode(run):
        digits = F.regexp_replace(run, "^0+(?=[0-9])", "")
        return F.when(
            run.rlike("^[0-9]+$"),
            F.concat(F.lit("\u0001"), F.lpad(F.length(digits).cast("string"), 10, "0"), digits),
        ).otherwise(run)

    return F.concat_ws("", F.transform(runs, encode))


def bare_address(url: Column) -> Column:
    """The address without its query string and trailing slashes."""
    return F.regexp_replace(F.substring_index(url, "?", 1), "/+$", "")


def is_raster(url: Column) -> Column:
    """True for addresses that end in a raster suffix, whatever their case."""
    path = F.lower(bare_address(url))
    hit = F.lit(False)
    for suffix in RASTER_SUFFIXES:
        hit = hit | F.endswith(path, F.lit(suffix))
    return hit


def names_raster(address: str) -> bool:
    """The rule of ``is_raster`` for one address on the driver."""
    bare = address.partition("?")[0].rstrip("/")
    return bare.lower().endswith(RASTER_SUFFIXES)


def lacks_column(column: str, columns: list[str]) -> str:
    """What to tell the reader of a map without a column that is needed."""
    return f"no column {column!r} in this map; columns: {', '.join(columns)}"


def is_parquet(url: Column) -> Column:
    return F.endswith(F.lower(bare_address(url)), F.lit(".parquet"))


def is_remote(url: Column) -> Column:
    """True for the remote schemes; the scheme itself is case-sensitive."""
    hit = F.lit(False)
    for scheme in REMOTE_SCHEMES:
        hit = hit | F.startswith(url, F.lit(scheme))
    return hit


def public_address(url: Column) -> Column:
    """Bucket addresses as public https; anything else unchanged."""
    return F.regexp_replace(url, "^gs://", PUBLIC_BUCKET_HOST)


def data_stem(url: Column) -> Column:
    """File name without its last suffix; ``ecosystems`` when nothing is left."""
    name = F.element_at(F.split(bare_address(url), "/"), -1)
    stem = F.regexp_replace(name, r"(?<=.)\.[^.]+$", "")
    return F.when(F.length(stem) > 0, stem).otherwise(F.lit("ecosystems"))


def cache_addresses(project: Column, url: Column, root: str = "gs://{project}-caches/") -> dict[str, Column]:
    """Where the sorted copy and the cell table of a source belong below ``root``."""
    before, after = root.split("{project}") if "{project}" in root else (root, None)
    place = F.lit(before) if after is None else F.concat(F.lit(before), project, F.lit(after))
    base = F.concat(place, data_stem(url))
    return {
        "optimized_data": F.concat(base, F.lit("_sorted.parquet")),
        "aoo_grid_cache_url": F.concat(base, F.lit("_aoo_grid.parquet")),
    }


def heading(index: Column, label: Column) -> Column:
    """``index · label``, or the bare label while no index is known."""
    return F.when(
        index.isNotNull(), F.concat(index.cast("string"), F.lit(" · "), label)
    ).otherwise(label)


def chapter_label(index: Column, code: Column, name: Column) -> Column:
    """Heading of ``code - name``; equal code and name are shown once."""
    base = F.when(code == name, name).otherwise(F.concat(code, F.lit(" - "), name))
    return heading(index, base)


def legend_label(code: Column, name: Column) -> Column:
    """``code — name``, or the code alone when there is no name."""
    return F.concat_ws(" — ", code, name)


def relative_prefix(page_path: Column) -> Column:
    """One ``../`` per folder between a page and the output root."""
    return F.repeat(F.lit("../"), F.size(F.split(page_path, "/")) - 1)


def record_hash(record: Column, shared: Column) -> Column:
    """SHA-256 of a record's text followed by the shared settings text."""
    return F.sha2(F.concat(record, shared).cast("binary"), 256)


def _literal(replacement: Column) -> Column:
    """Escape a value so a regular-expression replacement inserts it as it is."""
    return F.regexp_replace(replacement, r"([\\$])", r"\\$1")


def fill_template(
    template: Column,
    code: Column,
    name: Column,
    page_hash: Column,
    default_code: str,
    default_name: str,
) -> Column:
    """Point a page template at one ecosystem.

    Rewrites the ``ecosystem_code`` assignment (with the hash as a trailing
    comment unless it is null), the ``name (code)`` heading and the section
    title of the second page.
    """
    comment = F.coalesce(F.concat(F.lit("  # source-config sha256: "), page_hash), F.lit(""))
    assigned = F.concat(F.lit("$1'"), _literal(code), F.lit("'"), comment)
    text = F.regexp_replace(
        template, F.lit(r"""(?md)^(ecosystem_code\s*=\s*)['"].*['"]"""), assigned
    )
    text = F.replace(
        text,
        F.lit(f"{default_name} ({default_code})"),
        F.concat(name, F.lit(" ("), code, F.lit(")")),
    )
    return F.replace(
        text, F.lit(f"{default_code} Criterion B"), F.concat(code, F.lit(" Criterion B"))
    )


def metric_text(value: Column, decimals: int) -> Column:
    """Fixed decimals, or ``N/A`` for a missing metric."""
    shown = F.format_string(f"%.{decimals}f", value.cast("double"))
    # formatting a null gives text, so it has to be tested first
    return F.when(value.isNull(), F.lit("N/A")).otherwise(shown)
