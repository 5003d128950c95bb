"""A sink for content that is addressed by its hash.

Each row of (digest, ext, body) becomes the file ``digest.ext`` below a folder, with the
exact bytes of the body. What is there already is not written again. A file appears under
its name only when it is whole: tasks write to names of their own attempt and move them,
so a repeated, speculative or lost task leaves no half file, and two that write the same
content write the same bytes.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage
from pyspark.sql.types import StructType

SINK = "content_assets"
_COLUMNS = ("digest", "ext", "body")


@dataclass
class _Done(WriterCommitMessage):
    """What one task did: files written, and files that were there."""

    written: int = 0
    present: int = 0


def store_of(address: str) -> tuple[fs.FileSystem, str]:
    """The file system of an address and the path in it."""
    if "://" in address:
        return fs.FileSystem.from_uri(address)
    return fs.LocalFileSystem(), "/" + address.removeprefix("file:").lstrip("/")


class AssetWriter(DataSourceArrowWriter):
    """Writes the assets of each task; names are listed once a task."""

    def __init__(self, folder: str, order: list[int]):
        self.folder, self.order = folder, order

    def write(self, batches: Iterator[pa.RecordBatch]) -> _Done:
        store, folder = store_of(self.folder)
        store.create_dir(folder, recursive=True)
        listed = store.get_file_info(fs.FileSelector(folder))
        there = {info.base_name for info in listed if info.is_file}
        done = _Done()
        for batch in batches:
            digests, exts, bodies = (batch.column(k).cast(pa.binary() if n == 2 else pa.string()) for n, k in enumerate(self.order))
            for digest, ext, body in zip(digests.to_pylist(), exts.to_pylist(), bodies):
                name = f"{digest}.{ext}"
                if name in there:
                    done.present += 1
                    continue
                part = f"{folder}/.{name}.{uuid.uuid4().hex}"
                with store.open_output_stream(part) as out:
                    out.write(body.as_buffer() if body.is_valid else b"")
                store.move(part, f"{folder}/{name}")
                there.add(name)
                done.written += 1
        return done

    def commit(self, messages: list[_Done | None]) -> None:
        """Nothing is left to do: whole files are in place."""

    def abort(self, messages: list[_Done | None]) -> None:
        """Files of tasks that ended stay; they are whole, and the next run skips them."""


class AssetSink(DataSource):
    """``df.write.format("content_assets").mode("append").save(folder)``"""

    @classmethod
    def name(cls) -> str:
        return SINK

    def writer(self, schema: StructType, overwrite: bool) -> AssetWriter:
        missing = [c for c in _COLUMNS if c not in schema.names]
        if missing:
            raise ValueError(f"assets need columns {', '.join(_COLUMNS)}; missing: {', '.join(missing)}")
        if overwrite:
            raise ValueError("content has no other version: append to the folder")
        return AssetWriter(self.options["path"], [schema.names.index(c) for c in _COLUMNS])


def write_assets(assets: DataFrame, folder: str) -> str:
    """Store (digest, ext, body) below ``folder``; other columns are left out."""
    assets.sparkSession.dataSource.register(AssetSink)
    assets.select(*_COLUMNS).write.format(SINK).mode("append").save(folder)
    return folder


def stored_assets(spark: SparkSession, folder: str) -> DataFrame:
    """(digest, ext, body) of the assets below ``folder``, as bytes."""
    files = spark.read.format("binaryFile").load(folder)
    return files.selectExpr(
        "substring_index(substring_index(path, '/', -1), '.', 1) AS digest",
        "substring_index(path, '.', -1) AS ext", "content AS body",
    )
