"""Token id files with a minimal perfect hash index.

Data files hold the ids of documents one after another, nothing else, in ascending
doc_id order over the files. Index files map a document's key to its file, place and
length in constant time: a key's bucket names a displacement, which sends the key to
its own slot; the slot keeps a fingerprint, so that a foreign key is recognised.
"""

from __future__ import annotations

import json
import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ecoledger.llm.common import groups_of, texts_of
from ecoledger.llm.tokens import encoder
from ecoledger.session import settle

KEYS_PER_INDEX = 65_536
KEYS_PER_BUCKET = 4
_MAGIC = b"IDIX0001"
_MANIFEST = "doc_id long, repeat long, shard int, path string, at long, n_tokens long, width int"
_SLOT = np.dtype([("fingerprint", "<u4"), ("shard", "<i4"), ("at", "<i8"), ("n", "<i8")])


def _store(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path, as executors open it: local, hdfs, s3, gs."""
    if path.startswith("file:/") and not path.startswith("file://"):
        path = path[len("file:") :]
    return fs.FileSystem.from_uri(path)


def write_ids(docs: DataFrame, folder: str, vocabulary: str, end_id: int) -> DataFrame:
    """Write the data files; one row per document says where its ids are.

    Null and empty texts are the end id alone; null doc_ids come first; repeated doc_ids
    count up in ``repeat``. A task that is run again writes files of new names, and only
    those of the task that ended are in the result, which is settled.
    """

    kinds = {"shard": pa.int32(), "path": pa.string(), "width": pa.int32()}
    columns = ("doc_id", "repeat", "shard", "path", "at", "n_tokens", "width")
    schema = pa.schema([(c, kinds.get(c, pa.int64())) for c in columns])

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_of = encoder(vocabulary)
        end = np.array([end_id], ids_of.dtype).tobytes()
        width = np.dtype(ids_of.dtype).itemsize
        shard = TaskContext.get().partitionId()
        store, place = _store(folder)
        name = f"ids-{shard:06d}-{uuid.uuid4().hex[:12]}.bin"
        store.create_dir(place, recursive=True)
        at, last, repeat = 0, (), 0
        with store.open_output_stream(f"{place}/{name}") as out:
            for batch in batches:
                rows = []
                for key, text in zip(batch["doc_id"].to_pylist(), texts_of(batch["text"])):
                    repeat = repeat + 1 if last == (key,) else 0
                    last = (key,)
                    ids = ids_of.encode(text) + end
                    out.write(ids)
                    rows.append((key, repeat, shard, f"{folder}/{name}", at, len(ids) // width, width))
                    at += len(ids)
                if rows:
                    yield pa.RecordBatch.from_pydict(dict(zip(columns, zip(*rows))), schema=schema)

    ordered = (
        docs.select(F.col("doc_id").cast("long"), "text")
        .repartitionByRange("doc_id").sortWithinPartitions("doc_id")
    )
    return settle(ordered.mapInArrow(write, _MANIFEST))


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _slots(h: np.ndarray, displacement: np.ndarray, n: int) -> np.ndarray:
    return (_mix(h + displacement.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) % np.uint64(n)).astype(np.int64)


def perfect_hash(h1: np.ndarray, h2: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(displacement of each bucket, slot of each key): n keys take n slots.

    Large buckets look for a displacement first; a bucket of one key names its slot
    outright (as -1 - slot). The pairs (h1, h2) must differ.
    """
    n = len(h1)
    buckets = max(1, n // KEYS_PER_BUCKET)
    of = (h1 % np.uint64(buckets)).astype(np.int64)
    by = np.argsort(of, kind="stable")
    starts = np.searchsorted(of[by], np.arange(buckets + 1))
    sizes = np.diff(starts)
    found, slots, taken = np.zeros(buckets, np.int64), np.zeros(n, np.int64), np.zeros(n, bool)
    tries = np.arange(64)
    order = np.argsort(-sizes, kind="stable")
    for b in order[sizes[order] > 1]:
        keys = by[starts[b] : starts[b + 1]]
        h, base = h2[keys], 0
        while True:
            spots = _slots(h[None, :], (tries + base)[:, None], n)
            spread = np.sort(spots, axis=1)
            good = ~taken[spots].any(axis=1) & (np.diff(spread, axis=1) != 0).all(axis=1)
            if good.any():
                k = int(np.argmax(good))
                found[b], slots[keys] = base + k, spots[k]
                taken[spots[k]] = True
                break
            base += len(tries)
    alone = order[sizes[order] == 1]
    keys, spots = by[starts[alone]], np.flatnonzero(~taken)
    slots[keys], found[alone] = spots, -1 - spots
    return found, slots


def locate(h1: np.ndarray, h2: np.ndarray, displacement: np.ndarray, n: int) -> np.ndarray:
    """The slot of each key in an index of ``n`` keys."""
    d = displacement[(h1 % np.uint64(len(displacement))).astype(np.int64)]
    return np.where(d < 0, -1 - d, _slots(h2, np.maximum(d, 0), n))


def _fingerprint(h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
    return (_mix(h1 ^ (h2 >> np.uint64(7))) >> np.uint64(32)).astype("<u4")


def _unsigned(column: pd.Series) -> np.ndarray:
    return column.to_numpy(np.int64).view(np.uint64)


def _keyed(rows: DataFrame, parts: int) -> DataFrame:
    """Two hashes of the key (doc_id, repeat) and the index file that it belongs to."""
    return rows.withColumns(
        {
            "h1": F.xxhash64("doc_id", "repeat"), "h2": F.xxhash64("repeat", "doc_id", F.lit(7)),
            "index_part": F.pmod(F.xxhash64(F.lit(3), "doc_id", "repeat"), F.lit(parts)).cast("int"),
        }
    )


def write_index(manifest: DataFrame, folder: str) -> DataFrame:
    """Write index files of about KEYS_PER_INDEX keys each: (index_part, index_path, parts).

    A key hashes to one index file, so a lookup opens one file and reads one slot. The
    file also lists its data files. The result is settled.
    """
    parts = groups_of(manifest.count(), KEYS_PER_INDEX)

    def build(frame: pd.DataFrame) -> pd.DataFrame:
        part = int(frame["index_part"].iloc[0])
        h1, h2 = _unsigned(frame["h1"]), _unsigned(frame["h2"])
        displacement, slots = perfect_hash(h1, h2)
        table = np.zeros(len(frame), _SLOT)
        table["fingerprint"][slots] = _fingerprint(h1, h2)
        for field, column in (("shard", "shard"), ("at", "at"), ("n", "n_tokens")):
            table[field][slots] = frame[column].to_numpy()
        files = frame.drop_duplicates("shard")
        head = json.dumps(
            {
                "keys": len(frame), "buckets": len(displacement), "width": int(frame["width"].iloc[0]),
                "files": {int(s): p for s, p in zip(files["shard"], files["path"])},
            }
        ).encode()
        path = f"{folder}/index-{part:06d}-{uuid.uuid4().hex[:12]}.bin"
        store, place = _store(path)
        store.create_dir(place.rpartition("/")[0], recursive=True)
        with store.open_output_stream(place) as out:
            out.write(_MAGIC + struct.pack("<I", len(head)) + head)
            out.write(displacement.astype("<i8").tobytes() + table.tobytes())
        return pd.DataFrame({"index_part": [part], "index_path": [path], "parts": [parts]})

    keyed = _keyed(manifest, parts)
    return settle(keyed.groupBy("index_part").applyInPandas(build, "index_part int, index_path string, parts int"))


class Index:
    """One index file, opened for lookups."""

    def __init__(self, path: str):
        store, place = _store(path)
        with store.open_input_file(place) as f:
            raw = f.read()
        if raw[:8] != _MAGIC:
            raise ValueError(f"not an index file: {path}")
        size = struct.unpack_from("<I", raw, 8)[0]
        head = json.loads(raw[12 : 12 + size])
        self.width, self.files = head["width"], {int(k): v for k, v in head["files"].items()}
        self.displacement = np.frombuffer(raw, "<i8", head["buckets"], 12 + size)
        self.table = np.frombuffer(raw, _SLOT, head["keys"], 12 + size + 8 * head["buckets"])

    def find(self, h1: np.ndarray, h2: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(slot of each key, whether the stored fingerprint is the key's)."""
        slots = locate(h1, h2, self.displacement, len(self.table))
        return slots, self.table["fingerprint"][slots] == _fingerprint(h1, h2)


def read_ids(keys: DataFrame, index: DataFrame) -> DataFrame:
    """(doc_id, repeat, shard, at, n_tokens, width, ids): payloads looked up by key.

    ``keys`` has (doc_id, repeat). Unknown keys give no row, up to one chance in 2^32 a key.
    """
    first = index.first()
    out = "doc_id long, repeat long, shard int, at long, n_tokens long, width int, ids binary"
    parts = first["parts"] if first else 1

    def look_up(frame: pd.DataFrame) -> Iterator[pd.DataFrame]:
        opened = Index(frame["index_path"].iloc[0])
        slots, known = opened.find(_unsigned(frame["h1"]), _unsigned(frame["h2"]))
        frame = frame[known].assign(**{f: opened.table[f][slots[known]].astype("i8") for f in ("shard", "at", "n")})
        for shard, rows in frame.sort_values(["shard", "at"]).groupby("shard"):
            store, place = _store(opened.files[int(shard)])
            with store.open_input_file(place) as f:
                ids = [f.read_at(n * opened.width, at) for at, n in zip(rows["at"], rows["n"])]
            found = pd.DataFrame(
                {
                    "doc_id": rows["doc_id"].astype("Int64"), "repeat": rows["repeat"], "shard": rows["shard"],
                    "at": rows["at"], "n_tokens": rows["n"], "width": opened.width, "ids": ids,
                }
            )
            # payloads leave in slices, so that a group of long documents is not held twice
            yield from (found[k : k + 2000] for k in range(0, len(found), 2000))

    def per_part(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for _, rows in frame.groupby("index_path"):
                yield from look_up(rows)

    # one index file per group of keys; batches of a partition may hold several groups
    joined = _keyed(keys.select("doc_id", "repeat"), parts).join(index.drop("parts"), "index_part")
    return joined.sortWithinPartitions("index_part").mapInPandas(per_part, out)


def digests(payloads: DataFrame, manifest: DataFrame) -> DataFrame:
    """(doc_id, repeat, start, n_tokens, ids_crc32) from payloads that were read back.

    ``start`` counts the ids of all documents before, over all files.
    """

    def crc(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            sums = [
                zlib.crc32(np.frombuffer(ids, f"<u{width}").astype("<u4").tobytes())
                for ids, width in zip(b["ids"], b["width"])
            ]
            yield pd.DataFrame(
                {
                    "doc_id": b["doc_id"].astype("Int64"), "repeat": b["repeat"], "shard": b["shard"],
                    "within": b["at"] // b["width"], "n_tokens": b["n_tokens"], "ids_crc32": sums,
                }
            )

    sums = payloads.mapInPandas(crc, "doc_id long, repeat long, shard int, within long, n_tokens long, ids_crc32 long")
    earlier = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    bases = (
        # one row per data file
        manifest.groupBy("shard").agg(F.sum("n_tokens").alias("_n"))
        .select("shard", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_base"))
    )
    return sums.join(F.broadcast(bases), "shard").select(
        "doc_id", "repeat", (F.col("_base") + F.col("within")).alias("start"), "n_tokens", "ids_crc32"
    )
