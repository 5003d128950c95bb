"""Session set-up and the few helpers that touch cluster settings."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Rows up to which a settled table may be broadcast. Rows here are narrow
# (a few short columns), so this stays in the tens of megabytes.
BROADCAST_ROWS = 200_000

# Bytes of an Arrow batch that a task sends to its Python worker, where the session names
# no limit of its own; a longer row is a batch by itself. Both processes hold a batch.
BATCH_BYTES = "4m"
_BATCH_KEY = "spark.sql.execution.arrow.maxBytesPerBatch"


def get_session(app: str = "ecoledger", **conf) -> SparkSession:
    """A session with adaptive execution on; keyword names use ``__`` for dots."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def shared_root(spark: SparkSession) -> str:
    """The shared scratch folder named by ``spark.checkpoint.dir``.

    Only a local master may fall back to a temporary folder: on a cluster a
    machine-local path would be lost with its machine.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    return tempfile.mkdtemp(prefix="ecoledger-")


def scratch_path(spark: SparkSession, stem: str) -> str:
    """A fresh path below the shared folder."""
    return f"{_checkpoint_dir(spark)}/{stem}-{uuid.uuid4().hex[:12]}"


def _checkpoint_dir(spark: SparkSession) -> str:
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_root(spark))
    return spark.sparkContext.getCheckpointDir()


def settle(df: DataFrame) -> DataFrame:
    """Write ``df`` once to reliable storage and cut its lineage (runs a job)."""
    _checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def narrow_batches(df: DataFrame) -> DataFrame:
    """``df``, after its session was told to send rows to Python in batches of BATCH_BYTES.

    For steps that read whole texts. The setting stays, as plans are made later than
    this call; a limit that the session already names is left alone.
    """
    conf = df.sparkSession.conf
    if conf.get(_BATCH_KEY, None) is None:
        conf.set(_BATCH_KEY, BATCH_BYTES)
    return df


def broadcast_if_small(settled: DataFrame, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Hint a broadcast only when the settled table is known to be small.

    Past the limit the plain table is returned and the join stays a shuffle
    join, so the answer never depends on the size. Pass a settled table: the
    count then reads the checkpoint instead of running its plan again.
    """
    small = settled.limit(max_rows + 1).count() <= max_rows
    return F.broadcast(settled) if small else settled
