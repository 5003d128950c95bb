"""A training-data pipeline: stages over the documents table, each written and read again."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ecoledger.llm import icws, linechunks, mixing, packing, toxicity
from ecoledger.llm.common import read, word_count
from ecoledger.llm.queries import vocabulary
from ecoledger.session import scratch_path

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
# Pieces of text of a generation that a Python worker keeps; workers outlive their stage.
KEPT_PIECES = 50_000


def keeps_columns(stage: Stage) -> Stage:
    """The stage with all columns besides those of documents set aside in one, whatever their names."""

    @wraps(stage)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        others = [c for c in docs.columns if c not in COLUMNS]
        if not others:
            return stage(spark, docs, sf_dir)
        named = {c: F.col("`" + c.replace("`", "``") + "`") for c in docs.columns}
        aside = F.struct(*[named[c].alias(f"c{k}") for k, c in enumerate(others)]).alias("set_aside")
        out = stage(spark, docs.select(*[named[c] for c in docs.columns if c in COLUMNS], aside), sf_dir)
        place = {c: f"set_aside.c{k}" for k, c in enumerate(others)}
        return out.select(*[F.col(place.get(c, c)).alias(c) for c in docs.columns])

    return run_stage


@keeps_columns
def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the clause grammar, learned from the labels, does not call toxic."""
    model = toxicity.learn(docs, read(spark, sf_dir, "labels"))
    return toxicity.score(docs, model).where(F.col("toxicity") < toxicity.THRESHOLD).select(*docs.columns)


@keeps_columns
def drop_repeated_chunks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents; chunks of lines that stand earlier in the corpus are gone from their texts."""
    kept = linechunks.without_repeated_chunks(docs)
    return kept.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(*docs.columns)


@keeps_columns
def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicate texts, the one of the smallest id."""
    return icws.one_of_each(docs)


@keeps_columns
def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Whole copies of documents, so many that sources come near the weights 1, 2, 3 in turn.

    A document is there as often as the mix takes it, rounded; repeats are rows of their own.
    """
    mixed = mixing.mix(docs.withColumn("size", word_count(F.col("text"))))
    times = F.round(F.col("taken") / F.col("size")).cast("int")
    return mixed.where(F.col("taken") * 2 >= F.col("size")).where("size > 0").withColumn(
        "_copy", F.explode(F.array_repeat(F.lit(1), times))
    ).select(*docs.columns)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces of all documents, packed into sequences of at most 2048."""
    pieces = packing.token_pieces(docs, vocabulary("word_bpe_49k.json"), end_id=0, capacity=2048, kept=KEPT_PIECES)
    return packing.pack(pieces, capacity=2048).select(
        "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"
    )


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", reject_toxic),
    ("line_dedup", drop_repeated_chunks),
    ("minhash", drop_near_duplicates),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]

# Tokenizers and learned scores are beyond SQL; tests hold each stage to a plain version.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table; each result is written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
