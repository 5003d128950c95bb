"""Registered queries of the training-data operators, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ecoledger.llm import (
    fillmiddle, hnsw, icws, licences, linechunks, mixing, multiprobe, packing, resharding, spelling, substrings,
    tokenfiles, toxicity,
)
from ecoledger.llm.common import read, word_count
from ecoledger.session import scratch_path

OLD_SHARDS = 12


def vocabulary(name: str) -> str:
    """Place of a public vocabulary file."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_pareto_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that a mix of all sources to the weights 1, 2, 3 takes of each document."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "source", word_count(F.col("text")).alias("size"))
    return mixing.mix(docs).select("doc_id", "size", "source_size", "target", "taken")


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document by the clause grammar."""
    docs = read(spark, sf_dir, "documents")
    model = toxicity.learn(docs, read(spark, sf_dir, "labels"))
    return toxicity.score(docs.select("doc_id", "text"), model).select(
        "doc_id", toxicity.held_out(F.col("doc_id")).alias("held_out"), F.col("toxicity").alias("score"),
        (F.col("toxicity") >= toxicity.THRESHOLD).cast("int").alias("predicted"),
    )


def op3_repeated_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What stays of every document without passages of 50 words that stand before."""
    return substrings.remove_repeats(read(spark, sf_dir, "documents")).drop("kept")


def op4_near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and groups of all embeddings at a cosine of 0.93 within a label."""
    return hnsw.near_vectors(read(spark, sf_dir, "embeddings"), 0.93)


def op5_line_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What stays of every document without repeated chunks of lines."""
    kept = linechunks.without_repeated_chunks(read(spark, sf_dir, "documents").select("doc_id", "text"))
    return kept.select("doc_id", "lines_removed", "chunks_removed", F.sha2("text", 256).alias("kept_sha256"))


def op6_minhash_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Group of near-duplicate texts of every document."""
    return icws.near_texts(read(spark, sf_dir, "documents"))


def op7_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every document, written, indexed by key and read back by key."""
    folder = scratch_path(spark, "token-files")
    docs = read(spark, sf_dir, "documents")
    manifest = tokenfiles.write_ids(docs, folder, vocabulary("byte_bpe_50k.json"), end_id=2)
    index = tokenfiles.write_index(manifest, folder)
    payloads = tokenfiles.read_ids(manifest, index)
    return tokenfiles.digests(payloads, manifest).drop("repeat")


def op8_packed_sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in sequences of at most 2048 tokens."""
    docs = read(spark, sf_dir, "documents")
    pieces = packing.token_pieces(docs, vocabulary("word_bpe_49k.json"), end_id=0, capacity=2048)
    return packing.pack(pieces, capacity=2048).select(
        "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"
    )


def op9_flow_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents moved from 12 shards by text hash to 16 shards of equal bytes.

    Shards that change are written, and their columns are read back from the files.
    """
    docs = read(spark, sf_dir, "documents")
    keyed = resharding.keyed(docs)
    rows = keyed.select(
        "_id", "_th", (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("long").alias("size"),
        F.pmod("_th", F.lit(OLD_SHARDS)).cast("int").alias("old_shard"), F.col("_th").alias("group"),
    )
    placed = resharding.place(rows, shards=16)
    files, same = resharding.rewrite(docs, placed, scratch_path(spark, "shards"))
    return files.unionByName(same).select(
        "doc_id", (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("long").alias("size"),
        F.crc32(F.coalesce("text", F.lit(""))).alias("text_crc32"), F.lit("bytes").alias("law"),
        F.col("shard").cast("int").alias("shard"), "slot", F.lit(None).cast("int").alias("grown_shard"), "old_shard",
    )


def op10_multiprobe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest of every vector whose id is divisible by 20."""
    vectors = read(spark, sf_dir, "embeddings")
    return multiprobe.nearest(vectors, vectors.where(F.col("vec_id") % 20 == 0), k=20)


def op11_licence_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence notices of every document by the positional index of rare words."""
    return licences.scan(read(spark, sf_dir, "documents"))


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every frequent word of the documents with the form it is a variant of."""
    return spelling.variants(spelling.word_counts(read(spark, sf_dir, "documents")))


def op13_fill_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document cut at lines and reordered, with digests of the output and of the text rebuilt from it."""
    cut = fillmiddle.transform(read(spark, sf_dir, "documents"))
    return cut.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"),
        F.sha2(fillmiddle.restored(F.col("output"), F.col("form")), 256).alias("restored_sha256"),
    )


def llm_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    """The registered queries of this subpackage by name."""
    found = (
        op1_pareto_mix, op2_toxicity, op3_repeated_passages, op4_near_vectors, op5_line_chunks, op6_minhash_groups,
        op7_token_files, op8_packed_sequences, op9_flow_shards, op10_multiprobe, op11_licence_scan,
        op12_spelling_variants, op13_fill_middle,
    )
    return {f.__name__: f for f in found}
