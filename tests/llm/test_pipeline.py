import os

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
import corpus_pipeline
from ecoledger.llm import icws, linechunks, mixing, packing, toxicity
from ecoledger.llm.common import read, word_count
from ecoledger.llm.oracles import llm_oracles
from ecoledger.llm.queries import llm_queries, vocabulary

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="needs the driver's tables")

COLUMNS = {
    "op1_pareto_mix": {"doc_id", "size", "source_size", "target", "taken"},
    "op2_toxicity": {"doc_id", "held_out", "score", "predicted"},
    "op3_repeated_passages": {"doc_id", "n_words", "n_removed", "kept_sha256"},
    "op4_near_vectors": {"vec_id", "n_links", "component_id", "kept"},
    "op5_line_chunks": {"doc_id", "lines_removed", "chunks_removed", "kept_sha256"},
    "op6_minhash_groups": {"doc_id", "component_id", "kept"},
    "op7_token_files": {"doc_id", "start", "n_tokens", "ids_crc32"},
    "op8_packed_sequences": {"doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"},
    "op9_flow_shards": {"doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard", "old_shard"},
    "op10_multiprobe": {"query_id", "rank", "vec_id", "score", "probes"},
    "op11_licence_scan": {"doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"},
    "op12_spelling_variants": {"word", "form", "root", "n", "n_near", "form_n"},
    "op13_fill_middle": {"doc_id", "n", "form", "prefix_chars", "middle_chars", "output_sha256", "restored_sha256"},
}


def test_every_operator_is_registered():
    assert set(COLUMNS) == set(llm_queries()) <= set(contract.queries())
    assert "pipeline" in contract.queries() and len(corpus_pipeline.STAGES) == 5


@pytest.mark.parametrize("name", sorted(COLUMNS))
def test_queries_give_a_row_for_everything(spark, name):
    df = llm_queries()[name](spark, SF)
    assert set(df.columns) == COLUMNS[name]
    rows = df.count()
    if name == "op10_multiprobe":
        assert rows == 25 * 20
    elif name == "op4_near_vectors":
        assert rows == 500
    elif name == "op12_spelling_variants":
        assert rows > 200
    elif name != "op8_packed_sequences":
        assert rows == 200


@pytest.mark.parametrize("name", sorted(llm_oracles()))
def test_queries_equal_their_twins(spark, name):
    duck = duckdb.connect()
    for t in ("documents", "embeddings"):
        duck.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    want = duck.execute(llm_oracles()[name])
    columns = [d[0] for d in want.description]
    got = llm_queries()[name](spark, SF).select(*columns).collect()
    assert sorted(map(tuple, got), key=repr) == sorted(want.fetchall(), key=repr)


def test_stages_take_effect(spark, tmp_path):
    docs = read(spark, SF, "documents")
    seen = {"start": docs}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF)
        if name != "packing":
            assert out.dtypes == docs.dtypes
        out.write.parquet(str(tmp_path / name))
        docs = seen[name] = spark.read.parquet(str(tmp_path / name))
    ids = {n: {r[0] for r in d.select("doc_id").collect()} for n, d in seen.items()}

    model = toxicity.learn(seen["start"], read(spark, SF, "labels"))
    scored = toxicity.score(seen["start"], model)
    assert ids["toxicity"] == {r.doc_id for r in scored.where("toxicity < 0.7").collect()}
    bad = {r.doc_id for r in read(spark, SF, "labels").where("toxic = 1").collect()}
    clean = {r.doc_id for r in read(spark, SF, "labels").where("toxic = 0").collect()}
    assert clean <= ids["toxicity"] and len(bad & ids["toxicity"]) <= len(bad) / 2

    assert ids["line_dedup"] == ids["toxicity"]
    assert linechunks.repeated_chunks(seen["line_dedup"]).count() <= linechunks.repeated_chunks(seen["toxicity"]).count()
    wrong = seen["line_dedup"].where(F.length("text") != F.col("n_chars"))
    assert wrong.count() == 0

    groups = icws.near_texts(seen["line_dedup"]).collect()
    assert ids["minhash"] == {r.doc_id for r in groups if r.kept}

    mixed = mixing.mix(seen["minhash"].withColumn("size", word_count(F.col("text")))).collect()
    times = {r.doc_id: int(r.taken / r["size"] + 0.5) if r["size"] else 0 for r in mixed}
    got = {r.doc_id: r["count"] for r in seen["mixing"].groupBy("doc_id").count().collect()}
    assert got == {k: n for k, n in times.items() if n}

    pieces = packing.token_pieces(seen["mixing"], vocabulary("word_bpe_49k.json"), 0, 2048)
    assert seen["packing"].count() == pieces.count()
    assert seen["packing"].groupBy("sequence_id").agg(F.sum("length").alias("n")).where("n > 2048").count() == 0


def test_other_columns_pass_every_stage_unchanged(spark, tmp_path):
    names = ["size", "taken", "target", "source_size", "toxicity", "lines_removed", "chunks_removed", "_x", "_gone", "a.b", "a`b", "set_aside"]
    docs = read(spark, SF, "documents")
    docs = docs.select("*", *[F.concat(F.lit(f"{n} "), F.col("doc_id").cast("string")).alias(n) for n in names])
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.dtypes == docs.dtypes
        out.write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        rows = docs.collect()
        assert rows and all(r[n] == f"{n} {r.doc_id}" for r in rows for n in names)
    assert corpus_pipeline.STAGES[-1][1](spark, docs, SF).count() > 0
