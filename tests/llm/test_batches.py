"""Whole texts reach Python workers in batches of few bytes, whatever the rows are."""

from collections.abc import Iterator

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from ecoledger.llm import icws, packing, toxicity

KEY = "spark.sql.execution.arrow.maxBytesPerBatch"
STEPS = {
    "toxicity": lambda docs: toxicity.score(docs, toxicity.Model({})),
    "minhash": icws.near_texts,
    "packing": lambda docs: packing.token_pieces(docs, corpus_pipeline.vocabulary("word_bpe_49k.json"), 0, 2048),
}


@pytest.fixture
def no_limit(spark):
    before = spark.conf.get(KEY, None)
    spark.conf.unset(KEY)
    yield
    spark.conf.unset(KEY) if before is None else spark.conf.set(KEY, before)


@pytest.mark.parametrize("step", sorted(STEPS))
def test_batches_of_whole_texts_are_small(spark, make_docs, no_limit, step):
    """Before, a batch held 10,000 rows or 64 MB: here all 16 MB of a task at once."""
    STEPS[step](make_docs((1, "a b c"), (2, "a b c")))

    def sizes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_pydict({"size": [b.nbytes], "n": [b.num_rows]})

    def size(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for t in texts:
            yield pa.array([t.nbytes] * len(t), pa.int64())

    docs = spark.range(0, 160, 1, 1).selectExpr("id AS doc_id", "repeat('word ', 20000) AS text")
    rows = docs.mapInArrow(sizes, "size long, n long").collect()
    assert sum(r.n for r in rows) == 160 and max(r.size for r in rows) < 5_000_000
    assert docs.select(F.arrow_udf(size, "long")("text").alias("size")).agg(F.max("size")).first()[0] < 5_000_000


@pytest.mark.parametrize("step", sorted(STEPS))
def test_a_limit_of_the_session_stays(spark, make_docs, no_limit, step):
    spark.conf.set(KEY, "9m")
    STEPS[step](make_docs((1, "a b c")))
    assert spark.conf.get(KEY) == "9m"


def test_a_text_above_the_limit_is_a_batch_of_its_own(spark, make_docs, no_limit):
    spark.conf.set(KEY, "1k")
    long, docs = "one two three four " * 500, [(k, f"{k} five six") for k in range(20)]
    got = STEPS["packing"](make_docs(*docs, (20, long), (21, long), (22, None))).collect()
    spark.conf.unset(KEY)
    want = STEPS["packing"](make_docs(*docs, (20, long), (21, long), (22, None))).collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, want)) and {r.doc_id for r in got} == set(range(23))
