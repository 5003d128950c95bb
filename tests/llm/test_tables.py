import random
import re

import pytest
from pyspark.sql import functions as F

from ecoledger.llm import mixing, resharding
from ecoledger.llm.common import word_count


def test_word_count(spark):
    texts = ["", " ", "a", " a b\n", "a\x0b\x0cb", None, "\x1cx", "a b", "é  f\t"]
    got = [r[0] for r in spark.createDataFrame([(t,) for t in texts], "t string").select(word_count(F.col("t"))).collect()]
    assert got == [len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) for t in texts]


def water_fill(sizes, weights):
    capped = [False] * len(sizes)
    while True:
        rest = sum(sizes) - sum(3 * s for s, c in zip(sizes, capped) if c)
        open_weight = sum(w for w, c in zip(weights, capped) if not c)
        got = [3.0 * s if c else rest * w / open_weight for s, w, c in zip(sizes, weights, capped)]
        now = [c or g > 3 * s for c, g, s in zip(capped, got, sizes)]
        if now == capped:
            return got
        capped = now


def test_mix_meets_its_targets(spark):
    rng = random.Random(1)
    rows = [(k, rng.choice(["b", "a", "ä", "B", None, "hot", "hot", "hot"]), int(rng.paretovariate(1) * 20)) for k in range(3000)]
    rows += [(7000, "tiny", 3), (7001, "empty", 0), (None, "a", 50), (None, "a", 50), (5, "b", 40), (5, "b", 40)]
    docs = spark.createDataFrame(rows, "doc_id bigint, source string, size long").withColumns({"level": F.lit(1), "mean": F.lit(2), "target": F.lit("x")})
    got = mixing.mix(docs).collect()
    assert len(got) == len(rows) and all(0 <= r.taken <= 3 * r["size"] for r in got)
    names = sorted({r[1] for r in rows if r[1] is not None}) + [None]
    sizes = [sum(r[2] for r in rows if r[1] == n) for n in names]
    want = dict(zip(names, water_fill(sizes, [1 + k % 3 for k in range(len(names))])))
    for n, s in zip(names, sizes):
        mine = [r for r in got if r.source == n]
        assert {r.source_size for r in mine} == {s}
        assert all(r.target == pytest.approx(want[n]) for r in mine)
        assert abs(sum(r.taken for r in mine) - want[n]) <= 3
    assert sorted(map(repr, got)) == sorted(map(repr, mixing.mix(docs.repartition(7)).collect()))
    plan = mixing.mix(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "CartesianProduct" not in plan


def test_longer_documents_are_drawn_more_often(spark):
    docs = spark.range(20_000).selectExpr("id AS doc_id", "if(id % 10 = 0, 'few', 'many') AS source", "if(id % 3 = 0, 900L, 30L) AS size")
    rows = mixing.mix(docs).where("source = 'many'").groupBy("size").agg(F.avg(F.col("taken") / F.col("size")).alias("rate")).collect()
    rate = {r["size"]: r.rate for r in rows}
    assert rate[900] > 1.2 * rate[30] > 0


def test_mix_of_nothing(spark):
    empty = spark.createDataFrame([], "doc_id bigint, source string, size long")
    assert mixing.mix(empty).count() == 0
    zero = spark.createDataFrame([(1, "a", 0), (2, None, 0)], "doc_id bigint, source string, size long")
    assert [r.taken for r in mixing.mix(zero).collect()] == [0, 0]


def test_flow_moves_the_fewest_bytes():
    rng = random.Random(2)
    for _ in range(40):
        sizes = [rng.randrange(50) for _ in range(rng.randrange(1, 5))]
        capacities = resharding.even_capacities(sum(sizes), rng.randrange(1, 6))
        flow = resharding.least_cost_flow(sizes, capacities)
        assert [sum(f) for f in flow] == sizes
        assert [sum(f[j] for f in flow) for j in range(len(capacities))] == capacities
        stay = sum(min(s, c) for s, c in zip(sizes, capacities))
        assert sum(flow[i][i] for i in range(min(len(sizes), len(capacities)))) == stay
    assert resharding.least_cost_flow([4, 4], [4, 4], [[5, 1], [1, 9]]) == [[0, 4], [4, 0]]
    # the cheapest first path has to be taken back
    assert resharding.least_cost_flow([1, 1], [1, 1], [[1, 2], [1, 5]]) == [[0, 1], [1, 0]]
    with pytest.raises(ValueError):
        resharding.least_cost_flow([5], [4])


def reshard(spark, docs, folder):
    keyed = resharding.keyed(docs)
    rows = keyed.select(
        "_id", "_th", (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("long").alias("size"),
        F.pmod("_th", F.lit(12)).cast("int").alias("old_shard"), F.col("_th").alias("group"),
    )
    placed = resharding.place(rows, shards=16)
    files, same = resharding.rewrite(docs, placed, folder)
    return placed, files.unionByName(same)


def test_shards_are_even_and_whole(spark, make_docs, tmp_path):
    rng = random.Random(3)
    texts = ["copy of one text " * 3] * 700 + ["x" * rng.randrange(400) for _ in range(1300)] + [None, ""]
    docs = make_docs(*enumerate(texts), (None, "no id"), (5, texts[5]), (5, "other"), shard="99", slot="1", moved="2", old_shard="3")
    placed, files = reshard(spark, docs.drop("shard", "slot", "moved", "old_shard"), str(tmp_path / "s"))
    rows = files.collect()
    assert sorted((r.doc_id or -1, r.text or "") for r in rows) == sorted((r.doc_id or -1, r.text or "") for r in docs.collect())
    by = {}
    for r in rows:
        by.setdefault(r.shard, []).append((r.slot, len(r.text or "") + 1))
    assert set(by) == set(range(16)) and all(sorted(s for s, _ in v) == list(range(len(v))) for v in by.values())
    sizes = [sum(n for _, n in v) for v in by.values()]
    assert max(sizes) <= 1.03 * sum(sizes) / 16 and min(sizes) >= 0.97 * sum(sizes) / 16


def test_unaffected_shards_keep_their_files(spark, make_docs, tmp_path):
    docs = make_docs(*[(k, f"text {k:04d}") for k in range(400)])
    keyed = resharding.keyed(docs).withColumn("old_shard", (F.col("doc_id") % 4).cast("int"))
    rows = keyed.select("_id", "_th", F.lit(10).cast("long").alias("size"), "old_shard", F.col("_th").alias("group"))
    placed = resharding.place(rows, capacities=[1000, 1000, 500, 1000, 500])
    files, same = resharding.rewrite(docs, placed, str(tmp_path / "s"))
    assert {r.shard for r in files.select("shard").distinct().collect()} == {2, 4}
    assert {r.shard for r in same.select("shard").distinct().collect()} == {0, 1, 3}
    moved = placed.where("moved").count()
    assert 45 <= moved <= 55


def test_no_rows_no_shards(spark, make_docs):
    keyed = resharding.keyed(make_docs((1, "x")).limit(0))
    rows = keyed.selectExpr("_id", "_th", "1L AS size", "0 AS old_shard", "_th AS group")
    assert resharding.place(rows).count() == 0
