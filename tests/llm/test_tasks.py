"""Small tables are worked on in few tasks, however many partitions a shuffle has."""

import random
import uuid

import pytest

import corpus_pipeline
from ecoledger.llm import components, icws

PARTITIONS = 24


@pytest.fixture
def tasks_of(spark):
    """How many tasks a function starts, with ``PARTITIONS`` partitions after every shuffle."""

    def count(run):
        context, group = spark.sparkContext, uuid.uuid4().hex
        context.setJobGroup(group, "counted")
        run()
        jobs = context.statusTracker().getJobIdsForGroup(group)
        stages = {s for j in jobs for s in context.statusTracker().getJobInfo(j).stageIds}
        return sum(i.numCompletedTasks for i in map(context.statusTracker().getStageInfo, stages) if i)

    held = {"spark.sql.shuffle.partitions": str(PARTITIONS), "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in held}
    for k, v in held.items():
        spark.conf.set(k, v)
    yield count
    for k, v in before.items():
        spark.conf.set(k, v)
    for k in ("spark.jobGroup.id", "spark.job.description"):
        spark.sparkContext.setLocalProperty(k, None)


def test_rounds_over_few_links_take_few_tasks(spark, tasks_of):
    """A path takes the most rounds; before, each round took about 15 times the partitions of a shuffle."""
    links = spark.createDataFrame([(k, k + 1) for k in range(64)], "a bigint, b bigint")
    seen = {}
    taken = tasks_of(lambda: seen.update(map(tuple, components.components(links).collect())))
    assert seen == dict.fromkeys(range(65), 0)
    assert taken <= 20 * PARTITIONS


def test_rounds_over_many_links_give_the_same(spark, monkeypatch):
    """Links that are not broadcast and lie in many tasks."""
    monkeypatch.setattr(components, "BROADCAST_ROWS", 0)
    monkeypatch.setattr(components, "LINKS_READ", 5)
    links = spark.createDataFrame([(k, k + 1) for k in range(40)] + [(100, 200 + k) for k in range(30)] + [(7, None), (9, 9)], "a bigint, b bigint")
    want = dict.fromkeys(range(41), 0) | dict.fromkeys([100, *range(200, 230)], 100)
    assert dict(map(tuple, components.components(links).collect())) == want


def chain():
    """Texts that each differ in one word from the text before."""
    rng = random.Random(5)
    text, rows = [f"w{rng.randrange(5000)}" for _ in range(150)], []
    for k in range(120):
        text[rng.randrange(150)] = f"x{k}"
        rows.append((k, " ".join(text)))
    return rows


def test_near_texts_of_a_large_group_take_few_tasks(make_docs, tasks_of):
    """Linked by chains, so that one turn of leaders does not do."""
    seen = []
    taken = tasks_of(lambda: seen.extend(icws.near_texts(make_docs(*chain())).collect()))
    assert len(seen) == 120 and {r.component_id for r in seen} == {0}
    assert taken <= 100 * PARTITIONS


def test_near_duplicate_stage_takes_few_tasks(spark, make_docs, tasks_of):
    """The stage of the pipeline, with a row that stands twice."""
    rows = chain()
    docs, seen = make_docs(*rows, rows[0], (500, "no words of theirs")), []
    stage = dict(corpus_pipeline.STAGES)["minhash"]
    taken = tasks_of(lambda: seen.extend(stage(spark, docs, "").collect()))
    assert sorted(r.doc_id for r in seen) == [0, 500]
    assert taken <= 125 * PARTITIONS
