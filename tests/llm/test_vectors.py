import numpy as np
import pytest

from ecoledger.llm import components, hnsw, multiprobe

SCHEMA = "vec_id bigint, embedding array<double>, label int, dim int, key string"


def rows_of(x, ids, labels):
    return [(int(i), [float(v) for v in r], None if lab is None else int(lab), 1, "k") for i, r, lab in zip(ids, x, labels)]


BAD = [
    (9001, None, 1, 1, "k"), (9002, [0.0] * 8, 1, 1, "k"), (9003, [None] + [1.0] * 7, 1, 1, "k"),
    (9004, [float("nan")] + [1.0] * 7, 1, 1, "k"), (9005, [float("inf")] + [1.0] * 7, 1, 1, "k"), (9006, [], 1, 1, "k"),
]


def brute_links(rows, least):
    fit = [r for r in rows if r[1] and r[2] is not None and all(v is not None and np.isfinite(v) for v in r[1]) and any(r[1])]
    n_links, parent = {r[0]: 0 for r in rows}, {r[0]: r[0] for r in rows}

    def root(a):
        while parent[a] != a:
            a = parent[a]
        return a

    for k, a in enumerate(fit):
        for b in fit[:k]:
            if a[2] == b[2] and len(a[1]) == len(b[1]):
                x, y = np.array(a[1]), np.array(b[1])
                if x @ y / np.linalg.norm(x) / np.linalg.norm(y) >= least:
                    n_links[a[0]] += 1
                    n_links[b[0]] += 1
                    p, q = root(a[0]), root(b[0])
                    parent[max(p, q)] = min(p, q)
    return {i: (n_links[i], root(i), root(i) == i) for i in n_links}


def test_components_are_the_smallest_reachable(spark):
    rng = np.random.default_rng(2)
    pairs = [(int(a), int(b)) for a, b in rng.integers(0, 300, (200, 2))] + [(k, k + 1) for k in range(400, 460)] + [(7, 7)]
    parent = {}

    def root(a):
        parent.setdefault(a, a)
        while parent[a] != a:
            a = parent[a]
        return a

    for a, b in pairs:
        if a != b:
            p, q = root(a), root(b)
            parent[max(p, q)] = min(p, q)
    got = dict(map(tuple, components.components(spark.createDataFrame(pairs, "a bigint, b bigint")).collect()))
    assert got == {k: root(k) for k in parent}
    assert components.components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


@pytest.mark.parametrize("shard_rows", [10_000, 60])
def test_near_vectors_equal_brute_force(spark, shard_rows):
    rng = np.random.default_rng(3)
    centres = rng.standard_normal((40, 8))
    x = np.concatenate([centres[rng.integers(0, 40, 360)] + 0.12 * rng.standard_normal((360, 8)), rng.standard_normal((100, 8))])
    x[50:80], x[200] = x[50], x[201] * 1e200
    ids = rng.permutation(2000)[: len(x)]
    rows = rows_of(x, ids, [None if k % 97 == 0 else k % 2 for k in range(len(x))]) + BAD + [(9100, [1.0] * 4, 1, 1, "k"), (9101, [1.0] * 4, 1, 1, "k")]
    df = spark.createDataFrame(rows, SCHEMA)
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in hnsw.near_vectors(df, 0.93, shard_rows=shard_rows).collect()}
    with np.errstate(over="ignore"):
        want = brute_links([(i, v if v is None or 201 and i != ids[200] else list(np.array(v) / 1e200), lab) for i, v, lab, *_ in rows], 0.93)
    assert got == want


def test_large_equal_group_is_never_paired(spark):
    rows = rows_of(np.ones((3000, 8)), range(3000), [1] * 3000)
    got = hnsw.near_vectors(spark.createDataFrame(rows, SCHEMA), 0.93).collect()
    assert {(r.n_links, r.component_id) for r in got} == {(2999, 0)} and sum(r.kept for r in got) == 1
    assert hnsw.near_vectors(spark.createDataFrame(rows, SCHEMA).limit(0), 0.93).count() == 0


def test_beam_widens_past_a_full_beam():
    rng = np.random.default_rng(4)
    x = np.concatenate([np.ones((400, 8)) + 0.01 * rng.standard_normal((400, 8)), rng.standard_normal((300, 8))])
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    graph = hnsw.Graph.build(x)
    width = graph.width_that_finds_all(0.93)
    found = set()
    for r, c in graph.neighbours(graph.x, np.arange(len(x)), 0.93, width):
        found |= set(zip(r.tolist(), c.tolist()))
    truth = graph.x @ graph.x.T >= 0.93
    assert found == set(zip(*(a.tolist() for a in np.nonzero(truth))))


def test_links_leave_a_task_as_counts_and_a_forest():
    rng = np.random.default_rng(8)
    for shape in ((60, 60), (40, 25)):
        linked = rng.random(shape) < 0.03
        one = shape[0] == shape[1]
        if one:
            linked |= linked.T
            np.fill_diagonal(linked, False)
        sides = [hnsw.LinkBits(*shape)] + ([] if one else [hnsw.LinkBits(*shape[::-1])])
        sides[0].add(*np.nonzero(linked))
        if not one:
            sides[1].add(*np.nonzero(linked.T))
        n = shape[0] if one else sum(shape)
        full = linked if one else np.block([[np.zeros((40, 40), bool), linked], [linked.T, np.zeros((25, 25), bool)]])
        weights = rng.integers(1, 5, n)
        counts, parents, children = hnsw.counts_and_forest(sides, [0, shape[0]][: len(sides)], weights)
        assert counts.tolist() == (full @ weights).tolist() and full[parents, children].all()
        reach = lambda m: np.linalg.matrix_power(np.eye(n) + m, n) > 0
        tree = np.zeros((n, n), bool)
        tree[parents, children] = tree[children, parents] = True
        assert len(parents) == len(set(children.tolist())) and (reach(tree) == reach(full)).all()


def test_tight_group_gives_no_pair_rows(spark):
    rng = np.random.default_rng(9)
    x = np.ones((500, 8)) + 0.01 * rng.standard_normal((500, 8))
    got = hnsw.near_vectors(spark.createDataFrame(rows_of(x, range(500), [1] * 500), SCHEMA), 0.93, shard_rows=200).collect()
    assert {(r.n_links, r.component_id) for r in got} == {(499, 0)}


def test_perturbations_come_in_order_and_once():
    sets = multiprobe.perturbations(4, 60)
    assert sets[0] == () and len(set(sets)) == len(sets)
    assert all(7 - w not in s for s in sets for w in s)
    assert len(multiprobe.perturbations(2, 1000)) == 9  # every way to step down, stay or step up


@pytest.mark.parametrize("shard_rows", [10_000, 150])
def test_nearest_finds_most_neighbours(spark, shard_rows):
    rng = np.random.default_rng(5)
    x = rng.standard_normal((600, 8)) * rng.random((600, 1))
    x[100:140] = x[100]
    rows = rows_of(x, range(600), [1] * 600) + BAD + [(None, [1.0] * 8, 1, 1, "k")]
    df = spark.createDataFrame(rows, SCHEMA)
    got = {}
    for r in multiprobe.nearest(df, df.where("vec_id % 20 = 0"), 20, shard_rows=shard_rows, query_block=10).collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    assert sorted(got) == list(range(0, 600, 20))
    hits = 0
    for q, found in got.items():
        found.sort()
        scores = x @ x[q]
        assert [r for r, _, _ in found] == list(range(1, 21)) and q not in {v for _, v, _ in found}
        assert all(abs(s - scores[v]) < 1e-12 for _, v, s in found)
        assert [(-s, v) for _, v, s in found] == sorted((-s, v) for _, v, s in found)
        scores[q] = -np.inf
        hits += len({v for _, v, _ in found} & set(np.lexsort((np.arange(600), -scores))[:20].tolist()))
    assert hits >= 0.9 * 20 * len(got)


def test_few_or_no_candidates(spark):
    df = spark.createDataFrame(rows_of(np.eye(3, 8) + 1, range(3), [1] * 3), SCHEMA)
    assert multiprobe.nearest(df, df, 20).count() == 6
    assert multiprobe.nearest(df.limit(0), df, 20).count() == 0 == multiprobe.nearest(df, df.limit(0), 20).count()


@pytest.mark.parametrize("shard_rows", [10_000, 40])
def test_repeated_query_ids_leave_out_one_row_of_their_own(spark, shard_rows):
    rng = np.random.default_rng(6)
    x = rng.standard_normal((130, 8))
    ids = np.arange(130)
    ids[100:110] = 20  # other vectors of the id
    x[110:115], ids[110:115] = x[40], 40  # equal rows
    rows = rows_of(x, ids, [1] * 130)
    df = spark.createDataFrame(rows, SCHEMA)
    got = {}
    for r in multiprobe.nearest(df, df.where("vec_id % 20 = 0"), 20, shard_rows=shard_rows, query_block=5).collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id, round(r.score, 9)))
    asked = [k for k in range(110) if ids[k] % 20 == 0] + [k for k in range(115, 130) if ids[k] % 20 == 0]
    want = {}
    for q in asked:
        scores = x @ x[q]
        others = [k for k in np.lexsort((ids, -scores)) if k != q][:20]
        want.setdefault(int(ids[q]), []).extend((n + 1, int(ids[k]), round(float(scores[k]), 9)) for n, k in enumerate(others))
    assert set(got) == set(want) and {len(v) for v in want.values()} == {20, 220}
    for q, found in got.items():
        assert len(found) == len(want[q]) and len(set(found) & set(want[q])) >= 0.85 * len(set(want[q]))
        if q not in (20, 40):
            assert q not in {v for _, v, _ in found}
    assert sum(v == 40 for _, v, _ in got[40]) == 5  # five others equal it


def test_audit_sees_rare_links_that_the_graph_misses():
    rng = np.random.default_rng(7)
    x = rng.normal(size=(1500, 32))
    x[1400] = x[17] + 0.02 * rng.normal(size=32)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    graph = hnsw.Graph.build(x)
    a, b = (int(np.flatnonzero(graph.order == k)[0]) for k in (17, 1400))
    # a graph that leads to neither of the two: only comparing all rows finds their link
    for links in graph.layers:
        links[np.isin(links, [a, b])] = -1
    for q, own in ((None, True), (None, False), (x[[17, 3, 5]].astype(np.float32), False)):
        width = graph.width_that_finds_all(0.93, own=own, q=q)
        asked = graph.x if q is None else q
        start = np.arange(len(asked)) if own else None
        found = {(int(r), int(c)) for block in graph.neighbours(asked, start, 0.93, width) for r, c in zip(*block)}
        assert {(a, b), (b, a)} <= found if q is None else {(0, a), (0, b)} <= found
    assert hnsw.Graph.build(x[:900]).width_that_finds_all(0.93, own=True) == hnsw.QUERY_BEAM
