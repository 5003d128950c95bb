"""Approximate nearest neighbours by multiprobe p-stable hashing.

Largest inner products become smallest distances once every vector gets one more
component that brings it to a common length. Several tables hash the vectors by rounded
random projections (normal, hence 2-stable). A query visits its own bucket in each table
and then perturbed buckets in the order in which they are likely to hold a near vector:
the nearer the query lies to the walls that a perturbation crosses, the earlier. All
candidates of all tables are ranked by their exact inner product.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ecoledger.llm.common import groups_of
from ecoledger.llm.vectors import as_doubles, packed, unpacked, usable
from ecoledger.session import settle

SHARD_ROWS = 16_384
QUERY_BLOCK = 1_024
TABLES = 12
ROWS_PER_BUCKET = 8
FIRST_PROBES = 32
AUDITED = 32
RECALL = 0.95
MOST_TASKS = 20_000


def perturbations(functions: int, count: int) -> list[tuple[int, ...]]:
    """Sets of crossed walls in order of expected success, for ``functions`` projections.

    Walls are numbered by nearness, 0 to 2 * functions - 1; wall j and its opposite
    2 * functions - 1 - j belong to one projection, so no set holds both. The expected
    squared distance of the j-th nearest wall orders the sets.
    """
    m = functions
    near = [j * (j + 1) / (4 * (m + 1) * (m + 2)) for j in range(1, m + 1)]
    far = [1 - j / (m + 1) + j * (j + 1) / (4 * (m + 1) * (m + 2)) for j in range(m, 0, -1)]
    cost = near + far
    out: list[tuple[int, ...]] = [()]
    heap = [(cost[0], (0,))]
    while heap and len(out) < count:
        total, walls = heapq.heappop(heap)
        if all(2 * m - 1 - w not in walls for w in walls):
            out.append(walls)
        last = walls[-1]
        if last + 1 < 2 * m:
            heapq.heappush(heap, (total - cost[last] + cost[last + 1], (*walls[:-1], last + 1)))
            heapq.heappush(heap, (total + cost[last + 1], (*walls, last + 1)))
    return out


class Tables:
    """The hash tables of one shard."""

    def __init__(self, x: np.ndarray, longest: float, tables: int, seed: int):
        n, dim = x.shape
        scaled = x / longest
        rest = np.sqrt(np.maximum(0.0, 1.0 - np.einsum("ij,ij->i", scaled, scaled)))
        self.points = np.concatenate([scaled, rest[:, None]], axis=1).astype(np.float32)
        rng = np.random.default_rng(seed)
        # so many projections that a bucket holds a bounded number of rows at any shard size
        self.functions = max(2, int(np.ceil(np.log2(max(2, n / ROWS_PER_BUCKET)) / 1.5)))
        self.a = rng.standard_normal((tables, self.functions, dim + 1)).astype(np.float32)
        spread = np.concatenate([self.points @ a.T for a in self.a], axis=1).std(axis=0)
        # a bucket is as wide as the spread of its projection, times a constant
        self.width = np.maximum(1e-6, 1.6 * spread).reshape(tables, self.functions).astype(np.float32)
        self.shift = rng.random((tables, self.functions)).astype(np.float32)
        self.odd = rng.integers(1, 1 << 62, (tables, self.functions)).astype(np.int64) | 1
        self.sorted, self.rows = [], []
        for t in range(tables):
            with np.errstate(over="ignore"):
                keys = (np.floor(self._place(self.points, t)).astype(np.int64) * self.odd[t]).sum(axis=1)
            by = np.argsort(keys, kind="stable")
            self.sorted.append(keys[by])
            self.rows.append(by)

    def _place(self, x: np.ndarray, t: int) -> np.ndarray:
        return x @ self.a[t].T / self.width[t] + self.shift[t]

    def candidates(self, q: np.ndarray, probes: int) -> np.ndarray:
        """Which rows share a visited bucket with each query, as a mask."""
        size = np.sqrt(np.einsum("ij,ij->i", q, q))[:, None]
        points = np.concatenate([q / size, np.zeros((len(q), 1))], axis=1).astype(np.float32)
        mask = np.zeros((len(q), len(self.points)), bool)
        m = self.functions
        sets = perturbations(m, probes)
        crossed = np.zeros((2 * m, len(sets)), np.int64)
        for k, walls in enumerate(sets):
            crossed[list(walls), k] = 1
        for t in range(len(self.a)):
            place = self._place(points, t)
            low = np.floor(place)
            into = place - low
            # distances to the lower and to the upper wall of each projection
            walls = np.argsort(np.concatenate([into, 1 - into], axis=1), axis=1)
            with np.errstate(over="ignore"):
                home = (low.astype(np.int64) * self.odd[t]).sum(axis=1)
                step = np.where(walls < m, -1, 1) * self.odd[t][walls % m]
                for k in range(0, len(sets), 256):
                    keys = home[:, None] + step @ crossed[:, k : k + 256]
                    first = np.searchsorted(self.sorted[t], keys.ravel(), "left")
                    size = np.searchsorted(self.sorted[t], keys.ravel(), "right") - first
                    hit = np.flatnonzero(size)
                    size, first = size[hit], first[hit]
                    # every place from first to first + size of every bucket that is not empty
                    ends = np.cumsum(size)
                    spot = np.arange(ends[-1] if len(ends) else 0) + np.repeat(first - ends + size, size)
                    mask[np.repeat(hit // keys.shape[1], size), self.rows[t][spot]] = True
        return mask


def _top(ids: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
    """Positions of the ``k`` largest scores, ties to the smaller id."""
    if len(scores) > k:
        least = np.partition(scores, len(scores) - k)[len(scores) - k]
        some = np.flatnonzero(scores >= least)
    else:
        some = np.arange(len(scores))
    return some[np.lexsort((ids[some], -scores[some]))][:k]


def _exact(x: np.ndarray, q: np.ndarray) -> np.ndarray:
    # summed row by row in one order, so equal vectors get equal scores
    return np.einsum("ij,j->i", x, q)


def search_shard(
    ids: np.ndarray, x: np.ndarray, q_ids: np.ndarray, q: np.ndarray, longest: float, k: int,
    tables: int = TABLES, recall: float = RECALL, q_keys: np.ndarray | None = None,
) -> tuple[Iterator[pd.DataFrame], int]:
    """Frames (query_id, q_key, vec_id, score, own) with the ``k`` nearest found of each query, and the probes.

    Probes double until the audited queries find ``recall`` of their true neighbours in
    this shard; at the most every row is a candidate. Rows with the id and the vector of the
    query are found like others and have ``own`` true.
    """
    q_keys = np.zeros(len(q_ids), np.int64) if q_keys is None else q_keys
    index = Tables(x, longest, tables, len(ids))
    rows = np.unique(np.linspace(0, len(q) - 1, min(AUDITED, len(q))).astype(int))
    truth = [_top(ids, _exact(x, q[r]), k) for r in rows]
    probes, most = FIRST_PROBES, 3 ** index.functions
    while probes < most:
        mask = index.candidates(q[rows], probes)
        found = sum(int(mask[i, t].sum()) for i, t in enumerate(truth))
        if found >= recall * sum(len(t) for t in truth):
            break
        probes *= 2

    def frames() -> Iterator[pd.DataFrame]:
        for at in range(0, len(q), 256):
            block, block_ids = q[at : at + 256], q_ids[at : at + 256]
            mask = index.candidates(block, probes) if probes < most else np.ones((len(block), len(x)), bool)
            for i, query_id in enumerate(block_ids):
                some = np.flatnonzero(mask[i])
                scores = _exact(x[some], block[i])
                best = _top(ids[some], scores, k)
                found = some[best]
                own = (ids[found] == query_id) & (x[found] == block[i]).all(axis=1)
                yield pd.DataFrame(
                    {"query_id": query_id, "q_key": q_keys[at + i], "vec_id": ids[found], "score": scores[best], "own": own}
                )

    return frames(), probes


def nearest(
    vectors: DataFrame, queries: DataFrame, k: int = 20, id_name: str = "vec_id",
    shard_rows: int = SHARD_ROWS, query_block: int = QUERY_BLOCK,
) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` largest inner products of each query found.

    Both tables have (id, embedding); other columns are ignored. Vectors that are null, zero
    or not finite, and rows without an id, take no part; vectors meet only vectors of their
    length. One row of the query's own id and vector is no candidate; all others are, also
    those that share its id. Repeated ids are rows of their own, as candidates and as queries;
    queries equal in id and vector are one. Every query block visits every shard; a task holds
    one of each, and gives at most ``k`` + 1 rows a query, which are merged by rank.
    """

    def clean(df: DataFrame) -> DataFrame:
        rows = df.select(F.col(id_name).cast("long").alias("id"), as_doubles(F.col("embedding")).alias("vector"))
        return rows.where(usable(F.col("vector")) & F.col("id").isNotNull()).withColumn("dim", F.size("vector"))

    base, asked = clean(vectors), clean(queries).dropDuplicates(["id", "vector"])
    norm = F.sqrt(F.aggregate("vector", F.lit(0.0), lambda s, x: s + x * x))
    totals = {r["dim"]: r for r in base.groupBy("dim").agg(F.count("*").alias("n"), F.max(norm).alias("longest")).collect()}
    blocks = groups_of(asked.count(), query_block)
    # one entry for each length of vectors, in practice one
    shard_count = F.coalesce(*[F.when(F.col("dim") == d, groups_of(r["n"], shard_rows)) for d, r in totals.items()], F.lit(1))
    longest = {d: float(r["longest"]) * (1 + 1e-9) for d, r in totals.items()}
    # an id may repeat: rows of one id are dealt apart by their place
    placed = base.withColumn("shard", F.pmod(F.xxhash64("id", F.spark_partition_id()), shard_count).cast("int"))
    shards = settle(packed(placed, ["dim", "shard"], "id"))
    asked = asked.withColumn("q_key", F.xxhash64("vector"))
    asked = asked.withColumn("block", F.pmod(F.xxhash64("id", "q_key"), F.lit(blocks)).cast("int"))
    q = settle(packed(asked, ["dim", "block"], "id", "q_key"))

    def run(shard: pd.DataFrame, block: pd.DataFrame) -> pd.DataFrame:
        if not len(shard) or not len(block):
            return pd.DataFrame({"query_id": [], "q_key": [], "vec_id": [], "score": [], "own": [], "probes": []})
        row, asks = shard.iloc[0], block.iloc[0]
        ids, x = unpacked(row["ids"], row["vectors"], row["n"])
        q_ids, q_x = unpacked(asks["ids"], asks["vectors"], asks["n"])
        keys = np.frombuffer(asks["extra"], np.int64)
        found, probes = search_shard(ids, x, q_ids, q_x, longest[int(row["dim"])], k + 1, q_keys=keys)
        return pd.concat([*found]).assign(probes=probes)

    # a pair is much work in few bytes: without a number, small pairs would share a task
    tasks = max(1, min(MOST_TASKS, blocks * sum(groups_of(r["n"], shard_rows) for r in totals.values())))
    pair = ["dim", "shard", "block"]
    # each task that holds a shard or a block sends it to its partners; no key gathers them all
    every_block = F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block")
    every_shard = F.explode(F.sequence(F.lit(0), shard_count - 1)).alias("shard")
    left = shards.select("*", every_block).repartition(tasks, *pair).groupBy(*pair)
    right = q.select("*", every_shard).repartition(tasks, *pair).groupBy(*pair)
    found = left.cogroup(right).applyInPandas(
        run, "query_id long, q_key long, vec_id long, score double, own boolean, probes int"
    )
    one = ["query_id", "q_key"]
    order = Window.partitionBy(*one).orderBy(F.desc("score"), "vec_id", F.desc("own"))
    upto = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    # at most k + 1 rows a query and shard; of those equal to the query the first is the query
    return (
        found.withColumn("place", F.row_number().over(order)).where(F.col("place") <= k + 1)
        .withColumn("seen", F.sum(F.col("own").cast("int")).over(upto))
        .where(~F.col("own") | (F.col("seen") > 1))
        .withColumn("rank", (F.col("place") - F.least("seen", F.lit(1))).cast("int")).where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score", "probes")
    )
