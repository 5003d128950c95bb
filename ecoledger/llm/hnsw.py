"""Near-duplicate vectors by hierarchical navigable small-world graphs, one per shard.

Vectors of one label are dealt into shards of bounded size; each shard becomes a layered
neighbour graph, and every shard of a label is searched for the neighbours of all vectors
of that label. Beams widen for a vector whose beam is full of neighbours, and for a whole
shard, or pair of shards, until an audit against brute force finds every link it has seen.
Rows that no path leads to are compared with every query. Found pairs are verified by cosine
in double precision. A task holds its links as bits and gives only how many links each
vector has and a spanning forest of them; components are the union of the forests.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ecoledger.llm.common import with_uid
from ecoledger.llm.components import components
from ecoledger.llm.vectors import as_doubles, packed, unit, unpacked, usable
from ecoledger.session import settle

SHARD_ROWS = 16_384
DEGREE = 12
BUILD_BEAM = 40
QUERY_BEAM = 32
# an audit goes on until it has seen so many true links, a row counting as a few at most
AUDITED_LINKS = 1_000
LINKS_A_ROW = 8
# or compared so many of its queries, and looked for so many planted neighbours
AUDITED_ROWS = 1_024
PLANTED = 256
# single precision of beams: they search a little below the threshold
ROUNDING = 1e-4
# how far below the threshold a widened beam still goes on from a row
SLACK = 0.1
MOST_TASKS = 20_000
_BATCH = 512
_VERIFIED = 100_000


class Graph:
    """Layered neighbour lists over unit vectors; rows are ordered by their top layer, high first."""

    def __init__(self, x: np.ndarray, layers: list[np.ndarray], order: np.ndarray):
        self.x, self.layers, self.order = x.astype(np.float32), layers, order

    def unreached(self) -> np.ndarray:
        """Rows that no path from the first row leads to in the lowest layer."""
        links, seen = self.layers[-1], np.zeros(len(self.x), bool)
        front = np.zeros(min(1, len(self.x)), np.int64)
        while len(front):
            seen[front] = True
            met = np.unique(links[front])
            front = met[(met >= 0) & ~seen[met]]
        return np.flatnonzero(~seen)

    @classmethod
    def build(cls, unit_rows: np.ndarray) -> Graph:
        n = len(unit_rows)
        top = np.floor(-np.log(1 - np.random.default_rng(n).random(n)) / math.log(DEGREE)).astype(int)
        order = np.argsort(-top, kind="stable")
        graph = cls(unit_rows[order], [], order)
        # layers are finished from the top; each is entered through those above it
        for level in range(int(top.max()), -1, -1):
            graph._add_layer(int((top >= level).sum()), DEGREE * (1 if level else 2))
        return graph

    def _add_layer(self, size: int, degree: int) -> None:
        links = np.full((size, degree), -1, np.int32)
        done = 0
        while done < size:
            # early batches are small: members of a batch see each other, but few others
            batch = np.arange(done, min(size, done + min(_BATCH, max(32, done))))
            q = self.x[batch]
            near = q @ q.T
            np.fill_diagonal(near, -np.inf)
            keep = min(len(batch) - 1, BUILD_BEAM)
            ids = np.zeros((len(batch), 0), np.int64)
            if keep:
                ids = batch[np.argpartition(-near, keep - 1, axis=1)[:, :keep]]
            if done:
                found, _ = self._beam(links, q, self._enter(q, done), BUILD_BEAM, done)
                ids = np.concatenate([ids, found], axis=1)
            if ids.shape[1]:
                links[batch] = self._select(batch, ids, degree)
                self._link_back(links, batch)
            done += len(batch)
        self.layers.append(links)

    def _enter(self, q: np.ndarray, known: int) -> np.ndarray:
        """A start for each query in the next layer down: descend from the first row."""
        at = np.zeros((len(q), 1), np.int64)
        for links in self.layers:
            found, sims = self._beam(links, q, at, 4, len(links))
            at = np.take_along_axis(found, sims.argmax(axis=1)[:, None], axis=1)
        return np.where(at < known, at, 0)

    def _beam(self, links: np.ndarray, q: np.ndarray, entry: np.ndarray, width: int, size: int):
        """The ``width`` best rows met from ``entry`` in one layer, and their similarities."""
        rows = np.arange(len(q))
        seen = np.zeros((len(q), size), bool)
        ids = np.full((len(q), width), -1, np.int64)
        sims = np.full((len(q), width), -np.inf, np.float32)
        open_ = np.zeros((len(q), width), bool)
        first = entry[:, :width]
        ids[:, : first.shape[1]], open_[:, : first.shape[1]] = first, True
        sims[:, : first.shape[1]] = np.einsum("rmd,rd->rm", self.x[first], q)
        seen[rows[:, None], first] = True
        while len(rows):
            best = np.where(open_[rows], sims[rows], -np.inf)
            pick = best.argmax(axis=1)
            going = best[np.arange(len(rows)), pick] > -np.inf
            rows, pick = rows[going], pick[going]
            if not len(rows):
                break
            open_[rows, pick] = False
            near = links[ids[rows, pick]]
            fresh = near >= 0
            near = np.where(fresh, near, 0)
            fresh &= ~seen[rows[:, None], near]
            r, c = np.nonzero(fresh)
            seen[rows[r], near[r, c]] = True
            new = np.full(near.shape, -np.inf, np.float32)
            new[r, c] = np.einsum("ed,ed->e", self.x[near[r, c]], q[rows[r]])
            all_sims = np.concatenate([sims[rows], new], axis=1)
            all_ids = np.concatenate([ids[rows], np.where(fresh, near, -1)], axis=1)
            all_open = np.concatenate([open_[rows], fresh], axis=1)
            top = np.argpartition(-all_sims, width - 1, axis=1)[:, :width]
            sims[rows], ids[rows] = np.take_along_axis(all_sims, top, 1), np.take_along_axis(all_ids, top, 1)
            open_[rows] = np.take_along_axis(all_open, top, 1)
        return ids, sims

    def _select(self, centres: np.ndarray, ids: np.ndarray, degree: int) -> np.ndarray:
        """Neighbours that are nearer to the centre than to a chosen one; the nearest others fill up."""
        out = np.full((len(centres), degree), -1, np.int32)
        for k in range(0, len(centres), 256):
            c, cand = centres[k : k + 256], ids[k : k + 256]
            sims = np.einsum("rmd,rd->rm", self.x[np.maximum(cand, 0)], self.x[c])
            sims[(cand < 0) | (cand == c[:, None])] = -np.inf
            by = np.argsort(-sims, axis=1, kind="stable")
            cand, sims = np.take_along_axis(cand, by, 1), np.take_along_axis(sims, by, 1)
            v = self.x[np.maximum(cand, 0)]
            among = v @ v.transpose(0, 2, 1)
            blocked = ~np.isfinite(sims)
            repeated = np.zeros_like(blocked)
            chosen = np.zeros_like(blocked)
            for j in range(cand.shape[1]):
                take = ~blocked[:, j] & ~repeated[:, j]
                chosen[:, j] = take
                blocked[:, j + 1 :] |= take[:, None] & (among[:, j, j + 1 :] > sims[:, j + 1 :])
                repeated[:, j + 1 :] |= cand[:, j + 1 :] == cand[:, j : j + 1]
            rank = np.where(repeated | ~np.isfinite(sims), 2, np.where(chosen, 0, 1))
            pick = np.argsort(rank, axis=1, kind="stable")[:, :degree]
            got = np.where(np.take_along_axis(rank, pick, 1) == 2, -1, np.take_along_axis(cand, pick, 1))
            out[k : k + 256, : got.shape[1]] = got
        return out

    def _link_back(self, links: np.ndarray, batch: np.ndarray) -> None:
        source = np.repeat(batch, links.shape[1])
        target = links[batch].ravel()
        source, target = source[target >= 0], target[target >= 0]
        by = np.argsort(target, kind="stable")
        source, target = source[by], target[by]
        rank = np.arange(len(target)) - np.searchsorted(target, target)
        degree = links.shape[1]
        for low in range(0, int(rank.max(initial=-1)) + 1, degree):
            part = (rank >= low) & (rank < low + degree)
            nodes, at = np.unique(target[part], return_inverse=True)
            new = np.full((len(nodes), degree), -1, np.int64)
            new[at, rank[part] - low] = source[part]
            links[nodes] = self._select(nodes, np.concatenate([links[nodes], new], axis=1), degree)

    def neighbours(self, q: np.ndarray, start: np.ndarray | None, least: float, width: int):
        """Blocks of (query row, graph row) with similarity of ``least`` or more.

        A beam that is full of such rows widens until no row near enough is left unvisited.
        At a width of the whole graph all rows are compared.
        """
        base, n = self.layers[-1], len(self.x)
        if width >= n:
            for k in range(0, len(q), _BATCH):
                r, c = np.nonzero(q[k : k + _BATCH] @ self.x.T >= least)
                yield r + k, c
            return
        lost = self.unreached()
        for k in range(0, len(q) if len(lost) else 0, _BATCH):
            r, c = np.nonzero(q[k : k + _BATCH] @ self.x[lost].T >= least)
            yield r + k, lost[c]
        step = max(16, min(_BATCH, 8_000_000 // n))
        for k in range(0, len(q), step):
            rows = np.arange(k, min(len(q), k + step))
            entry = self._base_entry(q[rows]) if start is None else start[rows, None]
            ids, sims = self._beam(base, q[rows], entry, width, n)
            near = sims >= least
            full = near.all(axis=1)
            r, c = np.nonzero(near & ~full[:, None])
            yield rows[r], ids[r, c]
            if full.any():
                for r, c in self._widened(base, q[rows[full]], ids[full], sims[full], least):
                    yield rows[full][r], c

    def _widened(self, links: np.ndarray, q: np.ndarray, ids: np.ndarray, sims: np.ndarray, least: float):
        """Beams without a bound: every row within SLACK of ``least`` is visited from."""
        n = len(self.x)
        seen = np.zeros(len(q) * n, bool)
        r, c = np.nonzero(sims >= least - SLACK)
        front, near = r * n + ids[r, c], sims[r, c] >= least
        seen[front] = True
        yield front[near] // n, front[near] % n
        while len(front):
            after = []
            for k in range(0, len(front), 8_000):
                part = front[k : k + 8_000]
                met = links[part % n]
                keys = ((part // n * n)[:, None] + met)[met >= 0]
                keys = np.unique(keys[~seen[keys]])
                seen[keys] = True
                sims = np.einsum("ed,ed->e", self.x[keys % n], q[keys // n])
                after.append(keys[sims >= least - SLACK])
                near = keys[sims >= least]
                yield near // n, near % n
            front = np.concatenate(after)

    def _base_entry(self, q: np.ndarray) -> np.ndarray:
        at = np.zeros((len(q), 1), np.int64)
        for links in self.layers[:-1]:
            found, sims = self._beam(links, q, at, 4, len(links))
            at = np.take_along_axis(found, sims.argmax(axis=1)[:, None], axis=1)
        return at

    def width_that_finds_all(self, least: float, own: bool = False, q: np.ndarray | None = None) -> int:
        """A beam width at which an audit against brute force misses no link.

        Queries are ``q``, or else the rows themselves, whose likeness to themselves is no
        link; searches start at the top of the graph, or with ``own`` at the row itself.
        They are drawn in blocks until enough true links or AUDITED_ROWS queries are seen.
        Where links are rare few of those have any, so rows turned by an angle within
        ``least`` are looked for from the top as well. Past an eighth of the graph the width
        is the whole graph, which compares all rows.
        """
        n = len(self.x)
        rows, row, col = self._true_links(self.x if q is None else q, least, q is None)
        asked = (self.x if q is None else q)[rows]
        truth = row * n + col
        planted = self._planted(least)
        hidden = np.flatnonzero(planted @ self.x.T >= least)
        width = QUERY_BEAM
        while width < n:
            got = [r * n + c for r, c in self.neighbours(asked, rows if own else None, least - ROUNDING, width)]
            seen = [r * n + c for r, c in self.neighbours(planted, None, least - ROUNDING, width)]
            if np.isin(truth, np.concatenate([truth[:0], *got])).all() and np.isin(hidden, np.concatenate([hidden[:0], *seen])).all():
                break
            width = width * 2 if width * 16 <= n else n
        return width

    def _planted(self, least: float) -> np.ndarray:
        """Some rows turned by random angles whose cosine is between ``least`` and 1."""
        rng = np.random.default_rng(len(self.x) + 1)
        x = self.x[rng.permutation(len(self.x))[:PLANTED]].astype(np.float64)
        away = rng.standard_normal(x.shape)
        away -= np.einsum("ij,ij->i", away, x)[:, None] * x
        away /= np.maximum(np.sqrt(np.einsum("ij,ij->i", away, away)), 1e-300)[:, None]
        cosine = rng.uniform(least, 1, (len(x), 1))
        return (cosine * x + np.sqrt(1 - cosine**2) * away).astype(np.float32)

    def _true_links(self, q: np.ndarray, least: float, to_self: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(queries with links, place of the query among them, row) of the links of an audit."""
        order = np.random.default_rng(len(q)).permutation(len(q))
        rows, links, at, seen = [np.zeros(0, np.int64)], [np.zeros((2, 0), np.int64)], 0, 0
        known = 0
        while at < min(len(order), AUDITED_ROWS) and seen < AUDITED_LINKS:
            block = order[at : at + (_BATCH if at else 64)]
            near = q[block] @ self.x.T >= least
            if to_self:
                near[np.arange(len(block)), block] = False
            counts = near.sum(axis=1)
            near = near[counts > 0]
            r, c = np.nonzero(near)
            rows.append(block[counts > 0])
            links.append(np.stack([r + known, c]))
            known += len(near)
            seen += int(np.minimum(counts, LINKS_A_ROW).sum())
            at += len(block)
        row, col = np.concatenate(links, axis=1)
        return np.concatenate(rows), row, col


def _graph_rows(shards: DataFrame, least: float) -> DataFrame:
    """Packed shards with their graphs: layers as bytes, and the audited beam width for their own rows."""
    schema = shards.schema.simpleString()[len("struct<") : -1].replace(":", " ") + (
        ", sizes array<int>, layers binary, row_order binary, own_width int"
    )

    def build(frame: pd.DataFrame) -> pd.DataFrame:
        row = frame.iloc[0]
        _, x = unpacked(row["ids"], row["vectors"], row["n"])
        graph = Graph.build(unit(x))
        return frame.assign(
            sizes=[[len(a) for a in graph.layers]],
            layers=[b"".join(a.tobytes() for a in graph.layers)],
            row_order=[graph.order.astype(np.int64).tobytes()],
            own_width=graph.width_that_finds_all(least, own=True),
        )

    return shards.groupBy("label", "dim", "shard").applyInPandas(build, schema)


def _opened(row, x: np.ndarray) -> Graph:
    order = np.frombuffer(row["row_order"], np.int64)
    flat, layers, at = np.frombuffer(row["layers"], np.int32), [], 0
    for level, size in enumerate(row["sizes"]):
        degree = DEGREE * (2 if level == len(row["sizes"]) - 1 else 1)
        layers.append(flat[at : at + size * degree].reshape(size, degree))
        at += size * degree
    return Graph(x[order], layers, order)


class LinkBits:
    """Which columns each row is linked to, a bit a pair: 32 MB for two full shards."""

    def __init__(self, rows: int, columns: int):
        self.columns, self.bytes = columns, -(-columns // 8)
        self.flat = np.zeros(rows * self.bytes, np.uint8)

    def add(self, r: np.ndarray, c: np.ndarray) -> None:
        np.bitwise_or.at(self.flat, r * self.bytes + (c >> 3), (128 >> (c & 7)).astype(np.uint8))

    def linked(self) -> np.ndarray:
        return np.flatnonzero(self.flat.reshape(-1, self.bytes).any(axis=1))

    def of(self, r: int) -> np.ndarray:
        return np.flatnonzero(np.unpackbits(self.flat[r * self.bytes : (r + 1) * self.bytes], count=self.columns))


def counts_and_forest(
    sides: list[LinkBits], first: list[int], weights: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(weight of what each node is linked to, parents, children) of a spanning forest.

    Nodes of side k are numbered from ``first[k]``; its columns are nodes from ``first[1 - k]``,
    or of itself where there is one side. Each node is opened once.
    """
    counts, seen = np.zeros(len(weights), np.int64), np.zeros(len(weights), bool)
    parents, children = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for root in np.concatenate([bits.linked() + at for bits, at in zip(sides, first)]).tolist():
        todo = [] if seen[root] else [root]
        seen[root] = True
        while todo:
            u = todo.pop()
            k = int(len(sides) > 1 and u >= first[1])
            met = sides[k].of(u - first[k]) + first[len(sides) - 1 - k]
            counts[u] = weights[met].sum()
            new = met[~seen[met]]
            seen[new] = True
            parents.append(np.full(len(new), u))
            children.append(new)
            todo.extend(new.tolist())
    return counts, np.concatenate(parents), np.concatenate(children)


def _pair_links(row) -> pd.DataFrame:
    """(a, b, n) of one shard with itself or with another: see ``_search``."""
    names = ("n", "ids", "vectors", "extra", "sizes", "layers", "row_order")
    own = row["shard"] == row["q_shard"]
    shards = []
    for prefix in ("",) if own else ("", "q_"):
        part = {c: row[prefix + c] for c in names}
        ids, x = unpacked(part["ids"], part["vectors"], int(part["n"]))
        x = unit(x)
        shards.append((ids, x, np.frombuffer(part["extra"], np.int64), _opened(part, x)))

    def found(to: int, by: int, start, width: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        (_, x, _, graph), q = shards[to], shards[by][1]
        # beams run in single precision: a little slack, then the exact cosine decides
        for r, c in graph.neighbours(q.astype(np.float32), start, row["least"] - ROUNDING, width):
            c = graph.order[c]
            for k in range(0, len(r), _VERIFIED):
                i, j = r[k : k + _VERIFIED], c[k : k + _VERIFIED]
                sure = np.einsum("ij,ij->i", q[i], x[j]) >= row["least"]
                yield i[sure], j[sure]

    if own:
        ids, x, copies, graph = shards[0]
        start = np.empty(len(ids), np.int64)
        start[graph.order] = np.arange(len(ids))
        bits = LinkBits(len(ids), len(ids))
        for r, c in found(0, 0, start, int(row["own_width"])):
            r, c = r[r != c], c[r != c]
            bits.add(r, c)
            bits.add(c, r)
        sides, first = [bits], [0]
    else:
        sizes = [len(s[0]) for s in shards]
        sides, first = [LinkBits(*sizes), LinkBits(*sizes[::-1])], [0, sizes[0]]
        for to, by in ((0, 1), (1, 0)):
            width = shards[to][3].width_that_finds_all(row["least"], q=shards[by][1].astype(np.float32))
            for r, c in found(to, by, None, width):
                sides[by].add(r, c)
                sides[to].add(c, r)
        ids, copies = (np.concatenate([s[k] for s in shards]) for k in (0, 2))
    counts, parents, children = counts_and_forest(sides, first, copies)
    some = np.flatnonzero(counts)
    return pd.DataFrame({
        "a": np.concatenate([ids[some], ids[parents]]),
        "b": np.concatenate([ids[some], ids[children]]),
        "n": np.concatenate([counts[some], np.zeros(len(parents), np.int64)]),
    })


def _search(graphs: DataFrame, least: float) -> DataFrame:
    """(a, b, n): for a = b, a part of the links of a, with copies counted; else a link of a forest.

    Every two shards of a label are searched for each other in one task, a shard for itself
    in another, so a link that either side finds is one link. A task gives two rows a vector
    at most, however many links there are.
    """
    keys = ["label", "dim"]
    shard = graphs.select(*keys, "shard")
    # narrow pairs first: a shard's bytes then travel under a key of their own
    pairs = settle(
        shard.join(shard.withColumnRenamed("shard", "q_shard"), keys).where("shard <= q_shard")
        .withColumn("q_other", F.expr("if(shard < q_shard, q_shard, null)"))
    )
    sent = ("n", "ids", "vectors", "extra", "sizes", "layers", "row_order")
    q = graphs.select(*keys, F.col("shard").alias("q_other"), *[F.col(c).alias(f"q_{c}") for c in sent])
    both = pairs.join(graphs, [*keys, "shard"]).join(q, [*keys, "q_other"], "left")
    name = [*keys, "shard", "q_shard"]
    # a pair is much work in few bytes: without a number, small pairs would share a task
    spread = both.repartition(min(MOST_TASKS, max(1, pairs.count())), *name)
    return spread.groupBy(*name).applyInPandas(
        lambda frame: _pair_links(frame.iloc[0].to_dict() | {"least": least}), "a long, b long, n long"
    )


def near_vectors(
    vectors: DataFrame, least: float, id_name: str = "vec_id", shard_rows: int = SHARD_ROWS
) -> DataFrame:
    """(id, n_links, component_id, kept): links of cosine ``least`` or more within a label.

    ``vectors`` has (id, embedding, label); other columns are ignored. Vectors that are null,
    zero or not finite, rows without a label and rows without an id link with nothing and
    are components of their own. Equal vectors of one label are one vector with a count, so
    copies are never paired; repeated ids are rows that link like any other. One row comes
    out per row that goes in. Vectors of different lengths never link.
    """
    rows = vectors.select(
        F.col(id_name).cast("long").alias("id"), F.col("label").cast("string").alias("label"),
        as_doubles(F.col("embedding")).alias("vector"),
    )
    fit = usable(F.col("vector")) & F.col("label").isNotNull() & F.col("id").isNotNull()
    rows = rows.withColumn("vector", F.when(fit, F.col("vector")))
    same = rows.where("vector is not null").groupBy("label", "vector")
    # classes get numbers of their own: an id may repeat under two labels
    classes = settle(
        with_uid(same.agg(F.min("id").alias("rep"), F.count("*").alias("copies")), "key")
        .withColumn("dim", F.size("vector"))
    )
    sizes = classes.groupBy("label", "dim").agg(F.ceil(F.count("*") / shard_rows).cast("int").alias("shards"))
    dealt = classes.join(sizes, ["label", "dim"]).withColumn("shard", F.pmod(F.xxhash64("key"), "shards").cast("int"))
    shards = packed(
        dealt.select("label", "dim", "shard", "key", "vector", "copies"), ["label", "dim", "shard"], "key", "copies"
    )
    graphs = settle(_graph_rows(shards, least))
    found = settle(_search(graphs, least))
    narrow = classes.select("key", "rep")
    linked = found.where("a = b").groupBy(F.col("a").alias("key")).agg(F.sum("n").alias("others"))
    groups = components(found.where("a <> b").select("a", "b")).withColumnRenamed("id", "key")
    smallest = (
        groups.join(narrow, "key").groupBy("component").agg(F.min("rep").alias("smallest"))
        .join(groups, "component").select("key", "smallest")
    )
    known = (
        classes.join(linked, "key", "left").join(smallest, "key", "left")
        .select("label", "vector", (F.coalesce("others", F.lit(0)) + F.col("copies") - 1).alias("links"),
                F.coalesce("smallest", "rep").alias("component"))
    )
    return rows.join(known, ["label", "vector"], "left").select(
        F.col("id").alias(id_name), F.coalesce("links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("component", "id").alias("component_id"),
        F.coalesce(F.coalesce("component", "id") == F.col("id"), F.lit(True)).alias("kept"),
    )
