"""Resharding by minimum-cost flow.

Shards of old sizes become shards of new capacities. A flow between old and new shards
says how many bytes go where at the least cost; bytes that stay cost nothing. Within an
old shard, blocks of documents are laid out one after another and the flow cuts that line
into stretches, so whole blocks move and only files that gain or lose blocks are written.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ecoledger.session import settle

BLOCKS = 512
# a block is at most about this part of a new shard; larger ones are dealt into parts
BLOCK_SHARE = 128
_NO_ID = -(1 << 63)


def least_cost_flow(sizes: list[int], capacities: list[int], cost: list[list[int]] | None = None) -> list[list[int]]:
    """Units to send from each old to each new shard; all of ``sizes``, within ``capacities``.

    Successive shortest paths over the few shards. By default a unit that stays in the shard
    of its number costs 0 and any other 1, which moves the fewest bytes.
    """
    m, n = len(sizes), len(capacities)
    if sum(sizes) > sum(capacities):
        raise ValueError("capacities are smaller than the sizes")
    cost = cost or [[int(i != j) for j in range(n)] for i in range(m)]
    flow = [[0] * n for _ in range(m)]
    supply, room = list(sizes), list(capacities)
    while any(supply):
        # shortest paths from all supply over forward and returning edges
        far = float("inf")
        dist = [0 if s else far for s in supply] + [far] * n
        prior: list[int | None] = [None] * (m + n)
        for _ in range(m + n):
            changed = False
            for i in range(m):
                for j in range(n):
                    if dist[i] + cost[i][j] < dist[m + j]:
                        dist[m + j], prior[m + j], changed = dist[i] + cost[i][j], i, True
                    if flow[i][j] and dist[m + j] - cost[i][j] < dist[i]:
                        dist[i], prior[i], changed = dist[m + j] - cost[i][j], m + j, True
            if not changed:
                break
        end = min((j for j in range(n) if room[j]), key=lambda j: dist[m + j])
        path, at = [], m + end
        while prior[at] is not None:
            path.append((prior[at], at))
            at = prior[at]
        amount = min([supply[at], room[end], *(flow[b][a - m] for a, b in path if a >= m)])
        for a, b in path:
            if a < m:
                flow[a][b - m] += amount
            else:
                flow[b][a - m] -= amount
        supply[at] -= amount
        room[end] -= amount
    return flow


def even_capacities(total: int, shards: int) -> list[int]:
    """``total`` in ``shards`` parts that differ by one at most."""
    return [total // shards + (k < total % shards) for k in range(shards)]


def keyed(docs: DataFrame) -> DataFrame:
    """``docs`` with its row key: the id (null before all others) and the hash of the text."""
    return docs.withColumns(
        {"_id": F.coalesce(F.col("doc_id").cast("long"), F.lit(_NO_ID)), "_th": F.xxhash64("text")}
    )


def place(rows: DataFrame, capacities: list[int] | None = None, shards: int = 16) -> DataFrame:
    """(_id, _th, old_shard, shard, first_slot, moved): where each row goes.

    ``rows`` has (_id, _th, size, old_shard, group); ``old_shard`` counts from 0, ``group``
    is a hash. Rows of one group move together, unless the group is a large part of a
    shard. Rows with the same key are one, and take as many slots as they are.
    ``capacities`` default to equal parts of all sizes. Slots count from 0 in each shard.
    Runs jobs; one figure an old shard reaches the driver, and what is broadcast is bounded
    by the number of blocks.
    """
    rows = settle(
        rows.groupBy("_id", "_th", "old_shard", "group").agg(F.sum("size").alias("size"), F.count("*").alias("_n"))
        .withColumn("_block", F.pmod(F.xxhash64("group", F.lit(11)), F.lit(BLOCKS)).cast("int"))
    )
    by_shard = {r["old_shard"]: r["n"] for r in rows.groupBy("old_shard").agg(F.sum("size").alias("n")).collect()}
    total = sum(by_shard.values())
    capacities = capacities or even_capacities(total, shards)
    limit = max(1, total // (len(capacities) * BLOCK_SHARE))
    whole = rows.groupBy("old_shard", "_block").agg(F.sum("size").alias("_bytes"))
    parts = whole.select("old_shard", "_block", F.ceil(F.col("_bytes") / limit).alias("_parts"))
    # at most BLOCKS rows an old shard
    split = rows.join(F.broadcast(parts), ["old_shard", "_block"])
    # groups above the limit: at most as many as limits fit into the whole
    hot = (
        rows.groupBy("old_shard", "group").agg(F.sum("size").alias("_g")).where(F.col("_g") > limit)
        .select("old_shard", "group", F.lit(True).alias("_hot"))
    )
    split = split.join(F.broadcast(hot), ["old_shard", "group"], "left")
    # a block of many groups is dealt by group, a hot group by row
    key = F.when(F.col("_hot"), F.xxhash64("_id", "_th")).otherwise(F.xxhash64("group", F.lit(13)))
    split = split.withColumn("_part", F.pmod(key, F.greatest("_parts", F.lit(1))))
    name = ["old_shard", "_block", "_part"]
    blocks = settle(split.groupBy(*name).agg(F.sum("size").alias("_bytes"), F.sum("_n").alias("_rows")))

    old = range(max(by_shard, default=-1) + 1)
    flow = least_cost_flow([by_shard.get(i, 0) for i in old], capacities)
    # large blocks first: where a stretch ends, blocks are small
    line = Window.partitionBy("old_shard").orderBy(F.desc("_bytes"), "_block", "_part").rowsBetween(
        Window.unboundedPreceding, -1
    )
    laid = blocks.withColumn("_middle", F.coalesce(F.sum("_bytes").over(line), F.lit(0)) + F.col("_bytes") / 2)
    laid = laid.withColumn("shard", _stretches(flow).cast("int"))
    before = Window.partitionBy("shard").orderBy(*name).rowsBetween(Window.unboundedPreceding, -1)
    laid = laid.select(*name, "shard", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_base"))
    inside = Window.partitionBy(*name).orderBy("_id", "_th").rowsBetween(Window.unboundedPreceding, -1)
    return (
        split.withColumn("_row", F.coalesce(F.sum("_n").over(inside), F.lit(0)))
        # a few parts for each of BLOCKS times the old shards
        .join(F.broadcast(laid), name)
        .select(
            "_id", "_th", "old_shard", "shard", (F.col("_base") + F.col("_row")).cast("long").alias("first_slot"),
            (F.col("shard") != F.col("old_shard")).alias("moved"),
        )
    )


def _stretches(flow: list[list[int]]) -> Column:
    """The new shard of a block from its old shard and place: what stays comes first."""
    target: Column = F.lit(None)
    for i, sent in enumerate(flow):
        order = sorted((j for j, units in enumerate(sent) if units), key=lambda j: (j != i, j))
        inner, end = F.lit(order[-1] if order else min(i, len(sent) - 1)), sum(sent)
        for j, after in zip(order[-2::-1], order[:0:-1]):
            end -= sent[after]
            inner = F.when(F.col("_middle") <= end, j).otherwise(inner)
        target = F.when(F.col("old_shard") == i, inner).otherwise(target)
    return target


def _slotted(docs: DataFrame, placed: DataFrame) -> DataFrame:
    """Rows of ``docs`` that ``placed`` names, with shard, old_shard and slot."""
    repeat = F.row_number().over(Window.partitionBy("_id", "_th").orderBy(F.lit(0))) - 1
    return (
        keyed(docs).join(placed, ["_id", "_th"])
        .withColumn("slot", F.col("first_slot") + repeat).drop("_id", "_th", "first_slot", "moved")
    )


def rewrite(docs: DataFrame, placed: DataFrame, folder: str) -> tuple[DataFrame, DataFrame]:
    """Write the affected shards below ``folder`` as ``shard=K``; (what is read back, the rest).

    A shard is affected if a row came to it or left it; the others keep their files, and
    the second result is their rows of ``docs``, which are not written.
    Every row gets its ``slot``; rows are sorted by it within a file. A shard is many
    files, one from each task that holds rows of it. Columns of ``docs`` named shard,
    old_shard or slot are replaced.
    """
    docs, placed = docs.drop("shard", "old_shard", "slot"), settle(placed)
    touched = placed.where("moved").select(F.explode(F.array("shard", "old_shard")).alias("shard")).distinct()
    # one row a shard
    touched = F.broadcast(settle(touched))
    out = _slotted(docs, placed.join(touched, "shard", "left_semi"))
    out.sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(folder)
    files = docs.sparkSession.read.schema(out.schema).parquet(folder)
    still = settle(placed.join(touched, "shard", "left_anti"))
    same = _slotted(docs, still) if still.limit(1).count() else docs.sparkSession.createDataFrame([], out.schema)
    return files, same
