"""Connected components of a link table, as rounds of joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ecoledger.llm.common import groups_of
from ecoledger.session import BROADCAST_ROWS, settle

# links that one task of a round reads
LINKS_READ = 20_000


def components(links: DataFrame) -> DataFrame:
    """(id, component): the smallest id reachable from each id that has a link.

    ``links`` has two id columns.
    """
    edges = stars(links)
    roots = edges.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct()
    return edges.select(F.col("u").alias("id"), F.col("v").alias("component")).unionByName(roots)


def stars(links: DataFrame) -> DataFrame:
    """(u, v): each id of ``links`` that is not the smallest reachable, with the smallest; settled.

    Alternates large-star and small-star steps: each id's neighbours are hung below its
    smallest neighbour, until every component is a star. Rounds grow with the logarithm of
    the longest path; each settles its edges once. Minima are combined on the map side, and
    an id that hangs below none needs no step, so the middle of a star is never gathered.
    Few edges are read by few tasks and broadcast, and so is the result by its hint.
    """
    a, b = links.columns[:2]
    edges = settle(
        links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u <> v").distinct()
    )
    while True:
        done, rows = _shape(edges)
        hint = F.broadcast if rows <= BROADCAST_ROWS else lambda table: table
        edges = edges.coalesce(groups_of(rows, LINKS_READ))
        if done:
            return hint(edges)
        edges = settle(_round(edges, hint))


def _round(edges: DataFrame, hint) -> DataFrame:
    """Edges after one large-star and one small-star step."""
    below = edges.groupBy(F.col("u").alias("v")).agg(F.min("v").alias("m"))
    large = edges.join(hint(below), "v", "left").select("u", F.coalesce("m", "v").alias("v"))
    lowest = large.groupBy("u").agg(F.min("v").alias("m"))
    same = F.col("v") == F.col("m")
    return large.join(hint(lowest), "u").select(F.when(same, F.col("u")).otherwise(F.col("v")).alias("u"), F.col("m").alias("v")).distinct()


def _shape(edges: DataFrame) -> tuple[bool, int]:
    """Whether no id hangs below two, or below one that hangs itself; and the number of edges."""
    ends = F.array(F.struct(F.col("u").alias("id"), F.col("v").alias("to")), F.struct(F.col("v").alias("id"), F.lit(None).alias("to")))
    ids = edges.select(F.explode(ends).alias("e")).groupBy("e.id").agg(
        F.count("e.to").alias("hangs"), F.max(F.col("e.to").isNull()).alias("holds")
    )
    odd, rows = ids.agg(F.max(F.expr("hangs > 1 or (hangs = 1 and holds)")), F.sum("hangs")).first()
    return not odd, rows or 0
