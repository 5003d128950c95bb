"""Mixing sources to target weights by Pareto order sampling.

Each source has a budget of words. Every document gets whole copies for certain as often
as its expected number of copies holds ones; what remains of the budget goes to a sample
of further copies with unequal inclusion probabilities: documents are ranked by random
odds divided by inclusion odds and taken in that order until the budget is met, the last
one in part. Everything is DataFrame functions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ecoledger.session import broadcast_if_small, settle

MOST_COPIES = 3
_RANKS = 1 << 52


def uniform(key: Column, seed: int = 0) -> Column:
    """A number in (0, 1) that depends on the key and the seed alone."""
    digest = F.md5(F.concat_ws("|", F.coalesce(key.cast("string"), F.lit("")), F.lit(str(seed))))
    bits = F.conv(F.substring(digest, 1, 13), 16, 10).cast("double")
    return (bits + F.lit(0.5)) / F.lit(float(_RANKS))


def source_weights(sources: DataFrame, cycle: tuple[int, ...] = (1, 2, 3)) -> DataFrame:
    """(source, source_size, weight): sources by code point, null last, weigh 1, 2, 3, 1, ...

    Sorted as one small table, a row a source.
    """
    order = Window.orderBy(F.col("source").isNull(), F.col("source"))
    place = F.pmod(F.row_number().over(order) - 1, F.lit(len(cycle)))
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in cycle]), place.cast("int") + 1)
    return sources.select("source", "source_size", weight.alias("weight"))


def targets(weighted: DataFrame, share: float = 1.0, most: int = MOST_COPIES) -> DataFrame:
    """``weighted`` with ``target``: shares of all sizes by weight, at most ``most`` times the size.

    What a source cannot take is shared among the others by weight, again until none is
    above. A round caps a source at least, and two sums a round reach the driver.
    """
    limit = F.col("source_size") * most
    total = (weighted.agg(F.sum("source_size")).first()[0] or 0) * share
    level, count = -1.0, -1
    while True:
        # whether a source is capped follows from the level alone, so no state but it is kept
        capped = F.lit(level) * F.col("weight") > limit if level >= 0 else F.lit(False)
        used, open_weight, now = weighted.agg(
            F.coalesce(F.sum(F.when(capped, limit)), F.lit(0)),
            F.coalesce(F.sum(F.when(~capped, F.col("weight"))), F.lit(0.0)), F.count(F.when(capped, 1)),
        ).first()
        if now == count or not open_weight:
            break
        level, count = (total - used) / open_weight, now
    capped = F.lit(level) * F.col("weight") > limit
    return weighted.withColumn(
        "target", F.when(capped, limit.cast("double")).otherwise(F.lit(max(level, 0.0)) * F.col("weight"))
    )


def _favour(size: Column, mean: Column) -> Column:
    """How much likelier than the shortest a document is drawn: from 1 up to 2 with its size.

    Longer documents are favoured mildly, so that fewer documents meet a budget.
    """
    return 1 + size / (size + mean + 1)


def _levels(sizes: DataFrame, goals: DataFrame, most: int) -> DataFrame:
    """``goals`` with ``_mean`` and ``_level``: a document is expected level * favour times.

    Documents expected more often than ``most`` times are held there and the level of the
    others rises, until none is above. ``sizes`` counts documents by (source, size).
    """
    mean = sizes.groupBy("source").agg(
        (F.sum(F.col("size") * F.col("n")) / F.sum("n")).alias("_mean"), F.sum("n").alias("_docs")
    )
    known = settle(_same_source(goals, mean).withColumn("_level", F.lit(-1.0)))
    while True:
        rows = _same_source(sizes, known.select("source", "_mean", "_level"))
        favour = _favour(F.col("size"), F.col("_mean"))
        held = (F.col("_level") >= 0) & (F.col("_level") * favour > most)
        words = (F.col("size") * F.col("n")).cast("double")
        sums = rows.groupBy("source").agg(
            F.sum(F.when(held, words).otherwise(0.0)).alias("held"),
            F.sum(F.when(~held, words * favour).otherwise(0.0)).alias("open"),
        )
        rest = F.greatest(F.col("target") - F.col("held") * most, F.lit(0.0))
        fresh = F.when(F.col("open") > 0, rest / F.col("open")).otherwise(F.greatest(F.col("_level"), F.lit(0.0)))
        # a level only rises; sums of doubles may differ in their last digits between runs
        level = F.when(F.col("_level") < 0, fresh).otherwise(F.greatest("_level", F.round(fresh, 9)))
        after = settle(_same_source(known, sums).withColumn("_next", F.round(level, 9)).drop("held", "open"))
        moved = after.where(F.col("_next") > F.col("_level")).limit(1).count()
        known = after.withColumn("_level", F.col("_next")).drop("_next")
        if not moved:
            return known


def _same_source(left: DataFrame, right: DataFrame) -> DataFrame:
    """Join on ``source``, where null equals null; the right side has a row a source."""
    right = right.withColumnRenamed("source", "_source")
    return left.join(broadcast_if_small(right), left["source"].eqNullSafe(right["_source"])).drop("_source")


def mix(docs: DataFrame, weighted: DataFrame | None = None, share: float = 1.0, seed: int = 0) -> DataFrame:
    """``docs`` with (source_size, target, taken) from columns (doc_id, source, size).

    ``taken`` is the size that the mix takes of a document, repeats counted: whole copies,
    and of one document a source a part. It never exceeds MOST_COPIES times the size, and
    the documents of a source together take its target, up to rounding. The same rows give
    the same mix. Null sources are a source; rows of size 0 take nothing; rows that repeat
    an id draw the same random number, and share what is left of a budget. Columns of
    these names, and those that start with an underscore, are replaced or left out. ``weighted`` has (source, source_size, weight), by default
    the weights 1, 2, 3 in turn.

    Runs jobs over a settled narrow table; the documents themselves are never shuffled:
    each source's sample ends at one cut of the ranking, found by sums over slices of it.
    """
    docs = docs.select(*[
        c for c in docs.columns if not c.startswith("_") and c not in ("source_size", "target", "taken")
    ])
    narrow = settle(docs.select("doc_id", "source", F.col("size").cast("long").alias("size")))
    sizes = settle(narrow.groupBy("source", "size").agg(F.count("*").alias("n")))
    totals = sizes.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).cast("long").alias("source_size"))
    weighted = source_weights(totals) if weighted is None else weighted
    known = _levels(sizes, targets(settle(weighted), share), MOST_COPIES)

    def expected(rows: DataFrame) -> DataFrame:
        times = F.least(F.col("_level") * _favour(F.col("size"), F.col("_mean")), F.lit(float(MOST_COPIES)))
        return rows.withColumns({"_whole": F.floor(times), "_part": times - F.floor(times)})

    sure = expected(_same_source(sizes, known)).groupBy("source").agg(
        F.sum(F.col("_whole") * F.col("size") * F.col("n")).alias("_sure"),
        F.sum(F.when(F.col("_whole") < MOST_COPIES, F.col("size") * F.col("n")).otherwise(0)).alias("_room"),
    )
    known = _same_source(known, sure).select(
        "source", "source_size", "target", "_mean", "_level",
        F.least(F.greatest(F.round("target").cast("long") - F.col("_sure"), F.lit(0)), F.col("_room")).alias("_left"),
        F.ceil(F.sqrt("_docs")).alias("_slices"),
    )
    share_left = F.least(F.greatest(F.col("_left") / F.greatest(F.col("source_size"), F.lit(1)), F.lit(1e-3)), F.lit(1 - 1e-3))
    known = settle(known.withColumn("_odds", share_left / (1 - share_left)))

    def ranked(rows: DataFrame) -> DataFrame:
        """Random odds over inclusion odds; those never to be drawn come last."""
        u = uniform(F.col("doc_id"), seed)
        rank = F.when(F.col("_part") > 0, u * (1 - F.col("_part")) / ((1 - u) * F.col("_part")))
        rows = expected(_same_source(rows, known)).withColumn(
            "_rank", F.when(F.col("_whole") < MOST_COPIES, F.coalesce(rank, 1e300 * (1 + u)))
        )
        scaled = F.col("_rank") * F.col("_odds")
        place = F.when(F.isnan(scaled / (1 + scaled)) | (scaled > 1e15), 1.0).otherwise(scaled / (1 + scaled))
        return rows.withColumn("_slice", F.least(F.floor(place * F.col("_slices")), F.col("_slices") - 1))

    # a source's slices are about the square root of its documents, and hold as many each
    drawn = ranked(narrow).where("_rank is not null and size > 0")
    slices = drawn.groupBy("source", "_slice").agg(F.sum("size").alias("_words"), F.first("_left").alias("_left"))
    before = Window.partitionBy("source").orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    last = (
        slices.withColumn("_before", F.coalesce(F.sum("_words").over(before), F.lit(0)))
        .where("_before < _left and _left <= _before + _words").select("source", "_slice", "_before")
    )
    last = settle(last.withColumnRenamed("_slice", "_last"))
    inside = _same_source(drawn, last).where("_slice = _last").groupBy("source", "_rank", "doc_id").agg(
        F.sum("size").alias("_words"), F.first("_left").alias("_left"), F.first("_before").alias("_before")
    )
    upto = Window.partitionBy("source").orderBy("_rank", "doc_id").rowsBetween(Window.unboundedPreceding, -1)
    cuts = (
        inside.withColumn("_start", F.col("_before") + F.coalesce(F.sum("_words").over(upto), F.lit(0)))
        .where("_start < _left and _left <= _start + _words")
        .select(
            "source", F.col("_rank").alias("_cut"), F.col("doc_id").alias("_cut_id"),
            ((F.col("_left") - F.col("_start")) / F.col("_words")).alias("_cut_share"),
        )
    )
    cuts = settle(known.select("source").join(
        cuts.withColumnRenamed("source", "_s"), F.col("source").eqNullSafe(F.col("_s")), "left"
    ).drop("_s"))
    at_cut = (F.col("_rank") == F.col("_cut")) & F.col("doc_id").eqNullSafe(F.col("_cut_id"))
    # null ids come first among equals, as in the order above
    ahead = (F.col("_rank") < F.col("_cut")) | ((F.col("_rank") == F.col("_cut")) & F.coalesce(
        F.col("doc_id") < F.col("_cut_id"), F.col("doc_id").isNull() & F.col("_cut_id").isNotNull()))
    extra = (
        F.when(F.col("_cut").isNull() | F.col("_rank").isNull(), F.lit(0))
        .when(at_cut, F.round(F.col("size") * F.col("_cut_share")))
        .when(ahead, F.col("size")).otherwise(0)
    )
    final = _same_source(ranked(docs), cuts)
    return final.withColumn(
        "taken", (F.col("_whole") * F.col("size") + F.coalesce(extra, F.lit(0))).cast("long")
    ).drop("_whole", "_part", "_rank", "_slice", "_slices", "_odds", "_left", "_cut", "_cut_id", "_cut_share", "_mean", "_level")
