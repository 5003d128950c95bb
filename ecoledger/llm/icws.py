"""Near-duplicate texts by improved consistent weighted sampling over TF-IDF shingles.

A shingle is five words; its weight is how often it stands in the text times the mean
inverse document frequency of its words. Document frequencies of all words of all
documents are counted in a sketch of fixed size. Each text is sampled consistently: two
texts draw the same sample with the probability of their weighted Jaccard similarity.
Bands of samples give candidate pairs, which are verified by that similarity on the whole
texts; groups are the components of verified pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ecoledger.llm.common import texts_of, with_uid
from ecoledger.llm.components import stars
from ecoledger.llm.wordhash import mix, run_hashes, word_hashes
from ecoledger.session import broadcast_if_small, narrow_batches, settle

WORDS = 5
SIMILARITY = 0.8
BANDS = 14
ROWS = 5
SKETCH_BITS = 18
# weights of shingles are summed by hash in so many parts, which bounds what two texts share
PARTS = 256
# shingles that a task gathers before it sends them on
ROWS_SENT = 50_000
_NO_ID = -(1 << 63)
_SEED = 0x5851F42D4C957F2D
# slack of bounds that are sums of floats
_ROUNDING = 1e-3


def document_frequencies(docs: DataFrame) -> tuple[np.ndarray, int]:
    """(sketch, documents): in how many texts the words of each of 2^SKETCH_BITS slots stand.

    The sketch is the same size for any corpus: each task sends at most one number a
    slot, sums are per slot, and 2^SKETCH_BITS numbers reach the driver.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slots = np.zeros(1 << SKETCH_BITS, np.int64)
        for b in batches:
            for text in texts_of(b["text"]):
                if text is not None:
                    words = word_hashes(text.encode())
                    slots[np.unique(words >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)] += 1
        used = np.flatnonzero(slots)
        yield pa.RecordBatch.from_pydict({"slot": used.astype(np.int32), "n": slots[used]})

    sums = docs.select("text").mapInArrow(count, "slot int, n long").groupBy("slot").agg(F.sum("n").alias("n"))
    rows = sums.toPandas()
    sketch = np.zeros(1 << SKETCH_BITS, np.int64)
    sketch[rows["slot"].to_numpy()] = rows["n"].to_numpy()
    return sketch, docs.count()


def idf_table(sketch: np.ndarray, documents: int) -> np.ndarray:
    """Inverse document frequency of each slot, dampened: log2(2 + ln(documents / frequency)).

    Dampening keeps a common passage and a rare one within a factor of four, so copies of
    a text that thousands share are still alike to about what they are word by word.
    """
    idf = np.maximum(0.0, np.log((1 + documents) / (1 + sketch)))
    return np.log2(2 + idf).astype(np.float32)


def weighted_shingles(text: str | None, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(shingle hashes ascending, weights) of a whole text; texts of 1 to 4 words are one shingle."""
    words = word_hashes(text.encode()) if text else np.zeros(0, np.uint64)
    if not len(words):
        return np.zeros(0, np.uint64), np.zeros(0, np.float32)
    size = min(WORDS, len(words))
    shingles = run_hashes(words, size)
    rarity = idf[(words >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)]
    mean = sum(rarity[k : len(rarity) - size + 1 + k] for k in range(size)) / np.float32(size)
    found, first, counts = np.unique(shingles, return_index=True, return_counts=True)
    return found, (mean[first] * counts).astype(np.float32)


def weighted_jaccard(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Sum of smaller weights over sum of larger weights; 0 if a text has no shingle."""
    if not len(a[0]) or not len(b[0]):
        return 0.0
    _, i, j = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    small = float(np.minimum(a[1][i], b[1][j]).sum(dtype=np.float64))
    return small / (float(a[1].sum(dtype=np.float64)) + float(b[1].sum(dtype=np.float64)) - small)


class Sampler:
    """Consistent weighted samples: the quantiles of their distributions are tabulated."""

    def __init__(self, samples: int):
        p = (np.arange(1 << 16) + 0.5) / (1 << 16)
        x = np.linspace(0, 30, 400_001)
        # a sum of two exponential variables
        gamma = np.interp(p, 1 - np.exp(-x) * (1 + x), x)
        self.r, self.inverse_r = gamma.astype(np.float32), (1 / gamma).astype(np.float32)
        self.log_c = np.log(gamma).astype(np.float32)
        self.seeds = mix(np.arange(1, samples + 1, dtype=np.uint64) * np.uint64(_SEED))

    def samples(self, shingles: np.ndarray, weights: np.ndarray) -> np.ndarray:
        """One 64-bit value a sample; equal values mean the same shingle at the same level."""
        k = len(self.seeds)
        best, value = np.full(k, np.inf, np.float32), np.zeros(k, np.uint64)
        log_w = np.log(weights)
        rows = np.arange(k)
        for at in range(0, len(shingles), 512):
            s, w = shingles[at : at + 512], log_w[at : at + 512]
            u = (s[None, :] ^ self.seeds[:, None]) * np.uint64(0xD6E8FEB86659FD93)
            u ^= u >> np.uint64(32)
            u *= np.uint64(0xBF58476D1CE4E5B9)
            high, low = (u >> np.uint64(48)).astype(np.int32), ((u >> np.uint64(32)) & np.uint64(0xFFFF)).astype(np.int32)
            beta = ((u >> np.uint64(8)) & np.uint64(0xFFFFFF)).astype(np.float32) * np.float32(2**-24)
            r = self.r[high]
            t = np.floor(w * self.inverse_r[high] + beta)
            rank = self.log_c[low] - r * (t - beta + 1)
            least = rank.argmin(axis=1)
            better = rank[rows, least] < best
            best = np.where(better, rank[rows, least], best)
            level = t[rows, least].astype(np.int64).astype(np.uint64)
            value = np.where(better, mix(s[least] + level * np.uint64(_SEED)), value)
        return value


def band_keys(samples: np.ndarray, bands: int, rows: int) -> list[int]:
    """One signed 64-bit key a band."""
    grid = samples.reshape(bands, rows)
    key = np.arange(1, bands + 1, dtype=np.uint64)
    for k in range(rows):
        key = mix(key * np.uint64(_SEED) + grid[:, k])
    return key.view(np.int64).tolist()


def _text_classes(docs: DataFrame, idf, bands: int, rows: int) -> DataFrame:
    """(key, t1, t2, rep, keys): one row per different text with words; rep is its smallest id."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, sampler = idf.value, Sampler(bands * rows)
        for b in batches:
            keys = []
            for text in texts_of(b["text"]):
                shingles, weights = weighted_shingles(text, table)
                keys.append(band_keys(sampler.samples(shingles, weights), bands, rows) if len(shingles) else None)
            same = {c: b[c] for c in ("_id", "t1", "t2")}
            yield pa.RecordBatch.from_pydict(same | {"keys": pa.array(keys, pa.list_(pa.int64()))})

    signed = docs.mapInArrow(sign, "_id long, t1 long, t2 long, keys array<long>").where("keys is not null")
    classes = signed.groupBy("t1", "t2").agg(F.min("_id").alias("rep"), F.first("keys").alias("keys"))
    return settle(with_uid(classes, "key"))


def _joined(rows: list[tuple[np.ndarray, ...]]) -> pa.RecordBatch:
    """Rows (s, key, weight) of several texts in one batch."""
    return pa.RecordBatch.from_pydict(dict(zip(("s", "key", "weight"), map(np.concatenate, zip(*rows)))))


def _can_link(texts: DataFrame, idf, least: float) -> DataFrame:
    """(key, rep, total, common, parts): texts that can be alike to another to ``least``, with their weights.

    ``common`` is what the shingles weigh that another of ``texts`` has too. Two texts share
    at most that, so a text of which less than ``least`` is common is alike to no other and
    is left out; ``_near_enough`` bounds pairs in the same way. ``parts`` are the weights
    summed by a hash of the shingle: texts share at most the smaller sum of each part.
    """

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = idf.value
        for b in batches:
            waiting, held = [], 0
            for key, text in zip(b["key"].to_pylist(), texts_of(b["text"])):
                shingles, weights = weighted_shingles(text, table)
                waiting.append((shingles.view(np.int64), np.full(len(shingles), key, np.int64), weights))
                held += len(shingles)
                if held >= ROWS_SENT:
                    yield _joined(waiting)
                    waiting, held = [], 0
            if held:
                yield _joined(waiting)

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = idf.value
        for b in batches:
            totals, parts = np.zeros(b.num_rows), np.zeros((b.num_rows, PARTS), np.float32)
            for k, text in enumerate(texts_of(b["text"])):
                shingles, weights = weighted_shingles(text, table)
                totals[k] = weights.sum(dtype=np.float64)
                part = (mix(shingles) % np.uint64(PARTS)).astype(np.int64)
                parts[k] = np.bincount(part, weights, PARTS)
            ends = pa.array(np.arange(b.num_rows + 1, dtype=np.int32) * PARTS)
            lists = pa.ListArray.from_arrays(ends, pa.array(parts.reshape(-1)))
            yield pa.RecordBatch.from_pydict({"key": b["key"], "rep": b["rep"], "total": totals, "parts": lists})

    shingles = texts.mapInArrow(spread, "s long, key long, weight float")
    alone = (
        shingles.groupBy("s").agg(F.count("*").alias("n"), F.first("key").alias("key"), F.first("weight").alias("weight"))
        .where("n = 1").groupBy("key").agg(F.sum("weight").alias("alone"))
    )
    weighed = texts.mapInArrow(weigh, "key long, rep long, total double, parts array<float>").join(alone, "key", "left").select(
        "key", "rep", "total", (F.col("total") - F.coalesce("alone", F.lit(0.0))).alias("common"), "parts"
    )
    return weighed.where(F.col("common") >= F.col("total") * (least - _ROUNDING))


def _near_enough(total: str, common: str, other_total: str, other_common: str, least: float) -> Column:
    """Whether two texts may be alike: the smaller common part over what is left of both."""
    most = F.least(common, other_common)
    return most * (1 + least) >= (F.col(total) + F.col(other_total)) * (least - _ROUNDING)


def _parts_agree(total: str, parts: str, other_total: str, other_parts: str, least: float) -> Column:
    """Whether two texts may be alike: the smaller sums of all parts over what is left of both."""
    shared = F.aggregate(F.zip_with(parts, other_parts, lambda x, y: F.least(x, y).cast("double")), F.lit(0.0), lambda s, x: s + x)
    return shared * (1 + least) >= (F.col(total) + F.col(other_total)) * (least - _ROUNDING)


def _verified(pairs: DataFrame, texts: DataFrame, idf, least: float) -> DataFrame:
    """(group, other) of those (a, b) whose texts are alike to ``least`` or more."""

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = idf.value
        known: tuple = (None, None)
        for b in batches:
            good = np.zeros(b.num_rows, bool)
            for k, (a, x, y) in enumerate(zip(b["a"].to_pylist(), texts_of(b["text_a"]), texts_of(b["text_b"]))):
                if known[0] != a:
                    known = (a, weighted_shingles(x, table))
                good[k] = weighted_jaccard(known[1], weighted_shingles(y, table)) >= least
            yield b.select(["group", "other"]).filter(pa.array(good))

    left = texts.select(F.col("key").alias("a"), F.col("text").alias("text_a"))
    right = texts.select(F.col("key").alias("b"), F.col("text").alias("text_b"))
    # a text that leads many pairs makes a skewed join, which adaptive execution splits
    both = pairs.join(right, "b").join(left, "a")
    return settle(both.mapInArrow(check, "group long, other long"))


def _across(rows: DataFrame, turn: int) -> DataFrame:
    """Bucket rows of buckets that still hold several groups, with figures and a leader.

    The leader is the smallest member of one group, another every turn. Rows are dealt by
    bucket once, for both counts and the join.
    """
    rows = rows.repartition("band", "h")
    lead = F.min_by(F.col("first"), F.xxhash64("first.key", F.lit(turn)))
    first = F.min(F.struct("key", "total", "common", "group")).alias("first")
    buckets = (
        rows.groupBy("band", "h", "group").agg(F.count("*").alias("m"), first)
        .groupBy("band", "h").agg(
            F.sum("m").alias("members"), F.sum(F.col("m") * F.col("m")).alias("inside"), F.count("*").alias("groups"),
            lead.alias("l"),
        )
        .where("groups > 1")
        .select(
            "band", "h", "members", "inside", F.col("l.key").alias("lead"), F.col("l.total").alias("lead_total"),
            F.col("l.common").alias("lead_common"), F.col("l.group").alias("lead_group"),
        )
    )
    return rows.join(buckets, ["band", "h"])


def _keyed(docs: DataFrame) -> DataFrame:
    """``docs`` with the key of a row: its id, with a number for null, and both hashes of its text."""
    return docs.withColumns({
        "_id": F.coalesce(F.col("doc_id").cast("long"), F.lit(_NO_ID)),
        "t1": F.xxhash64("text"), "t2": F.xxhash64(F.lit(1), "text"),
    })


def near_texts(
    docs: DataFrame, least: float = SIMILARITY, bands: int = BANDS, rows: int = ROWS
) -> DataFrame:
    """(doc_id, component_id, kept) for every row of ``docs``, which has (doc_id, text).

    Documents linked by a chain of similar texts share the smallest doc_id as
    component_id, and only the document of that id is kept. Equal texts are one text, so
    copies are never paired. Texts without a word, and null texts, link with nothing.
    Null ids stand before all others, together as one document, and come out as null.
    Rows that repeat an id share its fate.

    Texts that share a bucket are candidates. Those that are mostly of their own cannot
    link and are set aside. The others of a bucket are first paired with one leader; while
    that merges groups, leaders of the groups left over follow, and at last all pairs of a
    bucket that are not yet in one group are verified, so no pair is passed over.
    """
    shown = lambda c: F.when(F.col(c) != _NO_ID, F.col(c))
    return _row_groups(docs, least, bands, rows).select(
        shown("_id").alias("doc_id"), shown("component").alias("component_id"),
        (F.col("component") == F.col("_id")).alias("kept"),
    )


def one_of_each(
    docs: DataFrame, least: float = SIMILARITY, bands: int = BANDS, rows: int = ROWS
) -> DataFrame:
    """``docs`` with one row of each group of ``near_texts``; rows without words all stay.

    It is the row of the smallest id (null first), then of the smallest text hashes; rows
    are told apart by id and text, so an id that repeats with other texts loses none of
    them. Of rows that repeat both, one stays.
    """
    names = docs.columns
    found = settle(
        _row_groups(docs.select("doc_id", "text"), least, bands, rows).where(F.col("group").isNotNull())
        .groupBy("group", "_id", "t1", "t2").agg(F.count("*").alias("_n"))
    )
    key = F.struct("_id", "t1", "t2")
    best = found.groupBy("group").agg(F.min(key).alias("best"))
    told = found.join(best, "group").select("_id", "t1", "t2", "_n", (key == F.col("best")).alias("_best"))
    gone = broadcast_if_small(settle(told.where(~F.col("_best") | (F.col("_n") > 1))))
    tagged = docs.select(*[F.col(f"`{c}`").alias(f"_c{k}") for k, c in enumerate(names)], "doc_id", "text")
    keyed = _keyed(tagged)
    # kept rows that stand more than once are few; only those are dealt by their key
    again = gone.where("_best").select("_id", "t1", "t2")
    single = keyed.join(gone.select("_id", "t1", "t2"), ["_id", "t1", "t2"], "left_anti")
    once = keyed.join(again, ["_id", "t1", "t2"], "left_semi").dropDuplicates(["_id", "t1", "t2"])
    return single.unionByName(once).select(*[F.col(f"_c{k}").alias(c) for k, c in enumerate(names)])


def _row_groups(docs: DataFrame, least: float, bands: int, rows: int) -> DataFrame:
    """(_id, t1, t2, component, group) for every row; ``group`` is null for a text without words.

    Groups that share the smallest id have one component, but never one ``group``.
    """
    spark = docs.sparkSession
    keyed = narrow_batches(_keyed(docs.select("doc_id", "text")).select("_id", "t1", "t2", "text"))
    # a fixed number of slots, whatever the corpus
    idf = spark.sparkContext.broadcast(idf_table(*document_frequencies(docs)))
    classes = _text_classes(keyed, idf, bands, rows)
    entries = classes.select("key", F.posexplode("keys").alias("band", "h"))
    shared = entries.groupBy("band", "h").agg(F.count("*").alias("n")).where("n > 1").select("band", "h")
    buckets = settle(entries.join(shared, ["band", "h"]))
    involved = settle(buckets.select("key").distinct().join(classes, "key").select("key", "t1", "t2", F.col("rep").alias("_id")))
    texts = settle(
        keyed.join(broadcast_if_small(involved), ["_id", "t1", "t2"])
        .select("key", F.col("_id").alias("rep"), "text").dropDuplicates(["key"])
    )
    weighed = settle(_can_link(texts, idf, least))
    groups = weighed.select("key", "rep", F.col("key").alias("group"))
    entered = buckets.join(weighed.select("key", "total", "common"), "key").withColumn("group", F.col("key"))
    left_before, turn = None, 0
    while True:
        turn += 1
        rows_now = settle(_across(entered, turn))
        # pairs across groups, each counted from both ends and once for every member
        open_pairs, members = rows_now.agg(
            F.coalesce(F.sum(F.expr("(members * members - inside) / members")), F.lit(0.0)), F.count("*")
        ).first()
        if not members:
            break
        last = open_pairs <= 4 * members or (left_before is not None and open_pairs > 0.9 * left_before)
        left_before = open_pairs
        if last:
            summed = rows_now.join(weighed.select("key", "parts"), "key").join(classes.select("key", "keys"), "key")
            mine = summed.select("band", "h", F.col("key").alias("a"), "group", "total", "common", "keys", "parts")
            other = summed.select(
                "band", "h", F.col("key").alias("b"), F.col("group").alias("other"), F.col("total").alias("total_b"),
                F.col("common").alias("common_b"), F.col("keys").alias("keys_b"), F.col("parts").alias("parts_b"),
            )
            # a pair counts in the first band that both share
            earlier = F.expr("exists(slice(zip_with(keys, keys_b, (x, y) -> x = y), 1, band), same -> same)")
            pairs = mine.join(other, ["band", "h"]).where(
                F.expr("a < b and `group` <> other") & _near_enough("total", "common", "total_b", "common_b", least) & ~earlier
                & _parts_agree("total", "parts", "total_b", "parts_b", least)
            ).select("a", "b", "group", "other")
        else:
            apart = F.col("group") != F.col("lead_group")
            pairs = rows_now.where(apart & _near_enough("total", "common", "lead_total", "lead_common", least)).select(
                F.col("lead").alias("a"), F.col("key").alias("b"), "group", F.col("lead_group").alias("other")
            )
        found = _verified(pairs.distinct(), texts, idf, least)
        merged = stars(found).select(F.col("u").alias("group"), "v")
        groups = settle(groups.join(merged, "group", "left").select("key", "rep", F.coalesce("v", "group").alias("group")))
        if last:
            break
        # buckets of one group stay so, and are not looked at again
        entered = rows_now.join(merged, "group", "left").select(
            "band", "h", "key", "total", "common", F.coalesce("v", "group").alias("group")
        )
    # those that stay alone are missing here and stand for themselves below
    smallest = groups.groupBy("group").agg(F.min("rep").alias("smallest"), F.count("*").alias("n")).where("n > 1")
    named = groups.join(smallest, "group").select("key", "smallest", "group")
    known = classes.join(named, "key", "left").select(
        "t1", "t2", F.coalesce("smallest", "rep").alias("component"), F.coalesce("group", "key").alias("group")
    )
    return keyed.select("_id", "t1", "t2").join(known, ["t1", "t2"], "left").withColumn(
        "component", F.coalesce("component", "_id")
    )
