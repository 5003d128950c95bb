"""Licence scans by a positional index of the rarest licence words.

The index lists, for each licence template, its words of highest inverse document frequency
with their positions. Every place of such a word in a file proposes an alignment: the place
where the template would begin. The other posted words are looked up at the same relative
position, the whole template is weighed there, and the mandatory phrases have the last word.

A template that asks for a share s of its weight posts its rarest words until they weigh more
than 1 - s together: an alignment that holds none of them cannot reach s. So nothing is
missed, while words such as "the" or "by" are never looked up. Everything is DataFrame functions.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ecoledger.llm.common import let
from ecoledger.session import settle

# Letters that are lower-cased, and what separates words.
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
BETWEEN_WORDS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"

# Words by which a mandatory phrase may stand off its place in the template.
SLACK = 2
# Weights are whole numbers, so that sums do not depend on their order.
_WEIGHT_UNIT = 1000


@dataclass(frozen=True)
class Template:
    """A licence text in words, the phrases it must hold, and the share of its weight to find.

    A ``base`` template is a plain phrase: all of it must stand, and its places are counted.
    """

    label: str
    text: str
    phrases: tuple[str, ...] = ()
    share: float = 0.5
    base: bool = False

    @property
    def words(self) -> list[str]:
        return self.text.split()


# The three base phrases, then well-known notices in lower-case words.
TEMPLATES = (
    Template("cc-by", "cc by", share=1.0, base=True),
    Template("gpl", "general public license", share=1.0, base=True),
    Template("reserved", "all rights reserved", share=1.0, base=True),
    Template("apache-2.0", "licensed under the apache license version 2 0", ("apache license", "2 0")),
    Template("bsd", "redistribution and use in source and binary forms with or without modification are permitted",
             ("redistribution and use", "source and binary forms")),
    Template("cc-by-nc", "licensed under cc by nc 4 0", ("cc by nc",)),
    Template("cc-by-sa", "licensed under cc by sa 4 0", ("cc by sa",)),
    Template("cc0", "to the extent possible under law the author has waived all copyright and related or neighboring rights",
             ("waived all copyright",)),
    Template("gpl-3.0", "this work is licensed under the gnu general public license version 3",
             ("gnu general public license", "version 3")),
    Template("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee",
             ("use copy modify", "with or without fee")),
    Template("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software",
             ("permission is hereby granted", "free of charge")),
    Template("mpl-2.0", "this source code form is subject to the terms of the mozilla public license v 2 0",
             ("mozilla public license",)),
    Template("unlicense", "this is free and unencumbered software released into the public domain",
             ("released into the public domain",)),
)


def words_of(text: Column) -> Column:
    """Array of the words of a text, A to Z lower-cased; null and empty texts have none."""
    lowered = F.translate(F.coalesce(text, F.lit("")), _UPPER, _UPPER.lower())
    return F.filter(F.split(lowered, BETWEEN_WORDS), lambda w: w != "")


def weights(docs: DataFrame, templates: tuple[Template, ...] = TEMPLATES) -> DataFrame:
    """(word, weight): inverse document frequency of every template word over all documents.

    A thousand times the logarithm of documents by documents with the word, rounded; 1 at
    least. One row per template word, however large the corpus.
    """
    vocabulary = sorted({w for t in templates for w in t.words})
    # the empty string is no word; it stands for the document itself
    present = F.array_append(F.array_intersect(words_of(F.col("text")), F.array(*map(F.lit, vocabulary))), F.lit(""))
    counted = docs.select(F.explode(present).alias("word")).groupBy("word").agg(F.count("*").alias("docs"))
    known = docs.sparkSession.createDataFrame([(w,) for w in [*vocabulary, ""]], "word string")
    # no more rows than the templates have words
    of_all = Window.partitionBy(F.lit(0))
    held = F.coalesce("docs", F.lit(0)) + 1
    ratio = F.max(F.when(F.col("word") == "", held)).over(of_all) / held
    return known.join(counted, "word", "left").select(
        "word", F.greatest(F.round(F.log(ratio) * _WEIGHT_UNIT), F.lit(1)).cast("long").alias("weight")
    )


def rare_word_index(
    spark: SparkSession, weight: DataFrame, templates: tuple[Template, ...] = TEMPLATES
) -> DataFrame:
    """One row per posting: (word, at, rank, label, base, share, words, weights, anchors, phrases).

    ``word`` stands at position ``at`` of the template and is its ``rank``-th rarest posted
    word. The rest describes the whole template: its words and their weights, the positions
    of its posted words by rank, and its phrases as (at, words). The index has at most as
    many rows as the templates have words.
    """
    rows = [
        (k, t.label, t.base, t.share, [_phrase(t, p) for p in t.phrases], at, w)
        for k, t in enumerate(templates) for at, w in enumerate(t.words)
    ]
    known = spark.createDataFrame(
        rows, "id int, label string, base boolean, share double, phrases array<struct<at:int,words:array<string>>>, at int, word string"
    )
    template = Window.partitionBy("id")
    rarest = template.orderBy(F.desc("weight"), "at")
    weighed = known.join(weight, "word").select(
        "*", F.row_number().over(rarest).alias("rank"),
        F.sum("weight").over(template).alias("whole"),
        F.coalesce(F.sum("weight").over(rarest.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("rarer"),
    )
    # posted until the words before weigh more than what an accepted alignment may lack
    posted = F.col("rarer") <= F.col("whole") * (1 - F.col("share"))
    by_place = F.array_sort(F.collect_list(F.struct("at", "word", "weight")).over(template))
    by_rank = F.array_sort(F.collect_list(F.when(posted, F.struct("rank", "at"))).over(template))
    return weighed.select(
        "word", "at", "rank", "label", "base", "share", "whole", "phrases",
        by_place["word"].alias("words"), by_place["weight"].alias("weights"), by_rank["at"].alias("anchors"),
        posted.alias("posted"),
    ).where("posted").drop("posted")


def _phrase(template: Template, phrase: str) -> tuple[int, list[str]]:
    """Where a phrase begins in its template, and its words."""
    words, wanted = template.words, phrase.split()
    return next((k for k in range(len(words)) if words[k : k + len(wanted)] == wanted)), wanted


def _places(words: Column, posted: list[str], reach: int) -> Column:
    """Array of (place, word, around): where posted words stand, with ``reach`` words to each side."""
    at = F.filter(
        F.transform(words, lambda w, i: F.when(w.isin(posted), i)), lambda i: i.isNotNull()
    )
    return F.transform(
        at,
        lambda i: F.struct(
            i.cast("long").alias("place"), F.get(words, i).alias("word"),
            F.least(i, F.lit(reach)).alias("left"),
            F.slice(words, F.greatest(i - reach, F.lit(0)) + 1, F.lit(2 * reach + 1)).alias("around"),
        ),
    )


def scan(docs: DataFrame, templates: tuple[Template, ...] = TEMPLATES) -> DataFrame:
    """(doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score) of every row.

    ``n_base`` counts the places of base phrases, ``first_word`` and ``last_word`` are the
    smallest and largest place where one begins (words from 0; null if there is none). Labels
    are sorted and joined by commas; ``base_labels`` are those of base phrases, ``labels``
    also those of templates that stand with all their phrases and their share of weight.
    ``score`` is the largest share of weight of an accepted alignment, rounded to 6 digits; 0
    if there is none. Null texts count as empty; repeated rows and null ids have rows of their own. Columns
    besides doc_id and text are left behind. The table is read twice: for document
    frequencies, and for the scan, whose one shuffle carries a narrow row per document.
    """
    texts = docs.select("doc_id", "text")
    index = settle(rare_word_index(docs.sparkSession, weights(texts, templates), templates))
    # bounded by the templates: no more words than they have
    posted = sorted(r.word for r in index.select("word").distinct().collect())
    reach = max(len(t.words) for t in templates) + SLACK
    found = texts.select(
        F.monotonically_increasing_id().alias("uid"), F.col("doc_id").cast("long").alias("doc_id"),
        let(words_of(F.col("text")), lambda words: F.struct(
            F.size(words).cast("long").alias("n_words"), _places(words, posted, reach).alias("places")
        )).alias("found"),
    )
    places = found.select("uid", "doc_id", "found.n_words", F.explode_outer("found.places").alias("p"))
    proposed = places.select("uid", "doc_id", "n_words", "p.*").join(F.broadcast(index), "word", "left")
    weighed = proposed.withColumn("start", F.col("place") - F.col("at")).withColumn("hits", _hits())
    # the rarest posted word that stands at this alignment reports it
    leads = F.element_at(F.filter("anchors", lambda a: F.get("hits", a)), 1) == F.col("at")
    gained = F.aggregate(
        F.zip_with("hits", "weights", lambda hit, w: F.when(hit, w).otherwise(F.lit(0).cast("long"))),
        F.lit(0).cast("long"), lambda a, b: a + b,
    )
    share = F.col("gained") / F.col("whole")
    accepted = (share >= F.col("share")) & F.forall("phrases", _stands)
    marked = weighed.where(F.col("label").isNull() | leads).withColumn("gained", gained).select(
        "uid", "doc_id", "n_words", "start", "label", share.alias("found_share"),
        (accepted & F.col("base")).alias("is_base"), accepted.alias("accepted"),
    )

    def labels(condition: str) -> Column:
        return F.array_join(F.array_sort(F.collect_set(F.when(F.col(condition), F.col("label")))), ",")

    base_start = F.when(F.col("is_base"), F.col("start"))
    # all rows of a document are in one task, so the map side leaves one row each
    return marked.groupBy("uid").agg(
        F.first("doc_id").alias("doc_id"), F.first("n_words").alias("n_words"),
        F.count_if("is_base").alias("n_base"),
        F.min(base_start).alias("first_word"), F.max(base_start).alias("last_word"),
        labels("is_base").alias("base_labels"), labels("accepted").alias("labels"),
        F.round(F.coalesce(F.max(F.when(F.col("accepted"), F.col("found_share"))), F.lit(0.0)), 6).alias("score"),
    ).drop("uid")


def _hits() -> Column:
    """Which template words stand at the alignment of a place."""
    return F.transform(
        "words",
        lambda w, k: F.coalesce(_around(F.col("left") - F.col("at") + k) == w, F.lit(False)),
    )


def _around(k: Column) -> Column:
    """The k-th of the words around a place; null beyond either end."""
    return F.when(k >= 0, F.get("around", k))


def _stands(phrase: Column) -> Column:
    """Whether a phrase stands at its place in the alignment, or up to ``SLACK`` words off it."""
    first = F.col("left") - F.col("at") + phrase["at"]
    return F.exists(
        F.sequence(F.lit(-SLACK), F.lit(SLACK)),
        lambda off: F.forall(
            F.transform(phrase["words"], lambda w, k: F.coalesce(_around(first + off + k) == w, F.lit(False))),
            lambda hit: hit,
        ),
    )
