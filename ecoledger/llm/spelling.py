"""Spelling variants: pairs of words one edit apart, by composition of finite-state machines.

The vocabulary is an acceptor, minimised; one edit is a transducer with two states (none
made yet, one made). Acceptor, transducer and acceptor again are composed lazily: a composed
state is a pair of vocabulary states and the edit's state, and every accepted path spells a
pair of near words. Before the edit both sides are in the same state, so the composition
walks the acceptor itself; after it the two right languages are intersected.

The work is dealt by initial states. Words of six letters or more that are one edit apart
share their first three letters or their last three, so one composition starts in each state
that three letters lead to, and a second one, over reversed words, in each state that three
last letters lead to. A crowded state is split: its pairs agree in one half or the other of
what is free, which halves the free part until it is one letter.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ecoledger.llm.common import groups_of
from ecoledger.session import broadcast_if_small, settle

# Letters of a run, and the share of runs that lose a letter (one in so many).
RUN_PATTERN = "[A-Za-zÀ-ÿ]+"
LOSS_ONE_IN = 199
LEAST_LETTERS = 6
LEAST_COUNT = 5
FORM_RATIO = 5

# Words beyond which the composition of one initial state is split.
CROWDED = 20_000
# How compositions are dealt: so many words a task, until there are that many tasks.
WORDS_PER_TASK = 20_000
MOST_TASKS = 20_000
_HALF = LEAST_LETTERS // 2
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
# Lengths of accepted rests are kept modulo this many bits: a quick test for no common rest.
_RING = 61


def word_counts(
    docs: DataFrame, loss_one_in: int = LOSS_ONE_IN, least_letters: int = LEAST_LETTERS, least: int = LEAST_COUNT
) -> DataFrame:
    """(word, n): every word of at least ``least_letters`` that occurs ``least`` times or more.

    Words are maximal runs of Latin letters, A to Z lower-cased. A run whose hash with the
    document's id is divisible by ``loss_one_in`` loses the letter its hash names. A null text
    has no words; a null id counts as the empty string.
    """
    # shorter runs cannot give a word that is long enough
    long_runs = RUN_PATTERN.removesuffix("+") + f"{{{least_letters},}}"
    runs = docs.select(
        F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"),
        F.explode(F.regexp_extract_all("text", F.lit(long_runs), F.lit(0))).alias("run"),
    ).select("id", F.translate("run", _UPPER, _UPPER.lower()).alias("run"))
    hashed = runs.select("run", F.crc32(F.concat("id", F.lit(":"), "run")).alias("h"))
    at = (F.col("h") % F.length("run")).cast("int")
    lost = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.length("run")))
    word = F.when(F.col("h") % loss_one_in == 0, lost).otherwise(F.col("run"))
    return (
        hashed.select(word.alias("word")).where(F.length("word") >= least_letters)
        .groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= least)
    )


class Acceptor:
    """Minimised acceptor of sorted words: ``arcs[state]`` maps letters to states."""

    def __init__(self, words: list[str]):
        self.arcs: list[dict[str, int]] = [{}]
        self.final: list[bool] = [False]
        self.rests: list[int] = [0]
        self._known: dict[tuple, int] = {}
        path, last = [0], ""
        for word in words:
            shared = 0
            for x, y in zip(word, last):
                if x != y:
                    break
                shared += 1
            self._close(path, last, shared)
            for letter in word[shared:]:
                self.arcs.append({})
                self.final.append(False)
                self.rests.append(0)
                self.arcs[path[-1]][letter] = len(self.arcs) - 1
                path.append(len(self.arcs) - 1)
            self.final[path[-1]] = True
            last = word
        self._close(path, last, 0)
        self.start = 0
        self._sum_rests(0)

    def _sum_rests(self, state: int) -> None:
        ring = (1 << _RING) - 1
        lengths = int(self.final[state])
        for target in self.arcs[state].values():
            lengths |= (self.rests[target] << 1 | self.rests[target] >> (_RING - 1)) & ring
        self.rests[state] = lengths

    def _close(self, path: list[int], word: str, depth: int) -> None:
        """Merge the states below ``depth`` of the last word with equal ones."""
        while len(path) - 1 > depth:
            state = path.pop()
            letter = word[len(path) - 1]
            same = (self.final[state], *self.arcs[state].items())
            kept = self._known.setdefault(same, state)
            if kept == state:
                self._sum_rests(state)
            else:
                self.arcs[path[-1]][letter] = kept
                if state == len(self.arcs) - 1:
                    self.arcs.pop(), self.final.pop(), self.rests.pop()

    def common_rests(self, a: int, b: int, barred: str | None = None) -> Iterator[str]:
        """What both states accept, except what begins with ``barred``."""
        arcs, final, rests = self.arcs, self.final, self.rests
        stack, spelt = [(a, b, 0, "")], []
        while stack:
            a, b, depth, letter = stack.pop()
            if depth:
                del spelt[depth - 1 :]
                spelt.append(letter)
            if final[a] and final[b]:
                yield "".join(spelt)
            here, there = arcs[a], arcs[b]
            if len(here) > len(there):
                here, there = there, here
            for letter in here:
                if letter in there and (depth or letter != barred):
                    x, y = here[letter], there[letter]
                    if rests[x] & rests[y]:
                        stack.append((x, y, depth + 1, letter))

    def near_pairs(self, until: int | None = None) -> Iterator[tuple[str, str]]:
        """All accepted pairs of the composition, each once; only those that part within ``until`` letters.

        A pair is found where its words part: there one side reads a letter that the other
        reads differently (replacement) or not at all (insertion).
        """
        arcs, rests = self.arcs, self.rests
        stack, spelt = [(self.start, 0, "")], []
        while stack:
            state, depth, letter = stack.pop()
            if depth:
                del spelt[depth - 1 :]
                spelt.append(letter)
            out = list(arcs[state].items())
            for k, (x, a) in enumerate(out):
                if until is None or depth + 1 < until:
                    stack.append((a, depth + 1, x))
                for y, b in out[k + 1 :]:
                    if rests[a] & rests[b]:
                        for rest in self.common_rests(a, b):
                            before = "".join(spelt)
                            yield before + x + rest, before + y + rest
                if rests[state] & rests[a]:
                    for rest in self.common_rests(state, a, barred=x):
                        before = "".join(spelt)
                        yield before + rest, before + x + rest


def _shared_start(u: str, v: str) -> int:
    n = 0
    for x, y in zip(u, v):
        if x != y:
            break
        n += 1
    return n


_FOUND = "word string, n long, n_near long, near_n long, near string"


def _compose(group: pd.DataFrame) -> pd.DataFrame:
    """Near words of one initial state: per word how many, and the most frequent one."""
    head, tail, limit, length = (int(group[c].iloc[0]) for c in ("head", "tail", "before", "length"))
    words, counts = group["word"].tolist(), group["n"].tolist()
    of = dict(zip(words, counts))
    backwards = head == 0
    start, end = words[0][:head], words[0][len(words[0]) - tail :]
    if backwards:
        free = sorted(w[: len(w) - tail][::-1] for w in words)
    else:
        free = sorted(w[head : len(w) - tail] for w in words)
    found: dict[str, tuple[int, int, str]] = {}

    def see(word: str, near: str) -> None:
        n, best_n, best = found.get(word, (0, -1, ""))
        near_n = of[near]
        if near_n > best_n or (near_n == best_n and near < best):
            best_n, best = near_n, near
        found[word] = (n + 1, best_n, best)

    # read forwards, words that part beyond the limit need not be walked
    for u, v in Acceptor(free).near_pairs(None if backwards else limit - head):
        if backwards:
            u, v = u[::-1], v[::-1]
        u, v = start + u + end, start + v + end
        # pairs that share more of their start, or are shorter, are found in another state
        if _shared_start(u, v) < limit and (not length or max(len(u), len(v)) == length):
            see(u, v)
            see(v, u)
    rows = [found.get(w, (0, None, None)) for w in words]
    return pd.DataFrame(
        {
            "word": words, "n": counts, "n_near": [r[0] for r in rows],
            "near_n": pd.array([r[1] for r in rows], "Int64"), "near": [r[2] for r in rows],
        }
    )


_NO_LIMIT = (1 << 31) - 1


def _halved(crowd: DataFrame) -> DataFrame:
    """Each member of crowded states in two states of half the free part.

    States get a common length first: words of a pair are of that length, or one of them is
    one letter shorter.
    """
    sized = crowd.where("length > 0").unionByName(
        crowd.where("length = 0").withColumn("length", F.explode(F.array(F.length("word"), F.length("word") + 1)))
    )
    half = F.floor((F.col("length") - F.col("head") - F.col("tail")) / 2).cast("int")
    stepped = sized.withColumn("half", half)
    fore = stepped.withColumn("head", F.col("head") + F.col("half"))
    rear = stepped.withColumns(
        {"tail": F.col("tail") + F.col("half"), "before": F.least("before", F.col("head") + F.col("half"))}
    )
    return _states(fore.unionByName(rear).select("word", "n", "head", "tail", "before", "length"))


def _states(members: DataFrame) -> DataFrame:
    """Name the initial state of each member by the letters that lead to it and from it."""
    return members.withColumns(
        {
            "from": F.substring("word", F.lit(1), F.col("head")),
            "to": F.substring("word", F.length("word") - F.col("tail") + 1, F.col("tail")),
        }
    )


_STATE = ("head", "tail", "before", "length", "from", "to")


def near_words(vocabulary: DataFrame, crowded: int = CROWDED) -> DataFrame:
    """(word, n, n_near, near, near_n): for each word how many are one edit away, and the most frequent of them.

    ``vocabulary`` has distinct words of six letters or more and their counts ``n``. An edit
    inserts, deletes or replaces one code point. Of equally frequent near words the smallest
    counts. ``near`` and ``near_n`` are null where no word is near. Every word goes to two
    initial states. States of more than ``crowded`` words are split, round by round, while
    there is a free part of two letters to split; so one task never holds more than
    ``crowded`` words or those that differ in one letter. An empty vocabulary gives no rows.
    """
    words = settle(vocabulary.select("word", F.col("n").cast("long").alias("n")))
    either = F.array(
        F.struct(F.lit(_HALF).alias("head"), F.lit(0).alias("tail"), F.lit(_NO_LIMIT).alias("before")),
        F.struct(F.lit(0).alias("head"), F.lit(_HALF).alias("tail"), F.lit(_HALF).alias("before")),
    )
    members = _states(words.select("word", "n", F.inline(either)).withColumn("length", F.lit(0)))
    fit: list[DataFrame] = []
    while True:
        sizes = members.groupBy(*_STATE).agg(F.count("*").alias("size"))
        splits = (F.col("length") == 0) | (F.col("length") - F.col("head") - F.col("tail") > 1)
        # few, however large the vocabulary: each has more than ``crowded`` members
        hot = settle(sizes.where((F.col("size") > crowded) & splits).select(*_STATE))
        if hot.isEmpty():
            fit.append(members)
            break
        few = broadcast_if_small(hot)
        fit.append(members.join(few, list(_STATE), "left_anti"))
        members = settle(_halved(members.join(few, list(_STATE), "left_semi")))
    # small in bytes, long in work: dealt by rows, not by the size of the exchange
    tasks = min(groups_of(2 * words.count(), WORDS_PER_TASK), MOST_TASKS)
    found = [m.repartition(tasks, *_STATE).groupBy(*_STATE).applyInPandas(_compose, _FOUND) for m in fit]
    every = found[0]
    for more in found[1:]:
        every = every.unionByName(more)
    # larger counts first, then smaller words
    best = F.min(F.when(F.col("near").isNotNull(), F.struct((-F.col("near_n")).alias("less"), "near")))
    return every.groupBy("word").agg(
        F.max("n").alias("n"), F.sum("n_near").alias("n_near"), best.alias("best")
    ).select("word", "n", "n_near", F.col("best.near").alias("near"), (-F.col("best.less")).alias("near_n"))


def variants(vocabulary: DataFrame, ratio: int = FORM_RATIO, crowded: int = CROWDED) -> DataFrame:
    """(word, form, root, n, n_near, form_n): each word with the form it is a variant of.

    The form is the most frequent near word if that is ``ratio`` times as frequent as the
    word or more, else null. ``root`` follows forms to the last; counts grow by the ratio at
    each step, so paths are short and have no circles. Rounds double the steps taken.
    """
    near = near_words(vocabulary, crowded)
    is_form = F.col("near_n") >= F.col("n") * ratio
    formed = settle(
        near.select(
            "word", F.when(is_form, F.col("near")).alias("form"), "n", "n_near",
            F.when(is_form, F.col("near_n")).alias("form_n"),
        )
    )
    steps = settle(formed.where("form is not null").select("word", F.col("form").alias("root")))
    while True:
        onward = steps.select(F.col("word").alias("root"), F.col("root").alias("next"))
        if steps.join(onward, "root", "left_semi").isEmpty():
            break
        steps = settle(
            steps.join(onward, "root", "left").select("word", F.coalesce("next", "root").alias("root"))
        )
    return formed.join(steps, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
