"""Toxicity by a weighted finite-state grammar over clauses.

Five transducers are composed into one machine: words to symbols, and over the symbols
negation, reported speech, target and threat. A clause that holds an insult or a threat
runs through it; each offence leaves with a weight that depends on what surrounds it: a
target next to it raises it, a negation or a report before it lowers it, and a threat
without a target counts little. A document's score is a logistic function of the weights
of its matched clauses. The vocabulary of insults and the logistic function are learned
from labelled documents.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ecoledger.llm.common import texts_of
from ecoledger.session import narrow_batches

# Labelled rows to learn from, at most (plus what hashing varies); the documented bound.
TRAINING_ROWS = 20_000
THRESHOLD = 0.7
STEM_LETTERS = range(3, 9)
# A stem is an insult if it stands in this share of toxic training documents at least
# and there at least this many times as often (in logarithms) as it may in others: what
# is seen in them and three more, which a few documents without it do not rule out. A rarer
# stem is one too if chance would hardly have put it into toxic documents so often: of all
# the stems that are tried, fewer than CHANCE would pass.
STEM_SHARE = 0.01
STEM_LEAST = 3
STEM_LOG_ODDS = 2.5
CHANCE = 0.05

# Closed word classes and a few offences known beforehand.
INSULTS = "idiot moron stupid scum trash loser pathetic worthless disgusting clown imbécile trottel estúpido".split()
THREATS = "kill hurt destroy shoot stab tuer frapper töten schlagen matar golpear".split()
TARGETS = "you your yours yourself they them he she tu vous toi ils elles du dich ihr euch tú usted ustedes vosotros".split()
NEGATIONS = "not no never isn't aren't don't without pas jamais sans nicht kein keine nie ohne nunca sin ni".split()
REPORTS = "said says say wrote claimed quoted reported dit disait écrit sagte sagt schrieb dijo dice escribió".split()

INSULT, THREAT, TARGET, NEGATION, REPORT, OTHER = range(6)
_WORD = re.compile(r"\w+(?:'\w+)?")
_CLAUSE_END = re.compile(r"[.!?;:\n]")


@dataclass
class Transducer:
    """(state, symbol) -> (next state, factor); symbols pass through unchanged."""

    states: int
    arcs: dict[tuple[int, int], tuple[int, float]]

    def step(self, state: int, symbol: int) -> tuple[int, float]:
        return self.arcs.get((state, symbol), (state, 1.0))


def _scope(opener: int, factor: float, reach: int) -> Transducer:
    """After ``opener``, offences among the next ``reach`` words are multiplied by ``factor``."""
    arcs = {}
    for left in range(reach + 1):
        for symbol in range(6):
            if symbol == opener:
                arcs[left, symbol] = (reach, 1.0)
            elif left:
                arcs[left, symbol] = (left - 1, factor if symbol in (INSULT, THREAT) else 1.0)
    return Transducer(reach + 1, arcs)


def _target(near: float, reach: int) -> Transducer:
    """A target among the ``reach`` words before an insult multiplies it by ``near``."""
    arcs = {}
    for left in range(reach + 1):
        for symbol in range(6):
            if symbol == TARGET:
                arcs[left, symbol] = (reach, 1.0)
            elif left:
                arcs[left, symbol] = (left - 1, near if symbol == INSULT else 1.0)
    return Transducer(reach + 1, arcs)


def _threat(without: float) -> Transducer:
    """A threat counts in full after a target in its clause, else by ``without``."""
    return Transducer(2, {(0, TARGET): (1, 1.0), (0, THREAT): (0, without), (1, THREAT): (1, 1.0)})


def compose(parts: list[Transducer]) -> Transducer:
    """The product machine: all parts read the same symbols, their factors multiply."""
    start = (0,) * len(parts)
    number, arcs, todo = {start: 0}, {}, [start]
    while todo:
        at = todo.pop()
        for symbol in range(6):
            steps = [p.step(s, symbol) for p, s in zip(parts, at)]
            after = tuple(s for s, _ in steps)
            if after not in number:
                number[after] = len(number)
                todo.append(after)
            arcs[number[at], symbol] = (number[after], math.prod(f for _, f in steps))
    return Transducer(len(number), arcs)


def grammar() -> Transducer:
    """Negation, reported speech, target and threat as one machine."""
    return compose([_scope(NEGATION, 0.3, 3), _scope(REPORT, 0.4, 12), _target(1.5, 3), _threat(0.2)])


@dataclass
class Model:
    """What scoring needs: offence stems with weights, and the logistic function."""

    stems: dict[str, float]  # a stem ends in "$" if it must be the whole word
    coefficients: list[float] = field(default_factory=lambda: [-4.0, 2.0, 1.0, 0.5])


def _symbols() -> dict[str, int]:
    return {w: s for s, words in ((TARGET, TARGETS), (NEGATION, NEGATIONS), (REPORT, REPORTS)) for w in words}


class Matcher:
    """A model made ready for one task."""

    def __init__(self, model: Model):
        import ahocorasick

        self.machine, self.closed, self.threats = grammar(), _symbols(), set(THREATS)
        self.stems, self.coefficients = model.stems, model.coefficients
        self.search = ahocorasick.Automaton()
        for stem in model.stems:
            self.search.add_word(stem.rstrip("$"), len(stem.rstrip("$")))
        for word in THREATS:
            self.search.add_word(word, len(word))
        self.search.make_automaton()

    def _offence(self, word: str) -> float:
        """The weight of a word's longest insulting stem; 0 if it has none."""
        weight = self.stems.get(word + "$", 0.0)
        if not weight:
            for n in range(min(len(word), STEM_LETTERS[-1]), STEM_LETTERS[0] - 1, -1):
                weight = self.stems.get(word[:n], 0.0)
                if weight:
                    break
        return weight

    def clause(self, text: str) -> float:
        """Sum of the weights of the offences of one clause of lower-case text."""
        state, total = 0, 0.0
        for word in _WORD.findall(text):
            weight = self._offence(word)
            if weight:
                symbol = INSULT
            elif word in self.threats:
                symbol, weight = THREAT, 1.0
            else:
                symbol = self.closed.get(word, OTHER)
            state, factor = self.machine.step(state, symbol)
            total += weight * factor
        return total

    def features(self, text: str | None) -> tuple[float, float, float]:
        """Whether, how strongly and in how many clauses a whole text offends."""
        if not text:
            return 0.0, 0.0, 0.0
        lower = text.lower()
        weights, done = [], -1
        for end, size in self.search.iter(lower):
            begin = end - size + 1
            if end <= done or (begin and (lower[begin - 1].isalnum() or lower[begin - 1] == "_")):
                continue
            # the clause around the hit; only clauses with a hit are read
            left = max(lower.rfind(mark, done + 1, begin) for mark in ".!?;:\n") + 1
            stop = _CLAUSE_END.search(lower, end + 1)
            right = stop.start() if stop else len(lower)
            weight = self.clause(lower[max(left, done + 1) : right])
            done = right
            if weight > 0:
                weights.append(weight)
        if not weights:
            return 0.0, 0.0, 0.0
        return min(1.0, max(weights)), math.log1p(sum(weights)), math.log1p(len(weights))

    def score(self, features: tuple[float, float, float]) -> float:
        z = self.coefficients[0] + sum(c * x for c, x in zip(self.coefficients[1:], features))
        return 1.0 / (1.0 + math.exp(-max(-30.0, min(30.0, z))))


def held_out(doc_id: Column) -> Column:
    """Rows whose labels are never learned from: crc32 of the id as text leaves 1 mod 3.

    A null id counts as held out.
    """
    return F.coalesce(F.crc32(doc_id.cast("string")) % 3 == 1, F.lit(True))


def _stems(text: str) -> set[str]:
    words = set(_WORD.findall(text.lower()))
    return {w + "$" for w in words if len(w) >= STEM_LETTERS[0]} | {w[:n] for w in words for n in STEM_LETTERS if len(w) >= n}


def training_rows(docs: DataFrame, labels: DataFrame, bound: int = TRAINING_ROWS) -> DataFrame:
    """(text, toxic) of about ``bound`` labelled rows that may be learned from, equal texts once.

    Rows are chosen by a hash of the id. Ids labelled more than once count once, as
    toxic if any of their labels says so; null labels are left out.
    """
    known = (
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
        .where(F.col("toxic").isNotNull() & ~held_out(F.col("doc_id")))
        .groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    )
    rows = known.count()
    share = min(1.0, bound / max(rows, 1))
    chosen = known.where(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) < math.ceil(share * 1_000_000))
    # about ``bound`` narrow rows
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(F.broadcast(chosen), "doc_id")
    # copies of one text would make its every word look telling
    return rows.groupBy("text").agg(F.max("toxic").alias("toxic"))


def learn(docs: DataFrame, labels: DataFrame, bound: int = TRAINING_ROWS) -> Model:
    """Stems and logistic function from at most about ``bound`` labelled documents.

    Without toxic or without clean training documents the stems known beforehand and a
    fixed function serve. Runs three jobs over the sample.
    """
    train = narrow_batches(training_rows(docs, labels, bound))
    totals = {r["toxic"]: r["count"] for r in train.groupBy("toxic").count().collect()}
    bad, good = totals.get(1, 0), totals.get(0, 0)
    known = {w + "$": 3.0 for w in INSULTS}
    if not bad or not good:
        return Model(known)

    def count(only: frozenset[str] | None):
        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            tally: Counter = Counter()
            for b in batches:
                for text in b["text"].dropna():
                    found = _stems(text)
                    tally.update(found if only is None else found & only)
            # an empty frame of text has no Arrow form here
            if tally:
                yield pd.DataFrame({"stem": list(tally), "n": list(tally.values())})

        return run

    # The sample is bounded, so these counts are too.
    often = (
        train.where("toxic = 1").select("text").mapInPandas(count(None), "stem string, n long")
        .groupBy("stem").agg(F.sum("n").alias("n")).where(F.col("n") >= STEM_LEAST).collect()
    )
    in_bad = {r["stem"]: r["n"] for r in often}
    in_good = {
        r["stem"]: r["n"]
        for r in train.where("toxic = 0").select("text").mapInPandas(count(frozenset(in_bad)), "stem string, n long")
        .groupBy("stem").agg(F.sum("n").alias("n")).collect()
    }
    odds = {
        s: math.log((n + 0.5) / (bad + 1)) - math.log((in_good.get(s, 0) + 3) / (good + 3)) for s, n in in_bad.items()
    }
    least = max(STEM_LEAST, STEM_SHARE * bad)
    share = bad / (bad + good)
    strong = {
        s: o for s, o in odds.items()
        if o >= STEM_LOG_ODDS
        and (in_bad[s] >= least or _by_chance(in_bad[s], in_good.get(s, 0), share) * len(odds) < CHANCE)
    }
    # the shortest stem that is as telling as its longer forms stands for them, drawn out
    # to what nearly all its words have in common, be it a whole word
    short = {
        s: o
        for s, o in strong.items()
        if not any(strong.get(s[:n], 0.0) >= min(o, 4.0) - 0.5 for n in STEM_LETTERS if n < len(s.rstrip("$")) + s.endswith("$"))
    }
    kept = {_drawn_out(s, in_bad): min(o, 5.0) / 2.5 for s, o in short.items()}
    kept = _with_lost_forms(kept, strong)
    model = Model({**{w: 1.0 for w in known if w not in in_good}, **kept})
    return _fit(train, model)


def _drawn_out(stem: str, counts: dict[str, int]) -> str:
    """The longest stem or whole word that nine in ten of the documents with ``stem`` share."""
    if stem.endswith("$"):
        return stem
    longer = [t for t, n in counts.items() if t.startswith(stem) and n >= 0.9 * counts[stem]]
    return max(longer, key=lambda t: (t.endswith("$"), len(t), t))


def _with_lost_forms(kept: dict[str, float], strong: dict[str, float]) -> dict[str, float]:
    """``kept`` and every strong form that its stems do not match.

    Beginnings of a kept stem are what that stem was drawn out from; they stay out.
    """
    out = dict(kept)
    # beginnings first, the shortest before longer ones: they match the words that go on from them
    for form in sorted(strong, key=lambda t: (t.endswith("$"), len(t), t)):
        word = form.rstrip("$")
        begun = any(word[:n] in out for n in range(STEM_LETTERS[0], len(word) + 1))
        drawn = not form.endswith("$") and any(t.startswith(form) for t in kept)
        if form not in out and not begun and not drawn:
            out[form] = min(strong[form], 5.0) / 2.5
    return out


def _by_chance(toxic: int, clean: int, share: float) -> float:
    """A bound on how likely ``toxic`` or more of the documents of a stem are toxic by chance (Chernoff)."""
    n = toxic + clean
    rate = toxic / n
    if rate <= share:
        return 1.0
    apart = rate * math.log(rate / share) + (math.log((1 - rate) / (1 - share)) * (1 - rate) if clean else 0.0)
    return math.exp(-n * apart)


def _fit(train: DataFrame, model: Model) -> Model:
    """Ridge logistic regression of the label on the clause features of the sample."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        matcher = Matcher(model)
        for b in batches:
            rows = [matcher.features(t) for t in b["text"]]
            yield pd.DataFrame(rows, columns=["a", "b", "c"]).assign(toxic=b["toxic"].to_numpy())

    # three numbers for each row of the bounded sample, as counts of equal rows
    seen = train.select("text", "toxic").mapInPandas(run, "a double, b double, c double, toxic int")
    table = seen.groupBy("a", "b", "c", "toxic").count().toPandas()
    x = np.column_stack([np.ones(len(table)), table[["a", "b", "c"]].to_numpy()])
    y, weight = table["toxic"].to_numpy(float), table["count"].to_numpy(float)
    beta, ridge = np.zeros(4), np.diag([1e-3, 0.1, 0.1, 0.1])
    for _ in range(25):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        slope = (x.T * (weight * p * (1 - p))) @ x + ridge
        beta = beta + np.linalg.solve(slope, x.T @ (weight * (y - p)) - ridge @ beta)
    return Model(model.stems, [float(b) for b in beta])


def score(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` with ``toxicity`` (0 to 1) from the whole text; null and empty texts included.

    Only the text is read; a column named ``toxicity`` is replaced.
    """

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        matcher = Matcher(model)
        for texts in batches:
            yield pa.array([matcher.score(matcher.features(t)) for t in texts_of(texts)], pa.float64())

    return narrow_batches(docs).withColumn("toxicity", F.arrow_udf(run, "double")("text"))
