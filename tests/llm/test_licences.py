import math
import random
import re

import pytest

from ecoledger.llm import licences
from ecoledger.llm.licences import TEMPLATES, Template


def split(text):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)


def brute(rows, templates=TEMPLATES):
    """Every template at every place of every text."""
    texts = [split(t) for _, t in rows]
    sets = [set(ws) for ws in texts]
    weight = {
        w: max(1, round(1000 * math.log((len(rows) + 1) / (sum(w in s for s in sets) + 1))))
        for t in templates for w in t.words
    }
    out = []
    for (key, _), ws in zip(rows, texts):
        starts, base, labels, best = [], set(), set(), 0.0
        for t in templates:
            whole = sum(weight[w] for w in t.words)
            for start in range(-len(t.words) + 1, len(ws)):
                gained = sum(
                    weight[w] for k, w in enumerate(t.words) if 0 <= start + k < len(ws) and ws[start + k] == w
                )
                if gained / whole < t.share or not all(near(ws, start, t, p) for p in t.phrases):
                    continue
                labels.add(t.label)
                best = max(best, gained / whole)
                if t.base:
                    base.add(t.label)
                    starts.append(start)
        first, last = (min(starts), max(starts)) if starts else (None, None)
        out.append((key, len(ws), len(starts), first, last, ",".join(sorted(base)), ",".join(sorted(labels)), round(best, 6)))
    return sorted(out, key=repr)


def near(ws, start, template, phrase):
    wanted = phrase.split()
    at = next(k for k in range(len(template.words)) if template.words[k : k + len(wanted)] == wanted)
    spots = range(start + at - licences.SLACK, start + at + licences.SLACK + 1)
    return any(s >= 0 and ws[s : s + len(wanted)] == wanted for s in spots)


def scanned(docs, templates=TEMPLATES):
    return sorted((tuple(r) for r in licences.scan(docs, templates).collect()), key=repr)


def noisy(rng, text):
    """A notice with words lost, put in, exchanged or in capitals."""
    words = text.split()
    for _ in range(rng.randrange(4)):
        k = rng.randrange(len(words))
        words[k : k + 1] = rng.choice([[], [words[k], "extra"], ["other"], [words[k].upper()], [words[k].title()]])
        words = words or ["empty"]
    return rng.choice([" ", "\n", ", ", "-"]).join(words)


@pytest.mark.parametrize("seed", range(3))
def test_scans_equal_brute_force(make_docs, seed):
    rng = random.Random(seed)
    common = ["the", "of", "all", "by", "rights", "license", "licensed", "public", "general", "copy", "é", "漢字", "2", "0", "version"]
    rows = []
    for k in range(120):
        parts = [" ".join(rng.choices(common, k=rng.randrange(12))) for _ in range(3)]
        parts.insert(1, noisy(rng, rng.choice(TEMPLATES).text) if rng.random() < 0.7 else "")
        rows.append((k, rng.choice([" ", "\n"]).join(parts)))
    rows += [(500, None), (501, ""), (502, "ALL rights-Reserved cc\x7fby CC BY"), (503, "All righţs reserved. All\x00rights_reserved"),
             (504, "all rights reserved " * 4000), (505, "İ cc by ſ"), (None, rows[3][1]), (7, rows[7][1]), (7, rows[7][1])]
    docs = make_docs(*rows, label="'a'", uid="1", word="'w'", n_words="2", places="3")
    assert scanned(docs) == brute(rows)


def test_no_documents_no_rows(make_docs):
    assert licences.scan(make_docs((1, "cc by")).limit(0)).count() == 0


def test_frequent_words_are_not_posted(spark, make_docs):
    docs = make_docs(*[(k, "the of by all" + (" reserved" if k == 3 else "")) for k in range(50)])
    index = licences.rare_word_index(spark, licences.weights(docs)).collect()
    posted = {(r.label, r.word) for r in index}
    assert ("reserved", "all") not in posted and ("cc-by", "by") not in posted and ("cc-by", "cc") in posted
    assert sum(r.label == "gpl" for r in index) == 1


def test_own_templates(make_docs):
    own = (Template("beer", "you can buy me a beer in return", ("buy me a beer",), share=0.8),)
    rows = [(1, "You can buy me a beer in return"), (2, "you can buy me a coffee in return"), (3, "buy me a beer"), (4, "can buy me a beer in return")]
    assert scanned(make_docs(*rows), own) == brute(rows, own)


def test_no_python_in_the_plan(make_docs):
    plan = licences.scan(make_docs((1, "cc by")))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Cartesian" not in plan
