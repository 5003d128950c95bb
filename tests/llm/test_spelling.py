import random
import re
import zlib
from collections import Counter

import pytest

from ecoledger.llm import spelling


def brute_near(words):
    """Pairs one edit apart, by the definition."""

    def shorter(w):
        return {w[:i] + w[i + 1 :] for i in range(len(w))}

    pairs = set()
    for u in words:
        for v in words:
            if len(u) == len(v) and sum(x != y for x, y in zip(u, v)) == 1:
                pairs.add((u, v))
            if len(v) == len(u) + 1 and u in shorter(v):
                pairs |= {(u, v), (v, u)}
    return pairs


def brute_variants(counts, ratio=5):
    near = {}
    for u, v in brute_near(counts):
        near.setdefault(u, []).append(v)
    form = {}
    for u, vs in near.items():
        best = min(vs, key=lambda v: (-counts[v], v))
        if counts[best] >= ratio * counts[u]:
            form[u] = best
    rows = set()
    for w, n in counts.items():
        root = w
        while root in form:
            root = form[root]
        rows.add((w, form.get(w), root, n, len(near.get(w, [])), counts[form[w]] if w in form else None))
    return rows


def brute_counts(rows, loss=199):
    counts = Counter()
    for key, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if key is None else key}:{run}".encode())
            if h % loss == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            if len(run) >= 6:
                counts[run] += 1
    return {w: n for w, n in counts.items() if n >= 5}


def some_words(seed, n, letters="abé", longest=11):
    rng = random.Random(seed)
    return {"".join(rng.choice(letters) for _ in range(rng.randrange(6, longest))) for _ in range(n)}


@pytest.mark.parametrize("seed", range(6))
def test_composition_accepts_the_pairs_one_edit_apart(seed):
    words = some_words(seed, 250, letters="ab" if seed % 2 else "abcdef", longest=10)
    found = list(spelling.Acceptor(sorted(words)).near_pairs())
    assert len(found) == len(set(found))
    assert set(found) | {(v, u) for u, v in found} == brute_near(words)
    early = {(u, v) for u, v in found if spelling._shared_start(u, v) < 3}
    assert set(spelling.Acceptor(sorted(words)).near_pairs(3)) == early


def test_acceptor_is_minimal():
    words = sorted(a + b for a in ("ab", "cb", "db") for b in ("x", "xy", "zy"))
    acceptor = spelling.Acceptor(words)
    # one state each: start, after the first letter, after b, after x, after z, end
    reached, open_ = {0}, [0]
    while open_:
        for target in acceptor.arcs[open_.pop()].values():
            if target not in reached:
                reached.add(target)
                open_.append(target)
    assert len(reached) == 6
    assert list(spelling.Acceptor([]).near_pairs()) == []


@pytest.mark.parametrize("crowded", [20_000, 12, 1])
def test_variants_equal_brute_force_however_states_are_split(spark, crowded):
    rng = random.Random(crowded)
    words = some_words(3, 150) | {"hotstate" + w for w in some_words(4, 60, longest=9)} | {w + "hot" for w in some_words(5, 40)}
    counts = {w: rng.choice([5, 5, 6, 30, 31, 160, 900, 5000]) for w in words}
    table = spark.createDataFrame(list(counts.items()), "word string, n long")
    got = spelling.variants(table, crowded=crowded).select("word", "form", "root", "n", "n_near", "form_n")
    rows = [tuple(r) for r in got.collect()]
    assert len(rows) == len(counts) and set(rows) == brute_variants(counts)


def test_words_of_documents(spark, make_docs):
    rng = random.Random(8)
    base = [w.capitalize() for w in some_words(1, 25, letters="abcdeßñ")]
    rows = [(k, " ".join(rng.choices(base, k=rng.randrange(40))) + "\n×÷ÿÀxx short") for k in range(120)]
    rows += [(None, rows[0][1]), (3, rows[1][1]), (3, rows[1][1]), (500, ""), (501, None), (502, "abcdeß" * 3000), (503, "İstanbul ſtraße " * 9)]
    docs = make_docs(*rows, word="'a'", n="1", run="'b'", h="3", id="4")
    got = {r.word: r.n for r in spelling.word_counts(docs).collect()}
    assert got == brute_counts(rows)
    lossy = {r.word: r.n for r in spelling.word_counts(docs, loss_one_in=2).collect()}
    assert lossy == brute_counts(rows, loss=2)
    out = spelling.variants(spelling.word_counts(docs, loss_one_in=7))
    assert {tuple(r) for r in out.collect()} == brute_variants(brute_counts(rows, loss=7))


def test_no_words(make_docs):
    assert spelling.variants(spelling.word_counts(make_docs((1, "x")).limit(0))).count() == 0


def test_forms_are_followed_to_the_last(spark):
    chain = ["aaaaaa", "aaaaab", "aaaabb", "aaabbb", "aabbbb", "abbbbb"]
    counts = {w: 5 * 5**k for k, w in enumerate(chain)}
    table = spark.createDataFrame(list(counts.items()), "word string, n long")
    assert {r.word: r.root for r in spelling.variants(table).collect()} == dict.fromkeys(chain, "abbbbb")


def test_very_long_words_one_edit_apart():
    long = "ab" * 60_000
    found = list(spelling.Acceptor(sorted([long, long[:-1], long[:70_000] + "x" + long[70_001:]])).near_pairs())
    assert len(found) == 2
