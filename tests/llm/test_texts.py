import hashlib
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from ecoledger.llm import icws, linechunks, substrings, toxicity, wordhash


def words(seed, n, vocabulary=5000):
    rng = random.Random(seed)
    return [f"w{rng.randrange(vocabulary)}" for _ in range(n)]


# --- passages -----------------------------------------------------------------


@pytest.mark.parametrize("period", sorted(substrings.COVERS))
def test_every_pair_of_residues_meets_in_the_cover(period):
    inside = set(substrings.COVERS[period])
    for a in range(period):
        for b in range(period):
            assert any((a + k) % period in inside and (b + k) % period in inside for k in range(period))


def brute_removal(rows, window):
    first = {}
    for key, text in sorted(((k if k is not None else -(1 << 63)), t or "") for k, t in rows):
        ws = text.encode().split()
        for i in range(len(ws) - window + 1):
            first.setdefault(tuple(ws[i : i + window]), key)
    out = []
    for key, text in rows:
        ws = (text or "").encode().split()
        gone = set()
        for i in range(len(ws) - window + 1):
            if first[tuple(ws[i : i + window])] < (key if key is not None else -(1 << 63)):
                gone.update(range(i, i + window))
        kept = b" ".join(w for i, w in enumerate(ws) if i not in gone)
        out.append((key, len(ws), len(gone), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


@pytest.mark.parametrize("repeat_ids", [False, True])
def test_repeated_passages_equal_brute_force(spark, make_docs, repeat_ids):
    rng = random.Random(5)
    shared = [words(k, 30 + 9 * k) for k in range(8)]
    rows = []
    for k in range(60):
        parts = []
        for _ in range(rng.randrange(1, 5)):
            parts += words(rng.random(), rng.randrange(60)) + (rng.choice(shared)[rng.randrange(9):] if rng.random() < 0.7 else [])
        rows.append((rng.randrange(1000) if repeat_ids is False else k // 2, rng.choice([" ", "\n", " \t"]).join(parts)))
    rows = list({r[0]: r for r in rows}.values()) if not repeat_ids else rows + [rows[3], (None, rows[5][1])]
    rows += [(2000, rows[0][1]), (2001, rows[0][1]), (2002, ""), (2003, None), (2004, "few words"), (2005, "\x1c　 " + rows[0][1])]
    docs = make_docs(*rows, h="1", spots="2", starts="3", g="4")
    got = substrings.remove_repeats(docs).select("doc_id", "n_words", "n_removed", "kept_sha256").collect()
    assert sorted(map(tuple, got), key=repr) == brute_removal(rows, 50)


def test_no_documents_no_passages(make_docs):
    assert substrings.remove_repeats(make_docs((1, "x")).limit(0)).count() == 0


def test_word_hashes_are_of_words():
    text = " a\tb\x0bc  ab é\x1cf a ".encode()
    hashes = wordhash.word_hashes(text)
    split = text.split()
    assert len(hashes) == len(split)
    assert len(set(hashes.tolist())) == len(set(split)) and hashes[0] == hashes[-1]
    assert (wordhash.run_hashes(hashes, 1) == wordhash.run_hashes(hashes, 1, np.arange(len(hashes)))).all()
    assert len(wordhash.run_hashes(hashes, 99)) == 0 == len(wordhash.word_hashes(b" \n"))


# --- lines --------------------------------------------------------------------


def plain_line_dedup(docs):
    """The law in plain Python for (doc_id, text) rows without nulls and with single ids."""
    windows = {}
    for doc_id, text in sorted(docs):
        lines = text.split("\n")
        seen = [i for i, line in enumerate(lines) if line.strip()]
        for i, j in zip(seen, seen[1:]):
            windows.setdefault("\n".join(lines[i : j + 1]), []).append((doc_id, i, j))
    gone, stay = set(), set()
    for places in windows.values():
        for doc_id, i, j in places[1:]:
            gone |= {(doc_id, k) for k in range(i, j + 1)}
        if len(places) > 1:
            doc_id, i, j = places[0]
            stay |= {(doc_id, k) for k in range(i, j + 1)}
    return {d: "\n".join(x for k, x in enumerate(t.split("\n")) if (d, k) not in gone - stay) for d, t in docs}


def two_lines_in_a_row(text):
    lines = text.split("\n")
    seen = [i for i, line in enumerate(lines) if line.strip()]
    return {"\n".join(lines[i : j + 1]) for i, j in zip(seen, seen[1:])}


def test_line_dedup_equals_plain_version_and_loses_no_passage(spark, make_docs):
    rng = np.random.default_rng(11)
    rows = [(k, "\n".join(rng.choice([*"abcdefgh", "", " "], rng.integers(1, 12)))) for k in range(300)]
    want = plain_line_dedup(rows)
    got = {r.doc_id: r.text for r in linechunks.without_repeated_chunks(make_docs(*rows)).collect()}
    assert got == want and sum(map(len, got.values())) < sum(len(t) for _, t in rows) / 2
    # what stands once may lose lines to two repeats beside each other; what repeats stays somewhere
    standing = Counter(w for _, t in rows for w in two_lines_in_a_row(t))
    assert {w for w, n in standing.items() if n > 1} <= set().union(*(two_lines_in_a_row(t) for t in got.values()))


def test_passage_in_a_repeat_keeps_its_first_place(spark, make_docs):
    rows = [(1, "p\nA"), (2, "p\nA\nB\nq"), (3, "B\nq"), (4, "A\nB"), (5, "beta\n\nThe end."), (6, "gamma\n\nThe end.")]
    got = {r.doc_id: r.text for r in linechunks.without_repeated_chunks(make_docs(*rows)).collect()}
    assert got == {1: "p\nA", 2: "A\nB\nq", 3: "", 4: "", 5: rows[4][1], 6: rows[5][1]}


def test_line_dedup_of_nothing_and_of_a_long_text(spark, make_docs):
    assert linechunks.without_repeated_chunks(make_docs((1, "a")).limit(0)).count() == 0
    long = "\n".join(f"line {k}" for k in range(20_000))
    got = {r.doc_id: r for r in linechunks.without_repeated_chunks(make_docs((1, long), (2, "x\n" + long))).collect()}
    assert got[1].text == long and (got[2].text, got[2].lines_removed, got[2].chunks_removed) == ("x", 20_000, 1)


def test_repeated_chunks_stay_once(spark, make_docs):
    block = "\n".join(words(3, 80))
    rows = [(5, "top\n" + block), (2, block + "\nend"), (9, block), (9, block), (11, None), (12, ""), (13, "one line"), (14, "one line"), (None, "solo\nlines\nhere")]
    docs = make_docs(*rows, _h="1", no="2", lines="3", body="4", h="5")
    got = linechunks.without_repeated_chunks(docs)
    kept = {}
    for r in got.collect():
        kept.setdefault(r.doc_id, []).append((r.text, r.lines_removed))
    assert len(sum(kept.values(), [])) == len(rows)
    assert kept[11] == [(None, 0)] and kept[12] == [("", 0)] and kept[13] == [("one line", 0)] == kept[14]
    assert kept[2] == [(block + "\nend", 0)]
    assert kept[5] == [("top", 80)] and kept[9] == [("", 80)] * 2
    assert {c for c in docs.columns} <= set(got.columns)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan


@pytest.mark.parametrize("size", [2, 3, 5])
def test_short_shared_passages_go_whole(spark, make_docs, size):
    shared = [[f"shared {k} line {j}" for j in range(size)] for k in range(40)]
    first = [(k, "\n".join([f"a{k}", *p, f"b{k}"])) for k, p in enumerate(shared)]
    later = [(100 + k, "\n".join([f"c{k}", f"d{k}", *p, f"e{k}"])) for k, p in enumerate(shared)]
    got = {r.doc_id: r for r in linechunks.without_repeated_chunks(make_docs(*first, *later)).collect()}
    assert all(got[k].text == text and got[k].lines_removed == 0 for k, text in first)
    for k in range(40):
        assert got[100 + k].text == f"c{k}\nd{k}\ne{k}"
        assert (got[100 + k].lines_removed, got[100 + k].chunks_removed) == (size, 1)


def test_lines_keep_their_first_place(spark, make_docs):
    rows = [(1, "p\nA"), (2, "p\nA\nB"), (3, "A\nB"), (4, "same\n" * 6 + "end"), (5, "x\ny\nz\nx\ny"), (6, "A\nother"), (7, "\n\n\n")]
    got = {r.doc_id: r.text for r in linechunks.without_repeated_chunks(make_docs(*rows)).collect()}
    assert got == {1: "p\nA", 2: "A\nB", 3: "", 4: "same\nsame\nend", 5: "x\ny\nz", 6: "A\nother", 7: "\n\n\n"}


# --- near-duplicate texts -------------------------------------------------------


def test_samples_agree_as_often_as_texts_are_alike():
    idf = np.ones(1 << icws.SKETCH_BITS, np.float32)
    base = words(4, 400)
    for changed in (0, 10, 40):
        other = list(base)
        for k in range(changed):
            other[k * 9] = f"new{k}"
        a, b = (icws.weighted_shingles(" ".join(t), idf) for t in (base, other))
        sampler = icws.Sampler(2000)
        same = (sampler.samples(*a) == sampler.samples(*b)).mean()
        assert abs(same - icws.weighted_jaccard(a, b)) < 0.05


def test_weighted_jaccard_equals_brute_force():
    idf = np.random.default_rng(1).random(1 << icws.SKETCH_BITS).astype(np.float32)
    one, two = " ".join(words(5, 50, 8)), " ".join(words(6, 70, 8))
    a, b = icws.weighted_shingles(one, idf), icws.weighted_shingles(two, idf)
    da, db = dict(zip(*a)), dict(zip(*b))
    keys = set(da) | set(db)
    want = sum(min(da.get(k, 0), db.get(k, 0)) for k in keys) / sum(max(da.get(k, 0), db.get(k, 0)) for k in keys)
    assert icws.weighted_jaccard(a, b) == pytest.approx(want, rel=1e-5)
    assert icws.weighted_jaccard(a, icws.weighted_shingles(None, idf)) == 0.0


def test_near_texts(spark, make_docs):
    def edit(ws, *places):
        return " ".join(f"edit{k}" if k in places else w for k, w in enumerate(ws))

    base, other = words(7, 300), words(8, 300)
    rows = [(10, " ".join(base)), (7, edit(base, 3)), (12, edit(base, 200, 100)), (13, " ".join(base)), (20, " ".join(other))]
    rows += [(30 + k, " ".join(words(100 + k, 120))) for k in range(30)]
    rows += [(90, ""), (91, None), (92, "a b"), (93, "a b"), (None, "no id at all but words"), (21, " ".join(other)), (21, " ".join(other))]
    got = icws.near_texts(make_docs(*rows, h="1", key="2", band="3", a="4")).collect()
    assert len(got) == len(rows)
    of = {r.doc_id: (r.component_id, r.kept) for r in got}
    assert {of[k] for k in (10, 12, 13)} == {(7, False)} and of[7] == (7, True)
    assert of[20] == (20, True) and of[21] == (20, False) and of[93] == (92, False)
    assert of[90] == (90, True) and of[91] == (91, True) and of[None] == (None, True)
    assert all(of[30 + k] == (30 + k, True) for k in range(30))
    assert icws.near_texts(make_docs((1, "x")).limit(0)).count() == 0


def test_large_group_of_near_texts_is_one(spark, make_docs):
    base = words(9, 200)
    rng = random.Random(3)
    rows = []
    for k in range(150):
        text = list(base)
        for _ in range(3):
            text[rng.randrange(200)] = f"x{rng.random()}"
        rows.append((k, " ".join(text)))
    idf = np.ones(1 << icws.SKETCH_BITS, np.float32)
    shingles = [icws.weighted_shingles(t, idf) for _, t in rows]
    parent = list(range(150))
    for i in range(150):
        for j in range(i):
            if icws.weighted_jaccard(shingles[i], shingles[j]) >= 0.85:
                a, b = parent[i], parent[j]
                parent = [min(a, b) if p in (a, b) else p for p in parent]
    got = {r.doc_id: r.component_id for r in icws.near_texts(make_docs(*rows)).collect()}
    assert all(got[i] == got[parent[i]] for i in range(150))


# --- toxicity -------------------------------------------------------------------


def test_grammar_weighs_what_surrounds_an_insult():
    m = toxicity.Matcher(toxicity.Model({"idiot$": 1.0, "lowei": 1.0}))
    plain = m.clause("the idiot spoke")
    assert m.clause("you idiot") > plain > m.clause("he is not an idiot")
    assert m.clause("she said the man was an idiot") < plain
    assert m.clause("you kill") > m.clause("we kill time") > 0
    assert m.clause("nothing here") == 0 and m.clause("idiotic") == 0 and m.clause("loweischaft") == 1.0
    assert m.features("Fine. You IDIOT! fine")[2] == m.features("you idiot")[2]
    assert m.features(None) == m.features("") == (0.0, 0.0, 0.0)


def test_toxicity_is_learned_from_open_rows_alone(spark, make_docs):
    rng = random.Random(1)
    rows, labels = [], []
    for k in range(600):
        toxic = k % 4 == 0
        text = words(k, 40) + ([f"zorg{rng.choice('abc')}", "vexil"] * 2 if toxic else [])
        rng.shuffle(text)
        rows.append((k, " ".join(text)))
        labels.append((k, int(toxic)))
    rows += [(9000, None), (9001, ""), (None, "x"), (9002, "long " * 50_000)]
    docs = make_docs(*rows, toxicity="5D", toxic="1", stem="2")
    marks = spark.createDataFrame([*labels, (None, 1), (5, None), (7777, 1)], "doc_id bigint, toxic int")
    flipped = marks.withColumn("toxic", F.when(toxicity.held_out(F.col("doc_id")), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    model = toxicity.learn(docs, marks)
    assert model == toxicity.learn(docs, flipped)
    got = {r.doc_id: r.toxicity for r in toxicity.score(docs, model).collect()}
    assert all((got[k] >= 0.7) == (k % 4 == 0) for k in range(600))
    assert got[9000] == got[9001] < 0.5 and got[9002] < 0.5 and len(got) == len(rows)
    empty = toxicity.learn(docs, marks.limit(0))
    assert toxicity.score(docs.limit(0), empty).count() == 0 and "idiot$" in empty.stems


def test_other_forms_of_a_drawn_out_insult_stay(spark, make_docs):
    ids = [k for k in range(20_000) if zlib.crc32(str(k).encode()) % 3 != 1]
    bad, good = ids[:600], ids[600:2600]
    forms = ["zorglux"] * 552 + ["zorgluxes"] * 28 + ["zorgluxian"] * 20
    docs = make_docs(
        *[(k, f"you {form} number n{k}") for k, form in zip(bad, forms)],
        *[(k, f"we saw m{k} in town") for k in good],
    )
    marks = spark.createDataFrame([(k, 1) for k in bad] + [(k, 0) for k in good], "doc_id long, toxic int")
    matcher = toxicity.Matcher(toxicity.learn(docs, marks))
    for form in set(forms):
        assert matcher.score(matcher.features(f"you {form}!")) >= toxicity.THRESHOLD
    assert matcher.features("we saw zorgish in town")[0] == 0


def test_rare_insults_are_learned_from_large_tables(spark, make_docs):
    ids = [k for k in range(20_000) if zlib.crc32(str(k).encode()) % 3 != 1]
    bad, good = ids[:1200], ids[1200:7200]
    # 10 of 1,200 toxic rows have a rare slur; one more word stands in 3 rows by chance
    said = ["blorfik"] * 10 + ["waddenzee idiot"] * 3 + ["idiot"] * 1187
    docs = make_docs(
        *[(k, f"you {word} n{k}") for k, word in zip(bad, said)], *[(k, f"we saw m{k} in town") for k in good]
    )
    marks = spark.createDataFrame([(k, 1) for k in bad] + [(k, 0) for k in good], "doc_id long, toxic int")
    matcher = toxicity.Matcher(toxicity.learn(docs, marks))
    assert matcher.score(matcher.features("you blorfik!")) >= toxicity.THRESHOLD
    assert matcher.features("on the waddenzee")[0] == 0


def test_one_row_of_each_group_stays_whatever_ids_repeat(spark, make_docs):
    a, b, c, near = (" ".join(words(k, 60)) for k in (51, 52, 53, 53))
    near += " more"
    rows = [(5, a), (9, a), (2, b), (5, b), (None, c), (None, c), (None, near), (7, near), (8, None), (8, None), (11, "")]
    docs = make_docs(*rows, t1="1", no="2")
    got = icws.one_of_each(docs)
    assert got.columns == docs.columns
    out = sorted(((r.doc_id, r.text) for r in got.collect()), key=str)
    alike = [r for r in out if r[1] in (c, near)]
    assert sorted((r for r in out if r not in alike), key=str) == sorted([(5, a), (2, b), (8, None), (8, None), (11, "")], key=str)
    assert len(alike) == 1 and alike[0][0] is None
