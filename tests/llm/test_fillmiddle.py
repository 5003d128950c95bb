import hashlib
import random
import re

import numpy as np
import pytest

from ecoledger.llm import fillmiddle
from pyspark.sql import functions as F


def brute(key, text, unit="line", seed=7, rate=100, spm_share=50):
    text = text or ""
    units = re.findall(r"[^\n]*\n|[^\n]+", text) if unit == "line" else list(text)
    n = len(units)
    hashed = hashlib.sha256(f"{seed}:{'' if key is None else key}".encode()).hexdigest()
    h = [int(hashed[8 * k : 8 * k + 8], 16) for k in range(4)]
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= rate:
        return (key, n, "plain", None, None, text)
    prefix, middle, suffix = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if h[3] % 100 < spm_share:
        return (key, n, "spm", len(prefix), len(middle), f"<S>{suffix}<P>{prefix}<M>{middle}")
    return (key, n, "psm", len(prefix), len(middle), f"<P>{prefix}<S>{suffix}<M>{middle}")


def texts(seed):
    rng = random.Random(seed)
    letters = "ab \n\n\r\t<SPM>éß€漢😀 \x85\x00"
    made = ["".join(rng.choice(letters) for _ in range(rng.randrange(60))) for _ in range(150)]
    made += ["", None, "\n", "\n\n", "x", "no end\nx", "has <P> in it\n", "<S>", "a<M>b", "<P\n>", "😀" * 2000 + "\n" + "é" * 9]
    return made + ["line\n" * 30_000 + "漢", made[0], made[0]]


@pytest.mark.parametrize("rule", [
    fillmiddle.Rule(), fillmiddle.Rule(seed=9, rate=60, suffix_first=20), fillmiddle.Rule(unit="char"),
])
def test_cut_texts_equal_plain_version(make_docs, rule):
    rows = [(k, t) for k, t in enumerate(texts(rule.seed))] + [(None, "null\nid\n"), (None, None), (3, "again\n3")]
    docs = make_docs(*rows, n="1", form="'x'", output="2", prefix_chars="3")
    cut = fillmiddle.transform(docs, rule)
    got = cut.withColumn("back", fillmiddle.restored(F.col("output"), F.col("form"))).collect()
    plain = [brute(k, t, rule.unit, rule.seed, rule.rate, rule.suffix_first) for k, t in rows]
    assert sorted((tuple(r)[:6] for r in got), key=repr) == sorted(plain, key=repr)
    by_output = {p[5]: t or "" for p, (_, t) in zip(plain, rows)}
    assert all(r.back == by_output[r.output] for r in got)
    assert {r.form for r in got} == {"plain", "psm", "spm"}


def test_exceptions_convert_both_ways():
    text = "aé€😀b漢" * 50
    index = fillmiddle.Exceptions(np.frombuffer(text.encode(), "u1"))
    cuts = [len(text[:k].encode()) for k in range(len(text) + 1)]
    assert index.to_chars(np.array(cuts)).tolist() == list(range(len(text) + 1))
    assert index.to_bytes(np.arange(len(text) + 1)).tolist() == cuts
    assert len(index.at) == 4 * 50


def test_no_documents_and_odd_units(make_docs):
    assert fillmiddle.transform(make_docs((1, "x")).limit(0)).count() == 0
    with pytest.raises(ValueError):
        fillmiddle.transform(make_docs((1, "x")), fillmiddle.Rule(unit="page"))
