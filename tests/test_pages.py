import hashlib
import json

import pyarrow as pa
import pytest

from ecoledger.operators import blobs, pages
from ecoledger.operators import checks

OPEN = '<script type="application/vnd.jupyter.widget-state+json">'
BIG = "x" * 5000 + "</script>é\""


def page(state, before="<html>", after="</html>"):
    body = state if isinstance(state, str) else json.dumps(state).replace("</", "<\\/")
    return f"{before}{OPEN}{body}</script>{after}"


def models(**held):
    return {"state": {f"m{i}": {"state": {k: v}} for i, (k, v) in enumerate(held.items())}}


PAGES = {
    1: ("a.html", page(models(_esm=BIG, _css="y" * 4096))),
    2: ("d/e/b.html", page({"state": {"a": {"state": {"_esm": BIG}}, "b": {"state": {"_esm": BIG, "_css": "z"}}}})),
    3: ("small.html", page(models(_esm="x" * 4095))),
    4: ("none.html", "<html></html>"),
    5: ("bad.html", page("{not json")),
    6: ("open.html", "<html>" + OPEN + json.dumps(models(_esm="x" * 5000))),
    7: ("ref.html", page(models(_esm="anywidget-ref:" + "x" * 5000))),
    8: ("done.html", page(models(_esm=BIG), after=f"<script {blobs.MARKER}></script>")),
    9: ("types.html", page(models(_esm=["x" * 5000], _css={"k": "x" * 5000}))),
    10: ("odd.html", page({"state": {"m": {"state": "text"}, "n": {"x": 1}}})),
    11: ("single.html", page(models(_esm=BIG)).replace('type="application', "id=1 type='application").replace('+json"', "+json'")),
}


@pytest.fixture(scope="module")
def site(spark):
    rows = [(k, path, html) for k, (path, html) in PAGES.items()]
    return spark.createDataFrame(rows, "page_id bigint, path string, html string")


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()[:32]


def test_usage(site):
    got = {(r.digest, r.ext): (r.uses, r.n_pages, r.first_page) for r in blobs.bundle_usage(site).collect()}
    assert got == {(digest(BIG), "js"): (4, 3, 1), (digest("y" * 4096), "css"): (1, 1, 1)}


def test_shared_bundles_are_stored_once(site):
    got = {r.path: r.body for r in blobs.shared_bundles(site).collect()}
    assert got == {
        f"site_libs/anywidget-assets/{digest(BIG)}.js": BIG,
        f"site_libs/anywidget-assets/{digest('y' * 4096)}.css": "y" * 4096,
    }


def test_bodies_leave_a_task_in_bounded_batches():
    html = [page(models(_esm=f"{k} " + "x" * 900_000)) for k in range(40)]
    schema = pa.schema([("digest", pa.string()), ("body", pa.string())])
    given = iter([pa.RecordBatch.from_pydict({"html": html})])
    sent = list(blobs._page_rows(given, schema, lambda found, row: [(p.digest, p.body) for p in found.places]))
    assert sum(b.num_rows for b in sent) == 40
    assert max(b.nbytes for b in sent) < blobs.CHARS_SENT + 1_000_000


def test_a_page_gives_a_bundle_once(site):
    found = [(r.page_id, r.digest) for r in blobs._bundle_rows(site).collect()]
    assert len(found) == len(set(found)) == 4


def test_only_pages_with_bundles_change(site):
    rows = {r.page_id: r for r in blobs.rewrite_pages(site).collect()}
    assert {k for k, r in rows.items() if r.changed} == {1, 2, 11}
    assert all(rows[k].html == PAGES[k][1] for k in rows if not rows[k].changed)


def test_rewritten_page(site):
    row = blobs.rewrite_pages(site).where("page_id = 2").first()
    assert row.html.startswith("<html>" + OPEN) and row.html.endswith("</html>")
    block = row.html[len("<html>" + OPEN):].split("</script>")[0]
    state = json.loads(block)["state"]
    want = f"anywidget-ref:../../site_libs/anywidget-assets/{digest(BIG)}.js"
    assert state["a"]["state"]["_esm"] == state["b"]["state"]["_esm"] == want
    assert state["b"]["state"]["_css"] == "z" and blobs.MARKER in row.html


def test_rewriting_twice_changes_nothing(site):
    once = blobs.rewrite_pages(site).drop("changed")
    twice = blobs.rewrite_pages(once)
    assert twice.where("changed").count() == 0
    assert sorted(r.html for r in once.collect()) == sorted(r.html for r in twice.collect())


ODD = {
    21: ("odd/text.html", page({"state": {"m0": "text", "m1": {"state": {"_esm": BIG}}}})),
    22: ("odd/list.html", page({"state": {"m0": {"state": [1]}, "m1": {"state": {"_esm": BIG}}}})),
    23: ("odd/twice.html", page('{"state": {"m": {"state": {"_esm": "small", "_esm": "' + "q" * 5000 + '"}}}}')),
    24: ("odd/surrogate.html", page('{"state": {"m": {"state": {"_esm": "\\ud800' + "q" * 5000 + '"}}}}')),
    25: ("odd/top.html", page("[1, 2]")),
}


def test_odd_models_do_not_lose_bundles(spark):
    rows = [(k, path, html) for k, (path, html) in {**PAGES, **ODD}.items()] + [(26, "null.html", None)]
    odd = spark.createDataFrame(rows, "page_id bigint, path string, html string")
    done = blobs.rewrite_pages(odd)
    got = {r.page_id: r for r in done.collect()}
    assert [k for k in sorted(got) if k > 20 and got[k].changed] == [21, 22, 23]
    assert got[24].problem == "a bundle is not valid Unicode" and got[24].html == ODD[24][1]
    assert got[5].problem == "the state block is not JSON" and got[26].html is None
    check = blobs.reference_integrity(done, blobs.shared_bundles(odd)).first()
    assert (check.references, check.assets, check.dangling, check.unused) == (8, 3, 0, 0)
    script = blobs.rewrite_pages(odd, script="resolve()").where("page_id = 21").first().html
    assert f'{blobs.MARKER}="1">resolve()</script>' in script


RECORDS = "code string, name string, record_text string"


def test_pages_and_changes(spark):
    template = "# Null Island Marine Shelf (M1.1.1)\necosystem_code = 'M1.1.1'\n"
    second = "## M1.1.1 Criterion B\necosystem_code = 'M1.1.1'\n"
    records = spark.createDataFrame([("a", "A", "r1"), ("b", None, "r2"), (None, "x", "r3")], RECORDS)
    made = pages.render_pages(records, template, second, "country")
    rows = {r.path: r.text for r in made.collect()}
    assert set(rows) == {"a/a.qmd", "a/a_crit_b.qmd", "b/b.qmd", "b/b_crit_b.qmd"}
    assert rows["b/b.qmd"].startswith("# b (b)\n")
    assert hashlib.sha256(b"r1country").hexdigest() in rows["a/a.qmd"]
    assert rows["a/a_crit_b.qmd"] == "## a Criterion B\necosystem_code = 'a'\n"

    edited = spark.createDataFrame([("a", "A", "r1 edited")], RECORDS)
    stored = pages.render_pages(edited, template, second, "country")
    change = {r.path: r.change for r in pages.page_changes(made, stored).collect()}
    assert change == {
        "a/a.qmd": "changed", "a/a_crit_b.qmd": "unchanged", "b/b.qmd": "new", "b/b_crit_b.qmd": "new",
    }


def test_chapter_order(spark):
    rows = [(None, "z", "Aa"), (10, "c", "C"), (2, "d", "d"), (None, "b", None)]
    chapters = pages.chapter_list(spark.createDataFrame(rows, "index int, code string, name string"))
    labels = [r.label for r in chapters.orderBy(*pages.report_order()).collect()]
    assert labels == ["2 · d", "10 · c - C", "z - Aa", "b"]


def test_scaffold(spark):
    features = spark.createDataFrame(
        [("a", None, "G", 1), ("a", "late", "H", 2), ("b", "B", None, 3)],
        "code string, name string, fg string, src_ordinal bigint",
    )
    index = spark.createDataFrame([(1, "a"), (2, "b")], "index int, code string")
    rows = {r.global_classification: r for r in pages.scaffold_records(index, features, "Ruritania").collect()}
    assert len(rows["a"].asDict()) == 26
    assert (rows["a"].ecosystem_name, rows["a"].functional_group, rows["b"].functional_group) == ("", "G", "N/A")
    assert rows["b"].criteria_status["E"] == {"E": "NE"} and rows["b"].authors == ["John Smith", "Jane Smith"]


def test_drift_is_null_safe(spark):
    schema = "k int, data string, fg string"
    now = spark.createDataFrame([(1, "x", None), (2, "x", "G"), (3, "x", None), (4, "y", None)], schema)
    then = spark.createDataFrame([(1, "x", None), (2, "x", None), (4, "x", None)], schema)
    got = checks.source_drift(now, then, "k", ["data", "fg"])
    assert {r.k: r.drifted for r in got.collect()} == {1: False, 2: True, 3: True, 4: True}


def test_backfill_is_idempotent(spark):
    index = spark.createDataFrame([(1, "a"), (2, "b")], "index int, code string")
    records = spark.createDataFrame([("a", 1), ("b", None), ("x", 7)], "code string, index int")
    once = checks.backfill_index(records, index)
    assert {r.code: (r["index"], r.change) for r in once.collect()} == {
        "a": (1, "unchanged"), "b": (2, "set"), "x": (7, "unmatched"),
    }
    twice = checks.backfill_index(once.drop("change"), index)
    assert twice.where("change = 'set'").count() == 0


def test_legend_mismatch_sees_missing_rows(spark):
    left = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "index int, code string")
    right = spark.createDataFrame([(1, "a"), (2, "x"), (4, "d")], "index int, code string")
    got = {r["index"]: (r.legend_code, r.index_code) for r in checks.legend_mismatches(left, right).collect()}
    assert got == {2: ("b", "x"), 3: ("c", None), 4: (None, "d")}


@pytest.mark.parametrize(
    "records, made, recorded, action",
    [
        ([], [], "x", "scaffold"), (["a"], ["a"], "y", "source drift"), (["a"], ["a", "b"], "x", "orphan pages"),
        (["a", None], ["a"], "x", "invalid records"), (["a"], ["a"], "x", "regenerate"),
    ],
)
def test_build_gate(spark, records, made, recorded, action):
    from ecoledger.plans.build_gate import build_gate

    def coded(values):
        return spark.createDataFrame([(v,) for v in values], "code string")

    source = "k int, data string"
    row = build_gate(
        coded(records), coded(made), spark.createDataFrame([(1, "x")], source),
        spark.createDataFrame([(1, recorded)], source), "k", ["data"],
    ).first()
    assert row.action == action
