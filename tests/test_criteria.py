import pytest
from pyspark.sql import functions as F

from ecoledger.operators import criteria
from ecoledger.plans import assessment

METRICS = "code string, eoo_km2 double, aoo_cells bigint"


@pytest.mark.parametrize(
    "eoo, aoo, want",
    [
        (2000.0, 2, ("CR", "CR", "CR")), (2000.1, 3, ("EN", "EN", "EN")),
        (20000.0, 20, ("EN", "EN", "EN")), (20000.1, 21, ("VU", "VU", "VU")),
        (50000.0, 50, ("VU", "VU", "VU")), (50000.1, 51, ("LC", "LC", "LC")),
        (147.7, 4, ("CR", "EN", "CR")), (None, 20, (None, "EN", "EN")),
        (3.0, None, ("CR", None, "CR")), (None, None, (None, None, None)),
    ],
)
def test_limits(spark, eoo, aoo, want):
    row = criteria.criterion_b(spark.createDataFrame([("a", eoo, aoo)], METRICS)).first()
    assert (row.b1, row.b2, row.overall) == want and row.basis == "spatial"


def test_thresholds_are_a_parameter(spark):
    limits = {"B1": ((1, "CR"),), "B2": ((1, "VU"),)}
    row = criteria.criterion_b(spark.createDataFrame([("a", 5.0, 1)], METRICS), limits).first()
    assert (row.b1, row.b2, row.overall) == ("LC", "VU", "VU")


def test_labels(spark):
    df = spark.createDataFrame([("CR",), ("TODO",), (None,)], "a string")
    got = [r[0] for r in df.select(criteria.category_label(F.col("a"))).collect()]
    assert got == ["Critically Endangered (CR)", "TODO", "N/A"]


def test_summary_lines(spark):
    graded = criteria.criterion_b(spark.createDataFrame([("a", 147.7, 4), ("b", None, None)], METRICS))
    rows = {(r.code, r.line): (r.value, r.category) for r in criteria.criterion_b_summary(graded).collect()}
    assert rows["a", 1] == ("148 km²", "Critically Endangered (CR)")
    assert rows["a", 2] == ("4 cells", "Endangered (EN)")
    assert rows["b", 3] == ("—", "N/A") and rows["b", 1] == ("N/A km²", "N/A")
    fills = {(r.code, r.line): (r.fill, r.text_colour) for r in criteria.criterion_b_summary(graded).collect()}
    assert fills["a", 1] == ("red", "#fff") and fills["b", 3] == ("transparent", "#fff")


def test_computed_categories_replace_authored_ones(spark):
    records = spark.createDataFrame(
        [("a", {"B": {"B1": "DD", "B2": "DD", "B3": "VU"}}), ("b", {"B": {"B1": "DD"}}), ("c", None)],
        "code string, criteria_status map<string,map<string,string>>",
    )
    graded = criteria.criterion_b(
        spark.createDataFrame([("a", 10.0, None), ("c", None, 30)], METRICS)
    )
    merged = criteria.merge_computed(records, graded)
    rows = {(r.code, r.sub_criterion): r for r in criteria.criteria_table(merged).collect()}
    assert len(rows) == 3 * 17
    assert [rows["a", s].status for s in ("B1", "B2", "B3", "A1")] == ["CR", "DD", "VU", "NE"]
    assert rows["b", "B1"].status == "DD"
    assert (rows["c", "B1"].status, rows["c", "B2"].status) == ("NE", "VU")
    assert (rows["a", "B1"].fill, rows["a", "B1"].text_colour) == ("red", "#fff")
    assert rows["a", "B3"].text_colour == "#000"


def test_assessment_keeps_classes_without_features(spark, island):
    index = spark.createDataFrame(
        [(1, "M1.1.1", "water"), (2, "T6.5.1", "alpine"), (3, "X", "nothing")],
        "index int, code string, name string",
    )
    rows = {r.code: r for r in assessment.assess(index, assessment.metrics(island)).collect()}
    assert (rows["M1.1.1"].b1, rows["M1.1.1"].b2, rows["M1.1.1"].overall) == ("CR", "EN", "CR")
    assert (rows["X"].eoo_km2, rows["X"].overall, rows["X"].has_data) == (None, None, False)
