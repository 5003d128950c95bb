from pyspark.sql import functions as F

from ecoledger.operators import classes, palette
from ecoledger.plans import overview

SCHEMA = "code string, name string, fg string, src_ordinal bigint"


def test_index_in_natural_order(spark):
    codes = ["T10.1", "t2.10", "T2.9", "T2.1", "M1.1.1", "10", "9", "9", None]
    features = spark.createDataFrame([(c, None, None, i) for i, c in enumerate(codes)], SCHEMA)
    got = {r.code: r["index"] for r in classes.class_index(features).collect()}
    assert got == {"9": 1, "10": 2, "M1.1.1": 3, "T2.1": 4, "T2.9": 5, "t2.10": 6, "T10.1": 7}
    assert classes.rejected_features(features).count() == 1


def test_first_name_wins_and_null_counts_as_absent(spark):
    rows = [("a", "late", None, 5), ("a", "early", "G", 1), ("b", None, None, 1), ("b", "second", "H", 2)]
    index = {r.code: r.name for r in classes.class_index(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert index == {"a": "early", "b": "b"}


def test_numbers_run_through_all_slices(spark):
    rows = spark.range(5000).select(F.expr("pmod(id * 7919, 5003)").alias("v"))
    got = classes.number_in_order(rows.repartition(7), ["v"], "n").orderBy("v").collect()
    assert [r.n for r in got] == list(range(1, 5001))


def test_numbering_of_nothing(spark):
    assert classes.number_in_order(spark.range(0), ["id"]).count() == 0


def test_capacity(spark):
    rows = [(f"c{i}", None, None, i) for i in range(300)]
    index = classes.class_index(spark.createDataFrame(rows, SCHEMA))
    assert classes.over_capacity(index).count() == 46
    assert classes.first_classes(index, 3).count() == 3


def test_palette_slots_and_groups(spark):
    rows = [("a", "A", "G1", 0), ("b", "B", "G2", 1), ("c", "C", "G1", 2), ("d", "D", None, 3)]
    features = spark.createDataFrame(rows, SCHEMA)
    index = classes.class_index(features)
    by_class = {r["index"]: tuple(r.colour) for r in palette.palette(palette.colour_groups(index)).collect()}
    assert by_class[0] == (0, 0, 0, 0) and len(set(by_class.values())) == 5
    grouped = palette.colour_groups(index, features)
    by_group = {r["index"]: tuple(r.colour) for r in palette.palette(grouped).collect()}
    assert by_group[1] == by_group[3] == by_class[1]
    assert by_group[2] == by_class[2] and by_group[4] == by_class[3]
    assert {r.label for r in palette.legend(grouped, by_group=True).collect()} == {"G1", "G2", "d"}


def test_colouring_falls_back_with_a_note(spark):
    features = spark.createDataFrame([("a", "A", "G", 0), ("b", "B", "G", 1)], SCHEMA)
    index = classes.class_index(features)
    for color_by, known, groups, noted in (
        ("ecosystem", True, 2, False), ("functional_group", True, 1, False), ("functional_group", False, 2, True),
    ):
        rows = palette.map_colouring(index, features, color_by, known).collect()
        assert len({r.colour_group for r in rows}) == groups
        assert all((r.note is not None) == noted for r in rows)


def test_palette_gap_is_transparent_and_unknown_pixels_are_clear(spark):
    index = spark.createDataFrame([(1, "a", "A"), (3, "c", "C")], "index int, code string, name string")
    colours = palette.palette(palette.colour_groups(index))
    assert {r["index"]: r.colour.a for r in colours.collect()} == {0: 0, 1: 200, 2: 0, 3: 200}
    pixels = spark.createDataFrame([(1,), (2,), (9,), (255,)], "index int")
    assert {r["index"]: r.colour.a for r in palette.paint(pixels, colours).collect()} == {1: 200, 2: 0, 9: 0, 255: 0}


def test_overview_without_groups(spark):
    rows = [("a", "A", "x", 0), ("b", "B", "x", 1)]
    facts = overview.overview(spark.createDataFrame(rows, SCHEMA), "Ruritania", groups_known=False).first()
    assert facts.functional_groups is None
    assert facts.sentence == "The Ruritania ecosystem typology includes 2 ecosystem types."


def test_typology_keeps_unknown_groups(spark):
    features = spark.createDataFrame([("a", "A", "T1", 0), ("b", "B", "T9", 1)], SCHEMA)
    groups = spark.createDataFrame(
        [("spanish", "T1", "Bosque", "B1", "T"), ("english", "T1", "Forest", "B1", "T")],
        "language string, fg string, fg_name string, biome string, realm string",
    )
    got = {r.code: r.fg_name for r in overview.typology_table(features, groups).collect()}
    assert got == {"a": "Bosque", "b": None}
    assert overview.typology_table(features, None).columns == ["code", "name"]
