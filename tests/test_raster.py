import random

import pytest
from pyspark.sql import functions as F

from ecoledger.functions import colour
from ecoledger.operators import raster, rings


def spans_of(features, metres):
    return raster.raster_spans(rings.edges(rings.rings(features)), metres)


def test_island_pixels(island):
    counts = {r.code: r.pixels for r in raster.pixel_counts(spans_of(island, 100.0)).collect()}
    assert counts["T6.5.1"] == 414
    # box and patch tile, so the whole box is covered once
    assert counts["M1.1.1"] + counts["T6.5.1"] == 14740


def test_pixels_are_used_once(island):
    spans = spans_of(island, 100.0)
    pixels = raster.pixels(spans)
    assert pixels.count() == pixels.select("row", "col").distinct().count() == 14740


def box(x, y, w, h):
    return [[[x, y], [x + w, y], [x + w, y + h], [x, y + h]]]


def test_later_feature_wins_everywhere(make_features):
    rng = random.Random(2)
    shapes = [
        (f"c{i % 3}", box(rng.uniform(-0.2, 0.2), rng.uniform(-0.1, 0.1), rng.uniform(0.02, 0.3), rng.uniform(0.02, 0.2)))
        for i in range(12)
    ]
    features = make_features(*shapes)
    alone = raster.pixels(
        raster.feature_spans(rings.edges(rings.rings(features)), 1000.0)
    ).groupBy("row", "col").agg(F.max(F.struct("src_ordinal", "code"))["code"].alias("code"))
    want = {(r.row, r.col): r.code for r in alone.collect()}
    rows = raster.pixels(spans_of(features, 1000.0)).collect()
    assert {(r.row, r.col): r.code for r in rows} == want and len(rows) == len(want)


def test_copies_of_one_shape_change_nothing(make_features):
    one = make_features(("a", box(0.0, 0.0, 0.3, 0.2)), ("b", box(0.1, 0.1, 0.3, 0.2)))
    many = make_features(*[("a", box(0.0, 0.0, 0.3, 0.2))] * 50, ("b", box(0.1, 0.1, 0.3, 0.2)))
    def count(f):
        return {r.code: r.pixels for r in raster.pixel_counts(spans_of(f, 1000.0)).collect()}
    assert count(one) == count(many)


def test_spans_are_cut_at_blocks(make_features):
    wide = make_features(("a", box(-30.0, 10.0, 60.0, 0.05)))
    spans = spans_of(wide, 1000.0)
    bad = spans.where(F.floor(F.col("c0") / 1024) != F.floor(F.col("c1") / 1024)).count()
    assert bad == 0 and spans.select("block").distinct().count() >= 6
    total = spans.agg(F.sum(F.col("c1") - F.col("c0") + 1)).first()[0]
    whole = raster.pixels(spans).select("row", "col").distinct().count()
    assert total == whole


def test_parts_of_one_feature_may_overlap(make_features):
    double = make_features(("a", [box(0.0, 0.0, 0.3, 0.2), box(0.1, 0.0, 0.3, 0.2)]))
    joined = make_features(("a", box(0.0, 0.0, 0.4, 0.2)))
    def count(f):
        return raster.pixel_counts(spans_of(f, 1000.0)).first().pixels
    assert count(double) == count(joined)


def test_class_colours_follow_hsv(spark):
    import colorsys

    rows = spark.range(300).select("id", colour.class_colour(F.col("id")).alias("c")).collect()
    for r in rows:
        rgb = colorsys.hsv_to_rgb((r.id * colour.HUE_STEP) % 1.0, colour.SATURATION, colour.VALUE)
        assert (r.c.r, r.c.g, r.c.b, r.c.a) == (*[round(v * 255) for v in rgb], 200)


@pytest.mark.parametrize(
    "value, rgba", [(3, (220, 20, 60, 235)), (4, (200, 200, 200, 130)), (255, (0, 0, 0, 0)), (None, (0, 0, 0, 0))]
)
def test_highlight(spark, value, rgba):
    df = spark.createDataFrame([(value,)], "v int")
    assert tuple(df.select(colour.highlight_colour(F.col("v"), 3).alias("c")).first().c) == rgba
