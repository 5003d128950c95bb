"""Risk categories: criterion B, the criteria table and status labels."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ecoledger.functions.colour import badge_text_colour
from ecoledger.functions.text import metric_text

# The categories as (abbreviation, name, severity, badge fill);
# severity falls from 6 to 1 and is null where no level of risk is stated.
CATEGORIES = (
    ("CO", "Collapsed", 6, "black"),
    ("CR", "Critically Endangered", 5, "red"),
    ("EN", "Endangered", 4, "orange"),
    ("VU", "Vulnerable", 3, "yellow"),
    ("NT", "Near Threatened", 2, "yellowgreen"),
    ("LC", "Least Concern", 1, "green"),
    ("DD", "Data Deficient", None, "lightgray"),
    ("NE", "Not Evaluated", None, "white"),
)

# Published upper limits of criterion B, most severe first.
# B1 is the extent of occurrence in km2, B2 the number of 10 km cells.
THRESHOLDS = {
    "B1": ((2_000, "CR"), (20_000, "EN"), (50_000, "VU")),
    "B2": ((2, "CR"), (20, "EN"), (50, "VU")),
}

# Criteria and sub-criteria in report order.
CRITERIA = {
    "A": ("A1", "A2a", "A2b", "A3"),
    "B": ("B1", "B2", "subcriteria", "B3"),
    "C": ("C1", "C2a", "C2b", "C3"),
    "D": ("D1", "D2a", "D2b", "D3"),
    "E": ("E",),
}
NOT_EVALUATED = "NE"

# Criterion B here rests on the spatial limits alone; a final listing also needs
# decline, threatening processes or few locations.
BASIS = "spatial"


def _lookup(field: int) -> Column:
    pairs = []
    for row in CATEGORIES:
        if row[field] is not None:
            pairs += [F.lit(row[0]), F.lit(row[field])]
    return F.create_map(*pairs)


def category_name(abbr: Column) -> Column:
    return F.try_element_at(_lookup(1), abbr)


def severity(abbr: Column) -> Column:
    return F.try_element_at(_lookup(2), abbr)


def category_fill(abbr: Column) -> Column:
    return F.try_element_at(_lookup(3), abbr)


def category_label(abbr: Column) -> Column:
    """``Name (ABBR)``; an unknown value stays itself and null becomes N/A."""
    return F.coalesce(
        F.concat(category_name(abbr), F.lit(" ("), abbr, F.lit(")")), F.nullif(abbr, F.lit("")),
        F.lit("N/A"),
    )


def limit_category(metric: Column, limits) -> Column:
    """First category whose upper limit the metric does not exceed, else LC."""
    chain = F.when(metric.isNull(), F.lit(None).cast("string"))
    for limit, abbr in limits:
        chain = chain.when(metric <= limit, F.lit(abbr))
    return chain.otherwise(F.lit("LC"))


def most_severe(*abbrs: Column) -> Column:
    """The most severe of several categories, nulls ignored."""
    ranked = F.array_compact(
        F.array(*[F.when(a.isNotNull(), F.struct(severity(a).alias("s"), a.alias("a"))) for a in abbrs])
    )
    return F.array_max(ranked)["a"]


def criterion_b(metrics: DataFrame, thresholds: dict = THRESHOLDS) -> DataFrame:
    """Add b1, b2, overall and basis to rows with eoo_km2 and aoo_cells."""
    graded = metrics.withColumn("b1", limit_category(F.col("eoo_km2"), thresholds["B1"])).withColumn(
        "b2", limit_category(F.col("aoo_cells"), thresholds["B2"])
    )
    return graded.withColumn("overall", most_severe(F.col("b1"), F.col("b2"))).withColumn(
        "basis", F.lit(BASIS)
    )


def criterion_b_summary(graded: DataFrame) -> DataFrame:
    """Three report rows per class: B1 by EOO, B2 by AOO, overall, with badge colours."""
    def line(order, sub, metric, value, category):
        fill = F.coalesce(category_fill(category), F.lit("transparent"))
        return F.struct(
            F.lit(order).alias("line"), F.lit(sub).alias("sub_criterion"),
            F.lit(metric).alias("metric"), value.alias("value"),
            category_label(category).alias("category"),
            fill.alias("fill"), badge_text_colour(fill).alias("text_colour"),
        )

    lines = F.array(
        line(1, "B1", "EOO", F.concat(metric_text(F.col("eoo_km2"), 0), F.lit(" km²")), F.col("b1")),
        line(2, "B2", "AOO",
             F.concat(F.coalesce(F.col("aoo_cells").cast("string"), F.lit("N/A")), F.lit(" cells")),
             F.col("b2")),
        line(3, "Overall B", "—", F.lit("—"), F.col("overall")),
    )
    return graded.select("code", F.inline(lines))


def blank_status() -> Column:
    """The nested status map of a new record, everything not evaluated."""
    outer = []
    for criterion, subs in CRITERIA.items():
        inner = []
        for sub in subs:
            inner += [F.lit(sub), F.lit(NOT_EVALUATED)]
        outer += [F.lit(criterion), F.create_map(*inner)]
    return F.create_map(*outer)


def merge_computed(records: DataFrame, graded: DataFrame) -> DataFrame:
    """Put the computed B1 and B2 into ``criteria_status``; nulls keep the authored value."""
    computed = graded.select("code", F.col("b1").alias("_b1"), F.col("b2").alias("_b2"))
    joined = records.join(computed, "code", "left")
    empty = F.create_map().cast("map<string,string>")
    status = F.coalesce("criteria_status", F.create_map().cast("map<string,map<string,string>>"))
    row_b = F.coalesce(F.try_element_at(status, F.lit("B")), empty)
    found = F.map_filter(
        F.create_map(F.lit("B1"), F.col("_b1"), F.lit("B2"), F.col("_b2")),
        lambda _, v: v.isNotNull(),
    )

    def without(m, keys):
        return F.map_filter(m, lambda k, _: ~F.array_contains(keys, k))

    new_b = F.map_concat(without(row_b, F.map_keys(found)), found)
    new_status = F.map_concat(
        F.map_filter(status, lambda k, _: k != "B"), F.create_map(F.lit("B"), new_b)
    )
    touched = F.col("_b1").isNotNull() | F.col("_b2").isNotNull()
    return joined.withColumn(
        "criteria_status", F.when(touched, new_status).otherwise(F.col("criteria_status"))
    ).drop("_b1", "_b2")


def criteria_table(records: DataFrame) -> DataFrame:
    """Seventeen ordered rows per record with status, badge fill and text colour."""
    slots = [
        F.struct(F.lit(n).alias("line"), F.lit(c).alias("criterion"), F.lit(s).alias("sub_criterion"))
        for n, (c, s) in enumerate(
            ((c, s) for c, subs in CRITERIA.items() for s in subs), start=1
        )
    ]
    lines = records.select("code", "criteria_status", F.inline(F.array(*slots)))
    value = F.try_element_at(
        F.try_element_at(F.col("criteria_status"), F.col("criterion")), F.col("sub_criterion")
    )
    return (
        lines.withColumn("status", F.coalesce(value, F.lit(NOT_EVALUATED)))
        .withColumn("fill", category_fill(F.col("status")))
        .withColumn(
            "text_colour",
            F.when(F.col("fill").isNotNull(), badge_text_colour(F.col("fill"))),
        )
        .drop("criteria_status")
    )
