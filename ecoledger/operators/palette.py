"""Colour tables of the categorical map."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ecoledger.functions.colour import CLEAR_RGBA, NODATA, class_colour, rgba
from ecoledger.functions.text import legend_label
from ecoledger.operators.classes import first_values, number_in_order
from ecoledger.session import broadcast_if_small, settle


def colour_groups(index: DataFrame, features: DataFrame | None = None) -> DataFrame:
    """(index, code, name, colour_group): the code, or its functional group.

    Pass ``features`` to colour by functional group; a code whose group is
    unknown keeps its own colour.
    """
    if features is None:
        return index.withColumn("colour_group", F.col("code"))
    groups = first_values(features, "fg")
    return (
        index.join(groups, "code", "left")
        .withColumn("colour_group", F.coalesce("fg", "code"))
        .select("index", "code", "name", "colour_group")
    )


def map_colouring(
    index: DataFrame, features: DataFrame, color_by: str, groups_known: bool
) -> DataFrame:
    """Colour groups by ``ecosystem`` or ``functional_group``, with a ``note``.

    Without a functional-group column the map falls back to one colour per
    ecosystem and the note says so; otherwise the note is null.
    """
    wanted = color_by == "functional_group"
    note = "no functional-group column: coloured by ecosystem" if wanted and not groups_known else None
    grouped = colour_groups(index, features if wanted and groups_known else None)
    return grouped.withColumn("note", F.lit(note).cast("string"))


def group_colours(grouped: DataFrame) -> DataFrame:
    """(colour_group, first_index, rank, colour): groups ranked by their first class number.

    Runs the job that numbers the groups.
    """
    firsts = grouped.groupBy("colour_group").agg(F.min("index").alias("first_index"))
    # coloured by ecosystem, a map has as many groups as classes: no task sees all of them
    ranked = number_in_order(firsts, ["first_index", "colour_group"], "rank").withColumn("rank", F.col("rank") - 1)
    return ranked.select(
        "colour_group", "first_index", "rank", class_colour(F.col("rank")).alias("colour")
    )


def palette(grouped: DataFrame) -> DataFrame:
    """(index, colour) for every pixel value from 0 to the last class.

    Slot 0 and gaps are transparent.
    """
    colours = grouped.join(group_colours(grouped), "colour_group").select("index", "colour")
    top = grouped.agg(F.coalesce(F.max("index"), F.lit(0)).alias("_top"))
    slots = top.select(F.explode(F.sequence(F.lit(0), F.col("_top"))).alias("index"))
    return slots.join(colours, "index", "left").select(
        "index", F.coalesce("colour", rgba(*CLEAR_RGBA)).alias("colour")
    )


def legend(grouped: DataFrame, by_group: bool = False) -> DataFrame:
    """Legend rows in class order: one per class, or one per colour group."""
    colours = group_colours(grouped)
    if by_group:
        return colours.select(
            F.col("first_index").alias("position"), F.col("colour_group").alias("label"), "colour"
        )
    return grouped.join(colours, "colour_group").select(
        F.col("index").alias("position"),
        legend_label(F.col("code"), F.col("name")).alias("label"),
        "colour",
    )


def paint(pixels: DataFrame, palette_rows: DataFrame) -> DataFrame:
    """Categorical mode: colour by palette; nodata and unknown values are clear.

    Runs the small job that counts the palette before it is broadcast.
    """
    known = broadcast_if_small(settle(palette_rows.where(F.col("index") != NODATA)))
    return pixels.join(known, "index", "left").withColumn(
        "colour", F.coalesce("colour", rgba(*CLEAR_RGBA))
    )
