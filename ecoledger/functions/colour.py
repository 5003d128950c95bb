"""Colour rules of maps, legends and status badges."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the map palette: hue step, saturation, value and alpha of the
# class colours, and the RGBA of the highlight mode.
HUE_STEP = 0.6180339887498949
SATURATION = 0.65
VALUE = 0.95
CLASS_ALPHA = 200
HIGHLIGHT_RGBA = (220, 20, 60, 235)
MUTED_RGBA = (200, 200, 200, 130)
CLEAR_RGBA = (0, 0, 0, 0)
NODATA = 255

# Badge fills that need dark text.
LIGHT_FILLS = ("yellow", "green", "lightgray", "white")


def rgba(r, g, b, a) -> Column:
    """STRUCT<r,g,b,a> of integers from columns or numbers."""
    parts = {"r": r, "g": g, "b": b, "a": a}
    return F.struct(
        *[(c if isinstance(c, Column) else F.lit(c)).cast("int").alias(k) for k, c in parts.items()]
    )


def class_colour(rank: Column) -> Column:
    """RGBA of the rank-th colour group, hues spread by the golden ratio."""
    step = rank.cast("double") * HUE_STEP
    hue6 = (step - F.floor(step)) * 6.0
    sector = F.floor(hue6)
    f = hue6 - sector
    low = F.lit(VALUE * (1.0 - SATURATION))
    falling = F.lit(VALUE) * (F.lit(1.0) - f * SATURATION)
    rising = F.lit(VALUE) * (F.lit(1.0) - (F.lit(1.0) - f) * SATURATION)
    top = F.lit(VALUE)
    # channel value per hue sector 0..5
    wheel = {
        "r": (top, falling, low, low, rising, top),
        "g": (rising, top, top, falling, low, low),
        "b": (low, low, rising, top, top, falling),
    }

    def channel(values):
        picked = F.when(sector == 0, values[0])
        for i in range(1, 6):
            picked = picked.when(sector == i, values[i])
        return F.bround(picked * 255.0).cast("int")

    return rgba(*[channel(wheel[k]) for k in "rgb"], CLASS_ALPHA)


def highlight_colour(index: Column, chosen: int) -> Column:
    """Highlight mode: the chosen class, everything else muted, nodata clear."""
    return (
        F.when(index.isNull() | (index == NODATA), rgba(*CLEAR_RGBA))
        .when(index == F.lit(chosen), rgba(*HIGHLIGHT_RGBA))
        .otherwise(rgba(*MUTED_RGBA))
    )


def badge_text_colour(fill: Column) -> Column:
    """Dark text on light fills, light text otherwise."""
    return F.when(fill.isin(*LIGHT_FILLS), F.lit("#000")).otherwise(F.lit("#fff"))


def ramp_position(value: Column, low: Column, high: Column) -> Column:
    """Position of a value on the white-to-red ramp; 0 when all values agree."""
    return F.coalesce((value - low) / F.nullif(high - low, F.lit(0.0)), F.lit(0.0))


def ramp_colour(position: Column) -> Column:
    """White at 0, red at 1, in 256 steps."""
    fade = F.lit(255) - F.least(F.floor(position * 256.0), F.lit(255))
    return rgba(255, fade, fade, 255)


