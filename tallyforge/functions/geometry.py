"""Boxes in pixels and fractions, as column arithmetic."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..config import Locate, Mark

SIDES = ("x0", "y0", "x1", "y1")


def pixels(box: Column, width: Column, height: Column) -> Column:
    """A box of fractions in pixels, cut towards zero."""
    return F.struct(*((box[s] * (width if s[0] == "x" else height)).cast("int").alias(s) for s in SIDES))


def fractions(box: Column, width: Column, height: Column) -> Column:
    return F.struct(*((box[s] / (width if s[0] == "x" else height)).alias(s) for s in SIDES))


def band(box: tuple[float, ...], width: Column, height: Column) -> Column:
    """A configured band of a page in pixels."""
    return pixels(F.struct(*(F.lit(v).alias(s) for v, s in zip(box, SIDES, strict=True))), width, height)


def hand_band(oval: Column, region: Column, cfg: Mark = Mark()) -> Column:
    """Where handwriting stands: right of the oval, in a strip above the line, which lies 6 pixels above the oval's end."""
    line = oval["y1"] - 6
    return F.struct((oval["x1"] + 2).alias("x0"), (line - cfg.hand_band_top).alias("y0"), region["x1"].alias("x1"), (line - cfg.hand_band_bot).alias("y1"))


def indented(start: Column, length: Column, column_width: Column, cfg: Locate = Locate()) -> Column:
    """Whether a run of dark pixels can be the line to write on, not a border or print."""
    return (start > cfg.min_indent) & (length > cfg.min_line_run) & (length <= F.lit(cfg.max_line_frac) * column_width)


def write_in_boxes(line_y: Column, line_x: Column, col_x0: Column, col_x1: Column, cfg: Locate = Locate()) -> tuple[Column, Column]:
    """The region to read and the oval's box, in pixels, from the line's left end and its column."""
    region = F.struct(col_x0.alias("x0"), (line_y - cfg.region_top_off).alias("y0"), col_x1.alias("x1"), (line_y + cfg.region_bot_off).alias("y1"))
    oval = F.struct((line_x - cfg.oval_left_off).alias("x0"), (line_y - cfg.oval_top_off).alias("y0"), (line_x - cfg.oval_right_off).alias("x1"), (line_y + cfg.oval_bot_off).alias("y1"))
    return region, oval


def gray(blue: Column, green: Column, red: Column) -> Column:
    """8-bit luma."""
    return F.floor((red * 299 + green * 587 + blue * 114) / 1000).cast("int")
