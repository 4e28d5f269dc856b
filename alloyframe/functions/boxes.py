"""Boxes on a page: scaling, clamping, growing, containment, and the bits of a difference hash.

A box is given by its corner and size (x, y, w, h) or by two corners (x0, y0, x1, y1), in pixels.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Raster resolution, padding of a crop, slack of containment; share of a page and least size of a box;
#: shares by which a box grows; shares of a page above and below a caption; border that is cut; where axes may cross.
DPI, PAD, SLACK = 300, 30, 15
LEAST_SHARE, MOST_SHARE, LEAST_WIDTH, LEAST_HEIGHT = 0.03, 0.8, 220, 180
GROW_LEFT, GROW_RIGHT, GROW_TOP, GROW_BOTTOM = 0.10, 0.06, 0.06, 0.18
ABOVE_CAPTION, BELOW_CAPTION = 0.95, 0.20
BORDER, LEAST_TRIMMED = 2, 8
RIGHTMOST_AXIS, TOPMOST_AXIS = 0.95, 0.05


def to_pixels(points: Column, dpi: int = DPI) -> Column:
    return (points * F.lit(dpi / 72.0)).cast("int")


def good_share(w: Column, h: Column, page_w: Column, page_h: Column) -> Column:
    """Whether a box takes more than 3 % and less than 80 % of its page."""
    share = (w * h) / (page_w * page_h)
    return (share > LEAST_SHARE) & (share < MOST_SHARE)


def large_enough(w: Column, h: Column) -> Column:
    return (w >= LEAST_WIDTH) & (h >= LEAST_HEIGHT)


def padded(x: Column, y: Column, w: Column, h: Column, page_w: Column, page_h: Column, pad: int = PAD) -> Column:
    """The two corners of a box that is wider by the padding, within its page."""
    return F.struct(F.greatest(F.lit(0), x - pad).alias("x0"), F.greatest(F.lit(0), y - pad).alias("y0"), F.least(page_w, x + w + pad).alias("x1"), F.least(page_h, y + h + pad).alias("y1"))


def safe_crop(x0: Column, y0: Column, x1: Column, y1: Column, width: Column, height: Column) -> Column:
    """Corners as whole pixels in order and within the image; null if nothing is left or a corner is null."""
    a, b, c, d = (v.cast("int") for v in (x0, y0, x1, y1))
    clamp = lambda v, most: F.greatest(F.lit(0), F.least(v, most))
    box = F.struct(clamp(F.least(a, c), width).alias("x0"), clamp(F.least(b, d), height).alias("y0"), clamp(F.greatest(a, c), width).alias("x1"), clamp(F.greatest(b, d), height).alias("y1"))
    return F.when(a.isNotNull() & b.isNotNull() & c.isNotNull() & d.isNotNull() & (box["x1"] > box["x0"]) & (box["y1"] > box["y0"]), box)


def grown(x0: Column, y0: Column, x1: Column, y1: Column, width: Column, height: Column, left: float = GROW_LEFT, right: float = GROW_RIGHT, top: float = GROW_TOP, bottom: float = GROW_BOTTOM) -> Column:
    """A box made larger by shares of its size, whole pixels, within the image."""
    w, h = x1 - x0, y1 - y0
    return F.struct(
        F.greatest(F.lit(0), (x0 - w * left).cast("int")).alias("x0"), F.greatest(F.lit(0), (y0 - h * top).cast("int")).alias("y0"),
        F.least(width, (x1 + w * right).cast("int")).alias("x1"), F.least(height, (y1 + h * bottom).cast("int")).alias("y1"),
    )


def search_region(caption_y0: Column, caption_y1: Column, page_h: Column) -> Column:
    """Top and bottom of the part of a page in which a caption's plot is looked for."""
    return F.struct(
        F.greatest(F.lit(0), caption_y0 - F.floor(page_h * ABOVE_CAPTION).cast("int")).alias("top"), F.least(page_h, caption_y1 + F.floor(page_h * BELOW_CAPTION).cast("int")).alias("bottom")
    )


def trimmed(width: Column, height: Column, border: int = BORDER, least: int = LEAST_TRIMMED) -> Column:
    """The corners of an image without its border, if it is large enough to lose it."""
    large = (width > least) & (height > least)
    cut = F.when(large, border).otherwise(0)
    return F.struct(cut.alias("x0"), cut.alias("y0"), (width - cut).alias("x1"), (height - cut).alias("y1"))


def axes_cross(x_axis_y: Column, y_axis_x: Column, width: Column, height: Column) -> Column:
    """Whether a horizontal and a vertical line can be the axes of a plot of this size."""
    inside = (x_axis_y >= 0) & (x_axis_y < height) & (y_axis_x >= 0) & (y_axis_x < width)
    return inside & (y_axis_x <= F.floor(width * RIGHTMOST_AXIS)) & (x_axis_y >= F.floor(height * TOPMOST_AXIS))


def inside(box: Column, outer: Column, slack: int = SLACK) -> Column:
    return (
        (box["x"] >= outer["x"] - slack) & (box["y"] >= outer["y"] - slack)
        & (box["x"] + box["w"] <= outer["x"] + outer["w"] + slack) & (box["y"] + box["h"] <= outer["y"] + outer["h"] + slack)
    )


def suppress_contained(boxes: Column, slack: int = SLACK) -> Column:
    """Of an array of structs (x, y, w, h, ord) those that lie in no larger box that is kept, largest first.

    Boxes of equal area keep the order of `ord`. The array is one page's boxes.
    """
    ranked = F.array_sort(F.transform(boxes, lambda b: F.struct((-(b["w"].cast("long") * b["h"])).alias("rank"), b["ord"].alias("ord"), b["x"].alias("x"), b["y"].alias("y"), b["w"].alias("w"), b["h"].alias("h"))))
    empty = F.slice(ranked, 1, 0)
    return F.aggregate(ranked, empty, lambda kept, b: F.when(F.exists(kept, lambda k: inside(b, k, slack)), kept).otherwise(F.concat(kept, F.array(b))))


def difference_bits(values: Column, width: int) -> Column:
    """A number whose bits, highest first, say where a value is larger than the next one in its row of `width` values."""
    n = F.size(values)
    places = F.filter(F.sequence(F.lit(0), n - 2), lambda i: (i + 1) % width != 0)
    bits = F.transform(places, lambda i: F.when(F.get(values, i) > F.get(values, i + 1), 1).otherwise(0).cast("long"))
    return F.aggregate(bits, F.lit(0).cast("long"), lambda a, b: F.shiftleft(a, 1).bitwiseOR(b))
