"""Boxes, crops, overlays and tiles as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _unit(x: Column) -> Column:
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), x))


def corners(cx: Column, cy: Column, w: Column, h: Column) -> Column:
    """struct(x1, y1, x2, y2) of centre and size, within the unit square."""
    return F.struct(_unit(cx - w / 2).alias("x1"), _unit(cy - h / 2).alias("y1"), _unit(cx + w / 2).alias("x2"), _unit(cy + h / 2).alias("y2"))


def from_square(box: Column, width: Column, height: Column) -> Column:
    """A box of the padded square as one of the image: x by side/width, y by side/height, within the unit square."""
    side = F.greatest(width, height).cast("double")
    x, y = side / width, side / height
    return F.struct(_unit(box["x1"] * x).alias("x1"), _unit(box["y1"] * y).alias("y1"), _unit(box["x2"] * x).alias("x2"), _unit(box["y2"] * y).alias("y2"))


def iou(a: Column, b: Column) -> Column:
    """Intersection over union of two boxes; 0 if both are empty."""
    w = F.greatest(F.lit(0.0), F.least(a["x2"], b["x2"]) - F.greatest(a["x1"], b["x1"]))
    h = F.greatest(F.lit(0.0), F.least(a["y2"], b["y2"]) - F.greatest(a["y1"], b["y1"]))
    area = lambda r: (r["x2"] - r["x1"]) * (r["y2"] - r["y1"])
    union = area(a) + area(b) - w * h
    return F.when(union > 0, w * h / union).otherwise(F.lit(0.0))


def crop_size(quad: Column, pad: int = 10) -> Column:
    """struct(w, h): longer of opposite edges of a quad of points (x, y), cut to whole pixels, and the margin."""
    side = lambda i, j: F.hypot(quad[i]["x"] - quad[j]["x"], quad[i]["y"] - quad[j]["y"])
    w, h = F.greatest(side(1, 0), side(2, 3)), F.greatest(side(3, 0), side(2, 1))
    return F.struct((w.cast("int") + 2 * pad).alias("w"), (h.cast("int") + 2 * pad).alias("h"))


# Overlay rectangles (ticker at the bottom, badge at the top right) as parts of the frame.
TICKER = {"y": 0.90625, "h": 0.052}
BADGE = {"x": 0.8138, "y": 0.0729, "w": 0.1054, "h": 0.084}


def overlay_boxes(height: Column, width: Column) -> Column:
    """array of two struct(x, y, w, h) in whole pixels."""
    part = lambda n, p: (n * F.lit(p)).cast("int")
    one = F.struct(F.lit(0).alias("x"), part(height, TICKER["y"]).alias("y"), width.cast("int").alias("w"), part(height, TICKER["h"]).alias("h"))
    two = F.struct(part(width, BADGE["x"]).alias("x"), part(height, BADGE["y"]).alias("y"), part(width, BADGE["w"]).alias("w"), part(height, BADGE["h"]).alias("h"))
    return F.array(one, two)


def tile_grid(width: Column, height: Column, most: int = 6, size: int = 448) -> Column:
    """struct(cols, rows) of the grid of at most `most` tiles whose aspect is nearest; a tie goes to the larger
    grid if the image has more than half its area. Grids count up by area, then columns."""
    shape = sorted(((i, j) for i in range(1, most + 1) for j in range(1, most + 1) if i * j <= most), key=lambda r: (r[0] * r[1], r))
    aspect, area = width.cast("double") / height, width.cast("double") * height
    zero = F.struct(F.lit(float("inf")).alias("off"), F.lit(1).alias("cols"), F.lit(1).alias("rows"))
    grids = F.array(*[F.struct(F.lit(i).alias("cols"), F.lit(j).alias("rows")) for i, j in shape])

    def step(best: Column, g: Column) -> Column:
        off = F.abs(aspect - g["cols"] / g["rows"])
        better = (off < best["off"]) | (off == best["off"]) & (area > F.lit(0.5) * size * size * g["cols"] * g["rows"])
        new = F.struct(off.alias("off"), g["cols"].alias("cols"), g["rows"].alias("rows"))
        return F.when(better, new).otherwise(best)

    best = F.aggregate(grids, zero, step)
    return F.struct(best["cols"].alias("cols"), best["rows"].alias("rows"))


def tile_boxes(grid: Column, size: int = 448, thumbnail: bool = True) -> Column:
    """Crop boxes (x1, y1, x2, y2) by rows of the resized image; with several tiles, one more for the whole image."""
    n = grid["cols"] * grid["rows"]

    def box(i: Column) -> Column:
        x, y = (i % grid["cols"]).cast("int") * size, F.floor(i / grid["cols"]).cast("int") * size
        return F.struct(x.alias("x1"), y.alias("y1"), (x + size).alias("x2"), (y + size).alias("y2"))

    tiles = F.transform(F.sequence(F.lit(0), n - 1), box)
    whole = F.struct(F.lit(0).alias("x1"), F.lit(0).alias("y1"), F.lit(size).alias("x2"), F.lit(size).alias("y2"))
    return F.when((n > 1) & F.lit(thumbnail), F.concat(tiles, F.array(whole))).otherwise(tiles)
