"""Boxes with normalized corners: origin at the top left, y downward."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Strips merge across gaps and offsets up to these, if they span this share of the page.
MAX_OFFSET, MAX_GAP, SPAN = 5.0, 2.0, 0.9


def valid(b: Column) -> Column:
    """Whether corners are within the page and in order; a box without area is valid. A NULL box is not."""
    inside = [(b[k] >= 0) & (b[k] <= 1) for k in ("x0", "y0", "x1", "y1")]
    return F.coalesce(inside[0] & inside[1] & inside[2] & inside[3] & (b["x1"] >= b["x0"]) & (b["y1"] >= b["y0"]), F.lit(False))


def width(b: Column) -> Column:
    return b["x1"] - b["x0"]


def height(b: Column) -> Column:
    return b["y1"] - b["y0"]


def area(b: Column) -> Column:
    return width(b) * height(b)


def clamped(b: Column) -> Column:
    """The box within the page, NULL if nothing of it is there or it has no area."""
    c = {k: F.greatest(F.lit(0.0), F.least(F.lit(1.0), b[k])) for k in ("x0", "y0", "x1", "y1")}
    return F.when((c["x1"] > c["x0"]) & (c["y1"] > c["y0"]), F.struct(*(v.alias(k) for k, v in c.items())))


def to_pixels(b: Column, page_width: Column, page_height: Column) -> Column:
    """Corners in pixels, halves rounded to even."""
    return F.array(*(F.bround(b[k] * s).cast("int") for k, s in (("x0", page_width), ("y0", page_height), ("x1", page_width), ("y1", page_height))))


def to_points(b: Column, page_width: Column, page_height: Column) -> Column:
    return F.array(b["x0"] * page_width, b["y0"] * page_height, b["x1"] * page_width, b["y1"] * page_height)


def crop(b: Column, page_width: Column, page_height: Column) -> Column:
    """Corners of a crop in pixels, rounded toward zero."""
    return F.array(*((b[k] * s).cast("int") for k, s in (("x0", page_width), ("y0", page_height), ("x1", page_width), ("y1", page_height))))


def tiny(b: Column, width_pt: float, height_pt: float, dpi: int = 200, least_px: int = 10) -> Column:
    """Whether a region, rendered at ``dpi``, falls short of ``least_px`` in either direction."""
    zoom = dpi / 72.0
    return (width(b) * width_pt * zoom < least_px) | (height(b) * height_pt * zoom < least_px)


def merged_strips(boxes: Column, page_width: Column, page_height: Column) -> Column:
    """Pictures with the slices of one picture joined: array<struct<x0,y0,x1,y1,id>> in, the same out.

    Equal boxes count once, the first stays. In order of (y0, x0) each box joins the picture before it if it spans the
    page in one direction, continues that picture within ``MAX_GAP`` and is in line with it within ``MAX_OFFSET``; the
    comparison is with the picture as merged so far, which makes it a fold.
    """
    kind = "array<struct<x0:double,y0:double,x1:double,y1:double,id:bigint>>"
    at = F.transform(boxes, lambda b, i: F.struct(b["y0"].alias("y0"), b["x0"].alias("x0"), i.alias("i"), b.alias("b")))
    first = F.filter(at, lambda s: ~F.exists(at, lambda o: (o["i"] < s["i"]) & (o["b"]["x0"] == s["b"]["x0"]) & (o["b"]["y0"] == s["b"]["y0"]) & (o["b"]["x1"] == s["b"]["x1"]) & (o["b"]["y1"] == s["b"]["y1"])))
    ordered = F.transform(F.array_sort(first), lambda s: s["b"])

    def near(a: Column, b: Column, most: float) -> Column:
        return F.abs(a - b) <= most

    def step(done: Column, b: Column) -> Column:
        last = F.try_element_at(done, F.lit(-1))
        across = (page_width > 0) & (F.abs(width(b)) >= page_width * SPAN) & near(last["x0"], b["x0"], MAX_OFFSET) & near(last["x1"], b["x1"], MAX_OFFSET) & near(b["y0"], last["y1"], MAX_GAP)
        down = (page_height > 0) & (F.abs(height(b)) >= page_height * SPAN) & near(last["y0"], b["y0"], MAX_OFFSET) & near(last["y1"], b["y1"], MAX_OFFSET) & near(b["x0"], last["x1"], MAX_GAP)
        joined = F.struct(F.least(b["x0"], last["x0"]).alias("x0"), F.least(b["y0"], last["y0"]).alias("y0"), F.greatest(b["x1"], last["x1"]).alias("x1"), F.greatest(b["y1"], last["y1"]).alias("y1"), b["id"].alias("id"))
        joins = F.coalesce(across | down, F.lit(False)) & (F.size(done) > 0)
        return F.when(joins, F.concat(F.slice(done, 1, F.greatest(F.lit(0), F.size(done) - 1)), F.array(joined))).otherwise(F.concat(done, F.array(b)))

    return F.aggregate(ordered.cast(kind), F.array().cast(kind), step)
