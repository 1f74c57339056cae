"""Rectangles on a page as Column arithmetic. A box is four columns x0, y0, x1, y1."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Layout tolerances.
MIN_OVERLAP, TEXT_WINS, PICTURE_LEAD, OVERSHOOT = 0.15, 0.5, 0.1, 0.3
COLUMN_OVERLAP, GAP_RATIO, MIN_GAP = 0.35, 0.5, 40.0
PICTURES = ["Picture", "Figure"]
#: Height of a band in pixels, and the last one: pages are joined band by band.
BAND, LAST_BAND = 64.0, 1023

Box = Callable[[str], Column]


def box(prefix: str = "") -> Box:
    """box("b_")("x0") is the column b_x0."""
    return lambda side: F.col(prefix + side)


def overlap_fraction(line: Box, area: Box) -> Column:
    """Share of the line's surface (one unit at least) that the area covers."""
    w = F.greatest(F.lit(0.0), F.least(line("x1"), area("x1")) - F.greatest(line("x0"), area("x0")))
    h = F.greatest(F.lit(0.0), F.least(line("y1"), area("y1")) - F.greatest(line("y0"), area("y0")))
    return w * h / F.greatest(F.lit(1.0), (line("x1") - line("x0")) * (line("y1") - line("y0")))


def bleeds(left: Column, right: Column, area: Box) -> Column:
    """J4. Text from left to right sticks out of the area by too much of its width."""
    return F.greatest(area("x0") - left, right - area("x1")) > OVERSHOOT * F.greatest(area("x1") - area("x0"), F.lit(1.0))


def same_column(a: Box, b: Box) -> Column:
    """W2."""
    wide = lambda r: F.greatest(r("x1") - r("x0"), F.lit(1.0))
    shared = F.greatest(F.lit(0.0), F.least(a("x1"), b("x1")) - F.greatest(a("x0"), b("x0")))
    return shared >= COLUMN_OVERLAP * F.least(wide(a), wide(b))


def gap_ok(before: Box, after: Box, ratio: float = GAP_RATIO, least: float = MIN_GAP) -> Column:
    """W3."""
    return after("y0") - before("y1") <= F.greatest(F.lit(least), F.lit(ratio) * F.greatest(before("y1") - before("y0"), after("y1") - after("y0")))


def x_center(b: Box) -> Column:
    """X6."""
    return (b("x0") + b("x1")) / 2


def y_center(b: Box) -> Column:
    return (b("y0") + b("y1")) / 2


def bands(low: Column, high: Column) -> Column:
    """The bands of BAND pixels that a stretch of the page meets, as an array; null of null or none.

    Two stretches that meet share a band, so they can be joined on it. Positions beyond the
    page are in its first or last band.
    """
    at = lambda y: F.least(F.greatest(F.floor(y / BAND), F.lit(0)), F.lit(LAST_BAND)).cast("int")
    return F.when(low <= high, F.sequence(at(low), at(high)))


def first_shared(a: Column, b: Column) -> Column:
    """The first band that two arrays of bands share, so that a pair counts once."""
    return F.greatest(F.get(a, F.lit(0)), F.get(b, F.lit(0)))


def upper_median(values: Column) -> Column:
    """A2. The upper of the two middle values; 0.0 of none."""
    return F.coalesce(F.get(F.array_sort(values), F.floor(F.size(values) / 2).cast("int")), F.lit(0.0))
