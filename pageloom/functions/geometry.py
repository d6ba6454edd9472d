"""Boxes as Column expressions. A box is four integer columns x_min, y_min, x_max, y_max."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

SIDES = ("x_min", "y_min", "x_max", "y_max")


@dataclass(frozen=True)
class Box:
    """Four columns that belong together."""

    x_min: Column
    y_min: Column
    x_max: Column
    y_max: Column

    @classmethod
    def of(cls, prefix: str = "") -> Box:
        return cls(*[F.col(prefix + s) for s in SIDES])

    @property
    def width(self) -> Column:
        return self.x_max - self.x_min

    @property
    def height(self) -> Column:
        return self.y_max - self.y_min

    @property
    def area(self) -> Column:
        return self.width * self.height

    @property
    def center(self) -> tuple[Column, Column]:
        return (self.x_min + self.x_max) / 2, (self.y_min + self.y_max) / 2

    @property
    def valid(self) -> Column:
        return (self.x_min < self.x_max) & (self.y_min < self.y_max)

    def named(self, prefix: str = "") -> list[Column]:
        return [c.cast("int").alias(prefix + s) for s, c in zip(SIDES, (self.x_min, self.y_min, self.x_max, self.y_max), strict=True)]

    def struct(self) -> Column:
        return F.struct(*self.named())

    def moved(self, dx: Column, dy: Column) -> Box:
        return Box(self.x_min + dx, self.y_min + dy, self.x_max + dx, self.y_max + dy)

    def union(self, other: Box) -> Box:
        return Box(F.least(self.x_min, other.x_min), F.least(self.y_min, other.y_min), F.greatest(self.x_max, other.x_max), F.greatest(self.y_max, other.y_max))

    def padded(self, width: int, height: int, part_x: float = 0.0125, part_y: float = 0.005) -> Box:
        """Grown by a part of the page on every side, kept on the page."""
        px, py = int(part_x * width), int(part_y * height)
        return Box(F.greatest(self.x_min - px, F.lit(0)), F.greatest(self.y_min - py, F.lit(0)), F.least(self.x_max + px, F.lit(width)), F.least(self.y_max + py, F.lit(height)))

    def clamped(self, width: int, height: int, inset: int = 5) -> Box:
        """Far sides beyond the page are set ``inset`` inside it; near sides stay."""
        return Box(self.x_min, self.y_min, F.when(self.x_max > width, width - inset).otherwise(self.x_max), F.when(self.y_max > height, height - inset).otherwise(self.y_max))

    def corners(self) -> Column:
        """array<struct<x, y>>: (x_min, y_min), (x_min, y_max), (x_max, y_max), (x_max, y_min)."""
        return F.array(*[F.struct(x.alias("x"), y.alias("y")) for x, y in ((self.x_min, self.y_min), (self.x_min, self.y_max), (self.x_max, self.y_max), (self.x_max, self.y_min))])


def from_corners(corners: Column) -> Box:
    """A box from its first and third corner."""
    a, c = corners.getItem(0), corners.getItem(2)
    return Box(a["x"], a["y"], c["x"], c["y"])


def distance(x0: Column, y0: Column, x1: Column, y1: Column) -> Column:
    return F.sqrt((x0 - x1) * (x0 - x1) + (y0 - y1) * (y0 - y1))


def distance_n(a: Column, b: Column) -> Column:
    """Distance of two points given as arrays of as many coordinates as they have; null if these differ in number."""
    squares = F.aggregate(F.zip_with(a, b, lambda x, y: (x - y) * (x - y)), F.lit(0.0), lambda s, v: s + v)
    return F.when(F.size(a) == F.size(b), F.sqrt(squares))


def within(x0: Column, y0: Column, x1: Column, y1: Column, radius: float) -> Column:
    return distance(x0, y0, x1, y1) < radius


def aligned_vertically(a: Box, b: Box, part: float = 0.05) -> Column:
    """Left and right sides differ by less than a part of the mean width. Not transitive."""
    w = (a.width + b.width) / 2
    return (F.abs(a.x_min - b.x_min) < part * w) & (F.abs(a.x_max - b.x_max) < part * w)


def aligned_horizontally(a: Box, b: Box, part: float = 0.05) -> Column:
    h = (a.height + b.height) / 2
    return (F.abs(a.y_min - b.y_min) < part * h) & (F.abs(a.y_max - b.y_max) < part * h)


def intersects(a: Box, b: Box) -> Column:
    """Open rectangles overlap."""
    return (a.x_min < b.x_max) & (b.x_min < a.x_max) & (a.y_min < b.y_max) & (b.y_min < a.y_max)


def contains_strictly(outer: Box, inner: Box) -> Column:
    """All corners of inner lie inside outer, none on its edge."""
    return (inner.x_min > outer.x_min) & (inner.x_max < outer.x_max) & (inner.y_min > outer.y_min) & (inner.y_max < outer.y_max)


def overlap_area(a: Box, b: Box) -> Column:
    w = F.greatest(F.lit(0), F.least(a.x_max, b.x_max) - F.greatest(a.x_min, b.x_min)).cast("long")
    return w * F.greatest(F.lit(0), F.least(a.y_max, b.y_max) - F.greatest(a.y_min, b.y_min))


def iou(a: Box, b: Box) -> Column:
    """Intersection over union; 0 for boxes without area."""
    i = overlap_area(a, b)
    return F.when(a.valid & b.valid, i / (a.area.cast("long") + b.area - i)).otherwise(F.lit(0.0))


def overlap_on_smaller(a: Box, b: Box) -> Column:
    """Intersection over the smaller area; 0 for boxes without area."""
    return F.when(a.valid & b.valid, overlap_area(a, b) / F.least(a.area, b.area)).otherwise(F.lit(0.0))


def inclusive_overlap(small: Box, big: Box) -> Column:
    """Shared pixels over the pixels of ``small``, sides included."""
    w = F.greatest(F.lit(0), F.least(small.x_max, big.x_max) - F.greatest(small.x_min, big.x_min) + 1)
    h = F.greatest(F.lit(0), F.least(small.y_max, big.y_max) - F.greatest(small.y_min, big.y_min) + 1)
    return (w * h) / ((small.width + 1) * (small.height + 1))


def relative_to_pixels(left: Column, top: Column, width: Column, height: Column, page_w: Column, page_h: Column) -> Box:
    """A box in parts of the page, in pixels, cut to whole numbers."""
    return Box((page_w * left).cast("int"), (page_h * top).cast("int"), (page_w * (left + width)).cast("int"), (page_h * (top + height)).cast("int"))


def grid_to_page(value: Column, page: Column, grid: int = 512) -> Column:
    """A place on the mask's grid, on the page: value / grid * page, cut."""
    return (value / F.lit(float(grid)) * page).cast("int")


def grid_to_page_by_factor(value: Column, page: Column, grid: int = 512) -> Column:
    """The same by value * (page / grid), which rounds elsewhere."""
    return (value * (page / F.lit(float(grid)))).cast("int")
