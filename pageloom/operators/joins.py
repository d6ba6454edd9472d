"""Joins that Spark plans badly from a bare condition, as equi-joins on buckets."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def bucketed_band_join(left: DataFrame, right: DataFrame, on: Sequence[str], left_value: str, right_value: str, band: float) -> DataFrame:
    """Pairs with equal ``on`` columns and |left_value - right_value| < band.

    The left side goes to the bucket of its value and both neighbours, the
    right side to its own: one equi-join, no pair twice. Other column names
    must differ. A null value pairs with nothing.
    """
    bucket = lambda c: F.floor(F.col(c) / F.lit(float(band))).cast("long")
    a = left.withColumn("_bucket", F.explode(F.sequence(bucket(left_value) - 1, bucket(left_value) + 1)))
    b = right.withColumn("_bucket", bucket(right_value))
    return a.join(b, [*on, "_bucket"]).where(F.abs(F.col(left_value) - F.col(right_value)) < band).drop("_bucket")


def grid_join(left: DataFrame, right: DataFrame, on: Sequence[str], left_xy: tuple[str, str], right_xy: tuple[str, str], radius: float) -> DataFrame:
    """Pairs with equal ``on`` columns whose points are nearer than ``radius``: cells of that size, 3 x 3 neighbours."""
    cell = lambda c: F.floor(F.col(c) / F.lit(float(radius))).cast("long")
    around = lambda c: F.explode(F.sequence(cell(c) - 1, cell(c) + 1))
    a = left.withColumn("_cx", around(left_xy[0])).withColumn("_cy", around(left_xy[1]))
    b = right.withColumn("_cx", cell(right_xy[0])).withColumn("_cy", cell(right_xy[1]))
    dx, dy = F.col(left_xy[0]) - F.col(right_xy[0]), F.col(left_xy[1]) - F.col(right_xy[1])
    return a.join(b, [*on, "_cx", "_cy"]).where(F.sqrt(dx * dx + dy * dy) < radius).drop("_cx", "_cy")
