"""Weights and values as positions on a ramp."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F


def scaled(weight: Column, low: Column, high: Column) -> Column:
    """log(1 + weight) from 0 at low to 1 at high, clamped; one half if there is nothing between them."""
    at = lambda c: F.log(1 + c)
    return F.when(high <= low, 0.5).otherwise(F.least(F.greatest((at(weight) - at(low)) / (at(high) - at(low)), F.lit(0.0)), F.lit(1.0)))


def ramp_position(value: Column, low: float = 3.0, high: float = 1000.0) -> Column:
    """A value's place on a logarithmic ramp between two values, clamped."""
    span = math.log10(high) - math.log10(low)
    return F.least(F.greatest((F.log10(F.greatest(value, F.lit(low))) - math.log10(low)) / span, F.lit(0.0)), F.lit(1.0))


def blend(stops: list[tuple[float, tuple[int, int, int]]], at: float) -> tuple[int, int, int]:
    """The colour at a place of a piecewise linear ramp."""
    if at <= stops[0][0]:
        return stops[0][1]
    for (a, c), (b, d) in zip(stops, stops[1:], strict=False):
        if at <= b:
            t = (at - a) / (b - a)
            return tuple(round(x + (y - x) * t) for x, y in zip(c, d, strict=True))
    return stops[-1][1]
