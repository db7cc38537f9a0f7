"""Arrays and polylines as Column expressions, and those that only code can express."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, IntegerType, StringType, StructField, StructType


def consecutive_distinct(a: Column) -> Column:
    """Without elements that equal the one before."""
    return F.filter(a, lambda x, i: (i == 0) | ~x.eqNullSafe(F.get(a, i - 1)))


def occurrences(haystack: Column, needle: Column) -> Column:
    """Places (from 0) where the needle's elements follow each other in the haystack."""
    last = F.size(haystack) - F.size(needle)
    starts = F.when((last >= 0) & (F.size(needle) > 0), F.sequence(F.lit(0), F.greatest(last, F.lit(0)))).otherwise(F.array().cast("array<int>"))
    return F.filter(starts, lambda s: F.slice(haystack, s + 1, F.size(needle)) == needle)


def occurrences_of_any(haystack: Column, needle: Column) -> Column:
    """The same where each element is an array of spellings, of which one must be shared."""
    last = F.size(haystack) - F.size(needle)
    starts = F.when((last >= 0) & (F.size(needle) > 0), F.sequence(F.lit(0), F.greatest(last, F.lit(0)))).otherwise(F.array().cast("array<int>"))
    return F.filter(starts, lambda s: F.forall(F.zip_with(F.slice(haystack, s + 1, F.size(needle)), needle, F.arrays_overlap), lambda x: x))


def thinned(points: Column, most: int = 2000) -> Column:
    """At most so many elements, evenly chosen, the last kept."""
    n = F.size(points)
    step = F.greatest(F.ceil(n / (most - 1)), F.lit(1)).cast("int")
    return F.when(n <= most, points).otherwise(F.filter(points, lambda _, i: (i % step == 0) | (i == n - 1)))


def canonical(a: Column) -> Column:
    """The smaller of an array and its reverse: the same for both directions of a street."""
    back = F.reverse(a)
    return F.when(a <= back, a).otherwise(back)


def cumulative_m(lon_e6: Column, lat_e6: Column) -> Column:
    """Planar metres from a polyline's first point to each of its points."""
    from transitnet.functions.geo import planar_m

    steps = F.transform(F.sequence(F.lit(0), F.greatest(F.size(lon_e6) - 2, F.lit(0))), lambda i: F.coalesce(planar_m(F.get(lat_e6, i) / 1e6, F.get(lon_e6, i) / 1e6, F.get(lat_e6, i + 1) / 1e6, F.get(lon_e6, i + 1) / 1e6, F.get(lat_e6, 0) / 1e6), F.lit(0.0)))
    start = F.array(F.lit(0.0))
    return F.aggregate(steps, start, lambda acc, d: F.concat(acc, F.array(F.element_at(acc, -1) + d)))


@F.pandas_udf(ArrayType(IntegerType()))
def kept_vertices(lon: pd.Series, lat: pd.Series, tolerance: pd.Series) -> pd.Series:
    """Numbers of the vertices that lie farther than the tolerance (the larger of both axes) from the last one kept; ends stay.

    Each vertex depends on the one kept before, which no array function carries cheaply.
    """
    out = []
    for xs, ys, t in zip(lon, lat, tolerance, strict=True):
        keep, n = [0], len(xs)
        for i in range(1, n - 1):
            k = keep[-1]
            if max(abs(int(xs[i]) - int(xs[k])), abs(int(ys[i]) - int(ys[k]))) > t:
                keep.append(i)
        out.append(keep + [n - 1] if n > 1 else keep[:n])
    return pd.Series(out)


def decode_polyline(text: str, precision: int = 6) -> list[tuple[float, float]]:
    """(lat, lon) of an encoded polyline: zigzag deltas in 5-bit groups; a text that ends inside a number raises."""
    values, shift, value = [], 0, 0
    for c in text:
        bits = ord(c) - 63
        value |= (bits & 31) << shift
        shift += 5
        if bits < 32:
            values.append(~(value >> 1) if value & 1 else value >> 1)
            shift = value = 0
    if shift or len(values) % 2:
        raise ValueError("the polyline ends inside a point")
    out, lat, lon, scale = [], 0, 0, 10**precision
    for dy, dx in zip(values[::2], values[1::2], strict=True):
        lat, lon = lat + dy, lon + dx
        out.append((lat / scale, lon / scale))
    return out


def encode_polyline(points: list[tuple[float, float]], precision: int = 6) -> str:
    """The inverse of decode_polyline()."""
    out, before = [], (0, 0)
    for point in points:
        now = tuple(round(v * 10**precision) for v in point)
        for v, b in zip(now, before, strict=True):
            z = (v - b) << 1
            z = ~z if v < b else z
            while z >= 32:
                out.append(chr((z & 31 | 32) + 63))
                z >>= 5
            out.append(chr(z + 63))
        before = now
    return "".join(out)


@F.pandas_udf(ArrayType(StructType([StructField("lat", DoubleType()), StructField("lon", DoubleType())])))
def polyline_points(text: pd.Series) -> pd.Series:
    return text.map(lambda t: None if t is None else [{"lat": a, "lon": b} for a, b in decode_polyline(t)])


@F.pandas_udf(StringType())
def polyline_text(points: pd.Series) -> pd.Series:
    return points.map(lambda ps: None if ps is None else encode_polyline([(p["lat"], p["lon"]) for p in ps]))
