"""Geometry as Column expressions: distances, projections, cells, curves, predicates."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

EARTH_M = 6_371_000.0
M_PER_DEG = 111_320.0
#: Bounds of the British Isles: a box, cut in the south-east by a line through the Channel; fixed values.
ISLES = {"lat_min": 49.80, "lat_max": 61.10, "lon_min": -11.00, "lon_cap": 2.00, "line_lon": 0.90, "line_slope": 0.60}


def haversine_m(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Great-circle metres."""
    a = F.pow(F.sin(F.radians(lat2 - lat1) / 2), 2) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.pow(F.sin(F.radians(lon2 - lon1) / 2), 2)
    return F.lit(2 * EARTH_M) * F.asin(F.sqrt(a))


def planar_m(lat1: Column, lon1: Column, lat2: Column, lon2: Column, ref_lat: Column) -> Column:
    """Metres on a plane through ref_lat; exact enough for local distances."""
    dx, dy = (lon2 - lon1) * M_PER_DEG * F.cos(F.radians(ref_lat)), (lat2 - lat1) * M_PER_DEG
    return F.sqrt(dx * dx + dy * dy)


def in_isles(lat: Column, lon: Column) -> Column:
    b = ISLES
    line = F.least(F.lit(b["lon_cap"]), b["line_lon"] + b["line_slope"] * (lat - 50.0))
    return lat.between(b["lat_min"], b["lat_max"]) & (lon >= b["lon_min"]) & (lon <= line)


def mercator(lat: Column, lon: Column) -> tuple[Column, Column]:
    """Web-Mercator x and y from 0 to 1, y downwards."""
    return (lon + 180) / 360, (1 - F.log(F.tan(math.pi / 4 + F.radians(lat) / 2)) / math.pi) / 2


def mercator_inverse(x: Column, y: Column) -> tuple[Column, Column]:
    """(lat, lon) of Web-Mercator x and y."""
    return F.degrees(F.atan(F.sinh(math.pi * (1 - 2 * y)))), x * 360 - 180


def _spread(v: Column) -> Column:
    for shift, mask in ((8, 0x00FF00FF), (4, 0x0F0F0F0F), (2, 0x33333333), (1, 0x55555555)):
        v = v.bitwiseOR(F.shiftleft(v, shift)).bitwiseAND(F.lit(mask))
    return v


def morton(x: Column, y: Column) -> Column:
    """The Z-order code of two whole numbers of 16 bits, x in the even places."""
    low = lambda v: _spread(v.cast("long").bitwiseAND(F.lit(0xFFFF)))
    return low(x).bitwiseOR(F.shiftleft(low(y), 1))


def grid16(v: Column, least: float, most: float) -> Column:
    """A coordinate as one of 65,536 steps between two bounds."""
    return F.least(F.greatest(F.floor((v - least) / (most - least) * 65535), F.lit(0)), F.lit(65535)).cast("long")


def overlaps(box: tuple[int, int, int, int], prefix: str = "") -> Column:
    """Four comparisons that the scan can prune by: a bbox in micro-degrees against (min_lon, min_lat, max_lon, max_lat)."""
    west, south, east, north = box
    c = lambda n: F.col(prefix + n)
    return (c("max_lon_e6") >= west) & (c("min_lon_e6") <= east) & (c("max_lat_e6") >= south) & (c("min_lat_e6") <= north)


def touches(box: tuple[int, int, int, int]) -> Column:
    """Whether a polyline's own extent meets the window, and it has two points at least."""
    west, south, east, north = box
    lon, lat = F.col("lon_e6"), F.col("lat_e6")
    return (F.size(lon) >= 2) & (F.array_max(lon) >= west) & (F.array_min(lon) <= east) & (F.array_max(lat) >= south) & (F.array_min(lat) <= north)


def with_bbox(df):
    """df with the four bbox columns of its polyline."""
    return df.withColumns({"min_lon_e6": F.array_min("lon_e6"), "min_lat_e6": F.array_min("lat_e6"), "max_lon_e6": F.array_max("lon_e6"), "max_lat_e6": F.array_max("lat_e6")})


def to_e6(points: Column) -> Column:
    """(lon_e6, lat_e6) of array<struct<lat, lon>>; null below two points."""
    e6 = lambda name: F.when(F.size(points) >= 2, F.transform(points, lambda p: F.bround(p[name] * 1_000_000).cast("int")))
    return F.struct(e6("lon").alias("lon_e6"), e6("lat").alias("lat_e6"))


def same_length(lon: Column, lat: Column) -> Column:
    """The first list; raises where the two parallel lists differ in length."""
    return F.when(F.size(lon) == F.size(lat), lon).otherwise(F.raise_error(F.lit("parallel coordinate lists differ in length")).cast("array<int>"))


def parse_window(text: str, presets: dict[str, tuple[float, float, float, float]] | None = None) -> tuple[float, float, float, float]:
    """A preset's name, or min_lon,min_lat,max_lon,max_lat in degrees."""
    presets = presets or {}
    if text in presets:
        return presets[text]
    try:
        west, south, east, north = (float(p) for p in text.split(","))
    except ValueError:
        raise ValueError(f"window {text!r} is neither min_lon,min_lat,max_lon,max_lat nor one of: {', '.join(sorted(presets)) or 'none'}") from None
    if not (-180 <= west < east <= 180 and -90 <= south < north <= 90):
        raise ValueError(f"window {text!r} is empty or not on the globe")
    return west, south, east, north


def pad_and_clip(box: tuple[float, float, float, float], pad: float) -> tuple[float, float, float, float]:
    """A window widened by pad and cut back to the British Isles' box."""
    b = ISLES
    west, south, east, north = box[0] - pad, box[1] - pad, box[2] + pad, box[3] + pad
    return max(west, b["lon_min"]), max(south, b["lat_min"]), min(east, b["lon_cap"]), min(north, b["lat_max"])


def extent(df, lat: str = "lat", lon: str = "lon", pad: float = 0.0) -> tuple[float, float, float, float] | None:
    """The window of all points inside the British Isles, padded and clipped; None without points. One aggregate."""
    row = df.where(in_isles(F.col(lat), F.col(lon))).agg(F.min(lon), F.min(lat), F.max(lon), F.max(lat)).first()
    return None if row[0] is None else pad_and_clip(tuple(row), pad)


def wkt_to_e6(wkt: Column) -> Column:
    """struct<lon_e6, lat_e6> of a LINESTRING text, as older stores held geometry."""
    inside = F.regexp_extract(wkt, r"(?i)^\s*LINESTRING\s*\(([^()]*)\)\s*$", 1)
    points = F.transform(F.split(F.trim(inside), r"\s*,\s*"), lambda p: F.split(F.trim(p), r"\s+"))
    e6 = lambda k: F.when(F.length(inside) > 0, F.transform(points, lambda p: F.bround(F.get(p, k).cast("double") * 1_000_000).cast("int")))
    return F.struct(e6(0).alias("lon_e6"), e6(1).alias("lat_e6"))


def points_to_e6(points: Column) -> Column:
    """struct<lon_e6, lat_e6> of array<struct<lon_e6, lat_e6>>, as other older stores held it."""
    return F.struct(F.transform(points, lambda p: p["lon_e6"]).alias("lon_e6"), F.transform(points, lambda p: p["lat_e6"]).alias("lat_e6"))


def fit(box: tuple[float, float, float, float], width: int, height: int, margin: float = 0.0) -> tuple[float, float, float]:
    """(scale, x0, y0) that put a window's Web-Mercator square into a canvas, letterboxed: pixel = (mercator - origin) * scale."""
    y = lambda lat: (1 - math.log(math.tan(math.pi / 4 + math.radians(lat) / 2)) / math.pi) / 2
    x0, x1, y0, y1 = (box[0] + 180) / 360, (box[2] + 180) / 360, y(box[3]), y(box[1])
    scale = min((width - 2 * margin) / (x1 - x0), (height - 2 * margin) / (y1 - y0))
    return scale, (x0 + x1) / 2 - width / 2 / scale, (y0 + y1) / 2 - height / 2 / scale


def packed(x: Column, y: Column) -> Column:
    """Two whole numbers of 32 bits in one, to be used as a key."""
    return F.shiftleft(x.cast("long"), 32).bitwiseOR(y.cast("long").bitwiseAND(F.lit(0xFFFFFFFF)))


def unpacked(key: Column) -> tuple[Column, Column]:
    low = key.bitwiseAND(F.lit(0xFFFFFFFF))
    return F.shiftright(key, 32), F.when(low >= 1 << 31, low - (1 << 32)).otherwise(low)
