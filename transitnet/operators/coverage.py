"""What a set of features covers: cells, bands of density, quotas and floors, and pixels."""

from __future__ import annotations

import math
import struct
import zlib

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def cell(x: Column, size: float) -> Column:
    """The cell of a coordinate; halves go to the even cell."""
    return F.bround(x / size).cast("long")


def drawn(features: DataFrame, size: float) -> DataFrame:
    """(zoom, cx, cy, n): features by the cell of their first point."""
    return features.groupBy("zoom", cell(F.col("x"), size).alias("cx"), cell(F.col("y"), size).alias("cy")).agg(F.count("*").alias("n"))


def bands(counts: DataFrame, by: list[str], value: str = "n", groups: int = 4) -> DataFrame:
    """(by, band, cells, median): a group's rows ranked by value and cut into equal bands, the rest in the last; each band's upper median.

    Each group is ranked alone: a group is one zoom's cells, which a grid bounds.
    """
    w = Window.partitionBy(*by).orderBy(value, *[c for c in ("cx", "cy", "key") if c in counts.columns])
    rows = counts.withColumns({"_k": F.row_number().over(w) - 1, "_n": F.count("*").over(Window.partitionBy(*by))})
    quarter = F.greatest(F.floor(F.col("_n") / groups), F.lit(1))
    rows = rows.withColumn("band", F.least(F.floor(F.col("_k") / quarter), F.lit(groups - 1)))
    return upper_median(rows, [*by, "band"], value)


def upper_median(rows: DataFrame, by: list[str], value: str) -> DataFrame:
    """(by, cells, median): the value of rank n // 2, counted from 0."""
    w = Window.partitionBy(*by).orderBy(value)
    ranked = rows.withColumns({"_r": F.row_number().over(w) - 1, "_c": F.count("*").over(Window.partitionBy(*by))})
    return ranked.groupBy(*by).agg(F.count("*").alias("cells"), F.max(F.when(F.col("_r") == F.floor(F.col("_c") / 2), F.col(value))).alias("median"))


def sizes(tiles: DataFrame) -> DataFrame:
    """(zoom, cells, median, most, total) of tiles (zoom, bytes)."""
    return upper_median(tiles, ["zoom"], "bytes").join(tiles.groupBy("zoom").agg(F.max("bytes").alias("most"), F.sum("bytes").alias("total")), "zoom")


def floors(rows: DataFrame, quota: int | Column, by: str = "cell", value: str = "trips") -> DataFrame:
    """(cell, floor): the least value down to which a cell's features stay within its quota; its busiest always stay.

    Features are counted by value first, so a cell's window holds its distinct values.
    """
    counts = rows.groupBy(by, value).agg(F.count("*").alias("n"))
    down = Window.partitionBy(by).orderBy(F.desc(value))
    upto = F.sum("n").over(down)
    first = F.row_number().over(down) == 1
    return counts.withColumns({"_upto": upto, "_first": first}).where((F.col("_upto") <= quota) | F.col("_first")).groupBy(by).agg(F.min(value).alias("floor"))


def hold_back(features: DataFrame, floors: DataFrame, by: str = "cell", value: str = "trips") -> DataFrame:
    """Features at or above their cell's floor."""
    return features.join(floors, by).where(F.col(value) >= F.col("floor")).drop("floor")


def quotas(sizes: DataFrame, cap: int, weight: float, by: str = "cell", size: str = "n") -> DataFrame:
    """(cell, quota): a cap divided in proportion to size ** weight; no cell gets more than its size, what is over is divided again, each gets one.

    Cells fill up in the order of size over share, so one cumulative pass finds who is full. The grid bounds the number of cells.
    """
    rows = sizes.withColumn("_w", F.pow(F.col(size).cast("double"), weight))
    every, filling = Window.partitionBy(F.lit(1)), Window.orderBy(F.col(size) / F.col("_w"), by)
    before = filling.rowsBetween(Window.unboundedPreceding, -1)
    left = cap - F.coalesce(F.sum(size).over(before), F.lit(0))
    level = left / (F.sum("_w").over(every) - F.coalesce(F.sum("_w").over(before), F.lit(0.0)))
    rows = rows.withColumns({"_level": level}).withColumn("_full", F.col("_level") * F.col("_w") >= F.col(size))
    open_level = F.min(F.when(~F.col("_full"), F.struct(F.col(size) / F.col("_w"), by, "_level"))).over(every)["_level"]
    share = F.when(F.col("_full"), F.col(size)).otherwise(F.least(F.floor(open_level * F.col("_w")), F.col(size)))
    return rows.select(by, F.greatest(share, F.lit(1)).cast("long").alias("quota"))


def pixels(segments: DataFrame) -> DataFrame:
    """(px, py, rgb) from (x0, y0, x1, y1, weight, rgb): every pixel of each line, the heaviest line on top, of equals the largest colour.

    A line's pixels are steps along its longer axis. Compositing is an aggregate: order doesn't matter, and it combines before the shuffle.
    """
    dx, dy = F.col("x1") - F.col("x0"), F.col("y1") - F.col("y0")
    n = F.greatest(F.abs(dx), F.abs(dy), F.lit(1))
    step = segments.select("weight", "rgb", "x0", "y0", dx.alias("dx"), dy.alias("dy"), n.alias("n"), F.explode(F.sequence(F.lit(0), n)).alias("k"))
    at = lambda a, d: F.bround(F.col(a) + F.col("k") * F.col(d) / F.col("n")).cast("int")
    return step.groupBy(at("x0", "dx").alias("px"), at("y0", "dy").alias("py")).agg(F.max(F.struct("weight", "rgb"))["rgb"].alias("rgb"))


def shrunk(pixels: DataFrame, factor: int) -> DataFrame:
    """Pixels of a finer canvas averaged into (px, py, r, g, b, cover)."""
    return pixels.groupBy(F.floor(F.col("px") / factor).alias("px"), F.floor(F.col("py") / factor).alias("py")).agg(
        *(F.avg(F.shiftright("rgb", s).bitwiseAND(255)).alias(c) for c, s in (("r", 16), ("g", 8), ("b", 0))), (F.count("*") / (factor * factor)).alias("cover")
    )


def png(rows: list[tuple[int, int, int]], width: int, height: int) -> bytes:
    """A PNG of (px, py, rgb) on black; the canvas is what bounds it."""
    canvas = bytearray(width * height * 3)
    for x, y, rgb in rows:
        if 0 <= x < width and 0 <= y < height:
            canvas[(y * width + x) * 3 : (y * width + x) * 3 + 3] = rgb.to_bytes(3, "big")
    raw = b"".join(b"\0" + canvas[y * width * 3 : (y + 1) * width * 3] for y in range(height))
    chunk = lambda kind, data: struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", width, height, 8, 2, 0, 0, 0)) + chunk(b"IDAT", zlib.compress(raw, 9)) + chunk(b"IEND", b"")


def band_cuts(edges: DataFrame, parts: int) -> list[float]:
    """Latitudes that cut edges into bands of equal number, by interpolated quantiles of their middle."""
    mid = (F.col("min_lat_e6") + F.col("max_lat_e6")) / 2
    row = edges.agg(F.percentile(mid, [k / parts for k in range(1, parts)]).alias("q")).first()
    return sorted(set(row["q"] or []))


def canvas_height(width: int, box: tuple[float, float, float, float]) -> int:
    """The height that keeps a window's Web-Mercator shape."""
    y = lambda lat: math.log(math.tan(math.pi / 4 + math.radians(lat) / 2))
    return max(1, round(width * (y(box[3]) - y(box[1])) / math.radians(box[2] - box[0])))
