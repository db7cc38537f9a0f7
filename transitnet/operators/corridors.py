"""Corridors: features that continue each other straightest, ranked, and thinned to a quota in each cell."""

from __future__ import annotations

import math

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, IntegerType, StructField, StructType

from transitnet.operators.graph import checkpointed, components

#: Two ends continue each other if they turn by this many degrees at most, seen over so many metres.
TURN, REACH_M = 60.0, 50.0
DEG_M = 111_320.0


@F.pandas_udf(ArrayType(StructType([StructField("x", IntegerType()), StructField("y", IntegerType()), StructField("dx", DoubleType()), StructField("dy", DoubleType())])))
def outward(lon: pd.Series, lat: pd.Series) -> pd.Series:
    """Both ends of a polyline: its point, and the unit direction in which the line leaves it, over REACH_M."""
    out = []
    for xs, ys in zip(lon, lat, strict=True):
        ends = []
        for order in (range(len(xs)), range(len(xs) - 1, -1, -1)):
            k = list(order)
            scale, along = math.cos(math.radians(ys[k[0]] / 1e6)), 0.0
            dx = dy = 0.0
            for a, b in zip(k, k[1:], strict=False):
                sx, sy = (int(xs[b]) - int(xs[a])) / 1e6 * DEG_M * scale, (int(ys[b]) - int(ys[a])) / 1e6 * DEG_M
                along += math.hypot(sx, sy)
                dx, dy = dx + sx, dy + sy
                if along >= REACH_M:
                    break
            size = math.hypot(dx, dy) or 1.0
            ends.append({"x": int(xs[k[0]]), "y": int(ys[k[0]]), "dx": dx / size, "dy": dy / size})
        out.append(ends)
    return pd.Series(out)


def links(features: DataFrame) -> DataFrame:
    """(a, b): features whose ends at a node are each other's straightest continuation.

    At a node, ends are ordered by the angle in which they leave; what continues an end straightest is next to its opposite angle, on
    either side, so each end meets two others however many there are. Ends of equal angle are stood for by the least. A link is
    one that both ends keep.
    """
    ends = features.select("id", F.posexplode(outward("lon_e6", "lat_e6")).alias("end", "e")).select("id", "end", F.struct("e.x", "e.y").alias("node"), "e.dx", "e.dy")
    ends = checkpointed(ends.withColumn("at", F.round(F.atan2("dy", "dx"), 9)))
    leaving = ends.groupBy("node", "at").agg(F.min(F.struct("id", "end", "dx", "dy")).alias("other"))
    nobody = F.lit(None).cast(leaving.schema["other"].dataType)
    opposite = F.when(F.col("at") > 0, F.col("at") - round(math.pi, 9)).otherwise(F.col("at") + round(math.pi, 9))
    rows = leaving.select("node", "at", F.lit(0).alias("asks"), "other", nobody.alias("own")).union(ends.select("node", opposite, F.lit(1), nobody, F.struct("id", "end", "dx", "dy")))
    whole = Window.partitionBy("node")
    below = F.last("other", ignorenulls=True).over(whole.orderBy("at", "asks").rowsBetween(Window.unboundedPreceding, 0))
    above = F.last("other", ignorenulls=True).over(whole.orderBy(F.desc("at"), "asks").rowsBetween(Window.unboundedPreceding, 0))
    placed = F.when(F.col("asks") == 0, F.struct("at", "other"))
    rows = rows.select("own", "asks", F.coalesce(below, F.max(placed).over(whole)["other"]).alias("below"), F.coalesce(above, F.min(placed).over(whole)["other"]).alias("above")).where("asks = 1")
    pairs = rows.select("own", F.explode(F.array_distinct(F.array("below", "above"))).alias("other")).where("own.id <> other.id or own.end <> other.end")
    straight = -(F.col("own.dx") * F.col("other.dx") + F.col("own.dy") * F.col("other.dy"))
    pairs = pairs.select(F.col("own.id").alias("a"), F.col("own.end").alias("ea"), F.col("other.id").alias("b"), F.col("other.end").alias("eb"), F.round(straight, 9).alias("cos")).where(F.col("cos") >= math.cos(math.radians(TURN)))
    kept = pairs.groupBy("a", "ea").agg(F.min(F.struct((-F.col("cos")).alias("c"), "b", "eb")).alias("m")).select("a", "ea", "m.b", "m.eb")
    kept = checkpointed(kept)
    mutual = kept.alias("l").join(kept.alias("r"), (F.col("l.a") == F.col("r.b")) & (F.col("l.ea") == F.col("r.eb")) & (F.col("l.b") == F.col("r.a")) & (F.col("l.eb") == F.col("r.ea")))
    return mutual.where("l.a < l.b").select("l.a", "l.b")


def build(features: DataFrame) -> DataFrame:
    """(id, corridor): each feature's corridor, named after its least feature. features: (id, lon_e6, lat_e6)."""
    found = components(links(features))
    return features.select("id").join(found, F.col("id") == F.col("node"), "left").select("id", F.coalesce("component", "id").alias("corridor"))


def measured(members: DataFrame) -> DataFrame:
    """(corridor, length_m, features, trips) from (corridor, id, length_m, trips)."""
    return members.groupBy("corridor").agg(F.sum("length_m").alias("length_m"), F.count("*").alias("features"), F.max("trips").alias("trips"))


def ranked(corridors: DataFrame, key: str = "corridor", length: str = "length_m", trips: str = "trips") -> DataFrame:
    """Longest first, then busiest, then by name: a global order, written as one sort."""
    return corridors.orderBy(F.desc(length), F.desc(trips), key)


def select(cells: DataFrame, by: str = "cell", key: str = "corridor", order: list | None = None, cost: str = "features", quota: str = "quota") -> DataFrame:
    """The corridors that any cell keeps: a cell takes them in rank order while those before have spent less than its quota; one at least.

    cells: (cell, corridor, cost, quota, and what ``order`` sorts by).
    """
    order = order or [F.desc("length_m"), F.desc("trips"), F.col(key)]
    before = F.coalesce(F.sum(cost).over(Window.partitionBy(by).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return cells.withColumn("_before", before).where((F.col("_before") < F.col(quota)) | (F.col("_before") == 0)).select(key).distinct()
