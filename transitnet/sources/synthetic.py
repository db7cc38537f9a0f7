"""A synthetic network by hash draws: any size, the same rows on every run, made by the executors."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from transitnet.functions.geo import with_bbox
from transitnet.functions.ids import unit

#: Road classes and the share of edges of each.
CLASSES = (("primary", 0.08), ("secondary", 0.17), ("tertiary", 0.25), ("residential", 0.35), ("unclassified", 0.15))


def network(spark: SparkSession, n: int, cities: int = 39, most_services: int = 64) -> dict[str, DataFrame]:
    """edges and edge_services: edges around cities by rank, services geometric with a mean near 2.4."""
    i = F.col("id")
    city = F.floor(F.pow(unit(i, "city"), 2) * (cities + 1)).cast("int")
    radius, angle = 60_000 * F.sqrt(unit(i, "r")) / (city + 1), 6.283185307 * unit(i, "a")
    x = -3_000_000 + (city * 377_000) % 4_000_000 + radius * F.cos(angle)
    y = 50_500_000 + (city * 611_000) % 5_000_000 + radius * F.sin(angle)
    points = (3 + F.floor(unit(i, "n") * 4)).cast("int")
    walk = lambda start, salt: F.transform(F.sequence(F.lit(1), points), lambda k: (start + k * 300 * (unit(F.concat(i.cast("string"), F.lit(":"), k.cast("string")), salt) - 0.4)).cast("int"))
    kind, edge = F.lit(CLASSES[-1][0]), 1.0
    for name, share in reversed(CLASSES[:-1]):
        edge = sum(s for c, s in CLASSES[: [c for c, _ in CLASSES].index(name) + 1])
        kind = F.when(unit(i, "class") < edge, name).otherwise(kind)
    edges = spark.range(n).select(
        i.alias("edge_id"), F.floor(i / 4).alias("way_id"), F.when(unit(i, "name") < 0.7, F.concat(F.lit("Road "), F.floor(i / 4).cast("string"))).alias("road_name"),
        kind.alias("road_class"), (20 + 180 * unit(i, "length")).alias("length_m"), walk(x, "x").alias("lon_e6"), walk(y, "y").alias("lat_e6"),
    )
    many = F.least(F.floor(F.log(1 - unit(i, "services")) / F.log(F.lit(0.7))).cast("int"), F.lit(most_services))
    services = spark.range(n).withColumn("k", F.explode(F.when(many > 0, F.sequence(F.lit(1), many)).otherwise(F.array().cast("array<int>"))))
    key = F.concat(i.cast("string"), F.lit("/"), F.col("k").cast("string"))
    services = services.select(
        i.alias("edge_id"), F.concat(F.lit("S"), F.floor(unit(key, "s") * 900).cast("string")).alias("short_name"), F.concat(F.lit("OP"), F.floor(unit(key, "o") * 40).cast("string")).alias("agency_id"),
        (1 + F.floor(unit(key, "p") * 4)).alias("n_patterns"), (5 + F.floor(unit(key, "t") * 400)).alias("n_trips"),
    )
    return {"edges": with_bbox(edges), "edge_services": services.dropDuplicates(["edge_id", "short_name", "agency_id"])}


def clip(points: DataFrame, box: tuple[float, float, float, float]) -> DataFrame:
    """(line, run, points): lines clipped to a window, segments with an end inside kept, broken into runs where they leave.

    points: (line, seq, lat, lon).
    """
    from pyspark.sql import Window

    west, south, east, north = box
    w = Window.partitionBy("line").orderBy("seq")
    inside = F.col("lat").between(south, north) & F.col("lon").between(west, east)
    rows = points.withColumn("in", inside)
    rows = rows.withColumn("keep", F.col("in") | F.coalesce(F.lead("in").over(w), F.lit(False)) | F.coalesce(F.lag("in").over(w), F.lit(False)))
    starts = F.col("keep") & ~(F.coalesce(F.lag("keep").over(w), F.lit(False)) & (F.col("in") | F.coalesce(F.lag("in").over(w), F.lit(False))))
    rows = rows.withColumn("run", F.sum(starts.cast("int")).over(w)).where("keep")
    out = rows.groupBy("line", "run").agg(F.sort_array(F.collect_list(F.struct("seq", "lat", "lon"))).alias("p")).where(F.size("p") >= 2)
    return out.select("line", "run", F.transform("p", lambda p: F.struct(p["lat"], p["lon"])).alias("points"))
