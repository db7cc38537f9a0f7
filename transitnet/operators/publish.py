"""Features to publish: lines with their services as JSON, in an order that repeats byte for byte."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from transitnet.operators.chains import coalesce, without_reverse

#: A feature lists so many services at most; their number is kept beside.
MOST_REFS = 64


def refs(services: DataFrame, by: list[str], name: str = "short_name", trips: str = "n_trips", most: int = MOST_REFS) -> DataFrame:
    """(by, n, refs, trips): services of each item, busiest first and then by name, at most so many; n counts all of them."""
    own = services.groupBy(*by, name).agg(F.sum(trips).alias("_t"))
    rows = own.groupBy(*by).agg(F.sort_array(F.collect_list(F.struct((-F.col("_t")).alias("t"), F.col(name).alias("r")))).alias("_r"), F.sum("_t").alias("trips"))
    return rows.select(*by, F.size("_r").cast("long").alias("n"), F.transform(F.slice("_r", 1, most), lambda x: x["r"]).alias("refs"), "trips")


def line(lon: str = "lon_e6", lat: str = "lat_e6") -> Column:
    """A GeoJSON LineString of a polyline."""
    return F.struct(F.lit("LineString").alias("type"), F.zip_with(lon, lat, lambda x, y: F.array(x / 1e6, y / 1e6)).alias("coordinates"))


def features(rows: DataFrame, properties: list[str], order: list[str]) -> DataFrame:
    """(value): one JSON feature a row, properties in the order given, rows in an order without ties."""
    feature = F.struct(F.lit("Feature").alias("type"), F.struct(*properties).alias("properties"), line().alias("geometry"))
    return rows.orderBy(*order).select(F.to_json(feature).alias("value"))


def roads(edges: DataFrame, services: DataFrame) -> DataFrame:
    """Road lines: edges with equal services of one way joined end to end, one direction of a street dropped."""
    own = refs(services, ["edge_id"])
    names = services.groupBy("edge_id").agg(F.array_join(F.sort_array(F.collect_set("short_name")), "\x1f").alias("_set"))
    rows = without_reverse(edges).join(own, "edge_id").join(names, "edge_id")
    lines = coalesce(rows.select("way_id", "_set", "trips", "n", "edge_id", "lon_e6", "lat_e6"), ["way_id", "_set", "trips", "n"])
    return lines.join(own.select("edge_id", "refs"), "edge_id").join(edges.select("edge_id", F.col("road_name").alias("name")), "edge_id").select("edge_id", "way_id", "n", "refs", "trips", "name", "lon_e6", "lat_e6")


def track(services: DataFrame, ways: DataFrame, trips: DataFrame) -> DataFrame:
    """Track lines, one for each way and mode: trips from attributed legs, else the services' sum, else null."""
    own = refs(services, ["way_id", "mode"])
    return own.join(ways, "way_id").join(trips, "way_id", "left").select("way_id", "mode", "n", "refs", F.coalesce("n_trips", "trips").alias("trips"), "lon_e6", "lat_e6")


def overview(lines: DataFrame) -> DataFrame:
    """Lines for small scales: those with equal n and trips joined end to end, whatever they are called."""
    return coalesce(lines, ["n", "trips"])


def contents(**layers: DataFrame) -> dict[str, bool]:
    """Whether each layer has a row: a limit of one, not a count."""
    return {name: not df.isEmpty() for name, df in layers.items()}


def credits(layers: dict[str, bool], owners: dict[str, str]) -> list[str]:
    """The licence credits that the layers present ask for, in the order of ``owners``, each once."""
    return list(dict.fromkeys(text for name, text in owners.items() if layers.get(name)))


#: Bands of zooms, each with the sources that it draws and the least trips of a line in it: what a tile builder needs to know.
BANDS = (("far", 5, 7, 200), ("middle", 8, 10, 20), ("near", 11, 12, 1), ("detail", 13, 14, 0))


def banded(lines: DataFrame) -> DataFrame:
    """Lines once for each band that draws them, with the band's zooms; to be written with partitionBy("band")."""
    bands = F.array(*(F.struct(F.lit(n).alias("band"), F.lit(a).alias("min_zoom"), F.lit(b).alias("max_zoom"), F.lit(t).alias("least")) for n, a, b, t in BANDS))
    rows = lines.withColumn("_b", F.explode(bands)).where(F.coalesce("trips", F.lit(0)) >= F.col("_b.least"))
    return rows.select(*lines.columns, "_b.band", "_b.min_zoom", "_b.max_zoom")


def status(funnel: DataFrame) -> str:
    """The one row of a funnel as JSON."""
    return funnel.select(F.to_json(F.struct("*"))).first()[0]


def write_lines(features: DataFrame, path: str) -> None:
    """One text file of a feature a line. Order across files is lost, so the last step is one ordered task; overview data fits it."""
    features.coalesce(1).write.mode("overwrite").text(path)
