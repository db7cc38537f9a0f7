"""OpenStreetMap relations and ways in the Overpass API's JSON."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_POINT = "struct<lat:double,lon:double>"
SCHEMA = (
    "elements array<struct<type:string,id:long,lat:double,lon:double,tags:map<string,string>,"
    f"geometry:array<{_POINT}>,members:array<struct<type:string,ref:long,role:string,geometry:array<{_POINT}>>>>>"
)


def elements(spark: SparkSession, path: str) -> DataFrame:
    """One row for each element of responses kept as files."""
    return spark.read.schema(SCHEMA).json(path, multiLine=True, mode="FAILFAST").select(F.explode("elements").alias("e")).select("e.*")


def relations(elements: DataFrame) -> DataFrame:
    """(relation_id, route, name, tags, ways, stops): member ways with two points or more, in order, and stops with their nodes' names.

    A stop is a node member whose role names a stop or platform; a node that the response lacks has no name.
    """
    own = elements.where("type = 'relation'").select("id", "tags", F.posexplode("members").alias("pos", "m"))
    nodes = elements.where("type = 'node'").select(F.col("id").alias("node"), "lat", "lon", F.try_element_at("tags", F.lit("name")).alias("node_name"))
    own = own.join(nodes, (F.col("m.type") == "node") & (F.col("m.ref") == F.col("node")), "left")
    way = F.when((F.col("m.type") == "way") & (F.size("m.geometry") >= 2) & ~F.coalesce(F.col("m.role"), F.lit("")).rlike("platform|stop"), F.struct("pos", F.col("m.ref").alias("way_id"), F.col("m.geometry").alias("points")))
    stop = F.when((F.col("m.type") == "node") & F.col("m.role").rlike("^(stop|platform)"), F.struct("pos", F.col("m.ref").alias("node_id"), F.col("node_name").alias("name"), "lat", "lon"))
    out = own.groupBy("id").agg(F.first("tags").alias("tags"), F.sort_array(F.collect_list(way)).alias("w"), F.sort_array(F.collect_list(stop)).alias("s"))
    tag = lambda k: F.try_element_at("tags", F.lit(k)).alias(k)
    return out.select(
        F.col("id").alias("relation_id"), tag("route"), tag("name"), "tags",
        F.transform("w", lambda x: F.struct(x["way_id"].alias("way_id"), x["points"].alias("points"))).alias("ways"),
        F.transform("s", lambda x: F.struct(x["node_id"].alias("node_id"), x["name"].alias("name"), x["lat"].alias("lat"), x["lon"].alias("lon"))).alias("stops"),
    )


def ways(elements: DataFrame) -> DataFrame:
    """(way_id, points, tags) of bare ways with two points or more."""
    return elements.where("type = 'way'").where(F.size("geometry") >= 2).select(F.col("id").alias("way_id"), F.col("geometry").alias("points"), "tags")
