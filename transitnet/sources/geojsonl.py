"""Line-delimited GeoJSON features back into rows; a line that can't be read stops the job."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read(spark: SparkSession, path: str, properties: str) -> DataFrame:
    """(the properties, lon_e6, lat_e6) of LineStrings. ``properties`` is their schema as DDL."""
    own = "struct<" + ",".join(p.strip().replace(" ", ":", 1) for p in properties.split(",")) + ">"
    schema = f"type string, properties {own}, geometry struct<type:string,coordinates:array<array<double>>>"
    rows = spark.read.schema(schema).json(path, mode="FAILFAST")
    at = lambda k: F.transform("geometry.coordinates", lambda c: F.bround(c[k] * 1_000_000).cast("int"))
    return rows.select("properties.*", at(0).alias("lon_e6"), at(1).alias("lat_e6"))
