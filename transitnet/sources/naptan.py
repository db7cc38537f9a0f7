"""The register of stops: rail stations by TIPLOC."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

COLUMNS = ("ATCOCode", "CommonName", "Latitude", "Longitude", "StopType", "Status")
#: Rail stations' stop type, the status kept, and the prefix that makes an ATCO code a TIPLOC; fixed values.
RAIL, ACTIVE, PREFIX = "RLY", "active", "9100"


def read(spark: SparkSession, path: str) -> DataFrame:
    """All rows as text, numbered in the file's order."""
    df = spark.read.csv(path, header=True, inferSchema=False)
    df = df.toDF(*(c.lstrip("﻿") for c in df.columns))
    if missing := [c for c in COLUMNS if c not in df.columns]:
        raise ValueError(f"the register lacks columns {missing}")
    return df.select(*COLUMNS, F.monotonically_increasing_id().alias("n"))


def stations(rows: DataFrame) -> DataFrame:
    """(tiploc, name, lat, lon, atco) of active rail stations with a coordinate; of duplicates the first. A station whose code
    lacks the prefix raises."""
    text = lambda c: F.trim(F.coalesce(F.col(c), F.lit("")))
    rail = rows.where((F.col("StopType") == RAIL) & (F.lower(text("Status")) == ACTIVE))
    atco = F.when(text("ATCOCode").startswith(PREFIX), text("ATCOCode")).otherwise(F.raise_error(F.concat(F.lit("not a station's ATCO code: "), text("ATCOCode"))).cast("string"))
    rail = rail.select("n", atco.alias("atco"), text("CommonName").alias("name"), text("Latitude").alias("lat"), text("Longitude").alias("lon"))
    rail = rail.where((F.col("lat") != "") & (F.col("lon") != "")).withColumn("tiploc", F.trim(F.substring("atco", len(PREFIX) + 1, 100)))
    first = F.row_number().over(Window.partitionBy("tiploc").orderBy("n"))
    return rail.withColumn("_k", first).where("_k = 1").select("tiploc", "name", F.col("lat").cast("double").alias("lat"), F.col("lon").cast("double").alias("lon"), "atco")


def resolve(used: DataFrame, stations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(those with a station, those without) of the TIPLOCs used."""
    return used.join(stations, "tiploc"), used.join(stations, "tiploc", "left_anti")
