"""GTFS feeds: every column is read as text, then typed and filtered by projection."""

from __future__ import annotations

import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from transitnet.functions.times import DAYS, days_per_week

REQUIRED = ("agency.txt", "stops.txt", "routes.txt", "trips.txt", "stop_times.txt", "calendar.txt")


def check_zip(path: str) -> list[str]:
    """The members of a feed's zip; raises if one that is required is missing."""
    with zipfile.ZipFile(path) as z:
        names = z.namelist()
    if missing := [n for n in REQUIRED if n not in names]:
        raise ValueError(f"{path} lacks {', '.join(missing)}")
    return names


def unpack(path: str, out: str) -> str:
    """Unpack a checked feed, on the driver; returns the folder."""
    check_zip(path)
    with zipfile.ZipFile(path) as z:
        for name in z.namelist():
            if Path(name).name == name and name.endswith(".txt"):
                z.extract(name, out)
    return out


def table(spark: SparkSession, folder: str, name: str, columns: list[str]) -> DataFrame:
    """A file's columns as text; columns that the file lacks are null, so "07" stays "07"."""
    head = spark.read.text(f"{folder}/{name}.txt").limit(1).collect()
    if not head:
        return spark.createDataFrame([], StructType([StructField(c, StringType()) for c in columns]))
    names = [c.strip().strip('"') for c in head[0][0].lstrip("﻿").split(",")]
    schema = StructType([StructField(c, StringType()) for c in names])
    df = spark.read.csv(f"{folder}/{name}.txt", schema=schema, header=True, enforceSchema=True)
    return df.select(*((F.col(c) if c in names else F.lit(None).cast("string")).alias(c) for c in columns))


def load(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """stops, routes, calendar, trips, stop_times and shapes, typed.

    Stops without a latitude, or with 0, are left out; a blank route_type is null. stop_times keeps three columns.
    """
    stops = table(spark, folder, "stops", ["stop_id", "stop_name", "stop_lat", "stop_lon"])
    lat, lon = F.col("stop_lat").try_cast("double"), F.col("stop_lon").try_cast("double")
    routes = table(spark, folder, "routes", ["route_id", "agency_id", "route_short_name", "route_long_name", "route_type"])
    calendar = table(spark, folder, "calendar", ["service_id", *(d.lower() for d in DAYS), "start_date", "end_date"])
    trips = table(spark, folder, "trips", ["route_id", "service_id", "trip_id", "direction_id", "shape_id"])
    times = table(spark, folder, "stop_times", ["trip_id", "stop_id", "stop_sequence"])
    out = {
        "stops": stops.where(lat.isNotNull() & (lat != 0)).select("stop_id", F.col("stop_name").alias("name"), lat.alias("lat"), lon.alias("lon")),
        "routes": routes.select(
            "route_id", "agency_id", F.col("route_short_name").alias("short_name"), F.col("route_long_name").alias("long_name"),
            F.nullif(F.trim("route_type"), F.lit("")).alias("route_type"),
        ),
        "calendar": calendar.select("service_id", days_per_week(*(F.col(d.lower()) for d in DAYS)).alias("days")),
        "trips": trips.select(
            "trip_id", "route_id", "service_id", F.col("direction_id").try_cast("int").alias("direction"), F.nullif(F.trim("shape_id"), F.lit("")).alias("shape_id")
        ),
        "stop_times": times.select("trip_id", "stop_id", F.col("stop_sequence").try_cast("int").alias("seq")),
    }
    if Path(f"{folder}/shapes.txt").exists() or "://" in folder:
        points = table(spark, folder, "shapes", ["shape_id", "shape_pt_lat", "shape_pt_lon", "shape_pt_sequence"])
        out["shape_points"] = points.select(
            "shape_id", F.col("shape_pt_lat").try_cast("double").alias("lat"), F.col("shape_pt_lon").try_cast("double").alias("lon"), F.col("shape_pt_sequence").try_cast("int").alias("seq")
        )
    return out


def feed_version(spark: SparkSession, folder: str) -> str:
    """feed_info's version; one that is a GUID says nothing of its age, so its start date goes before its first 8 digits."""
    info = table(spark, folder, "feed_info", ["feed_version", "feed_start_date"])
    guid = F.col("feed_version").rlike(r"^[0-9a-fA-F]{8}-([0-9a-fA-F]{4}-){3}[0-9a-fA-F]{12}$")
    dated = F.concat_ws("-", F.nullif("feed_start_date", F.lit("")), F.substring("feed_version", 1, 8))
    row = info.select(F.when(guid, dated).otherwise(F.trim("feed_version")).alias("v")).first()
    if row is None or not row["v"]:
        raise ValueError(f"{folder}: feed_info has no version")
    return row["v"]
