"""TransXChange timetables: stops, routes and trips from XML, and the GTFS bundle built of them."""

from __future__ import annotations

import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from transitnet.functions.ids import shape_id
from transitnet.functions.times import DAYS, departure_seconds, hhmmss, iso_seconds

STOP = "AtcoCode string, Descriptor struct<CommonName:string>, Place struct<Location:struct<Latitude:double,Longitude:double>>"
LINK = "From struct<StopPointRef:string>, To struct<StopPointRef:string>, RunTime string"
SECTION = f"_id string, JourneyPatternTimingLink array<struct<{LINK.replace(' struct', ':struct').replace(' string', ':string')}>>"
PROFILE = "RegularDayType:struct<DaysOfWeek:map<string,string>>"
SERVICE = (
    "ServiceCode string, RegisteredOperatorRef string, Lines struct<Line:array<struct<_id:string,LineName:string>>>,"
    f"OperatingProfile struct<{PROFILE}>,"
    "StandardService struct<JourneyPattern:array<struct<_id:string,Direction:string,JourneyPatternSectionRefs:array<string>>>>"
)
JOURNEY = f"VehicleJourneyCode string, ServiceRef string, JourneyPatternRef string, DepartureTime string, DepartureDayShift string, OperatingProfile struct<{PROFILE}>"


def _rows(spark: SparkSession, path: str, tag: str, schema: str) -> DataFrame:
    return spark.read.format("xml").option("rowTag", tag).schema(schema).load(path)


def _week(profile: str):
    """Seven flags of a profile; null if it has none."""
    from transitnet.functions.times import week

    return week(F.map_keys(f"{profile}.RegularDayType.DaysOfWeek"), F.col(f"{profile}.RegularDayType").isNotNull())


def stops(spark: SparkSession, path: str) -> DataFrame:
    """(stop_id, name, lat, lon); a stop at 0, 0 has no place."""
    df = _rows(spark, path, "StopPoint", STOP)
    lat, lon = F.col("Place.Location.Latitude"), F.col("Place.Location.Longitude")
    return df.select(F.col("AtcoCode").alias("stop_id"), F.col("Descriptor.CommonName").alias("name"), lat.alias("lat"), lon.alias("lon")).where((lat != 0) | (lon != 0))


def routes(spark: SparkSession, path: str) -> DataFrame:
    """(route_id, agency_id, short_name)."""
    return _rows(spark, path, "Service", SERVICE).select(
        F.col("ServiceCode").alias("route_id"), F.col("RegisteredOperatorRef").alias("agency_id"), F.get(F.col("Lines.Line"), 0)["LineName"].alias("short_name")
    )


def trips(spark: SparkSession, path: str) -> DataFrame:
    """(trip_id, route_id, direction, days, stops, times): each vehicle journey with the times at its stops, in seconds.

    A journey's own operating profile overrides its service's.
    """
    links = _rows(spark, path, "JourneyPatternSection", SECTION).select(F.col("_id").alias("section"), F.posexplode("JourneyPatternTimingLink").alias("at", "link"))
    service = _rows(spark, path, "Service", SERVICE)
    patterns = service.select("ServiceCode", F.explode("StandardService.JourneyPattern").alias("p"), _week("OperatingProfile").alias("service_days"))
    patterns = patterns.select("ServiceCode", F.col("p._id").alias("pattern"), F.col("p.Direction").alias("direction"), "service_days", F.posexplode("p.JourneyPatternSectionRefs").alias("k", "section"))
    hops = patterns.join(links, "section").groupBy("ServiceCode", "pattern", "direction", "service_days").agg(F.sort_array(F.collect_list(F.struct("k", "at", "link"))).alias("hops"))
    hops = hops.select(
        "ServiceCode", "pattern", "direction", "service_days",
        F.concat(F.array(F.get("hops", 0)["link"]["From"]["StopPointRef"]), F.transform("hops", lambda h: h["link"]["To"]["StopPointRef"])).alias("stops"),
        F.transform("hops", lambda h: iso_seconds(h["link"]["RunTime"])).alias("runs"),
    )
    own = F.when(F.col("j.OperatingProfile").isNotNull(), _week("j.OperatingProfile"))
    journeys = _rows(spark, path, "VehicleJourney", JOURNEY).select(F.struct("*").alias("j"))
    journeys = journeys.select(
        F.col("j.VehicleJourneyCode").alias("trip_id"), F.col("j.ServiceRef").alias("ServiceCode"), F.col("j.JourneyPatternRef").alias("pattern"),
        departure_seconds(F.col("j.DepartureTime"), F.col("j.DepartureDayShift")).alias("start"), own.alias("own_days"),
    )
    rows = journeys.join(hops, ["ServiceCode", "pattern"])
    times = F.aggregate("runs", F.array(F.col("start")), lambda acc, r: F.concat(acc, F.array(F.element_at(acc, -1) + r)))
    return rows.select(
        "trip_id", F.col("ServiceCode").alias("route_id"), "direction", F.coalesce("own_days", "service_days").alias("days"), "stops", times.alias("times")
    )


def stitched(sequences: DataFrame, hops: DataFrame) -> DataFrame:
    """(shape_id, stops, points) of distinct stop sequences: the hops' points end to end, all hops or none.

    hops: (from_id, to_id, points).
    """
    distinct = sequences.select("stops").distinct()
    pairs = distinct.select("stops", F.posexplode(F.zip_with(F.slice("stops", 1, F.size("stops") - 1), F.slice("stops", 2, F.size("stops") - 1), lambda a, b: F.struct(a.alias("from_id"), b.alias("to_id")))).alias("k", "h"))
    pairs = pairs.select("stops", "k", "h.from_id", "h.to_id").join(hops, ["from_id", "to_id"], "left")
    whole = pairs.groupBy("stops").agg(F.bool_and(F.col("points").isNotNull()).alias("all"), F.sort_array(F.collect_list(F.struct("k", "points"))).alias("p"))
    joined = F.flatten(F.transform("p", lambda x, i: F.when(i == 0, x["points"]).otherwise(F.slice(x["points"], 2, F.greatest(F.size(x["points"]) - 1, F.lit(0))))))
    return whole.where("all").select(shape_id(F.col("stops")).alias("shape_id"), "stops", joined.alias("points"))


def hop_geometry(features: DataFrame) -> DataFrame:
    """(from_id, to_id, points): of several variants of a hop the shortest, then the smallest by its points."""
    first = Window.partitionBy("from_id", "to_id").orderBy(F.size("points"), "points")
    return features.withColumn("_k", F.row_number().over(first)).where("_k = 1").select("from_id", "to_id", "points")


def crosswalk(points: DataFrame) -> DataFrame:
    """(key, atco): of several codes for a stopping point the one written last."""
    return points.groupBy("key").agg(F.max_by("atco", "ordinal").alias("atco"))


def members(path: str) -> list[str]:
    """The XML members of a zip; an empty bundle raises."""
    with zipfile.ZipFile(path) as z:
        found = sorted(n for n in z.namelist() if n.lower().endswith(".xml"))
    if not found:
        raise ValueError(f"{path} holds no timetable")
    return found


def gtfs_tables(stops: DataFrame, routes: DataFrame, trips: DataFrame, shapes: DataFrame) -> dict[str, DataFrame]:
    """The seven files of a bundle, each in a fixed order of columns and rows."""
    with_id = trips.join(shapes.select(F.col("stops").alias("_s"), "shape_id"), F.col("stops") == F.col("_s"), "left").withColumn("service_id", F.array_join(F.transform("days", lambda d: d.cast("string")), ""))
    times = with_id.select("trip_id", F.posexplode(F.arrays_zip("stops", "times")).alias("k", "c"))
    clock = hhmmss(F.col("c.times"))
    return {
        "agency": routes.select("agency_id", F.col("agency_id").alias("agency_name")).distinct().orderBy("agency_id"),
        "stops": stops.select("stop_id", F.col("name").alias("stop_name"), F.col("lat").alias("stop_lat"), F.col("lon").alias("stop_lon")).orderBy("stop_id"),
        "routes": routes.select("route_id", "agency_id", F.col("short_name").alias("route_short_name"), F.lit("3").alias("route_type")).orderBy("route_id"),
        "calendar": with_id.select("service_id", *(F.get("days", k).alias(d.lower()) for k, d in enumerate(DAYS))).distinct().orderBy("service_id"),
        "trips": with_id.select("route_id", "service_id", "trip_id", F.when(F.col("direction") == "inbound", 1).otherwise(0).alias("direction_id"), "shape_id").orderBy("trip_id"),
        "stop_times": times.select("trip_id", clock.alias("arrival_time"), clock.alias("departure_time"), F.col("c.stops").alias("stop_id"), (F.col("k") + 1).alias("stop_sequence")).orderBy("trip_id", "stop_sequence"),
        "shapes": shapes.select("shape_id", F.posexplode("points").alias("k", "p")).select("shape_id", F.col("p.lat").alias("shape_pt_lat"), F.col("p.lon").alias("shape_pt_lon"), (F.col("k") + 1).alias("shape_pt_sequence")).orderBy("shape_id", "shape_pt_sequence"),
    }


def write_bundle(tables: dict[str, DataFrame], out: str) -> str:
    """A zip whose bytes depend on the tables alone. A bundle is one small file; rows stream through the driver in order."""
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        for name in sorted(tables):
            info = zipfile.ZipInfo(f"{name}.txt", (2000, 1, 1, 0, 0, 0))
            info.compress_type = zipfile.ZIP_DEFLATED
            with z.open(info, "w") as f:
                f.write((",".join(tables[name].columns) + "\n").encode())
                for row in tables[name].toLocalIterator():
                    quoted = ("" if v is None else f'"{v}"' if "," in str(v) else str(v) for v in row)
                    f.write((",".join(quoted) + "\n").encode())
    return str(Path(out))
