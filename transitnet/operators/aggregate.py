"""Patterns inverted into the services of each edge and of each way, segments to draw, and the pipeline's census."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from transitnet.functions.geo import with_bbox
from transitnet.functions.text import display_name


def invert(links: DataFrame, patterns: DataFrame, key: str, item: str, by: list[str], pattern: str = "pattern_id", trips: str = "n_trips") -> DataFrame:
    """(item, by, n_patterns, n_trips) from links (pattern, item) and patterns (pattern, by, trips).

    A pattern that crosses an item twice counts once. n_trips is null where no pattern has any, not 0. Distinct links make the counts
    of patterns plain counts, which combine before the shuffle.
    """
    distinct = links.select(F.col(key).alias(pattern), item).distinct()
    rows = distinct.join(patterns.select(pattern, *by, trips), pattern)
    return rows.groupBy(item, *by).agg(F.count("*").alias("n_patterns"), F.sum(trips).cast("long").alias("n_trips"))


def edge_services(pattern_edges: DataFrame, patterns: DataFrame, live: Column) -> DataFrame:
    """The services of each road edge: live patterns on roads, by name and agency."""
    own = patterns.where(live).withColumn("short_name", display_name(F.col("short_name"), F.col("route_id")))
    return invert(pattern_edges, own, "pattern_id", "edge_id", ["short_name", "agency_id"])


def is_cut() -> Column:
    """Whether a trace's ways are cut to its pattern's stops; what isn't must not be inverted."""
    return F.coalesce(F.col("ways_cut"), F.lit(False))


def track_services(traces: DataFrame, patterns: DataFrame, live: Column) -> DataFrame:
    """The services of each way: cut traces of live patterns, by name, agency and mode."""
    links = traces.where(is_cut()).select("pattern_id", F.explode("way_ids").alias("way_id"))
    own = patterns.where(live).withColumn("short_name", display_name(F.col("short_name"), F.col("route_id")))
    return invert(links, own, "pattern_id", "way_id", ["short_name", "agency_id", "mode"])


def segments(patterns: DataFrame, shapes: DataFrame, traces: DataFrame, undrawn: Column) -> DataFrame:
    """Polylines of the live patterns that no edge draws: their shape, or else their uncut trace. Those with a cut trace are drawn as track.

    Two arms that exclude each other, so that no pattern is drawn twice.
    """
    own = patterns.where(undrawn).join(traces.where(is_cut()).select("pattern_id"), "pattern_id", "left_anti")
    shaped = own.join(shapes, "shape_id").select("pattern_id", "mode", "lon_e6", "lat_e6")
    traced = own.join(shapes.select("shape_id"), "shape_id", "left_anti").join(traces.where(~is_cut()), "pattern_id").select("pattern_id", "mode", "lon_e6", "lat_e6")
    return with_bbox(shaped.unionByName(traced))


def counted(condition: Column) -> Column:
    return F.count(F.when(condition, 1))


def funnel(patterns: DataFrame, status: DataFrame, live: Column, edges: DataFrame | None = None) -> DataFrame:
    """One row: patterns, live, matched, pending, trips covered, and maps of counts by status and mode. One pass over a left join."""
    rows = patterns.withColumn("_live", live).join(status.select("pattern_id", "status"), "pattern_id", "left")
    by = rows.where("_live").groupBy("status", "mode").agg(F.count("*").alias("n"))
    as_map = lambda c: F.map_from_entries(F.sort_array(F.collect_list(F.struct(c, "n"))))
    maps = by.where("status is not null").groupBy("status").agg(F.sum("n").alias("n")).agg(as_map("status").alias("by_status"))
    modes = by.groupBy(F.coalesce("mode", F.lit("unknown")).alias("mode")).agg(F.sum("n").alias("n")).agg(as_map("mode").alias("by_mode"))
    ok = F.col("status") == "ok"
    one = rows.agg(
        F.count("*").alias("patterns"), counted(F.col("_live")).alias("live"), counted(F.col("_live") & ok).alias("matched"), counted(F.col("_live") & F.col("status").isNull()).alias("pending"),
        F.sum(F.when(F.col("_live"), F.col("n_trips"))).alias("trips"), F.sum(F.when(F.col("_live") & ok, F.col("n_trips"))).alias("trips_matched"),
    )
    for small in (maps, modes, *([edges.agg(F.count("*").alias("edges"), (F.sum("length_m") / 1000).alias("km"))] if edges is not None else [])):
        one = one.join(F.broadcast(small))  # one row each
    return one


def trace_funnel(patterns: DataFrame, traces: DataFrame, live: Column, owed: Column) -> DataFrame:
    """One row beside the funnel, for patterns that no matcher is asked about: owed, owed without a status, and live ones by status.

    Kept out of the funnel: a pattern that can't be traced would hold its pending number up for ever.
    """
    rows = patterns.withColumns({"_live": live, "_owed": owed}).join(traces.select("pattern_id", "status"), "pattern_id", "left")
    by = rows.where("_live and status is not null").groupBy("status").agg(F.count("*").alias("n")).agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct("status", "n")))).alias("traced_by_status"))
    one = rows.agg(counted(F.col("_owed")).alias("patterns_owed"), counted(F.col("_owed") & F.col("status").isNull()).alias("patterns_pending"))
    return one.join(F.broadcast(by))  # one row
