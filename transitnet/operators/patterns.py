"""Trips to patterns: distinct stop sequences with their counts, spans and shapes, merged feed by feed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from transitnet.functions.geo import haversine_m, in_isles
from transitnet.functions.ids import check_unique, pattern_id
from transitnet.functions.text import display_name
from transitnet.operators.maintenance import refuse_collapse
from transitnet.schemas import MODES, ROAD_MODES, route_types
from transitnet.store import Store


def sequences(stop_times: DataFrame, key: str = "trip_id", stop: str = "stop_id", order: tuple[str, ...] = ("seq",)) -> DataFrame:
    """(key, stop_seq): each trip's stops as an ordered array. One shuffle by trip; sorted inside the group.

    ``order`` names columns that together order a trip's rows without ties; the stop itself breaks those that are left.
    """
    rows = F.sort_array(F.collect_list(F.struct(*order, F.col(stop).alias("_stop"))))
    return stop_times.groupBy(key).agg(rows.alias("_rows")).select(key, F.transform("_rows", lambda r: r["_stop"]).alias("stop_seq"))


def kept_type(route_type: Column, kept: list[int]) -> Column:
    """Whether a route type is among those kept: false, never null, for what isn't a number, so that its negation is usable."""
    return F.coalesce(route_type.try_cast("int").isin(kept), F.lit(False))


def mode_of(route_type: Column) -> Column:
    """The mode's name; null for a type that no mode has."""
    out = F.lit(None).cast("string")
    for name, types in MODES.items():
        out = F.when(route_type.try_cast("int").isin(sorted(types)), name).otherwise(out)
    return out


def trip_rows(trips: DataFrame, calendar: DataFrame, routes: DataFrame) -> DataFrame:
    """Trips with their service's days a week, five if the calendar lacks it, and their route's name, agency and mode."""
    return (
        trips.join(calendar, "service_id", "left")
        .join(routes, "route_id", "left")
        .withColumns({"days": F.coalesce("days", F.lit(5)), "mode": mode_of(F.col("route_type"))})
    )


def select_modes(routes: DataFrame, modes: list[str]) -> DataFrame:
    """Routes of the modes; raises if none is left."""
    kept = routes.where(kept_type(F.col("route_type"), route_types(modes)))
    if kept.isEmpty():
        raise ValueError(f"no route of {', '.join(sorted(modes))} in this feed")
    return kept


def mode_census(routes: DataFrame, modes: list[str]) -> DataFrame:
    """(route_type, kept, routes, agencies): what a selection keeps and drops."""
    return routes.groupBy("route_type", kept_type(F.col("route_type"), route_types(modes)).alias("kept")).agg(
        F.count("*").alias("routes"), F.count_distinct("agency_id").alias("agencies")
    )


def most_common(value: str, by: list[str], df: DataFrame) -> DataFrame:
    """(by, value): each group's most frequent value that isn't null, of equals the smallest. Counted before it is ranked."""
    counts = df.where(F.col(value).isNotNull()).groupBy(*by, value).agg(F.count("*").alias("_n"))
    return counts.groupBy(*by).agg(F.min(F.struct((-F.col("_n")).alias("n"), F.col(value).alias("v")))["v"].alias(value))


def collapse(rows: DataFrame) -> DataFrame:
    """Patterns of trips (route_id, agency_id, short_name, direction, stop_seq, mode, days, shape_id).

    pattern_id, the identity's columns, n_stops, n_trips (trips a week) and the most frequent shape.
    """
    identity = ["route_id", "agency_id", "short_name", "direction", "stop_seq", "mode"]
    raw = rows.where(F.size("stop_seq") >= 2).withColumn("pattern_id", pattern_id(F.col("route_id"), F.col("direction"), F.col("stop_seq")))
    shapes = most_common("shape_id", ["pattern_id"], raw)
    out = raw.groupBy("pattern_id").agg(*(F.first(c).alias(c) for c in identity), F.count("*").alias("trips"), F.sum("days").cast("long").alias("n_trips"))
    return out.join(shapes, "pattern_id", "left").withColumn("n_stops", F.size("stop_seq"))


def pattern_stops(patterns: DataFrame) -> DataFrame:
    return patterns.select("pattern_id", F.posexplode("stop_seq").alias("seq", "stop_id"))


def gaps(pattern_stops: DataFrame, stops: DataFrame) -> DataFrame:
    """(pattern_id, span_m, max_gap_m): the sum and the largest of the distances between stops that follow each other."""
    w = Window.partitionBy("pattern_id").orderBy("seq")
    at = pattern_stops.join(stops.select("stop_id", "lat", "lon"), "stop_id")
    at = at.select("pattern_id", "lat", "lon", F.lead("lat").over(w).alias("lat2"), F.lead("lon").over(w).alias("lon2")).where("lat2 is not null")
    d = haversine_m(F.col("lat"), F.col("lon"), F.col("lat2"), F.col("lon2"))
    return at.groupBy("pattern_id").agg(F.sum(d).alias("span_m"), F.max(d).alias("max_gap_m"))


def inside_isles(patterns: DataFrame, stops: DataFrame) -> DataFrame:
    """Patterns all of whose stops lie in the British Isles; one stop outside drops the whole pattern."""
    outside = stops.where(~in_isles(F.col("lat"), F.col("lon"))).select("stop_id")
    hit = patterns.select("pattern_id", F.explode("stop_seq").alias("stop_id")).join(outside, "stop_id").select("pattern_id").distinct()
    return patterns.join(hit, "pattern_id", "left_anti")


def shapes_of(shape_points: DataFrame, patterns: DataFrame) -> DataFrame:
    """(shape_id, lon_e6, lat_e6) of the shapes that patterns refer to: one row a shape, points in their order."""
    used = shape_points.join(patterns.select("shape_id").distinct(), "shape_id", "left_semi")
    e6 = lambda c: F.bround(F.col(c) * 1_000_000).cast("int")
    rows = used.groupBy("shape_id").agg(F.sort_array(F.collect_list(F.struct("seq", e6("lon").alias("x"), e6("lat").alias("y")))).alias("p"))
    return rows.select("shape_id", F.transform("p", lambda p: p["x"]).alias("lon_e6"), F.transform("p", lambda p: p["y"]).alias("lat_e6"))


def from_feed(feed: dict[str, DataFrame], modes: list[str]) -> dict[str, DataFrame]:
    """stops, routes, patterns, pattern_stops and shapes of a loaded feed: modes are dropped before anything is collapsed."""
    routes = select_modes(feed["routes"], modes)
    trips = trip_rows(feed["trips"].join(routes.select("route_id"), "route_id", "left_semi"), feed["calendar"], routes)
    times = feed["stop_times"].join(trips.select("trip_id"), "trip_id", "left_semi").join(feed["stops"].select("stop_id"), "stop_id", "left_semi")
    rows = trips.join(sequences(times), "trip_id").withColumn("short_name", display_name(F.col("short_name"), F.col("route_id")))
    patterns = inside_isles(check_unique(collapse(rows), "pattern_id", ["route_id", "direction", "stop_seq"]), feed["stops"])
    out = {"stops": feed["stops"], "routes": routes, "patterns": patterns, "pattern_stops": pattern_stops(patterns)}
    if "shape_points" in feed:
        out["shapes"] = shapes_of(feed["shape_points"], patterns)
        known = out["shapes"].select("shape_id", F.lit(True).alias("_known"))
        out["patterns"] = patterns.join(known, "shape_id", "left").withColumn("shape_id", F.when(F.col("_known"), F.col("shape_id"))).drop("_known")
    spans = gaps(out["pattern_stops"], feed["stops"])
    out["patterns"] = out["patterns"].join(spans.select("pattern_id", "span_m"), "pattern_id", "left")
    return out


def merge(stored: DataFrame, feed: DataFrame, version: str, key: str = "pattern_id", seen: tuple[str, str] = ("first_seen", "last_seen")) -> DataFrame:
    """Stored rows and a feed's by key: new ones are added, known ones take the feed's values, departed ones stay as they are.

    Every row of the feed gets last_seen = version; first_seen is kept, or version for new ones. One full outer join.
    """
    old, new = stored.alias("o"), feed.alias("f")
    there = F.col(f"f.{key}").isNotNull()
    columns = []
    for c in stored.columns:
        own = F.col(f"o.{c}")
        if c == seen[0]:
            columns.append(F.coalesce(own, F.lit(version)).alias(c))
        elif c == seen[1]:
            columns.append(F.when(there, F.lit(version)).otherwise(own).alias(c))
        elif c == key:
            columns.append(F.coalesce(own, F.col(f"f.{c}")).alias(c))
        else:
            columns.append((F.when(there, F.col(f"f.{c}")).otherwise(own) if c in feed.columns else own).alias(c))
    return old.join(new, F.col(f"o.{key}") == F.col(f"f.{key}"), "full_outer").select(*columns)


def retire_modes(patterns: DataFrame, modes: list[str]) -> DataFrame:
    """Stored patterns of modes that are no longer selected are no longer live; those without a mode are spared."""
    gone = F.col("mode").isNotNull() & ~F.col("mode").isin(list(modes))
    return patterns.withColumn("last_seen", F.when(gone, F.lit(None)).otherwise(F.col("last_seen")))


def refresh_services(stored: DataFrame, found: DataFrame, version: str, own: Column, key: str = "pattern_id", floor: float = 0.5) -> DataFrame:
    """Stored patterns with those that this source drew last time (``own``) retired first, then those found put in by key.

    A source that finds none has stopped drawing: its patterns are retired all the same. One that finds less than ``floor`` of those that
    were live, but some, has failed: that raises, and nothing changes.
    """
    live = own & (F.col("last_seen") == F.lit(version))
    before, now = stored.where(live).count(), found.count()
    if now:
        refuse_collapse(before, now, floor)
    return merge(stored.withColumn("last_seen", F.when(F.coalesce(live, F.lit(False)), F.lit(None)).otherwise(F.col("last_seen"))), found, version, key)


def remembered_modes(store: Store, given: list[str] | None = None, default: tuple[str, ...] = ROAD_MODES) -> list[str]:
    """The modes to build with: those given, which are remembered, else those of the last build, else the default.

    Without this a bare refresh would narrow a store of many modes. A stored name that is no longer known raises.
    """
    modes = sorted(given) if given is not None else sorted(m.strip() for m in (store.meta("modes") or "").split(",") if m.strip()) or sorted(default)
    route_types(modes)
    if given is not None:
        store.set_meta("modes", ",".join(modes))
    return modes


def churn(before: DataFrame, now: DataFrame, matched: DataFrame, key: str) -> DataFrame:
    """One row: keys that are new, that were there and are unmatched still, and that have departed."""
    old = before.select(key, F.lit(1).alias("o")).distinct()
    new = now.select(key, F.lit(1).alias("n")).distinct()
    done = matched.select(key, F.lit(1).alias("m")).distinct()
    both = old.join(new, key, "full_outer").join(done, key, "left")
    count = lambda c: F.count(F.when(c, 1))
    return both.agg(
        count(F.col("o").isNull()).alias("new"), count(F.col("o").isNotNull() & F.col("n").isNotNull() & F.col("m").isNull()).alias("returning_unmatched"), count(F.col("n").isNull()).alias("departed")
    )


def gained_shapes(before: DataFrame, now: DataFrame, statuses: DataFrame) -> DataFrame:
    """Patterns matched from stops alone to which a feed has given a shape since."""
    return before.where("shape_id is null").select("pattern_id").join(now.where("shape_id is not null").select("pattern_id"), "pattern_id").join(statuses.where("source = 'stops'"), "pattern_id", "left_semi")
