"""Patterns on mapped lines: relations walked into paths, stop sequences fitted to them, polylines snapped to ways, trips put on track."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from transitnet.functions.arrays import occurrences_of_any
from transitnet.functions.geo import M_PER_DEG, haversine_m
from transitnet.functions.text import claimed, spellings

#: Metres: a stop from its namesake, a stop from the line, and how far a later stop may lie back along it.
STOP_M, TRACK_M, SLACK_M = 400.0, 400.0, 250.0
#: Metres: a vertex from its way, and how much nearer another way must be to be taken instead; the share that must be covered.
SNAP_M, STICK_M, COVER = 25.0, 3.0, 0.98
#: A leg may be so many times longer by track than straight.
DETOUR = 3.0


def walk(ways: list[tuple[int, list[tuple[float, float]]]]) -> tuple[list[tuple[float, float]], list[int], int]:
    """(points, the way of each segment, breaks) of ways in their order, each turned so that it continues the one before.

    If that breaks, it is tried with the first way turned; the fewer breaks win.
    """
    def once(flip: bool):
        path, owner, breaks = [], [], 0
        for k, (way, points) in enumerate(ways):
            p = list(points)
            if not path:
                p = p[::-1] if flip else p
            elif p[0] != path[-1] and p[-1] == path[-1]:
                p = p[::-1]
            elif p[0] != path[-1]:
                breaks += 1
                nearer = math.dist(p[-1], path[-1]) < math.dist(p[0], path[-1])
                p = p[::-1] if nearer else p
            fresh = p[1:] if path and p[0] == path[-1] else p
            owner += [way] * (len(fresh) - (0 if path else 1))
            path += fresh
            del k
        return path, owner, breaks

    first = once(False)
    if not first[2] or not ways:
        return first
    second = once(True)
    return second if second[2] < first[2] else first


PATH = "relation_id long, breaks int, span_m double, points array<struct<lat:double,lon:double>>, owner array<long>"


def paths(relations: DataFrame) -> DataFrame:
    """(relation_id, breaks, span_m, points, owner) of relations with ways; row by row, in Arrow batches."""
    def run(batches):
        for pdf in batches:
            out = []
            for rel, ways in zip(pdf["relation_id"], pdf["ways"], strict=True):
                path, owner, breaks = walk([(int(w["way_id"]), [(p["lat"], p["lon"]) for p in w["points"]]) for w in ways])
                span = sum(_plane(a, b) for a, b in zip(path, path[1:], strict=False))
                out.append((rel, breaks, span, [{"lat": a, "lon": b} for a, b in path], owner))
            yield pd.DataFrame(out, columns=["relation_id", "breaks", "span_m", "points", "owner"])

    return relations.select("relation_id", "ways").mapInPandas(run, PATH)


def sift(relations: DataFrame, paths: DataFrame, routes: list[str], mine: list[str], others: list[str]) -> DataFrame:
    """Relations with a column reason: kept, or why they are refused; the first reason that holds."""
    rows = relations.join(paths.select("relation_id", "breaks", "span_m"), "relation_id", "left")
    tag = F.try_element_at("tags", F.lit("operator"))
    reason = (
        F.when(~F.coalesce(F.col("route").isin(routes), F.lit(False)), "other route")
        .when(~claimed(tag, mine, others), "another region's")
        .when(F.size("stops") < 2, "too few stops")
        .when(F.coalesce(F.col("breaks"), F.lit(1)) > 0, "broken")
        .otherwise("kept")
    )
    return rows.withColumn("reason", reason)


def _plane(a, b) -> float:
    return M_PER_DEG * math.hypot(b[0] - a[0], (b[1] - a[1]) * math.cos(math.radians(a[0])))


def project(point: tuple[float, float], path: list[tuple[float, float]]) -> tuple[float, float]:
    """(metres along, metres off) of the nearest place of a path."""
    scale, best, along = math.cos(math.radians(path[0][0])), (math.inf, 0.0), 0.0
    for a, b in zip(path, path[1:], strict=False):
        ax, ay, bx, by = a[1] * scale, a[0], b[1] * scale, b[0]
        px, py, dx, dy = point[1] * scale, point[0], bx - ax, by - ay
        size = dx * dx + dy * dy
        t = min(1.0, max(0.0, ((px - ax) * dx + (py - ay) * dy) / size)) if size else 0.0
        off = M_PER_DEG * math.hypot(px - ax - t * dx, py - ay - t * dy)
        step = M_PER_DEG * math.sqrt(size)
        if off < best[0]:
            best = off, along + t * step
        along += step
    return best[1], best[0]


def cut(stops: list[tuple[float, float]], path: list[tuple[float, float]], owner: list[int]) -> tuple[str, float, list, list[int]]:
    """(reason, worst metres, points, ways) of the part of a path that a stop sequence runs over, in either direction.

    A part of less than two points is no line: its stops lie in one place.
    """
    placed = [project(s, path) for s in stops]
    worst = max(off for _, off in placed)
    if worst > TRACK_M:
        return "off_track", worst, [], []
    at = [a for a, _ in placed]
    forward = all(b >= a - SLACK_M for a, b in zip(at, at[1:], strict=False))
    backward = all(b <= a + SLACK_M for a, b in zip(at, at[1:], strict=False))
    if not (forward or backward):
        return "not_monotonic", worst, [], []
    turned = not forward or (backward and at[-1] < at[0])
    low, high = min(at[0], at[-1]), max(at[0], at[-1])
    along, points, ways = 0.0, [], []
    for (a, b), way in zip(zip(path, path[1:], strict=False), owner, strict=True):
        step = _plane(a, b)
        if along + step > low and along < high:
            t0, t1 = (max(0.0, (low - along) / step), min(1.0, (high - along) / step)) if step else (0.0, 1.0)
            mix = lambda t, a=a, b=b: (a[0] + (b[0] - a[0]) * t, a[1] + (b[1] - a[1]) * t)
            points += ([mix(t0)] if not points else []) + [mix(t1)]
            if not ways or ways[-1] != way:
                ways.append(way)
        along += step
    if len(points) < 2:
        return "off_track", worst, [], []
    return "ok", worst, points[::-1] if turned else points, ways[::-1] if turned else ways


def fits(patterns: DataFrame, relations: DataFrame) -> DataFrame:
    """(pattern_id, relation_id, start, turned): where a pattern's stops follow each other along a relation's, by any spelling.

    patterns and relations: (id, stops array<struct<name, lat, lon>>). Relations that share a spelling with the pattern's first stop are candidates:
    an equi-join. Then all stops are held against each other, in both directions.
    """
    own = patterns.select("pattern_id", F.transform("stops", lambda s: spellings(s["name"])).alias("p"))
    rel = relations.select("relation_id", F.transform("stops", lambda s: spellings(s["name"])).alias("r"))
    by = rel.select("relation_id", "r", F.explode(F.array_distinct(F.flatten("r"))).alias("name"))
    rows = own.select("pattern_id", "p", F.explode(F.get("p", 0)).alias("name")).join(by, "name").select("pattern_id", "p", "relation_id", "r").dropDuplicates(["pattern_id", "relation_id"])
    ways = F.concat(
        F.transform(occurrences_of_any(F.col("r"), F.col("p")), lambda s: F.struct(s.alias("start"), F.lit(False).alias("turned"))),
        F.transform(occurrences_of_any(F.reverse("r"), F.col("p")), lambda s: F.struct(s.alias("start"), F.lit(True).alias("turned"))),
    )
    return rows.select("pattern_id", "relation_id", F.explode(ways).alias("w")).select("pattern_id", "relation_id", "w.start", "w.turned")


def near_namesake(fits: DataFrame, patterns: DataFrame, relations: DataFrame) -> DataFrame:
    """fits with worst_stop_m, the farthest that a stop lies from its namesake, and only those within STOP_M.

    side holds the relation's own stop nodes, in the pattern's order: they lie on its line, where a timetable's stop may lie on a parallel one.
    """
    rows = fits.join(patterns.select("pattern_id", F.col("stops").alias("ps")), "pattern_id").join(relations.select("relation_id", F.col("stops").alias("rs")), "relation_id")
    side = F.slice(F.when(F.col("turned"), F.reverse("rs")).otherwise(F.col("rs")), F.col("start") + 1, F.size("ps"))
    far = F.array_max(F.zip_with(side, "ps", lambda a, b: haversine_m(a["lat"], a["lon"], b["lat"], b["lon"])))
    rows = rows.withColumns({"worst_stop_m": far, "side": F.transform(side, lambda s: F.struct(s["lat"].alias("lat"), s["lon"].alias("lon")))})
    return rows.where(F.col("worst_stop_m") <= STOP_M).drop("ps", "rs")


#: Why a pattern found no trace, the most telling last; fixed values.
REASONS = ("no_relation", "no_stop_match", "stop_too_far", "off_track", "not_monotonic", "ok")


def resolve(attempts: DataFrame) -> DataFrame:
    """One attempt a pattern: the best fit (nearest stops, then shortest, then the least relation), else the most telling failure.

    attempts: (pattern_id, relation_id, reason, worst_stop_m, length_m, ...).
    """
    rank = F.array_position(F.array(*map(F.lit, REASONS)), F.col("reason"))
    best = F.row_number().over(Window.partitionBy("pattern_id").orderBy(F.desc(rank), F.col("worst_stop_m").asc_nulls_last(), F.col("length_m").asc_nulls_last(), "relation_id"))
    return attempts.withColumn("_k", best).where("_k = 1").drop("_k")


def traced(fitted: DataFrame, paths: DataFrame) -> DataFrame:
    """Attempts of near fits: each cut out of its relation's path at its own stop nodes. The polyline arithmetic runs in Arrow batches.

    Patterns that call at the same nodes of a relation share one cut, so a path meets each distinct run of nodes, not each pattern.
    """
    runs = fitted.select("relation_id", "side").distinct().join(paths.select("relation_id", "points", "owner"), "relation_id")

    def run(batches):
        for pdf in batches:
            out = []
            for r in pdf.itertuples():
                side = [(s["lat"], s["lon"]) for s in r.side]
                reason, worst, points, ways = cut(side, [(p["lat"], p["lon"]) for p in r.points], list(r.owner))
                length = sum(_plane(a, b) for a, b in zip(points, points[1:], strict=False))
                out.append((r.relation_id, list(r.side), reason, worst, length, ways, [{"lat": a, "lon": b} for a, b in points]))
            yield pd.DataFrame(out, columns=["relation_id", "side", "reason", "worst_track_m", "length_m", "way_ids", "points"])

    point = "array<struct<lat:double,lon:double>>"
    cuts = runs.mapInPandas(run, f"relation_id long, side {point}, reason string, worst_track_m double, length_m double, way_ids array<long>, points {point}")
    return fitted.select("pattern_id", "relation_id", "worst_stop_m", "side").join(cuts, ["relation_id", "side"]).select("pattern_id", "relation_id", "reason", "worst_stop_m", "worst_track_m", "length_m", "way_ids", "points")


def nearest_within(points: DataFrame, targets: DataFrame, within: int, keys: tuple[str, str] = ("p", "t")) -> DataFrame:
    """(p, t, d2): each point's nearest target within a distance, of equals the least. points (p, x, y) and targets (t, x, y) in whole units.

    A grid of cells of that size: a target stands in the 9 cells around it, so an equi-join by cell finds all that can be near.
    """
    p, t = keys
    at = lambda c: F.floor(F.col(c) / within)
    around = F.explode(F.array(*(F.struct((at("x") + i).alias("cx"), (at("y") + j).alias("cy")) for i in (-1, 0, 1) for j in (-1, 0, 1))))
    spread = targets.select(t, F.col("x").alias("tx"), F.col("y").alias("ty"), around.alias("c")).select(t, "tx", "ty", "c.cx", "c.cy")
    rows = points.select(p, "x", "y", at("x").alias("cx"), at("y").alias("cy")).join(spread, ["cx", "cy"])
    d2 = (F.col("x") - F.col("tx")) * (F.col("x") - F.col("tx")) + (F.col("y") - F.col("ty")) * (F.col("y") - F.col("ty"))
    near = rows.select(p, t, d2.alias("d2")).where(F.col("d2") <= within * within)
    return near.groupBy(p).agg(F.min(F.struct("d2", t)).alias("b")).select(p, F.col(f"b.{t}").alias(t), F.col("b.d2").alias("d2"))


def snapped(vertices: DataFrame, segments: DataFrame) -> DataFrame:
    """(pattern_id, status, way_ids, covered, worst_m): polylines' vertices on the ways nearest to them.

    vertices (pattern_id, seq, x, y) and segments (way_id, ax, ay, bx, by) in metres of one plane. Candidates within SNAP_M come from an equi-join by
    cell, a segment standing in all cells of its box and one around; then each polyline is scanned in order, staying on its way
    unless another is nearer by STICK_M. A polyline is refused where less than COVER of its length is near a way.

    Ways of the same segments are equally far from every vertex, so only the least of them is ever the nearest: it alone is joined, and
    the work follows the polylines and the different ways near them, not the copies of a way. Segments without a way are left out.
    """
    size = 100.0
    drawn = segments.where("way_id is not null").groupBy("way_id").agg(F.sort_array(F.collect_set(F.struct("ax", "ay", "bx", "by"))).alias("drawn"))
    ways = drawn.groupBy("drawn").agg(F.min("way_id").alias("way_id")).select("way_id", F.inline("drawn"))
    lo = lambda a, b: F.floor((F.least(F.col(a), F.col(b)) - SNAP_M) / size).cast("long")
    hi = lambda a, b: F.floor((F.greatest(F.col(a), F.col(b)) + SNAP_M) / size).cast("long")
    cells = ways.withColumn("wx", F.explode(F.sequence(lo("ax", "bx"), hi("ax", "bx")))).withColumn("wy", F.explode(F.sequence(lo("ay", "by"), hi("ay", "by"))))
    dx, dy = F.col("bx") - F.col("ax"), F.col("by") - F.col("ay")
    t = F.coalesce(F.try_divide((F.col("x") - F.col("ax")) * dx + (F.col("y") - F.col("ay")) * dy, dx * dx + dy * dy), F.lit(0.0))
    t = F.least(F.greatest(t, F.lit(0.0)), F.lit(1.0))
    d = F.sqrt(F.pow(F.col("x") - F.col("ax") - t * dx, 2) + F.pow(F.col("y") - F.col("ay") - t * dy, 2))
    at = vertices.withColumns({"cx": F.floor(F.col("x") / size).cast("long"), "cy": F.floor(F.col("y") / size).cast("long")})
    rows = at.join(cells, (F.col("cx") == F.col("wx")) & (F.col("cy") == F.col("wy")) & (d <= SNAP_M), "left").select("pattern_id", "seq", "x", "y", "way_id", d.alias("d"))
    near = F.collect_list(F.when(F.col("way_id").isNotNull(), F.struct("d", "way_id")))
    rows = rows.repartition("pattern_id").groupBy("pattern_id", "seq", "x", "y").agg(F.sort_array(near).alias("near"))
    lines = rows.groupBy("pattern_id").agg(F.sort_array(F.collect_list(F.struct("seq", "x", "y", "near"))).alias("line"))
    # Plain arrays, which Arrow hands over without an object for each vertex and candidate.
    flat = F.flatten("line.near")
    lines = lines.select("pattern_id", F.col("line.x").alias("x"), F.col("line.y").alias("y"), F.transform("line.near", F.size).alias("n"), flat["d"].alias("d"), flat["way_id"].alias("way"))

    def scan(xs, ys, counts, ds, ids) -> tuple[str, list[int], float, float]:
        now, ways, worst, covered, total, before, k = None, {}, 0.0, 0.0, 0.0, None, 0
        for x, y, n in zip(xs, ys, counts, strict=True):
            step = math.hypot(x - before[0], y - before[1]) if before is not None else 0.0
            if n:
                # By rising distance: of a way's segments the nearest comes last here and stays.
                options = dict(zip(ids[k : k + n][::-1], ds[k : k + n][::-1], strict=True))
                now = now if now in options and options[now] <= ds[k] + STICK_M else ids[k]
                worst = max(worst, options[now])
                covered += step
                ways[now] = None
            total += step
            before, k = (x, y), k + n
        share = covered / total if total > 0 else 0.0
        return "ok" if share >= COVER else "uncovered", list(ways) if share >= COVER else [], share, worst

    def run(batches):
        for pdf in batches:
            arrays = zip(*(map(np.ndarray.tolist, pdf[c]) for c in ("x", "y", "n", "d", "way")), strict=True)
            yield pd.DataFrame([(p, *scan(*line)) for p, line in zip(pdf["pattern_id"], arrays, strict=True)], columns=["pattern_id", "status", "way_ids", "covered", "worst_m"])

    return lines.mapInPandas(run, "pattern_id long, status string, way_ids array<long>, covered double, worst_m double")


def legs(sequences: DataFrame, key: str = "sequence", calls: str = "calls") -> DataFrame:
    """(key, k, a, b): pairs of calls that follow each other."""
    pair = F.zip_with(F.slice(calls, 1, F.size(calls) - 1), F.slice(calls, 2, F.size(calls) - 1), lambda a, b: F.struct(a.alias("a"), b.alias("b")))
    return sequences.where(F.size(calls) >= 2).select(key, F.posexplode(pair).alias("k", "p")).select(key, "k", "p.a", "p.b")


def resolved_sequences(sequences: DataFrame, stations: DataFrame, key: str = "sequence", calls: str = "calls") -> DataFrame:
    """Sequences all of whose calls have a station; one without drops the whole."""
    rows = sequences.select(key, F.explode(calls).alias("tiploc")).join(stations.select("tiploc", F.lit(True).alias("known")), "tiploc", "left")
    whole = rows.groupBy(key).agg(F.bool_and(F.col("known").isNotNull()).alias("all")).where("all").select(key)
    return sequences.join(whole, key, "left_semi")


def place_legs(pairs: DataFrame, line_stops: DataFrame, stations: DataFrame) -> DataFrame:
    """(a, b, relation_id, low, high): each pair of stations on the line that joins them shortest, by spelling and within the detour.

    pairs (a, b) of TIPLOCs, line_stops (relation_id, spelling, along_m): two equi-joins by spelling and one by line; the best by rank.
    """
    named = stations.select("tiploc", "lat", "lon", F.explode(spellings(F.col("name"))).alias("spelling"))
    on = named.join(line_stops, "spelling").select("tiploc", "relation_id", "along_m", "lat", "lon").distinct()
    a = on.select(F.col("tiploc").alias("a"), "relation_id", F.col("along_m").alias("ma"), F.col("lat").alias("lat1"), F.col("lon").alias("lon1"))
    b = on.select(F.col("tiploc").alias("b"), "relation_id", F.col("along_m").alias("mb"), F.col("lat").alias("lat2"), F.col("lon").alias("lon2"))
    rows = pairs.select("a", "b").distinct().join(a, "a").join(b, ["b", "relation_id"])
    gap = F.abs(F.col("mb") - F.col("ma"))
    rows = rows.withColumn("gap", gap).where((F.col("gap") > 0) & (F.col("gap") <= DETOUR * haversine_m(F.col("lat1"), F.col("lon1"), F.col("lat2"), F.col("lon2"))))
    best = F.row_number().over(Window.partitionBy("a", "b").orderBy("gap", "relation_id", "ma", "mb"))
    return rows.withColumn("_k", best).where("_k = 1").select("a", "b", "relation_id", F.least("ma", "mb").alias("low"), F.greatest("ma", "mb").alias("high"))


def way_trips(weekly: DataFrame, placed: DataFrame, line_ways: DataFrame) -> DataFrame:
    """(way_id, n_trips) from sequences' legs (a, b, trips), placed legs, and lines' ways (relation_id, way_id, from_m, to_m)."""
    rows = weekly.groupBy("a", "b").agg(F.sum("trips").alias("trips")).join(placed, ["a", "b"]).join(line_ways, "relation_id")
    return rows.where("from_m < high and to_m > low").groupBy("way_id").agg(F.sum("trips").cast("long").alias("n_trips"))


def line_ways(paths: DataFrame) -> DataFrame:
    """(relation_id, way_id, from_m, to_m): the stretch of each way along its relation's path."""
    def run(batches):
        for pdf in batches:
            out = []
            for rel, points, owner in zip(pdf["relation_id"], pdf["points"], pdf["owner"], strict=True):
                along = 0.0
                path = [(p["lat"], p["lon"]) for p in points]
                for (a, b), way in zip(zip(path, path[1:], strict=False), owner, strict=True):
                    step = _plane(a, b)
                    if out and out[-1][0] == rel and out[-1][1] == way:
                        out[-1][3] = along + step
                    else:
                        out.append([rel, int(way), along, along + step])
                    along += step
            yield pd.DataFrame(out, columns=["relation_id", "way_id", "from_m", "to_m"])

    return paths.select("relation_id", "points", "owner").mapInPandas(run, "relation_id long, way_id long, from_m double, to_m double")


def line_stops(relations: DataFrame, paths: DataFrame) -> DataFrame:
    """(relation_id, spelling, along_m): the stops of unbroken lines by each spelling of their names."""
    rows = relations.join(paths.where("breaks = 0").select("relation_id", "points"), "relation_id").select("relation_id", "stops", "points")

    @F.pandas_udf("array<double>")
    def along(stops: pd.Series, points: pd.Series) -> pd.Series:
        return pd.Series([[project((s["lat"], s["lon"]), [(p["lat"], p["lon"]) for p in ps])[0] for s in ss] for ss, ps in zip(stops, points, strict=True)])

    rows = rows.where(F.size("points") >= 2).withColumn("m", along("stops", "points")).select("relation_id", F.posexplode(F.arrays_zip("stops", "m")).alias("k", "s"))
    return rows.select("relation_id", F.explode(spellings(F.col("s.stops.name"))).alias("spelling"), F.col("s.m").alias("along_m"))


def covered(status: Column) -> Column:
    return F.count(F.when(status == "ok", 1)) / F.count("*")
