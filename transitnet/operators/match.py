"""Map matching: a matcher outside, its answers to edges and statuses here."""

from __future__ import annotations

from typing import Protocol

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from transitnet.functions.geo import with_bbox
from transitnet.operators.graph import checkpointed

#: Below this confidence a shape's match is doubtful; a road longer than this many times the span and these metres is a detour.
LEAST_CONFIDENCE, DETOUR, DETOUR_M = 0.30, 3.0, 1000.0
ANSWER = "source string, confidence double, edges array<struct<edge_id:long,way_id:long,road_name:string,road_class:string,length_m:double,lon_e6:array<int>,lat_e6:array<int>>>, error string"


class Matcher(Protocol):
    """What snaps points to a road graph; called on executors, so it must be picklable."""

    def match_shape(self, points: list[tuple[float, float]]) -> dict: ...
    def match_stops(self, points: list[tuple[float, float]]) -> dict: ...
    def graph_id(self) -> str: ...
    def healthy(self) -> bool: ...


class StraightMatcher:
    """A stand-in for a routing service: each leg between two points is an edge, whose id depends on its ends alone."""

    def graph_id(self) -> str:
        return "straight-1"

    def healthy(self) -> bool:
        return True

    def _answer(self, points: list[tuple[float, float]], source: str) -> dict:
        import hashlib
        import math

        edges = []
        for (a, b), (c, d) in zip(points, points[1:], strict=False):
            ends = [round(v * 1e6) for v in (b, d, a, c)]
            metres = 111_320 * math.hypot(c - a, (d - b) * math.cos(math.radians(a)))
            number = int(hashlib.md5(repr(ends).encode()).hexdigest()[:15], 16)
            edges.append({"edge_id": number, "way_id": number % 1_000_003, "road_name": None, "road_class": "unclassified", "length_m": metres, "lon_e6": ends[:2], "lat_e6": ends[2:]})
        return {"source": source, "confidence": 0.9 if edges else None, "edges": edges, "error": None}

    def match_shape(self, points):
        return self._answer(points, "shape")

    def match_stops(self, points):
        return self._answer(points, "stops")


def points_of(pattern_stops: DataFrame, stops: DataFrame, shapes: DataFrame, patterns: DataFrame) -> DataFrame:
    """(pattern_id, span_m, has_shape, points): a pattern's shape, or else its stops, as array<struct<lat, lon>> in order."""
    own = pattern_stops.join(stops, "stop_id").groupBy("pattern_id").agg(F.sort_array(F.collect_list(F.struct("seq", "lat", "lon"))).alias("p"))
    shaped = shapes.select("shape_id", F.zip_with("lat_e6", "lon_e6", lambda a, b: F.struct((a / 1e6).alias("lat"), (b / 1e6).alias("lon"))).alias("shape"))
    rows = patterns.select("pattern_id", "shape_id", "span_m").join(own, "pattern_id").join(shaped, "shape_id", "left")
    stops_only = F.transform("p", lambda p: F.struct(p["lat"].alias("lat"), p["lon"].alias("lon")))
    return rows.select("pattern_id", "span_m", F.col("shape").isNotNull().alias("has_shape"), F.coalesce("shape", stops_only).alias("points"))


def ask(rows: DataFrame, matcher: Matcher) -> DataFrame:
    """Rows with the matcher's answer, asked in Arrow batches on the executors; a failure is an answer too."""

    @F.pandas_udf(f"struct<{ANSWER.replace(' ', ':', 1).replace(', confidence ', ',confidence:').replace(', edges ', ',edges:').replace(', error ', ',error:')}>")
    def answer(points: pd.Series, shaped: pd.Series) -> pd.DataFrame:
        out = []
        for p, s in zip(points, shaped, strict=True):
            at = [(x["lat"], x["lon"]) for x in p]
            try:
                out.append((matcher.match_shape if s else matcher.match_stops)(at))
            except ConnectionError as e:
                out.append({"source": None, "confidence": None, "edges": [], "error": f"transport: {e}"})
            except Exception as e:
                out.append({"source": None, "confidence": None, "edges": [], "error": str(e)})
        return pd.DataFrame(out)

    return rows.withColumn("a", answer("points", "has_shape"))


def classify(points: Column, source: Column, confidence: Column, edges: Column, road_m: Column, span_m: Column, error: Column) -> Column:
    """The status of an answer."""
    return (
        F.when(F.size(points) < 2, "skipped")
        .when(error.startswith("transport: "), "transport_error")
        .when(error.isNotNull(), "error")
        .when(F.size(edges) == 0, "no_route")
        .when(road_m > span_m * DETOUR + DETOUR_M, "low_confidence")
        .when((source == "shape") & (confidence < LEAST_CONFIDENCE), "low_confidence")
        .otherwise("ok")
    )


def outcomes(answered: DataFrame) -> dict[str, DataFrame]:
    """match_status, pattern_edges and edges of answered rows. The answers are checkpointed: a matcher is asked once, not once for each table."""
    road = F.aggregate("a.edges", F.lit(0.0), lambda acc, e: acc + e["length_m"])
    rows = answered.withColumn("road_m", road)
    status = classify(F.col("points"), F.col("a.source"), F.col("a.confidence"), F.col("a.edges"), F.col("road_m"), F.col("span_m"), F.col("a.error"))
    rows = checkpointed(rows.withColumn("status", status))
    detour = F.try_divide("road_m", "span_m")
    out = rows.select(
        "pattern_id", "status", F.col("a.source").alias("source"), F.col("a.confidence").alias("confidence"), "road_m", detour.alias("detour"), F.size("a.edges").alias("n_edges"), F.col("a.error").alias("detail"),
        F.current_timestamp().cast("timestamp_ntz").alias("matched_at"),
    )
    used = rows.where(F.col("status").isin("ok", "low_confidence")).select("pattern_id", F.posexplode("a.edges").alias("seq", "e"))
    edges = with_bbox(used.where("e.edge_id is not null").select("e.*").dropDuplicates(["edge_id"]))
    return {"match_status": out, "pattern_edges": used.select("pattern_id", "seq", "e.edge_id"), "edges": edges}
