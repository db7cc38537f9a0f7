"""Schemas of the stored tables, and the closed vocabularies of their text columns."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, DoubleType, IntegerType, LongType, StringType, StructField, StructType, TimestampNTZType

_POLY = "lon_e6 array<int>, lat_e6 array<int>"
_BOX = "min_lon_e6 int, min_lat_e6 int, max_lon_e6 int, max_lat_e6 int"

_TYPES = {
    "string": StringType(), "long": LongType(), "int": IntegerType(), "double": DoubleType(), "boolean": BooleanType(),
    "timestamp_ntz": TimestampNTZType(), "array<int>": ArrayType(IntegerType()), "array<long>": ArrayType(LongType()),
}


def _struct(columns: str) -> StructType:
    """Columns as "name type", which unlike Spark's own parser needs no session."""
    return StructType([StructField(n, _TYPES[t]) for n, t in (c.split() for c in columns.split(","))])


TABLES: dict[str, StructType] = {
    name: _struct(ddl)
    for name, ddl in {
        "stops": "stop_id string, name string, lat double, lon double",
        "routes": "route_id string, agency_id string, short_name string, long_name string, route_type string",
        "patterns": "pattern_id long, route_id string, agency_id string, short_name string, direction int, shape_id string, n_stops int, n_trips long, span_m double, mode string, first_seen string, last_seen string",
        "pattern_stops": "pattern_id long, seq int, stop_id string",
        "shapes": f"shape_id string, {_POLY}",
        "match_status": "pattern_id long, status string, source string, confidence double, road_m double, detour double, n_edges int, detail string, matched_at timestamp_ntz",
        "edges": f"edge_id long, way_id long, road_name string, road_class string, length_m double, {_POLY}, {_BOX}",
        "pattern_edges": "pattern_id long, seq int, edge_id long",
        "edge_services": "edge_id long, short_name string, agency_id string, n_patterns long, n_trips long",
        "segments": f"pattern_id long, mode string, {_POLY}, {_BOX}",
        "trace_status": "pattern_id long, status string, relation_id long, osm_route string, n_ways int, n_stops int, worst_stop_m double, length_m double, detail string, traced_at timestamp_ntz",
        "snap_status": "pattern_id long, status string, n_ways int, covered_pct double, worst_m double, length_m double, detail string, snapped_at timestamp_ntz",
        "traces": f"pattern_id long, relation_id long, way_ids array<long>, ways_cut boolean, {_POLY}",
        "ways": f"way_id long, {_POLY}, {_BOX}",
        "track_services": "way_id long, short_name string, agency_id string, mode string, n_patterns long, n_trips long",
        "way_trips": "way_id long, n_trips long",
        "meta": "key string, value string",
    }.items()
}

#: GTFS route types of each mode; fixed values.
MODES: dict[str, frozenset[int]] = {
    "bus": frozenset({3, 11, 800, *range(700, 717)}),
    "coach": frozenset(range(200, 210)),
    "tram": frozenset({0}),
    "metro": frozenset({1}),
    "rail": frozenset({2}),
    "ferry": frozenset({4}),
    "cable_tram": frozenset({5}),
    "aerial": frozenset({6}),
    "funicular": frozenset({7}),
    "monorail": frozenset({12}),
}
ROAD_MODES = ("bus", "coach")
MATCH_STATUS = ("ok", "low_confidence", "no_route", "skipped", "error", "transport_error")
#: The one status that a retry clears without being named.
TRANSIENT = ("transport_error",)


def route_types(modes) -> list[int]:
    """The route types of modes; an unknown name raises and lists those that are known."""
    if unknown := sorted(set(modes) - set(MODES)):
        raise ValueError(f"unknown mode(s) {', '.join(unknown)}; known: {', '.join(sorted(MODES))}")
    return sorted(t for m in set(modes) for t in MODES[m])


def conform(df: DataFrame, table: str) -> DataFrame:
    """df with exactly the table's columns; those that an older snapshot lacks are null."""
    return df.select(*((F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in TABLES[table]))
