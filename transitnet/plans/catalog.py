"""Registered queries: the operators over the driver's tables, each with DuckDB SQL where SQL can express it.

The tables hold no transit feed. Each query lets them stand for one: orders are trips or patterns, suppliers or parts
are edges, customers are feeds' patterns, events are legs; so the operators run on whole tables and their results can be checked.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from transitnet.functions import arrays, geo, ids, scale, text
from transitnet.operators import aggregate, chains, corridors, coverage, graph, match, network, patterns, publish, tracing, work
from transitnet.store import Store

_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
_SQL: dict[str, str] = {}


def query(sql: str | None = None, **fill: str):
    """Register a query under its function's name, with its SQL."""

    def put(f):
        _QUERIES[f.__name__] = f
        if sql:
            _SQL[f.__name__] = sql.format(**fill) if fill else sql
        return f

    return put


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    from transitnet.plans import roundtrips  # registers its own

    del roundtrips
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    queries()
    return dict(_SQL)


def _t(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


#: DuckDB's twin of ids.text_id.
_ID = "CAST('0x' || substr(md5({k}), 1, 15) AS BIGINT)"

# -- trips to patterns ---------------------------------------------------------------------------------------------


def _trip_sequences(spark, d):
    """Orders as trips: their lines in order are the stops."""
    rows = _t(spark, d, "lineitem").select(F.col("l_orderkey").alias("trip_id"), "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", (F.col("l_suppkey") % 5).cast("string").alias("stop_id"))
    return patterns.sequences(rows, order=("l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"))


_SEQ = """WITH seq AS (SELECT l_orderkey AS trip_id, list(CAST(l_suppkey % 5 AS VARCHAR)
  ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice, CAST(l_suppkey % 5 AS VARCHAR)) AS s FROM lineitem GROUP BY 1)"""


@query(_SEQ + " SELECT trip_id, array_to_string(s, '>') AS stops, CAST(len(s) AS INTEGER) AS n_stops FROM seq")
def trip_sequences(spark, d):
    return _trip_sequences(spark, d).select("trip_id", F.array_join("stop_seq", ">").alias("stops"), F.size("stop_seq").alias("n_stops"))


def _pattern_rows(spark, d):
    o = _t(spark, d, "orders")
    own = o.select(
        F.col("o_orderkey").alias("trip_id"), F.col("o_orderstatus").alias("route_id"), F.lit(None).cast("string").alias("agency_id"), F.lit(None).cast("string").alias("short_name"),
        (F.col("o_custkey") % 2).cast("int").alias("direction"), F.lit("bus").alias("mode"), (F.col("o_orderkey") % 7 + 1).cast("int").alias("days"), F.substring("o_orderpriority", 1, 1).alias("shape_id"),
    )
    return own.join(_trip_sequences(spark, d), "trip_id")


_PAT = (
    _SEQ
    + """, raw AS (SELECT o_orderstatus AS route_id, CAST(o_custkey % 2 AS INTEGER) AS direction, s, o_orderkey % 7 + 1 AS days, substr(o_orderpriority, 1, 1) AS shape_id
  FROM orders JOIN seq ON trip_id = o_orderkey WHERE len(s) >= 2),
keyed AS (SELECT *, """
    + _ID.format(k="route_id || '|' || CAST(direction AS VARCHAR) || '|' || array_to_string(s, '>')")
    + """ AS pattern_id FROM raw),
shape AS (SELECT pattern_id, arg_min(shape_id, (-n, shape_id)) AS shape_id FROM (SELECT pattern_id, shape_id, count(*) AS n FROM keyed GROUP BY 1, 2) GROUP BY 1),
pat AS (SELECT pattern_id, min(route_id) AS route_id, min(direction) AS direction, any_value(s) AS s, count(*) AS trips, CAST(sum(days) AS BIGINT) AS n_trips FROM keyed GROUP BY 1)"""
)


@query(_PAT + " SELECT pattern_id, route_id, direction, array_to_string(s, '>') AS stops, CAST(len(s) AS INTEGER) AS n_stops, trips, n_trips, shape_id FROM pat JOIN shape USING (pattern_id)")
def pattern_collapse(spark, d):
    out = patterns.collapse(_pattern_rows(spark, d))
    return out.select("pattern_id", "route_id", "direction", F.array_join("stop_seq", ">").alias("stops"), "n_stops", "trips", "n_trips", "shape_id")


@query(_PAT + " SELECT pattern_id, CAST(unnest(range(len(s))) AS INTEGER) AS seq, unnest(s) AS stop_id FROM pat")
def pattern_stops(spark, d):
    return patterns.pattern_stops(patterns.collapse(_pattern_rows(spark, d)))


@query("SELECT l_returnflag, arg_min(l_linestatus, (-n, l_linestatus)) AS l_linestatus FROM (SELECT l_returnflag, l_linestatus, count(*) AS n FROM lineitem GROUP BY 1, 2) GROUP BY 1")
def mode_tiebreak(spark, d):
    return patterns.most_common("l_linestatus", ["l_returnflag"], _t(spark, d, "lineitem"))


@query("SELECT count(DISTINCT o_orderkey) AS keys, count(*) AS rows FROM orders")
def id_collisions(spark, d):
    o = ids.check_unique(_t(spark, d, "orders").withColumn("id", ids.text_id(F.col("o_orderkey").cast("string"))), "id", ["o_orderkey"])
    return o.agg(F.count_distinct("id").alias("keys"), F.count("*").alias("rows"))


def _points(spark, d):
    """Parts at places that their keys decide."""
    k = F.col("p_partkey")
    return _t(spark, d, "part").select(k.alias("stop_id"), (48.0 + (k * 37 % 1500) / 100.0).alias("lat"), (-12.0 + (k * 53 % 1600) / 100.0).alias("lon"), "p_brand", "p_size")


_PTS = "WITH pts AS (SELECT p_partkey AS stop_id, 48.0 + (p_partkey * 37 % 1500) / 100.0 AS lat, -12.0 + (p_partkey * 53 % 1600) / 100.0 AS lon, p_brand, p_size FROM part)"


@query(_PTS + " SELECT stop_id, lat BETWEEN 49.8 AND 61.1 AND lon BETWEEN -11.0 AND least(2.0, 0.9 + 0.6 * (lat - 50.0)) AS inside FROM pts")
def isles_filter(spark, d):
    return _points(spark, d).select("stop_id", geo.in_isles(F.col("lat"), F.col("lon")).alias("inside"))


_HAV = "2 * 6371000.0 * asin(sqrt(pow(sin(radians({b} - {a}) / 2), 2) + cos(radians({a})) * cos(radians({b})) * pow(sin(radians({y} - {x}) / 2), 2)))"


@query(
    _PTS
    + ", n AS (SELECT p_brand, lat, lon, lead(lat) OVER w AS lat2, lead(lon) OVER w AS lon2 FROM pts WINDOW w AS (PARTITION BY p_brand ORDER BY stop_id)), h AS (SELECT p_brand, "
    + _HAV.format(a="lat", b="lat2", x="lon", y="lon2")
    + " AS d FROM n WHERE lat2 IS NOT NULL) SELECT p_brand AS pattern_id, round(sum(d), 1) AS span_m, round(max(d), 1) AS max_gap_m FROM h GROUP BY 1"
)
def span_and_gap(spark, d):
    p = _points(spark, d)
    out = patterns.gaps(p.select(F.col("p_brand").alias("pattern_id"), F.col("stop_id").alias("seq"), "stop_id"), p)
    return out.select("pattern_id", F.round("span_m", 1).alias("span_m"), F.round("max_gap_m", 1).alias("max_gap_m"))


@query(
    _PTS
    + ", bad AS (SELECT DISTINCT p_size FROM pts WHERE NOT (lat BETWEEN 49.8 AND 61.1 AND lon BETWEEN -11.0 AND least(2.0, 0.9 + 0.6 * (lat - 50.0)))) SELECT p_size AS pattern_id, count(*) AS stops FROM pts WHERE p_size NOT IN (SELECT p_size FROM bad) GROUP BY 1"
)
def boundary_drops_patterns(spark, d):
    p = _points(spark, d)
    seq = p.groupBy(F.col("p_size").alias("pattern_id")).agg(F.collect_list("stop_id").alias("stop_seq"))
    return patterns.inside_isles(seq, p).select("pattern_id", F.size("stop_seq").cast("long").alias("stops"))


@query("SELECT c_mktsegment AS route_type, c_nationkey IN (2, 3, 7) AS kept, count(*) AS routes, count(DISTINCT c_nationkey) AS agencies FROM customer GROUP BY 1, 2")
def mode_census(spark, d):
    c = _t(spark, d, "customer")
    return c.groupBy(F.col("c_mktsegment").alias("route_type"), patterns.kept_type(F.col("c_nationkey").cast("string"), [2, 3, 7]).alias("kept")).agg(F.count("*").alias("routes"), F.count_distinct("c_nationkey").alias("agencies"))


@query(
    "SELECT CAST(n_nationkey AS VARCHAR) AS route_type, CASE WHEN n_nationkey IN (3, 11) THEN 'bus' WHEN n_nationkey = 0 THEN 'tram' WHEN n_nationkey = 1 THEN 'metro' WHEN n_nationkey = 2 THEN 'rail' WHEN n_nationkey = 4 THEN 'ferry' "
    "WHEN n_nationkey = 5 THEN 'cable_tram' WHEN n_nationkey = 6 THEN 'aerial' WHEN n_nationkey = 7 THEN 'funicular' WHEN n_nationkey = 12 THEN 'monorail' END AS mode FROM nation"
)
def mode_case(spark, d):
    key = F.col("n_nationkey").cast("string")
    return _t(spark, d, "nation").select(key.alias("route_type"), patterns.mode_of(key).alias("mode"))


def _two_feeds(spark, d):
    """Customers ordering before 1995-06-17, and from then on, as two feeds of patterns."""
    o = _t(spark, d, "orders").groupBy(F.col("o_custkey").alias("pattern_id"), (F.col("o_orderdate") < "1995-06-17").alias("old")).agg(F.count("*").alias("n_trips"))
    first = o.where("old").select("pattern_id", "n_trips", F.lit("v1").alias("first_seen"), F.lit("v1").alias("last_seen"))
    return first, o.where("not old").select("pattern_id", "n_trips")


_FEEDS = "WITH a AS (SELECT o_custkey AS id, count(*) AS n FROM orders WHERE o_orderdate < '1995-06-17' GROUP BY 1), b AS (SELECT o_custkey AS id, count(*) AS n FROM orders WHERE o_orderdate >= '1995-06-17' GROUP BY 1)"


@query(_FEEDS + " SELECT coalesce(a.id, b.id) AS pattern_id, coalesce(b.n, a.n) AS n_trips, CASE WHEN a.id IS NULL THEN 'v2' ELSE 'v1' END AS first_seen, CASE WHEN b.id IS NULL THEN 'v1' ELSE 'v2' END AS last_seen FROM a FULL JOIN b ON a.id = b.id")
def feed_merge(spark, d):
    old, new = _two_feeds(spark, d)
    return patterns.merge(old, new, "v2")


@query(
    _FEEDS
    + ", m AS (SELECT id FROM a WHERE id % 3 = 0) SELECT count(*) FILTER (a.id IS NULL) AS new, count(*) FILTER (a.id IS NOT NULL AND b.id IS NOT NULL AND m.id IS NULL) AS returning_unmatched, count(*) FILTER (b.id IS NULL) AS departed FROM a FULL JOIN b ON a.id = b.id LEFT JOIN m ON m.id = coalesce(a.id, b.id)"
)
def churn(spark, d):
    old, new = _two_feeds(spark, d)
    return patterns.churn(old, new, old.where("pattern_id % 3 = 0"), "pattern_id")


@query(_FEEDS + " SELECT id AS pattern_id, CASE WHEN id % 4 IN (1, 2) THEN NULL ELSE 'v1' END AS last_seen FROM a")
def retire_modes(spark, d):
    old, _ = _two_feeds(spark, d)
    modes = F.element_at(F.array(F.lit("bus"), F.lit("rail"), F.lit("tram"), F.lit(None).cast("string")), (F.col("pattern_id") % 4 + 1).cast("int"))
    return patterns.retire_modes(old.withColumn("mode", modes), ["bus"]).select("pattern_id", "last_seen")


# -- services of edges and ways --------------------------------------------------------------------------------------


def _as_patterns(spark, d):
    return _t(spark, d, "orders").select(F.col("o_orderkey").alias("pattern_id"), F.col("o_orderstatus").alias("short_name"), F.col("o_orderpriority").alias("agency_id"), (F.col("o_orderkey") % 50 + 1).alias("n_trips"), F.col("o_orderkey").cast("string").alias("route_id"))


def _as_edges(spark, d):
    return _t(spark, d, "lineitem").select(F.col("l_orderkey").alias("pattern_id"), F.col("l_suppkey").alias("edge_id"))


_ES = "(SELECT l_suppkey AS edge_id, o_orderstatus AS short_name, o_orderpriority AS agency_id, count(*) AS n_patterns, CAST(sum(o_orderkey % 50 + 1) AS BIGINT) AS n_trips FROM (SELECT DISTINCT l_orderkey, l_suppkey FROM lineitem) JOIN orders ON o_orderkey = l_orderkey GROUP BY 1, 2, 3)"


@query("SELECT * FROM " + _ES)
def edge_service_inversion(spark, d):
    return aggregate.edge_services(_as_edges(spark, d), _as_patterns(spark, d), F.lit(True))


@query(
    "SELECT l_suppkey AS way_id, o_orderstatus AS short_name, o_orderpriority AS agency_id, CASE WHEN o_custkey % 2 = 0 THEN 'rail' ELSE 'tram' END AS mode, count(*) AS n_patterns, "
    "CAST(sum(CASE WHEN o_orderstatus <> 'P' THEN o_orderkey % 50 + 1 END) AS BIGINT) AS n_trips FROM (SELECT DISTINCT l_orderkey, l_suppkey FROM lineitem) JOIN orders ON o_orderkey = l_orderkey WHERE l_orderkey % 3 <> 0 GROUP BY 1, 2, 3, 4"
)
def track_inversion_nullsum(spark, d):
    o = _t(spark, d, "orders").select(
        F.col("o_orderkey").alias("pattern_id"), F.col("o_orderstatus").alias("short_name"), F.col("o_orderpriority").alias("agency_id"), F.when(F.col("o_custkey") % 2 == 0, "rail").otherwise("tram").alias("mode"),
        F.when(F.col("o_orderstatus") != "P", F.col("o_orderkey") % 50 + 1).alias("n_trips"), F.col("o_orderkey").cast("string").alias("route_id"),
    )
    traces = _as_edges(spark, d).groupBy("pattern_id").agg(F.collect_list("edge_id").alias("way_ids")).withColumn("ways_cut", F.when(F.col("pattern_id") % 3 != 0, True))
    return aggregate.track_services(traces, o, F.lit(True))


@query("SELECT o_orderkey FROM orders WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey)")
def pending_work(spark, d):
    return work.pending(_t(spark, d, "orders").select("o_orderkey"), _t(spark, d, "lineitem"), "o_orderkey", "l_orderkey")


@query("SELECT l_orderkey AS pattern_id, count(*) AS n_trips FROM lineitem GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 25")
def busiest_first_topk(spark, d):
    return work.busiest_first(_t(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("pattern_id")).agg(F.count("*").alias("n_trips")), 25)


@query("SELECT o_orderkey AS pattern_id, o_orderstatus AS status FROM orders WHERE o_orderstatus <> 'F'")
def retry_clears(spark, d):
    o = _t(spark, d, "orders").select(F.col("o_orderkey").alias("pattern_id"), F.when(F.col("o_orderstatus") == "F", "transport_error").otherwise(F.col("o_orderstatus")).alias("status"))
    return work.retry({"match_status": o}, ["transient"])["match_status"]


@query("SELECT o_orderkey AS pattern_id, CASE WHEN o_orderstatus = 'F' AND regexp_matches(o_orderpriority, 'HIGH|URGENT') AND o_orderpriority NOT LIKE '%URGENT' THEN 'transport_error' WHEN o_orderstatus = 'F' THEN 'error' ELSE 'ok' END AS status FROM orders")
def reclassify_faults(spark, d):
    o = _t(spark, d, "orders").select(F.col("o_orderkey").alias("pattern_id"), F.when(F.col("o_orderstatus") == "F", "error").otherwise("ok").alias("status"), F.col("o_orderpriority").alias("detail"))
    return work.reclassify(o, "HIGH|URGENT", "%URGENT").select("pattern_id", "status")


@query("SELECT l_suppkey AS edge_id, CAST(1 AS BIGINT) AS rows, count(*) AS links, count(DISTINCT l_orderkey) AS patterns FROM lineitem JOIN orders ON o_orderkey = l_orderkey GROUP BY 1")
def match_commit(spark, d):
    """All orders matched to their suppliers in three batches of a store: an edge that several batches bring is there once."""
    store = Store(spark, f"{graph.shared_folder(spark)}/store-{uuid.uuid4().hex[:12]}")
    items = _t(spark, d, "orders").select(F.col("o_orderkey").alias("pattern_id"), (F.col("o_orderkey") % 50 + 1).alias("n_trips"))
    lines = _t(spark, d, "lineitem").select(F.col("l_orderkey").alias("pattern_id"), F.col("l_suppkey").alias("edge_id"), "l_linenumber", "l_partkey", "l_extendedprice")
    place = F.row_number().over(Window.partitionBy("pattern_id").orderBy("l_linenumber", "l_partkey", "edge_id", "l_extendedprice")) - 1

    def process(batch):
        links = lines.join(batch.select("pattern_id"), "pattern_id", "left_semi").withColumn("seq", place)
        return {"match_status": batch.select("pattern_id", F.lit("ok").alias("status")), "pattern_edges": links, "edges": links.select("edge_id", F.lit(100.0).alias("length_m"))}

    work.run(store, lambda n: work.busiest_first(work.pending(items, store.read("match_status")), n), process, -(-items.count() // 3))
    links = store.read("pattern_edges").groupBy("edge_id").agg(F.count("*").alias("links"), F.count_distinct("pattern_id").alias("patterns"))
    return store.read("edges").groupBy("edge_id").agg(F.count("*").alias("rows")).join(links, "edge_id")


@query(
    "SELECT count(*) AS patterns, count(*) FILTER (c_nationkey < 20) AS live, count(*) FILTER (c_nationkey < 20 AND s = 'ok') AS matched, count(*) FILTER (c_nationkey < 20 AND s IS NULL) AS pending, CAST(sum(CASE WHEN c_nationkey < 20 THEN c_custkey % 9 END) AS BIGINT) AS trips, "
    "CAST(sum(CASE WHEN c_nationkey < 20 AND s = 'ok' THEN c_custkey % 9 END) AS BIGINT) AS trips_matched FROM (SELECT *, CASE WHEN c_custkey % 5 = 0 THEN NULL WHEN c_custkey % 5 = 1 THEN 'no_route' ELSE 'ok' END AS s FROM customer)"
)
def funnel(spark, d):
    c = _t(spark, d, "customer").select(F.col("c_custkey").alias("pattern_id"), F.col("c_mktsegment").alias("mode"), "c_nationkey", (F.col("c_custkey") % 9).alias("n_trips"))
    status = c.where("pattern_id % 5 <> 0").select("pattern_id", F.when(F.col("pattern_id") % 5 == 1, "no_route").otherwise("ok").alias("status"))
    return aggregate.funnel(c, status, F.col("c_nationkey") < 20).drop("by_status", "by_mode")


@query(
    "SELECT o_orderkey AS pattern_id, CASE WHEN l.n IS NULL THEN 'no_route' WHEN l.q > o_orderkey % 400 * 3 / 100.0 + 120 THEN 'low_confidence' WHEN o_orderstatus = 'F' AND o_custkey % 100 / 100.0 < 0.3 THEN 'low_confidence' ELSE 'ok' END AS status "
    "FROM orders LEFT JOIN (SELECT l_orderkey, count(*) AS n, sum(l_quantity) AS q FROM lineitem GROUP BY 1) l ON l_orderkey = o_orderkey"
)
def match_classification(spark, d):
    lines = _t(spark, d, "lineitem").groupBy("l_orderkey").agg(F.collect_list("l_linenumber").alias("edges"), F.sum("l_quantity").alias("road"))
    o = _t(spark, d, "orders").join(lines, F.col("o_orderkey") == F.col("l_orderkey"), "left")
    span = (F.col("o_orderkey") % 400 / 100.0 + (120.0 - match.DETOUR_M) / match.DETOUR)
    status = match.classify(F.array(F.lit(1), F.lit(2)), F.when(F.col("o_orderstatus") == "F", "shape").otherwise("stops"), F.col("o_custkey") % 100 / 100.0, F.coalesce("edges", F.array().cast("array<int>")), F.col("road"), span, F.lit(None).cast("string"))
    return o.select(F.col("o_orderkey").alias("pattern_id"), status.alias("status"))


# -- the query specification -------------------------------------------------------------------------------------------


def _network(spark, d, box=(-8_000_000, 49_000_000, 8_000_000, 58_000_000)):
    """Suppliers as edges with boxes that their keys decide; a third of them without services."""
    k = F.col("s_suppkey")
    edges = _t(spark, d, "supplier").select(
        k.alias("edge_id"), F.floor(k / 3).alias("way_id"), F.when(k % 4 != 0, F.concat(F.lit("Road "), (k % 11).cast("string"))).alias("road_name"), F.element_at(F.array(F.lit("primary"), F.lit("secondary"), F.lit("tertiary")), (k % 3 + 1).cast("int")).alias("road_class"),
        (k % 190 + 10).cast("double").alias("length_m"), ((k * 7919 % 20000 - 10000) * 1000).cast("int").alias("min_lon_e6"), ((k * 6101 % 12000 + 48000) * 1000).cast("int").alias("min_lat_e6"),
    )
    edges = edges.withColumns({"max_lon_e6": F.col("min_lon_e6") + 1000, "max_lat_e6": F.col("min_lat_e6") + 1000})
    services = aggregate.edge_services(_as_edges(spark, d), _as_patterns(spark, d), F.lit(True)).where("edge_id % 3 <> 0")
    return network.Network(edges, services, box)


_NET = f"""WITH e AS (SELECT s_suppkey AS edge_id, s_suppkey // 3 AS way_id, CASE WHEN s_suppkey % 4 <> 0 THEN 'Road ' || CAST(s_suppkey % 11 AS VARCHAR) END AS road_name, ['primary', 'secondary', 'tertiary'][s_suppkey % 3 + 1] AS road_class, CAST(s_suppkey % 190 + 10 AS DOUBLE) AS length_m,
  (s_suppkey * 7919 % 20000 - 10000) * 1000 AS x, (s_suppkey * 6101 % 12000 + 48000) * 1000 AS y FROM supplier),
win AS (SELECT * FROM e WHERE x + 1000 >= -8000000 AND x <= 8000000 AND y + 1000 >= 49000000 AND y <= 58000000), es AS (SELECT * FROM {_ES} WHERE edge_id % 3 <> 0)"""

_WEIGHT_SQL = {
    "trips": "sum(n_trips)", "services": "count(DISTINCT short_name)", "operators": "count(DISTINCT agency_id)", "patterns": "sum(n_patterns)", "busiest": "max(n_trips)", "density": "sum(n_trips) / greatest(min(length_m), 1.0)",
}


def _weights_query(name: str) -> None:
    def f(spark, d):
        return _network(spark, d).weights(network.QuerySpec(weight=name)).select("edge_id", F.round("weight", 9).alias("weight"))

    f.__name__ = f"edges_weighted_{name}"
    query(_NET + f" SELECT edge_id, round(coalesce(CAST({_WEIGHT_SQL[name]} AS DOUBLE), 0), 9) AS weight FROM win LEFT JOIN es USING (edge_id) GROUP BY 1")(f)


def _selective_query(name: str) -> None:
    def f(spark, d):
        spec = network.QuerySpec(weight=name, operator=("1-URGENT", "2-HIGH"), road_class=("secondary", "tertiary"), min_trips=40)
        return _network(spark, d).weights(spec).select("edge_id", F.round("weight", 9).alias("weight"))

    f.__name__ = f"edges_selective_{name}"
    query(
        _NET
        + f" SELECT edge_id, round(CAST({_WEIGHT_SQL[name]} AS DOUBLE), 9) AS weight FROM win JOIN es USING (edge_id) WHERE road_class IN ('secondary', 'tertiary') AND agency_id IN ('1-URGENT', '2-HIGH') GROUP BY 1 HAVING sum(n_trips) >= 40"
    )(f)


for _name in network.WEIGHTS:
    _weights_query(_name)
    _selective_query(_name)

_GROUP_SQL = {"service": ("short_name", "JOIN"), "operator": ("agency_id", "JOIN"), "road_class": ("road_class", "LEFT JOIN"), "way": ("way_id", "LEFT JOIN"), "road_name": ("road_name", "LEFT JOIN")}
_ORDER_SQL = {"widest": "n_edges DESC, grp", "narrowest": "n_edges, grp", "busiest": "trips DESC, grp", "quietest": "trips, grp", "name": "grp"}


def _group_cte(group: str) -> str:
    column, join = _GROUP_SQL[group]
    return (
        _NET
        + f", w AS (SELECT edge_id, coalesce(CAST(sum(n_trips) AS DOUBLE), 0) AS weight FROM win LEFT JOIN es USING (edge_id) GROUP BY 1), p AS (SELECT DISTINCT coalesce(CAST({column} AS VARCHAR), 'unknown') AS grp, edge_id FROM win {join} es USING (edge_id)), "
        "g AS (SELECT grp, count(*) AS n_edges, sum(weight) AS trips FROM p JOIN w USING (edge_id) GROUP BY 1)"
    )


def _groups_query(group: str) -> None:
    def f(spark, d):
        return _network(spark, d).groups(network.QuerySpec(group=group))

    f.__name__ = f"group_stats_{group}"
    query(_group_cte(group) + " SELECT grp, n_edges, trips FROM g")(f)


def _order_query(order: str) -> None:
    def f(spark, d):
        stats = _network(spark, d).groups(network.QuerySpec(group="road_name", order=order))
        return stats.withColumn("place", F.row_number().over(Window.orderBy(*network.group_order(order)))).select("grp", "place")

    f.__name__ = f"grouped_{order}"
    query(_group_cte("road_name") + f" SELECT grp, CAST(row_number() OVER (ORDER BY {_ORDER_SQL[order]}) AS INTEGER) AS place FROM g")(f)


for _name in network.GROUPS:
    _groups_query(_name)
for _name in network.ORDERS:
    _order_query(_name)


@query(_group_cte("service") + " SELECT grp, edge_id, weight, n_edges, trips, road_class FROM p JOIN w USING (edge_id) JOIN g USING (grp) JOIN e USING (edge_id)")
def grouped_edges(spark, d):
    return _network(spark, d).grouped_query(network.QuerySpec()).select("grp", "edge_id", "weight", "n_edges", "trips", "road_class")


@query(_group_cte("service") + ", s AS (SELECT edge_id, array_to_string(list_sort(list(grp)), ',') AS groups FROM p GROUP BY 1) SELECT edge_id, road_class, weight, groups FROM win JOIN w USING (edge_id) LEFT JOIN s USING (edge_id)")
def edges_with_groups(spark, d):
    return _network(spark, d).edges_query(network.QuerySpec(), with_groups=True).select("edge_id", "road_class", "weight", F.array_join("groups", ",").alias("groups"))


_BOUNDS = "r AS (SELECT weight, row_number() OVER (ORDER BY weight) - 1 AS k, count(*) OVER () AS n FROM w)"


@query(_group_cte("service") + ", " + _BOUNDS + " SELECT max(weight) FILTER (k = least(n - 1, floor(0.02 * n))) AS lo, max(weight) FILTER (k = least(n - 1, floor(0.98 * n))) AS hi FROM r")
def weight_bounds(spark, d):
    return _network(spark, d).bounds(network.QuerySpec())


@query(
    _group_cte("road_name")
    + ", r AS (SELECT trips, row_number() OVER (ORDER BY trips) - 1 AS k, count(*) OVER () AS n FROM g), b AS (SELECT max(trips) FILTER (k = least(n - 1, floor(0.02 * n))) AS lo, max(trips) FILTER (k = least(n - 1, floor(0.98 * n))) AS hi FROM r) "
    "SELECT grp, round(CASE WHEN hi <= lo THEN 0.5 ELSE least(greatest((ln(1 + trips) - ln(1 + lo)) / (ln(1 + hi) - ln(1 + lo)), 0), 1) END, 9) AS weight FROM g, b"
)
def group_weights(spark, d):
    return _network(spark, d).group_weights(network.QuerySpec(group="road_name")).select("grp", F.round("weight", 9).alias("weight"))


@query(_NET + " SELECT edge_id, way_id, road_class, length_m FROM win WHERE road_class IN ('primary')")
def window_overlap(spark, d):
    return _network(spark, d).window(network.QuerySpec(road_class=("primary",))).select("edge_id", "way_id", "road_class", "length_m")


@query(_NET + " SELECT edge_id FROM win WHERE " + _ID.format(k="CAST(edge_id AS VARCHAR)") + " % 4 = 0")
def sampled_edges(spark, d):
    """A sampling operator: a preview's one edge in four."""
    return _network(spark, d).window(network.QuerySpec(sample=4)).select("edge_id")


@query("SELECT DISTINCT p_brand FROM part WHERE p_brand IS NOT NULL ORDER BY 1 LIMIT 500")
def facets(spark, d):
    p = _t(spark, d, "part")
    return network.Network(p, p).facet("p_brand")


@query("SELECT max(v) FILTER (k = least(n - 1, floor(0.02 * n))) AS lo, max(v) FILTER (k = least(n - 1, floor(0.98 * n))) AS hi FROM (SELECT l_extendedprice AS v, row_number() OVER (ORDER BY l_extendedprice) - 1 AS k, count(*) OVER () AS n FROM lineitem)")
def order_statistics(spark, d):
    return network.order_statistics(_t(spark, d, "lineitem"), "l_extendedprice", {"lo": 0.02, "hi": 0.98})


# -- geometry and order ------------------------------------------------------------------------------------------------

def _sql_spread(v: str) -> str:
    for shift, mask in ((8, 0x00FF00FF), (4, 0x0F0F0F0F), (2, 0x33333333), (1, 0x55555555)):
        v = f"(({v}) | (({v}) << {shift})) & {mask}"
    return f"({v})"


@query(f"SELECT p_partkey, {_sql_spread('(p_partkey * 37) & 65535')} | ({_sql_spread('(p_partkey * 101) & 65535')} << 1) AS code FROM part")
def morton_order(spark, d):
    return _t(spark, d, "part").select("p_partkey", geo.morton(F.col("p_partkey") * 37, F.col("p_partkey") * 101).alias("code"))


@query(_PTS + " SELECT stop_id, round((lon + 180) / 360, 9) AS x, round((1 - ln(tan(pi() / 4 + radians(lat) / 2)) / pi()) / 2, 9) AS y FROM pts")
def mercator(spark, d):
    x, y = geo.mercator(F.col("lat"), F.col("lon"))
    return _points(spark, d).select("stop_id", F.round(x, 9).alias("x"), F.round(y, 9).alias("y"))


@query(_PTS + " SELECT p_brand, round(sum(sqrt(pow((lon2 - lon) * 111320.0 * cos(radians(lat)), 2) + pow((lat2 - lat) * 111320.0, 2))), 1) AS metres FROM (SELECT p_brand, lat, lon, lead(lat) OVER w AS lat2, lead(lon) OVER w AS lon2 FROM pts WINDOW w AS (PARTITION BY p_brand ORDER BY stop_id)) WHERE lat2 IS NOT NULL GROUP BY 1")
def planar_length(spark, d):
    w = Window.partitionBy("p_brand").orderBy("stop_id")
    p = _points(spark, d).select("p_brand", "lat", "lon", F.lead("lat").over(w).alias("lat2"), F.lead("lon").over(w).alias("lon2")).where("lat2 is not null")
    return p.groupBy("p_brand").agg(F.round(F.sum(geo.planar_m(F.col("lat"), F.col("lon"), F.col("lat2"), F.col("lon2"), F.col("lat"))), 1).alias("metres"))


@query("SELECT round(quantile_cont((p_size * 100 + p_partkey % 100) / 2.0, 0.25), 2) AS q1, round(quantile_cont((p_size * 100 + p_partkey % 100) / 2.0, 0.5), 2) AS q2, round(quantile_cont((p_size * 100 + p_partkey % 100) / 2.0, 0.75), 2) AS q3 FROM part")
def band_cuts(spark, d):
    p = _t(spark, d, "part").select((F.col("p_size") * 100).alias("min_lat_e6"), (F.col("p_partkey") % 100).alias("max_lat_e6"))
    cuts = p.agg(F.percentile((F.col("min_lat_e6") + F.col("max_lat_e6")) / 2, [0.25, 0.5, 0.75]).alias("q"))
    return cuts.select(*(F.round(F.get("q", k), 2).alias(f"q{k + 1}") for k in range(3)))


# -- chains and corridors ------------------------------------------------------------------------------------------------


def _links(spark, d):
    """Orders as edges between nodes that their keys decide: runs of ten, some forked and some of another weight."""
    k = F.col("o_orderkey")
    n = F.when(k % 97 == 0, k - 1).otherwise(k)
    return _t(spark, d, "orders").select(k.alias("id"), n.alias("from_node"), F.when(k % 10 == 9, -k).otherwise(k + 1).alias("to_node"), F.when(k % 37 == 0, 2.0).otherwise(1.0).alias("weight"))


_LINKS = "WITH e AS (SELECT o_orderkey AS id, CASE WHEN o_orderkey % 97 = 0 THEN o_orderkey - 1 ELSE o_orderkey END AS f, CASE WHEN o_orderkey % 10 = 9 THEN -o_orderkey ELSE o_orderkey + 1 END AS t, CASE WHEN o_orderkey % 37 = 0 THEN 2.0 ELSE 1.0 END AS w FROM orders)"
_SUCC = _LINKS + ", i AS (SELECT t AS n, w, count(*) AS c FROM e GROUP BY 1, 2), o AS (SELECT f AS n, w, count(*) AS c, min(id) AS nx FROM e GROUP BY 1, 2), s AS (SELECT e.id, CASE WHEN o.nx <> e.id THEN o.nx END AS next_id FROM e LEFT JOIN i ON i.n = e.t AND i.w = e.w AND i.c = 1 LEFT JOIN o ON o.n = i.n AND o.w = i.w AND o.c = 1)"


@query(_SUCC + " SELECT id, next_id FROM s")
def successor_relation(spark, d):
    return chains.successors(_links(spark, d))


@query(_SUCC.replace("WITH e", "WITH RECURSIVE e") + ", c(id, chain, seq) AS (SELECT id, id, CAST(0 AS BIGINT) FROM s WHERE id NOT IN (SELECT next_id FROM s WHERE next_id IS NOT NULL) UNION ALL SELECT s.next_id, c.chain, c.seq + 1 FROM c JOIN s ON s.id = c.id WHERE s.next_id IS NOT NULL) SELECT id, chain, seq FROM c")
def chain_ids(spark, d):
    return graph.follow(chains.successors(_links(spark, d)))


@query(_LINKS.replace("WITH e", "WITH RECURSIVE e") + ", u AS (SELECT f AS a, t AS b FROM e UNION SELECT t, f FROM e), r(n, c) AS (SELECT a, a FROM u UNION SELECT u.b, r.c FROM r JOIN u ON u.a = r.n) SELECT n AS node, min(c) AS component FROM r GROUP BY 1")
def connected_components(spark, d):
    return graph.components(_links(spark, d).select(F.col("from_node").alias("a"), F.col("to_node").alias("b")))


@query("SELECT l_orderkey, min(l_suppkey) AS edge_id, names, count(*) AS n FROM (SELECT l_orderkey, l_suppkey, array_to_string(list_sort(list_distinct(list(l_returnflag || l_linestatus))), ',') AS names FROM lineitem GROUP BY 1, 2) GROUP BY l_orderkey, names")
def coalesce_keys(spark, d):
    sets = _t(spark, d, "lineitem").groupBy("l_orderkey", "l_suppkey").agg(F.array_join(F.sort_array(F.collect_set(F.concat("l_returnflag", "l_linestatus"))), ",").alias("names"))
    return sets.groupBy("l_orderkey", "names").agg(F.min("l_suppkey").alias("edge_id"), F.count("*").alias("n"))


@query("SELECT least(l_partkey, l_suppkey) AS a, greatest(l_partkey, l_suppkey) AS b, min(l_orderkey) AS edge_id FROM lineitem GROUP BY 1, 2")
def canonical_direction(spark, d):
    rows = _t(spark, d, "lineitem").select("l_orderkey", arrays.canonical(F.array("l_partkey", "l_suppkey")).alias("p"))
    return rows.groupBy(F.get("p", 0).alias("a"), F.get("p", 1).alias("b")).agg(F.min("l_orderkey").alias("edge_id"))


@query("SELECT l_suppkey AS edge_id, CAST(len(r) AS BIGINT) AS n, array_to_string(list_transform(r[1:3], lambda x: x.p), ',') AS refs, t AS trips FROM (SELECT l_suppkey, list({'q': -q, 'p': p} ORDER BY -q, p) AS r, CAST(sum(q) AS BIGINT) AS t FROM (SELECT l_suppkey, l_shipdate::DATE::VARCHAR AS p, count(*) AS q FROM lineitem GROUP BY 1, 2) GROUP BY 1)")
def refs_list(spark, d):
    rows = _t(spark, d, "lineitem").select(F.col("l_suppkey").alias("edge_id"), F.col("l_shipdate").cast("date").cast("string").alias("short_name"), F.lit(1).alias("n_trips"))
    return publish.refs(rows, ["edge_id"], most=3).select("edge_id", "n", F.array_join("refs", ",").alias("refs"), "trips")


_CELLS = "(SELECT c_nationkey AS cell, c_custkey AS corridor, CAST(floor(c_acctbal) AS BIGINT) AS length_m, c_custkey % 7 AS trips, c_custkey % 4 + 1 AS features FROM customer)"


@query(f"SELECT DISTINCT corridor FROM (SELECT *, coalesce(sum(features) OVER (PARTITION BY cell ORDER BY length_m DESC, trips DESC, corridor ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS b FROM {_CELLS}) WHERE b < 20 OR b = 0")
def cell_quota_topk(spark, d):
    c = _t(spark, d, "customer").select(F.col("c_nationkey").alias("cell"), F.col("c_custkey").alias("corridor"), F.floor("c_acctbal").alias("length_m"), (F.col("c_custkey") % 7).alias("trips"), (F.col("c_custkey") % 4 + 1).alias("features"), F.lit(20).alias("quota"))
    return corridors.select(c)


@query("SELECT cell, min(trips) AS floor FROM (SELECT cell, trips, sum(count(*)) OVER (PARTITION BY cell ORDER BY trips DESC) AS u, row_number() OVER (PARTITION BY cell ORDER BY trips DESC) AS k FROM (SELECT l_suppkey % 40 AS cell, CAST(l_quantity AS BIGINT) AS trips FROM lineitem) GROUP BY 1, 2) WHERE u <= 60 OR k = 1 GROUP BY 1")
def cell_histogram_floor(spark, d):
    rows = _t(spark, d, "lineitem").select((F.col("l_suppkey") % 40).alias("cell"), F.col("l_quantity").cast("long").alias("trips"))
    return coverage.floors(rows, 60)


@query(
    "WITH s AS (SELECT p_brand AS cell, CAST(count(*) AS DOUBLE) AS n FROM part GROUP BY 1), w AS (SELECT cell, n, pow(n, 0.5) AS w FROM s), c AS (SELECT *, (0.6 * (SELECT count(*) FROM part) - coalesce(sum(n) OVER (ORDER BY n / w, cell ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) / (sum(w) OVER () - coalesce(sum(w) OVER (ORDER BY n / w, cell ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) AS l FROM w), "
    "o AS (SELECT arg_min(l, (n / w, cell)) AS l FROM c WHERE l * w < n) SELECT c.cell, CAST(greatest(CASE WHEN c.l * c.w >= c.n THEN c.n ELSE least(floor(o.l * c.w), c.n) END, 1) AS BIGINT) AS quota FROM c, o"
)
def quota_filling(spark, d):
    p = _t(spark, d, "part")
    sizes = p.groupBy(F.col("p_brand").alias("cell")).agg(F.count("*").cast("double").alias("n"))
    return coverage.quotas(sizes, 0.6 * p.count(), 0.5)


@query(
    "WITH t AS (SELECT c_mktsegment AS zoom, c_nationkey AS cx, CAST(0 AS BIGINT) AS cy, count(*) AS n FROM customer GROUP BY 1, 2), r AS (SELECT *, row_number() OVER (PARTITION BY zoom ORDER BY n, cx, cy) - 1 AS k, count(*) OVER (PARTITION BY zoom) AS m FROM t), b AS (SELECT zoom, n, least(k // greatest(m // 4, 1), 3) AS band FROM r), "
    "q AS (SELECT zoom, band, n, row_number() OVER (PARTITION BY zoom, band ORDER BY n) - 1 AS j, count(*) OVER (PARTITION BY zoom, band) AS c FROM b) SELECT zoom, band, count(*) AS cells, max(n) FILTER (j = c // 2) AS median FROM q GROUP BY 1, 2"
)
def quartile_bands(spark, d):
    t = _t(spark, d, "customer").groupBy(F.col("c_mktsegment").alias("zoom"), F.col("c_nationkey").alias("cx"), F.lit(0).cast("long").alias("cy")).agg(F.count("*").alias("n"))
    return coverage.bands(t, ["zoom"])


@query("SELECT zoom, cells, median, most, total FROM (SELECT zoom, count(*) AS cells, max(b) FILTER (k = n // 2) AS median, max(b) AS most, CAST(sum(b) AS BIGINT) AS total FROM (SELECT zoom, b, row_number() OVER (PARTITION BY zoom ORDER BY b) - 1 AS k, count(*) OVER (PARTITION BY zoom) AS n FROM (SELECT p_size % 15 AS zoom, CAST(floor(p_retailprice) AS BIGINT) AS b FROM part)) GROUP BY 1)")
def tile_sizes(spark, d):
    return coverage.sizes(_t(spark, d, "part").select((F.col("p_size") % 15).alias("zoom"), F.floor("p_retailprice").alias("bytes")))


@query("WITH p AS (SELECT p_partkey % 12 AS zoom, round_even((p_partkey * 37 % 5000) / 128.0, 0)::BIGINT AS cx, round_even((p_partkey * 91 % 5000) / 128.0, 0)::BIGINT AS cy FROM part) SELECT zoom, cx, cy, count(*) AS n FROM p GROUP BY ALL")
def drawn_cells(spark, d):
    k = F.col("p_partkey")
    return coverage.drawn(_t(spark, d, "part").select((k % 12).alias("zoom"), (k * 37 % 5000).alias("x"), (k * 91 % 5000).alias("y")), 128.0)


@query("WITH s AS (SELECT p_partkey % 300 AS x, p_partkey * 7 % 200 AS y, p_size % 9 AS n, p_partkey AS rgb, p_size AS weight FROM part), q AS (SELECT x + unnest(range(n + 1)) AS px, y AS py, weight, rgb FROM s) SELECT CAST(px AS INTEGER) AS px, CAST(py AS INTEGER) AS py, arg_max(rgb, (weight, rgb)) AS rgb FROM q GROUP BY 1, 2")
def pixel_composite(spark, d):
    k = F.col("p_partkey")
    s = _t(spark, d, "part").select((k % 300).alias("x0"), (k * 7 % 200).alias("y0"), (k % 300 + F.col("p_size") % 9).alias("x1"), (k * 7 % 200).alias("y1"), F.col("p_size").alias("weight"), k.alias("rgb"))
    return coverage.pixels(s)


# -- rail, traces and snaps --------------------------------------------------------------------------------------------


@query("WITH r AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_returnflag, row_number() OVER (PARTITION BY l_orderkey ORDER BY CASE l_returnflag WHEN 'A' THEN 1 WHEN 'N' THEN 2 ELSE 3 END, l_linenumber, l_partkey, l_suppkey, l_extendedprice) AS k FROM lineitem) SELECT l_orderkey AS train_uid, l_returnflag AS stp, l_linenumber AS n FROM r WHERE k = 1 AND l_returnflag <> 'A'")
def stp_overlay(spark, d):
    rows = _t(spark, d, "lineitem").withColumn("stp", F.when(F.col("l_returnflag") == "A", "C").when(F.col("l_returnflag") == "N", "N").otherwise("P"))
    rows = rows.select(F.col("l_orderkey").alias("train_uid"), "stp", "l_returnflag", F.struct("l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice").alias("n"))
    rows = rows.withColumns({"runs_from": F.to_date(F.lit("2024-01-01")), "runs_to": F.to_date(F.lit("2024-12-31")), "days": F.lit("1111111")})
    from transitnet.sources import cif

    return cif.live(rows, "2024-04-15").select("train_uid", F.col("l_returnflag").alias("stp"), F.col("n.l_linenumber").alias("n"))


@query(_SEQ + " SELECT array_to_string(s, '>') AS calls, count(*) AS schedules, CAST(sum(trip_id % 7 + 1) AS BIGINT) AS trips FROM seq WHERE len(s) >= 2 GROUP BY 1")
def weekly_sequences(spark, d):
    from transitnet.sources import cif

    s = _trip_sequences(spark, d).select(F.transform("stop_seq", lambda x: F.struct(x.alias("tiploc"), F.lit(True).alias("public"))).alias("calls"), F.rpad(F.repeat(F.lit("1"), (F.col("trip_id") % 7 + 1).cast("int")), 7, "0").alias("days"))
    return cif.weekly_sequences(s).select(F.array_join("calls", ">").alias("calls"), "schedules", "trips")


_EV = "(SELECT user_id, list(event_type ORDER BY ts, event_id) AS s FROM events GROUP BY 1)"


@query(f"WITH u AS {_EV}, l AS (SELECT unnest(s[1:len(s) - 1]) AS a, unnest(s[2:]) AS b, user_id FROM u WHERE len(s) >= 2) SELECT a, b, count(*) AS legs, CAST(sum(user_id) AS BIGINT) AS trips FROM l GROUP BY 1, 2")
def leg_pairs(spark, d):
    s = patterns.sequences(_t(spark, d, "events"), "user_id", "event_type", ("ts", "event_id")).withColumnRenamed("stop_seq", "calls")
    return tracing.legs(s, "user_id").groupBy("a", "b").agg(F.count("*").alias("legs"), F.sum("user_id").alias("trips"))


@query(f"WITH u AS {_EV} SELECT user_id, array_to_string(list_transform(list_filter(range(1, len(s) + 1), lambda i: i = 1 OR s[i] <> s[i - 1]), lambda i: s[i]), ',') AS calls FROM u")
def consecutive_distinct(spark, d):
    s = patterns.sequences(_t(spark, d, "events"), "user_id", "event_type", ("ts", "event_id"))
    return s.select("user_id", F.array_join(arrays.consecutive_distinct(F.col("stop_seq")), ",").alias("calls"))


@query(f"WITH u AS {_EV} SELECT user_id, CAST(len(list_filter(range(1, len(s)), lambda i: s[i] = 'click' AND s[i + 1] = 'view')) AS BIGINT) AS n FROM u")
def subsequence_fit(spark, d):
    s = patterns.sequences(_t(spark, d, "events"), "user_id", "event_type", ("ts", "event_id"))
    return s.select("user_id", F.size(arrays.occurrences(F.col("stop_seq"), F.array(F.lit("click"), F.lit("view")))).cast("long").alias("n"))


@query("SELECT l_orderkey AS sequence, count(*) AS calls FROM lineitem LEFT JOIN (SELECT s_suppkey, 1 AS k FROM supplier WHERE s_suppkey % 5 <> 0) ON s_suppkey = l_suppkey GROUP BY 1 HAVING bool_and(k IS NOT NULL)")
def all_or_nothing(spark, d):
    s = _t(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("sequence")).agg(F.collect_list(F.col("l_suppkey").cast("string")).alias("calls"))
    stations = _t(spark, d, "supplier").where("s_suppkey % 5 <> 0").select(F.col("s_suppkey").cast("string").alias("tiploc"))
    return tracing.resolved_sequences(s, stations).select("sequence", F.size("calls").cast("long").alias("calls"))


@query(
    "WITH p AS (SELECT s_suppkey AS p, s_suppkey * 977 % 4000 AS x, s_suppkey * 389 % 4000 AS y FROM supplier), t AS (SELECT p_partkey AS t, p_partkey * 613 % 4000 AS x, p_partkey * 257 % 4000 AS y FROM part), "
    "j AS (SELECT p, t, (p.x - t.x) * (p.x - t.x) + (p.y - t.y) * (p.y - t.y) AS d2 FROM p JOIN t ON abs(p.x - t.x) <= 250 AND abs(p.y - t.y) <= 250) SELECT p, arg_min(t, (d2, t)) AS t, min(d2) AS d2 FROM j WHERE d2 <= 62500 GROUP BY 1"
)
def grid_nearest(spark, d):
    s, p = F.col("s_suppkey"), F.col("p_partkey")
    return tracing.nearest_within(_t(spark, d, "supplier").select(s.alias("p"), (s * 977 % 4000).alias("x"), (s * 389 % 4000).alias("y")), _t(spark, d, "part").select(p.alias("t"), (p * 613 % 4000).alias("x"), (p * 257 % 4000).alias("y")), 250)


@query("SELECT l_orderkey AS pattern_id, arg_min(l_returnflag, (CASE l_returnflag WHEN 'A' THEN 1 WHEN 'N' THEN 2 ELSE 3 END, l_quantity, l_extendedprice, l_partkey)) AS reason FROM lineitem GROUP BY 1")
def resolve_ladder(spark, d):
    reason = F.when(F.col("l_returnflag") == "A", "ok").when(F.col("l_returnflag") == "N", "not_monotonic").otherwise("off_track")
    rows = _t(spark, d, "lineitem").select(F.col("l_orderkey").alias("pattern_id"), F.col("l_partkey").alias("relation_id"), reason.alias("reason"), F.col("l_quantity").alias("worst_stop_m"), F.col("l_extendedprice").alias("length_m"), "l_returnflag")
    return tracing.resolve(rows).select("pattern_id", F.col("l_returnflag").alias("reason"))


# -- text, scales and events -------------------------------------------------------------------------------------------


@query(
    "WITH n AS (SELECT p_partkey, p_name || [' Station', ' (Main) Rail Station', ', Platform 2', ' & Halt', ''][p_partkey % 5 + 1] AS name FROM part), "
    "a AS (SELECT p_partkey, trim(regexp_replace(replace(regexp_replace(replace(lower(name), '''', ''), '[.,()\\-/]', ' ', 'g'), '&', ' and '), '\\s+', ' ', 'g')) AS s FROM n), b AS (SELECT p_partkey, CASE WHEN length(trim(regexp_replace(s, '{q}', ''))) > 0 THEN trim(regexp_replace(s, '{q}', '')) ELSE s END AS s FROM a), "
    "c AS (SELECT p_partkey, CASE WHEN length(trim(regexp_replace(s, '{q}', ''))) > 0 THEN trim(regexp_replace(s, '{q}', '')) ELSE s END AS s FROM b), e AS (SELECT p_partkey, CASE WHEN length(trim(regexp_replace(s, '{q}', ''))) > 0 THEN trim(regexp_replace(s, '{q}', '')) ELSE s END AS s FROM c) "
    "SELECT p_partkey, CASE WHEN length(trim(regexp_replace(s, '{q}', ''))) > 0 THEN trim(regexp_replace(s, '{q}', '')) ELSE s END AS name FROM e",
    q="\\s*\\b(" + "|".join(text.QUALIFIERS) + ")\\s*$",
)
def name_normalise(spark, d):
    k = F.col("p_partkey")
    tail = F.element_at(F.array(*map(F.lit, (" Station", " (Main) Rail Station", ", Platform 2", " & Halt", ""))), (k % 5 + 1).cast("int"))
    return _t(spark, d, "part").select("p_partkey", text.normalise(F.concat("p_name", tail)).alias("name"))


@query("SELECT n_nationkey, trim(regexp_replace(strip_accents(lower(n_name || ' Éireann/Öst-' || CAST(n_nationkey AS VARCHAR))), '[^a-z0-9]+', ' ', 'g')) AS key FROM nation")
def operator_keys(spark, d):
    return _t(spark, d, "nation").select("n_nationkey", text.operator_key(F.concat("n_name", F.lit(" Éireann/Öst-"), F.col("n_nationkey").cast("string"))).alias("key"))


@query("SELECT c_custkey, c_mktsegment, CASE WHEN len(list_filter(k, lambda x: x IN ('building', 'machinery', 'household'))) = 0 THEN true ELSE list_filter(k, lambda x: x IN ('building', 'machinery', 'household'))[1] IN ('building', 'machinery') END AS ours FROM (SELECT c_custkey, c_mktsegment, [lower(c_mktsegment), CASE WHEN c_custkey % 2 = 0 THEN 'household' ELSE 'machinery' END] AS k FROM customer)")
def ownership(spark, d):
    tag = F.concat("c_mktsegment", F.when(F.col("c_custkey") % 2 == 0, "; Household").otherwise("/Machinery"))
    return _t(spark, d, "customer").select("c_custkey", "c_mktsegment", text.claimed(tag, ["building", "machinery"], ["household"]).alias("ours"))


@query("SELECT o_orderkey, round(CASE WHEN 400000.0 <= 1000.0 THEN 0.5 ELSE least(greatest((ln(1 + o_totalprice) - ln(1 + 1000.0)) / (ln(1 + 400000.0) - ln(1 + 1000.0)), 0), 1) END, 9) AS weight, round(least(greatest((log10(greatest(o_totalprice / 700.0, 3.0)) - log10(3.0)) / (3 - log10(3.0)), 0), 1), 9) AS position FROM orders")
def ramp_positions(spark, d):
    return _t(spark, d, "orders").select("o_orderkey", F.round(scale.scaled(F.col("o_totalprice"), F.lit(1000.0), F.lit(400000.0)), 9).alias("weight"), F.round(scale.ramp_position(F.col("o_totalprice") / 700.0), 9).alias("position"))


@query("SELECT o_orderkey, coalesce(nullif(trim(CASE WHEN o_orderkey % 3 = 0 THEN '  ' ELSE o_orderstatus END), ''), CAST(o_orderkey AS VARCHAR)) AS name FROM orders")
def display_names(spark, d):
    return _t(spark, d, "orders").select("o_orderkey", text.display_name(F.when(F.col("o_orderkey") % 3 == 0, "  ").otherwise(F.col("o_orderstatus")), F.col("o_orderkey").cast("string")).alias("name"))


@query("SELECT o_orderkey, lpad(CAST(s // 3600 AS VARCHAR), 2, '0') || ':' || lpad(CAST(s // 60 % 60 AS VARCHAR), 2, '0') || ':' || lpad(CAST(s % 60 AS VARCHAR), 2, '0') AS clock, s AS seconds FROM (SELECT o_orderkey, o_orderkey * 37 % 100000 AS s FROM orders)")
def clock_round_trip(spark, d):
    from transitnet.functions import times

    o = _t(spark, d, "orders").select("o_orderkey", times.hhmmss(F.col("o_orderkey") * 37 % 100000).alias("clock"))
    return o.select("o_orderkey", "clock", times.clock_seconds(F.col("clock")).cast("long").alias("seconds"))


_US = "epoch_us(ts)"


@query(f"SELECT event_type, ({_US} // 3600000000) * 3600000000 AS start_us, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY 1, 2")
def events_tumbling(spark, d):
    e = _t(spark, d, "events").withColumn("at", F.col("ts").cast("timestamp"))
    out = e.groupBy(F.window("at", "1 hour"), "event_type").agg(F.count("*").alias("n"), F.round(F.sum("value"), 4).alias("total"))
    return out.select("event_type", F.unix_micros("window.start").alias("start_us"), "n", "total")


@query(f"SELECT user_id, {_US.replace('ts', 'min(ts)')} AS start_us, count(*) AS n FROM (SELECT user_id, ts, sum(b) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS s FROM (SELECT user_id, event_id, ts, CASE WHEN {_US} - lag({_US}) OVER (PARTITION BY user_id ORDER BY ts, event_id) < 21600000000 THEN 0 ELSE 1 END AS b FROM events)) GROUP BY user_id, s")
def events_session(spark, d):
    e = _t(spark, d, "events").withColumn("at", F.col("ts").cast("timestamp"))
    out = e.groupBy(F.session_window("at", "6 hours"), "user_id").agg(F.count("*").alias("n"), F.min("at").alias("first"))
    return out.select("user_id", F.unix_micros("first").alias("start_us"), "n")


# -- stores, joins and readers -----------------------------------------------------------------------------------------


@query("SELECT o_orderkey AS trip_id, coalesce(CASE WHEN c_custkey % 4 = 0 THEN NULL ELSE CAST(c_custkey % 7 AS INTEGER) END, 5) AS days, CASE WHEN n_nationkey = 2 THEN 'rail' WHEN n_nationkey IN (3, 11) THEN 'bus' ELSE NULL END AS mode FROM orders LEFT JOIN customer ON c_custkey = o_custkey LEFT JOIN (SELECT n_nationkey, c_custkey AS k FROM customer JOIN nation ON n_nationkey = c_nationkey) n ON n.k = o_custkey")
def trips_with_defaults(spark, d):
    c = _t(spark, d, "customer")
    trips = _t(spark, d, "orders").select(F.col("o_orderkey").alias("trip_id"), F.col("o_custkey").alias("service_id"), F.col("o_custkey").alias("route_id"))
    calendar = c.where("c_custkey % 4 <> 0").select(F.col("c_custkey").alias("service_id"), (F.col("c_custkey") % 7).cast("int").alias("days"))
    routes = c.select(F.col("c_custkey").alias("route_id"), F.col("c_nationkey").cast("string").alias("route_type"))
    out = patterns.trip_rows(trips, calendar, routes)
    return out.select("trip_id", "days", F.when(F.col("mode").isin("rail", "bus"), F.col("mode")).alias("mode"))


@query(
    "WITH p AS (SELECT user_id, list({'t': epoch_us(ts), 'e': event_id, 'v': CAST(round_even(value * 1000000, 0) AS BIGINT)} ORDER BY epoch_us(ts), event_id) AS l FROM events WHERE user_id IN (SELECT c_custkey FROM customer WHERE c_nationkey < 12) GROUP BY 1) "
    "SELECT user_id AS shape_id, CAST(len(l) AS INTEGER) AS points, CAST(l[1].v AS BIGINT) AS first_e6, CAST(l[-1].v AS BIGINT) AS last_e6 FROM p"
)
def shape_lists(spark, d):
    e = _t(spark, d, "events").select(F.col("user_id").alias("shape_id"), (F.col("value") * 0).alias("lat"), F.col("value").alias("lon"), F.struct(F.unix_micros(F.col("ts").cast("timestamp")).alias("t"), "event_id").alias("seq"))
    used = _t(spark, d, "customer").where("c_nationkey < 12").select(F.col("c_custkey").alias("shape_id"))
    out = patterns.shapes_of(e, used)
    return out.select("shape_id", F.size("lon_e6").alias("points"), F.get("lon_e6", 0).cast("long").alias("first_e6"), F.element_at("lon_e6", -1).cast("long").alias("last_e6"))


@query("SELECT p_partkey AS shape_id FROM part WHERE p_partkey NOT IN (SELECT l_partkey FROM lineitem WHERE l_quantity < 10) IS FALSE")
def pruned_shapes(spark, d):
    from transitnet.operators import maintenance

    shapes = _t(spark, d, "part").select(F.col("p_partkey").alias("shape_id"))
    used = _t(spark, d, "lineitem").select(F.when(F.col("l_quantity") < 10, F.col("l_partkey")).alias("shape_id"))
    return maintenance.unreferenced_shapes(shapes, used, 0)


@query("SELECT s_suppkey AS way_id FROM supplier WHERE EXISTS (SELECT 1 FROM lineitem WHERE l_suppkey = s_suppkey)")
def pruned_ways(spark, d):
    from transitnet.operators import maintenance

    traces = _t(spark, d, "lineitem").groupBy("l_orderkey").agg(F.collect_set("l_suppkey").alias("way_ids"))
    return maintenance.referenced_ways(_t(spark, d, "supplier").select(F.col("s_suppkey").alias("way_id")), traces)


@query(
    "WITH p AS (SELECT o_orderkey AS id, CASE WHEN o_orderkey % 3 = 0 THEN o_custkey END AS sh, CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE o_orderkey % 5 = 1 END AS cut, o_orderkey % 7 < 5 AS traced FROM orders) "
    "SELECT id AS pattern_id, CASE WHEN sh IN (SELECT c_custkey FROM customer WHERE c_custkey % 2 = 0) THEN 'shape' ELSE 'trace' END AS arm FROM p WHERE NOT (traced AND coalesce(cut, false)) AND (sh IN (SELECT c_custkey FROM customer WHERE c_custkey % 2 = 0) OR traced)"
)
def segment_arms(spark, d):
    k = F.col("o_orderkey")
    p = _t(spark, d, "orders").select(k.alias("pattern_id"), F.lit("rail").alias("mode"), F.when(k % 3 == 0, F.col("o_custkey").cast("string")).alias("shape_id"))
    line = {c: F.array(F.lit(v), F.lit(v + 1)) for c, v in (("lon_e6", 1), ("lat_e6", 5))}
    shapes = _t(spark, d, "customer").where("c_custkey % 2 = 0").select(F.col("c_custkey").cast("string").alias("shape_id")).withColumns(line)
    traces = _t(spark, d, "orders").where(k % 7 < 5).select(k.alias("pattern_id"), F.when(k % 5 != 0, k % 5 == 1).alias("ways_cut")).withColumns({c: F.transform(v, lambda x: x + 100) for c, v in line.items()})
    return aggregate.segments(p, shapes, traces, F.lit(True)).select("pattern_id", F.when(F.col("min_lon_e6") < 100, "shape").otherwise("trace").alias("arm"))


@query("SELECT p_partkey AS pattern_id FROM part WHERE p_partkey % 3 = 0 AND p_size % 2 = 0 AND p_partkey % 5 <> 0")
def gained_shapes(spark, d):
    k = F.col("p_partkey")
    before = _t(spark, d, "part").where(k % 3 == 0).select(k.alias("pattern_id"), F.lit(None).cast("string").alias("shape_id"))
    now = _t(spark, d, "part").select(k.alias("pattern_id"), F.when(F.col("p_size") % 2 == 0, "S").alias("shape_id"))
    status = _t(spark, d, "part").select(k.alias("pattern_id"), F.when(k % 5 != 0, "stops").otherwise("shape").alias("source"))
    return patterns.gained_shapes(before, now, status)


@query("SELECT o_orderstatus AS status, count(*) AS items, round(avg(o_totalprice), 4) AS mean_worst_m, max(o_totalprice) AS worst_m, round(sum(o_custkey) / 1000.0, 4) AS km FROM orders GROUP BY 1")
def status_summary(spark, d):
    out = work.summary(_t(spark, d, "orders").withColumnRenamed("o_orderstatus", "status"), "o_custkey", "o_totalprice")
    return out.select("status", "items", F.round("mean_worst_m", 4).alias("mean_worst_m"), "worst_m", F.round("km", 4).alias("km"))


@query("SELECT l_suppkey AS from_id, l_linenumber AS to_id, arg_min(l_partkey, (CAST(l_quantity AS INTEGER), l_partkey)) AS best FROM lineitem GROUP BY 1, 2")
def shortest_variant(spark, d):
    from transitnet.sources import txc

    rows = _t(spark, d, "lineitem").select(F.col("l_suppkey").alias("from_id"), F.col("l_linenumber").alias("to_id"), F.array_repeat(F.col("l_partkey"), F.col("l_quantity").cast("int")).alias("points"))
    return txc.hop_geometry(rows).select("from_id", "to_id", F.get("points", 0).alias("best"))


@query("SELECT o_custkey AS key, arg_max(o_orderpriority, o_orderkey) AS atco FROM orders GROUP BY 1")
def last_writer_wins(spark, d):
    from transitnet.sources import txc

    return txc.crosswalk(_t(spark, d, "orders").select(F.col("o_custkey").alias("key"), F.col("o_orderpriority").alias("atco"), F.col("o_orderkey").alias("ordinal")))


@query("SELECT '9100' || CAST(c_nationkey AS VARCHAR) AS atco, arg_min(c_name, c_custkey) AS name FROM customer WHERE c_mktsegment <> 'BUILDING' GROUP BY 1")
def station_register(spark, d):
    from transitnet.sources import naptan

    rows = _t(spark, d, "customer").select(
        F.concat(F.lit("9100"), F.col("c_nationkey").cast("string")).alias("ATCOCode"), F.col("c_name").alias("CommonName"), F.lit("51.5").alias("Latitude"), F.lit("-3.2").alias("Longitude"),
        F.when(F.col("c_mktsegment") == "BUILDING", "BCT").otherwise("RLY").alias("StopType"), F.lit("Active ").alias("Status"), F.col("c_custkey").alias("n"),
    )
    return naptan.stations(rows).select("atco", "name")


@query("SELECT o_orderkey, CAST(o_orderkey % 3 * 86400 + o_orderkey % 24 * 3600 + o_orderkey % 60 * 60 + o_orderkey % 59 AS INTEGER) AS seconds, make_date(CASE WHEN o_orderkey % 100 < 60 THEN 2000 ELSE 1900 END + o_orderkey % 100, o_orderkey % 12 + 1, o_orderkey % 28 + 1) AS day FROM orders")
def feed_times(spark, d):
    from transitnet.functions import times

    k = F.col("o_orderkey")
    two = lambda c: F.lpad(c.cast("string"), 2, "0")
    iso = F.concat(F.lit("P"), (k % 3).cast("string"), F.lit("DT"), (k % 24).cast("string"), F.lit("H"), (k % 60).cast("string"), F.lit("M"), (k % 59).cast("string"), F.lit("S"))
    return _t(spark, d, "orders").select("o_orderkey", times.iso_seconds(iso).alias("seconds"), times.cif_date(F.concat(two(k % 100), two(k % 12 + 1), two(k % 28 + 1))).alias("day"))


@query("SELECT l_orderkey, CAST(len(x) AS INTEGER) AS n, x[1] AS first, x[-1] AS last FROM (SELECT l_orderkey, list_transform(list_filter(range(0, c), lambda i: c <= 4 OR i % greatest(CAST(ceil(c / 3.0) AS BIGINT), 1) = 0 OR i = c - 1), lambda i: i) AS x FROM (SELECT l_orderkey, count(*) AS c FROM lineitem GROUP BY 1))")
def thinned_points(spark, d):
    rows = _t(spark, d, "lineitem").groupBy("l_orderkey").agg(F.count("*").alias("c")).select("l_orderkey", arrays.thinned(F.sequence(F.lit(0).cast("long"), F.col("c") - 1), 4).alias("x"))
    return rows.select("l_orderkey", F.size("x").alias("n"), F.get("x", 0).alias("first"), F.element_at("x", -1).alias("last"))


@query("SELECT o_orderkey AS id, coalesce(CASE WHEN o_orderkey % 4 = 1 THEN 'new' END, 'old') AS v FROM orders WHERE o_orderkey % 2 = 0 OR o_orderkey % 4 = 1")
def bulk_insert_replace(spark, d):
    from transitnet.store import upsert

    k = F.col("o_orderkey")
    old = _t(spark, d, "orders").where((k % 2 == 0) | (k % 8 == 1)).select(k.alias("id"), F.lit("old").alias("v"))
    return upsert(old, _t(spark, d, "orders").where(k % 4 == 1).select(k.alias("id"), F.lit("new").alias("v")), ["id"], "replace")


@query("SELECT o_orderkey AS id, CASE WHEN o_orderkey % 2 = 0 THEN 'old' ELSE 'new' END AS v FROM orders WHERE o_orderkey % 2 = 0 OR o_orderkey % 3 = 0")
def bulk_insert_ignore(spark, d):
    from transitnet.store import upsert

    k = F.col("o_orderkey")
    pick = lambda c, v: _t(spark, d, "orders").where(c).select(k.alias("id"), F.lit(v).alias("v"))
    return upsert(pick(k % 2 == 0, "old"), pick(k % 3 == 0, "new"), ["id"], "ignore")


@query("SELECT band, count(*) AS lines, CAST(sum(trips) AS BIGINT) AS trips FROM (SELECT o_custkey AS k, count(*) * 12 AS trips FROM orders GROUP BY 1), (VALUES ('far', 200), ('middle', 20), ('near', 1), ('detail', 0)) b(band, least) WHERE trips >= least GROUP BY 1")
def zoom_bands(spark, d):
    lines = _t(spark, d, "orders").groupBy("o_custkey").agg((F.count("*") * 12).alias("trips"))
    return publish.banded(lines).groupBy("band").agg(F.count("*").alias("lines"), F.sum("trips").alias("trips"))


@query(
    "WITH r AS (SELECT l_suppkey % 40 AS cell, CAST(l_quantity AS BIGINT) AS trips FROM lineitem), f AS (SELECT cell, min(trips) AS floor FROM (SELECT cell, trips, sum(count(*)) OVER (PARTITION BY cell ORDER BY trips DESC) AS u, row_number() OVER (PARTITION BY cell ORDER BY trips DESC) AS k FROM r GROUP BY 1, 2) WHERE u <= 60 OR k = 1 GROUP BY 1) "
    "SELECT cell, count(*) AS kept FROM r JOIN f USING (cell) WHERE trips >= floor GROUP BY 1"
)
def overview_hold_back(spark, d):
    rows = _t(spark, d, "lineitem").select((F.col("l_suppkey") % 40).alias("cell"), F.col("l_quantity").cast("long").alias("trips"))
    return coverage.hold_back(rows, coverage.floors(rows, 60)).groupBy("cell").agg(F.count("*").alias("kept"))


@query("SELECT way_id, CAST(sum(trips) AS BIGINT) AS n_trips FROM (SELECT l_suppkey % 9 AS a, l_suppkey % 9 + 1 AS b, count(*) AS trips FROM lineitem GROUP BY 1, 2) JOIN (SELECT s_suppkey AS way_id, CAST(s_suppkey % 12 AS DOUBLE) AS f, CAST(s_suppkey % 12 + 1.5 AS DOUBLE) AS t FROM supplier) ON f < b AND t > a GROUP BY 1")
def attributed_way_trips(spark, d):
    legs = _t(spark, d, "lineitem").groupBy((F.col("l_suppkey") % 9).alias("a")).agg(F.count("*").alias("trips")).withColumn("b", F.col("a") + 1)
    placed = legs.select("a", "b", F.lit(1).alias("relation_id"), F.col("a").cast("double").alias("low"), F.col("b").cast("double").alias("high"))
    k = F.col("s_suppkey")
    ways = _t(spark, d, "supplier").select(F.lit(1).alias("relation_id"), k.alias("way_id"), (k % 12).cast("double").alias("from_m"), (k % 12 + 1.5).cast("double").alias("to_m"))
    return tracing.way_trips(legs, placed, ways)


@query(
    "SELECT CAST(c_custkey AS BIGINT) AS relation_id, CASE WHEN c_mktsegment = 'FURNITURE' THEN 'other route' WHEN c_nationkey = 3 THEN 'another region''s' WHEN c_custkey % 5 = 0 THEN 'too few stops' WHEN c_custkey % 7 = 0 THEN 'broken' ELSE 'kept' END AS reason FROM customer"
)
def relation_sift(spark, d):
    k = F.col("c_custkey")
    rel = _t(spark, d, "customer").select(
        k.alias("relation_id"), F.col("c_mktsegment").alias("route"), F.create_map(F.lit("operator"), F.when(F.col("c_nationkey") == 3, "Theirs; Ours").otherwise("Ours/Theirs")).alias("tags"), F.when(k % 5 == 0, F.array(F.lit(1))).otherwise(F.array(F.lit(1), F.lit(2))).alias("stops")
    )
    paths = _t(spark, d, "customer").select(k.alias("relation_id"), F.when(k % 7 == 0, 1).otherwise(0).alias("breaks"), F.lit(1.0).alias("span_m"))
    return tracing.sift(rel, paths, ["AUTOMOBILE", "BUILDING", "HOUSEHOLD", "MACHINERY"], ["ours"], ["theirs"]).select("relation_id", "reason")


@query(f"SELECT user_id, s_us AS start_us, count(*) AS n FROM (SELECT user_id, unnest([({_US} // 3600000000) * 3600000000, ({_US} // 3600000000) * 3600000000 - CASE WHEN {_US} % 3600000000 < 3600000000 THEN 3600000000 ELSE 0 END]) AS s_us FROM events) GROUP BY 1, 2")
def events_sliding(spark, d):
    e = _t(spark, d, "events").withColumn("at", F.col("ts").cast("timestamp"))
    return e.groupBy(F.window("at", "2 hours", "1 hour"), "user_id").agg(F.count("*").alias("n")).select("user_id", F.unix_micros("window.start").alias("start_us"), "n")


# -- graph and geometry operators ----------------------------------------------------------------------------


def _streets(spark, d):
    """Parts as streets of a lattice."""
    k = F.col("p_partkey")
    x, y = k % 40, F.floor(k / 40) % 40
    e6 = lambda v: (v * 1000).cast("int")
    lon = F.when(k % 2 == 0, F.array(e6(x), e6(x + 1))).otherwise(F.array(e6(x), e6(x)))
    lat = F.when(k % 2 == 0, F.array(e6(y), e6(y))).otherwise(F.array(e6(y), e6(y + 1)))
    return _t(spark, d, "part").select(k.alias("id"), k.alias("edge_id"), lon.alias("lon_e6"), lat.alias("lat_e6"), F.col("p_brand").alias("name"))


@query(
    "WITH s AS (SELECT p_partkey AS k, (p_partkey % 40) * 100.0 AS ax, (p_partkey // 40 % 40) * 100.0 AS ay, (p_partkey % 40 + CAST(p_partkey % 2 = 0 AS INTEGER)) * 100.0 AS bx, (p_partkey // 40 % 40 + CAST(p_partkey % 2 <> 0 AS INTEGER)) * 100.0 AS ey FROM part), "
    "v AS (SELECT k, 0 AS j, ax AS x, ay + 5 AS y FROM s UNION ALL SELECT k, 1, bx, ey + 5 FROM s), "
    "t AS (SELECT v.k, j, w.k AS way, x, y, ax, ay, bx - ax AS dx, ey - ay AS dy, least(greatest(((x - ax) * (bx - ax) + (y - ay) * (ey - ay)) / ((bx - ax) * (bx - ax) + (ey - ay) * (ey - ay)), 0.0), 1.0) AS t FROM v JOIN s w ON abs(x - ax) <= 130 AND abs(y - ay) <= 130), "
    "n AS (SELECT k, j, way, sqrt(pow(x - ax - t * dx, 2) + pow(y - ay - t * dy, 2)) AS g FROM t WHERE sqrt(pow(x - ax - t * dx, 2) + pow(y - ay - t * dy, 2)) <= 25), "
    "b AS (SELECT k, j, arg_min(way, (g, way)) AS way, min(g) AS g FROM n GROUP BY 1, 2), "
    "p AS (SELECT s.k, b0.way AS w0, CASE WHEN b0.way IS NOT NULL AND n1.g <= b1.g + 3 THEN b0.way ELSE b1.way END AS w1 FROM s LEFT JOIN b b0 ON b0.k = s.k AND b0.j = 0 LEFT JOIN b b1 ON b1.k = s.k AND b1.j = 1 LEFT JOIN n n1 ON n1.k = s.k AND n1.j = 1 AND n1.way = b0.way) "
    "SELECT k AS pattern_id, CASE WHEN w1 IS NULL THEN 'uncovered' ELSE 'ok' END AS status, CASE WHEN w1 IS NULL THEN '' WHEN w0 IS NULL OR w0 = w1 THEN CAST(w1 AS VARCHAR) ELSE CAST(w0 AS VARCHAR) || ',' || CAST(w1 AS VARCHAR) END AS ways, CASE WHEN w1 IS NULL THEN 0.0 ELSE 1.0 END AS covered FROM p"
)
def snapped_polylines(spark, d):
    s = _streets(spark, d)
    vertices = s.select(F.col("name").alias("n"), F.col("id").alias("pattern_id"), F.posexplode(F.arrays_zip("lon_e6", "lat_e6")).alias("seq", "p"))
    vertices = vertices.select("pattern_id", "seq", (F.col("p.lon_e6") / 10.0).alias("x"), (F.col("p.lat_e6") / 10.0 + 5).alias("y"))
    ways = s.select(F.col("id").alias("way_id"), *((F.get(c, k) / 10.0).alias(n) for n, c, k in (("ax", "lon_e6", 0), ("ay", "lat_e6", 0), ("bx", "lon_e6", 1), ("by", "lat_e6", 1))))
    out = tracing.snapped(vertices, ways)
    return out.select("pattern_id", "status", F.array_join("way_ids", ",").alias("ways"), F.round("covered", 6).alias("covered"))
