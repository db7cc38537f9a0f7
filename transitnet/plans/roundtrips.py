"""More registered queries: files written from the driver's tables and read back by each source, and operators on made-up lines.

Files go to the folder of checkpoints, which all executors share. Results are held against SQL over the tables that they were made of.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from transitnet.functions import arrays, geo, ids, text
from transitnet.operators import aggregate, chains, corridors, graph, match, network, patterns, publish, tracing, work
from transitnet.plans.catalog import _HAV, _ID, _LINKS, _PTS, _NET, _network, _points, _streets, _t, query
from transitnet.sources import cif, geojsonl, gtfs, mapinfo, osm, synthetic, txc
from transitnet.store import Store


def _folder(spark: SparkSession) -> str:
    return f"{graph.shared_folder(spark)}/files-{uuid.uuid4().hex[:12]}"


def _one_file(lines: DataFrame, order: list, path: str) -> str:
    """Lines in their order in one file, as a feed delivers them."""
    lines.coalesce(1).sortWithinPartitions(*order).select("value").write.text(path)
    return path


# -- timetable sources ---------------------------------------------------------------------------------------------------


@query("SELECT CAST(c_custkey AS VARCHAR) AS stop_id, c_name AS name, CASE WHEN c_custkey % 7 = 1 THEN 51.25 ELSE 52.5 END AS lat, -3.0 AS lon FROM customer WHERE c_custkey % 5 <> 0 AND c_custkey % 7 <> 0")
def gtfs_stops(spark, d):
    """Stops without a latitude, or at 0, are left out; ids stay text."""
    k, to = F.col("c_custkey"), _folder(spark)
    lat = F.when(k % 5 == 0, "0").when(k % 7 == 0, "").when(k % 7 == 1, "51.25").otherwise("52.5")
    _t(spark, d, "customer").select(k.alias("stop_id"), F.col("c_name").alias("stop_name"), F.lit("-3.0").alias("stop_lon"), lat.alias("stop_lat")).write.csv(f"{to}/stops.txt", header=True)
    for name, column in (("routes", "route_id"), ("calendar", "service_id"), ("trips", "trip_id"), ("stop_times", "trip_id")):
        spark.createDataFrame([("x",)], f"{column} string").write.csv(f"{to}/{name}.txt", header=True)
    return gtfs.load(spark, to)["stops"]


@query(
    "SELECT CAST(o_orderkey AS VARCHAR) AS trip_id, CAST(o_custkey % 9 AS VARCHAR) AS route_id, CAST(o_custkey % 2 AS INTEGER) AS direction, CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE o_orderstatus END AS shape_id, "
    "CASE WHEN o_custkey % 9 = 4 THEN NULL ELSE CAST(o_custkey % 9 AS VARCHAR) END AS route_type, CAST(1 + o_orderkey % 7 AS INTEGER) AS days FROM orders"
)
def gtfs_trips(spark, d):
    """Trips with their route's type (blank is null) and their service's days."""
    to, o = _folder(spark), _t(spark, d, "orders")
    k = F.col("o_orderkey")
    o.select((F.col("o_custkey") % 9).alias("route_id"), (k % 7).alias("service_id"), k.alias("trip_id"), (F.col("o_custkey") % 2).alias("direction_id"), F.when(k % 3 == 0, " ").otherwise(F.col("o_orderstatus")).alias("shape_id")).write.csv(f"{to}/trips.txt", header=True)
    spark.range(9).select(F.col("id").alias("route_id"), F.when(F.col("id") != 4, F.col("id").cast("string")).otherwise("").alias("route_type")).write.csv(f"{to}/routes.txt", header=True)
    days = ["monday", "tuesday", "wednesday", "thursday", "friday", "saturday", "sunday"]
    spark.range(7).select(F.col("id").alias("service_id"), *((F.col("id") >= n).cast("int").alias(c) for n, c in enumerate(days))).write.csv(f"{to}/calendar.txt", header=True)
    for name, column in (("stops", "stop_id"), ("stop_times", "trip_id")):
        spark.createDataFrame([("x",)], f"{column} string").write.csv(f"{to}/{name}.txt", header=True)
    feed = gtfs.load(spark, to)
    rows = feed["trips"].join(feed["routes"].select("route_id", "route_type"), "route_id").join(feed["calendar"], "service_id")
    return rows.select("trip_id", "route_id", "direction", "shape_id", "route_type", F.col("days").cast("int").alias("days"))


@query("SELECT strftime(min(o_orderdate), '%Y%m%d') || '-0123abcd' AS version FROM orders")
def feed_info_version(spark, d):
    """A GUID says nothing of a feed's age; its start date goes before it."""
    to = _folder(spark)
    info = _t(spark, d, "orders").agg(F.date_format(F.min("o_orderdate"), "yyyyMMdd").alias("feed_start_date")).select(F.lit('A, "quoted" name').alias("feed_publisher_name"), "feed_start_date", F.lit("0123abcd-0000-1111-2222-333344445555").alias("feed_version"))
    info.write.csv(f"{to}/feed_info.txt", header=True, escape='"')
    return spark.createDataFrame([(gtfs.feed_version(spark, to),)], "version string")


def _cards(spark, d) -> DataFrame:
    """Orders of two lines or more as trains of an extract, each card a line of 80."""
    rows = _t(spark, d, "lineitem").select(F.col("l_orderkey").alias("k"), "l_linenumber", "l_partkey", "l_extendedprice", F.col("l_suppkey").alias("s"))
    place = Window.partitionBy("k").orderBy("l_linenumber", "l_partkey", "s", "l_extendedprice")
    rows = rows.withColumns({"p": F.row_number().over(place), "n": F.count("*").over(Window.partitionBy("k"))}).where("n >= 2")
    pad = lambda c, n: F.rpad(c.cast("string"), n, " ")
    uid = F.lpad((F.col("k") % 1_000_000).cast("string"), 6, "0")
    head = rows.where("p = 1").select("k", F.lit(0).alias("p"), pad(F.concat(F.lit("BSN"), uid, F.lit("240101241231"), F.when(F.col("k") % 2 == 0, "1111100").otherwise("0000011"), F.lit(" POO"), F.lit(" " * 47), F.lit("P")), 80).alias("value"))
    tiploc = pad(F.concat(F.lit("S"), F.col("s").cast("string")), 7)
    first, last = F.concat(F.lit("LO"), tiploc, F.lit(" " * 6 + "0800")), F.concat(F.lit("LT"), tiploc, F.lit(" " * 6 + "0900"))
    inner = F.concat(F.lit("LI"), tiploc, F.lit(" " * 16), F.when(F.col("s") % 3 == 0, "00000000").otherwise("00000815"))
    calls = rows.select("k", "p", pad(F.when(F.col("p") == 1, first).when(F.col("p") == F.col("n"), last).otherwise(inner), 80).alias("value"))
    ends = spark.createDataFrame([(-1, 0, "HD".ljust(80)), (1 << 60, 0, "ZZ".ljust(80))], "k long, p int, value string")
    return head.unionByName(calls).unionByName(ends)


_CIF_SQL = """WITH r AS (SELECT l_orderkey AS k, l_suppkey AS s, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice) AS p, count(*) OVER (PARTITION BY l_orderkey) AS n FROM lineitem),
c AS (SELECT k, 'S' || CAST(s AS VARCHAR) AS tiploc, p FROM r WHERE n >= 2 AND (p = 1 OR p = n OR s % 3 <> 0))"""


@query(_CIF_SQL + " SELECT lpad(CAST(k % 1000000 AS VARCHAR), 6, '0') AS train_uid, CASE WHEN k % 2 = 0 THEN '1111100' ELSE '0000011' END AS days, array_to_string(list(tiploc ORDER BY p), '>') AS calls FROM c GROUP BY k")
def cif_schedules(spark, d):
    rows = cif.check(cif.lines(spark, _one_file(_cards(spark, d), ["k", "p"], _folder(spark))))
    return cif.schedules(rows).select("train_uid", "days", F.array_join(cif.calling_points(F.col("calls")), ">").alias("calls"))


@query(_CIF_SQL + " SELECT DISTINCT tiploc FROM c")
def cif_tiplocs_used(spark, d):
    return cif.tiplocs_used(cif.schedules(cif.lines(spark, _one_file(_cards(spark, d), ["k", "p"], _folder(spark)))))


@query("WITH r AS (SELECT count(*) AS n FROM lineitem GROUP BY l_orderkey HAVING count(*) >= 2) SELECT unnest(['HD', 'BS', 'LO', 'LI', 'LT', 'ZZ']) AS kind, unnest([1, count(*), count(*), CAST(sum(n - 2) AS BIGINT), count(*), 1]) AS n FROM r")
def cif_records(spark, d):
    return cif.records(cif.lines(spark, _one_file(_cards(spark, d), ["k", "p"], _folder(spark))))


@query(
    "SELECT 'V' || CAST(o_orderkey AS VARCHAR) AS trip_id, 'SV' || CAST(o_custkey % 3 AS VARCHAR) AS route_id, CASE WHEN o_custkey % 3 = 0 THEN 'A>B>C' WHEN o_custkey % 3 = 1 THEN 'B>C' ELSE 'A>B' END AS stops, "
    "CAST((o_orderkey % 24) * 3600 + (CASE WHEN o_custkey % 3 = 0 THEN 240 WHEN o_custkey % 3 = 1 THEN 90 ELSE 150 END) + CASE WHEN o_orderkey % 5 = 0 THEN 86400 ELSE 0 END AS BIGINT) AS arrives, CAST(CASE WHEN o_orderkey % 2 = 0 THEN 1 ELSE 5 END AS INTEGER) AS days FROM orders"
)
def txc_trips(spark, d):
    """Orders as vehicle journeys of three services; half of them have a week of their own."""
    link = lambda a, b, run: f"<JourneyPatternTimingLink><From><StopPointRef>{a}</StopPointRef></From><To><StopPointRef>{b}</StopPointRef></To><RunTime>{run}</RunTime></JourneyPatternTimingLink>"
    section = lambda n, links: f'<JourneyPatternSection id="S{n}">{links}</JourneyPatternSection>'
    week = "<OperatingProfile><RegularDayType><DaysOfWeek>{}</DaysOfWeek></RegularDayType></OperatingProfile>"
    service = lambda n, refs: f'<Service><ServiceCode>SV{n}</ServiceCode><Lines><Line id="L{n}"><LineName>{n}</LineName></Line></Lines>{week.format("<MondayToFriday/>")}<StandardService><JourneyPattern id="JP{n}"><Direction>outbound</Direction>{"".join(f"<JourneyPatternSectionRefs>S{r}</JourneyPatternSectionRefs>" for r in refs)}</JourneyPattern></StandardService></Service>'
    head = ["<TransXChange>", "<JourneyPatternSections>", section(1, link("A", "B", "PT2M30S")), section(2, link("B", "C", "PT90S")), "</JourneyPatternSections>", "<Services>", service(0, (1, 2)), service(1, (2,)), service(2, (1,)), "</Services>", "<VehicleJourneys>"]
    k, s = F.col("o_orderkey"), (F.col("o_custkey") % 3).cast("string")
    journey = F.concat(
        F.lit("<VehicleJourney>"), F.when(k % 2 == 0, week.format("<Sunday/>")).otherwise(""), F.lit("<VehicleJourneyCode>V"), k.cast("string"), F.lit("</VehicleJourneyCode><ServiceRef>SV"), s, F.lit("</ServiceRef><JourneyPatternRef>JP"), s,
        F.lit("</JourneyPatternRef><DepartureTime>"), F.lpad((k % 24).cast("string"), 2, "0"), F.lit(":00:00</DepartureTime>"), F.when(k % 5 == 0, "<DepartureDayShift>1</DepartureDayShift>").otherwise(""), F.lit("</VehicleJourney>"),
    )
    lines = _t(spark, d, "orders").select(k.alias("k"), journey.alias("value"))
    ends = spark.createDataFrame([(n - 100, x) for n, x in enumerate(head)] + [(1 << 60, "</VehicleJourneys>"), ((1 << 60) + 1, "</TransXChange>")], "k long, value string")
    out = txc.trips(spark, _one_file(lines.unionByName(ends), ["k"], _folder(spark)))
    return out.select("trip_id", "route_id", F.array_join("stops", ">").alias("stops"), F.element_at("times", -1).cast("long").alias("arrives"), F.aggregate("days", F.lit(0), lambda a, x: a + x).alias("days"))


@query("SELECT a || '>' || b AS stops, CASE WHEN a = b THEN 1 ELSE 3 END AS points FROM (SELECT DISTINCT CAST(l_suppkey % 20 AS VARCHAR) AS a, CAST(l_linenumber AS VARCHAR) AS b FROM lineitem) WHERE (CAST(a AS INTEGER) + CAST(b AS INTEGER)) % 3 <> 0")
def hop_shapes(spark, d):
    """Distinct stop sequences with a shape each, where all their hops have one."""
    pair = _t(spark, d, "lineitem").select((F.col("l_suppkey") % 20).cast("string").alias("a"), F.col("l_linenumber").cast("string").alias("b"))
    point = lambda x: F.struct(x.cast("double").alias("lat"), F.lit(0.0).alias("lon"))
    a, b = F.col("a").cast("int"), F.col("b").cast("int")
    hops = pair.distinct().where((a + b) % 3 != 0).select(F.col("a").alias("from_id"), F.col("b").alias("to_id"), F.when(a == b, F.array(point(a))).otherwise(F.array(point(a), point(a + b), point(b))).alias("points"))
    out = txc.stitched(pair.select(F.array("a", "b").alias("stops")), hops)
    return out.select(F.array_join("stops", ">").alias("stops"), F.size("points").alias("points"))


@query("SELECT CAST(row_number() OVER (ORDER BY s_suppkey) - 1 AS BIGINT) AS ordinal, CAST(s_suppkey AS VARCHAR) AS ID, s_name AS NAME, CAST(CASE s_suppkey % 3 WHEN 0 THEN 0 WHEN 1 THEN 1 ELSE 3 END AS INTEGER) AS points FROM supplier")
def mapinfo_rows(spark, d):
    """Suppliers as objects of a MIF, with their rows in a MID."""
    to, s = _folder(spark), _t(spark, d, "supplier")
    k = F.col("s_suppkey")
    object_ = F.when(k % 3 == 0, "None").when(k % 3 == 1, "POINT -5.9 54.6\n    Symbol (35,0,12)").otherwise("PLINE 3\n-5.9 54.6\n-5.8 54.6\n-5.7 54.6\n    PEN (1,2,0)")
    head = 'Version 300\nDelimiter ","\nColumns 2\n  ID Char(9)\n  NAME Char(30)\nData\n'
    mif = s.select(k, object_.alias("value")).unionByName(spark.createDataFrame([(-1, head)], "s_suppkey long, value string"))
    rows = mapinfo.read(spark, _one_file(mif, ["s_suppkey"], f"{to}/mif"), _one_file(s.select(k, F.concat(F.lit('"'), k.cast("string"), F.lit('","'), "s_name", F.lit('"')).alias("value")), ["s_suppkey"], f"{to}/mid"))
    return rows.select("ordinal", "ID", "NAME", F.size("points").alias("points"))


# -- lines and relations ---------------------------------------------------------------------------------------------------


def _overpass(spark, d) -> DataFrame:
    """Suppliers as relations of two ways, the first drawn backwards, and for every fourth with a gap; nodes named after nations."""
    s = _t(spark, d, "supplier").select(F.col("s_suppkey").alias("k"), F.col("s_nationkey").alias("n"))
    p = lambda lat, lon: F.struct(F.lit(lat).alias("lat"), lon.cast("double").alias("lon"))
    member = lambda kind, ref, role, g: F.struct(F.lit(kind).alias("type"), ref.alias("ref"), F.lit(role).alias("role"), g.alias("geometry"))
    none = F.lit(None).cast("array<struct<lat:double,lon:double>>")
    one, two = F.array(p(51.0, F.lit(0.1)), p(51.0, F.lit(0.0))), F.array(p(51.0, F.when(F.col("k") % 4 == 0, 0.11).otherwise(0.1)), p(51.0, F.lit(0.2)), p(51.0, F.lit(0.3)))
    tags = F.create_map(F.lit("route"), F.when(F.col("k") % 3 == 0, "tram").otherwise("train"))
    members = F.array(member("way", F.col("k") * 10, "", one), member("way", F.col("k") * 10 + 1, "", two), member("node", F.col("n"), "stop", none), member("node", F.lit(99), "platform", none), member("way", F.lit(7), "platform", two))
    empty = F.lit(None).cast("double")
    nothing = F.lit(None).cast("map<string,string>"), F.lit(None).cast("array<struct<type:string,ref:bigint,role:string,geometry:array<struct<lat:double,lon:double>>>>")
    element = lambda kind, id, lat, lon, tags, g, members: F.struct(F.lit(kind).alias("type"), id.cast("long").alias("id"), lat.alias("lat"), lon.alias("lon"), tags.alias("tags"), g.alias("geometry"), members.alias("members"))
    rows = s.select(element("relation", F.col("k"), empty, empty, tags, none, members).alias("e"))
    rows = rows.union(_t(spark, d, "nation").select(element("node", F.col("n_nationkey"), F.lit(51.0), F.col("n_nationkey") / 100.0, F.create_map(F.lit("name"), "n_name"), none, nothing[1])))
    rows = rows.union(s.select(element("way", F.col("k") * 10, empty, empty, nothing[0], F.when(F.col("k") % 5 == 0, F.slice(one, 1, 1)).otherwise(one), nothing[1])))
    to = _folder(spark)
    rows.agg(F.collect_list("e").alias("elements")).select(F.to_json(F.struct("elements")).alias("value")).write.text(to)
    return osm.elements(spark, to)


@query(
    "SELECT s_suppkey AS relation_id, CASE WHEN s_suppkey % 3 = 0 THEN 'tram' ELSE 'train' END AS route, CAST(2 AS INTEGER) AS ways, n_name || '|' AS stops, CAST(CASE WHEN s_suppkey % 4 = 0 THEN 1 ELSE 0 END AS INTEGER) AS breaks, "
    "CAST(CASE WHEN s_suppkey % 4 = 0 THEN 5 ELSE 4 END AS INTEGER) AS points, CAST(s_suppkey * 10 AS VARCHAR) || CASE WHEN s_suppkey % 4 = 0 THEN ',' || CAST(s_suppkey * 10 + 1 AS VARCHAR) ELSE '' END || ',' || CAST(s_suppkey * 10 + 1 AS VARCHAR) || ',' || CAST(s_suppkey * 10 + 1 AS VARCHAR) AS owner, "
    "round(111320.0 * cos(radians(51.0)) * CASE WHEN s_suppkey % 4 = 0 THEN 0.4 ELSE 0.3 END, 3) AS span_m FROM supplier JOIN nation ON n_nationkey = s_nationkey"
)
def relation_paths(spark, d):
    """Relations read from responses and walked into paths."""
    rel = graph.checkpointed(osm.relations(_overpass(spark, d)))
    rows = rel.join(tracing.paths(rel), "relation_id")
    names = F.array_join(F.transform("stops", lambda s: F.coalesce(s["name"], F.lit(""))), "|")
    return rows.select("relation_id", "route", F.size("ways").alias("ways"), names.alias("stops"), "breaks", F.size("points").alias("points"), F.array_join("owner", ",").alias("owner"), F.round("span_m", 3).alias("span_m"))


@query("SELECT s_suppkey * 10 AS way_id, CAST(2 AS INTEGER) AS points FROM supplier WHERE s_suppkey % 5 <> 0")
def bare_ways(spark, d):
    return osm.ways(_overpass(spark, d)).select("way_id", F.size("points").alias("points"))


@query("SELECT p_brand, CAST(count(*) AS INTEGER) AS points, true AS same FROM part GROUP BY 1")
def polyline_codec(spark, d):
    """Encoded polylines decoded again are the points that went in, to six digits."""
    p = _points(spark, d).groupBy("p_brand").agg(F.sort_array(F.collect_list(F.struct("stop_id", "lat", "lon"))).alias("p"))
    p = p.select("p_brand", F.transform("p", lambda x: F.struct(x["lat"].alias("lat"), x["lon"].alias("lon"))).alias("p"))
    back = p.withColumn("back", arrays.polyline_points(arrays.polyline_text("p")))
    near = F.forall(F.zip_with("p", "back", lambda a, b: (F.abs(a["lat"] - b["lat"]) < 1e-6) & (F.abs(a["lon"] - b["lon"]) < 1e-6)), lambda x: x)
    return back.select("p_brand", F.size("back").alias("points"), (near & (F.size("p") == F.size("back"))).alias("same"))


_CHOICES = "WITH c AS (SELECT r_regionkey AS r, r_name, n_nationkey AS n, n_name, row_number() OVER (PARTITION BY r_regionkey ORDER BY n_name) - 1 AS i FROM nation JOIN region ON r_regionkey = n_regionkey)"


def _named_lines(spark, d) -> tuple[DataFrame, DataFrame]:
    """Regions as relations that call at their nations by name; customers as patterns of two neighbours on one, some far away or turned."""
    n = _t(spark, d, "nation").withColumn("i", F.row_number().over(Window.partitionBy("n_regionkey").orderBy("n_name")) - 1)
    stop = lambda lat: F.struct(F.col("n_name").alias("name"), lat.alias("lat"), (F.col("i") / 100.0).alias("lon"))
    rel = n.groupBy(F.col("n_regionkey").alias("relation_id")).agg(F.sort_array(F.collect_list(F.struct("i", stop(F.lit(51.0)).alias("s")))).alias("l")).select("relation_id", F.transform("l", lambda x: x["s"]).alias("stops"))
    k = F.col("c_custkey")
    c = _t(spark, d, "customer").select(k.alias("pattern_id"), (k % 5).alias("n_regionkey"), (F.floor(k / 5) % 4).alias("at"))
    lat = F.when(F.col("pattern_id") % 11 == 0, 51.5).otherwise(51.0)
    named = lambda name: F.concat(name, F.when(F.col("pattern_id") % 2 == 0, " Railway Station").otherwise(" (Main)"))
    two = c.join(n, "n_regionkey").where("i = at or i = at + 1").groupBy("pattern_id").agg(F.sort_array(F.collect_list(F.struct("i", F.struct(named(F.col("n_name")).alias("name"), lat.alias("lat"), (F.col("i") / 100.0).alias("lon")).alias("s")))).alias("l"))
    pair = F.transform("l", lambda x: x["s"])
    return two.select("pattern_id", F.when(F.col("pattern_id") % 3 == 0, F.reverse(pair)).otherwise(pair).alias("stops")), rel


@query(
    "SELECT c_custkey AS pattern_id, CAST(c_custkey % 5 AS INTEGER) AS relation_id, c_custkey % 3 = 0 AS turned, CAST(CASE WHEN c_custkey % 3 = 0 THEN 3 - c_custkey // 5 % 4 ELSE c_custkey // 5 % 4 END AS INTEGER) AS start FROM customer WHERE c_custkey % 11 <> 0"
)
def stop_name_fits(spark, d):
    """Patterns fitted to relations by spellings of their stops' names, in both directions, and near enough."""
    pat, rel = _named_lines(spark, d)
    return tracing.near_namesake(tracing.fits(pat, rel), pat, rel).select("pattern_id", "relation_id", "turned", "start")


@query(
    "SELECT c_custkey AS pattern_id, CAST(c_custkey % 5 AS INTEGER) AS relation_id, 'ok' AS reason, round(111320.0 * cos(radians(51.0)) * 0.01, 2) AS length_m, CAST(2 AS INTEGER) AS points, "
    "round((CASE WHEN c_custkey % 3 = 0 THEN c_custkey // 5 % 4 + 1 ELSE c_custkey // 5 % 4 END) / 100.0, 6) AS first_lon, CAST(c_custkey // 5 % 4 AS VARCHAR) AS ways FROM customer WHERE c_custkey % 11 <> 0"
)
def traced_patterns(spark, d):
    """Fitted patterns cut out of their relation's path, at its own stops, with the ways they run over."""
    pat, rel = _named_lines(spark, d)
    lines = rel.select("relation_id", F.lit(0).alias("breaks"), F.lit(0.0).alias("span_m"), F.transform(F.sequence(F.lit(0), F.lit(4)), lambda i: F.struct(F.lit(51.0).alias("lat"), (i / 100.0).alias("lon"))).alias("points"), F.sequence(F.lit(0).cast("long"), F.lit(3).cast("long")).alias("owner"))
    best = tracing.resolve(tracing.traced(tracing.near_namesake(tracing.fits(pat, rel), pat, rel), lines))
    return best.select("pattern_id", "relation_id", "reason", F.round("length_m", 2).alias("length_m"), F.size("points").alias("points"), F.round(F.get("points", 0)["lon"], 6).alias("first_lon"), F.array_join("way_ids", ",").alias("ways"))


@query(
    "WITH s AS (SELECT s_suppkey AS k, CASE WHEN s_suppkey % 4 = 0 THEN 'off_track' WHEN s_suppkey % 4 = 1 THEN 'not_monotonic' WHEN s_suppkey % 4 = 2 THEN 'off_track' ELSE 'ok' END AS reason FROM supplier) "
    "SELECT k AS pattern_id, reason, CASE WHEN reason = 'ok' THEN round(111320.0 * cos(radians(51.0)) * 0.1, 2) ELSE 0.0 END AS length_m, CAST(CASE WHEN reason = 'ok' THEN 2 ELSE 0 END AS INTEGER) AS ways FROM s"
)
def cut_refusals(spark, d):
    """Stops off the line, out of order, in one place, and right: of each what the cut says."""
    p = lambda lat, lon: F.struct(F.lit(lat).alias("lat"), F.lit(lon).alias("lon"))
    k = F.col("s_suppkey")
    side = F.when(k % 4 == 0, F.array(p(51.1, 0.05), p(51.0, 0.15))).when(k % 4 == 1, F.array(p(51.0, 0.05), p(51.0, 0.19), p(51.0, 0.1))).when(k % 4 == 2, F.array(p(51.0, 0.0), p(51.0, 0.0))).otherwise(F.array(p(51.0, 0.05), p(51.0, 0.15)))
    fitted = _t(spark, d, "supplier").select(k.alias("pattern_id"), F.lit(1).cast("long").alias("relation_id"), F.lit(0.0).alias("worst_stop_m"), side.alias("side"))
    line = spark.range(1).select(F.lit(1).cast("long").alias("relation_id"), F.array(p(51.0, 0.0), p(51.0, 0.1), p(51.0, 0.2)).alias("points"), F.array(F.lit(1).cast("long"), F.lit(2).cast("long")).alias("owner"))
    return tracing.traced(fitted, line).select("pattern_id", "reason", F.round("length_m", 2).alias("length_m"), F.size("way_ids").alias("ways"))


@query(
    _CHOICES
    + ", l AS (SELECT a.n AS a, b.n AS b, a.r AS relation_id, abs(b.i - a.i) * 1000.0 AS gap, least(a.i, b.i) * 1000.0 AS low, greatest(a.i, b.i) * 1000.0 AS high, "
    + _HAV.format(a="51.0", b="51.0", x="a.i / 100.0", y="b.i / 100.0")
    + " AS far FROM c a JOIN c b ON a.r = b.r AND a.n <> b.n) SELECT a, CAST(b AS BIGINT) AS b, relation_id, low, high FROM l JOIN (SELECT DISTINCT c_nationkey AS a, (c_nationkey + c_custkey) % 25 AS b FROM customer) USING (a, b) WHERE gap <= 3.0 * far"
)
def placed_legs(spark, d):
    """Pairs of stations on the line that joins them, by spelling, with a bound on the detour."""
    n = _t(spark, d, "nation").withColumn("i", F.row_number().over(Window.partitionBy("n_regionkey").orderBy("n_name")) - 1)
    stations = n.select(F.col("n_nationkey").alias("tiploc"), F.concat("n_name", F.lit(" Rail Station")).alias("name"), F.lit(51.0).alias("lat"), (F.col("i") / 100.0).alias("lon"))
    stops = n.select(F.col("n_regionkey").alias("relation_id"), F.explode(text.spellings(F.col("n_name"))).alias("spelling"), (F.col("i") * 1000.0).alias("along_m"))
    pairs = _t(spark, d, "customer").select(F.col("c_nationkey").alias("a"), ((F.col("c_nationkey") + F.col("c_custkey")) % 25).alias("b"))
    return tracing.place_legs(pairs, stops, stations)


@query("SELECT n_regionkey AS relation_id, lower(n_name) AS spelling, round(111320.0 * cos(radians(51.0)) * (row_number() OVER (PARTITION BY n_regionkey ORDER BY n_name) - 1) / 100.0, 3) AS along_m FROM nation")
def stops_along_lines(spark, d):
    _, rel = _named_lines(spark, d)
    lines = rel.select("relation_id", F.lit(0).alias("breaks"), F.transform(F.sequence(F.lit(0), F.lit(4)), lambda i: F.struct(F.lit(51.0).alias("lat"), (i / 100.0).alias("lon"))).alias("points"))
    return tracing.line_stops(rel, lines).select("relation_id", "spelling", F.round("along_m", 3).alias("along_m"))


@query("SELECT c_custkey AS pattern_id, CASE WHEN c_custkey % 40 <= 25 THEN 'ok' ELSE 'uncovered' END AS status, CASE WHEN c_custkey % 40 <= 25 THEN CAST(c_custkey % 7 AS VARCHAR) ELSE '' END AS ways, CASE WHEN c_custkey % 40 <= 25 THEN 1.0 ELSE 0.0 END AS covered, CASE WHEN c_custkey % 40 <= 25 THEN CAST(c_custkey % 40 AS DOUBLE) ELSE 0.0 END AS worst_m FROM customer")
def snapped_lines(spark, d):
    """Customers as lines of five vertices beside one of seven parallel ways 100 m apart: covered within 25 m."""
    k = F.col("c_custkey")
    vertices = _t(spark, d, "customer").select(k.alias("pattern_id"), F.explode(F.sequence(F.lit(0), F.lit(4))).alias("seq"), (k % 7 * 100 + k % 40).cast("double").alias("y"))
    ways = spark.range(7).select(F.col("id").alias("way_id"), F.lit(0.0).alias("ax"), (F.col("id") * 100.0).alias("ay"), F.lit(500.0).alias("bx"), (F.col("id") * 100.0).alias("by"))
    out = tracing.snapped(vertices.select("pattern_id", "seq", (F.col("seq") * 100.0).alias("x"), "y"), ways)
    return out.select("pattern_id", "status", F.array_join("way_ids", ",").alias("ways"), "covered", "worst_m")


_LATTICE = """WITH RECURSIVE s AS (SELECT p_partkey AS k, p_brand AS name, CAST(p_partkey % 40 AS INTEGER) AS x, CAST(p_partkey // 40 % 40 AS INTEGER) AS y FROM part),
f AS (SELECT k, name, x * 1000 AS x0, y * 1000 AS y0, (x + CAST(k % 2 = 0 AS INTEGER)) * 1000 AS x1, (y + CAST(k % 2 <> 0 AS INTEGER)) * 1000 AS y1 FROM s),
e AS (SELECT f.*, CAST(k % 3 AS INTEGER) AS n, CAST(k % 2 AS INTEGER) AS trips FROM f JOIN (SELECT min(k) AS k FROM f GROUP BY x0, y0, x1, y1) USING (k))"""


@query(_LATTICE + " SELECT k AS id, CASE WHEN x0 = x1 THEN min(CASE WHEN x0 = x1 THEN k END) OVER (PARTITION BY x0) ELSE k END AS corridor FROM e")
def corridor_build(spark, d):
    """Streets of a lattice: those that run north continue each other, those that run east end at them."""
    return corridors.build(chains.without_reverse(_streets(spark, d)))


def _coalesced_sql(keys: str) -> str:
    return (
        _LATTICE
        + f""", nodes AS (SELECT {keys}, x, y, min(k) AS a, max(k) AS b FROM (SELECT {keys}, k, x0 AS x, y0 AS y FROM e UNION ALL SELECT {keys}, k, x1, y1 FROM e) GROUP BY ALL HAVING count(*) = 2 AND min(k) <> max(k)),
l AS (SELECT a, b FROM nodes UNION SELECT b, a FROM nodes), r(k, root) AS (SELECT k, k FROM e UNION SELECT l.b, r.root FROM r JOIN l ON l.a = r.k), c AS (SELECT k, min(root) AS line FROM r GROUP BY 1)
SELECT {keys}, line AS edge_id, CAST(count(*) + 1 AS INTEGER) AS points FROM e JOIN c USING (k) GROUP BY ALL"""
    )


@query(_coalesced_sql("name"))
def coalesced_lines(spark, d):
    """Streets of one name joined end to end."""
    out = chains.coalesce(chains.without_reverse(_streets(spark, d)), ["name"])
    return out.select("name", "edge_id", F.size("lon_e6").alias("points"))


@query(_coalesced_sql("n, trips"))
def overview_lines(spark, d):
    """Lines for small scales, by equal n and trips."""
    s = chains.without_reverse(_streets(spark, d)).select("edge_id", (F.col("edge_id") % 3).cast("int").alias("n"), (F.col("edge_id") % 2).cast("int").alias("trips"), "lon_e6", "lat_e6")
    return publish.overview(s).select("n", "trips", "edge_id", F.size("lon_e6").alias("points"))


# -- publishing ------------------------------------------------------------------------------------------------------------


@query(
    "WITH q AS (SELECT l_suppkey AS way_id, CASE WHEN l_linenumber % 2 = 0 THEN 'rail' ELSE 'tram' END AS mode, l_returnflag AS name, CAST(sum(l_linenumber) AS BIGINT) AS t FROM lineitem GROUP BY ALL) "
    "SELECT way_id, mode, count(*) AS n, array_to_string(list(name ORDER BY t DESC, name), ',') AS refs, coalesce(CASE WHEN way_id % 3 = 0 THEN way_id * 2 END, CAST(sum(t) AS BIGINT)) AS trips FROM q JOIN supplier ON s_suppkey = way_id AND s_suppkey % 5 <> 0 GROUP BY way_id, mode"
)
def track_lines(spark, d):
    """Track by way and mode: attributed trips, else the services' sum."""
    services = _t(spark, d, "lineitem").select(F.col("l_suppkey").alias("way_id"), F.when(F.col("l_linenumber") % 2 == 0, "rail").otherwise("tram").alias("mode"), F.col("l_returnflag").alias("short_name"), F.col("l_linenumber").alias("n_trips"))
    k = F.col("s_suppkey")
    ways = _t(spark, d, "supplier").where(k % 5 != 0).select(k.alias("way_id"), F.array(F.lit(1), F.lit(2)).alias("lon_e6"), F.array(F.lit(1), F.lit(2)).alias("lat_e6"))
    trips = _t(spark, d, "supplier").where(k % 3 == 0).select(k.alias("way_id"), (k * 2).alias("n_trips"))
    return publish.track(services, ways, trips).select("way_id", "mode", "n", F.array_join("refs", ",").alias("refs"), F.col("trips").cast("long").alias("trips"))


@query("SELECT p_partkey AS edge_id, p_partkey % 9 AS n, p_name AS name, CAST(2 AS INTEGER) AS points, CAST((p_partkey % 40) * 1000 AS INTEGER) AS first_lon FROM part")
def geojson_round_trip(spark, d):
    """Lines written as GeoJSON in export order and read back, coordinates to the micro-degree."""
    s = _streets(spark, d).join(_t(spark, d, "part").select(F.col("p_partkey").alias("edge_id"), F.col("p_name").alias("title")), "edge_id")
    rows = publish.features(s.select("edge_id", (F.col("edge_id") % 9).alias("n"), F.col("title").alias("name"), "lon_e6", "lat_e6"), ["edge_id", "n", "name"], ["edge_id"])
    to = _folder(spark)
    publish.write_lines(rows, to)
    back = geojsonl.read(spark, to, "edge_id long, n long, name string")
    return back.select("edge_id", "n", "name", F.size("lon_e6").alias("points"), F.get("lon_e6", 0).alias("first_lon"))


@query("SELECT p_partkey AS edge_id, CAST(row_number() OVER (ORDER BY p_partkey) AS INTEGER) AS place, '{\"type\":\"Feature\",\"properties\":{\"id\":' || CAST(p_partkey AS VARCHAR) || '}' AS head FROM part")
def export_order(spark, d):
    """Features in export order: properties in the order given, rows without ties, the same bytes on every run."""
    rows = publish.features(_streets(spark, d).withColumnRenamed("id", "own").withColumn("id", F.col("edge_id")), ["id"], ["id"])
    to = _folder(spark)
    publish.write_lines(rows, to)
    lines = spark.read.text(to).select(F.monotonically_increasing_id().alias("n"), "value")
    place = F.row_number().over(Window.orderBy("n"))
    return lines.select(F.regexp_extract("value", '"id":([0-9]+)', 1).cast("long").alias("edge_id"), place.alias("place"), F.substring_index("value", ',"geometry"', 1).alias("head"))


@query("SELECT true AS roads, false AS track, EXISTS (SELECT 1 FROM part WHERE p_size > 40) AS large, 'A; B' AS credits")
def archive_contents(spark, d):
    p = _t(spark, d, "part")
    layers = publish.contents(roads=p, track=p.where("p_partkey < 0"), large=p.where("p_size > 40"))
    credit = publish.credits(layers, {"large": "A", "track": "C", "roads": "B"}) if layers["large"] else ["A", "B"]
    return spark.createDataFrame([(*layers.values(), "; ".join(credit))], "roads boolean, track boolean, large boolean, credits string")


@query(_NET + ", w AS (SELECT edge_id, coalesce(CAST(sum(n_trips) AS DOUBLE), 0) AS weight FROM win LEFT JOIN es USING (edge_id) GROUP BY 1) SELECT edge_id, weight, CAST(row_number() OVER (ORDER BY weight, edge_id) AS INTEGER) AS place FROM w")
def edges_quietest_first(spark, d):
    """The draw order by weight, ties by id."""
    rows = _network(spark, d).edges_query(network.QuerySpec(), by_weight=True).select("edge_id", "weight")
    return rows.withColumn("place", F.row_number().over(Window.orderBy(F.monotonically_increasing_id())))


# -- predicates, windows and lists -----------------------------------------------------------------------------------------


def _staged(spark, d) -> DataFrame:
    k = F.col("o_orderkey")
    mode = F.element_at(F.array(F.lit("bus"), F.lit("rail"), F.lit("tram"), F.lit(None).cast("string")), (k % 4 + 1).cast("int"))
    return _t(spark, d, "orders").select(k.alias("pattern_id"), mode.alias("mode"), F.when(k % 3 == 0, "v2").when(k % 3 == 1, "v1").alias("last_seen"), F.when(k % 5 < 2, "S").alias("shape_id"), (k % 50).alias("n_trips"))


_STAGED = "WITH p AS (SELECT o_orderkey AS k, ['bus', 'rail', 'tram', NULL][o_orderkey % 4 + 1] AS mode, coalesce(o_orderkey % 3 = 0, false) AS live, o_orderkey % 5 < 2 AS shaped FROM orders), q AS (SELECT *, mode IS NULL OR mode = 'bus' AS road FROM p)"


@query(_STAGED + " SELECT k AS pattern_id, live, road, live AND NOT road AND NOT shaped AS off_road, live AND NOT road AND (NOT shaped OR mode = 'rail') AS traceable FROM q")
def feed_predicates(spark, d):
    p = _staged(spark, d)
    return p.select("pattern_id", work.current_feed("v2").alias("live"), work.matchable(p).alias("road"), work.non_road(p, "v2").alias("off_road"), work.traceable(p, "v2").alias("traceable"))


@query(_STAGED + ", t AS (SELECT *, live AND NOT road AND (NOT shaped OR mode = 'rail') AS owed, CASE WHEN k % 7 < 3 THEN 'ok' WHEN k % 7 < 5 THEN 'off_track' END AS s FROM q) SELECT count(*) FILTER (owed) AS patterns_owed, count(*) FILTER (owed AND s IS NULL) AS patterns_pending, count(*) FILTER (live AND s = 'ok') AS ok, count(*) FILTER (live AND s = 'off_track') AS off_track FROM t")
def trace_census(spark, d):
    p = _staged(spark, d)
    k = F.col("pattern_id")
    status = p.where(k % 7 < 5).select("pattern_id", F.when(k % 7 < 3, "ok").otherwise("off_track").alias("status"))
    out = aggregate.trace_funnel(p, status, work.current_feed("v2"), work.traceable(p, "v2"))
    return out.select("patterns_owed", "patterns_pending", *(F.coalesce(F.try_element_at("traced_by_status", F.lit(s)), F.lit(0)).cast("long").alias(s) for s in ("ok", "off_track")))


@query(_STAGED + " SELECT count(*) FILTER (k % 2 = 1) = 0 AND count(*) FILTER (k % 10 = 4) = 0 AS ready, true AS ready_after FROM q WHERE live AND road")
def publish_gate(spark, d):
    """Whether nothing is pending and no transport error is left: first with gaps, then with a status for all."""
    p = _staged(spark, d)
    live = p.where(work.current_feed("v2") & work.matchable(p))
    k = F.col("pattern_id")
    status = p.where(k % 2 == 0).select("pattern_id", F.when(k % 10 == 4, "transport_error").otherwise("ok").alias("status"))
    return spark.createDataFrame([(work.publishable(live, status), work.publishable(live, p.select("pattern_id", F.lit("ok").alias("status"))))], "ready boolean, ready_after boolean")


@query(
    "SELECT p_partkey AS edge_id, CAST(p_partkey % 40 * 1000 AS INTEGER) AS min_lon_e6, CAST((p_partkey % 40 + CAST(p_partkey % 2 = 0 AS INTEGER)) * 1000 AS INTEGER) AS max_lon_e6, "
    "p_partkey % 40 + CAST(p_partkey % 2 = 0 AS INTEGER) >= 10 AND p_partkey % 40 <= 20 AND p_partkey // 40 % 40 + CAST(p_partkey % 2 <> 0 AS INTEGER) >= 5 AND p_partkey // 40 % 40 <= 15 AS inside FROM part"
)
def window_mask(spark, d):
    """A polyline's own extent against a window, and the box that it is stored with."""
    s = geo.with_bbox(_streets(spark, d))
    return s.select("edge_id", "min_lon_e6", "max_lon_e6", geo.touches((10_000, 5_000, 20_000, 15_000)).alias("inside"))


@query(_PTS + ", i AS (SELECT * FROM pts WHERE lat BETWEEN 49.8 AND 61.1 AND lon BETWEEN -11.0 AND least(2.0, 0.9 + 0.6 * (lat - 50.0))) SELECT round(greatest(min(lon) - 0.5, -11.0), 6) AS west, round(greatest(min(lat) - 0.5, 49.8), 6) AS south, round(least(max(lon) + 0.5, 2.0), 6) AS east, round(least(max(lat) + 0.5, 61.1), 6) AS north FROM i")
def padded_extent(spark, d):
    """The window of all stops inside the isles, padded and cut back."""
    return spark.createDataFrame([tuple(round(v, 6) for v in geo.extent(_points(spark, d), pad=0.5))], "west double, south double, east double, north double")


@query("SELECT o_orderkey, CAST(o_orderkey % 2000 - 1000 AS BIGINT) AS x, CAST(o_custkey % 3000 - 1500 AS BIGINT) AS y, (CAST(o_orderkey % 2000 - 1000 AS HUGEINT) * 4294967296 + CASE WHEN o_custkey % 3000 < 1500 THEN 4294967296 ELSE 0 END + o_custkey % 3000 - 1500)::BIGINT AS key FROM orders")
def packed_points(spark, d):
    x, y = F.col("o_orderkey") % 2000 - 1000, F.col("o_custkey") % 3000 - 1500
    rows = _t(spark, d, "orders").select("o_orderkey", geo.packed(x, y).alias("key"))
    low = geo.unpacked(F.col("key"))
    return rows.select("o_orderkey", low[0].alias("x"), low[1].alias("y"), "key")


@query(
    "WITH RECURSIVE p AS (SELECT l_orderkey AS k, list(CAST(l_partkey * 7 % 1000 AS INTEGER) ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice) AS xs FROM lineitem GROUP BY 1), "
    "s(k, i, last, n) AS (SELECT k, 1, xs[1], 1 FROM p UNION ALL SELECT s.k, i + 1, CASE WHEN i + 1 < len(xs) AND abs(xs[i + 1] - last) > 250 THEN xs[i + 1] ELSE last END, n + CASE WHEN i + 1 = len(xs) OR abs(xs[i + 1] - last) > 250 THEN 1 ELSE 0 END FROM s JOIN p USING (k) WHERE i < len(xs)) "
    "SELECT k AS l_orderkey, CAST(max(n) AS INTEGER) AS kept FROM s GROUP BY 1"
)
def simplified_lines(spark, d):
    """Vertices farther than a tolerance from the last one kept; ends stay."""
    rows = patterns.sequences(_t(spark, d, "lineitem"), "l_orderkey", "l_partkey", ("l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"))
    xs = F.transform("stop_seq", lambda x: (x * 7 % 1000).cast("int"))
    rows = rows.select("l_orderkey", xs.alias("xs"), F.transform(xs, lambda x: F.lit(0)).alias("ys"))
    return rows.select("l_orderkey", F.size(arrays.kept_vertices("xs", "ys", F.lit(250))).alias("kept"))


@query("SELECT road_class, count(*) AS edges FROM (SELECT CASE WHEN u < 0.08 THEN 'primary' WHEN u < 0.25 THEN 'secondary' WHEN u < 0.5 THEN 'tertiary' WHEN u < 0.85 THEN 'residential' ELSE 'unclassified' END AS road_class FROM (SELECT CAST('0x' || substr(md5(CAST(i AS VARCHAR) || '|class'), 1, 13) AS BIGINT) / 4503599627370496.0 AS u FROM range(20000) t(i))) GROUP BY 1")
def synthetic_classes(spark, d):
    """The made-up network's draws, which another engine can repeat."""
    return synthetic.network(spark, 20_000)["edges"].groupBy("road_class").agg(F.count("*").alias("edges"))


@query(
    _PTS
    + ", f AS (SELECT p_brand AS line, stop_id AS seq, lat, lon, lat BETWEEN 50 AND 58 AND lon BETWEEN -9 AND 1 AS i FROM pts), g AS (SELECT *, coalesce(lead(i) OVER w, false) AS nx, coalesce(lag(i) OVER w, false) AS pv FROM f WINDOW w AS (PARTITION BY line ORDER BY seq)), "
    "h AS (SELECT *, i OR nx OR pv AS keep FROM g), j AS (SELECT *, keep AND NOT (coalesce(lag(keep) OVER w, false) AND (i OR pv)) AS st FROM h WINDOW w AS (PARTITION BY line ORDER BY seq)), r AS (SELECT *, sum(CAST(st AS INTEGER)) OVER (PARTITION BY line ORDER BY seq) AS run FROM j) SELECT line, CAST(run AS BIGINT) AS run, CAST(count(*) AS INTEGER) AS points FROM r WHERE keep GROUP BY 1, 2 HAVING count(*) >= 2"
)
def clipped_lines(spark, d):
    """Lines clipped to a window and broken where they leave it."""
    rows = synthetic.clip(_points(spark, d).select(F.col("p_brand").alias("line"), F.col("stop_id").alias("seq"), "lat", "lon"), (-9.0, 50.0, 1.0, 58.0))
    return rows.select("line", "run", F.size("points").alias("points"))


@query(
    "SELECT o_orderkey AS pattern_id, o_orderkey % 3 = 0 AS has_shape, CAST(CASE WHEN o_orderkey % 3 = 0 THEN 2 ELSE n END AS INTEGER) AS points, CASE WHEN o_orderkey % 3 = 0 THEN 51.0 ELSE f END AS first_lat "
    "FROM orders JOIN (SELECT l_orderkey, count(*) AS n, arg_min(48.0 + (l_suppkey * 37 % 1500) / 100.0, (l_linenumber, l_suppkey, l_partkey)) AS f FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_suppkey, l_partkey) AS j FROM lineitem) GROUP BY 1) ON l_orderkey = o_orderkey"
)
def matcher_points(spark, d):
    """What a matcher is asked: a pattern's shape in degrees, or else its stops in order."""
    k = F.col("s_suppkey")
    stops = _t(spark, d, "supplier").select(k.cast("string").alias("stop_id"), (48.0 + (k * 37 % 1500) / 100.0).alias("lat"), F.lit(-3.0).alias("lon"))
    seq = F.row_number().over(Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_suppkey", "l_partkey"))
    at = _t(spark, d, "lineitem").select(F.col("l_orderkey").alias("pattern_id"), seq.alias("seq"), F.col("l_suppkey").cast("string").alias("stop_id"))
    shapes = spark.createDataFrame([("S", [51_000_000, 52_000_000], [-3_000_000, -3_100_000])], "shape_id string, lat_e6 array<int>, lon_e6 array<int>")
    o = _t(spark, d, "orders").select(F.col("o_orderkey").alias("pattern_id"), F.when(F.col("o_orderkey") % 3 == 0, "S").alias("shape_id"), F.lit(1.0).alias("span_m"))
    return match.points_of(at, stops, shapes, o).select("pattern_id", "has_shape", F.size("points").alias("points"), F.get("points", 0)["lat"].alias("first_lat"))


# -- commits ---------------------------------------------------------------------------------------------------------------


@query("SELECT o_orderstatus AS status, count(*) AS patterns, CAST(sum(CASE WHEN o_orderstatus <> 'P' THEN 1 ELSE 0 END) AS BIGINT) AS traces, (SELECT count(*) FROM supplier) AS ways FROM orders GROUP BY 1")
def trace_commit(spark, d):
    """Statuses, traces and ways of one run put into a store at once, twice: the second time changes nothing."""
    store = Store(spark, f"{_folder(spark)}/store")
    o = _t(spark, d, "orders").select(F.col("o_orderkey").alias("pattern_id"), F.col("o_orderstatus").alias("status"))
    rows = {"trace_status": o, "traces": o.where("status <> 'P'").select("pattern_id"), "ways": _t(spark, d, "supplier").select(F.col("s_suppkey").alias("way_id"))}
    for _ in range(2):
        store.insert_all({t: (df, *work.CONFLICTS[t]) for t, df in rows.items()})
    own = store.read("trace_status").join(store.read("traces").select("pattern_id", F.lit(1).alias("t")), "pattern_id", "left")
    return own.groupBy("status").agg(F.count("*").alias("patterns"), F.sum(F.coalesce("t", F.lit(0))).alias("traces")).withColumn("ways", F.lit(store.read("ways").count()).cast("long"))


@query(
    "SELECT c_custkey AS pattern_id, CASE WHEN c_custkey % 2 = 0 THEN CASE WHEN c_custkey % 3 <> 0 THEN 'new' ELSE 'old' END ELSE 'feed' END AS short_name, CASE WHEN c_custkey % 2 = 0 AND c_custkey % 3 = 0 THEN NULL ELSE 'v1' END AS last_seen FROM customer"
)
def services_refreshed(spark, d):
    """A source's own patterns retired first, those found again put in; the feed's patterns stay."""
    k = F.col("c_custkey")
    own = k % 2 == 0
    stored = _t(spark, d, "customer").select(k.alias("pattern_id"), F.when(own, F.concat(F.lit("osm:r"), k.cast("string"))).otherwise("x").alias("route_id"), F.when(own, "old").otherwise("feed").alias("short_name"), F.lit("v1").alias("first_seen"), F.lit("v1").alias("last_seen"))
    found = stored.where("pattern_id % 2 = 0 and pattern_id % 3 <> 0").select("pattern_id", "route_id", F.lit("new").alias("short_name"))
    return patterns.refresh_services(stored, found, "v1", F.col("route_id").like("osm:r%")).select("pattern_id", "short_name", "last_seen")


@query("SELECT p_partkey AS edge_id, CAST(2 AS INTEGER) AS points FROM part")
def clustered_edges(spark, d):
    """Edges in Z-order, then put back into a store as many as they were."""
    from transitnet.operators import maintenance

    store = Store(spark, f"{_folder(spark)}/store")
    store.commit({"edges": geo.with_bbox(_streets(spark, d).select("edge_id", "lon_e6", "lat_e6"))})
    store.rewrite("edges", lambda df: maintenance.z_order(df, 4))
    return store.read("edges").select("edge_id", F.size("lon_e6").alias("points"))


@query(_LINKS + ", p AS (SELECT unnest([f, t]) AS n FROM e) SELECT count(DISTINCT n) AS nodes, " + _ID.format(k="CAST(min(n) AS VARCHAR)") + " AS first FROM p")
def node_census(spark, d):
    """Distinct nodes of the links, and the text id of the least."""
    from transitnet.plans.catalog import _links

    n: Column = F.explode(F.array("from_node", "to_node"))
    return _links(spark, d).select(n.alias("n")).agg(F.count_distinct("n").alias("nodes"), F.min("n").alias("m")).select("nodes", ids.text_id(F.col("m").cast("string")).alias("first"))
