import gzip
import json
import struct

import pytest
from pyspark.sql import functions as F

from transitnet.operators import tracing
from transitnet.sources import osm, pmtiles
from transitnet.streaming import feeds


@pytest.fixture
def overpass(spark, tmp_path):
    g = lambda *xy: [{"lat": a, "lon": b} for a, b in xy]
    way = lambda ref, *xy: {"type": "way", "ref": ref, "role": "", "geometry": g(*xy)}
    node = lambda ref: {"type": "node", "ref": ref, "role": "stop"}
    body = {
        "elements": [
            {"type": "relation", "id": 1, "tags": {"route": "train", "name": "Line", "operator": "Ours"}, "members": [way(10, (51.0, 0.1), (51.0, 0.0)), way(11, (51.0, 0.1), (51.0, 0.2)), node(100), node(101), node(102)]},
            {"type": "relation", "id": 2, "tags": {"route": "train", "operator": "Theirs"}, "members": [way(10, (51.0, 0.0), (51.0, 0.1)), way(12, (52.0, 0.1), (52.0, 0.2)), node(100), node(101)]},
            *({"type": "node", "id": 100 + k, "lat": 51.0, "lon": 0.1 * k, "tags": {"name": n}} for k, n in enumerate(("Alpha Station", "Beta", "Gamma (East)"))),
            {"type": "way", "id": 10, "tags": {"railway": "rail"}, "geometry": g((51.0, 0.0), (51.0, 0.1))},
            {"type": "way", "id": 13, "geometry": g((51.0, 0.0))},
        ]
    }
    (tmp_path / "o.json").write_text(json.dumps(body))
    return osm.elements(spark, str(tmp_path / "o.json"))


def test_relations_to_traces(spark, overpass):
    rel = osm.relations(overpass)
    assert osm.ways(overpass).count() == 1
    paths = tracing.paths(rel)
    got = {r["relation_id"]: r for r in paths.collect()}
    assert got[1]["breaks"] == 0 and [p["lon"] for p in got[1]["points"]] == [0.0, 0.1, 0.2] and got[1]["owner"] == [10, 11]
    assert got[2]["breaks"] == 1
    reasons = {r["relation_id"]: r["reason"] for r in tracing.sift(rel, paths, ["train"], ["ours"], ["theirs"]).collect()}
    assert reasons == {1: "kept", 2: "another region's"}
    stop = lambda n, lon: {"name": n, "lat": 51.0, "lon": lon}
    pat = spark.createDataFrame([(7, [stop("Gamma", 0.2), stop("Beta Halt", 0.1)]), (8, [stop("Alpha", 0.0), stop("Gamma", 0.2)])], "pattern_id long, stops array<struct<name:string,lat:double,lon:double>>")
    fit = tracing.near_namesake(tracing.fits(pat, rel.where("relation_id = 1")), pat, rel)
    assert [(r["pattern_id"], r["start"], r["turned"]) for r in fit.collect()] == [(7, 0, True)]
    best = tracing.resolve(tracing.traced(fit, paths)).first()
    assert best["reason"] == "ok" and best["way_ids"] == [11] and [round(p["lon"], 6) for p in best["points"]] == [0.2, 0.1]
    lines = tracing.line_stops(rel, paths)
    stations = spark.createDataFrame([("A", "Alpha Rail Station", 51.0, 0.0), ("C", "Gamma", 51.0, 0.2)], "tiploc string, name string, lat double, lon double")
    legs = tracing.legs(spark.createDataFrame([(1, ["A", "C"]), (2, ["A"])], "sequence long, calls array<string>")).withColumn("trips", F.lit(5))
    placed = tracing.place_legs(legs, lines, stations)
    out = tracing.way_trips(legs, placed, tracing.line_ways(paths.where("breaks = 0")))
    assert {r["way_id"]: r["n_trips"] for r in out.collect()} == {10: 5, 11: 5}


def test_cut_at_the_relations_own_stops(spark):
    """The timetable's stops lie on a parallel line 300 m north; the relation's nodes on its own line decide the cut."""
    stop = lambda n, lat, lon: {"name": n, "lat": lat, "lon": lon}
    ddl = "stops array<struct<name:string,lat:double,lon:double>>"
    pat = spark.createDataFrame([(k, [stop("Alpha", 51.0027, 0.02), stop("Beta", 51.0027, 0.08)]) for k in (1, 2)], f"pattern_id long, {ddl}")
    rel = spark.createDataFrame([(5, [stop("Alpha", 51.0, 0.021), stop("Beta", 51.0, 0.079)])], f"relation_id long, {ddl}")
    path = spark.createDataFrame([(5, [(51.0, 0.0), (51.0, 0.1)], [10])], "relation_id long, points array<struct<lat:double,lon:double>>, owner array<long>")
    rows = tracing.traced(tracing.near_namesake(tracing.fits(pat, rel), pat, rel), path).collect()
    assert len(rows) == 2 and all(r["reason"] == "ok" and r["worst_track_m"] < 1e-6 and [round(p["lon"], 9) for p in r["points"]] == [0.021, 0.079] for r in rows)


def test_cut_refusals():
    assert tracing.cut([(51.0, 0.0), (51.0, 0.0)], [(51.0, 0.0), (51.0, 0.1)], [1])[0] == "off_track"
    path, owner = [(51.0, 0.0), (51.0, 0.1), (51.0, 0.2)], [1, 2]
    assert tracing.cut([(51.1, 0.0), (51.0, 0.1)], path, owner)[0] == "off_track"
    assert tracing.cut([(51.0, 0.0), (51.0, 0.2), (51.0, 0.1)], path, owner)[0] == "not_monotonic"
    assert tracing.cut([(51.0, 0.05), (51.0, 0.15)], path, owner)[3] == [1, 2]


def test_snap_holds_on(spark):
    v = spark.createDataFrame([(1, k, 10.0 * k, 1.0 if k < 5 else 2.0) for k in range(10)] + [(2, k, 10.0 * k, 500.0) for k in range(3)], "pattern_id long, seq int, x double, y double")
    s = spark.createDataFrame([(5, 0.0, 0.0, 100.0, 0.0), (6, 0.0, 3.0, 100.0, 3.0)], "way_id long, ax double, ay double, bx double, by double")
    got = {r["pattern_id"]: (r["status"], r["way_ids"]) for r in tracing.snapped(v, s).collect()}
    assert got == {1: ("ok", [5]), 2: ("uncovered", [])}


def made(plan) -> int:
    """The most rows that a node of an executed plan gave out."""
    kind = plan.getClass().getSimpleName()
    inner = plan.executedPlan() if kind == "AdaptiveSparkPlanExec" else plan.plan() if kind.endswith("QueryStageExec") else None
    children = [inner] if inner is not None else [plan.children().apply(i) for i in range(plan.children().size())]
    rows = plan.metrics().get("numOutputRows")
    return max([rows.get().value() if rows.isDefined() else 0, *map(made, children)])


def test_snap_to_copies_of_ways(spark):
    """The rows joined follow the polylines, not polylines times copies; the least of equal ways is named, others stay apart."""
    n, street, bend = 300, (0.0, 0.0, 100.0, 0.0), (100.0, 0.0, 100.0, 100.0)
    v = spark.createDataFrame([(p, k, 90.0 * k, 1.0 + 60.0 * (k == 2)) for p in range(n) for k in range(2 + p % 2)], "pattern_id long, seq int, x double, y double")
    big = 2**60 + 1
    ways = [(big + k, *street) for k in range(n)] + [(7, *s) for s in (street, bend)] + [(9, *s) for s in (bend, street, street)] + [(8, *bend), (None, *street)]
    s = spark.createDataFrame(ways, "way_id long, ax double, ay double, bx double, by double")
    out = tracing.snapped(v, s)
    assert {(r["status"], tuple(r["way_ids"]), round(r["worst_m"], 9)) for r in out.where("pattern_id % 2 = 0").collect()} == {("ok", (7,), 1.0)}
    apart = tracing.snapped(v, s.where(f"way_id >= {big}"))
    got = {r["pattern_id"]: (r["status"], r["way_ids"], r["covered"]) for r in apart.collect()}
    assert all(got[p][:2] == ("ok", [big]) for p in range(0, n, 2)) and all(got[p][0] == "uncovered" and 0 < got[p][2] < 1 for p in range(1, n, 2))
    assert made(apart._jdf.queryExecution().executedPlan()) < 10 * n


def test_snap_without_places(spark):
    v = spark.createDataFrame([(1, 0, None, 1.0), (1, 1, 5.0, 1.0), (2, 0, 5.0, 1.0), (2, 1, 5.0, 1.0), (3, 0, 0.0, 1.0), (3, 1, 9.0, 1.0)], "pattern_id long, seq int, x double, y double")
    s = spark.createDataFrame([(5, 0.0, 0.0, 50.0, 0.0), (4, None, 0.0, 50.0, 0.0)], "way_id long, ax double, ay double, bx double, by double")
    got = {r["pattern_id"]: (r["status"], r["way_ids"], r["covered"]) for r in tracing.snapped(v, s).collect()}
    assert got == {1: ("uncovered", [], 0.0), 2: ("uncovered", [], 0.0), 3: ("ok", [5], 1.0)}


def varint(n):
    out = b""
    while n > 127:
        out, n = out + bytes([n & 127 | 128]), n >> 7
    return out + bytes([n])


def field(number, value):
    return varint(number << 3) + varint(value) if isinstance(value, int) else varint(number << 3 | 2) + varint(len(value)) + value


def test_pmtiles(spark, tmp_path):
    zig = lambda v: v << 1 ^ v >> 63
    geometry = b"".join(map(varint, [1 << 3 | 1, zig(2), zig(3), 2 << 3 | 2, zig(5), zig(0), zig(0), zig(-1)]))
    feature = field(2, b"\x00\x00") + field(3, 2) + field(4, geometry)
    tile = gzip.compress(field(3, field(1, b"roads") + field(2, feature) + field(3, b"n") + field(4, field(4, 42)) + field(5, 4096)))
    entry = b"".join(map(varint, [1, 5, 2, len(tile), 1]))
    root = gzip.compress(entry)
    head = struct.pack("<8Q", 127, len(root), 0, 0, 0, 0, 127 + len(root), len(tile))
    header = (b"PMTiles\x03" + head).ljust(97, b"\0") + b"\x02"
    (tmp_path / "a.pmtiles").write_bytes(header.ljust(127, b"\0") + root + tile)
    rows = pmtiles.features(spark, str(tmp_path / "a.pmtiles"))
    got = rows.orderBy("x", "y").collect()
    assert [(r["z"], r["layer"], r["properties"], [tuple(p) for p in r["paths"][0]]) for r in got] == [(2, "roads", {"n": "42"}, [(2, 3), (7, 3), (7, 2)])] * 2
    assert pmtiles.attributes(rows, 2).first()["keys"] == ["n"]
    assert sorted(pmtiles.tile_zxy(1 + k)[1:] for k in range(4)) == [(0, 0), (0, 1), (1, 0), (1, 1)]
    with pytest.raises(ValueError):
        list(pmtiles.entries(b"x" * 200))


def test_streams(spark, tmp_path):
    from transitnet.store import Store

    store = Store(spark, str(tmp_path / "root"))
    one = spark.createDataFrame([(1, "42", 5)], "pattern_id long, short_name string, n_trips long")
    for k in range(2):
        one.withColumn("n_trips", F.lit(5 + k).cast("long")).write.mode("append").parquet(str(tmp_path / "drops"))
        feeds.merge_feeds(spark, str(tmp_path / "drops"), one.schema, store, "patterns", "pattern_id", lambda df, e: f"v{e}", str(tmp_path / "cp")).awaitTermination()
    row = store.read("patterns").first()
    assert (row["n_trips"], row["first_seen"], row["last_seen"]) == (6, "v0", "v1")
    events = spark.createDataFrame([(1, "2024-01-01 00:01:00"), (1, "2024-01-01 00:20:00"), (2, "2024-01-01 05:00:00")], "user long, at string").withColumn("at", F.to_timestamp("at"))
    events.write.parquet(str(tmp_path / "ev"))
    stream = spark.readStream.schema(events.schema).parquet(str(tmp_path / "ev"))
    q = feeds.windowed(stream, "at", "1 hour", None, "10 minutes", ["user"], n=F.count("*")).writeStream.format("memory").queryName("w").outputMode("complete").start()
    q.processAllAvailable()
    q.stop()
    assert sorted((r["user"], r["n"]) for r in spark.table("w").collect()) == [(1, 2), (2, 1)]
    assert feeds.sessions(events, "at", "30 minutes", "1 hour", ["user"], n=F.count("*")).count() == 2
    assert feeds.republished_once(stream, "user", "at", "1 hour").isStreaming
