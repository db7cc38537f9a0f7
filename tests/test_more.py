import json

import pytest
from pyspark.sql import functions as F

from transitnet.functions import arrays, geo
from transitnet.operators import maintenance, match, publish
from transitnet.operators.network import Network, QuerySpec
from transitnet.sources import fetch, routing, synthetic
from transitnet.store import Store


class FakeSession:
    def __init__(self, *answers):
        self.answers, self.asked = list(answers), []

    def get(self, url, headers):
        self.asked.append(headers)
        answer = self.answers.pop(0)
        if isinstance(answer, Exception):
            raise answer
        return answer[0], {}, [answer[1]]


def test_download_resumes_and_retries(tmp_path):
    path = str(tmp_path / "a" / "f.zip")
    waits = []
    (tmp_path / "a").mkdir()
    (tmp_path / "a" / "f.zip.part").write_bytes(b"half")
    s = FakeSession(fetch.Unreachable("down"), (503, b""), (206, b"rest"))
    assert fetch.download("http://x", path, s, sleep=waits.append) == path
    assert open(path, "rb").read() == b"halfrest" and waits == [1.0, 2.0] and s.asked[0] == {"Range": "bytes=4-"}
    assert fetch.download("http://x", path, FakeSession()) == path
    for status, error in ((404, fetch.Invalid), (403, fetch.Unauthorized)):
        s = FakeSession((status, b""), (200, b"never asked"))
        with pytest.raises(error):
            fetch.download("http://x", path, s, force=True)
        assert len(s.answers) == 1
    with pytest.raises(fetch.Invalid, match="no good"):
        fetch.download("http://x", path, FakeSession((200, b"x")), valid=lambda p: (_ for _ in ()).throw(ValueError("no good")), force=True)


def test_answers_are_kept(tmp_path):
    asked = []
    ask = lambda q: asked.append(q) or b'{"elements": []}'
    assert fetch.cached("q", str(tmp_path / "c"), ask) == fetch.cached("q", str(tmp_path / "c"), ask) and asked == ["q"]
    with pytest.raises(fetch.Invalid):
        fetch.cached("bad", str(tmp_path / "c"), lambda q: b"<html>")
    package = {"result": {"resources": [{"format": "zip", "url": "old", "last_modified": "2024"}, {"format": "ZIP", "url": "new", "last_modified": "2025"}, {"format": "CSV", "url": "x", "last_modified": "2026"}]}}
    assert fetch.newest_resource(package) == "new"
    (tmp_path / "in").write_text("x")
    built = []
    run = lambda: fetch.rebuilt([str(tmp_path / "in")], str(tmp_path / "m"), lambda: built.append(1))
    assert run() and not run() and built == [1]
    (tmp_path / "in").write_text("xy")
    assert run()


def test_routing_answers():
    line = [(51.0, -3.0), (51.001, -3.0), (51.002, -3.0)]
    assert [len(r) for r in routing.chunked(line, most=2)] == [2, 2] and [len(r) for r in routing.chunked(line, metres=120)] == [2, 2] and routing.chunked(line) == [line]
    there_and_back = [(51.0, -3.0), (51.01, -3.0), (51.02, -3.0), (51.0101, -3.0), (51.03, -3.0)]
    assert routing.location_types(there_and_back) == ["break", "break", "break_through", "break", "break"]
    shape = arrays.encode_polyline(line)
    trace = {"shape": shape, "confidence_score": 0.9, "edges": [{"id": 1001, "way_id": 7, "length": 0.111, "names": ["High Street"], "road_class": "primary", "begin_shape_index": 0, "end_shape_index": 1}, {"length": 1, "begin_shape_index": 0, "end_shape_index": 1}, {"id": 1002, "length": 0.112, "begin_shape_index": 1, "end_shape_index": 2}]}
    calls = []

    def post(path, body):
        calls.append((path, body))
        return {"/trace_attributes": trace, "/route": {"trip": {"legs": [{"shape": shape}]}}, "/status": {"version": "3", "tileset_last_modified": 5}}[path]

    m = routing.RoutingMatcher(post)
    answer = m.match_stops([line[0], line[-1]])
    assert [e["edge_id"] for e in answer["edges"]] == [1001, 1002] and answer["edges"][0]["length_m"] == 111.0 and answer["edges"][0]["lat_e6"] == [51000000, 51001000]
    assert [c[0] for c in calls] == ["/route", "/trace_attributes"] and calls[1][1]["shape_match"] == "edge_walk"
    assert m.match_shape(line)["confidence"] == 0.9 and m.healthy() and m.graph_id() == "5"
    assert routing.RoutingMatcher(lambda p, b: {"error": "no path"}).match_stops(line)["edges"] == []


def test_faulty_service_is_a_status(spark):
    class Down(match.StraightMatcher):
        def match_stops(self, points):
            raise ConnectionError("refused")

    p = F.array(*(F.struct(F.lit(51.0 + k).alias("lat"), F.lit(-3.0).alias("lon")) for k in range(2)))
    rows = spark.range(1).select(F.col("id").alias("pattern_id"), F.lit(1.0).alias("span_m"), F.lit(False).alias("has_shape"), p.alias("points"))
    out = match.outcomes(match.ask(rows, Down()))
    assert out["match_status"].first()["status"] == "transport_error" and out["pattern_edges"].count() == 0
    far = match.outcomes(match.ask(rows, match.StraightMatcher()))
    assert far["match_status"].first()["status"] == "low_confidence"


def test_paths_and_pruning(spark, tmp_path):
    made = synthetic.network(spark, 4000)
    box = made["edges"].agg(F.percentile("min_lon_e6", 0.4), F.percentile("min_lat_e6", 0.4), F.percentile("max_lon_e6", 0.5), F.percentile("max_lat_e6", 0.5)).first()
    box = tuple(int(v) for v in box)
    store = Store(spark, str(tmp_path / "root"))
    store.commit(made)
    before = store.read("edges").count()
    store.rewrite("edges", lambda df: maintenance.z_order(df, 8))
    assert store.read("edges").count() == before
    with pytest.raises(ValueError, match="in force again"):
        store.rewrite("edges", lambda df: df.limit(5))
    net = Network(store.read("edges"), store.read("edge_services"), box)
    rows = net.paths(QuerySpec(), (800, 600), tolerance=50).collect()
    assert rows and all(0 <= r["weight"] <= 1 and len(r["xs"]) == len(r["ys"]) >= 2 for r in rows)
    assert any(0 <= x <= 800 for r in rows for x in r["xs"])
    read = maintenance.scanned(net.window(QuerySpec()).select("edge_id"))
    assert read["files"] == 8 and read["rows"] >= len(rows)
    with pytest.raises(ValueError, match="window"):
        Network(made["edges"], made["edge_services"]).paths(QuerySpec(), (8, 8))


def test_geometry_extras(spark):
    one = lambda c: spark.range(1).select(c).first()[0]
    assert tuple(one(geo.wkt_to_e6(F.lit("LINESTRING (-3.2 51.5, -3.1 51.6)")))) == ([-3200000, -3100000], [51500000, 51600000])
    assert one(geo.wkt_to_e6(F.lit("POINT (1 2)")))[0] is None
    key = geo.packed(F.lit(-5), F.lit(7))
    assert [one(c) for c in geo.unpacked(key)] == [-5, 7] and [one(c) for c in geo.unpacked(geo.packed(F.lit(5), F.lit(-7)))] == [5, -7]
    stops = spark.createDataFrame([(51.5, -3.2), (53.0, -1.0), (48.8, 2.3)], "lat double, lon double")
    assert geo.extent(stops, pad=0.5) == (-3.7, 51.0, -0.5, 53.5) and geo.extent(stops.limit(0)) is None
    scale, x0, y0 = geo.fit((-1, -1, 1, 1), 100, 50)
    assert ((180 / 360) - x0) * scale == pytest.approx(50) and (0.5 - y0) * scale == pytest.approx(25)
    lines = spark.createDataFrame([(1, 300), (2, 5), (3, None)], "id int, trips int")
    assert {(r["id"], r["band"]) for r in publish.banded(lines).collect()} == {(1, b[0]) for b in publish.BANDS} | {(2, "near"), (2, "detail"), (3, "detail")}
    assert json.loads(publish.status(spark.range(1).withColumn("n", F.lit(3)))) == {"id": 0, "n": 3}
