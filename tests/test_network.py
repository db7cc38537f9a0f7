import json
import random

import pytest
from pyspark.sql import functions as F

from transitnet.functions.geo import with_bbox
from transitnet.operators import aggregate, chains, corridors, coverage, graph, maintenance, publish
from transitnet.operators.network import GROUPS, ORDERS, WEIGHTS, Network, QuerySpec, order_statistics
from transitnet.schemas import TABLES
from transitnet.sources import geojsonl, synthetic

BOX = (-3_300_000, 51_400_000, -3_100_000, 51_600_000)


@pytest.fixture(scope="module")
def net(spark):
    e = [(k, 1 if k < 4 else 99, "R" if k < 4 else None, "secondary" if k < 4 else "primary", 100.0, [-3_200_000 + 1000 * k, -3_199_000 + 1000 * k], [51_500_000] * 2) for k in (1, 2, 3, 4)]
    edges = with_bbox(spark.createDataFrame(e, "edge_id long, way_id long, road_name string, road_class string, length_m double, lon_e6 array<int>, lat_e6 array<int>"))
    services = spark.createDataFrame([(1, "42", "OP1", 1, 100), (1, "9A", "OP1", 1, 100), (2, "42", "FIRST", 1, 50), (4, "7", "OP1", 1, 30)], TABLES["edge_services"])
    return Network(edges, services, BOX)


def test_query_spec(net):
    ids = lambda **k: [r["edge_id"] for r in net.weights(QuerySpec(**k)).orderBy("edge_id").collect()]
    assert ids() == [1, 2, 3, 4] and ids(min_trips=40) == [1, 2] and ids(operator=("FIRST",)) == [2] and ids(road_class=("primary",)) == [4]
    assert ids(service=("42'; DROP TABLE x",)) == []
    w = lambda **k: {r["edge_id"]: r["weight"] for r in net.weights(QuerySpec(**k)).collect()}
    assert w()[3] == 0 and w(weight="density")[4] == 0.3 and w(weight="services")[1] == 2
    names = lambda **k: sorted(r["grp"] for r in net.groups(QuerySpec(**k)).collect())
    assert names(group="way") == ["1", "99"] and names(group="road_name") == ["R", "unknown"]
    expected = {"widest": "42 42 7 9A", "narrowest": "7 9A 42 42", "busiest": "42 42 9A 7", "quietest": "7 9A 42 42", "name": "42 42 7 9A"}
    for order, groups in expected.items():
        assert " ".join(r["grp"] for r in net.grouped_query(QuerySpec(order=order)).collect()) == groups
    assert [r["groups"] for r in net.edges_query(QuerySpec(), with_groups=True).collect()][0] == ["42", "9A"]
    assert tuple(net.bounds(QuerySpec()).first()) == (0.0, 200.0)
    with pytest.raises(ValueError, match="known weights"):
        QuerySpec(weight="trams")
    with pytest.raises(ValueError, match="1 or more"):
        QuerySpec(sample=0)
    assert QuerySpec(service=("A", "B")).key != QuerySpec(service=("A,B",)).key
    assert [r[0] for r in net.facet("short_name").collect()] == ["42", "7", "9A"]


@pytest.mark.parametrize("weight", WEIGHTS)
def test_every_combination_plans(net, weight):
    for group in GROUPS:
        for order in ORDERS:
            net.pairs(QuerySpec(weight=weight, group=group, order=order)).join(net.weights(QuerySpec(weight=weight)), "edge_id")._jdf.queryExecution().executedPlan()


def test_window_reaches_the_scan(spark, net, tmp_path):
    maintenance.z_order(net.edges, 2).write.parquet(str(tmp_path / "e"))
    stored = Network(spark.read.parquet(str(tmp_path / "e")), net.services, BOX)
    plan = spark._jvm.PythonSQLUtils.explainString(stored.window(QuerySpec())._jdf.queryExecution(), "formatted")
    pushed = next(line for line in plan.splitlines() if line.startswith("PushedFilters"))
    assert "LessThanOrEqual(min_lon_e6" in pushed and "GreaterThanOrEqual(max_lon_e6" in pushed
    assert stored.window(QuerySpec()).count() == 4


def test_order_statistics_rank_rule(spark):
    values = [(i * i) % 97 for i in range(50)]
    df = spark.createDataFrame([(float(v),) for v in values], "v double")
    got = order_statistics(df, "v", {"lo": 0.02, "hi": 0.98, "mid": 0.5}).first()
    ranked = sorted(values)
    assert tuple(got) == tuple(ranked[min(49, int(q * 50))] for q in (0.02, 0.98, 0.5))


def chain(spark, rows):
    df = spark.createDataFrame(rows, "id long, from_node long, to_node long, weight double")
    return {r["id"]: (r["chain"], r["seq"]) for r in graph.follow(chains.successors(df)).collect()}


def test_chains(spark):
    assert chain(spark, [(1, 10, 11, 1.0), (2, 11, 12, 1.0), (3, 12, 13, 1.0)]) == {1: (1, 0), 2: (1, 1), 3: (1, 2)}
    fork = chain(spark, [(1, 10, 11, 1.0), (2, 11, 12, 1.0), (3, 11, 13, 1.0)])
    assert {k: v[1] for k, v in fork.items()} == {1: 0, 2: 0, 3: 0}
    assert chain(spark, [(1, 10, 11, 1.0), (2, 11, 12, 2.0)]) == {1: (1, 0), 2: (2, 0)}
    ring = chain(spark, [(5, 1, 2, 1.0), (3, 2, 3, 1.0), (9, 3, 1, 1.0)])
    assert ring == {3: (3, 0), 9: (3, 1), 5: (3, 2)}
    long = chain(spark, [(k, k, k + 1, 1.0) for k in range(200)])
    assert long == {k: (0, k) for k in range(200)}


def test_components(spark):
    rng = random.Random(5)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(180)] + [(1000 + k, 1001 + k) for k in range(60)]
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    got = {r["node"]: r["component"] for r in graph.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {n: find(n) for e in edges for n in e}


def line(*xy):
    return [x for x, _ in xy], [y for _, y in xy]


def brute_links(rows):
    """All pairs at each node, by the same angles."""
    import math

    ends = []
    for i, xs, ys in rows:
        for end in (0, 1):
            k = range(len(xs)) if end == 0 else range(len(xs) - 1, -1, -1)
            k = list(k)
            scale = math.cos(math.radians(ys[k[0]] / 1e6))
            dx = dy = along = 0.0
            for a, b in zip(k, k[1:], strict=False):
                sx, sy = (xs[b] - xs[a]) / 1e6 * 111_320.0 * scale, (ys[b] - ys[a]) / 1e6 * 111_320.0
                along, dx, dy = along + math.hypot(sx, sy), dx + sx, dy + sy
                if along >= 50:
                    break
            ends.append((i, end, (xs[k[0]], ys[k[0]]), math.atan2(dy, dx)))
    best = {}
    for a in ends:
        for b in ends:
            if a[:2] != b[:2] and a[2] == b[2] and (c := round(-math.cos(a[3] - b[3]), 7)) >= math.cos(math.radians(60)):
                best[a[:2]] = min(best.get(a[:2], (9,)), (-c, *b[:2]))
    return {(a[0], b[1]) for a, b in best.items() if a[0] < b[1] and best.get(b[1:], (9,))[1:] == a}


def test_corridor_links_by_bearing(spark):
    import random

    rng = random.Random(3)
    nodes = [(k % 5 * 2000, k // 5 * 2000) for k in range(20)]
    rows = []
    for k in range(160):
        (a, b), (c, d) = rng.sample(nodes, 2)
        rows.append((k, [a, rng.randrange(9000), c], [b, rng.randrange(9000), d]))
    got = corridors.links(spark.createDataFrame(rows, "id long, lon_e6 array<int>, lat_e6 array<int>")).collect()
    assert {tuple(r) for r in got} == brute_links(rows)


def test_coalesce_of_many(spark):
    """Lines joined by components and joins, against all lines of a group at once."""
    import random

    rng = random.Random(5)
    rows = []
    for k in range(400):
        x, y = rng.randrange(12), rng.randrange(12)
        other = (x + 1, y) if rng.random() < 0.5 else (x, y + 1)
        p = [(x, y), other][:: rng.choice((1, -1))]
        rows.append((k, rng.choice("AB"), [a for a, _ in p], [b for _, b in p]))
    seen, kept = set(), []
    for r in rows:
        key = (r[1], frozenset(zip(r[2], r[3], strict=True)))
        if key not in seen:
            seen.add(key)
            kept.append(r)
    rng.shuffle(kept)
    kept = kept[:150]
    out = {(r["name"], r["edge_id"], tuple(r["lon_e6"]), tuple(r["lat_e6"])) for r in chains.coalesce(spark.createDataFrame(kept, "edge_id long, name string, lon_e6 array<int>, lat_e6 array<int>"), ["name"]).collect()}
    expected = set()
    for name in "AB":
        for i, p in chains.joined_lines([(r[0], list(zip(r[2], r[3], strict=True))) for r in kept if r[1] == name]):
            expected.add((name, i, tuple(a for a, _ in p), tuple(b for _, b in p)))
    assert out == expected and len(out) < len(kept)


def test_coalesce_and_corridors(spark):
    rows = [(1, "A", *line((0, 0), (10, 0))), (2, "A", *line((20, 0), (10, 0))), (3, "B", *line((20, 0), (30, 0))), (4, "A", *line((10, 0), (0, 0)))]
    df = spark.createDataFrame(rows, "edge_id long, name string, lon_e6 array<int>, lat_e6 array<int>")
    one_way = chains.without_reverse(df)
    assert sorted(r["edge_id"] for r in one_way.collect()) == [1, 2, 3]
    out = {r["name"]: (r["edge_id"], r["lon_e6"]) for r in chains.coalesce(one_way, ["name"]).collect()}
    assert out == {"A": (1, [0, 10, 20]), "B": (3, [20, 30])}
    cross = [(1, *line((0, 0), (1000, 0))), (2, *line((1000, 0), (2000, 100))), (3, *line((1000, 0), (1000, 900))), (4, *line((5000, 0), (6000, 0)))]
    built = corridors.build(spark.createDataFrame(cross, "id long, lon_e6 array<int>, lat_e6 array<int>"))
    assert {r["id"]: r["corridor"] for r in built.collect()} == {1: 1, 2: 1, 3: 3, 4: 4}
    ranked = corridors.measured(built.join(spark.createDataFrame([(k, 100.0 * k, k) for k in (1, 2, 3, 4)], "id long, length_m double, trips int"), "id"))
    assert [r["corridor"] for r in corridors.ranked(ranked).collect()] == [4, 3, 1]


def test_inversions(spark):
    p = spark.createDataFrame([(1, "R", "42", "OP", "bus", 10, "v"), (2, "R", " ", "OP", "bus", None, "v"), (3, "F", "F", "OP", "ferry", 5, "v"), (4, "R", "42", "OP", "bus", 7, None)], "pattern_id long, route_id string, short_name string, agency_id string, mode string, n_trips long, last_seen string")
    e = spark.createDataFrame([(1, 0, 7), (1, 5, 7), (2, 0, 7), (3, 0, 7), (4, 0, 7)], TABLES["pattern_edges"])
    live = F.coalesce(F.col("last_seen") == "v", F.lit(False)) & (F.col("mode") == "bus")
    got = {tuple(r) for r in aggregate.edge_services(e, p, live).collect()}
    assert got == {(7, "42", "OP", 1, 10), (7, "R", "OP", 1, None)}
    traces = spark.createDataFrame([(1, [5, 6, 5], True), (3, [5], None)], "pattern_id long, way_ids array<long>, ways_cut boolean").withColumns({"lon_e6": F.array(F.lit(1), F.lit(2)), "lat_e6": F.array(F.lit(1), F.lit(2))})
    track = aggregate.track_services(traces, p, F.lit(True))
    assert {tuple(r) for r in track.collect()} == {(5, "42", "OP", "bus", 1, 10), (6, "42", "OP", "bus", 1, 10)}
    shapes = spark.createDataFrame([("SH", [1, 2], [3, 4])], TABLES["shapes"])
    seg = aggregate.segments(p.withColumn("shape_id", F.when(F.col("pattern_id") == 2, "SH")), shapes, traces, F.lit(True))
    assert sorted(r["pattern_id"] for r in seg.collect()) == [2, 3]
    status = spark.createDataFrame([(1, "ok"), (2, "error")], "pattern_id long, status string")
    f = aggregate.funnel(p, status, live).first()
    assert (f["patterns"], f["live"], f["matched"], f["pending"], f["by_status"]) == (4, 2, 1, 0, {"ok": 1, "error": 1})


def test_publish(spark, net, tmp_path):
    out = publish.roads(net.edges, net.services)
    rows = publish.features(out, ["edge_id", "way_id", "n", "refs", "trips", "name"], ["way_id", "edge_id"])
    text = [r[0] for r in rows.collect()]
    assert text == [r[0] for r in rows.collect()] and json.loads(text[0])["properties"]["refs"] == ["42", "9A"]
    publish.write_lines(rows, str(tmp_path / "l"))
    back = geojsonl.read(spark, str(tmp_path / "l"), "edge_id long, n long")
    assert sorted((r["edge_id"], len(r["lon_e6"])) for r in back.collect()) == sorted((r["edge_id"], len(r["lon_e6"])) for r in out.collect())
    (tmp_path / "bad").write_text("{not json\n")
    with pytest.raises(Exception):
        geojsonl.read(spark, str(tmp_path / "bad"), "edge_id long").collect()
    assert publish.contents(roads=out, track=out.limit(0)) == {"roads": True, "track": False}
    assert publish.credits({"roads": True}, {"roads": "A", "track": "B"}) == ["A"]
    with pytest.raises(ValueError, match="pending"):
        maintenance.unreferenced_shapes(out, out, 3)
    with pytest.raises(ValueError, match="refused"):
        maintenance.refuse_collapse(100, 40)


def test_coverage(spark):
    sizes = spark.createDataFrame([("a", 100), ("b", 10), ("c", 1)], "cell string, n long")
    quota = {r["cell"]: r["quota"] for r in coverage.quotas(sizes, 60, 0.5).collect()}
    assert quota["c"] == 1 and quota["b"] == 10 and quota["a"] == 49
    rows = spark.createDataFrame([("a", t) for t in (9, 9, 5, 5, 1)], "cell string, trips long")
    assert coverage.floors(rows, 4).first()["floor"] == 5
    assert coverage.hold_back(rows, coverage.floors(rows, 4)).count() == 4
    assert coverage.floors(rows, 1).first()["floor"] == 9
    px = coverage.pixels(spark.createDataFrame([(0, 0, 3, 0, 1, 255), (2, 0, 2, 2, 5, 65280)], "x0 int, y0 int, x1 int, y1 int, weight int, rgb int"))
    got = {(r["px"], r["py"]): r["rgb"] for r in px.collect()}
    assert got[(2, 0)] == 65280 and got[(1, 0)] == 255 and len(got) == 6
    png = coverage.png([(k[0], k[1], v) for k, v in got.items()], 4, 3)
    assert png[:8] == b"\x89PNG\r\n\x1a\n" and b"IDAT" in png
    assert coverage.shrunk(px, 2).where("px = 0 and py = 0").first()["cover"] == 0.5
    assert coverage.canvas_height(1000, (-1, -1, 1, 1)) == 1000


def test_synthetic_network_repeats(spark):
    a, b = (synthetic.network(spark, 500) for _ in range(2))
    assert a["edges"].exceptAll(b["edges"]).isEmpty() and a["edge_services"].count() == b["edge_services"].count() > 500
    pts = spark.createDataFrame([("l", k, 0.0, float(k)) for k in range(6)], "line string, seq int, lat double, lon double")
    runs = synthetic.clip(pts, (1.5, -1, 2.5, 1))
    assert [len(r["points"]) for r in runs.collect()] == [3]
