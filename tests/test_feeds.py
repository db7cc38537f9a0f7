import zipfile

import pytest
from pyspark.sql import functions as F

from transitnet.operators import match, patterns, work
from transitnet.schemas import TABLES, route_types
from transitnet.sources import cif, gtfs, mapinfo, naptan, txc
from transitnet.store import Store, upsert

FEED = {
    "agency": "agency_id,agency_name,agency_url,agency_timezone\nOP1,Operator,http://x,Europe/London\n",
    "stops": "stop_id,stop_name,stop_lat,stop_lon\nS1,One,51.500,-3.200\nS2,Two,51.500,-3.195\nS3,Three,51.500,-3.190\nS4,\"Four, Five\",51.500,-3.185\nP1,Pier,51.45,-3.16\nP2,Pier 2,51.44,-3.15\nX,Nowhere,0,0\n",
    "routes": "route_id,agency_id,route_short_name,route_long_name,route_type\nR1,OP1,07,Seven,3\nR2,OP1,F,Ferry,4\nR3,OP1,T,Train,2\nR4,OP1,?,Odd,999\n",
    "calendar": "service_id,monday,tuesday,wednesday,thursday,friday,saturday,sunday,start_date,end_date\nWD,1,1,1,1,1,0,0,20240101,20241231\n",
    "trips": "route_id,service_id,trip_id,direction_id,shape_id\nR1,WD,T1,0,SH1\nR1,WD,T2,0,\nR1,WD,T3,0,\nR2,WD,T4,0,\nR3,WD,T5,0,\n",
    "stop_times": "trip_id,arrival_time,departure_time,stop_id,stop_sequence\n"
    + "".join(f"{t},08:0{k}:00,08:0{k}:00,S{k},{k}\n" for t in ("T1", "T2") for k in (2, 1, 4, 3))
    + "T3,09:00:00,09:00:00,S1,1\nT3,09:01:00,09:01:00,S2,2\nT4,1:00,1:00,P1,1\nT4,1:10,1:10,P2,2\nT5,1:00,1:00,S1,1\nT5,1:00,1:00,S4,2\n",
    "shapes": "shape_id,shape_pt_lat,shape_pt_lon,shape_pt_sequence\nSH1,51.5,-3.19,2\nSH1,51.5,-3.2,1\nSH2,51.5,-3.2,1\n",
    "feed_info": "feed_publisher_name,feed_publisher_url,feed_lang,feed_version,feed_start_date\n\"Pub, Ltd\",http://x,en,1b4e28ba-2fa1-11d2-883f-0016d3cca427,20240101\n",
}


@pytest.fixture
def folder(tmp_path):
    for name, text in FEED.items():
        (tmp_path / f"{name}.txt").write_text("﻿" + text if name == "stops" else text)
    return str(tmp_path)


def test_feed_to_patterns(spark, folder):
    out = patterns.from_feed(gtfs.load(spark, folder), ["bus"])
    rows = {r["n_stops"]: r for r in out["patterns"].collect()}
    assert sorted(rows) == [2, 4]
    assert (rows[4]["n_trips"], rows[4]["shape_id"], rows[4]["stop_seq"]) == (10, "SH1", ["S1", "S2", "S3", "S4"])
    assert (rows[2]["n_trips"], rows[2]["shape_id"], rows[2]["short_name"]) == (5, None, "07")
    assert 900 < rows[4]["span_m"] < 1050
    assert [tuple(r) for r in out["shapes"].collect()] == [("SH1", [-3200000, -3190000], [51500000, 51500000])]
    assert sorted((r["seq"], r["stop_id"]) for r in out["pattern_stops"].where(F.col("pattern_id") == rows[2]["pattern_id"]).collect()) == [(0, "S1"), (1, "S2")]
    assert out["stops"].where("stop_id = 'X'").isEmpty()
    assert patterns.from_feed(gtfs.load(spark, folder), ["bus", "ferry", "rail"])["patterns"].count() == 4
    with pytest.raises(ValueError, match="no route"):
        patterns.from_feed(gtfs.load(spark, folder), ["tram"])
    with pytest.raises(ValueError, match="unknown mode"):
        route_types(["trem"])
    assert gtfs.feed_version(spark, folder) == "20240101-1b4e28ba"


def test_zip(folder, tmp_path):
    path = str(tmp_path / "feed.zip")
    with zipfile.ZipFile(path, "w") as z:
        for name, text in FEED.items():
            z.writestr(f"{name}.txt", text)
    assert "stops.txt" in gtfs.check_zip(path)
    assert gtfs.unpack(path, str(tmp_path / "out"))
    with zipfile.ZipFile(path, "w") as z:
        z.writestr("stops.txt", "")
    with pytest.raises(ValueError, match="lacks"):
        gtfs.check_zip(path)


def test_second_feed_and_work(spark, tmp_path):
    store = Store(spark, str(tmp_path / "root"))
    make = lambda rows: spark.createDataFrame(rows, "pattern_id long, short_name string, n_trips long, mode string, shape_id string, span_m double")
    first = make([(1, "1", 10, "bus", None, 900.0), (2, "2", 5, "bus", "SH", 500.0), (3, "F", 3, "ferry", None, 1.0)])
    merged = patterns.merge(store.read("patterns"), first, "v1")
    store.commit({"patterns": merged})
    store.set_meta("feed_version", "v1")
    store.commit({"patterns": patterns.merge(store.read("patterns"), make([(2, "2b", 7, "bus", "SH", 500.0), (4, "4", 1, "bus", None, 10.0)]), "v2")})
    rows = {r["pattern_id"]: r for r in store.read("patterns").collect()}
    assert (rows[1]["first_seen"], rows[1]["last_seen"]) == ("v1", "v1")
    assert (rows[2]["first_seen"], rows[2]["last_seen"], rows[2]["short_name"], rows[2]["n_trips"]) == ("v1", "v2", "2b", 7)
    assert (rows[4]["first_seen"], rows[4]["last_seen"]) == ("v2", "v2")
    assert store.meta("feed_version") == "v1"
    live = store.read("patterns").where(work.current_feed("v2") & work.matchable(store.read("patterns")))
    points = [{"lat": 51.5, "lon": -3.2}, {"lat": 51.5, "lon": -3.19}]

    def load(n):
        todo = work.busiest_first(work.pending(live, store.read("match_status")), n)
        return todo.select("pattern_id", F.lit(1000.0).alias("span_m"), F.lit(False).alias("has_shape"), F.array(*(F.struct(F.lit(p["lat"]).alias("lat"), F.lit(p["lon"]).alias("lon")) for p in points)).alias("points"))

    assert work.run(store, load, lambda items: match.outcomes(match.ask(items, match.StraightMatcher())), batch=1) == 2
    assert {r["pattern_id"]: r["status"] for r in store.read("match_status").collect()} == {2: "ok", 4: "ok"}
    assert store.read("pattern_edges").count() == 2 and store.read("edges").count() == 1
    assert work.publishable(live, store.read("match_status"))
    store.commit({"match_status": store.read("match_status").withColumn("status", F.when(F.col("pattern_id") == 4, "transport_error").otherwise(F.col("status")))})
    assert not work.publishable(live, store.read("match_status"))
    cleared = work.retry({t: store.read(t) for t in ("match_status", "pattern_edges")}, ["transient"])
    assert [r["pattern_id"] for r in cleared["pattern_edges"].collect()] == [2]
    with pytest.raises(ValueError, match="unknown status"):
        work.expand_statuses(["fine"])
    work.pin_graph(store, "g1")
    with pytest.raises(ValueError, match="graph g1"):
        work.pin_graph(store, "g2")
    with pytest.raises(ValueError, match="there already"):
        store.insert("meta", spark.createDataFrame([("graph_id", "x")], TABLES["meta"]), ["key"])
    store.insert("meta", spark.createDataFrame([("graph_id", "x")], TABLES["meta"]), ["key"], "ignore")
    assert store.meta("graph_id") == "g1"


def test_store_survives_a_lost_writer(spark, tmp_path, monkeypatch):
    store = Store(spark, str(tmp_path / "root"))
    row = lambda *kv: spark.createDataFrame([kv], TABLES["meta"])
    store.commit({"meta": row("a", "1")})

    def lost(*_):
        raise KeyboardInterrupt

    for step in ("_put", "_write"):
        with monkeypatch.context() as m:
            m.setattr(store, step, lost)
            with pytest.raises(KeyboardInterrupt):
                store.commit({"meta": row("a", "2")})
        assert store.meta("a") == "1"
    # What a writer left half done is not in force: a folder without manifest, a manifest under another name.
    store._write("meta", row("b", "3"), None)
    (tmp_path / "root" / ".manifest-123").write_text('{"meta": []}')
    assert store.read("meta").count() == 1
    # A number that another writer took is an error, and changes nothing.
    number, manifest = store._manifest()
    with pytest.raises(OSError, match="another writer"):
        store._put(number, {})
    assert store._manifest() == (number, manifest)
    for k in range(6):
        store.insert("meta", row(f"k{k}", "x"), ["key"])
    assert store.read("meta").count() == 7 and len(store._manifest()[1]["meta"]) == 7 and len(store._numbers()) == 3
    monkeypatch.setattr("transitnet.store.MOST_PARTS", 4)
    store.insert("meta", row("last", "x"), ["key"])
    assert store.read("meta").count() == 8 and len(store._manifest()[1]["meta"]) == 1
    for _ in range(4):
        store.set_meta("a", "9")
    assert store.meta("a") == "9" and store.read("meta").count() == 8
    for f in (tmp_path / "root").glob("manifest-*.json"):
        f.unlink()
    with pytest.raises(OSError, match="no manifest"):
        store.read("meta")


def test_statuses_are_not_sent_whole(spark, tmp_path):
    """Columns of nulls make 300,000 statuses look smaller than they are; the driver isn't to hold a table of all that was done."""
    store = Store(spark, str(tmp_path / "root"))
    done = spark.range(300_000).select(F.col("id").alias("pattern_id"), F.lit("ok").alias("status"))
    store.commit({"match_status": done})
    items = spark.range(300_010).select(F.col("id").alias("pattern_id"))
    left = work.pending(items, store.read("match_status"))
    cleared = work.retry({"match_status": store.read("match_status"), "links": items}, ["error"])["links"]
    kept = [upsert(store.read("match_status"), store.read("match_status"), ["pattern_id"], c) for c in ("ignore", "replace")]
    for df in (left, cleared, *kept):
        assert "Broadcast" not in df._jdf.queryExecution().sparkPlan().toString()
    assert sorted(r["pattern_id"] for r in left.collect()) == list(range(300_000, 300_010))
    assert store.insert("match_status", items.withColumn("status", F.lit("new")), ["pattern_id"], "ignore") == 10


def test_a_batch_is_loaded_once(spark, tmp_path):
    store, seen = Store(spark, str(tmp_path / "root")), spark.sparkContext.accumulator(0)
    items = spark.range(6).select(F.col("id").alias("pattern_id"))

    def counted(batches):
        for pdf in batches:
            seen.add(len(pdf))
            yield pdf

    def process(batch):
        links = batch.select("pattern_id", F.lit(0).alias("seq"), F.lit(5).alias("edge_id"))
        return {"match_status": batch.withColumn("status", F.lit("ok")), "pattern_edges": links, "edges": links.select("edge_id")}

    load = lambda n: work.pending(items, store.read("match_status")).orderBy("pattern_id").limit(n).mapInPandas(counted, "pattern_id long")
    assert work.run(store, load, process, 3) == 6
    assert (store.read("pattern_edges").count(), store.read("edges").count(), seen.value) == (6, 1, 6)


def test_batches_again_change_nothing(spark, tmp_path):
    store = Store(spark, str(tmp_path / "root"))
    edges = spark.createDataFrame([(7, "x"), (7, "y"), (8, "z")], "edge_id long, road_name string")
    status = spark.createDataFrame([(1, "ok")], "pattern_id long, status string")
    put = lambda status: store.insert_all({"match_status": (status, *work.CONFLICTS["match_status"]), "edges": (edges, *work.CONFLICTS["edges"])})
    assert put(status) == {"match_status": 1, "edges": 2}
    assert put(status.withColumn("status", F.lit("no_route"))) == {"match_status": 1, "edges": 0}
    assert [r["status"] for r in store.read("match_status").collect()] == ["no_route"]
    assert sorted((r["edge_id"], r["road_name"]) for r in store.read("edges").collect()) == [(7, "x"), (8, "z")]


def card(kind, **at):
    line = list(kind.ljust(80))
    for place, value in at.items():
        line[int(place[1:]) : int(place[1:]) + len(value)] = value
    return "".join(line)


CIF = [
    card("HD"),
    card("TI", c2="CRDFCEN", c18="CARDIFF CENTRAL"),
    card("BS", c2="N", c3="A00001", c9="240101", c15="241231", c21="1111100", c29="P", c30="OO", c79="P"),
    card("LO", c2="CRDFCEN", c15="0800", c19="1"),
    card("LI", c2="JUNCTON", c25="0000", c29="0000"),
    card("LI", c2="NEWPORT", c25="0000", c29="0815", c33="2"),
    card("LT", c2="BRSTLTM", c15="0845"),
    card("BS", c2="N", c3="A00001", c9="240401", c15="240430", c21="1111111", c29="P", c30="OO", c79="O"),
    card("LO", c2="CRDFCEN", c15="0805"),
    card("LT", c2="NEWPORT", c15="0820"),
    card("BS", c2="N", c3="A00001", c9="240415", c15="240416", c21="1111111", c79="C"),
    card("ZZ"),
]


def test_cif(spark, tmp_path):
    path = tmp_path / "x.cif"
    path.write_text("\n".join(CIF) + "\n")
    rows = cif.check(cif.lines(spark, str(path)))
    s = cif.schedules(rows)
    assert [(r["stp"], len(r["calls"])) for r in s.orderBy("n").collect()] == [("P", 4), ("O", 2), ("C", 0)]
    on = lambda day: [[c for c in r[0]] for r in cif.live(s, day).select(cif.calling_points(F.col("calls"))).collect()]
    assert on("2024-02-05") == [["CRDFCEN", "NEWPORT", "BRSTLTM"]]
    assert on("2024-04-08") == [["CRDFCEN", "NEWPORT"]]
    assert on("2024-04-15") == [] and on("2024-02-04") == []
    assert {tuple(r["calls"]): r["trips"] for r in cif.weekly_sequences(s).collect()} == {("CRDFCEN", "NEWPORT", "BRSTLTM"): 5, ("CRDFCEN", "NEWPORT"): 7}
    assert cif.tiplocs(rows).collect()[0]["description"] == "CARDIFF CENTRAL"
    assert cif.tiplocs_used(s).count() == 3
    for bad, why in (([card("HD"), card("QQ")], "unknown record"), ([card("BS", c2="N")], "no HD"), ([card("HD"), card("BS", c2="R")], "update")):
        path.write_text("\n".join(bad))
        with pytest.raises(ValueError, match=why):
            cif.check(cif.lines(spark, str(path)))


def test_naptan(spark, tmp_path):
    path = tmp_path / "n.csv"
    head = "ATCOCode,CommonName,Latitude,Longitude,StopType,Status\n"
    path.write_text(head + "9100CRDFCEN,Cardiff Central Rail Station,51.47,-3.17,RLY,active\n9100CRDFCEN,Again,1,1,RLY,Active\n9100OLD,Old,1,1,RLY,inactive\n9100NOWHERE,No,,,RLY,active\n5710B,Bus,1,1,BCT,active\n")
    s = naptan.stations(naptan.read(spark, str(path)))
    assert [tuple(r) for r in s.collect()] == [("CRDFCEN", "Cardiff Central Rail Station", 51.47, -3.17, "9100CRDFCEN")]
    known, unknown = naptan.resolve(spark.createDataFrame([("CRDFCEN",), ("NEWPORT",)], "tiploc string"), s)
    assert (known.count(), unknown.count()) == (1, 1)
    path.write_text(head + "5710X,Wrong,1,1,RLY,active\n")
    with pytest.raises(Exception, match="not a station"):
        naptan.stations(naptan.read(spark, str(path))).collect()


TXC = """<?xml version="1.0"?><TransXChange xmlns="http://www.transxchange.org.uk/">
<StopPoints><StopPoint><AtcoCode>A</AtcoCode><Descriptor><CommonName>Alpha</CommonName></Descriptor><Place><Location><Latitude>54.6</Latitude><Longitude>-5.9</Longitude></Location></Place></StopPoint>
<StopPoint><AtcoCode>Z</AtcoCode><Descriptor><CommonName>Zero</CommonName></Descriptor><Place><Location><Latitude>0</Latitude><Longitude>0</Longitude></Location></Place></StopPoint></StopPoints>
<JourneyPatternSections><JourneyPatternSection id="S1"><JourneyPatternTimingLink id="l1"><From><StopPointRef>A</StopPointRef></From><To><StopPointRef>B</StopPointRef></To><RunTime>PT2M30S</RunTime></JourneyPatternTimingLink></JourneyPatternSection>
<JourneyPatternSection id="S2"><JourneyPatternTimingLink id="l2"><From><StopPointRef>B</StopPointRef></From><To><StopPointRef>C</StopPointRef></To><RunTime>PT90S</RunTime></JourneyPatternTimingLink></JourneyPatternSection></JourneyPatternSections>
<Services><Service><ServiceCode>SV1</ServiceCode><RegisteredOperatorRef>O1</RegisteredOperatorRef><Lines><Line id="L1"><LineName>1a</LineName></Line></Lines>
<OperatingProfile><RegularDayType><DaysOfWeek><MondayToFriday/></DaysOfWeek></RegularDayType></OperatingProfile>
<StandardService><JourneyPattern id="JP1"><Direction>outbound</Direction><JourneyPatternSectionRefs>S1</JourneyPatternSectionRefs><JourneyPatternSectionRefs>S2</JourneyPatternSectionRefs></JourneyPattern>
<JourneyPattern id="JP2"><Direction>inbound</Direction><JourneyPatternSectionRefs>S2</JourneyPatternSectionRefs></JourneyPattern></StandardService></Service></Services>
<VehicleJourneys><VehicleJourney><VehicleJourneyCode>V1</VehicleJourneyCode><ServiceRef>SV1</ServiceRef><JourneyPatternRef>JP1</JourneyPatternRef><DepartureTime>08:00:00</DepartureTime></VehicleJourney>
<VehicleJourney><OperatingProfile><RegularDayType><DaysOfWeek><Saturday/></DaysOfWeek></RegularDayType></OperatingProfile><VehicleJourneyCode>V2</VehicleJourneyCode><ServiceRef>SV1</ServiceRef><JourneyPatternRef>JP2</JourneyPatternRef><DepartureTime>00:30:00</DepartureTime><DepartureDayShift>1</DepartureDayShift></VehicleJourney></VehicleJourneys></TransXChange>"""


def test_txc(spark, tmp_path):
    path = str(tmp_path / "t.xml")
    (tmp_path / "t.xml").write_text(TXC)
    trips = {r["trip_id"]: r for r in txc.trips(spark, path).collect()}
    assert trips["V1"]["stops"] == ["A", "B", "C"] and trips["V1"]["times"] == [28800, 28950, 29040]
    assert trips["V1"]["days"] == [1, 1, 1, 1, 1, 0, 0] and trips["V2"]["days"] == [0, 0, 0, 0, 0, 1, 0]
    assert trips["V2"]["times"] == [88200, 88290]
    assert [r["stop_id"] for r in txc.stops(spark, path).collect()] == ["A"]
    assert [tuple(r) for r in txc.routes(spark, path).collect()] == [("SV1", "O1", "1a")]
    p = lambda *xy: [{"lat": float(a), "lon": float(b)} for a, b in xy]
    hops = spark.createDataFrame([("A", "B", p((0, 0), (0, 1), (0, 2))), ("A", "B", p((0, 0), (0, 2))), ("B", "C", p((0, 2), (0, 3)))], "from_id string, to_id string, points array<struct<lat:double,lon:double>>")
    shapes = txc.stitched(txc.trips(spark, path), txc.hop_geometry(hops))
    got = {tuple(r["stops"]): [x["lon"] for x in r["points"]] for r in shapes.collect()}
    assert got == {("A", "B", "C"): [0, 2, 3], ("B", "C"): [2, 3]}
    tables = txc.gtfs_tables(txc.stops(spark, path), txc.routes(spark, path), txc.trips(spark, path), shapes)
    a, b = (txc.write_bundle(tables, str(tmp_path / n)) for n in ("a.zip", "b.zip"))
    assert open(a, "rb").read() == open(b, "rb").read()
    with zipfile.ZipFile(a) as z:
        assert z.read("stop_times.txt").decode().splitlines()[1] == "V1,08:00:00,08:00:00,A,1"
    cross = spark.createDataFrame([("k", "old", 1), ("k", "new", 2)], "key string, atco string, ordinal int")
    assert txc.crosswalk(cross).first()["atco"] == "new"


MIF = 'Version 300\nCharset "WindowsLatin1"\nDelimiter ","\nCoordSys Earth Projection 1, 0\nColumns 2\n  FROM_ID Char(8)\n  TO_ID Char(8)\nData\n\nPLINE 3\n-5.9 54.6\n-5.8 54.6\n-5.7 54.6\n    PEN (1,2,0)\nNone\nPOINT -5.9 54.6\n'


def test_mapinfo(spark, tmp_path):
    (tmp_path / "h.mif").write_text(MIF)
    (tmp_path / "h.mid").write_text('A,B\n"C",D\nE,F\n')
    rows = mapinfo.read(spark, str(tmp_path / "h.mif"), str(tmp_path / "h.mid")).orderBy("ordinal").collect()
    assert [(r["FROM_ID"], r["TO_ID"], len(r["points"])) for r in rows] == [("A", "B", 3), ("C", "D", 0), ("E", "F", 1)]
    assert rows[0]["points"][0]["lat"] == 54.6
    (tmp_path / "h.mid").write_text("A,B\n")
    with pytest.raises(ValueError, match="3 objects and 1 rows"):
        mapinfo.read(spark, str(tmp_path / "h.mif"), str(tmp_path / "h.mid"))
    (tmp_path / "h.mif").write_text(MIF.replace("None", "REGION 1"))
    with pytest.raises(ValueError, match="REGION"):
        mapinfo.read(spark, str(tmp_path / "h.mif"), str(tmp_path / "h.mid"))
