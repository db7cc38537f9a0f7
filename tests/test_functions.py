import math

import pytest
from pyspark.sql import functions as F

from transitnet.functions import arrays, geo, ids, scale, text, times


def one(spark, *columns):
    row = spark.range(1).select(*columns).first()
    return row[0] if len(columns) == 1 else tuple(row)


def test_names(spark):
    cases = {
        "King's Cross St. Pancras Underground Station": "kings cross st pancras",
        "Lewisham DLR Station": "lewisham",
        "Canary Wharf Platforms 5 & 6": "canary wharf",
        "Shepherd's Bush (Central)": "shepherds bush central",
        "Station": "station",
        "Bank": "bank",
        None: "",
    }
    for name, expected in cases.items():
        assert one(spark, text.normalise(F.lit(name).cast("string"))) == expected
    assert one(spark, text.spellings(F.lit("Edgware Road (Bakerloo)"))) == ["edgware road bakerloo", "edgware road"]
    assert one(spark, text.operator_key(F.lit("Iarnród Éireann"))) == "iarnrod eireann"
    mine, others = ["iarnrod eireann"], ["ni railways"]
    for tag, ours in (("NI Railways; Iarnród Éireann", False), ("Iarnród Éireann/NI Railways", True), ("Somebody", True), (None, True), ("NI Railways", False)):
        assert one(spark, text.claimed(F.lit(tag).cast("string"), mine, others)) is ours
    assert one(spark, text.display_name(F.lit("  "), F.lit("R1"))) == "R1"


def test_times(spark):
    for raw, seconds in (("PT2M30S", 150), ("PT90S", 90), ("P1DT1H", 90_000), ("nonsense", 0), ("", 0)):
        assert one(spark, times.iso_seconds(F.lit(raw))) == seconds
    assert one(spark, times.departure_seconds(F.lit("00:10:00"), F.lit("1"))) == 87_000
    assert one(spark, times.hhmmss(F.lit(90_061))) == "25:01:01"
    days = lambda names: one(spark, times.week(F.array(*map(F.lit, names)) if names is not None else F.lit(None).cast("array<string>"), F.lit(True)))
    assert days(None) == [1, 1, 1, 1, 1, 0, 0]
    assert days(["Saturday"]) == [0, 0, 0, 0, 0, 1, 0]
    assert days(["MondayToThursday", "Weekend"]) == [1, 1, 1, 1, 0, 1, 1]
    assert days(["Fullmoon"]) == [1, 1, 1, 1, 1, 0, 0]
    assert str(one(spark, times.cif_date(F.lit("240229")))) == "2024-02-29"
    assert str(one(spark, times.cif_date(F.lit("600101")))) == "1960-01-01"
    assert str(one(spark, times.cif_date(F.lit("999999")))) == "9999-12-31"
    with pytest.raises(Exception, match="not a YYMMDD date"):
        one(spark, times.cif_date(F.lit("24021x")))
    assert [one(spark, times.cif_public(F.lit(x))) for x in ("0000", "    ", "0915")] == [False, False, True]


def test_geometry(spark):
    a, b = (51.5, -0.1), (53.4, -2.2)
    h = one(spark, geo.haversine_m(*(F.lit(v) for v in (*a, *b))))
    p = [math.radians(v) for v in (*a, *b)]
    x = math.sin((p[2] - p[0]) / 2) ** 2 + math.cos(p[0]) * math.cos(p[2]) * math.sin((p[3] - p[1]) / 2) ** 2
    assert h == pytest.approx(2 * 6_371_000 * math.asin(math.sqrt(x)))
    inside = {"Land's End": (50.07, -5.71), "Lowestoft": (52.48, 1.75), "Unst": (60.8, -0.8), "Dover": (51.13, 1.31)}
    outside = {"Calais": (50.97, 1.81), "Brest": (48.39, -4.49), "Warsaw": (52.23, 20.96), "Faroes": (62.0, -6.8), "Alderney": (49.71, -2.2)}
    for places, expected in ((inside, True), (outside, False)):
        for lat, lon in places.values():
            assert one(spark, geo.in_isles(F.lit(lat), F.lit(lon))) is expected
    mx, my = geo.mercator(F.lit(51.5), F.lit(-0.1))
    assert one(spark, *geo.mercator_inverse(mx, my)) == pytest.approx((51.5, -0.1))
    assert one(spark, geo.morton(F.lit(5), F.lit(3))) == 0b011011
    assert geo.parse_window("-3.3,51.4,-3.1,51.6") == (-3.3, 51.4, -3.1, 51.6)
    assert geo.parse_window("cardiff", {"cardiff": (1, 2, 3, 4)}) == (1, 2, 3, 4)
    for bad in ("1,2,3", "nowhere", "3,2,1,4"):
        with pytest.raises(ValueError):
            geo.parse_window(bad)
    assert geo.pad_and_clip((-20, 40, 10, 70), 0.1) == (-11.0, 49.8, 2.0, 61.1)
    with pytest.raises(Exception, match="differ in length"):
        one(spark, geo.same_length(F.array(F.lit(1)), F.array(F.lit(1), F.lit(2))))


def test_arrays(spark):
    a = lambda *x: F.array(*map(F.lit, x))
    assert one(spark, arrays.consecutive_distinct(a("x", "x", "y", "x"))) == ["x", "y", "x"]
    assert one(spark, arrays.occurrences(a(1, 2, 1, 2, 3), a(1, 2))) == [0, 2]
    assert one(spark, arrays.occurrences(a(1), a(1, 2))) == []
    assert one(spark, arrays.thinned(F.sequence(F.lit(1), F.lit(100)), 11)) == [*range(1, 101, 10), 100]
    assert one(spark, arrays.canonical(a(3, 1, 2))) == [2, 1, 3]
    assert one(spark, arrays.kept_vertices(a(0, 5, 6, 40, 41), a(0, 0, 0, 0, 0), F.lit(10))) == [0, 3, 4]
    run = one(spark, arrays.cumulative_m(a(0, 1000, 2000), a(0, 0, 0)))
    assert run == pytest.approx([0, 111.32, 222.64])
    points = [(38.5, -120.2), (40.7, -120.95), (43.252, -126.453)]
    assert arrays.encode_polyline(points, 5) == "_p~iF~ps|U_ulLnnqC_mqNvxq`@"
    assert arrays.decode_polyline("_p~iF~ps|U_ulLnnqC_mqNvxq`@", 5) == points
    with pytest.raises(ValueError):
        arrays.decode_polyline("_p~iF~ps|U_")


def test_ids(spark):
    df = spark.createDataFrame([(k, f"r{k}") for k in range(50)], "id long, r string")
    got = df.select(ids.pattern_id(F.col("r"), F.lit(None).cast("int"), F.array(F.lit("a"), F.lit("b"))).alias("k"), "r").collect()
    import hashlib

    assert all(r["k"] == int(hashlib.md5(f"{r['r']}||a>b".encode()).hexdigest()[:15], 16) for r in got)
    with pytest.raises(ValueError, match="collision"):
        ids.check_unique(df.withColumn("k", F.lit(1)), "k", ["r"])
    u = df.select(ids.unit(F.col("id"), "s").alias("u")).agg(F.min("u"), F.max("u")).first()
    assert 0 <= u[0] < u[1] < 1
    assert one(spark, scale.scaled(F.lit(5.0), F.lit(7.0), F.lit(7.0))) == 0.5
    assert scale.blend([(0, (0, 0, 0)), (1, (100, 200, 50))], 0.5) == (50, 100, 25)
