"""Every registered query of the library against its SQL, on the smallest tables."""

import math

import duckdb
import pytest

from transitnet.operators import tracing
from transitnet.plans import catalog

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"


@pytest.fixture(scope="module")
def duck(sf):
    c = duckdb.connect()
    for t in TABLES.split():
        c.execute(f"create view {t} as select * from '{sf}/{t}.parquet'")
    return c


def rows(values, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(repr(float(r[i])) if isinstance(r[i], float) or type(r[i]).__name__ == "Decimal" else repr(r[i]) for i in order) for r in values)


@pytest.mark.parametrize("name", sorted(catalog.queries()))
def test_query(spark, duck, sf, name):
    df = catalog.queries()[name](spark, sf)
    got = [tuple(r) for r in df.collect()]
    if sql := catalog.oracle_sql().get(name):
        out = duck.execute(sql)
        columns = [c[0] for c in out.description]
        assert sorted(columns) == sorted(df.columns)
        assert rows(got, df.columns) == rows(out.fetchall(), columns)
    else:
        assert got


def test_pruned_ways_of_all_lines(spark, tmp_path):
    spark.createDataFrame([(k,) for k in range(1, 5)], "s_suppkey long").write.parquet(str(tmp_path / "supplier.parquet"))
    spark.createDataFrame([(51, 1), (52, 2), (52, 2), (100, 3)], "l_orderkey long, l_suppkey long").write.parquet(str(tmp_path / "lineitem.parquet"))
    assert sorted(r["way_id"] for r in catalog.queries()["pruned_ways"](spark, str(tmp_path)).collect()) == [1, 2, 3]


def test_snapped_polylines_by_brute_force(spark, tmp_path):
    keys = [*range(1, 60, 2), 2, 4, 80, 82, 1601, 1602, 1603]
    spark.createDataFrame([(k, "Brand") for k in keys], "p_partkey long, p_brand string").write.parquet(str(tmp_path / "part.parquet"))
    ends = lambda k: [(k % 40 * 100.0, k // 40 % 40 * 100.0), ((k % 40 + (k % 2 == 0)) * 100.0, (k // 40 % 40 + (k % 2 == 1)) * 100.0)]

    def gap(x, y, way):
        (ax, ay), (bx, by) = ends(way)
        t = max(0.0, min(1.0, ((x - ax) * (bx - ax) + (y - ay) * (by - ay)) / 10000.0))
        return math.hypot(x - ax - t * (bx - ax), y - ay - t * (by - ay))

    expected = {}
    for k in keys:
        now, ways, missed = None, [], False
        for j, (x, y) in enumerate(ends(k)):
            near = sorted((gap(x, y + 5, w), w) for w in keys if gap(x, y + 5, w) <= tracing.SNAP_M)
            missed = missed or (j == 1 and not near)
            if near:
                own = {w: d for d, w in near}
                now = now if now in own and own[now] <= near[0][0] + tracing.STICK_M else near[0][1]
                ways += [now] if now not in ways else []
        expected[k] = ("uncovered", "", 0.0) if missed else ("ok", ",".join(map(str, ways)), 1.0)
    got = {r["pattern_id"]: (r["status"], r["ways"], r["covered"]) for r in catalog.queries()["snapped_polylines"](spark, str(tmp_path)).collect()}
    assert got == expected


def test_entry(spark, sf):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0
    assert set(e.oracle_sql()) <= set(e.queries())
