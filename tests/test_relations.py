"""Interval and lateral joins, deep trees, sorted and exact storage."""

import datetime as dt
import os
import random
import tempfile
from decimal import Decimal

import duckdb
import pytest
from pyspark.sql import functions as F

from fixtures import D, T0, warehouse
from marketlens.functions.dates import FIXED_HOLIDAYS, calendar_attributes
from marketlens.functions.money import stored_money
from marketlens.operators.deep_tree import resolve_tree, unreachable
from marketlens.operators.interval_join import interval_join
from marketlens.operators.lateral import lateral_top_k
from marketlens.plans.build import build
from marketlens.sources.inline import values, with_holidays
from marketlens.sources.sinks import append_checked, read_in_order, write_sorted, write_table


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


# ---------------------------------------------------------------- intervals
def ranges(seed=1):
    rng = random.Random(seed)
    points = [(k, rng.choice([rng.randrange(-500, 5000), 77])) for k in range(600)] + [(9999, None)]
    spans = [(k, a, a + rng.choice([0, 1, 5, 100, 4000, -3])) for k, a in ((k, rng.randrange(-600, 5000)) for k in range(150))]
    return points, spans + [(999, None, 5), (998, 3, None), (997, -10 ** 6, 10 ** 6), (996, 77, 77)]


@pytest.mark.parametrize("bits,hot", [(2, 10 ** 6), (2, 20), (4, 50), (1, 10 ** 6)])
def test_interval_join_equals_between(spark, bits, hot):
    points, spans = ranges()
    p, s = spark.createDataFrame(points, "pid int, x int").repartition(3), spark.createDataFrame(spans, "sid int, a long, b long")
    got = interval_join(p, s, "x", "a", "b", bits=bits, hot_rows=hot)
    want = sorted((i, x, j, a, b) for i, x in points for j, a, b in spans if None not in (x, a, b) and a <= x <= b)
    assert sorted(map(tuple, got.collect())) == want
    assert "NestedLoop" not in plan(got) and "Cartesian" not in plan(got)
    assert interval_join(p.limit(0), s, "x", "a", "b").count() == 0 and interval_join(p, s.limit(0), "x", "a", "b").count() == 0


@pytest.mark.parametrize("kind", ["date", "timestamp_ntz", "timestamp", "double", "decimal(10,2)"])
def test_interval_join_of_other_types(spark, kind):
    rng = random.Random(2)
    make = {"date": lambda v: dt.date(2020, 1, 1) + dt.timedelta(days=int(v)), "double": lambda v: v / 7, "decimal(10,2)": lambda v: Decimal(v) / 4}.get(
        kind, lambda v: dt.datetime(1969, 12, 30) + dt.timedelta(minutes=37 * v))
    points = [(k, k % 3, make(rng.randrange(0, 300))) for k in range(200)]
    spans = [(k, k % 3, make(a), make(a + rng.choice([0, 1, 60, 250, -1]))) for k, a in ((k, rng.randrange(300)) for k in range(40))]
    p = spark.createDataFrame(points, f"pid int, g int, x {kind}")
    s = spark.createDataFrame(spans, f"sid int, g int, a {kind}, b {kind}")
    units = {"date": [None], "double": [None, 0.01, 100], "decimal(10,2)": [None, 0.25]}.get(kind, [None, 60e6, 3.6e9])
    want = sorted((i, j) for i, g, x in points for j, h, a, b in spans if g == h and a <= x <= b)
    for unit in units:
        got = interval_join(p, s, "x", "a", "b", on=["g"], unit=unit)
        assert got.columns == ["pid", "g", "x", "sid", "a", "b"]
        assert sorted((r.pid, r.sid) for r in got.collect()) == want
    with pytest.raises(ValueError, match="both sides"):
        interval_join(p, s, "x", "a", "b")
    with pytest.raises(TypeError):
        interval_join(p.withColumn("x", F.lit("a")), s, "x", "a", "b", on=["g"])


# ------------------------------------------------------------------ lateral
@pytest.mark.parametrize("k", [1, 2, 5])
def test_lateral_top_k_equals_sql(spark, k):
    rng = random.Random(k)
    outer = [(i, f"n{i}") for i in range(30)] + [(None, "none"), (3, "twice")]
    inner = [(rng.choice([7, rng.randrange(25), None]), rng.randrange(10), n) for n in range(400)]
    o, i = spark.createDataFrame(outer, "k int, n string"), spark.createDataFrame(inner, "kk int, v int, id int")
    con = duckdb.connect()
    con.register("o", o.toPandas().astype({"k": "Int64"}))
    con.register("i", i.toPandas().astype({"kk": "Int64"}))
    for left in (True, False):
        got = lateral_top_k(o, i, [("k", "kk")], [F.col("v"), F.col("id")], k, left=left)
        want = con.sql(f"select o.k, n, x.kk, v, id from o {'left' if left else ''} join lateral (select * from i where i.kk = o.k "
                       f"order by v, id limit {k}) x on true").fetchall()
        assert sorted(map(tuple, got.collect()), key=str) == sorted(want, key=str)
        assert "WindowGroupLimit" in plan(got) and "NestedLoop" not in plan(got)
    filled = lateral_top_k(o, i, [("k", "kk")], [F.col("v"), F.col("id")], k, fallback={"id": -F.col("k")})
    assert {(r.k, r.id) for r in filled.collect() if r.kk is None} == {(r[0], None if r[0] is None else -r[0]) for r in want_missing(outer, inner)}


def want_missing(outer, inner):
    known = {r[0] for r in inner}
    return [r for r in outer if r[0] is None or r[0] not in known]


# --------------------------------------------------------------- deep trees
def test_chain_of_100000_nodes(spark):
    n = 100_000
    nodes = spark.range(n).selectExpr("id", "if(id = 0, null, id - 1) as parent")
    got = resolve_tree(nodes, id_col="id", parent_col="parent")
    assert got.where((F.col("depth") != F.col("id")) | (F.col("root_id") != 0) | (F.col("state") != "rooted")).count() == 0
    assert got.count() == n


def test_orphans_and_cycles_are_told_apart(spark):
    nodes = [(1, None), (2, 1), (3, 2), (4, 99), (5, 4), (6, 5), (10, 11), (11, 12), (12, 10), (13, 12), (14, 14), (20, None)]
    frame = spark.createDataFrame(nodes, "id long, parent long")
    got = {r.id: (r.root_id, r.depth, r.state) for r in resolve_tree(frame, id_col="id", parent_col="parent").collect()}
    assert got == {1: (1, 0, "rooted"), 2: (1, 1, "rooted"), 3: (1, 2, "rooted"), 20: (20, 0, "rooted"),
                   **{k: (None, None, "orphan") for k in (4, 5, 6)}, **{k: (None, None, "cycle") for k in (10, 11, 12, 13, 14)}}
    assert {(r.id, r.reason) for r in unreachable(frame, id_col="id", parent_col="parent").collect()} == \
        {(k, v[2]) for k, v in got.items() if v[2] != "rooted"}
    assert resolve_tree(frame.limit(0), id_col="id", parent_col="parent").count() == 0
    with pytest.raises(ValueError, match="null or repeated"):
        resolve_tree(frame.unionByName(frame.limit(1)), id_col="id", parent_col="parent")


# ------------------------------------------------------------------ storage
def test_sorted_table_is_in_order_across_files(spark):
    rng = random.Random(3)
    rows = [(rng.choice(["a", "b", None]), rng.randrange(40), k) for k in range(5000)]
    path = tempfile.mkdtemp(prefix="sorted-") + "/t"
    frame = spark.createDataFrame(rows, "g string, v int, id int").repartition(6)
    order = [F.col("g").asc_nulls_last(), F.col("v").desc(), F.col("id")]
    write_sorted(frame, path, order, files=5)
    files = sorted(f for f in os.listdir(path) if f.endswith(".parquet"))
    assert len(files) > 1
    want = sorted(rows, key=lambda r: (r[0] is None, r[0] or "", -r[1], r[2]))
    import pyarrow.parquet as pq
    in_files = [tuple(r.values()) for f in files for r in pq.read_table(f"{path}/{f}").to_pylist()]
    assert in_files == want
    back = {r.position: (r.g, r.v, r.id) for r in read_in_order(spark, path).collect()}
    assert [back[n] for n in range(1, len(rows) + 1)] == want


def test_amounts_are_stored_exactly(spark):
    wh = warehouse(spark, orders=[dict(id=1, user_id=1, created_at=T0)],
                   order_line_items=[dict(id=k, order_id=1, product_id=1, sku_id=1, quantity=1, line_total=D("9999999999.99")) for k in range(3)])
    wh.exact = True
    daily = wh.revenue_daily()
    assert daily.schema["total_revenue"].dataType.simpleString() == "decimal(24,2)"
    path = tempfile.mkdtemp(prefix="exact-") + "/t"
    write_table(daily, path)
    append_checked(daily, path)
    assert spark.read.parquet(path).agg(F.sum("total_revenue")).first()[0] == D("59999999999.94")
    for wrong in (daily.withColumn("total_revenue", F.col("total_revenue").cast("double")), daily.drop("total_orders"),
                  daily.withColumn("more", F.lit(1)), daily.withColumn("total_revenue", F.col("total_revenue").cast("decimal(20,2)"))):
        with pytest.raises(ValueError, match="append"):
            append_checked(wrong, path)
    assert spark.read.parquet(path).count() == 2
    with pytest.raises(Exception, match="too large"):
        spark.range(1).select(stored_money(F.lit("1" + "0" * 30).cast("decimal(38,0)"))).collect()


def test_build_stores_decimals(spark):
    sf = "/root/testdata/sf0.001"
    names = ["int_revenue_daily", "rep_category_performance"]
    exact = build(spark, sf, tempfile.mkdtemp(prefix="build-"), models=names, exact=True)
    plain = build(spark, sf, tempfile.mkdtemp(prefix="build-"), models=names)
    for name in names:
        a, b = spark.read.parquet(exact[name]), spark.read.parquet(plain[name])
        assert a.schema["total_revenue"].dataType.simpleString() == "decimal(24,2)" and a.columns == b.columns
        assert b.schema["total_revenue"].dataType.simpleString() == "double"
        key = a.columns[0]
        assert sorted((r[key], float(r.total_revenue)) for r in a.collect()) == sorted((r[key], r.total_revenue) for r in b.collect())


# ------------------------------------------------------------------- inline
def test_values_relation(spark):
    rows = [(1, "a'b", dt.date(2020, 1, 2)), (None, None, None), (3, "x", dt.date(1999, 1, 1))]
    got = values(spark, rows, "n long, `s t` string, d date")
    assert [tuple(r) for r in got.collect()] == rows and [f.dataType.simpleString() for f in got.schema.fields] == ["bigint", "string", "date"]
    assert values(spark, [], "n long").count() == 0


def test_holidays_by_join(spark):
    days = spark.sql("select explode(sequence(date'2023-12-20', date'2025-01-10')) as d").unionByName(spark.sql("select cast(null as date) as d"))
    got = {r.d: (r.is_greek_public_holiday, r.greek_public_holiday_name) for r in with_holidays(days, "d").collect()}
    want = {r.d: (r.is_greek_public_holiday, r.greek_public_holiday_name) for r in days.select("d", *calendar_attributes("d")).collect()}
    assert got == want and len(got) == days.count()
    many = [(1 + k % 12, 1 + k % 28, f"h{k}") for k in range(500)] + FIXED_HOLIDAYS
    named = with_holidays(days, "d", many)
    assert named.count() == days.count() and named.where("is_greek_public_holiday").count() > 80
    assert with_holidays(days, "d", []).where("is_greek_public_holiday").count() == 0
