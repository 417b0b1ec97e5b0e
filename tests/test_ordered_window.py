"""The distributed ordered window must equal the single-task window."""

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from marketlens.operators.ordered_window import Order, ordered_window, plain_window

KW = dict(row_number="rn", dense_rank="dr", lag={"prev_v": "v"}, lead={"next_v": "v"},
          running_sum={"cum_v": "v"})


def _rows(df, cols):
    return sorted(tuple(r) for r in df.select(*cols).collect())


def _compare(spark, data, n, partition_by=(), schema="k long, g long, v decimal(12,2)"):
    df = spark.createDataFrame(data, schema)
    order = [Order("v", desc=True), Order("k")]
    got = ordered_window(df, order, partition_by=partition_by, num_buckets=n, materialize=False, **KW)
    want = plain_window(df, order, partition_by=partition_by, **KW)
    cols = ["k", "g", "v", "rn", "dr", "prev_v", "next_v", "cum_v"]
    assert _rows(got, cols) == _rows(want, cols)


def _data(num, distinct, with_nulls=False, hot_group=False, null_group=False):
    out = []
    for i in range(num):
        v = None if with_nulls and i % 13 == 0 else Decimal(((i * 7919) % distinct)) / 4
        g = 0 if hot_group and i % 3 != 0 else i % 5
        if null_group and i % 4 == 0:
            g = None
        out.append((i, g, v))
    return out


@pytest.mark.parametrize("n", [1, 4, 50])
def test_global_ties(spark, n):
    _compare(spark, _data(400, 37), n)


@pytest.mark.parametrize("n", [4, 50])
def test_global_nulls(spark, n):
    _compare(spark, _data(300, 11, with_nulls=True), n)


def test_all_equal(spark):
    _compare(spark, [(i, 0, Decimal("5.00")) for i in range(200)], 8)


@pytest.mark.parametrize("n", [1, 6, 40])
def test_partitioned_hot_key(spark, n):
    _compare(spark, _data(600, 23, with_nulls=True, hot_group=True), n, partition_by=["g"])


@pytest.mark.parametrize("n", [5, 30])
def test_partitioned_null_key_spanning_buckets(spark, n):
    _compare(spark, _data(500, 19, with_nulls=True, null_group=True), n, partition_by=["g"])


def test_timestamp_ntz_order_column(spark):
    import datetime as dt
    base = dt.datetime(2024, 3, 31, 23, 0, 0)
    data = [(i, i % 4, base + dt.timedelta(minutes=37 * (i % 50))) for i in range(300)]
    df = spark.createDataFrame(data, "k long, g long, ts timestamp_ntz")
    order = [Order("ts"), Order("k")]
    kw = dict(row_number="rn", lag={"prev_ts": "ts"}, lead={"next_ts": "ts"})
    got = ordered_window(df, order, partition_by=["g"], num_buckets=9, materialize=False, **kw)
    want = plain_window(df, order, partition_by=["g"], **kw)
    cols = ["k", "rn", "prev_ts", "next_ts"]
    assert _rows(got, cols) == _rows(want, cols)


def test_empty_input(spark):
    df = spark.createDataFrame([], "k long, g long, v decimal(12,2)")
    out = ordered_window(df, [Order("v", True), Order("k")], num_buckets=4, materialize=False, **KW)
    assert out.count() == 0


def test_hot_value_is_split_across_buckets(spark):
    data = [(i, 0, Decimal("0.00") if i % 3 else Decimal(i)) for i in range(3000)]
    df = spark.createDataFrame(data, "k long, g long, v decimal(12,2)")
    out = ordered_window(df, [Order("v", True), Order("k")], num_buckets=8, materialize=True,
                         dense_rank="dr", row_number="rn")
    # the zero value (two thirds of the rows) must still rank densely
    assert out.filter(F.col("v") == 0).select("dr").distinct().count() == 1
    assert out.agg(F.max("rn")).first()[0] == 3000


def test_mixed_types_nan_and_nulls_in_the_order(spark):
    import random

    rnd = random.Random(3)
    words = ["a", "B", "ä", "zz", "Z", "", None, "ab", "é", "𝔘", "it's", "back\\slash"]
    data = [(rnd.choice([None, float("nan"), -1.5, 0.0, 2.25, 1e9]), rnd.choice(words), i) for i in range(400)]
    df = spark.createDataFrame(data, "x double, s string, k long")
    kw = dict(row_number="rn", dense_rank="dr", lag={"p": "s"}, lead={"q": "s"})
    for order in ([Order("x", True), Order("s"), Order("k")], [Order("s", True), Order("x"), Order("k", True)]):
        got = ordered_window(df, order, num_buckets=16, materialize=False, **kw)
        want = plain_window(df, order, **kw)
        rows = [{r["k"]: tuple(r)[3:] for r in f.select("x", "s", "k", "rn", "dr", "p", "q").collect()} for f in (got, want)]
        assert rows[0] == rows[1]


@pytest.mark.parametrize("n", [64, 1024, 4096])
def test_many_buckets(spark, n):
    _compare(spark, _data(3000, 101, with_nulls=True), n)


def test_many_buckets_per_key(spark):
    _compare(spark, _data(2000, 23, with_nulls=True, hot_group=True, null_group=True), 1024, partition_by=["g"])


def test_buckets_grow_with_the_rows(spark):
    df = spark.createDataFrame(_data(3000, 500), "k long, g long, v decimal(12,2)")
    out = ordered_window(df, [Order("v"), Order("k")], row_number="rn", target_rows_per_bucket=10, bucket_col="b")
    assert out.select("b").distinct().count() > 200
    assert out.agg(F.max("rn"), F.countDistinct("rn")).first()[:] == (3000, 3000)


def test_running_sum_keeps_the_type_of_the_plain_window(spark):
    df = spark.createDataFrame(_data(50, 7), "k long, g long, v decimal(12,2)")
    order = [Order("v"), Order("k")]
    got = ordered_window(df, order, num_buckets=5, running_sum={"c": "v"})
    assert got.schema["c"].dataType == plain_window(df, order, running_sum={"c": "v"}).schema["c"].dataType


def test_hot_partition_key_spread_over_buckets(spark):
    # user 0 owns a third of the rows
    data = [(i, 0 if i % 3 == 0 else i % 97 + 1, Decimal(i % 11)) for i in range(3000)]
    df = spark.createDataFrame(data, "k long, g long, v decimal(12,2)")
    out = ordered_window(df, [Order("v"), Order("k")], partition_by=["g"], num_buckets=12, materialize=False,
                         row_number="rn", lag={"p": "v"}, bucket_col="b")
    hot = out.filter(F.col("g") == 0)
    assert hot.select("b").distinct().count() >= 3
    sizes = [r["count"] for r in out.groupBy("b").count().collect()]
    assert max(sizes) <= 2 * 3000 / 12
    assert hot.agg(F.max("rn")).first()[0] == 1000


def test_buckets_by_default_fit_a_task(spark):
    df = spark.range(1_200_000).select(F.col("id").alias("k"), (F.col("id") * 7919 % 1000).alias("v"))
    out = ordered_window(df, [Order("v"), Order("k")], row_number="rn", dense_rank="dr", bucket_col="b")
    assert out.groupBy("b").count().agg(F.max("count")).first()[0] <= 600_000
    assert out.agg(F.max("rn"), F.countDistinct("rn"), F.max("dr")).first()[:] == (1_200_000, 1_200_000, 1000)


def test_rows_move_to_their_bucket_in_one_shuffle(spark):
    from marketlens.operators.ordered_window import _bucketed_window
    df = spark.createDataFrame(_data(300, 11, with_nulls=True), "k long, g long, v decimal(12,2)")
    cut = _bucketed_window(df, [Order("v", desc=True), Order("k")], [], ["v"], 4, 300, {}, {}, {})
    plan = cut._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") - plan.count("BroadcastExchange") == 1
    sizes = [r["count"] for r in cut.groupBy("_ow_bucket").count().collect()]
    assert len(sizes) == 4 and max(sizes) < 100
