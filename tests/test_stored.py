"""Stored tables that go on: history, keyed updates and inserts, catalog."""

import datetime as dt
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from fixtures import frame
from marketlens.functions.dates import ts_ntz
from marketlens.operators.keyed import insert_skip_conflict, update_from
from marketlens.operators.scd2 import scd2_apply
from marketlens.plans.build import build
from marketlens.plans.jobs import ADDRESS_CHECK_COLS
from marketlens.sources import history as hist
from marketlens.sources.keyed_tables import insert_stored, update_stored
from marketlens.sources.sinks import write_table

SF = "/root/testdata/sf0.001"
AS_OF = ["2024-02-01 00:00:00", "2024-03-01 00:00:00", "2024-04-01 00:00:00"]


def files(path):
    """Every data file with the time of its last change."""
    return {os.path.relpath(os.path.join(d, f), path): os.stat(os.path.join(d, f)).st_mtime_ns
            for d, _, names in os.walk(path) for f in names if f.endswith(".parquet")}


def extracts(spark):
    first = [dict(id=k) for k in range(1, 61)]
    second = [dict(id=k) for k in range(1, 61) if k != 5]
    second[1] = dict(id=2, city="Patras")
    second[2] = dict(id=3, created_at=dt.datetime(2024, 2, 2))  # no checked column
    return [frame(spark, "addresses", rows) for rows in (first, second, second + [dict(id=5), dict(id=99)])]


def rows(df):
    return sorted(map(str, df.select("id", "city", "created_at", "valid_from", "valid_to", "version_id").collect()))


def replay(frames, times):
    out = None
    for f, a in zip(frames, times):
        out = scd2_apply(out, f, "id", ADDRESS_CHECK_COLS, ts_ntz(a))
    return out


def test_history_goes_on_and_writes_only_what_changes(spark):
    path = tempfile.mkdtemp(prefix="hist-") + "/h"
    frames = extracts(spark)
    def run(k, as_of=None):
        return hist.apply_extract(spark, path, frames[k], "id", ADDRESS_CHECK_COLS, as_of or AS_OF[k], buckets=8)
    assert hist.runs(spark, path) is None and run(0)
    first = files(path)
    assert run(1) and rows(hist.history(spark, path)) == rows(replay(frames[:2], AS_OF))
    second = files(path)
    kept = {f for f in first if f in second and first[f] == second[f]}
    changed_buckets = {f.split("/")[1] for f in first if f.startswith("state=open") and f not in kept}
    assert 1 <= len(changed_buckets) <= 2  # of ids 2 and 5
    assert run(2) and rows(hist.history(spark, path)) == rows(replay(frames, AS_OF))
    third = files(path)
    assert all(third[f] == t for f, t in second.items() if f.startswith("state=closed"))  # never written again
    assert not run(2) and not run(0) and files(path) == third  # applied before
    assert run(2, "2024-05-01") and {f for f in files(path) if f not in third} == {f for f in files(path) if f.startswith("_runs")} - set(third)
    assert rows(hist.open_versions(spark, path)) == rows(hist.history(spark, path).where("valid_to is null"))
    assert [tuple(r) for r in hist.runs(spark, path).orderBy("run").select("closed", "opened").collect()] == [(0, 60), (2, 1), (0, 2), (0, 0)]


def test_a_run_broken_off_is_completed(spark, monkeypatch):
    frames = extracts(spark)
    for fails_at in (1, 2):  # after the closed versions, after the buckets
        path = tempfile.mkdtemp(prefix="hist-") + "/h"
        hist.apply_extract(spark, path, frames[0], "id", ADDRESS_CHECK_COLS, AS_OF[0], buckets=4)
        calls = []
        real = hist._partitioned

        def broken(versions, where, mode):
            real(versions, where, mode)
            calls.append(mode)
            if len(calls) == fails_at:
                raise RuntimeError("lost")

        monkeypatch.setattr(hist, "_partitioned", broken)
        with pytest.raises(RuntimeError):
            hist.apply_extract(spark, path, frames[1], "id", ADDRESS_CHECK_COLS, AS_OF[1])
        monkeypatch.setattr(hist, "_partitioned", real)
        assert hist.apply_extract(spark, path, frames[1], "id", ADDRESS_CHECK_COLS, AS_OF[1])
        assert rows(hist.history(spark, path)) == rows(replay(frames[:2], AS_OF))


def test_history_of_an_emptied_source_and_of_bad_extracts(spark):
    path = tempfile.mkdtemp(prefix="hist-") + "/h"
    full = extracts(spark)[0]
    def run(f, as_of):
        return hist.apply_extract(spark, path, f, "id", ADDRESS_CHECK_COLS, as_of, buckets=4)
    run(full, AS_OF[0])
    for bad in (full.unionByName(full.limit(1)), full.withColumn("id", F.lit(None).cast("long"))):
        with pytest.raises(ValueError, match="null or repeated"):
            run(bad, AS_OF[1])
    with pytest.raises(ValueError, match="columns"):
        run(full.drop("city"), AS_OF[1])
    run(full.limit(0), AS_OF[1])
    assert hist.open_versions(spark, path).count() == 0 and hist.history(spark, path).count() == 60
    run(full, AS_OF[2])
    assert hist.open_versions(spark, path).count() == 60 and hist.history(spark, path).count() == 120


def orders_table(spark, path):
    orders = spark.range(1000).selectExpr("id as k", "cast(id % 10 as int) as month", "cast(id as double) as amount", "'old' as state")
    write_table(orders, path, partition_by=["month"])
    return spark.read.parquet(path)


def test_update_rewrites_changed_partitions_only(spark):
    path = tempfile.mkdtemp(prefix="upd-") + "/t"
    before = orders_table(spark, path)
    # ids 3, 13, ... of month 3; id 7 gets the value it has; 5000 is unknown
    source = spark.createDataFrame([(k, float(-k)) for k in range(3, 100, 10)] + [(7, 7.0), (5000, 1.0)], "k long, v double")
    want = sorted(map(tuple, update_from(before, source, ["k"], {"amount": F.col("s.v")}).collect()))
    old = files(path)
    assert update_stored(spark, path, source, ["k"], {"amount": F.col("s.v")}, ["month"]) == [(3,)]
    new = files(path)
    assert sorted(map(tuple, spark.read.parquet(path).select(before.columns).collect())) == want
    assert {f for f in old if not f.startswith("month=3")} == {f for f in new if not f.startswith("month=3")}
    assert all(old[f] == new[f] for f in new if not f.startswith("month=3")) and not {f for f in old if f.startswith("month=3")} & set(new)
    assert update_stored(spark, path, source, ["k"], {"amount": F.col("s.v")}, ["month"]) == [] and files(path) == new  # again
    with pytest.raises(Exception, match="several source rows"):
        update_stored(spark, path, source.unionByName(source), ["k"], {"amount": F.col("s.v")}, ["month"])
    with pytest.raises(ValueError, match="partition"):
        update_stored(spark, path, source, ["k"], {"month": F.lit(1)}, ["month"])


def test_update_of_null_partitions(spark):
    path = tempfile.mkdtemp(prefix="upd-") + "/t"
    table = spark.createDataFrame([(1, None, "a", 1), (2, "x", "a", 1), (3, "x", "b", 1), (4, None, None, 1)], "k int, p string, q string, v int")
    write_table(table, path, partition_by=["p", "q"])
    source = spark.createDataFrame([(1, 9), (3, 9), (4, 9)], "k int, v int")
    touched = update_stored(spark, path, source, ["k"], {"v": F.col("s.v")}, ["p", "q"])
    assert sorted(touched, key=str) == sorted([(None, "a"), ("x", "b"), (None, None)], key=str)
    got = spark.read.parquet(path).select("k", "p", "q", "v").collect()
    assert sorted(map(tuple, got), key=str) == sorted([(1, None, "a", 9), (2, "x", "a", 1), (3, "x", "b", 9), (4, None, None, 9)], key=str)


def test_insert_appends_only(spark):
    path = tempfile.mkdtemp(prefix="ins-") + "/t"
    before = orders_table(spark, path)
    incoming = spark.createDataFrame([(3, 3, 0.5, "new"), (2000, 4, 2.0, "late"), (2000, 4, 1.0, "early"), (2001, 11, 1.0, "month")],
                                     "k long, month int, amount double, state string")
    want = sorted(map(tuple, before.unionByName(insert_skip_conflict(before, incoming.select(before.columns), ["k"], ["amount"])).collect()))
    old = files(path)
    insert_stored(spark, path, incoming, ["k"], ["amount"], ["month"])
    new = files(path)
    assert all(new[f] == t for f, t in old.items()) and {f.split("/")[0] for f in set(new) - set(old)} == {"month=4", "month=11"}
    assert sorted(map(tuple, spark.read.parquet(path).select(before.columns).collect())) == want
    insert_stored(spark, path, incoming, ["k"], ["amount"], ["month"])
    assert spark.read.parquet(path).count() == len(want)
    insert_stored(spark, path, incoming.withColumn("k", F.lit(3000)).limit(1), ["month", "k"], ["amount"], ["month"])
    assert spark.read.parquet(path).count() == len(want) + 1


def test_build_continues_the_history_and_is_read_by_name(spark):
    target = tempfile.mkdtemp(prefix="build-")
    schemas = {"intermediate": "t_intermediate", "historical": "t_historical", "current_views": "t_current"}
    models = ["int_revenue_daily", "addresses_hist", "dim_addresses_current"]
    def run(extracts):
        return build(spark, SF, target, custom_schemas=schemas, models=models, extracts=extracts, catalog=True)
    out = run([1])
    assert out["dim_addresses_current"] == "t_current.dim_addresses_current"
    assert out["int_revenue_daily"] == f"{target}/t_intermediate/int_revenue_daily"
    path = out["addresses_hist"]
    first = hist.history(spark, path).count()
    run([2])
    extended = hist.history(spark, path)
    assert extended.where("valid_to is not null").count() > 0 and extended.count() > first
    same = files(path)
    run([2])
    assert files(path) == same
    run(None)
    want = build(spark, SF, tempfile.mkdtemp(prefix="build-"), models=["addresses_hist"])["addresses_hist"]
    other = spark.newSession()  # by name
    got = other.table("t_current.dim_addresses_current")
    assert sorted(map(str, got.collect())) == sorted(map(str, hist.open_versions(spark, want).select(got.columns).collect()))
    assert other.table("t_intermediate.int_revenue_daily").count() == spark.read.parquet(out["int_revenue_daily"]).count()
    assert "state=closed" not in str(got.inputFiles()) and got.inputFiles()
    assert [r.viewName for r in other.sql("show views in t_current").collect()] == ["dim_addresses_current"]
