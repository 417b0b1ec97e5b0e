"""Table materialisation, layer routing, insert-select and lineage cuts."""

import tempfile

from marketlens.sources.sinks import append_rows, layer_location, materialize, swap_write, write_table


def test_write_append_swap(spark):
    base = tempfile.mkdtemp(prefix="sinks-")
    assert layer_location(base, "reporting") == f"{base}/reporting"
    assert layer_location(base, "current_views", custom="current") == f"{base}/current"
    df = spark.range(10).selectExpr("id", "id % 3 as g")
    path = layer_location(base, "intermediate") + "/model"
    write_table(df, path, partition_by=["g"])
    append_rows(spark.range(10, 12).selectExpr("id", "id % 3 as g"), path, partition_by=["g"])
    back = spark.read.parquet(path)
    assert back.count() == 12 and sorted(r.g for r in back.select("g").distinct().collect()) == [0, 1, 2]
    v1 = swap_write(back.filter("id < 5"), base + "/hist")
    v2 = swap_write(spark.read.parquet(v1).filter("id < 3"), base + "/hist")
    assert v1 != v2 and spark.read.parquet(v2).count() == 3


def test_materialize_cuts_lineage(spark):
    df = spark.range(100).selectExpr("id", "id * 2 as x").groupBy("x").count()
    m = materialize(df)
    assert m.count() == 100
    plan = m._jdf.queryExecution().optimizedPlan().toString()
    assert "Aggregate" not in plan


def test_build_writes_models_and_views(spark):
    from marketlens.plans.build import build
    target = tempfile.mkdtemp(prefix="build-")
    out = build(spark, "/root/testdata/sf0.001", target, custom_schemas={"current_views": "current"},
                models=["int_revenue_daily", "rep_revenue_per_period", "dim_addresses_current"])
    assert set(out) == {"int_revenue_daily", "rep_revenue_per_period", "dim_addresses_current"}
    assert out["dim_addresses_current"] == f"{target}/current/dim_addresses_current"
    daily = spark.read.parquet(out["int_revenue_daily"])
    per = spark.read.parquet(out["rep_revenue_per_period"])
    assert per.filter("reporting_period = 'Day'").count() == daily.count()
    assert spark.sql("select count(*) from stg_orders").first()[0] == 1500


def test_build_reads_what_it_has_stored(spark):
    from marketlens.plans.build import StoredWarehouse, build
    from marketlens.plans.jobs import Jobs
    from marketlens.plans.warehouse import Warehouse
    sf = "/root/testdata/sf0.001"
    target = tempfile.mkdtemp(prefix="build-")
    names = ["int_category_revenue", "rep_category_performance", "addresses_hist", "dim_addresses_current"]
    out = build(spark, sf, target, models=names)
    rows = lambda df, cols: sorted(map(str, df.select(*cols).collect()))
    current = Jobs(Warehouse(spark, sf)).addresses_current()
    assert rows(spark.read.parquet(out["dim_addresses_current"]), ["id", "city", "valid_from"]) == \
        rows(current, ["id", "city", "valid_from"])
    report = Warehouse(spark, sf).rep_category_performance()
    assert rows(spark.read.parquet(out["rep_category_performance"]), report.columns) == rows(report, report.columns)
    wh = StoredWarehouse(spark, sf)
    assert wh.category_revenue_exact() is wh.category_revenue_exact()
    plan = wh.rep_category_performance()._jdf.queryExecution().executedPlan().toString()
    assert "lineitem" not in plan


def test_cluster_conf_sizes_partitions():
    from marketlens.session import cluster_conf
    conf = cluster_conf(100 * 1024 ** 4)  # 100 TiB
    assert int(conf["spark.sql.shuffle.partitions"]) == 409600
    assert cluster_conf(1 << 20)["spark.sql.shuffle.partitions"] == "200"


def test_stored_tables_can_be_removed(spark):
    import os

    from marketlens.sources.sinks import new_table_path, remove_tables
    stored = materialize(spark.range(5).selectExpr("id"))
    folder = os.path.dirname(new_table_path(spark)).removeprefix("file:")
    assert stored.count() == 5 and os.path.isdir(folder)
    assert remove_tables(spark) and not os.path.exists(folder)
    assert materialize(spark.range(3).selectExpr("id")).count() == 3
