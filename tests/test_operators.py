"""SCD2, hierarchy, keyed inserts/updates and quality checks on fixtures."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from fixtures import D, T0, frame, warehouse
from marketlens.functions.dates import ts_ntz
from marketlens.operators.hierarchy import expand_tree, unreachable_nodes
from marketlens.operators.keyed import insert_skip_conflict, nth_latest_per_group, top_k_per_group, update_from
from marketlens.operators.quality import (
    RelationshipCheck, Suite, UniqueCheck, accepted_values, constraint, not_null, run_suite, suite_sql,
)
from marketlens.operators.scd2 import current_versions, scd2_apply
from marketlens.plans.jobs import ADDRESS_CHECK_COLS, Jobs, order_status_expr
from marketlens.sources.marketplace import product_key


def _addr(i, **kw):
    return dict(id=i, city=kw.pop("city", "Athens"), **kw)


def test_scd2_versions(spark):
    b1 = [_addr(1), _addr(2), _addr(3, address_line2=None), _addr(4), _addr(5)]
    b2 = [_addr(1), _addr(2, city="Patras"), _addr(3, address_line2="Apt 1"),
          _addr(5, created_at=T0 + dt.timedelta(days=3))]                     # 4 deleted, 5 only created_at
    b3 = [_addr(1), _addr(2, city="Patras"), _addr(3, address_line2="Apt 1"), _addr(4), _addr(5)]  # 4 returns
    asof = ["2024-02-01 00:00:00", "2024-03-01 00:00:00", "2024-04-01 00:00:00"]
    hist = None
    for b, a in zip([b1, b2, b3], asof):
        hist = scd2_apply(hist, frame(spark, "addresses", b), "id", ADDRESS_CHECK_COLS, ts_ntz(a))
    rows = hist.collect()
    by_id = {}
    for r in rows:
        by_id.setdefault(r["id"], []).append(r)
    assert len(by_id[1]) == 1 and by_id[1][0]["valid_to"] is None
    assert len(by_id[2]) == 2 and {r["city"] for r in by_id[2] if r["valid_to"] is None} == {"Patras"}
    assert len(by_id[3]) == 2                                # null -> value is a change
    assert len(by_id[4]) == 2                                # closed by the delete, reopened on return
    closed4 = [r for r in by_id[4] if r["valid_to"] is not None][0]
    assert closed4["valid_to"] == dt.datetime(2024, 3, 1)
    assert len(by_id[5]) == 1                                # created_at is not a check column
    cur = current_versions(hist)
    assert cur.count() == 5 and cur.groupBy("id").count().filter("count > 1").count() == 0
    # no overlapping intervals and unique version ids
    assert hist.select("version_id").distinct().count() == len(rows)


def test_product_keys_do_not_collide(spark):
    pairs = [(1, 1_000_000), (2, 0), (1, 11), (11, 1), (111, 1), (2 ** 62, 2 ** 62), (None, 3)]
    got = [r[0] for r in spark.createDataFrame(pairs, "sku long, shop long")
           .select(product_key(F.col("sku"), F.col("shop"))).collect()]
    assert len(set(got)) == len(pairs) and got[-1] is None


def test_last_orders_are_repeated(spark):
    wh = warehouse(
        spark,
        orders=[dict(id=1, user_id=7, payment_id=11, created_at=T0), dict(id=2, user_id=7, payment_id=12, created_at=T0),
                dict(id=3, user_id=8, payment_id=13, created_at=T0), dict(id=4, user_id=9, payment_id=14, created_at=T0)],
        order_line_items=[dict(id=101, order_id=1, product_id=5, sku_id=50, quantity=9, line_total=D(9)),
                          dict(id=201, order_id=2, product_id=5, sku_id=50, quantity=2, line_total=D(2)),
                          dict(id=202, order_id=2, product_id=6, sku_id=60, quantity=1, line_total=D(1)),
                          dict(id=301, order_id=3, product_id=6, sku_id=60, quantity=1, line_total=D(1)),
                          dict(id=401, order_id=4, product_id=5, sku_id=50, quantity=1, line_total=D(1))],
        products=[dict(id=5, shop_id=1, sku_id=50, price=D("2.50")), dict(id=6, shop_id=1, sku_id=60, price=D(4), is_active=False)],
        payments=[dict(id=11), dict(id=12, provider="cod"), dict(id=13), dict(id=14, status="failed")],
        users_addresses=[dict(user_id=u, address_id=u * 10) for u in (7, 8, 9)])
    jobs = Jobs(wh)
    orders = {r["user_id"]: r for r in jobs.order_topup_orders().collect()}
    assert set(orders) == {7, 9}  # nothing of user 8's last order is still sold
    assert (orders[7]["order_id"], orders[7]["payment_id"], orders[7]["order_total_amount"]) == (6, 26, D("5.00"))
    assert (orders[7]["order_status"], orders[9]["order_status"]) == ("paid", "pending")
    assert orders[7]["order_created_at"] == T0 + dt.timedelta(days=28) and orders[7]["shipping_address_id"] == 70
    lines = sorted((r["order_id"], r["item_n"], r["quantity"], r["line_total"]) for r in jobs.order_topup_lines().collect())
    assert lines == [(6, 1, 2, D("5.00")), (8, 1, 1, D("2.50"))]
    assert {r["provider"] for r in jobs.order_topup_payments().collect()} == {"cod", "card"}
    assert jobs.insert_skip_conflict().count() == 6


def test_hierarchy_deeper_than_the_default_limit(spark):
    nodes = spark.range(105).selectExpr("id as category_id", "if(id = 0, null, id - 1) as parent_id",
                                        "cast(id as string) as category_name").coalesce(1)
    deepest = expand_tree(nodes).orderBy(F.col("depth").desc()).first()
    assert deepest["depth"] == 104 and deepest["category_path"] == " > ".join(map(str, range(105)))


def test_hierarchy_with_orphan_and_cycle(spark):
    nodes = spark.createDataFrame(
        [(1, None, "Root A"), (2, None, "Root B"), (3, 1, "Child"), (4, 3, "Grandchild"),
         (5, 99, "Orphan"), (6, 7, "Cyc1"), (7, 6, "Cyc2")],
        "category_id long, parent_id long, category_name string")
    tree = expand_tree(nodes)
    t = {r["category_id"]: r for r in tree.collect()}
    assert set(t) == {1, 2, 3, 4}
    assert t[4]["category_path"] == "Root A > Child > Grandchild" and t[4]["depth"] == 2
    assert t[4]["root_category_id"] == 1 and t[2]["root_category_name"] == "Root B"
    assert {r["category_id"] for r in unreachable_nodes(nodes, tree).collect()} == {5, 6, 7}


def test_insert_skip_conflict_first_duplicate_wins(spark):
    target = spark.createDataFrame([(1, "a", 0), (2, "b", 0)], "k long, v string, ts int")
    incoming = spark.createDataFrame([(2, "x", 1), (3, "late", 5), (3, "early", 1), (4, "d", 0)],
                                     "k long, v string, ts int")
    new = {r["k"]: r["v"] for r in insert_skip_conflict(target, incoming, ["k"], ["ts"]).collect()}
    assert new == {3: "early", 4: "d"}


def test_top_k_and_second_latest(spark):
    rows = [(1 if i % 3 else 2, i, float(i % 7)) for i in range(1, 200)]
    df = spark.createDataFrame(rows, "g long, id long, price double")
    top = top_k_per_group(df.repartition(7), ["g"], [F.col("price").asc()], 3, rank_col="r", tiebreak="id")
    got = sorted((r["g"], r["r"], r["id"]) for r in top.collect())
    want = []
    for g in (1, 2):
        s = sorted([x for x in rows if x[0] == g], key=lambda x: (x[2], x[1]))[:3]
        want += [(g, i + 1, x[1]) for i, x in enumerate(s)]
    assert got == sorted(want)
    nl = {r["g"]: (r["latest"], r["second_latest"]) for r in nth_latest_per_group(df, "g", "id").collect()}
    assert nl[2] == (198, 195)


def test_payment_status_mapping(spark):
    df = spark.createDataFrame([(s,) for s in ["captured", "authorized", "failed", "cancelled", "refunded",
                                               "pending"]], "s string")
    out = {r["s"]: r["o"] for r in df.select("s", order_status_expr(F.col("s"), F.lit("keep")).alias("o")).collect()}
    assert out == {"captured": "paid", "authorized": "pending", "failed": "cancelled", "cancelled": "cancelled",
                   "refunded": "refunded", "pending": "keep"}


def test_default_address_fallback(spark):
    wh = warehouse(spark, users_addresses=[
        dict(user_id=1, address_id=11, is_default_shipping=False, is_default_billing=False),
        dict(user_id=1, address_id=10, is_default_shipping=False, is_default_billing=False),
        dict(user_id=2, address_id=20, is_default_shipping=False, is_default_billing=True),
        dict(user_id=2, address_id=21, is_default_shipping=True, is_default_billing=False)])
    r = {x["user_id"]: (x["shipping_address_id"], x["billing_address_id"])
         for x in Jobs(wh).default_address().collect()}
    assert r == {1: (10, 10), 2: (21, 20)}


def test_quality_suite_counts_failures(spark):
    import duckdb
    a = spark.createDataFrame([(1, "paid", 5), (1, "paid", -1), (None, "weird", 3), (4, "paid", 2)],
                              "id long, status string, qty int")
    b = spark.createDataFrame([(10, 1), (11, 9), (12, None)], "cid long, aid long")
    suite = Suite(rows=[not_null("a", "id"), accepted_values("a", "status", ["paid"]),
                        constraint("a", "qty", "qty > 0")],
                  uniques=[UniqueCheck("a", ("id",))],
                  relationships=[RelationshipCheck("b", "aid", "a", "id")])
    got = {(r["check_name"], r["column_names"]): r["failing_rows"] for r in run_suite({"a": a, "b": b}, suite).collect()}
    assert got == {("not_null", "id"): 1, ("accepted_values", "status"): 1, ("row_constraint", "qty"): 1,
                   ("unique", "id"): 1, ("relationships", "aid->a.id"): 1}
    con = duckdb.connect()
    con.register("a", a.toPandas())
    con.register("b", b.toPandas())
    sql_rows = {(r[1], r[2]): r[3] for r in con.sql(suite_sql(suite)).fetchall()}
    assert sql_rows == got


def test_quality_suite_neither_multiplies_rows_nor_rounds_keys(spark, monkeypatch):
    plans = []
    kind = type(spark.range(1))
    collect = kind.collect

    def recorded(df):
        plans.append(df._jdf.queryExecution().optimizedPlan().toString())
        return collect(df)

    a = spark.createDataFrame([(1, T0, 5), (1, T0 + dt.timedelta(microseconds=1), -1), (2, T0, 3), (2, T0, 3), (None, T0, 7)],
                              "id long, at timestamp_ntz, qty int")
    b = spark.createDataFrame([(1, 2), (9, 9), (9, None), (None, None)], "aid long, other long")
    suite = Suite(rows=[not_null("a", "id"), not_null("b", "other"), constraint("a", "qty", "qty > 0")],
                  uniques=[UniqueCheck("a", ("id",)), UniqueCheck("a", ("id", "at"))],
                  relationships=[RelationshipCheck("b", "aid", "a", "id"), RelationshipCheck("b", "other", "a", "id")])
    monkeypatch.setattr(kind, "collect", recorded)
    report = run_suite({"a": a, "b": b}, suite)
    monkeypatch.undo()
    assert plans and not any("explode" in p for p in plans)
    got = {(r["table_name"], r["check_name"], r["column_names"]): r["failing_rows"] for r in report.collect()}
    assert got == {("a", "not_null", "id"): 1, ("b", "not_null", "other"): 2, ("a", "row_constraint", "qty"): 1,
                   ("a", "unique", "id"): 2, ("a", "unique_combination", "id,at"): 1,
                   ("b", "relationships", "aid->a.id"): 2, ("b", "relationships", "other->a.id"): 1}


def test_update_from_refuses_two_source_rows_of_a_key(spark):
    target = spark.createDataFrame([(1, 2), (5, 6)], "k int, v int")
    source = spark.createDataFrame([(1, 3), (1, 4)], "k int, v int")
    with pytest.raises(Exception, match="several source rows"):
        update_from(target, source, ["k"], {"v": F.col("s.v")}).collect()


def test_insert_keeps_rows_with_null_keys(spark):
    target = spark.createDataFrame([(1, 2)], "k int, v int")
    incoming = spark.createDataFrame([(1, 9), (None, 3), (None, 4), (7, 5), (7, 6)], "k int, v int")
    got = insert_skip_conflict(target, incoming, ["k"], ["v"]).collect()
    assert sorted(map(tuple, got), key=str) == [(7, 5), (None, 3), (None, 4)]


def test_sampled_pairs_are_dealt_over_tasks(spark, tmp_path, monkeypatch):
    from marketlens.plans import jobs

    def stored(column, keys):
        spark.createDataFrame([(k,) for k in keys], f"{column} long").coalesce(1).write.parquet(str(tmp_path / column))
        return spark.read.parquet(str(tmp_path / column))

    class Frames:
        mp = None
        stg_shops = stored("shop_id", [*range(150), 3, None])
        stg_skus = stored("sku_id", [*range(200), 7, None])

    monkeypatch.setattr(jobs, "PAIRS_PER_TASK", 500)
    pairs = jobs.Jobs(Frames()).sampled_pairs()
    want = [(s, k) for s in [*range(150), 3] for k in [*range(200), 7] if (31 * s + 17 * k) % 100 < 20]
    assert sorted(tuple(r) for r in pairs.collect()) == sorted(want)
    assert pairs.select(F.spark_partition_id().alias("p")).distinct().count() > 4


def rows_shuffled(df):
    """Rows that the exchanges of a collected frame have written."""
    def walk(node):
        name = node.getClass().getSimpleName()
        if name == "AdaptiveSparkPlanExec":
            return walk(node.executedPlan())
        if name.endswith("QueryStageExec"):
            return walk(node.plan())
        own = node.metrics().apply("shuffleRecordsWritten").value() if name == "ShuffleExchangeExec" else 0
        return own + sum(walk(node.children().apply(i)) for i in range(node.children().size()))
    return walk(df._jdf.queryExecution().executedPlan())


def test_sampled_pairs_shuffle_ids_not_multiplied_rows(spark, monkeypatch):
    from marketlens.plans import jobs

    def pairs_of(shops, skus):
        class Frames:
            mp = None
            stg_shops = spark.createDataFrame([(k,) for k in shops], "shop_id long")
            stg_skus = spark.createDataFrame([(k,) for k in skus], "sku_id long")

        pairs = jobs.Jobs(Frames()).sampled_pairs()
        want = [(s, k) for s in shops for k in skus if None not in (s, k) and (31 * s + 17 * k) % 100 < 20]
        assert sorted(tuple(r) for r in pairs.collect()) == sorted(want)
        return pairs

    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        ids = [*range(300)]
        assert rows_shuffled(pairs_of(ids, ids)) < 10 * 600
        # all of a class, in many blocks and cells; ids that repeat or are null; no ids
        monkeypatch.setattr(jobs, "BLOCK_IDS", 7)
        monkeypatch.setattr(jobs, "PAIRS_PER_TASK", 400)
        pairs_of([*range(0, 6000, 100), 300, 300, None], [*range(0, 5000, 100), *[700] * 30, None])
        pairs_of([1], [*range(500)])
        pairs_of([*range(500)], [2])
        pairs_of([], [1, 2])
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
