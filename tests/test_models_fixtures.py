"""Model semantics on small hand-made fixtures (zero-fill, ties, calendar,
period changes, exercises)."""

import datetime as dt

from pyspark.sql import functions as F

from fixtures import D, T0, warehouse
from marketlens.functions.dates import calendar_attributes, week_start
from marketlens.plans.exercises import Exercises, similar_to_regex


def _by(df, key):
    return {r[key]: r.asDict() for r in df.collect()}


def test_zero_fill_orders_products_shops(spark):
    wh = warehouse(
        spark,
        shops=[dict(id=1, name="A"), dict(id=2, name="B")],
        skus=[dict(id=100, category_id=None)],
        products=[dict(id=10, shop_id=1, sku_id=100, price=D(5)), dict(id=11, shop_id=1, sku_id=100, price=D(6))],
        orders=[dict(id=1, user_id=7, created_at=T0), dict(id=2, user_id=7, created_at=T0 + dt.timedelta(days=1))],
        order_line_items=[dict(id=1, order_id=1, product_id=10, sku_id=100, quantity=2, line_total=D("10.50"))],
    )
    daily = _by(wh.revenue_daily(), "order_date")
    assert daily[dt.date(2024, 1, 2)]["total_revenue"] == 0.0
    assert daily[dt.date(2024, 1, 2)]["total_orders"] == 1
    perf = _by(wh.product_performance(), "product_id")
    assert perf[11]["total_revenue"] == 0.0 and perf[11]["total_orders"] == 0 and perf[11]["total_quantity"] == 0
    assert perf[10]["product_revenue_rank"] == 1 and perf[11]["product_revenue_rank"] == 2
    pps = _by(wh.products_per_shop(), "shop_id")
    assert pps[2]["total_products"] == 0 and pps[1]["total_products"] == 2
    rps = _by(wh.revenue_per_shop(), "shop_id")
    assert rps[2]["total_revenue"] == 0.0 and rps[1]["total_revenue"] == 10.5


def test_shop_revenue_tie(spark):
    wh = warehouse(
        spark,
        shops=[dict(id=2, name="B"), dict(id=1, name="A"), dict(id=3, name="C")],
        skus=[dict(id=100)],
        products=[dict(id=10, shop_id=1, sku_id=100, price=D(1)), dict(id=20, shop_id=2, sku_id=100, price=D(1))],
        orders=[dict(id=1, user_id=1, created_at=T0)],
        order_line_items=[dict(id=1, order_id=1, product_id=10, sku_id=100, quantity=1, line_total=D(30)),
                          dict(id=2, order_id=1, product_id=20, sku_id=100, quantity=1, line_total=D(30))],
    )
    r = _by(wh.rep_main_kpis_per_shop(), "shop_id")
    assert r[1]["revenue_rank"] == r[2]["revenue_rank"] == 1 and r[3]["revenue_rank"] == 2
    # ties are ordered by shop id: shop 1 first
    assert r[1]["previous_shop_revenue"] is None and r[2]["previous_shop_revenue"] == 30.0
    assert r[1]["cumulative_revenue"] == 30.0 and r[2]["cumulative_revenue"] == 60.0
    assert r[3]["next_shop_revenue"] is None and r[3]["cumulative_revenue"] == 60.0


def test_period_change_after_zero_and_rolling_rows(spark):
    days = [0, 1, 2, 5, 6, 7, 8, 11, 12, 13]  # 10 of 14 days
    amounts = {0: 100, 1: 0, 2: 50}
    orders, lines = [], []
    for i, d in enumerate(days):
        orders.append(dict(id=i + 1, user_id=1, created_at=T0 + dt.timedelta(days=d)))
        amt = amounts.get(d, 10)
        if amt:
            lines.append(dict(id=i + 1, order_id=i + 1, product_id=1, sku_id=1, quantity=1, line_total=D(amt)))
    wh = warehouse(spark, orders=orders, order_line_items=lines)
    rep = wh.rep_revenue_per_period().filter(F.col("reporting_period") == "Day")
    r = _by(rep, "reporting_date")
    d0 = dt.date(2024, 1, 1)
    assert r[d0 + dt.timedelta(days=1)]["revenue_pct_change_vs_prev"] == -1.0
    assert r[d0 + dt.timedelta(days=2)]["revenue_pct_change_vs_prev"] is None  # previous period is zero
    assert r[d0]["prev_total_revenue"] is None
    # rows, not days: the 7 rows ending at day 11 reach back to day 1 (0 + 50 + 5 x 10)
    assert r[d0 + dt.timedelta(days=11)]["revenue_last_7_periods"] == 0 + 50 + 10 * 5
    ma = Exercises(wh).ex_orders_ma7().orderBy("dt").collect()
    assert len(ma) == 14
    assert [x["order_cnt"] for x in ma[3:5]] == [0, 0]
    assert abs(ma[3]["ma7"] - 5 / 7) < 1e-12  # days 0..6 of which 0,1,2,5,6 have one order


def test_week_starts_sunday_and_holidays(spark):
    rows = [(dt.date(2024, 6, 8),), (dt.date(2024, 6, 9),), (dt.date(2024, 1, 1),), (dt.date(2024, 1, 6),),
            (dt.date(2024, 3, 25),), (dt.date(2024, 5, 1),), (dt.date(2024, 8, 15),), (dt.date(2024, 10, 28),),
            (dt.date(2024, 12, 25),), (dt.date(2024, 12, 26),), (dt.date(2024, 7, 3),)]
    df = spark.createDataFrame(rows, "reporting_date date")
    out = {r["reporting_date"]: r for r in df.select("reporting_date", week_start("reporting_date").alias("ws"),
                                                   *calendar_attributes()).collect()}
    assert out[dt.date(2024, 6, 8)]["ws"] == dt.date(2024, 6, 2)  # Saturday -> previous Sunday
    assert out[dt.date(2024, 6, 9)]["ws"] == dt.date(2024, 6, 9)  # Sunday is its own anchor
    assert out[dt.date(2024, 6, 9)]["day_of_week"] == 1 and out[dt.date(2024, 6, 9)]["is_weekend"]
    hol = [d for d, r in out.items() if r["is_greek_public_holiday"]]
    assert len(hol) == 8 and dt.date(2024, 7, 3) not in hol
    assert out[dt.date(2024, 10, 28)]["greek_public_holiday_name"] == "Ochi Day"
    assert out[dt.date(2024, 7, 3)]["greek_public_holiday_name"] is None
    assert out[dt.date(2024, 1, 1)]["calendar_month_name"] == "January"
    assert out[dt.date(2024, 1, 1)]["day_name"] == "Monday"


def test_cheapest_offer_tiebreaks(spark):
    wh = warehouse(
        spark,
        shops=[dict(id=1, rating=D("3.50")), dict(id=2, rating=D("4.50")), dict(id=3, rating=D("4.50"))],
        skus=[dict(id=100)],
        products=[dict(id=31, shop_id=3, sku_id=100, price=D("9.99")),
                  dict(id=12, shop_id=1, sku_id=100, price=D("9.99")),
                  dict(id=22, shop_id=2, sku_id=100, price=D("9.99")),
                  dict(id=40, shop_id=1, sku_id=100, price=D("1.00"), is_active=False)],
    )
    (row,) = Exercises(wh).ex_cheapest_offer().collect()
    assert (row["product_id"], row["shop_id"], row["price"], row["shop_rating"]) == (22, 2, 9.99, 4.5)


def test_catalog_gap_notes(spark):
    wh = warehouse(
        spark,
        skus=[dict(id=1), dict(id=2), dict(id=3)],
        products=[dict(id=10, shop_id=1, sku_id=1, price=D(1), is_active=True),
                  dict(id=20, shop_id=1, sku_id=2, price=D(1), is_active=False),
                  dict(id=30, shop_id=1, sku_id=3, price=D(1), is_active=True)],
        orders=[dict(id=1, user_id=1, status="delivered", created_at=T0)],
        order_line_items=[dict(id=1, order_id=1, product_id=20, sku_id=2, quantity=1, line_total=D(5)),
                          dict(id=2, order_id=1, product_id=30, sku_id=3, quantity=1, line_total=D(5))],
    )
    r = _by(Exercises(wh).ex_catalog_sales_gap(), "sku_id")
    assert set(r) == {1, 2}
    assert r[1]["notes"] == "active in catalog, no sales" and r[2]["notes"] == "sold, inactive in catalog"


def test_interpurchase_hot_user_matches_plain_window(spark):
    orders = [dict(id=i, user_id=1 if i % 3 else 2, created_at=T0 + dt.timedelta(days=i // 2)) for i in range(1, 60)]
    wh = warehouse(spark, orders=orders)
    got = {r["order_id"]: r for r in Exercises(wh).ex_interpurchase().collect()}
    by_user = {}
    for o in sorted(orders, key=lambda o: (o["user_id"], o["created_at"].date(), o["id"])):
        by_user.setdefault(o["user_id"], []).append(o)
    for seq in by_user.values():
        for i, o in enumerate(seq):
            prev = seq[i - 1]["created_at"].date() if i else None
            nxt = seq[i + 1]["created_at"].date() if i + 1 < len(seq) else None
            g = got[o["id"]]
            assert (g["prev_order_dt"], g["next_order_dt"]) == (prev, nxt)
            assert g["days_since_prev"] == (None if prev is None else (o["created_at"].date() - prev).days)


def test_similar_to_translation():
    assert similar_to_regex("(Small|Large) %") == "^(?:(Small|Large) .*)$"
    assert similar_to_regex("a_c.") == "^(?:a.c\\.)$"


def test_presentation_order(spark):
    from marketlens.plans.warehouse import presented
    df = spark.createDataFrame([("Month", dt.date(2024, 2, 1)), ("Day", dt.date(2024, 1, 5)),
                                ("Day", dt.date(2024, 1, 1))], "reporting_period string, reporting_date date")
    out = [(r[0], r[1].day) for r in presented("rep_revenue_per_period", df).collect()]
    assert out == [("Day", 1), ("Day", 5), ("Month", 1)]


def test_model_keys_that_fail_are_counted(spark):
    from marketlens.operators.quality import run_suite
    from marketlens.plans.quality_suite import MODEL_KEYS, model_suite
    suite = model_suite()
    assert len(suite.rows) + len(suite.uniques) == 26
    frames = {m: spark.createDataFrame([], ", ".join(f"{k} string" for k in key)) for m, key in MODEL_KEYS.items()}
    frames["rep_payment_summary"] = spark.createDataFrame(
        [("a", "paid"), ("a", "paid"), ("a", "failed"), (None, "paid")], "provider string, payment_status string")
    bad = {(r["table_name"], r["check_name"], r["column_names"]): r["failing_rows"]
           for r in run_suite(frames, suite).collect() if r["failing_rows"]}
    assert bad == {("rep_payment_summary", "not_null", "provider"): 1,
                   ("rep_payment_summary", "unique_combination", "provider,payment_status"): 1}


def test_keys_of_models_need_no_sums(spark):
    from fixtures import warehouse
    from marketlens.plans.build import KeyWarehouse
    mp = warehouse(spark, orders=[dict(id=1, user_id=5)], order_line_items=[dict(id=1, order_id=1, product_id=1, sku_id=1)],
                   shops=[dict(id=1), dict(id=1)], products=[dict(id=1, shop_id=1, sku_id=1)], categories=[dict(id=3)]).mp
    wh = KeyWarehouse(spark, marketplace=mp)
    for model, key, want in (("rep_main_kpis_per_shop", "shop_id", [1, 1, 1, 1]), ("revenue_per_shop", "shop_id", [1, 1]),
                             ("category_revenue", "category_id", [3]), ("user_orders", "user_id", [5])):
        keys = getattr(wh, model)().select(key)
        plan = keys._jdf.queryExecution().optimizedPlan().toString()
        assert "sum(" not in plan and "count(" not in plan, model
        assert sorted(r[key] for r in keys.collect()) == want
