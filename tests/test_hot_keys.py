"""Skew-sensitive plans stay exact when one key holds a third of the rows."""

import datetime as dt
from collections import defaultdict

from fixtures import D, T0, warehouse
from marketlens.plans.exercises import Exercises


def test_hot_user_latest_orders_and_hot_order_revenue(spark):
    orders = [dict(id=i, user_id=0 if i % 3 == 0 else i % 17 + 1, created_at=T0 + dt.timedelta(hours=i))
              for i in range(1, 400)]
    lines = [dict(id=j, order_id=3 if j % 3 == 0 else j % 399 + 1, product_id=j % 7, sku_id=j % 7, quantity=1,
                  line_total=D(f"{j % 50}.25")) for j in range(1, 1200)]
    wh = warehouse(spark, orders=orders, order_line_items=lines)
    got = {r["user_id"]: (r["latest_order_id"], r["second_latest_order_id"])
           for r in Exercises(wh).offset_limit().collect()}
    by_user = defaultdict(list)
    for o in orders:
        by_user[o["user_id"]].append(o["id"])
    want = {u: (sorted(ids)[-1], sorted(ids)[-2] if len(ids) > 1 else None) for u, ids in by_user.items()}
    assert got == want
    rev = defaultdict(lambda: D(0))
    for ln in lines:
        rev[ln["order_id"]] += ln["line_total"]
    daily = defaultdict(lambda: D(0))
    for o in orders:
        daily[o["created_at"].date()] += rev.get(o["id"], D(0))
    got_daily = {r["order_date"]: r["total_revenue"] for r in wh.revenue_daily().collect()}
    assert got_daily == {d: float(v) for d, v in daily.items()}


def test_hot_sku_top_offers(spark):
    products = [dict(id=i, shop_id=i % 40, sku_id=1 if i % 3 == 0 else i % 13 + 2, price=D(f"{(i * 37) % 90}.50"),
                     is_active=i % 11 != 0) for i in range(1, 600)]
    wh = warehouse(spark, products=products, shops=[dict(id=s) for s in range(40)])
    got = sorted((r["sku_id"], r["offer_rank"], r["product_id"]) for r in Exercises(wh).lateral_topn().collect())
    by_sku = defaultdict(list)
    for p in products:
        if p["is_active"]:
            by_sku[p["sku_id"]].append((p["price"], p["id"]))
    want = sorted((s, i + 1, pid) for s, offers in by_sku.items() for i, (_, pid) in enumerate(sorted(offers)[:3]))
    assert got == want
