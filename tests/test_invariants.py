"""Model invariants on the sf0.01 driver tables."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from marketlens.operators.hierarchy import unreachable_nodes
from marketlens.plans.exercises import Exercises
from marketlens.plans.jobs import Jobs
from marketlens.plans.warehouse import Warehouse

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def wh(spark):
    return Warehouse(spark, SF)


def test_grain_totals_agree(wh):
    rep = wh.rep_revenue_per_period()
    totals = {r["reporting_period"]: (round(r["rev"], 2), r["orders"]) for r in
              rep.groupBy("reporting_period").agg(F.sum("total_revenue").alias("rev"),
                                                  F.sum("total_orders").alias("orders")).collect()}
    assert totals["Day"] == totals["Month"] == totals["Year"]
    assert totals["Day"][1] == wh.stg_orders.count()


def test_category_pareto_and_ranks(wh):
    rep = wh.rep_category_performance()
    agg = rep.agg(F.max("cumulative_revenue_share").alias("mx"), F.sum("total_revenue").alias("tot"),
                  F.max("cumulative_category_revenue").alias("last"), F.min("category_revenue_rank").alias("r1"),
                  F.sum("revenue_share").alias("shares")).first()
    assert abs(agg["mx"] - 1.0) < 1e-12 and abs(agg["shares"] - 1.0) < 1e-9
    assert abs(agg["last"] - agg["tot"]) < 1e-6 and agg["r1"] == 1


def test_status_share_sums_to_one_per_provider(wh):
    rep = wh.rep_payment_summary()
    for r in rep.groupBy("provider").agg(F.sum("status_transaction_share").alias("s")).collect():
        assert abs(r["s"] - 1.0) < 1e-12


def test_hierarchy_covers_categories(wh, spark):
    cats = wh.stg_categories
    tree = Exercises(wh).category_hierarchy()
    assert tree.count() + unreachable_nodes(cats, tree).count() == cats.count()


def test_scd2_open_rows_and_intervals(wh):
    hist = Jobs(wh).addresses_history()
    assert hist.filter(F.col("valid_to").isNull()).groupBy("id").count().filter("count > 1").count() == 0
    w = Window.partitionBy("id").orderBy("valid_from")
    nxt = hist.withColumn("next_from", F.lead("valid_from").over(w))
    # every closed version ends where the next one starts or the key stays closed
    bad = nxt.filter(F.col("next_from").isNotNull() & (F.col("valid_to").isNull()
                                                      | (F.col("valid_to") > F.col("next_from"))))
    assert bad.count() == 0
    assert hist.select("version_id").distinct().count() == hist.count()


def test_user_kpis_roll_up_to_user_orders(wh):
    per_user = wh.user_orders().select("user_id", "total_orders", "total_revenue")
    years = (wh.rep_user_kpis_per_period().filter(F.col("reporting_period") == "Year")
             .groupBy("user_id").agg(F.sum("total_orders").alias("o"), F.sum("total_revenue").alias("r")))
    diff = per_user.join(years, "user_id", "full_outer").filter(
        (F.col("o") != F.col("total_orders")) | (F.abs(F.col("r") - F.col("total_revenue")) > 1e-6)
        | F.col("o").isNull() | F.col("total_orders").isNull())
    assert diff.count() == 0


def test_calendar_anchor_semantics(wh):
    rp = wh.reporting_periods()
    weeks = rp.filter(F.col("reporting_period") == "Week")
    assert weeks.filter(~F.col("is_weekend") | (F.col("day_of_week") != 1)).count() == 0
    years_q1 = rp.filter((F.col("reporting_period") == "Year")
                         | ((F.col("reporting_period") == "Quarter") & (F.col("calendar_quarter") == 1)))
    assert years_q1.filter(F.col("greek_public_holiday_name") != "New Years Day").count() == 0
    counts = {r[0]: r[1] for r in rp.groupBy("reporting_period").count().collect()}
    days = wh.all_dates().count()
    assert counts["Day"] == days and counts["Year"] * 12 == counts["Month"] == counts["Quarter"] * 3
