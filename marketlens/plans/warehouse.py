"""Warehouse models: staging, calendar, metrics and reports.

Each model is a method returning a lazy DataFrame; models call each other
the way the warehouse's ``ref()`` does, so one query is one Catalyst plan.

Scale notes (see README.md, "Plans at scale"):

* fact-side joins pre-aggregate order lines on the join key first
  (partial aggregation happens map-side), so a hot order or product turns
  into one row per map task before any shuffle;
* dimension joins (calendar, categories, shops, SKUs) are left to the
  planner and AQE, which broadcast a side only after checking its
  estimated and measured size and keep a shuffle join otherwise;
* whole-table rankings over entities that grow with the data (products,
  users, shops) use ``ordered_window`` instead of a single-partition window.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from marketlens.functions.dates import PERIODS, date_attributes, period_anchor
from marketlens.functions.money import money_out, pct_change, safe_div, stored_money
from marketlens.operators.ordered_window import Order, ordered_window, plain_window
from marketlens.operators.staging import stage
from marketlens.sources.calendar import all_dates, order_date_range
from marketlens.sources.inline import with_holidays
from marketlens.sources.marketplace import Marketplace
from marketlens.sources.sinks import materialize

CALENDAR_COLS = ["calendar_year", "calendar_quarter", "calendar_month", "calendar_month_name", "iso_week",
                 "day_of_week", "day_name", "is_weekend", "is_greek_public_holiday", "greek_public_holiday_name"]

REPORT_GRAINS = ("Day", "Month", "Year")


def explode_grains(df: DataFrame, date_col: str, grains=REPORT_GRAINS) -> DataFrame:
    """One row per (grain, anchor date) for every input row.

    Replaces a UNION ALL of one aggregation per grain: the input is scanned
    once and the following groupBy shuffles once for all grains.
    """
    arr = F.array(*[F.struct(F.lit(g).alias("reporting_period"),
                             period_anchor(g, F.col(date_col)).alias("reporting_date")) for g in grains])
    return df.withColumn("_grain", F.explode(arr)).select(
        "*", "_grain.reporting_period", "_grain.reporting_date").drop("_grain")


class Warehouse:
    """The models over one source.  With ``exact`` their amounts stay decimals,
    for storage; otherwise they leave as double."""

    def __init__(self, spark: SparkSession, sf_dir: str | None = None, *, window_opts: dict | None = None,
                 marketplace=None, exact: bool = False):
        self.exact = exact
        self.spark = spark
        self.sf_dir = sf_dir
        self.mp = marketplace if marketplace is not None else Marketplace(spark, sf_dir)
        self.window_opts = dict(window_opts or {})

    def _money(self, c: Column | str) -> Column:
        """An amount as it leaves a model; one beyond ``STORED_MONEY`` is an
        error, not a null."""
        return stored_money(c) if self.exact else money_out(c)

    def _ow(self, df: DataFrame, order, **kw) -> DataFrame:
        return ordered_window(df, order, **{**self.window_opts, **kw})

    def _kept(self, df: DataFrame) -> DataFrame:
        """A frame that is read several times: computed once and stored."""
        return materialize(df)

    # ============================================================ staging
    def stg(self, entity: str) -> DataFrame:
        if entity == "addresses":
            return stage("addresses", self.mp.addresses(1))
        return stage(entity, getattr(self.mp, entity))

    @cached_property
    def stg_orders(self):
        return self.stg("orders")

    @cached_property
    def stg_lines(self):
        return self.stg("order_line_items")

    @cached_property
    def stg_products(self):
        return self.stg("products")

    @cached_property
    def stg_shops(self):
        return self.stg("shops")

    @cached_property
    def stg_skus(self):
        return self.stg("skus")

    @cached_property
    def stg_categories(self):
        return self.stg("categories")

    @cached_property
    def stg_payments(self):
        return self.stg("payments")

    def int_addresses(self) -> DataFrame:
        return self.stg("addresses").select("*")

    # ============================================================ calendar
    def all_dates(self) -> DataFrame:
        """Dense calendar over whole years spanned by the order dates."""
        return all_dates(order_date_range(self.mp.orders, "created_at"))

    def reporting_periods(self) -> DataFrame:
        """(period, anchor date) for Day/Week/Month/Quarter/Year + attributes."""
        d = self.all_dates()
        arr = F.array(*[F.struct(F.lit(p).alias("reporting_period"),
                                 period_anchor(p, F.col("date_column")).alias("reporting_date")) for p in PERIODS])
        anchors = with_holidays(d.select(F.explode(arr).alias("a")).select("a.*").distinct(), "reporting_date")
        return anchors.select("reporting_period", "reporting_date", *date_attributes("reporting_date"),
                              "is_greek_public_holiday", "greek_public_holiday_name")

    def _calendar_dim(self) -> DataFrame:
        # ~1.2 rows per day of the date span; AQE broadcasts it after
        # measuring it (the size check) and keeps a shuffle join otherwise
        return self.reporting_periods()

    # ============================================================ metrics
    def order_revenue(self) -> DataFrame:
        """Per order: user, order date and revenue (0 for orders without lines)."""
        by_order = self.stg_lines.groupBy("order_id").agg(F.sum("line_total").alias("_rev"))
        orders = self.stg_orders.select("order_id", "user_id", F.to_date("order_created_at").alias("order_date"))
        return orders.join(by_order, "order_id", "left").select(
            "order_id", "user_id", "order_date",
            F.coalesce(F.col("_rev"), F.lit(0)).alias("order_revenue_amount"))

    def revenue_daily_exact(self) -> DataFrame:
        return self.order_revenue().groupBy("order_date").agg(
            F.sum("order_revenue_amount").alias("total_revenue"),
            F.count("order_id").alias("total_orders"))

    def revenue_daily(self) -> DataFrame:
        return self.revenue_daily_exact().select(
            "order_date", self._money("total_revenue").alias("total_revenue"), "total_orders")

    def _lines_by_product(self) -> DataFrame:
        return self.stg_lines.groupBy("product_id").agg(
            F.sum("line_total").alias("_rev"),
            F.sum("quantity").alias("_qty"),
            F.count_distinct("order_id").alias("_orders"))

    def _product_perf_base(self) -> DataFrame:
        p = self.stg_products
        return p.join(self._lines_by_product(), "product_id", "left").select(
            "product_id", F.col("product_shop_id").alias("shop_id"), "sku_id",
            "product_price", "currency", "product_stock", "product_condition", "product_is_active",
            F.coalesce("_rev", F.lit(0)).alias("total_revenue"),
            F.coalesce("_qty", F.lit(0)).cast("long").alias("total_quantity"),
            F.coalesce("_orders", F.lit(0)).cast("long").alias("total_orders"))

    def product_performance(self) -> DataFrame:
        base = self._product_perf_base().select("product_id", "shop_id", "total_revenue",
                                                "total_quantity", "total_orders")
        ranked = self._ow(base, [Order("total_revenue", True), Order("product_id")],
                          dense_rank="product_revenue_rank")
        return ranked.select("product_id", "shop_id", self._money("total_revenue").alias("total_revenue"),
                             "total_quantity", "total_orders", "product_revenue_rank")

    def products_per_shop_exact(self) -> DataFrame:
        per_shop = self.stg_products.groupBy("product_shop_id").agg(
            F.count_distinct("product_id").alias("_n"))
        return self.stg_shops.select("shop_id", "shop_name").join(
            per_shop, F.col("shop_id") == F.col("product_shop_id"), "left").select(
            "shop_id", "shop_name", F.coalesce("_n", F.lit(0)).cast("long").alias("total_products"))

    def products_per_shop(self) -> DataFrame:
        return self._ow(self.products_per_shop_exact(), [Order("total_products", True), Order("shop_id")],
                        dense_rank="product_count_rank")

    def revenue_per_shop_exact(self) -> DataFrame:
        by_product = self.stg_lines.groupBy("product_id").agg(F.sum("line_total").alias("_rev"))
        by_shop = (by_product.join(self.stg_products.select("product_id", "product_shop_id"), "product_id")
                   .groupBy("product_shop_id").agg(F.sum("_rev").alias("_rev")))
        return self.stg_shops.select("shop_id", "shop_name").join(
            by_shop, F.col("shop_id") == F.col("product_shop_id"), "left").select(
            "shop_id", "shop_name", F.coalesce("_rev", F.lit(0)).alias("total_revenue"))

    def revenue_per_shop(self) -> DataFrame:
        r = self._ow(self.revenue_per_shop_exact(), [Order("total_revenue", True), Order("shop_id")],
                     dense_rank="revenue_rank")
        return r.select("shop_id", "shop_name", self._money("total_revenue").alias("total_revenue"), "revenue_rank")

    def category_revenue_exact(self) -> DataFrame:
        prod_cat = self.stg_products.select("product_id", "sku_id").join(
            self.stg_skus.select("sku_id", "category_id"), "sku_id")
        agg = self.stg_lines.join(prod_cat, "product_id").groupBy("category_id").agg(
            F.sum("line_total").alias("_rev"), F.sum("quantity").alias("_qty"),
            F.count_distinct("order_id").alias("_orders"))
        cats = self.stg_categories.select("category_id", "category_name")
        # one row per category; AQE broadcasts it once its size is measured
        joined = cats.join(agg, "category_id", "left").select(
            "category_id", "category_name",
            F.coalesce("_rev", F.lit(0)).alias("total_revenue"),
            F.coalesce("_qty", F.lit(0)).cast("long").alias("total_quantity"),
            F.coalesce("_orders", F.lit(0)).cast("long").alias("total_orders"))
        return plain_window(joined, [Order("total_revenue", True), Order("category_id")],
                            dense_rank="category_revenue_rank")

    def category_revenue(self) -> DataFrame:
        return self.category_revenue_exact().withColumn("total_revenue", self._money("total_revenue"))

    def payment_summary_exact(self) -> DataFrame:
        agg = self.stg_payments.groupBy("provider", "payment_status").agg(
            F.count(F.lit(1)).alias("total_transactions"), F.sum("payment_amount").alias("total_amount"))
        w = Window.partitionBy("payment_status").orderBy(F.col("total_amount").desc_nulls_last())
        return agg.withColumn("amount_rank_within_status", F.dense_rank().over(w).cast("long"))

    def payment_summary(self) -> DataFrame:
        return self.payment_summary_exact().withColumn("total_amount", self._money("total_amount"))

    def user_orders(self) -> DataFrame:
        agg = self.order_revenue().groupBy("user_id").agg(
            F.count("order_id").alias("total_orders"),
            F.sum("order_revenue_amount").alias("total_revenue"),
            F.min("order_date").alias("first_order_date"),
            F.max("order_date").alias("last_order_date"))
        agg = self._kept(agg)
        overall = agg.select((F.sum("total_revenue").cast("double") / F.count(F.lit(1))).alias("a")).scalar()
        ranked = self._ow(agg, [Order("total_revenue", True), Order("user_id")], dense_rank="revenue_rank",
                          materialize=False)
        return ranked.select(
            "user_id", "total_orders", self._money("total_revenue").alias("total_revenue"),
            F.when(F.col("total_orders") > 0, F.col("total_revenue").cast("double") / F.col("total_orders"))
             .alias("avg_order_value"),
            "first_order_date", "last_order_date", "revenue_rank",
            overall.alias("avg_total_revenue_overall"))

    # ============================================================ reports
    def rep_category_performance(self) -> DataFrame:
        m = self.category_revenue_exact()
        cats = self.stg_categories
        j = cats.join(m.drop("category_name"), "category_id", "left")
        w_all = Window.partitionBy()
        total = F.sum("total_revenue").over(w_all)
        avg = F.sum("total_revenue").over(w_all).cast("double") / F.count(F.lit(1)).over(w_all)
        j = plain_window(j, [Order("total_revenue", True), Order("category_id")],
                         lag={"_prev": "total_revenue"}, running_sum={"_cum": "total_revenue"})
        return j.select(
            "category_id", "category_name", "category_slug", "category_created_at",
            self._money("total_revenue").alias("total_revenue"), "total_quantity", "total_orders",
            "category_revenue_rank",
            safe_div(F.col("total_revenue"), total).alias("revenue_share"),
            safe_div(F.col("_cum"), total).alias("cumulative_revenue_share"),
            self._money(F.col("total_revenue") - F.col("_prev")).alias("revenue_diff_vs_prev"),
            F.when(F.col("_prev") == 0, F.lit(None).cast("double"))
             .otherwise(F.col("total_revenue").cast("double") / F.col("_prev").cast("double") - 1)
             .alias("revenue_pct_diff_vs_prev"),
            safe_div(F.col("total_revenue"), avg).alias("revenue_index"),
            self._money("_cum").alias("cumulative_category_revenue"))

    def rep_main_kpis_per_shop(self) -> DataFrame:
        rev = self.revenue_per_shop_exact()
        prods = self.products_per_shop_exact().drop("shop_name")
        j = self._kept(rev.join(prods, "shop_id", "left"))
        j = self._ow(j, [Order("total_products", True), Order("shop_id")], dense_rank="product_count_rank",
                     materialize=False)
        j = self._ow(j, [Order("total_revenue", True), Order("shop_id")], dense_rank="revenue_rank",
                     lag={"previous_shop_revenue": "total_revenue"}, lead={"next_shop_revenue": "total_revenue"},
                     running_sum={"cumulative_revenue": "total_revenue"})
        return j.select("shop_id", "shop_name", self._money("total_revenue").alias("total_revenue"),
                        "revenue_rank", "total_products", "product_count_rank",
                        self._money("previous_shop_revenue").alias("previous_shop_revenue"),
                        self._money("next_shop_revenue").alias("next_shop_revenue"),
                        self._money("cumulative_revenue").alias("cumulative_revenue"))

    def rep_payment_summary(self) -> DataFrame:
        ps = self.payment_summary_exact()
        by_provider = F.sum("total_transactions").over(Window.partitionBy("provider"))
        ps = ps.withColumn("_by_provider", by_provider)
        ps = plain_window(ps, [Order("total_amount", True), Order("provider"), Order("payment_status")],
                          lag={"_prev": "total_amount"}, lead={"_next": "total_amount"},
                          running_sum={"_cum": "total_amount"})
        return ps.select(
            "provider", "payment_status", "total_transactions", self._money("total_amount").alias("total_amount"),
            F.when(F.col("total_transactions") > 0,
                   F.col("total_amount").cast("double") / F.col("total_transactions")).alias("avg_transaction_value"),
            F.when(F.col("_by_provider") > 0,
                   F.col("total_transactions") / F.col("_by_provider")).alias("status_transaction_share"),
            self._money("_prev").alias("previous_total_amount"),
            self._money("_next").alias("next_total_amount"),
            self._money("_cum").alias("cumulative_total_amount"))

    def rep_product_performance(self) -> DataFrame:
        base = self._product_perf_base()
        ranked = self._ow(base, [Order("total_revenue", True), Order("product_id")],
                          dense_rank="product_revenue_rank",
                          lag={"previous_product_revenue": "total_revenue"},
                          lead={"next_product_revenue": "total_revenue"},
                          running_sum={"cumulative_product_revenue": "total_revenue"})
        skus = self.stg_skus.select("sku_id", "sku_title", "brand", "category_id")
        cats = self.stg_categories.select("category_id", "category_name")
        shops = self.stg_shops.select("shop_id", "shop_name")
        j = (ranked.join(skus, "sku_id", "left").join(cats, "category_id", "left")
             .join(shops, "shop_id", "left"))
        return j.select(
            "product_id", "sku_title", "brand", "category_name", "shop_id", "shop_name",
            self._money("product_price").alias("product_price"), "currency", "product_stock",
            "product_condition", "product_is_active", "total_quantity",
            self._money("total_revenue").alias("total_revenue"), "total_orders", "product_revenue_rank",
            self._money("previous_product_revenue").alias("previous_product_revenue"),
            self._money("next_product_revenue").alias("next_product_revenue"),
            self._money("cumulative_product_revenue").alias("cumulative_product_revenue"))

    def rep_revenue_per_period(self) -> DataFrame:
        daily = self.revenue_daily_exact()
        grains = explode_grains(daily, "order_date").groupBy("reporting_period", "reporting_date").agg(
            F.sum("total_revenue").alias("total_revenue"), F.sum("total_orders").alias("total_orders"))
        j = grains.join(self._calendar_dim(), ["reporting_period", "reporting_date"], "left")
        w = Window.partitionBy("reporting_period").orderBy("reporting_date")
        prev = F.lag("total_revenue").over(w)
        j = j.withColumns({
            "_prev": prev,
            "_next": F.lead("total_revenue").over(w),
            "_r7": F.sum("total_revenue").over(w.rowsBetween(-6, Window.currentRow)),
            "_r30": F.sum("total_revenue").over(w.rowsBetween(-29, Window.currentRow)),
        })
        return j.select(
            "reporting_period", "reporting_date", *CALENDAR_COLS,
            self._money("total_revenue").alias("total_revenue"), F.col("total_orders").cast("long").alias("total_orders"),
            self._money("_prev").alias("prev_total_revenue"),
            self._money("_next").alias("next_total_revenue"),
            self._money(F.col("total_revenue") - F.col("_prev")).alias("revenue_change_vs_prev"),
            pct_change(F.col("total_revenue"), F.col("_prev")).alias("revenue_pct_change_vs_prev"),
            self._money("_r7").alias("revenue_last_7_periods"),
            self._money("_r30").alias("revenue_last_30_periods"))

    def rep_user_kpis_per_period(self) -> DataFrame:
        orev = self.order_revenue()
        # after this aggregation a user owns at most one row per calendar
        # anchor, so the per-user windows below are bounded even for a hot user
        kpis = explode_grains(orev, "order_date").groupBy("user_id", "reporting_period", "reporting_date").agg(
            F.count("order_id").alias("total_orders"), F.sum("order_revenue_amount").alias("total_revenue"))
        j = kpis.join(self._calendar_dim(), ["reporting_period", "reporting_date"], "left")
        w = Window.partitionBy("user_id", "reporting_period").orderBy("reporting_date")
        j = j.withColumns({"_prev": F.lag("total_revenue").over(w), "_next": F.lead("total_revenue").over(w)})
        return j.select(
            "user_id", "reporting_period", "reporting_date", *CALENDAR_COLS,
            "total_orders", self._money("total_revenue").alias("total_revenue"),
            F.when(F.col("total_orders") > 0, F.col("total_revenue").cast("double") / F.col("total_orders"))
             .alias("avg_order_value"),
            self._money("_prev").alias("prev_total_revenue"),
            self._money("_next").alias("next_total_revenue"),
            self._money(F.col("total_revenue") - F.col("_prev")).alias("revenue_change_vs_prev"),
            pct_change(F.col("total_revenue"), F.col("_prev")).alias("revenue_pct_change_vs_prev"))


# Presentation order of the models that end with ORDER BY.
PRESENTATION_ORDER = {
    "category_hierarchy": ["root_category_id", "depth", "category_id"],
    "reporting_periods": ["reporting_date", "reporting_period"],
    "rep_revenue_per_period": ["reporting_period", "reporting_date"],
    "rep_user_kpis_per_period": ["user_id", "reporting_period", "reporting_date"],
}


def presented(name: str, df: DataFrame) -> DataFrame:
    """Sort a model for display (a range-partitioned global sort).

    Written tables stay unordered; only use this for what a person reads.
    """
    cols = PRESENTATION_ORDER.get(name)
    return df.orderBy(*cols) if cols else df
