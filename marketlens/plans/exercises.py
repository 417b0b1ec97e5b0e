"""Analytical questions over the warehouse (exercises and example queries).

GMV questions count monetized orders only (status paid, shipped or
delivered).  Parameters (month, shop names, search patterns, k) are
explicit arguments.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marketlens.functions.money import money_out
from marketlens.operators.hierarchy import expand_tree
from marketlens.operators.keyed import nth_latest_per_group, top_k_per_group
from marketlens.operators.ordered_window import Order, ordered_window
from marketlens.plans.warehouse import Warehouse
from marketlens.sources.marketplace import MONETIZED_STATUSES

# The two shops compared by the assortment question.
SHOP_A, SHOP_B = "Shop 10", "Shop 15"

# Modulus and multiplier of the sampling hash (Lehmer / MINSTD).
SAMPLE_MODULUS, SAMPLE_MULTIPLIER = 2147483647, 48271


class Exercises:
    def __init__(self, wh: Warehouse):
        self.wh = wh

    # ------------------------------------------------------------ helpers
    def monetized_orders(self) -> DataFrame:
        return self.wh.stg_orders.filter(F.col("order_status").isin(*MONETIZED_STATUSES))

    def _gmv_by_order(self) -> DataFrame:
        by_order = self.wh.stg_lines.groupBy("order_id").agg(F.sum("line_total").alias("_gmv"))
        return self.monetized_orders().select("order_id", F.to_date("order_created_at").alias("dt")) \
            .join(by_order, "order_id")

    # ---------------------------------------------------------- hierarchy
    def category_hierarchy(self) -> DataFrame:
        return expand_tree(self.wh.stg_categories)

    def region_hierarchy(self) -> DataFrame:
        """Second tree: region -> nation (node ids: region key, 1000 + nation key)."""
        mp = self.wh.mp
        regions = mp.raw("region").select(F.col("r_regionkey").cast("long").alias("category_id"),
                                          F.lit(None).cast("long").alias("parent_id"),
                                          F.col("r_name").alias("category_name"))
        nations = mp.raw("nation").select((F.lit(1000) + F.col("n_nationkey")).cast("long").alias("category_id"),
                                          F.col("n_regionkey").cast("long").alias("parent_id"),
                                          F.col("n_name").alias("category_name"))
        return expand_tree(regions.unionByName(nations))

    def ex_breadcrumbs(self) -> DataFrame:
        t = self.category_hierarchy()
        return t.select(F.col("category_id").alias("id"), "parent_id", F.col("category_name").alias("name"),
                        F.col("category_path").alias("path"))

    def ex_leaf_root_gmv(self) -> DataFrame:
        """GMV of monetized orders per leaf category, labelled with its root."""
        t = self.category_hierarchy()
        cats = self.wh.stg_categories
        leaves = t.join(cats.select(F.col("parent_id").alias("category_id")).distinct(), "category_id", "left_anti")
        line_cat = (self.wh.stg_lines.select("order_id", "sku_id", "line_total")
                    .join(self.monetized_orders().select("order_id"), "order_id")
                    .join(self.wh.stg_skus.select("sku_id", "category_id"), "sku_id")
                    .groupBy("category_id").agg(F.sum("line_total").alias("_gmv")))
        return leaves.join(line_cat, "category_id", "left").select(
            F.col("root_category_name").alias("root_category"),
            F.col("category_name").alias("leaf_category"),
            money_out(F.coalesce("_gmv", F.lit(0))).alias("gmv"))

    # ------------------------------------------------------------ windows
    def ex_running_gmv(self, month: str | None = None, months_ago: int | None = None) -> DataFrame:
        """Daily GMV and running GMV within the month.

        ``month`` (its first day) picks one month; ``months_ago`` counts back
        from the month of the latest order (the data's "now", 0); otherwise
        every month is reported.
        """
        daily = self._gmv_by_order().groupBy("dt").agg(F.sum("_gmv").alias("daily_gmv"))
        if month is not None:
            daily = daily.filter(F.trunc("dt", "MM") == F.to_date(F.lit(month)))
        elif months_ago is not None:
            latest = F.trunc(F.max(F.to_date("order_created_at")), "MM")
            picked = self.wh.stg_orders.agg(F.add_months(latest, -months_ago).alias("m")).scalar()
            daily = daily.filter(F.trunc("dt", "MM") == picked)
        w = Window.partitionBy(F.trunc("dt", "MM")).orderBy("dt") \
            .rowsBetween(Window.unboundedPreceding, Window.currentRow)
        return daily.select("dt", money_out("daily_gmv").alias("daily_gmv"),
                            money_out(F.sum("daily_gmv").over(w)).alias("running_gmv"))

    def ex_orders_ma7(self) -> DataFrame:
        """Daily order counts on a dense date range with a centred 7-day mean."""
        orders = self.wh.stg_orders.select(F.to_date("order_created_at").alias("dt"))
        counts = orders.groupBy("dt").agg(F.count(F.lit(1)).alias("order_cnt"))
        span = orders.agg(F.min("dt").alias("lo"), F.max("dt").alias("hi"))
        days = span.select(F.explode(F.sequence("lo", "hi", F.expr("interval 1 day"))).alias("dt"))
        dense = days.join(counts, "dt", "left").select("dt", F.coalesce("order_cnt", F.lit(0)).alias("order_cnt"))
        # one row per calendar day: bounded by the date span
        w = Window.orderBy("dt").rowsBetween(-3, 3)
        return dense.select("dt", "order_cnt", F.avg("order_cnt").over(w).alias("ma7"))

    def ex_interpurchase(self) -> DataFrame:
        """Previous/next order date and days since previous, per user."""
        o = self.wh.stg_orders.select("user_id", "order_id", F.to_date("order_created_at").alias("order_dt"))
        w = self.wh._ow(o, [Order("order_dt"), Order("order_id")], partition_by=["user_id"],
                        lag={"prev_order_dt": "order_dt"}, lead={"next_order_dt": "order_dt"})
        return w.select("user_id", "order_id", "order_dt", "prev_order_dt",
                        F.datediff("order_dt", "prev_order_dt").alias("days_since_prev"), "next_order_dt")

    # ----------------------------------------------------------- set ops
    def _shop_skus(self, shop_name: str) -> DataFrame:
        shop = self.wh.stg_shops.filter(F.col("shop_name") == shop_name).select("shop_id")
        return self.wh.stg_products.join(shop, F.col("product_shop_id") == F.col("shop_id"), "left_semi") \
            .select("sku_id")

    def ex_assortment_both(self, shop_a: str = SHOP_A, shop_b: str = SHOP_B) -> DataFrame:
        return self._shop_skus(shop_a).intersect(self._shop_skus(shop_b))

    def ex_assortment_only_a(self, shop_a: str = SHOP_A, shop_b: str = SHOP_B) -> DataFrame:
        return self._shop_skus(shop_a).subtract(self._shop_skus(shop_b))

    # ------------------------------------------------------- gap analysis
    def ex_catalog_sales_gap(self) -> DataFrame:
        """SKUs active in the catalogue without sales, and sold SKUs with no active offer."""
        catalog = self.wh.stg_skus.select("sku_id").join(
            self.wh.stg_products.groupBy("sku_id").agg(F.max(F.col("product_is_active").cast("int")).alias("_act")),
            "sku_id", "left").select("sku_id", (F.coalesce("_act", F.lit(0)) == 1).alias("active_in_catalog"))
        sold = (self.wh.stg_lines.select("order_id", "sku_id")
                .join(self.monetized_orders().select("order_id"), "order_id")
                .select("sku_id").distinct().withColumn("sold", F.lit(True)))
        j = catalog.join(sold, "sku_id", "full_outer").select(
            "sku_id", F.coalesce("active_in_catalog", F.lit(False)).alias("active_in_catalog"),
            F.coalesce("sold", F.lit(False)).alias("sold"))
        notes = (F.when(F.col("active_in_catalog") & ~F.col("sold"), F.lit("active in catalog, no sales"))
                 .when(F.col("sold") & ~F.col("active_in_catalog"), F.lit("sold, inactive in catalog")))
        return j.withColumn("notes", notes).filter(F.col("notes").isNotNull())

    def ex_offer_sales_gap(self, months_ago: int = 1) -> DataFrame:
        """The gap per offer in one month, counted back from the month of the
        latest order: active offers without sales, and sold offers that are
        inactive now."""
        month = F.trunc(F.to_date("order_created_at"), "MM")
        picked = self.wh.stg_orders.agg(F.add_months(F.max(month), -months_ago).alias("m")).scalar()
        offers = self.wh.stg_products.select("product_id", "sku_id", F.col("product_is_active").alias("active_in_catalog"))
        sold = (self.wh.stg_lines.select("order_id", "product_id")
                .join(self.monetized_orders().filter(month == picked).select("order_id"), "order_id")
                .select("product_id").distinct().withColumn("sold", F.lit(True)))
        j = offers.join(sold, "product_id", "full_outer").select(
            "product_id", "sku_id", F.coalesce("active_in_catalog", F.lit(False)).alias("active_in_catalog"),
            F.coalesce("sold", F.lit(False)).alias("sold"))
        return j.filter(F.col("active_in_catalog") != F.col("sold")).withColumn(
            "notes", F.when(F.col("sold"), F.lit("sold, inactive in catalog")).otherwise(F.lit("active in catalog, no sales")))

    # ------------------------------------------------------ text patterns
    def _sku_rows(self) -> DataFrame:
        return self.wh.stg_skus.select("sku_id", "sku_code", "sku_title")

    def ex_title_prefix_ci(self, prefix: str = "small") -> DataFrame:
        return self._sku_rows().filter(F.col("sku_title").ilike(prefix + " %"))

    def ex_code_suffix(self, suffix: str = "-13") -> DataFrame:
        return self._sku_rows().filter(F.col("sku_code").like("%" + suffix))

    def ex_code_contains(self, part: str = "-13") -> DataFrame:
        return self._sku_rows().filter(F.col("sku_code").contains(part))

    def ex_similar_to(self, pattern: str = "(Small|Large) %") -> DataFrame:
        """SQL ``SIMILAR TO`` (whole-string match; ``%`` any run, ``_`` one char)."""
        return self._sku_rows().filter(F.col("sku_title").rlike("(?s)" + similar_to_regex(pattern)))

    def ex_like_escape(self, pattern: str = "bank!_%", escape: str = "!") -> DataFrame:
        p = self.wh.stg_payments.select("payment_id", "provider")
        return p.filter(F.like("provider", F.lit(pattern), F.lit(escape)))

    # --------------------------------------------------------- top / argmin
    def ex_cheapest_offer(self) -> DataFrame:
        """Per SKU with active offers: cheapest price, best shop rating among the
        cheapest, then the lowest product id (a partial-aggregating min)."""
        offers = self.wh.stg_products.filter(F.col("product_is_active")).join(
            self.wh.stg_shops.select(F.col("shop_id").alias("product_shop_id"), "shop_rating"), "product_shop_id")
        best = offers.groupBy("sku_id").agg(F.min(F.struct(
            F.col("product_price").alias("price"), (-F.col("shop_rating")).alias("neg_rating"),
            F.col("product_id").alias("product_id"), F.col("product_shop_id").alias("shop_id"))).alias("b"))
        return best.select("sku_id", "b.product_id", "b.shop_id", money_out("b.price").alias("price"),
                           money_out(-F.col("b.neg_rating")).alias("shop_rating"))

    def lateral_topn(self, k: int = 3) -> DataFrame:
        """Per SKU, the k cheapest active offers (lateral top-n, skew-safe)."""
        offers = self.wh.stg_products.filter(F.col("product_is_active")).select(
            "sku_id", "product_id", F.col("product_shop_id").alias("shop_id"), "product_price")
        top = top_k_per_group(offers, ["sku_id"], [F.col("product_price").asc()], k,
                              rank_col="offer_rank", tiebreak="product_id")
        return top.select("sku_id", "product_id", "shop_id", money_out("product_price").alias("price"), "offer_rank")

    def offset_limit(self) -> DataFrame:
        """Per user: latest order id and the one before it (OFFSET 1 LIMIT 1)."""
        o = self.wh.stg_orders.select("user_id", "order_id")
        r = nth_latest_per_group(o, "user_id", "order_id")
        return r.select("user_id", F.col("latest").alias("latest_order_id"),
                        F.col("second_latest").alias("second_latest_order_id"))

    # ------------------------------------------------------ grouping sets
    def ex_grouping_sets_gmv(self) -> DataFrame:
        lines = self.wh.stg_lines.select("order_id", "product_id", "line_total")
        o = self.monetized_orders().select("order_id", F.to_date("order_created_at").alias("dt"))
        p = self.wh.stg_products.select("product_id", F.col("product_shop_id").alias("shop_id"))
        # summed once by day and shop; the sets add up that small table instead
        # of expanding every line three times
        both = lines.join(o, "order_id").join(p, "product_id").groupBy("dt", "shop_id").agg(F.sum("line_total").alias("_gmv"))
        g = both.groupingSets([["dt"], ["shop_id"], []], "dt", "shop_id").agg(
            F.sum("_gmv").alias("_gmv"), F.grouping("dt").alias("_gd"), F.grouping("shop_id").alias("_gs"))
        level = F.when(F.col("_gd") == 0, F.lit("day")).when(F.col("_gs") == 0, F.lit("shop")) \
            .otherwise(F.lit("overall"))
        return g.select(level.alias("level"), "dt", "shop_id", money_out("_gmv").alias("gmv"))

    def ex_payment_outcomes(self) -> DataFrame:
        p = self.wh.stg_payments
        amt = F.col("payment_amount")
        st = F.col("payment_status")
        return p.groupBy(F.to_date("payment_created_at").alias("dt")).agg(
            money_out(F.sum(F.when(st == "captured", amt))).alias("captured_amt"),
            money_out(F.sum(F.when(st == "failed", amt))).alias("failed_amt"),
            money_out(F.sum(F.when(st == "refunded", amt))).alias("refunded_amt"))

    # ---------------------------------------------------- example queries
    def top_categories_gmv(self, k: int = 5) -> DataFrame:
        lines = self.wh.stg_lines.select("sku_id", "line_total")
        g = (lines.join(self.wh.stg_skus.select("sku_id", "category_id"), "sku_id")
             .groupBy("category_id").agg(F.sum("line_total").alias("_gmv"))
             .join(self.wh.stg_categories.select("category_id", "category_name"), "category_id")
             .groupBy(F.col("category_name").alias("name")).agg(F.sum("_gmv").alias("_gmv")))
        # top-k is the feature: TakeOrderedAndProject keeps k rows per task
        return g.orderBy(F.col("_gmv").desc(), F.col("name")).limit(k).select(
            "name", money_out("_gmv").alias("gmv"))

    def monthly_revenue(self) -> DataFrame:
        o = self.monetized_orders()
        return o.groupBy(F.trunc(F.to_date("order_created_at"), "MM").alias("month")).agg(
            money_out(F.sum("order_total_amount")).alias("revenue"))

    def shop_performance(self) -> DataFrame:
        """Distinct monetized orders and line GMV per shop name."""
        lines = self.wh.stg_lines.select("order_id", "product_id", "line_total")
        p = self.wh.stg_products.select("product_id", F.col("product_shop_id").alias("shop_id"))
        j = lines.join(self.monetized_orders().select("order_id"), "order_id").join(p, "product_id")
        per_shop = j.groupBy("shop_id").agg(F.count_distinct("order_id").alias("orders"),
                                            F.sum("line_total").alias("_gmv"))
        return per_shop.join(self.wh.stg_shops.select("shop_id", F.col("shop_name").alias("name")), "shop_id") \
            .groupBy("name").agg(F.sum("orders").cast("long").alias("orders"), money_out(F.sum("_gmv")).alias("gmv"))

    def shop_performance_fanout(self) -> DataFrame:
        """Literal form of the example: sums the order total once per line item."""
        lines = self.wh.stg_lines.select("order_id", "product_id")
        o = self.monetized_orders().select("order_id", "order_total_amount")
        p = self.wh.stg_products.select("product_id", F.col("product_shop_id").alias("shop_id"))
        j = o.join(lines, "order_id").join(p, "product_id").join(
            self.wh.stg_shops.select("shop_id", F.col("shop_name").alias("name")), "shop_id")
        return j.groupBy("name").agg(F.count_distinct("order_id").alias("orders"),
                                     money_out(F.sum("order_total_amount")).alias("gmv"))

    def orders_payment_items(self) -> DataFrame:
        o = self.wh.stg_orders.select(F.col("order_id").alias("id"), F.col("order_status").alias("status"),
                                      "payment_id", "order_total_amount")
        p = self.wh.stg_payments.select("payment_id", "payment_status")
        items = self.wh.stg_lines.groupBy("order_id").agg(F.count("order_line_items_id").alias("_items"))
        return (o.join(p, "payment_id", "left").join(items, F.col("id") == F.col("order_id"), "left")
                .select("id", "status", "payment_status", money_out("order_total_amount").alias("total_amount"),
                        F.coalesce("_items", F.lit(0)).alias("items")))

    def sample_orders(self, k: int = 100, seed: int = 7) -> DataFrame:
        """Reproducible sample of ``k`` orders (ORDER BY random() LIMIT k).

        The order key is a seeded multiplicative hash of the id (Lehmer
        generator constants), so reruns and recomputed tasks pick the same
        rows; TakeOrderedAndProject keeps only k rows per task.
        """
        h = F.pmod(F.pmod(F.col("order_id") + seed, F.lit(SAMPLE_MODULUS)) * SAMPLE_MULTIPLIER,
                   F.lit(SAMPLE_MODULUS))
        o = self.wh.stg_orders.select("order_id", "user_id", "order_created_at")
        return o.orderBy(h, F.col("order_id")).limit(k)

    def global_rank_distributed(self) -> DataFrame:
        """Every order ranked by revenue over the whole table (X1 directly)."""
        orev = self.wh.order_revenue()
        r = ordered_window(orev, [Order("order_revenue_amount", True), Order("order_id")],
                           row_number="revenue_row_number", dense_rank="revenue_dense_rank",
                           lag={"prev_order_revenue": "order_revenue_amount"},
                           lead={"next_order_revenue": "order_revenue_amount"},
                           running_sum={"cumulative_revenue": "order_revenue_amount"},
                           **self.wh.window_opts)
        return r.select("order_id", "user_id", money_out("order_revenue_amount").alias("order_revenue"),
                        "revenue_row_number", "revenue_dense_rank",
                        money_out("prev_order_revenue").alias("prev_order_revenue"),
                        money_out("next_order_revenue").alias("next_order_revenue"),
                        money_out("cumulative_revenue").alias("cumulative_revenue"))


def similar_to_regex(pattern: str) -> str:
    """Translate a SQL ``SIMILAR TO`` pattern into an anchored Java regex."""
    out = []
    for ch in pattern:
        if ch == "%":
            out.append(".*")
        elif ch == "_":
            out.append(".")
        elif ch in ".^$\\":
            out.append("\\" + ch)
        else:
            out.append(ch)  # | ( ) * + ? { } keep their regex meaning
    return "^(?:" + "".join(out) + ")$"
