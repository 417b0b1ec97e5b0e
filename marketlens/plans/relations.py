"""Joins and tables of a general kind: ranges, lateral top-k, deep chains,
sorted and exact storage."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marketlens.operators.deep_tree import resolve_tree, unreachable
from marketlens.operators.interval_join import interval_join
from marketlens.operators.lateral import lateral_top_k
from marketlens.operators.ordered_window import Order
from marketlens.plans.warehouse import Warehouse
from marketlens.sources.marketplace import MONETIZED_STATUSES
from marketlens.sources.sinks import append_checked, materialize, read_in_order, write_sorted, write_table

#: A user's range of address ids: users of every 50th id reach this far.
WIDE_RANGE = 2000


class Relations:
    def __init__(self, wh: Warehouse):
        self.wh = wh

    # ------------------------------------------------------ interval joins
    def addresses_in_range(self) -> DataFrame:
        """Per user the addresses in the user's range of ids: ranges overlap,
        those of every 7th user end before they start, those of every 50th
        are wide."""
        u = F.col("user_id")
        users = self.wh.stg("users").select(
            "user_id", (u * 2 + 1 - u % 5).alias("first_id"),
            F.when(u % 50 == 0, u * 2 + WIDE_RANGE).when(u % 7 == 0, u * 2 - 9).otherwise(u * 2 + u % 4).alias("last_id"))
        addresses = self.wh.stg("addresses").select("address_id")
        pairs = interval_join(addresses, users, "address_id", "first_id", "last_id")
        return pairs.groupBy("user_id").agg(F.count(F.lit(1)).alias("addresses"), F.min("address_id").alias("first_address"),
                                            F.max("address_id").alias("last_address"))

    def events_before_purchases(self, hours: int = 24) -> DataFrame:
        """Per purchase the events of its user in the hours up to it (a range
        of time within an equal key)."""
        events = self.wh.mp.raw("events").select("user_id", "ts", "event_id", "event_type")
        bought = events.where(F.col("event_type") == "purchase").select(
            "user_id", F.col("event_id").alias("purchase_id"), (F.col("ts") - F.make_dt_interval(F.lit(0), F.lit(hours))).alias("opens"),
            F.col("ts").alias("closes"))
        pairs = interval_join(events, bought, "ts", "opens", "closes", on=["user_id"], unit=3.6e9)
        return pairs.groupBy("purchase_id", "user_id").agg(F.count(F.lit(1)).alias("events"), F.min("ts").alias("first_event"),
                                                           F.max("ts").alias("last_event"))

    # ------------------------------------------------------- lateral joins
    def cheapest_offers(self, k: int = 3, least_stock: int = 90) -> DataFrame:
        """Every SKU with its ``k`` cheapest well-stocked offers; a SKU without
        one has a row that says so."""
        offers = self.wh.stg_products.where(F.col("product_stock") >= least_stock).select(
            F.col("sku_id").alias("offer_sku"), "product_id", F.col("product_price").alias("price"))
        skus = self.wh.stg_skus.select("sku_id")
        return lateral_top_k(skus, offers, [("sku_id", "offer_sku")], [F.col("price"), F.col("product_id")], k,
                             fallback={"product_id": F.lit("none")}).drop("offer_sku")

    def user_address(self) -> DataFrame:
        """Every user with one address: a default of shipping first, else any;
        a user without an address has null."""
        linked = self.wh.stg("users_addresses").where(F.col("address_id") % 3 != 0).select(
            F.col("user_id").alias("owner"), "address_id", F.col("is_default_shipping").alias("is_default"))
        users = self.wh.stg("users").select("user_id")
        return lateral_top_k(users, linked, [("user_id", "owner")], [F.col("is_default").desc(), F.col("address_id")], 1,
                             fallback={"is_default": F.lit(False)}).drop("owner")

    # ------------------------------------------------ series and round robin
    def small_line_units(self, most: int = 3) -> DataFrame:
        """A row for each unit of order lines of ``most`` units at most, as for
        labels: a series from 1 to the quantity, per row."""
        lines = self.wh.stg_lines.where(F.col("quantity").between(1, most))
        return lines.select("order_id", "product_id", "quantity",
                            F.explode(F.sequence(F.lit(1), F.col("quantity"))).alias("unit_no"))

    def orders_dealt(self, least_rating: float = 4.9) -> DataFrame:
        """Orders, by id, dealt in turn to the best-rated shops, by id: the
        n-th order goes to shop (n - 1) mod count + 1.  Orders are numbered by
        the distributed window; the shops that take part are few and numbered
        by a plain one."""
        shops = self.wh.stg_shops.where(F.col("shop_rating") >= least_rating).select("shop_id")
        turns = materialize(shops.withColumn("turn", F.row_number().over(Window.orderBy("shop_id")).cast("long")))
        number = turns.agg(F.count(F.lit(1))).scalar()
        orders = self.wh._ow(self.wh.stg_orders.select("order_id"), [Order("order_id")], row_number="order_no")
        keyed = orders.withColumn("turn", F.when(number > 0, F.pmod(F.col("order_no") - 1, F.when(number > 0, number)) + 1))
        return keyed.join(turns, "turn").select("order_id", "order_no", "shop_id")

    # --------------------------------------------------------- deep chains
    def _order_links(self) -> DataFrame:
        """Every order and the one that its user placed before."""
        before = Window.partitionBy("user_id").orderBy("order_id")
        return self.wh.stg_orders.select("order_id", "user_id", "order_status", F.lag("order_id").over(before).alias("previous_id"))

    def order_chains(self) -> DataFrame:
        """Every order with the first of its user and its number of earlier ones."""
        chain = resolve_tree(materialize(self._order_links()), id_col="order_id", parent_col="previous_id")
        return chain.select("order_id", F.col("root_id").alias("first_order_id"), F.col("depth").alias("earlier_orders"))

    def broken_chains(self) -> DataFrame:
        """Monetized orders whose chain of monetized orders does not reach
        their user's first order."""
        links = materialize(self._order_links().where(F.col("order_status").isin(MONETIZED_STATUSES)))
        return unreachable(links, id_col="order_id", parent_col="previous_id")

    # -------------------------------------------------------------- storage
    def sorted_periods(self, path: str) -> DataFrame:
        """Revenue per period as a table in order, read back with its places."""
        rows = self.wh.rep_revenue_per_period().select("reporting_period", "reporting_date", "total_orders")
        write_sorted(rows, path, [F.col("reporting_period"), F.col("reporting_date")])
        return read_in_order(self.wh.spark, path)

    def exact_daily(self, path: str) -> DataFrame:
        """Daily revenue stored as decimals, the latest year appended; sums as
        they are stored, to the cent."""
        daily = materialize(Warehouse(self.wh.spark, marketplace=self.wh.mp, exact=True).revenue_daily())
        last = daily.agg(F.trunc(F.max("order_date"), "year")).scalar()
        write_table(daily.where(F.col("order_date") < last), path)
        append_checked(daily.where(F.col("order_date") >= last), path)
        return self.wh.spark.read.parquet(path).groupBy(F.year("order_date").alias("order_year")).agg(
            F.sum("total_revenue").cast("string").alias("revenue"), F.count(F.lit(1)).alias("days"))
