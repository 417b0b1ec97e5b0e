"""Table jobs: snapshots, keyed updates, repeated orders and the bridge/offer
derivations.

Nothing reads the wall clock: snapshots run at the dates of ``Marketplace``,
and a repeated order is dated by the order that it repeats.
"""

from __future__ import annotations

import math
from functools import cached_property

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketlens.functions.dates import ts_ntz
from marketlens.functions.money import MONEY, money_out
from marketlens.operators.keyed import insert_skip_conflict, update_from
from marketlens.operators.scd2 import current_versions, scd2_apply
from marketlens.plans.warehouse import Warehouse
from marketlens.sources.marketplace import SNAPSHOT_AS_OF, payment_ref
from marketlens.sources.keyed_tables import insert_stored, update_stored
from marketlens.sources.sinks import materialize, write_table

# Columns compared by the address snapshot.
ADDRESS_CHECK_COLS = ["country", "region", "city", "postal_code", "address_line1", "address_line2",
                      "latitude", "longitude"]

# Order status implied by a payment outcome.
PAYMENT_TO_ORDER_STATUS = [("captured", "paid"), ("authorized", "pending"), ("failed", "cancelled"),
                           ("cancelled", "cancelled"), ("refunded", "refunded")]

#: Pairs that a task of ``sampled_pairs`` makes.
PAIRS_PER_TASK = 20_000_000
#: Ids of a block of ``sampled_pairs``.
BLOCK_IDS = 256
#: Days after which a customer's last order is placed again.
REPEAT_DAYS = 28
#: Days of payments that an update of stored orders takes.
RECENT_DAYS = 30


def order_status_expr(payment_status: Column, current: Column) -> Column:
    expr = None
    for p, o in PAYMENT_TO_ORDER_STATUS:
        expr = F.when(payment_status == p, F.lit(o)) if expr is None else expr.when(payment_status == p, F.lit(o))
    return expr.otherwise(current)


class Jobs:
    def __init__(self, wh: Warehouse):
        self.wh = wh
        self.mp = wh.mp

    # ------------------------------------------------------------- SCD2
    def addresses_history(self, batches: int = 3) -> DataFrame:
        """History after ``batches`` snapshot runs.

        Each run reads the previous history twice (closed and open
        versions), so the previous run is materialised first, as a stored
        snapshot table would be; the plan stays linear in the number of runs.
        """
        hist = None
        for b in range(1, batches + 1):
            if hist is not None:
                hist = materialize(hist)
            hist = scd2_apply(hist, self.mp.addresses(b), "id", ADDRESS_CHECK_COLS, ts_ntz(SNAPSHOT_AS_OF[b - 1]))
        return hist

    def addresses_current(self, history: DataFrame | None = None) -> DataFrame:
        """The open versions of a stored ``history``, or of one made here."""
        h = current_versions(self.addresses_history() if history is None else history)
        return h.select("id", "country", "region", "city", "postal_code", "address_line1", "address_line2",
                        "latitude", "longitude", "created_at", "valid_from")

    # ------------------------------------------------------ keyed updates
    def default_address(self) -> DataFrame:
        """Default shipping/billing address per user, falling back to any address."""
        ua = self.wh.stg("users_addresses")
        agg = ua.groupBy("user_id").agg(
            F.max(F.when(F.col("is_default_shipping"), F.col("address_id"))).alias("default_ship"),
            F.max(F.when(F.col("is_default_billing"), F.col("address_id"))).alias("default_bill"),
            F.min("address_id").alias("any_address"))
        return agg.select("user_id",
                          F.coalesce("default_ship", "any_address").alias("shipping_address_id"),
                          F.coalesce("default_bill", "any_address").alias("billing_address_id"))

    def order_totals_recalc(self) -> DataFrame:
        """orders.total_amount := sum(line_total) for orders that have lines."""
        orders = self.wh.stg_orders.select("order_id", "order_total_amount",
                                           F.col("order_total_amount").alias("previous_total_amount"))
        totals = self.wh.stg_lines.groupBy("order_id").agg(F.sum("line_total").alias("sum_total"))
        upd = update_from(orders, totals, ["order_id"],
                          {"order_total_amount": F.col("s.sum_total").cast(MONEY)}, unique=True)
        return upd.select("order_id", money_out("order_total_amount").alias("order_total_amount"),
                          money_out("previous_total_amount").alias("previous_total_amount"))

    @staticmethod
    def _status_from_payment() -> dict[str, Column]:
        return {"payment_id": F.col("s.pid"),
                "order_status": order_status_expr(F.col("s.payment_status"), F.col("t.order_status")),
                "order_updated_at": F.greatest(F.col("t.order_updated_at"), F.col("s.payment_created_at"))}

    def order_status_from_payment(self) -> DataFrame:
        """Order status and updated_at derived from the linked payment outcome."""
        orders = self.wh.stg_orders.select("order_id", "order_status", "payment_id", "order_updated_at")
        pay = self.wh.stg_payments.select(F.col("external_ref"), F.col("payment_id").alias("pid"),
                                          "payment_status", "payment_created_at")
        keyed = orders.withColumn("external_ref", payment_ref(F.col("order_id")))
        upd = update_from(keyed, pay, ["external_ref"], self._status_from_payment())
        return upd.select("order_id", "payment_id", "order_status", "order_updated_at")

    def payment_batch(self) -> DataFrame:
        """A batch of payments with duplicate and existing keys: the repeated
        orders' payments twice (a retry with the same key, one minute later)
        and a re-send of the whole existing table."""
        topup = self._repeated_payments.drop("order_id")
        retry = topup.withColumn("payment_created_at",
                                 F.col("payment_created_at") + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(1)))
        return topup.unionByName(retry).unionByName(self.wh.stg_payments)

    def insert_skip_conflict(self) -> DataFrame:
        """Payments table after inserting the batch; conflicts are skipped,
        duplicates keep the earliest row."""
        target = self.wh.stg_payments
        new_rows = insert_skip_conflict(target, self.payment_batch(), ["payment_id"], ["payment_created_at", "payment_status"])
        return target.unionByName(new_rows)

    def payments_inserted(self, path: str) -> DataFrame:
        """The same insert into a stored table, which is partitioned by the
        month of the payment: new rows are appended."""
        month = F.date_format("payment_created_at", "yyyy-MM").alias("payment_month")
        write_table(self.wh.stg_payments.select("*", month), path, partition_by=["payment_month"])
        insert_stored(self.wh.spark, path, self.payment_batch().select("*", month), ["payment_id"],
                      ["payment_created_at", "payment_status"], ["payment_month"])
        return self.wh.spark.read.parquet(path).drop("payment_month")

    def orders_updated(self, path: str) -> DataFrame:
        """Order status from the payments of the last ``RECENT_DAYS`` days, in
        a stored table of orders by month: only their months are written."""
        spark = self.wh.spark
        orders = self.wh.stg_orders.select("order_id", "order_status", "payment_id", "order_updated_at",
                                           F.date_format("order_created_at", "yyyy-MM").alias("order_month"))
        write_table(orders.withColumn("external_ref", payment_ref(F.col("order_id"))), path, partition_by=["order_month"])
        newest = self.wh.stg_payments.agg(F.max("payment_created_at")).scalar()
        recent = self.wh.stg_payments.where(F.col("payment_created_at") >= newest - F.make_dt_interval(F.lit(RECENT_DAYS)))
        update_stored(spark, path, recent.select("external_ref", F.col("payment_id").alias("pid"), "payment_status", "payment_created_at"),
                      ["external_ref"], self._status_from_payment(), ["order_month"])
        return spark.read.parquet(path).select("order_id", "payment_id", "order_status", "order_updated_at")

    # ---------------------------------------------------- repeated orders
    @cached_property
    def _repeat_plan(self) -> DataFrame:
        """Stored, as all that follows reads it: every user's last order, to be placed again ``REPEAT_DAYS`` later
        for the user's default addresses: ``last_id`` and the new columns.
        New ids are the last id of the table plus the repeated order's."""
        orders = self.wh.stg_orders
        top = orders.agg(F.max("order_id")).scalar()
        last = orders.groupBy("user_id").agg(F.max(F.struct("order_id", "order_created_at", "order_currency")).alias("o"))
        return materialize(last.join(self.default_address(), "user_id").select(
            F.col("o.order_id").alias("last_id"), (top + F.col("o.order_id")).alias("order_id"), "user_id",
            "shipping_address_id", "billing_address_id", F.col("o.order_currency").alias("order_currency"),
            (F.col("o.order_created_at") + F.make_dt_interval(F.lit(REPEAT_DAYS))).alias("order_created_at")))

    def order_topup_lines(self) -> DataFrame:
        """The lines of the last orders whose offer is still active, at its
        price of today; ``item_n`` is the line's number in the old order."""
        wh = self.wh
        active = wh.stg_products.filter(F.col("product_is_active")).select("product_id", "product_price")
        plan = self._repeat_plan.select("last_id", F.col("order_id").alias("new_id"))
        lines = wh.stg_lines.join(plan, F.col("order_id") == F.col("last_id")).join(active, "product_id")
        return lines.select(
            F.col("new_id").alias("order_id"), (F.col("order_line_items_id") - F.col("last_id") * 100).alias("item_n"),
            "product_id", "sku_id", "quantity", F.col("product_price").alias("unit_price"),
            (F.col("quantity") * F.col("product_price")).cast(MONEY).alias("line_total"))

    def order_topup_payments(self) -> DataFrame:
        """A payment per repeated order with something in it, by the provider
        of the last one: authorized, and captured where that one was."""
        wh = self.wh
        top = wh.stg_payments.agg(F.max("payment_id")).scalar()
        totals = self.order_topup_lines().groupBy("order_id").agg(F.sum("line_total").cast(MONEY).alias("payment_amount"))
        paid = wh.stg_orders.select(F.col("order_id").alias("last_id"), "payment_id").join(
            wh.stg_payments.select("payment_id", "provider", "payment_status"), "payment_id")
        return self._repeat_plan.join(totals, "order_id").join(paid, "last_id").select(
            (top + F.col("payment_id")).alias("payment_id"), "order_id", "provider",
            F.when(F.col("payment_status") == "captured", "captured").otherwise("authorized").alias("payment_status"),
            "payment_amount", F.col("order_currency").alias("payment_currency"),
            payment_ref(F.col("order_id")).alias("external_ref"), F.col("order_created_at").alias("payment_created_at"))

    @cached_property
    def _repeated_payments(self) -> DataFrame:
        return materialize(self.order_topup_payments())

    def order_topup_orders(self) -> DataFrame:
        """The repeated orders that have a payment; its amount is their total."""
        pay = self._repeated_payments.select("order_id", "payment_id", "payment_status", "payment_amount")
        return self._repeat_plan.join(pay, "order_id").select(
            "order_id", "user_id", "shipping_address_id", "billing_address_id",
            order_status_expr(F.col("payment_status"), F.lit("pending")).alias("order_status"),
            F.col("payment_amount").alias("order_total_amount"), "order_currency", "payment_id",
            "order_created_at", F.col("order_created_at").alias("order_updated_at"))

    # ------------------------------------------------- bridge / offers
    def range_join_bridge(self) -> DataFrame:
        """Link users to addresses whose id is in [2u+1, 2u+2]; first is default.

        The BETWEEN condition is rewritten to the equi-key
        ``(address_id - 1) div 2 = user_id`` so it plans as a hash join
        instead of a nested loop.
        """
        users = self.wh.stg("users").select("user_id")
        addr = self.wh.stg("addresses").select("address_id")
        j = addr.withColumn("user_id", F.expr("(address_id - 1) div 2")).join(users, "user_id")
        from pyspark.sql import Window
        # at most two addresses per user by construction of the range
        rn = F.row_number().over(Window.partitionBy("user_id").orderBy("address_id"))
        j = j.withColumn("rn", rn)
        return j.select("user_id", "address_id",
                        F.when(F.col("rn") == 1, F.lit("Home")).otherwise(F.lit("Office")).alias("label"),
                        (F.col("rn") == 1).alias("is_default_shipping"),
                        (F.col("rn") == 1).alias("is_default_billing"))

    def sampled_pairs(self, pct: int = 20) -> DataFrame:
        """Offers for a deterministic ``pct``% sample of (shop, SKU) pairs.

        A pair is kept when ``(31*shop + 17*sku) mod 100 < pct``, which the
        classes of the two ids mod 100 decide.  The pairs grow with the
        product of the two tables, so neither is multiplied row by row: shops
        and SKUs are dealt evenly, whatever their ids, along the sides of a
        grid whose cells have ``PAIRS_PER_TASK`` pairs, a task each.  The ids
        of a part and class make blocks of ``BLOCK_IDS`` at most, which are
        sent to the cells of their part and joined there by class: only kept
        pairs are ever produced, and what is shuffled grows with the number
        of cells times the side of one, not with the pairs.

        A task streams its pairs block by block, so in a file one column stays
        the same for a block and the other repeats a block's few ids.
        """
        shops, skus = self.wh.stg_shops.select("shop_id"), self.wh.stg_skus.select("sku_id")
        n_shops, n_skus = shops.count(), skus.count()
        tasks = max(1, -(-n_shops * n_skus * pct // (100 * PAIRS_PER_TASK)))
        shop_parts = min(tasks, max(1, math.ceil(math.sqrt(tasks * n_shops / max(1, n_skus)))))
        sku_parts = -(-tasks // shop_parts)
        cells = shop_parts * sku_parts

        def blocks(ids: DataFrame, name: str, parts: int) -> DataFrame:
            key = F.col(f"{name}_id")
            dealt = ids.where(key.isNotNull()).select(
                F.pmod(F.monotonically_increasing_id(), F.lit(parts)).alias(f"{name}_part"),
                F.pmod(key, F.lit(100)).alias(f"{name}_class"), key)
            lists = dealt.groupBy(f"{name}_part", f"{name}_class").agg(F.collect_list(key).alias("ids"))
            starts = F.sequence(F.lit(1), F.size("ids"), F.lit(BLOCK_IDS))
            cut = F.transform(starts, lambda i: F.slice("ids", i, F.lit(BLOCK_IDS)))
            return lists.select(f"{name}_part", f"{name}_class", F.explode(cut).alias(f"{name}_ids"))

        def sent(side: DataFrame, other: str, parts: int) -> DataFrame:
            each = side.withColumn(f"{other}_part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))
            cell = (F.col("shop_part") * sku_parts + F.col("sku_part")).cast("int")
            return each.withColumn("cell", cell).drop("shop_part", "sku_part").repartitionById(cells, "cell")

        shop_blocks = sent(blocks(shops, "shop", shop_parts), "sku", sku_parts)
        sku_blocks = sent(blocks(skus, "sku", sku_parts), "shop", shop_parts)
        # a cell is bounded, but the planner's estimate does not count how often blocks are sent: no broadcast
        kept = F.pmod(31 * F.col("shop_class") + 17 * F.col("sku_class"), F.lit(100)) < pct
        joined = sku_blocks.join(shop_blocks.hint("shuffle_hash"), "cell").where(kept)
        # compiled code holds all rows that come of one input row; coalesce, here to as many tasks, ends
        # it between the two explodes, so that these are the rows of one block and not all pairs of several
        lists = joined.select("shop_ids", F.explode("sku_ids").alias("sku_id")).coalesce(cells)
        return lists.select(F.explode("shop_ids").alias("shop_id"), "sku_id")
