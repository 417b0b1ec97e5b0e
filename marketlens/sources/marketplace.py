"""Marketplace entities derived from the driver's input tables.

The analytics operate on a marketplace schema (users, addresses, shops,
categories, SKUs, offers/products, orders, order lines, payments).  The
driver ships TPC-H-like tables instead, so each entity is a deterministic
projection of them (documented in README.md, "Entity mapping").  Every
derived attribute is key arithmetic on built-in functions, so the same
mapping can be written in any SQL dialect and checked against an oracle.

All frames are lazy; ``Marketplace`` only memoises the DataFrame objects so
the same scan is reused inside one plan.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marketlens.functions.dates import ts_ntz
from marketlens.functions.money import MONEY, cents, money, money_from_cents
from marketlens.sources.sinks import materialize
from marketlens.sources.tables import read_table

# Enum domains of the marketplace source schema.
PAYMENT_PROVIDERS = ["card", "paypal", "bank_transfer", "cod"]
PAYMENT_STATUSES = ["pending", "authorized", "captured", "failed", "refunded", "cancelled"]
ORDER_STATUSES = ["pending", "paid", "shipped", "delivered", "cancelled", "refunded"]
USER_STATUSES = ["active", "banned", "inactive"]
SHOP_STATUSES = ["active", "suspended", "closed"]
PRODUCT_CONDITIONS = ["new", "used", "refurbished"]
MONETIZED_STATUSES = ["paid", "shipped", "delivered"]

# ids of addresses added by later snapshot batches
NEW_ADDRESS_BASE = 1_000_000_000_000

SNAPSHOT_AS_OF = ["2002-01-01 00:00:00", "2002-02-01 00:00:00", "2002-03-01 00:00:00"]


def _days(ts: Column, n: Column) -> Column:
    return ts + F.make_dt_interval(n.cast("int"), F.lit(0), F.lit(0), F.lit(0))


def _secs(ts: Column, n: Column) -> Column:
    return ts + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), n.cast("decimal(18,6)"))


def _s(c: Column) -> Column:
    return c.cast("string")


def product_key(sku_id: Column, shop_id: Column) -> Column:
    """``<sku>-<shop>``: one offer per shop and SKU; different pairs of any
    size have different keys, and a null part gives a null key."""
    return F.concat(_s(sku_id), F.lit("-"), _s(shop_id))


def payment_ref(order_id: Column) -> Column:
    """The provider's reference of an order's payment."""
    return F.concat(F.lit("pay/"), _s(order_id))


class Marketplace:
    """Entity frames over one input directory (``sf_dir``)."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir

    def raw(self, name: str) -> DataFrame:
        return read_table(self.spark, self.sf_dir, name)

    # ------------------------------------------------------------------ users
    @cached_property
    def users(self) -> DataFrame:
        c = self.raw("customer")
        k = F.col("c_custkey")
        created = _days(ts_ntz("1994-01-01 00:00:00"), F.pmod(k, F.lit(365)))
        return c.select(
            k.alias("id"),
            F.concat(F.lit("customer"), _s(k), F.lit("@example.com")).alias("email"),
            F.col("c_name").alias("full_name"),
            F.when(F.pmod(k, F.lit(5)) == 0, F.lit(None).cast("string"))
             .otherwise(F.concat(F.lit("+30"), F.lpad(_s(k), 10, "0"))).alias("phone"),
            F.when(F.pmod(k, F.lit(50)) == 0, F.lit("banned"))
             .when(F.col("c_acctbal") < 0, F.lit("inactive"))
             .otherwise(F.lit("active")).alias("status"),
            created.alias("created_at"),
            _days(created, F.lit(30)).alias("updated_at"),
        )

    # ------------------------------------------------------------------ shops
    @cached_property
    def shops(self) -> DataFrame:
        s = self.raw("supplier")
        k = F.col("s_suppkey")
        return s.select(
            k.alias("id"),
            F.concat(F.lit("Shop "), _s(k)).alias("name"),
            F.concat(F.lit("shop-"), _s(k)).alias("slug"),
            F.when(F.pmod(k, F.lit(9)) == 0, F.lit(None).cast("string"))
             .otherwise(F.concat(F.lit("https://shop"), _s(k), F.lit(".example"))).alias("url"),
            money_from_cents(F.lit(350) + F.pmod(k, F.lit(16)) * 10).cast("decimal(3,2)").alias("rating"),
            F.when(F.col("s_acctbal") < 0, F.lit("suspended")).otherwise(F.lit("active")).alias("status"),
            _days(ts_ntz("1993-01-01 00:00:00"), F.pmod(k, F.lit(365))).alias("created_at"),
        )

    # ------------------------------------------------------------- categories
    @cached_property
    def _category_ids(self) -> DataFrame:
        """The (type, brand) vocabulary with its numbers, stored once: SKUs,
        categories and all models over them read it instead of ``part``.

        The distinct vocabulary is small and bounded by the catalogue, not by
        the row count, so numbering it with one sorted window is cheap.  The
        (type, brand) order also satisfies the type-only order, so both
        ranks share one sort.
        """
        from pyspark.sql import Window as W
        pairs = self.raw("part").select("p_type", "p_brand").distinct()
        return materialize(pairs.select(
            "p_type", "p_brand",
            F.dense_rank().over(W.orderBy("p_type")).cast("long").alias("root_id"),
            (F.lit(100000) + F.dense_rank().over(W.orderBy("p_type", "p_brand"))).cast("long").alias("leaf_id")))

    @cached_property
    def categories(self) -> DataFrame:
        """Two-level tree: product type -> (type, brand)."""
        ranked = self._category_ids
        created = ts_ntz("1992-01-01 00:00:00").alias("created_at")
        roots = ranked.select("root_id", "p_type").distinct().select(
            F.col("root_id").alias("id"), F.lit(None).cast("long").alias("parent_id"),
            F.col("p_type").alias("name"), F.lower(F.col("p_type")).alias("slug"), created)
        leaves = ranked.select(
            F.col("leaf_id").alias("id"), F.col("root_id").alias("parent_id"),
            F.concat_ws(" ", "p_type", "p_brand").alias("name"),
            F.lower(F.concat_ws("-", "p_type", F.regexp_replace("p_brand", "#", ""))).alias("slug"), created)
        return roots.unionByName(leaves)

    @cached_property
    def _leaf_keys(self) -> DataFrame:
        # grouped by its key: the optimizer drops the join where nobody reads the category
        return (self._category_ids.select(F.concat_ws(" ", "p_type", "p_brand").alias("name"), "leaf_id")
                .groupBy("name").agg(F.min("leaf_id").alias("category_id")))

    # ------------------------------------------------------------------- skus
    @cached_property
    def skus(self) -> DataFrame:
        p = self.raw("part")
        k = F.col("p_partkey")
        leaf = F.concat_ws(" ", "p_type", "p_brand")
        # category leaves follow the type/brand vocabulary; AQE broadcasts
        # them after measuring their size
        return (p.withColumn("_leaf", leaf)
                .join(self._leaf_keys, F.col("_leaf") == F.col("name"), "left")
                .select(
                    k.alias("id"),
                    F.concat(F.lit("SKU-"), _s(k), F.lit("-"), _s(F.col("p_size"))).alias("sku_code"),
                    F.concat(F.upper(F.substring("p_name", 1, 1)), F.expr("substring(p_name, 2)")).alias("title"),
                    F.col("p_brand").alias("brand"),
                    F.col("category_id"),
                    F.to_json(F.struct(F.split("p_name", " ").getItem(0).alias("color"),
                                       F.col("p_size").alias("size"))).alias("attributes"),
                    _days(ts_ntz("1992-06-01 00:00:00"), F.pmod(k, F.lit(100))).alias("created_at"),
                ))

    # --------------------------------------------------------------- products
    @cached_property
    def products(self) -> DataFrame:
        """One offer per (shop, SKU) pair that appears in the order lines."""
        pairs = self.raw("lineitem").select("l_partkey", "l_suppkey").distinct()
        # grouped by its key: the optimizer drops the join where nobody reads the price
        part = self.raw("part").groupBy("p_partkey").agg(F.min("p_retailprice").alias("p_retailprice"))
        pk, sk = F.col("l_partkey"), F.col("l_suppkey")
        return (pairs.join(part, pk == F.col("p_partkey"), "left")
                .select(
                    product_key(pk, sk).alias("id"),
                    sk.alias("shop_id"),
                    pk.alias("sku_id"),
                    (money("p_retailprice") + F.pmod(sk, F.lit(10))).cast(MONEY).alias("price"),
                    F.lit("EUR").alias("currency"),
                    F.pmod(pk * 7 + sk * 3, F.lit(100)).cast("int").alias("stock"),
                    F.element_at(F.array(*[F.lit(x) for x in PRODUCT_CONDITIONS]),
                                 (F.pmod(pk + sk, F.lit(3)) + 1).cast("int")).alias("condition"),
                    (F.pmod(pk + sk, F.lit(10)) != 0).alias("is_active"),
                    _days(ts_ntz("1994-01-01 00:00:00"), F.pmod(pk, F.lit(365))).alias("created_at"),
                ))

    # ----------------------------------------------------------------- orders
    @cached_property
    def orders(self) -> DataFrame:
        o = self.raw("orders")
        k, c = F.col("o_orderkey"), F.col("o_custkey")
        created = _secs(F.col("o_orderdate"), F.pmod(k, F.lit(86400)))
        return o.select(
            k.alias("id"),
            c.alias("user_id"),
            (c * 2 + 1).alias("shipping_address_id"),
            F.when(F.pmod(k, F.lit(5)) == 0, c * 2 + 2).otherwise(c * 2 + 1).alias("billing_address_id"),
            F.when(F.col("o_orderstatus") == "F", F.lit("delivered"))
             .when((F.col("o_orderstatus") == "O") & (F.pmod(k, F.lit(3)) == 0), F.lit("shipped"))
             .when(F.col("o_orderstatus") == "O", F.lit("paid"))
             .otherwise(F.lit("pending")).alias("status"),
            money("o_totalprice").alias("total_amount"),
            F.lit("EUR").alias("currency"),
            k.alias("payment_id"),
            created.alias("created_at"),
            _days(created, F.lit(1)).alias("updated_at"),
        )

    # ------------------------------------------------------- order line items
    @cached_property
    def order_line_items(self) -> DataFrame:
        li = self.raw("lineitem")
        q = F.col("l_quantity").cast("int")
        return li.select(
            (F.col("l_orderkey") * 100 + F.col("l_linenumber")).alias("id"),
            F.col("l_orderkey").alias("order_id"),
            product_key(F.col("l_partkey"), F.col("l_suppkey")).alias("product_id"),
            F.col("l_partkey").alias("sku_id"),
            q.alias("quantity"),
            money_from_cents(F.expr("cast(round(l_extendedprice * 100) as bigint) div cast(l_quantity as int)")).alias("unit_price"),
            money("l_extendedprice").alias("line_total"),
        )

    # --------------------------------------------------------------- payments
    @cached_property
    def payments(self) -> DataFrame:
        """One per order.  A customer has one provider; an open order is
        authorized; where the cents divide by 11 a delivered order was given
        back and any other failed; the rest is captured."""
        o = self.raw("orders")
        k, status = F.col("o_orderkey"), F.col("o_orderstatus")
        price = cents(money("o_totalprice"))
        order_created = _secs(F.col("o_orderdate"), F.pmod(k, F.lit(86400)))
        return o.select(
            k.alias("id"),
            F.element_at(F.array(*[F.lit(x) for x in PAYMENT_PROVIDERS]),
                         (F.pmod(F.col("o_custkey"), F.lit(len(PAYMENT_PROVIDERS))) + 1).cast("int")).alias("provider"),
            F.when(status == "P", F.lit("authorized"))
             .when((F.pmod(price, F.lit(11)) == 0) & (status == "F"), F.lit("refunded"))
             .when(F.pmod(price, F.lit(11)) == 0, F.lit("failed"))
             .otherwise(F.lit("captured")).alias("status"),
            money("o_totalprice").alias("amount"),
            F.lit("EUR").alias("currency"),
            payment_ref(k).alias("external_ref"),
            _secs(order_created, F.pmod(price, F.lit(900))).alias("created_at"),
        )

    # -------------------------------------------------------------- addresses
    @cached_property
    def _address_base(self) -> DataFrame:
        c = self.raw("customer").select("c_custkey", "c_nationkey")
        nation = self.raw("nation")
        region = self.raw("region")
        # nation/region are small fixed dimensions; the planner broadcasts them
        # from their measured file size
        geo = nation.join(region, F.col("n_regionkey") == F.col("r_regionkey"), "left") \
            .select("n_nationkey", "n_name", "r_name")
        k = F.col("c_custkey")
        n = F.col("n")
        return (c.withColumn("n", F.explode(F.sequence(F.lit(1), F.lit(2))))
                .join(geo, F.col("c_nationkey") == F.col("n_nationkey"), "left")
                .select(
                    k.alias("user_id"), n,
                    (k * 2 + n).alias("id"),
                    F.col("n_name").alias("country"),
                    F.col("r_name").alias("region"),
                    F.concat(F.lit("City "), _s(F.pmod(k, F.lit(50)))).alias("city"),
                    F.lpad(_s(F.lit(10000) + F.pmod(k * 7 + n, F.lit(89999))), 5, "0").alias("postal_code"),
                    F.concat(F.lit("Street "), _s(F.pmod(k, F.lit(300)) + 1), F.lit(" "),
                             F.element_at(F.array(*[F.lit(x) for x in "ABCDE"]),
                                          (F.pmod(k + n, F.lit(5)) + 1).cast("int"))).alias("address_line1"),
                    F.when(F.pmod(k + n, F.lit(5)) == 0,
                           F.concat(F.lit("Apt "), _s(F.pmod(k, F.lit(50)) + 1))).alias("address_line2"),
                    (F.lit(34_000_000) + F.pmod(k * 7919 + n, F.lit(6_000_000))).cast("decimal(14,0)")
                    .__truediv__(F.lit(1_000_000)).cast("decimal(9,6)").alias("latitude"),
                    (F.lit(19_000_000) + F.pmod(k * 104729 + n, F.lit(8_000_000))).cast("decimal(14,0)")
                    .__truediv__(F.lit(1_000_000)).cast("decimal(9,6)").alias("longitude"),
                    _days(ts_ntz("1994-01-01 00:00:00"), F.pmod(k, F.lit(800))).alias("created_at"),
                ))

    ADDRESS_COLS = ["id", "country", "region", "city", "postal_code", "address_line1",
                    "address_line2", "latitude", "longitude", "created_at"]

    def addresses(self, batch: int = 1) -> DataFrame:
        """Address table as seen by snapshot run ``batch`` (1, 2 or 3).

        Batch 2: users with key % 11 = 0 deleted, key % 7 = 0 moved city,
        key % 13 = 0 filled a missing second line, key % 17 = 0 only had
        ``created_at`` touched, key % 19 = 0 added a new address.
        Batch 3: the deleted addresses come back unchanged.
        """
        base = self._address_base
        if batch == 1:
            return base.select(*self.ADDRESS_COLS)
        k = F.col("user_id")
        changed = base.select(
            "user_id",
            "id", "country", "region",
            F.when(F.pmod(k, F.lit(7)) == 0, F.concat(F.lit("City "), _s(F.pmod(k, F.lit(50)) + 100)))
             .otherwise(F.col("city")).alias("city"),
            "postal_code", "address_line1",
            F.when((F.pmod(k, F.lit(13)) == 0) & F.col("address_line2").isNull(), F.lit("Apt 99"))
             .otherwise(F.col("address_line2")).alias("address_line2"),
            "latitude", "longitude",
            F.when(F.pmod(k, F.lit(17)) == 0, _days(F.col("created_at"), F.lit(1)))
             .otherwise(F.col("created_at")).alias("created_at"),
        )
        kept = changed.filter(F.pmod(k, F.lit(11)) != 0)
        added = (base.filter((F.pmod(k, F.lit(19)) == 0) & (F.col("n") == 1))
                 .select((F.lit(NEW_ADDRESS_BASE) + k).alias("id"), "country", "region",
                         F.lit("City new").alias("city"), "postal_code",
                         F.lit("Street 1 Z").alias("address_line1"),
                         F.lit(None).cast("string").alias("address_line2"),
                         "latitude", "longitude", "created_at"))
        out = kept.select(*self.ADDRESS_COLS).unionByName(added)
        if batch == 2:
            return out
        if batch == 3:
            back = base.filter(F.pmod(k, F.lit(11)) == 0).select(*self.ADDRESS_COLS)
            return out.unionByName(back)
        raise ValueError(f"unknown snapshot batch {batch}")

    @cached_property
    def users_addresses(self) -> DataFrame:
        base = self._address_base
        k, n = F.col("user_id"), F.col("n")
        default = (n == 1) & (F.pmod(k, F.lit(23)) != 0)
        return base.select(
            k.alias("user_id"),
            F.col("id").alias("address_id"),
            F.when(n == 1, F.lit("Home")).otherwise(F.lit("Office")).alias("label"),
            default.alias("is_default_shipping"),
            default.alias("is_default_billing"),
            F.col("created_at"),
        )


class StaticMarketplace:
    """Entity frames given directly (hand-made fixtures, other sources).

    ``frames`` maps entity name -> DataFrame with the source schema used by
    ``Marketplace``; ``address_batches`` lists the address table per
    snapshot run.
    """

    def __init__(self, spark: SparkSession, frames: dict[str, DataFrame],
                 address_batches: list[DataFrame] | None = None, raw_tables: dict[str, DataFrame] | None = None):
        self.spark = spark
        self.sf_dir = None
        self._frames = dict(frames)
        self._batches = list(address_batches or ([frames["addresses"]] if "addresses" in frames else []))
        self._raw = dict(raw_tables or {})

    def __getattr__(self, name: str) -> DataFrame:
        frames = self.__dict__.get("_frames", {})
        if name in frames:
            return frames[name]
        raise AttributeError(name)

    def raw(self, name: str) -> DataFrame:
        return self._raw[name]

    def addresses(self, batch: int = 1) -> DataFrame:
        return self._batches[batch - 1]
