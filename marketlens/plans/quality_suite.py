"""The marketplace data-quality suite (declared keys, domains, checks)."""

from __future__ import annotations

from marketlens.operators.quality import (
    FreshnessCheck, ReconcileCheck, RelationshipCheck, Suite, UniqueCheck, accepted_values, constraint, not_null,
)
from marketlens.sources.marketplace import (
    ORDER_STATUSES, PAYMENT_PROVIDERS, PAYMENT_STATUSES, PRODUCT_CONDITIONS, SHOP_STATUSES, USER_STATUSES,
)

KEYS = {
    "stg_addresses": "address_id", "stg_categories": "category_id", "stg_order_line_items": "order_line_items_id",
    "stg_orders": "order_id", "stg_payments": "payment_id", "stg_products": "product_id", "stg_shops": "shop_id",
    "stg_skus": "sku_id", "stg_users": "user_id",
}

#: Keys of the models above staging: no part is null, the parts are unique together.
MODEL_KEYS = {
    "category_revenue": ("category_id",),
    "products_per_shop": ("shop_id",),
    "revenue_per_shop": ("shop_id",),
    "user_orders": ("user_id",),
    "rep_category_performance": ("category_id",),
    "rep_main_kpis_per_shop": ("shop_id",),
    "rep_payment_summary": ("provider", "payment_status"),
    "rep_product_performance": ("product_id",),
    "rep_revenue_per_period": ("reporting_period", "reporting_date"),
    "rep_user_kpis_per_period": ("user_id", "reporting_period", "reporting_date"),
    "addresses_current": ("id",),
}

FRESHNESS_AS_OF = "2001-09-01 00:00:00"


def marketplace_suite() -> Suite:
    s = Suite()
    for t, k in KEYS.items():
        s.rows.append(not_null(t, k))
        s.uniques.append(UniqueCheck(t, (k,)))
    s.rows += [not_null("stg_users_addresses", "user_id"), not_null("stg_users_addresses", "address_id")]
    s.uniques += [UniqueCheck("stg_users_addresses", ("user_id", "address_id")),
                  UniqueCheck("stg_users", ("user_email",)), UniqueCheck("stg_shops", ("shop_name",)),
                  UniqueCheck("stg_shops", ("shop_slug",)), UniqueCheck("stg_skus", ("sku_code",)),
                  UniqueCheck("stg_categories", ("category_slug",)),
                  UniqueCheck("stg_products", ("product_shop_id", "sku_id"))]
    s.rows += [
        accepted_values("stg_orders", "order_status", ORDER_STATUSES),
        accepted_values("stg_payments", "payment_status", PAYMENT_STATUSES),
        accepted_values("stg_payments", "provider", PAYMENT_PROVIDERS),
        accepted_values("stg_products", "product_condition", PRODUCT_CONDITIONS),
        accepted_values("stg_users", "user_status", USER_STATUSES),
        accepted_values("stg_shops", "shop_status", SHOP_STATUSES),
        constraint("stg_order_line_items", "quantity", "quantity > 0"),
        constraint("stg_order_line_items", "unit_price", "unit_price >= 0"),
        constraint("stg_products", "product_price", "product_price >= 0"),
        constraint("stg_products", "product_stock", "product_stock >= 0"),
        constraint("stg_shops", "shop_rating", "shop_rating >= 0 and shop_rating <= 5"),
        constraint("stg_payments", "payment_amount", "payment_amount >= 0"),
        constraint("stg_orders", "order_total_amount", "order_total_amount >= 0"),
    ]
    s.relationships += [
        RelationshipCheck("stg_order_line_items", "order_id", "stg_orders", "order_id"),
        RelationshipCheck("stg_order_line_items", "product_id", "stg_products", "product_id"),
        RelationshipCheck("stg_order_line_items", "sku_id", "stg_skus", "sku_id"),
        RelationshipCheck("stg_orders", "user_id", "stg_users", "user_id"),
        RelationshipCheck("stg_orders", "payment_id", "stg_payments", "payment_id"),
        RelationshipCheck("stg_products", "product_shop_id", "stg_shops", "shop_id"),
        RelationshipCheck("stg_products", "sku_id", "stg_skus", "sku_id"),
        RelationshipCheck("stg_skus", "category_id", "stg_categories", "category_id"),
        RelationshipCheck("stg_categories", "parent_id", "stg_categories", "category_id"),
        RelationshipCheck("stg_users_addresses", "address_id", "stg_addresses", "address_id"),
        RelationshipCheck("stg_users_addresses", "user_id", "stg_users", "user_id"),
        RelationshipCheck("stg_orders", "shipping_address_id", "stg_addresses", "address_id"),
        RelationshipCheck("stg_orders", "billing_address_id", "stg_addresses", "address_id"),
    ]
    s.freshness.append(FreshnessCheck("stg_orders", "order_created_at", FRESHNESS_AS_OF, 60))
    s.reconcile.append(ReconcileCheck("stg_orders", "order_id", "order_total_amount", "stg_order_line_items",
                                      "order_id", "line_total"))
    return s


def model_suite() -> Suite:
    s = Suite()
    for model, key in MODEL_KEYS.items():
        s.rows += [not_null(model, k) for k in key]
        s.uniques.append(UniqueCheck(model, key))
    return s
