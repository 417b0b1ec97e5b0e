"""Staging projections: rename source columns into the layer's vocabulary.

Pure projections, so Catalyst prunes unused columns down to the scan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Source column -> staging column, per entity.
STAGING_COLUMNS = {
    "addresses": [("id", "address_id"), ("country", "address_country"), ("region", "address_region"),
                  ("city", "address_city"), ("postal_code", "address_postal_code"),
                  ("address_line1", "address_line1"), ("address_line2", "address_line2"),
                  ("latitude", "latitude"), ("longitude", "longitude"), ("created_at", "address_created_at")],
    "categories": [("id", "category_id"), ("parent_id", "parent_id"), ("name", "category_name"),
                   ("slug", "category_slug"), ("created_at", "category_created_at")],
    "order_line_items": [("id", "order_line_items_id"), ("order_id", "order_id"), ("product_id", "product_id"),
                         ("sku_id", "sku_id"), ("quantity", "quantity"), ("unit_price", "unit_price"),
                         ("line_total", "line_total")],
    "orders": [("id", "order_id"), ("user_id", "user_id"), ("shipping_address_id", "shipping_address_id"),
               ("billing_address_id", "billing_address_id"), ("status", "order_status"),
               ("total_amount", "order_total_amount"), ("currency", "order_currency"),
               ("payment_id", "payment_id"), ("created_at", "order_created_at"),
               ("updated_at", "order_updated_at")],
    "payments": [("id", "payment_id"), ("provider", "provider"), ("status", "payment_status"),
                 ("amount", "payment_amount"), ("currency", "payment_currency"),
                 ("external_ref", "external_ref"), ("created_at", "payment_created_at")],
    "products": [("id", "product_id"), ("shop_id", "product_shop_id"), ("sku_id", "sku_id"),
                 ("price", "product_price"), ("currency", "currency"), ("stock", "product_stock"),
                 ("condition", "product_condition"), ("is_active", "product_is_active"),
                 ("created_at", "product_created_at")],
    "shops": [("id", "shop_id"), ("name", "shop_name"), ("slug", "shop_slug"), ("url", "shop_url"),
              ("rating", "shop_rating"), ("status", "shop_status"), ("created_at", "shop_created_at")],
    "skus": [("id", "sku_id"), ("sku_code", "sku_code"), ("title", "sku_title"), ("brand", "brand"),
             ("category_id", "category_id"), ("attributes", "sku_attributes"), ("created_at", "sku_created_at")],
    "users": [("id", "user_id"), ("email", "user_email"), ("full_name", "user_full_name"),
              ("phone", "user_phone"), ("status", "user_status"), ("created_at", "user_created_at"),
              ("updated_at", "user_updated_at")],
    "users_addresses": [("user_id", "user_id"), ("address_id", "address_id"), ("label", "user_address_label"),
                        ("is_default_shipping", "is_default_shipping"),
                        ("is_default_billing", "is_default_billing"),
                        ("created_at", "user_address_created_at")],
}


def stage(entity: str, df: DataFrame) -> DataFrame:
    """Rename/narrow projection of one source entity."""
    return df.select(*[F.col(src).alias(dst) for src, dst in STAGING_COLUMNS[entity]])
