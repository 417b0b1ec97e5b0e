"""Hand-made marketplace fixtures (source schema of ``Marketplace``)."""

from __future__ import annotations

import datetime as dt
import re
from decimal import Decimal

from marketlens.plans.warehouse import Warehouse
from marketlens.sources.marketplace import StaticMarketplace

T0 = dt.datetime(2024, 1, 1, 9, 0, 0)

SCHEMAS = {
    "users": "id long, email string, full_name string, phone string, status string, created_at timestamp_ntz, "
             "updated_at timestamp_ntz",
    "shops": "id long, name string, slug string, url string, rating decimal(3,2), status string, "
             "created_at timestamp_ntz",
    "categories": "id long, parent_id long, name string, slug string, created_at timestamp_ntz",
    "skus": "id long, sku_code string, title string, brand string, category_id long, attributes string, "
            "created_at timestamp_ntz",
    "products": "id long, shop_id long, sku_id long, price decimal(12,2), currency string, stock int, "
                "condition string, is_active boolean, created_at timestamp_ntz",
    "orders": "id long, user_id long, shipping_address_id long, billing_address_id long, status string, "
              "total_amount decimal(12,2), currency string, payment_id long, created_at timestamp_ntz, "
              "updated_at timestamp_ntz",
    "order_line_items": "id long, order_id long, product_id long, sku_id long, quantity int, "
                        "unit_price decimal(12,2), line_total decimal(12,2)",
    "payments": "id long, provider string, status string, amount decimal(12,2), currency string, "
                "external_ref string, created_at timestamp_ntz",
    "addresses": "id long, country string, region string, city string, postal_code string, address_line1 string, "
                 "address_line2 string, latitude decimal(9,6), longitude decimal(9,6), created_at timestamp_ntz",
    "users_addresses": "user_id long, address_id long, label string, is_default_shipping boolean, "
                       "is_default_billing boolean, created_at timestamp_ntz",
}

DEFAULTS = {
    "users": dict(email=None, full_name="u", phone=None, status="active", created_at=T0, updated_at=T0),
    "shops": dict(name=None, slug=None, url=None, rating=Decimal("4.00"), status="active", created_at=T0),
    "categories": dict(parent_id=None, name=None, slug=None, created_at=T0),
    "skus": dict(sku_code=None, title="t", brand="b", category_id=None, attributes="{}", created_at=T0),
    "products": dict(currency="EUR", stock=1, condition="new", is_active=True, created_at=T0),
    "orders": dict(shipping_address_id=None, billing_address_id=None, status="paid", total_amount=Decimal("0"),
                   currency="EUR", payment_id=None, updated_at=T0),
    "order_line_items": dict(unit_price=Decimal("0")),
    "payments": dict(provider="card", status="captured", amount=Decimal("0"), currency="EUR", external_ref=None,
                     created_at=T0),
    "addresses": dict(country="GR", region=None, city="Athens", postal_code="10000", address_line1="Street 1",
                      address_line2=None, latitude=None, longitude=None, created_at=T0),
    "users_addresses": dict(label="Home", is_default_shipping=True, is_default_billing=True, created_at=T0),
}


def frame(spark, entity: str, rows: list[dict]):
    schema = SCHEMAS[entity]
    cols = [c.strip().split(" ")[0] for c in re.split(r",(?![^()]*\))", schema)]
    data = []
    for r in rows:
        full = {**DEFAULTS[entity], **r}
        data.append(tuple(full.get(c) for c in cols))
    return spark.createDataFrame(data, schema)


def warehouse(spark, address_batches=None, **entities) -> Warehouse:
    frames = {name: frame(spark, name, entities.get(name, [])) for name in SCHEMAS}
    batches = [frame(spark, "addresses", b) for b in address_batches] if address_batches else None
    mp = StaticMarketplace(spark, frames, address_batches=batches)
    return Warehouse(spark, marketplace=mp, window_opts={"num_buckets": 3})


def D(x) -> Decimal:
    return Decimal(str(x))
