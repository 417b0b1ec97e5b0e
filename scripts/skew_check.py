"""Skew check: one user owns a third of all orders.

Compares the largest task of a plain ``Window.partitionBy(user)`` with the
largest bucket of ``ordered_window`` (per-user lag/lead as in the
inter-purchase question) and checks both give identical results.
Usage: python scripts/skew_check.py [sf_dir] [rows_per_bucket]
"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    per_bucket = int(sys.argv[2]) if len(sys.argv) > 2 else 10_000
    from marketlens.operators.ordered_window import Order, ordered_window, plain_window
    from marketlens.plans.warehouse import Warehouse
    from marketlens.session import get_session
    spark = get_session()
    o = Warehouse(spark, sf_dir).stg_orders.select(
        F.when(F.pmod("order_id", F.lit(3)) == 0, F.lit(0)).otherwise(F.col("user_id")).alias("user_id"),
        "order_id", F.to_date("order_created_at").alias("order_dt"))
    total = o.count()
    hot = o.filter("user_id = 0").count()
    order = [Order("order_dt"), Order("order_id")]
    kw = dict(partition_by=["user_id"], lag={"prev_dt": "order_dt"}, lead={"next_dt": "order_dt"},
              row_number="rn")
    dist = ordered_window(o, order, target_rows_per_bucket=per_bucket, bucket_col="bucket", **kw)
    sizes = sorted((r["count"] for r in dist.groupBy("bucket").count().collect()), reverse=True)
    spans = dist.filter("user_id = 0").select("bucket").distinct().count()
    plain = plain_window(o, order, **kw)
    cols = ["order_id", "rn", "prev_dt", "next_dt"]
    diff = dist.select(*cols).exceptAll(plain.select(*cols)).count() + \
        plain.select(*cols).exceptAll(dist.select(*cols)).count()
    print(f"orders={total} hot_user_rows={hot} ({hot / total:.0%})")
    print(f"plain partitionBy(user): largest task >= {hot} rows ({hot / total:.0%})")
    print(f"ordered_window: {len(sizes)} buckets, largest {sizes[0]} rows ({sizes[0] / total:.1%}), "
          f"hot user spread over {spans} buckets; differing rows vs plain window: {diff}")


if __name__ == "__main__":
    main()
