"""Typed scans of the input Parquet tables.

The schema is given explicitly so a drifting file fails loudly instead of
silently changing types; column pruning and filter pushdown still reach the
Parquet reader because the scan stays a plain ``spark.read.parquet``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLE_SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey long, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey long, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": ("o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, "
               "o_orderdate timestamp_ntz, o_orderpriority string"),
    "lineitem": ("l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, "
                 "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, "
                 "l_linestatus string, l_shipdate timestamp_ntz"),
    "events": "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string",
}


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    reader = spark.read
    schema = TABLE_SCHEMAS.get(name)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
