"""Every registered query against its DuckDB oracle on the sf0.001 tables."""

import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "scripts"))

from marketlens.plans.registry import ORACLE, QUERIES  # noqa: E402
from check_oracle import TABLES, rows  # noqa: E402

SF = "/root/testdata/sf0.001"
NAMES = sorted(QUERIES)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        p = f"{SF}/{t}.parquet"
        if os.path.exists(p):
            con.sql(f"create view {t} as select * from read_parquet('{p}')")
    return con


def test_every_query_has_oracle_or_is_documented():
    missing = set(QUERIES) - set(ORACLE)
    assert not missing, missing


def test_entry_smoke(spark):
    import __spark_entry__ as entry
    df = entry.entry(spark)
    assert df.count() > 0 and df.columns == ["order_date", "total_revenue", "total_orders"]


SPARK_TO_SQL = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "date": "DATE",
                "timestamp_ntz": "TIMESTAMP", "boolean": "BOOLEAN"}


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, duck, name):
    frame = QUERIES[name](spark, SF)
    types = {f.name: SPARK_TO_SQL.get(f.dataType.simpleString(), f.dataType.simpleString())
             for f in frame.schema.fields}
    assert types == {r[0]: r[1] for r in duck.sql("describe " + ORACLE[name]).fetchall()}
    sdf = frame.toPandas()
    ddf = duck.sql(ORACLE[name]).df()
    assert sorted(sdf.columns) == sorted(ddf.columns)
    assert len(sdf) == len(ddf)
    assert rows(sdf, True) == rows(ddf, True)


DISTRIBUTED = ["product_performance", "rep_product_performance", "rep_main_kpis_per_shop", "revenue_per_shop",
               "products_per_shop", "user_orders", "ex_interpurchase", "global_rank_distributed"]


@pytest.mark.parametrize("name", DISTRIBUTED)
def test_distributed_window_path_matches_oracle(spark, duck, name, monkeypatch):
    """Force many buckets so the split-point / offset path runs on real queries."""
    import marketlens.operators.ordered_window as ow
    monkeypatch.setattr(ow, "DEFAULT_ROWS_PER_BUCKET", 97)
    sdf = QUERIES[name](spark, SF).toPandas()
    ddf = duck.sql(ORACLE[name]).df()
    assert len(sdf) == len(ddf)
    assert rows(sdf, False) == rows(ddf, False)
