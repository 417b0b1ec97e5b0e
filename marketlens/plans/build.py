"""Build the warehouse: staging models as views, the rest as tables.

Staging models stay lazy (temp views over the sources); intermediate and
reporting models are written as Parquet tables under ``target/<layer>`` (or a
custom folder per layer), each a full refresh.  The address history is not
refreshed: every build continues the stored one with the extracts that are
newer than its last run.  Models are written one after another in a fixed
order; nothing here schedules or plans — every model is its own Spark job.
What several models are made of is computed by the first of them and read
from storage by the others; the current addresses are read from the history.

With ``catalog`` the layers are schemas of the session's catalog, the models
their tables, and the current addresses a lasting view of the history's open
versions, which needs no rewriting when the history goes on.  With ``exact``
amounts are stored as decimals; otherwise as double.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import cache, partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketlens.functions.money import decimals_to_double
from marketlens.plans.exercises import Exercises
from marketlens.plans.jobs import ADDRESS_CHECK_COLS, Jobs
from marketlens.plans.warehouse import Warehouse
from marketlens.sources.catalog import attach, create_layer, create_view, save_model
from marketlens.sources.history import apply_extract, history
from marketlens.sources.marketplace import SNAPSHOT_AS_OF
from marketlens.sources.sinks import layer_location, materialize, write_table

STAGING = ["addresses", "categories", "order_line_items", "orders", "payments", "products", "shops", "skus",
           "users", "users_addresses"]

HISTORY_LAYER, HISTORY, CURRENT = "historical", "addresses_hist", "dim_addresses_current"

# (layer, model name, builder) in dependency order
TABLE_MODELS = [
    ("intermediate", "int_addresses", lambda wh: wh.int_addresses()),
    ("intermediate", "int_category_hierarchy", lambda wh: Exercises(wh).category_hierarchy()),
    ("intermediate", "int_category_revenue", lambda wh: wh.category_revenue()),
    ("intermediate", "int_payment_summary", lambda wh: wh.payment_summary()),
    ("intermediate", "int_product_performance", lambda wh: wh.product_performance()),
    ("intermediate", "int_products_per_shop", lambda wh: wh.products_per_shop()),
    ("intermediate", "int_revenue_daily", lambda wh: wh.revenue_daily()),
    ("intermediate", "int_revenue_per_shop", lambda wh: wh.revenue_per_shop()),
    ("intermediate", "int_user_orders", lambda wh: wh.user_orders()),
    ("reporting", "dim_reporting_periods", lambda wh: wh.reporting_periods()),
    ("reporting", "rep_category_performance", lambda wh: wh.rep_category_performance()),
    ("reporting", "rep_main_kpis_per_shop", lambda wh: wh.rep_main_kpis_per_shop()),
    ("reporting", "rep_payment_summary", lambda wh: wh.rep_payment_summary()),
    ("reporting", "rep_product_performance", lambda wh: wh.rep_product_performance()),
    ("reporting", "rep_revenue_per_period", lambda wh: wh.rep_revenue_per_period()),
    ("reporting", "rep_user_kpis_per_period", lambda wh: wh.rep_user_kpis_per_period()),
    (HISTORY_LAYER, HISTORY, None),
    ("current_views", CURRENT, lambda wh: Jobs(wh).addresses_current(wh.history)),
]

# exact aggregates that an intermediate model and reports share
SHARED = ["revenue_daily_exact", "products_per_shop_exact", "revenue_per_shop_exact", "category_revenue_exact",
          "payment_summary_exact", "_product_perf_base"]

# date-partitioned reports: later reads of a period prune folders
PARTITION_BY = {"rep_revenue_per_period": ["reporting_period"], "rep_user_kpis_per_period": ["reporting_period"]}


class StoredWarehouse(Warehouse):
    """A warehouse of one build: shared aggregates are stored at first use,
    with their exact decimals."""

    #: The address history as this build has left it.
    history: DataFrame | None = None

    def __init__(self, *args, **kw):
        super().__init__(*args, **kw)
        for name in SHARED:
            setattr(self, name, cache(partial(self._store, getattr(self, name))))

    @staticmethod
    def _store(model: Callable[[], DataFrame]) -> DataFrame:
        return materialize(model())


class KeyWarehouse(Warehouse):
    """For checks of the models' keys: windows, which add columns to rows but
    neither rows nor keys, are left out; everything else is as it is.  Nothing
    is stored on the way, so that who selects the keys of a model has Spark
    compute the joins and groups that decide its rows, and no sums."""

    def _kept(self, df: DataFrame) -> DataFrame:
        return df

    def _ow(self, df: DataFrame, order, **kw) -> DataFrame:
        made = [kw.get("row_number"), kw.get("dense_rank"), *(kw.get("lag") or {}), *(kw.get("lead") or {}), *(kw.get("running_sum") or {})]
        sources = {**(kw.get("lag") or {}), **(kw.get("lead") or {}), **(kw.get("running_sum") or {})}
        return df.withColumns({c: F.lit(None).cast(df.schema[sources[c]].dataType if c in sources else "long") for c in made if c})


#: The view's columns; its rows are the open versions.
CURRENT_SQL = ("SELECT id, country, region, city, postal_code, address_line1, address_line2, latitude, longitude, created_at, valid_from "
               "FROM {table} WHERE state = 'open'")


def snapshot_addresses(wh: Warehouse, path: str, extracts: list[int] | None = None) -> list[bool]:
    """Continue the stored address history with the numbered extracts of the
    source (all, unless named); whether each was applied."""
    numbers = extracts or range(1, len(SNAPSHOT_AS_OF) + 1)
    return [apply_extract(wh.spark, path, wh.mp.addresses(n), "id", ADDRESS_CHECK_COLS, SNAPSHOT_AS_OF[n - 1]) for n in numbers]


def build(spark: SparkSession, sf_dir: str, target: str, *, custom_schemas: dict[str, str] | None = None,
          models: list[str] | None = None, extracts: list[int] | None = None, catalog: bool = False,
          exact: bool = False) -> dict[str, str]:
    """Register staging views and write the table models; return name -> path
    (of a view: its name)."""
    wh = StoredWarehouse(spark, sf_dir, exact=exact)
    out = (lambda df: df) if exact else decimals_to_double
    for entity in STAGING:
        wh.stg(entity).createOrReplaceTempView(f"stg_{entity}")
    custom = custom_schemas or {}
    schemas: dict[str, str] = {}
    written = {}
    for layer, name, builder in TABLE_MODELS:
        if models and name not in models:
            continue
        if catalog and layer not in schemas:
            schemas[layer] = create_layer(spark, target, layer, custom.get(layer))
        path = f"{layer_location(target, layer, custom.get(layer))}/{name}"
        if name == HISTORY:
            snapshot_addresses(wh, path, extracts)
            wh.history = history(spark, path)
            if catalog:
                attach(spark, schemas[layer], name, path)
        elif name == CURRENT and catalog:
            source = create_layer(spark, target, HISTORY_LAYER, custom.get(HISTORY_LAYER))
            create_view(spark, schemas[layer], name, CURRENT_SQL.format(table=f"`{source}`.`{HISTORY}`"))
            path = f"{schemas[layer]}.{name}"
        elif catalog:
            save_model(out(builder(wh)), schemas[layer], name, path, partition_by=PARTITION_BY.get(name))
        else:
            write_table(out(builder(wh)), path, partition_by=PARTITION_BY.get(name))
        written[name] = path
    return written
