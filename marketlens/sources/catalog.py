"""Models as tables and views of the session's catalog.

A layer is a schema: a custom name is used as it is, otherwise the layer's
own.  Its tables lie in the folder of the layer (``sinks.layer_location``),
so a model has one place whether it is read by path or by name, and any
session of the catalog reads it by name.  Which catalog that is (of the
application, or a metastore shared by many) is the session's setting.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from marketlens.sources.sinks import layer_location


def _quoted(*names: str) -> str:
    return ".".join("`" + n.replace("`", "``") + "`" for n in names)


def schema_name(layer: str, custom: str | None = None) -> str:
    return custom.strip() if custom and custom.strip() else layer


def create_layer(spark: SparkSession, base: str, layer: str, custom: str | None = None) -> str:
    """The schema of a layer, made if it is not there; its name."""
    name = schema_name(layer, custom)
    place = layer_location(base, layer, custom).replace("'", "\\'")
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {_quoted(name)} LOCATION '{place}'")
    return name


def save_model(df: DataFrame, schema: str, name: str, path: str, *, partition_by: list[str] | None = None) -> None:
    """Write a model as the table ``schema.name`` at ``path``, in place of
    the one there."""
    w = df.write.mode("overwrite").format("parquet").option("path", path)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.saveAsTable(_quoted(schema, name))


def attach(spark: SparkSession, schema: str, name: str, path: str) -> None:
    """Let ``schema.name`` be the Parquet table that lies at ``path``, with
    its folders as partitions as they are now."""
    table = _quoted(schema, name)
    spark.read.parquet(path)  # fails here, not in the catalog, if nothing is there
    if spark.catalog.tableExists(table):
        told = {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE TABLE EXTENDED {table}").collect()}
        if told.get("Location", "").split(":")[-1].rstrip("/") != path.split(":")[-1].rstrip("/"):
            spark.sql(f"DROP TABLE {table}")
    if not spark.catalog.tableExists(table):
        spark.catalog.createTable(f"{schema}.{name}", path=path, source="parquet")
    if any(c.isPartition for c in spark.catalog.listColumns(f"{schema}.{name}")):
        spark.sql(f"MSCK REPAIR TABLE {table} SYNC PARTITIONS")
    spark.catalog.refreshTable(table)


def create_view(spark: SparkSession, schema: str, name: str, query: str) -> None:
    """A lasting view; it reads its tables as they are when it is read."""
    spark.sql(f"CREATE OR REPLACE VIEW {_quoted(schema, name)} AS {query}")
