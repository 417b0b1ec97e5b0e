"""Sinks: table materialisation and lineage cuts.

* ``materialize`` cuts lineage with a Parquet table written in the folder
  the session names in ``spark.checkpoint.dir`` (shared storage on a
  cluster), so a lost executor never forces a recompute of the upstream
  joins.
* ``write_table`` is the full-refresh table materialisation: Parquet,
  overwrite, optionally partitioned / bucketed for co-located joins.
* ``swap_write`` writes a frame that was computed from the same path
  (e.g. a snapshot history) to a fresh location first, because Spark cannot
  overwrite a table it is reading.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from marketlens.session import ensure_checkpoint_dir


def materialize(df: DataFrame) -> DataFrame:
    """Compute ``df`` once and continue from a Parquet table written under
    the session's shared checkpoint folder.

    Columnar and compressed, so it is cheaper to write and read back than an
    RDD checkpoint, and later scans still prune columns and push filters.
    The returned frame's lineage starts at that table: a lost executor
    re-reads it instead of recomputing the upstream plan.
    """
    spark = df.sparkSession
    path = new_table_path(spark)
    if not path:
        return df.checkpoint(eager=True)
    df.write.mode("error").parquet(path)
    return spark.read.parquet(path)


def new_table_path(spark: SparkSession) -> str | None:
    """A new folder name for a stored table in the shared checkpoint folder;
    None where the session has none."""
    root = ensure_checkpoint_dir(spark) or spark.conf.get("spark.checkpoint.dir", None)
    return f"{root.rstrip('/')}/marketlens-tables/{uuid.uuid4().hex}" if root else None


def remove_tables(spark: SparkSession) -> bool:
    """Delete the stored tables of this application, once nothing reads them
    any more.  Only the application's own checkpoint folder is touched."""
    own = spark.sparkContext.getCheckpointDir()
    return bool(own) and remove_folder(spark, f"{own.rstrip('/')}/marketlens-tables")


def write_table(df: DataFrame, path: str, *, partition_by: list[str] | None = None,
                mode: str = "overwrite") -> None:
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def append_rows(df: DataFrame, path: str, *, partition_by: list[str] | None = None) -> None:
    """Insert-select: append new rows to an existing table (same partition layout)."""
    write_table(df, path, partition_by=partition_by, mode="append")


def append_checked(df: DataFrame, path: str, *, partition_by: list[str] | None = None) -> None:
    """Append to a table whose columns and types (a decimal's digits too) are
    those of ``df``; anything else is an error, and nothing is written."""
    stored = df.sparkSession.read.parquet(path).schema
    have, new = ({f.name: f.dataType.simpleString() for f in schema.fields} for schema in (stored, df.schema))
    wrong = sorted(c for c in {*have, *new} if have.get(c) != new.get(c))
    if wrong:
        raise ValueError("append: " + ", ".join(f"{c} is {have.get(c, 'not there')} in the table and {new.get(c, 'not there')} in the rows" for c in wrong))
    append_rows(df.select(*stored.names), path, partition_by=partition_by)


def write_sorted(df: DataFrame, path: str, order: list[Column], files: int | None = None) -> None:
    """Write a table in order: each file holds a range of ``order``, sorted,
    and files by number follow each other (``files`` of them at most; unless
    given, as many as the session's shuffles make).  One range shuffle; no task sees more
    than its range, and equal rows of ``order`` are spread by Spark's sample
    only as far as ``order`` tells them apart, so end it with a key."""
    dealt = df.repartitionByRange(files, *order) if files else df.repartitionByRange(*order)
    dealt.sortWithinPartitions(*order).write.mode("overwrite").parquet(path)


def read_in_order(spark: SparkSession, path: str, position: str = "position") -> DataFrame:
    """A table written by ``write_sorted`` with each row's place in it (from
    1), counted from files and rows in files; no key is compared again."""
    table = spark.read.parquet(path)
    place = table.metadataColumn("_metadata")
    rows = table.select("*", F.regexp_extract(place["file_name"], r"part-(\d+)", 1).cast("long").alias("_file"), place["row_index"].alias("_index"))
    # one row a file
    before = Window.orderBy("_file").rowsBetween(Window.unboundedPreceding, -1)
    files = rows.groupBy("_file").agg(F.count(F.lit(1)).alias("_n")).select("_file", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    return rows.join(files, "_file").withColumn(position, F.col("_before") + F.col("_index") + 1).drop("_file", "_index", "_before")


def write_partitions(df: DataFrame, path: str, partition_by: list[str], mode: str = "overwrite") -> None:
    """Append to, or replace, just the partitions that ``df`` has rows of;
    all others keep their files.  The table may be read by ``df`` itself,
    since partitions are moved into place after the job.  Rows are dealt by
    partition, and large partitions are split among tasks (rebalance)."""
    (df.hint("rebalance", *[F.col(c) for c in partition_by]).write.mode(mode)
     .option("partitionOverwriteMode", "dynamic").partitionBy(*partition_by).parquet(path))


def swap_write(df: DataFrame, base_path: str) -> str:
    """Write to a new versioned folder under ``base_path``; return its path."""
    target = f"{base_path.rstrip('/')}/v-{uuid.uuid4().hex}"
    df.write.mode("error").parquet(target)
    return target


def remove_folder(spark: SparkSession, path: str) -> bool:
    """Delete a folder of a stored table through Spark's file systems."""
    jvm = spark._jvm
    folder = jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def layer_location(base: str, layer: str, custom: str | None = None) -> str:
    """Where a model of ``layer`` is written: a custom schema name is used
    verbatim, otherwise the layer's default folder."""
    return f"{base.rstrip('/')}/{custom or layer}"
