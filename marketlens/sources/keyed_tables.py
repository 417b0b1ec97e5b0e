"""Keyed updates and inserts on a stored table that is partitioned.

Only what changes is written: an update finds the partitions that hold a row
with another value than before and puts them in the place of the old ones
(dynamic partition overwrite); an insert appends.  All other partitions keep
their files.  A driver that is lost while partitions are moved into place may
leave some of them new and some old; the same update again brings the rest,
since a row that has its value already counts as unchanged.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marketlens.operators.keyed import changed_by, insert_skip_conflict, once_per_key, update_from
from marketlens.sources.sinks import materialize, write_partitions


def in_partitions(table: DataFrame, partition_by: Sequence[str], values: list[tuple]) -> DataFrame:
    """The rows of the named partitions; the scan lists no others."""
    wanted = F.lit(False)
    if len(partition_by) == 1:
        known = [v for v, in values if v is not None]
        wanted = F.col(partition_by[0]).isin(known) if known else wanted
        if len(known) < len(values):
            wanted = wanted | F.col(partition_by[0]).isNull()
    else:
        for value in values:
            one = F.lit(True)
            for c, v in zip(partition_by, value):
                one = one & (F.col(c).isNull() if v is None else F.col(c) == F.lit(v))
            wanted = wanted | one
    return table.where(wanted)


def partitions_of(rows: DataFrame, partition_by: Sequence[str]) -> list[tuple]:
    """The partitions that rows lie in: at most as many as the table has."""
    return [tuple(r) for r in rows.select(*partition_by).distinct().collect()]


def update_stored(spark: SparkSession, path: str, source: DataFrame, key: Sequence[str], assignments: dict[str, Column],
                  partition_by: Sequence[str], *, unique: bool = False) -> list[tuple]:
    """``UPDATE t SET ... FROM s WHERE t.k = s.k`` on the table at ``path``;
    the partitions that were rewritten.

    ``assignments`` as in ``update_from``; they may not set a partition
    column.  The source is stored first, as it is read twice."""
    moved = set(assignments) & set(partition_by)
    if moved:
        raise ValueError(f"update_stored: {sorted(moved)} decide the partition of a row and cannot be set")
    source = materialize(source if unique else once_per_key(source, key))
    table = spark.read.parquet(path)
    touched = partitions_of(changed_by(table, source, key, assignments), partition_by)
    if touched:
        new = update_from(in_partitions(table, partition_by, touched), source, key, assignments, unique=True)
        write_partitions(new, path, list(partition_by))
    return touched


def insert_stored(spark: SparkSession, path: str, incoming: DataFrame, key: Sequence[str], order: Sequence[str],
                  partition_by: Sequence[str]) -> None:
    """``INSERT ... ON CONFLICT DO NOTHING`` into the table at ``path``.

    Where the key holds the partition columns, only the partitions of the
    incoming rows are searched for conflicts; else the keys of all."""
    incoming = materialize(incoming)
    table = spark.read.parquet(path)
    if set(partition_by) <= set(key):
        table = in_partitions(table, partition_by, partitions_of(incoming, partition_by))
    write_partitions(insert_skip_conflict(table, incoming, key, order), path, list(partition_by), "append")
