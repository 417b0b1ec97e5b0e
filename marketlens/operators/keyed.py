"""Keyed inserts and updates on immutable tables.

These functions make the new rows or the new version of a table;
``sources.keyed_tables`` applies them to a stored, partitioned table and
rewrites only the partitions that change.

* ``insert_skip_conflict`` - insert, silently skipping keys that already
  exist and keeping the first of duplicate keys inside the batch, chosen by
  an explicit order.
* ``update_from`` - ``UPDATE t SET c = s.c FROM s WHERE t.k = s.k``; the
  source must be unique on the key.
* ``top_k_per_group``, ``first_per_key`` - the first rows of a key; Spark keeps
  k rows of a key per task before the shuffle, so a hot key is k rows a task.
* ``nth_latest_per_group`` - largest and second-largest value per group
  (``ORDER BY ... OFFSET 1 LIMIT 1`` per group) through ``top_k_per_group``.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def first_per_key(df: DataFrame, key: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key: the row with the smallest ``order`` tuple, then the
    smallest of all its columns."""
    columns = df.columns
    inside = Window.partitionBy(*key).orderBy(*order, *[c for c in columns if c not in (*key, *order)])
    return df.withColumn("_n", F.row_number().over(inside)).where(F.col("_n") == 1).select(*columns)


def insert_skip_conflict(target: DataFrame, incoming: DataFrame, key: Sequence[str],
                         order: Sequence[str]) -> DataFrame:
    """Rows of ``incoming`` whose key is new (first per key by ``order``).

    Known keys go before the rest is reduced; rows with a null in the key
    conflict with nothing, as in SQL, and all stay.
    """
    key = list(key)
    fresh = incoming.select(*target.columns).join(target.select(*key), key, "left_anti").select(*target.columns)
    whole = F.lit(True)
    for k in key:
        whole = whole & F.col(k).isNotNull()
    return first_per_key(fresh.filter(whole), key, order).unionByName(fresh.filter(~whole))


def once_per_key(source: DataFrame, key: Sequence[str]) -> DataFrame:
    """``source``, which fails when read if a key repeats.  The rows of a key
    are counted in the partition that a join on the key needs anyway."""
    several = F.raise_error(F.concat(F.lit("update_from: several source rows for key "), F.to_json(F.struct(*key))))
    n = F.count(F.lit(1)).over(Window.partitionBy(*key))
    return source.withColumn("_n", n).where(F.when(F.col("_n") == 1, F.lit(True)).otherwise(several.cast("boolean"))).drop("_n")


def _on(key: Sequence[str]) -> Column:
    cond = F.lit(True)
    for k in key:
        cond = cond & (F.col(f"t.{k}") == F.col(f"s.{k}"))
    return cond


def update_from(target: DataFrame, source: DataFrame, key: Sequence[str], assignments: dict[str, Column], *,
                unique: bool = False) -> DataFrame:
    """New version of ``target``; ``assignments`` may reference ``s.<col>`` and ``t.<col>``.

    A key must be unique in ``source``: a second source row for it would be a
    second target row, so the query fails with an error instead.  ``unique``
    says that it is by its making (a group by the key), which saves the count.
    """
    key = list(key)
    s = (source if unique else once_per_key(source, key)).alias("s")
    j = target.alias("t").join(s, _on(key), "left")
    matched = F.col(f"s.{key[0]}").isNotNull()
    out = []
    for c in target.columns:
        if c in assignments:
            out.append(F.when(matched, assignments[c]).otherwise(F.col(f"t.{c}")).alias(c))
        else:
            out.append(F.col(f"t.{c}").alias(c))
    return j.select(*out)


def changed_by(target: DataFrame, source: DataFrame, key: Sequence[str], assignments: dict[str, Column]) -> DataFrame:
    """The rows of ``target`` that ``update_from`` gives another value."""
    differs = F.lit(False)
    for c, value in assignments.items():
        differs = differs | ~value.eqNullSafe(F.col(f"t.{c}"))
    return target.alias("t").join(source.alias("s"), _on(key)).where(differs).select("t.*")


def top_k_per_group(df: DataFrame, group: Sequence[str], order: Sequence[Column], k: int, *,
                    rank_col: str = "rank", tiebreak: str) -> DataFrame:
    """Top ``k`` rows per group by ``order`` (then ``tiebreak`` ascending).

    The filter on the row number lets Spark keep k rows of a group in each
    task before the one shuffle (WindowGroupLimit), so a group holding a
    third of all rows sends k rows per task.
    """
    inside = Window.partitionBy(*group).orderBy(*order, F.col(tiebreak).asc())
    return df.withColumn(rank_col, F.row_number().over(inside).cast("long")).filter(F.col(rank_col) <= k)


def nth_latest_per_group(df: DataFrame, group: str, value: str) -> DataFrame:
    """group, latest value, second latest value (null if the group has one).

    ``value`` must be unique (a key), as ``ORDER BY key DESC OFFSET 1`` is.
    """
    top2 = top_k_per_group(df.select(group, value), [group], [F.col(value).desc()], 2,
                           rank_col="_r", tiebreak=value)
    return top2.groupBy(group).agg(F.max(F.when(F.col("_r") == 1, F.col(value))).alias("latest"),
                                   F.max(F.when(F.col("_r") == 2, F.col(value))).alias("second_latest"))
