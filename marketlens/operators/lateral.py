"""Correlated lateral top-k: the first rows of a relation for each outer row.

``lateral_top_k`` is SQL's ``LEFT JOIN LATERAL (SELECT ... WHERE inner.k =
outer.k ORDER BY ... LIMIT k) ON true``, with ``DataFrame.lateralJoin``.  Spark
turns the limit into a row number per key before the join, and keeps k rows of
a key in each task before the shuffle (WindowGroupLimit), so a key with a
third of all rows sends k rows a task.  Outer rows without a match stay, with
nulls or with the values of ``fallback``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def lateral_top_k(outer: DataFrame, inner: DataFrame, key: Sequence[tuple[str, str]], order: Sequence[Column], k: int, *,
                  left: bool = True, fallback: dict[str, Column] | None = None) -> DataFrame:
    """``outer`` with the first ``k`` rows of ``inner``, by ``order``, whose
    key columns equal its own; ``key`` names pairs (outer, inner).

    ``order`` should end with a unique column.  ``fallback`` gives values (of
    outer columns or literals) for inner columns where there is no match.
    """
    match = F.lit(True)
    for o, i in key:
        match = match & (F.col(f"i.{i}") == F.col(f"o.{o}").outer())
    first = inner.alias("i").where(match).orderBy(*order).limit(k).withColumn("_found", F.lit(True))
    joined = outer.alias("o").lateralJoin(first, how="left" if left else "inner")
    values = [F.col(c) for c in outer.columns]
    for c in inner.columns:
        if fallback and c in fallback:
            values.append(F.when(F.col("_found"), F.col(c)).otherwise(fallback[c]).alias(c))
        else:
            values.append(F.col(c))
    return joined.select(*values)
