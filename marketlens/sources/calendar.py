"""Dense date generator (one row per calendar day).

The range is an input, never the wall clock.  ``order_date_range`` derives
it from the data (first January of the first order year to 31 December of
the last order year) as a one-row DataFrame, so the calendar stays lazy and
grows only with the span of dates, not with the data volume.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def order_date_range(orders: DataFrame, ts_col: str = "created_at") -> DataFrame:
    """One row (start_date, end_date) covering whole years of order dates."""
    d = F.to_date(F.col(ts_col))
    return orders.agg(F.min(d).alias("lo"), F.max(d).alias("hi")).select(
        F.trunc("lo", "year").alias("start_date"),
        F.date_sub(F.add_months(F.trunc("hi", "year"), 12), 1).alias("end_date"),
    )


def all_dates(date_range: DataFrame) -> DataFrame:
    """``date_column`` for every day in [start_date, end_date] of a one-row frame."""
    return date_range.select(
        F.explode(F.sequence("start_date", "end_date", F.expr("interval 1 day"))).alias("date_column")
    )


def all_dates_between(spark: SparkSession, start: dt.date, end: dt.date) -> DataFrame:
    """Calendar for a fixed, parameterised range (e.g. 2015-01-01 .. 2030-12-31)."""
    n = (end - start).days
    return spark.range(0, n + 1).select(
        F.date_add(F.lit(start), F.col("id").cast("int")).alias("date_column"))
