"""Inline relations: the rows of a ``VALUES`` list as a DataFrame.

They are part of the plan, so the planner knows their size and broadcasts
them only if they are small.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketlens.functions.dates import FIXED_HOLIDAYS


def values(spark: SparkSession, rows: Sequence[tuple], schema: str) -> DataFrame:
    """``(VALUES ...) AS t(...)``; the schema gives names and types."""
    if not rows:
        return spark.createDataFrame([], schema)
    names = spark.createDataFrame([], schema).schema.fields
    args = {f"v{r}_{c}": v for r, row in enumerate(rows) for c, v in enumerate(row)}
    body = ", ".join("(" + ", ".join(f":v{r}_{c}" for c in range(len(names))) + ")" for r in range(len(rows)))
    listed = spark.sql(f"SELECT * FROM VALUES {body} AS t({', '.join(f'`{f.name}`' for f in names)})", args=args)
    return listed.select(*[F.col(f"`{f.name}`").cast(f.dataType) for f in names])


def with_holidays(dates: DataFrame, date_col: str, holidays: Sequence[tuple[int, int, str]] = FIXED_HOLIDAYS, *,
                  flag: str = "is_greek_public_holiday", name: str = "greek_public_holiday_name") -> DataFrame:
    """Dates with the holiday of their month and day: any number of holidays,
    one join.  Several on one day share a row, their names joined by `` / ``."""
    by_day: dict[tuple[int, int], list[str]] = {}
    for month, day, label in holidays:
        by_day.setdefault((month, day), []).append(label)
    listed = values(dates.sparkSession, [(m, d, " / ".join(n)) for (m, d), n in by_day.items()], f"_m int, _d int, {name} string")
    d = F.col(date_col)
    joined = dates.join(listed, F.month(d).eqNullSafe(F.col("_m")) & F.dayofmonth(d).eqNullSafe(F.col("_d")), "left")
    return joined.withColumn(flag, F.col(name).isNotNull()).select(*dates.columns, flag, name)
