"""Exact money arithmetic.

Amounts are ``decimal(12,2)`` at the source boundary so every sum is exact
and independent of the order in which partitions are combined.  Results
leave the library as ``double`` (``money_out``) only after the exact sum.
Ratios are computed on doubles with an explicit zero guard, which is safe
under ANSI mode (no division-by-zero error, null instead).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

MONEY = DecimalType(12, 2)
#: Stored sums of amounts.
STORED_MONEY = DecimalType(24, 2)


def money(c: Column | str) -> Column:
    """Cast a numeric amount to decimal(12,2)."""
    return F.col(c).cast(MONEY) if isinstance(c, str) else c.cast(MONEY)


def cents(c: Column | str) -> Column:
    """Whole cents of an amount that is exact to the cent, as bigint."""
    c = F.col(c) if isinstance(c, str) else c
    return F.round(c * F.lit(100)).cast("bigint")


def money_from_cents(c: Column) -> Column:
    """decimal(12,2) from an integer number of cents (exact)."""
    return (c.cast(DecimalType(14, 0)) / F.lit(100)).cast(MONEY)


def money_out(c: Column | str) -> Column:
    """Exact decimal result -> double at the output boundary."""
    c = F.col(c) if isinstance(c, str) else c
    return c.cast("double")


def stored_money(c: Column | str) -> Column:
    """An amount as it is stored: ``STORED_MONEY``.  A sum that does not fit
    fails the query instead of becoming null, whatever the session's mode."""
    c = F.col(c) if isinstance(c, str) else c
    kept = c.try_cast(STORED_MONEY)
    return F.when(c.isNull() | kept.isNotNull(), kept).otherwise(
        F.raise_error(F.concat(F.lit("amount too large to store: "), c.cast("string"))))


def decimals_to_double(df: DataFrame) -> DataFrame:
    """All decimal columns as double, for a result that leaves the library."""
    dec = [f.name for f in df.schema.fields if isinstance(f.dataType, DecimalType)]
    return df.withColumns({c: F.col(c).cast("double") for c in dec}) if dec else df


def safe_div(num: Column, den: Column) -> Column:
    """num / den as double, null when den is null or zero."""
    den_d = den.cast("double")
    return F.when(den_d.isNull() | (den_d == 0), F.lit(None).cast("double")) \
        .otherwise(num.cast("double") / den_d)


def pct_change(cur: Column, prev: Column) -> Column:
    """(cur - prev) / prev; null when prev is null or zero."""
    return safe_div(cur - prev, prev)
