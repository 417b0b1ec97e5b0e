"""Calendar expressions.

Weeks start on Sunday (the warehouse dialect's ``date_trunc(d, week)``),
``dayofweek`` numbers Sunday as 1, ISO week numbers come from
``weekofyear``.  Holidays are fixed month/day pairs.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Public holidays on fixed dates (month, day, name).  These
# must equal the reference calendar for identical holiday flags and names.
FIXED_HOLIDAYS = [
    (1, 1, "New Years Day"),
    (1, 6, "Epiphany"),
    (3, 25, "Independence Day / Annunciation"),
    (5, 1, "Labour Day"),
    (8, 15, "Dormition of the Mother of God"),
    (10, 28, "Ochi Day"),
    (12, 25, "Christmas Day"),
    (12, 26, "Synaxis of the Mother of God"),
]

PERIODS = ("Day", "Week", "Month", "Quarter", "Year")


def _c(c):
    return F.col(c) if isinstance(c, str) else c


def ts_ntz(literal: str) -> Column:
    """A TIMESTAMP_NTZ literal (inputs carry wall-clock timestamps)."""
    return F.expr(f"timestamp_ntz'{literal}'")


def week_start(d) -> Column:
    """Sunday on or before ``d``."""
    d = _c(d)
    return F.date_sub(d, F.dayofweek(d) - 1)


def period_anchor(period: str, d) -> Column:
    d = _c(d)
    if period == "Day":
        return d
    if period == "Week":
        return week_start(d)
    if period == "Month":
        return F.trunc(d, "MM")
    if period == "Quarter":
        return F.trunc(d, "quarter")
    if period == "Year":
        return F.trunc(d, "year")
    raise ValueError(period)


def holiday_name(d) -> Column:
    d = _c(d)
    m, dd = F.month(d), F.dayofmonth(d)
    expr = None
    for month, day, name in FIXED_HOLIDAYS:
        cond = (m == month) & (dd == day)
        expr = F.when(cond, F.lit(name)) if expr is None else expr.when(cond, F.lit(name))
    return expr.otherwise(F.lit(None).cast("string"))


def date_attributes(d="reporting_date") -> list[Column]:
    """Attributes of an anchor date (not of the period it stands for)."""
    d = _c(d)
    dow = F.dayofweek(d)
    return [
        F.year(d).alias("calendar_year"),
        F.quarter(d).alias("calendar_quarter"),
        F.month(d).alias("calendar_month"),
        F.date_format(d, "MMMM").alias("calendar_month_name"),
        F.weekofyear(d).alias("iso_week"),
        dow.alias("day_of_week"),
        F.date_format(d, "EEEE").alias("day_name"),
        dow.isin(1, 7).alias("is_weekend"),
    ]


def calendar_attributes(d="reporting_date") -> list[Column]:
    """The same with the fixed holidays as expressions (``sources.inline``
    joins any list of holidays instead)."""
    name = holiday_name(d)
    return [
        *date_attributes(d),
        name.isNotNull().alias("is_greek_public_holiday"),
        name.alias("greek_public_holiday_name"),
    ]
