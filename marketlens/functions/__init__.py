"""Column-level helpers built only from ``pyspark.sql.functions``."""

from marketlens.functions.money import (  # noqa: F401
    MONEY, money, money_from_cents, cents, money_out, pct_change, safe_div,
)
from marketlens.functions.dates import (  # noqa: F401
    week_start, period_anchor, holiday_name, calendar_attributes, ts_ntz,
)
