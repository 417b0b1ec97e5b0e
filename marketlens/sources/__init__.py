"""Scans, entity adapters, calendar generator and sinks."""

from marketlens.sources.tables import read_table, TABLE_SCHEMAS  # noqa: F401
from marketlens.sources.marketplace import Marketplace  # noqa: F401
from marketlens.sources.calendar import all_dates, all_dates_between, order_date_range  # noqa: F401
