"""Trailing time windows (F1, F2).

``as_of`` replaces ``current_date``/``current_timestamp`` so runs are
reproducible. Both predicates compare ``to_date(ts)`` with a literal date;
Catalyst unwraps that into a plain timestamp range that reaches the parquet
scan as a pushed filter.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from visitlens.functions.urls import _col


def days_start(as_of: dt.date, days: int) -> dt.date:
    return as_of - dt.timedelta(days=days)


def trailing_days(ts, as_of: dt.date, days: int) -> Column:
    """``date(ts) >= as_of - days``."""
    return F.to_date(_col(ts)) >= F.lit(days_start(as_of, days))


def months_start(as_of: dt.date, months: int = 4, lag_days: int = 2) -> Column:
    """Lower bound of F2: ``(as_of - lag_days) - months`` with month-end clamping."""
    return F.add_months(F.lit(as_of - dt.timedelta(days=lag_days)), -months)


def trailing_months(ts, as_of: dt.date, months: int = 4, lag_days: int = 2) -> Column:
    """lower bound only, as in the original."""
    return F.to_date(_col(ts)) >= months_start(as_of, months, lag_days)
