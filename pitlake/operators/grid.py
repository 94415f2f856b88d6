"""J1 base grid and P6 date-range filter."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pitlake.operators.calendar import distinct_dates


def between_dates(df: DataFrame, lo, hi, date: str = "date") -> DataFrame:
    """Inclusive date range.  Literal bounds reach the Parquet scan as
    pushed filters when ``date`` is a stored column."""
    cond: Column = F.lit(True)
    if lo is not None:
        cond = cond & (F.col(date) >= _lit_date(lo))
    if hi is not None:
        cond = cond & (F.col(date) <= _lit_date(hi))
    return df.where(cond)


def _lit_date(v) -> Column:
    if isinstance(v, Column):
        return v
    if isinstance(v, (_dt.date, _dt.datetime)):
        return F.lit(v).cast("date")
    return F.to_date(F.lit(str(v)))


def base_grid(universe: DataFrame, calendar: DataFrame, lo=None, hi=None,
              key: str = "ticker", date: str = "date") -> DataFrame:
    """Every universe entity x every trading day in ``[lo, hi]``.

    The calendar side is a date-keyed table (one row per trading day, bounded
    by days), so it is broadcast and the universe -- which may hold millions
    of entities -- streams through a broadcast nested-loop join without any
    shuffle.  Output order is left to the sink (O1).
    """
    cal = between_dates(distinct_dates(calendar, date), lo, hi)
    return universe.select(key).crossJoin(F.broadcast(cal))
