"""Calendar attributes of a DATE column."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def date_key(d: Column) -> Column:
    """yyyyMMdd as INT (NULL for a NULL date), computed arithmetically."""
    return (F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)).cast("int")


def calendar_columns(d: Column, quarter: bool = False) -> dict[str, Column]:
    """date_key, year, month, day, [quarter], day_of_week (1 = Sunday),
    day_name, month_name, is_weekend (Sunday or Saturday)."""
    cols = {
        "date_key": date_key(d),
        "year": F.year(d),
        "month": F.month(d),
        "day": F.dayofmonth(d),
    }
    if quarter:
        cols["quarter"] = F.quarter(d)
    dow = F.dayofweek(d)
    cols.update({
        "day_of_week": dow,
        "day_name": F.date_format(d, "EEEE"),
        "month_name": F.date_format(d, "MMMM"),
        "is_weekend": F.coalesce(dow.isin(1, 7), F.lit(False)),
    })
    return cols
