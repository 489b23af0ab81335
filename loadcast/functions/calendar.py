"""Calendar features of a date column."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

DAYS_IN_WEEK = 7
MONTHS_IN_YEAR = 12


def _turn(position: Column, length: int) -> Column:
    return F.lit(2 * math.pi) * position / F.lit(length)


def calendar_columns(date: Column) -> dict[str, Column]:
    """Year to weekend flag; weekdays run from 0 on Monday, months keep 1-12 in the cycle."""
    dow, month = F.weekday(date), F.month(date)
    return {
        "year": F.year(date),
        "month": month,
        "day": F.dayofmonth(date),
        "dow": dow,
        "dow_sin": F.sin(_turn(dow, DAYS_IN_WEEK)),
        "dow_cos": F.cos(_turn(dow, DAYS_IN_WEEK)),
        "mon_sin": F.sin(_turn(month, MONTHS_IN_YEAR)),
        "mon_cos": F.cos(_turn(month, MONTHS_IN_YEAR)),
        "weekend": F.coalesce((dow >= 5).cast("int"), F.lit(0)),
    }
