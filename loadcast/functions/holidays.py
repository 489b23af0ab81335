"""Japanese public holidays, generated from the law's rules, as a small dimension table."""

from __future__ import annotations

import datetime as dt
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The law is of July 1948; there are no such holidays before it.
FIRST_YEAR, LAST_YEAR = 1948, 2150
ONE_DAY = dt.timedelta(days=1)

# Fixed values: (month, day, first year, last year) of the holidays bound to a calendar day.
FIXED_DAYS = (
    (1, 1, 1949, 2150),
    (1, 15, 1949, 1999),
    (2, 11, 1967, 2150),
    (2, 23, 2020, 2150),
    (4, 29, 1949, 2150),
    (5, 3, 1949, 2150),
    (5, 4, 2007, 2150),
    (5, 5, 1949, 2150),
    (7, 20, 1996, 2002),
    (8, 11, 2016, 2019),
    (8, 11, 2022, 2150),
    (9, 15, 1966, 2002),
    (10, 10, 1966, 1999),
    (11, 3, 1948, 2150),
    (11, 23, 1948, 2150),
    (12, 23, 1989, 2018),
)
# Fixed values: (month, which Monday, first year, last year).
MONDAYS = (
    (1, 2, 2000, 2150),
    (7, 3, 2003, 2019),
    (7, 3, 2022, 2150),
    (9, 3, 2003, 2150),
    (10, 2, 2000, 2019),
    (10, 2, 2022, 2150),
)
# Ceremonies of 1959, 1989, 1990, 1993 and 2019, and the games of 2020 and 2021.
ONE_OFF = (
    (1959, 4, 10), (1989, 2, 24), (1990, 11, 12), (1993, 6, 9),
    (2019, 5, 1), (2019, 10, 22),
    (2020, 7, 23), (2020, 7, 24), (2020, 8, 10),
    (2021, 7, 22), (2021, 7, 23), (2021, 8, 8),
)
# The published approximation of the equinoxes: last year, leap-year base, March and September offset.
EQUINOXES = ((1979, 1983, 20.8357, 23.2588), (2099, 1980, 20.8431, 23.2488), (2150, 1980, 21.8510, 24.2488))
# First days of the rules for holidays on Sundays and for days between two holidays.
MOVED_SINCE, BETWEEN_SINCE = dt.date(1973, 4, 12), dt.date(1985, 12, 27)
YEARLY_DRIFT = 0.242194


def _nth_monday(year: int, month: int, nth: int) -> dt.date:
    first = dt.date(year, month, 1)
    return first + dt.timedelta(days=(7 - first.weekday()) % 7 + 7 * (nth - 1))


def _statutory(year: int) -> set[dt.date]:
    days = {dt.date(year, m, d) for m, d, lo, hi in FIXED_DAYS if lo <= year <= hi}
    days |= {_nth_monday(year, m, n) for m, n, lo, hi in MONDAYS if lo <= year <= hi}
    days |= {dt.date(y, m, d) for y, m, d in ONE_OFF if y == year}
    _, leap_base, march, september = next(rule for rule in EQUINOXES if year <= rule[0])
    # The division drops the fraction, also of negative numbers.
    shift = YEARLY_DRIFT * (year - 1980) - int((year - leap_base) / 4)
    days.add(dt.date(year, 9, int(september + shift)))
    if year > FIRST_YEAR:
        days.add(dt.date(year, 3, int(march + shift)))
    return days


@lru_cache(maxsize=None)
def holidays_of(year: int) -> tuple[dt.date, ...]:
    if not FIRST_YEAR <= year <= LAST_YEAR:
        raise ValueError(f"holiday rules cover {FIRST_YEAR}-{LAST_YEAR}, not {year}")
    named = _statutory(year)
    between = {
        day + ONE_DAY
        for day in named
        if day >= BETWEEN_SINCE and day + 2 * ONE_DAY in named and day + ONE_DAY not in named
        and (day + ONE_DAY).weekday() != 6
    }
    moved = set()
    for day in named:
        if day.weekday() == 6 and day >= MOVED_SINCE:
            shifted = day + ONE_DAY
            # Since 2007 a displaced holiday walks on to the next free day; before, only a free Monday served.
            while year >= 2007 and shifted in named:
                shifted += ONE_DAY
            if shifted not in named:
                moved.add(shifted)
    return tuple(sorted(named | between | moved))


def holiday_table(spark: SparkSession, first: int = FIRST_YEAR, last: int = LAST_YEAR) -> DataFrame:
    """One row per holiday, at most 25 a year: a local relation whose size Spark knows, so joins broadcast it."""
    days = [d for y in range(first, last + 1) for d in holidays_of(y)]
    return spark.createDataFrame(pa.table({"holiday_date": pa.array(days, pa.date32())}))


def checked_flag(date: Column, matched: Column) -> Column:
    """1 or 0; a year after the rules is an error rather than a silent 0."""
    return (
        F.when(matched.isNotNull(), 1)
        .when(date.isNull() | (F.year(date) <= LAST_YEAR), 0)
        .otherwise(
            F.raise_error(F.concat(F.lit("no holiday rules for "), date.cast("string"))).cast("int")
        )
    )
