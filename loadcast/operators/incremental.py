"""Selection of days not yet processed, and the per-job watermark."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loadcast.functions.dates import date_in_key

# Fixed value: the watermark of a job that has never run; that day itself is never selected.
FIRST_WATERMARK = dt.date(2022, 1, 1)


def dates_in_keys(keys: DataFrame, col: str = "key") -> DataFrame:
    """Distinct dates named in object keys, as text."""
    return keys.select(date_in_key(F.col(col)).alias("dt")).filter(F.col("dt").isNotNull()).distinct()


def unprocessed_dates(
    power: DataFrame, weather: DataFrame, watermark: dt.date, col: str = "date", done: DataFrame | None = None
) -> DataFrame:
    """Days present on both sides and after the watermark, ascending.

    A day that lands after the watermark has passed it is never selected. Passing `done`, the days
    already processed, selects by absence from that table instead.
    """
    def days(side: DataFrame) -> DataFrame:
        return side.select(F.col(col).cast("date").alias("date"))

    def fresh(side: DataFrame) -> DataFrame:
        return days(side).filter(F.col("date") > F.lit(watermark)) if done is None else days(side)

    # Each side shrinks to its days before they meet: rows never travel, however many a day has.
    both = fresh(power).distinct().join(fresh(weather).distinct(), "date", "left_semi")
    if done is not None:
        both = both.join(days(done).distinct(), "date", "left_anti")
    return both.orderBy("date")


def read_watermark(control: DataFrame, job: str, default: dt.date = FIRST_WATERMARK) -> dt.date:
    """The stored day of one job; the control table holds one row per job."""
    stored = control.filter(F.col("job_name") == job).agg(F.max("last_processed")).first()[0]
    return default if stored is None else stored


def advance_watermark(
    control: DataFrame, updates: DataFrame, updated_at: dt.datetime, strict: bool = False
) -> DataFrame:
    """The control table after `updates(job_name, last_processed)`: a watermark only moves forward.

    With `strict` an update that does not move its job forward is an error.
    """
    batch = updates.groupBy("job_name").agg(F.max("last_processed").alias("_new"))
    old, new = F.col("last_processed"), F.col("_new")
    moves = new.isNotNull() & (old.isNull() | (old < new))
    day = F.when(moves, new).otherwise(old)
    if strict:
        message = F.concat(F.lit("watermark not advanced: "), F.col("job_name"))
        day = F.when(new.isNotNull() & ~moves, F.raise_error(message).cast("date")).otherwise(day)
    stamp = F.when(moves, F.lit(updated_at)).otherwise(F.col("updated_at"))
    return control.join(batch, "job_name", "full_outer").select(
        "job_name", day.alias("last_processed"), stamp.alias("updated_at")
    )


def batch_watermark(days: DataFrame, col: str = "date") -> DataFrame:
    """The new watermark of a batch: its last day."""
    return days.agg(F.max(col).alias("last_processed"))


def encode_dates(days: Iterable[dt.date]) -> str:
    return ",".join(day.isoformat() for day in days)


def decode_dates(text: str) -> list[dt.date]:
    """The days of `a, b, c`; an empty text is an empty batch."""
    return [dt.date.fromisoformat(part.strip()) for part in text.split(",") if part.strip()]


def needs_run(days: DataFrame) -> bool:
    return not days.isEmpty()
