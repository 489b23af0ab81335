"""The append-only feature history and its latest-version reads."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loadcast.operators.ranking import latest_per_key

EVENT_TIME_FORMAT = "%Y-%m-%dT%H:%M:%SZ"


def stamp_versions(features: DataFrame, moment: dt.datetime, date_col: str = "date") -> DataFrame:
    """Add the record key (the day) and one ingest time for the whole batch."""
    utc = moment.astimezone(dt.timezone.utc) if moment.tzinfo else moment
    return features.withColumns({
        "record_id": F.date_format(date_col, "yyyy-MM-dd"),
        "event_time": F.lit(utc.strftime(EVENT_TIME_FORMAT)),
    })


def append_versions(versions: DataFrame, path: str) -> None:
    versions.write.mode("append").parquet(path)


def latest_features(
    versions: DataFrame,
    start: dt.date | None = None,
    end: dt.date | None = None,
    key: Sequence[str] = ("record_id",),
    version: Sequence[str] = ("event_time",),
    date_col: str = "date",
    key_is_date: bool = False,
) -> DataFrame:
    """The newest version per key, then the days from `start` to `end`, both included.

    The range applies to the chosen version, so it cannot in general move ahead of the choice. When the
    key determines the day (`key_is_date`) both orders agree and the range reaches the scan. Equal
    versions are decided by the remaining columns, so the result is the same on every run.
    """
    def in_range(df: DataFrame) -> DataFrame:
        if start is not None:
            df = df.filter(F.col(date_col) >= F.lit(start))
        if end is not None:
            df = df.filter(F.col(date_col) <= F.lit(end))
        return df

    pool = in_range(versions) if key_is_date else versions
    chosen = latest_per_key(pool, list(key), list(version))
    return chosen if key_is_date else in_range(chosen)
