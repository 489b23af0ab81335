"""Daily peaks and the weather-power join."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loadcast.functions.weather import missing_if_nan


def daily_peak(
    readings: DataFrame,
    keys: Sequence[str] = (),
    ts: str = "ts",
    value: str = "value",
    truncate: bool = True,
    strict: bool = False,
) -> DataFrame:
    """Highest reading per day; a day with no usable reading is dropped, or an error when `strict`."""
    peaks = (
        readings.groupBy(*keys, F.to_date(ts).alias("date"))
        .agg(F.max(missing_if_nan(F.col(value))).alias("peak"))
    )
    peak = F.col("peak")
    if strict:
        message = F.concat(F.lit("no reading on "), F.coalesce(F.col("date").cast("string"), F.lit("an unknown day")))
        peak = F.when(peak.isNotNull(), peak).otherwise(F.raise_error(message).cast("double"))
    else:
        peaks = peaks.filter(peak.isNotNull())
    # Spark's cast to an integer drops the fraction, which is the wanted rule.
    return peaks.select(*keys, "date", (peak.cast("long") if truncate else peak).alias("max_power"))


def merge_daily(weather: DataFrame, power: DataFrame, keys: Sequence[str] = ("date",)) -> DataFrame:
    """Inner join on the day (and area). No manual repartitioning: the planner sees both sizes."""
    return weather.join(power, list(keys), "inner")
