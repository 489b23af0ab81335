"""Feature engineering over merged days."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loadcast.config import Config
from loadcast.functions.calendar import calendar_columns
from loadcast.functions.holidays import checked_flag, holiday_table
from loadcast.functions.weather import missing_if_nan, temperature_features, weather_category

DEFAULTS = Config()


def categorize_weather(df: DataFrame, col: str = "weather", null_as_text: bool = False) -> DataFrame:
    return df.withColumn("weather_category", weather_category(F.col(col), null_as_text)).drop(col)


def numeric_features(df: DataFrame, cfg: Config = DEFAULTS) -> DataFrame:
    high, low = F.col("max_temp"), F.col("min_temp")
    return df.withColumns({
        "max_temp": missing_if_nan(high),
        "min_temp": missing_if_nan(low),
        **temperature_features(high, low, cfg.thresholds),
    })


def calendar_features(df: DataFrame, holidays: DataFrame | None = None, date_col: str = "date") -> DataFrame:
    """Calendar columns plus the holiday flag; the dimension is a few thousand rows by construction."""
    dimension = holiday_table(df.sparkSession) if holidays is None else holidays
    date = F.col(date_col)
    return (
        df.withColumns(calendar_columns(date))
        .join(dimension, date == F.col("holiday_date"), "left")
        .withColumn("holiday", checked_flag(date, F.col("holiday_date")))
        .drop("holiday_date")
    )


def make_features(
    df: DataFrame,
    cfg: Config = DEFAULTS,
    holidays: DataFrame | None = None,
    date_col: str = "date",
    null_as_text: bool = False,
) -> DataFrame:
    """Weather category, then temperature, then calendar features."""
    return (
        df.transform(categorize_weather, null_as_text=null_as_text)
        .transform(numeric_features, cfg)
        .transform(calendar_features, holidays, date_col)
    )
