"""Weather-text categories and temperature features as native column expressions."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

from loadcast.config import Thresholds

# The keywords and category names of the feature table.
SNOW = ("雪", "ゆき")
THUNDER = ("雷",)
RAIN = ("雨", "あめ")
SUN = ("晴", "日射")
CLOUD = ("曇", "くもり")
CLEAR = ("快晴",)
CATEGORY_MISSING = "不明"
CATEGORY_OTHER = "その他"
CATEGORIES = (
    "不明", "雪", "雷雨", "晴れ(雷あり)", "曇り(雷あり)", "雷", "快晴", "晴れ時々曇り", "晴れ時々雨",
    "晴れ", "曇り時々雨", "曇り", "雨", "その他",
)


def mentions(text: Column, words: tuple[str, ...]) -> Column:
    return reduce(or_, (text.contains(w) for w in words))


def weather_category(text: Column, null_as_text: bool = False) -> Column:
    """First matching rule wins.

    `null_as_text` is the scoring behaviour: a missing text has become the word "nan" or "None"
    by the time it is categorised, so it lands in the catch-all category.
    """
    snow, thunder, rain = mentions(text, SNOW), mentions(text, THUNDER), mentions(text, RAIN)
    sun, cloud, clear = mentions(text, SUN), mentions(text, CLOUD), mentions(text, CLEAR)
    under_thunder = (
        F.when(rain, "雷雨").when(sun, "晴れ(雷あり)").when(cloud, "曇り(雷あり)").otherwise("雷")
    )
    under_sun = F.when(cloud, "晴れ時々曇り").when(rain, "晴れ時々雨").otherwise("晴れ")
    return (
        F.when(text.isNull(), CATEGORY_OTHER if null_as_text else CATEGORY_MISSING)
        .when(snow, "雪")
        .when(thunder, under_thunder)
        .when(clear, "快晴")
        .when(sun, under_sun)
        .when(cloud, F.when(rain, "曇り時々雨").otherwise("曇り"))
        .when(rain, "雨")
        .otherwise(CATEGORY_OTHER)
    )


def missing_if_nan(value: Column) -> Column:
    """Spark orders NaN above every number, so NaN must become null before any comparison."""
    return F.nanvl(value.cast("double"), F.lit(None).cast("double"))


def temperature_features(max_temp: Column, min_temp: Column, limits: Thresholds) -> dict[str, Column]:
    """Mean, spread, degree days (missing stays missing) and 0/1 flags (missing counts as 0)."""
    high, low = missing_if_nan(max_temp), missing_if_nan(min_temp)
    mean = (high + low) / 2

    def above_zero(excess: Column) -> Column:
        # greatest() skips nulls, so an unguarded greatest(null, 0) would turn missing into 0.
        return F.when(excess.isNotNull(), F.greatest(excess, F.lit(0.0)))

    def flag(test: Column) -> Column:
        return F.coalesce(test.cast("int"), F.lit(0))

    return {
        "avg": mean,
        "rng": high - low,
        "cdd": above_zero(mean - F.lit(limits.cdd_base)),
        "hdd": above_zero(F.lit(limits.hdd_base) - mean),
        "hot": flag(high >= F.lit(limits.hot_day)),
        "cold": flag(low <= F.lit(limits.cold_day)),
    }
