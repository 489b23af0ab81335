import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from loadcast.config import Config, Thresholds, config_from_mapping, load_config
from loadcast.functions.holidays import holidays_of
from loadcast.operators.features import calendar_features, categorize_weather, make_features, numeric_features
from loadcast.schemas import FEATURES, MERGED

CASES = [
    (None, "不明"),
    ("", "その他"),
    ("霧", "その他"),
    ("雪時々雷雨", "雪"),
    ("ゆき", "雪"),
    ("雷雨", "雷雨"),
    ("晴一時雷", "晴れ(雷あり)"),
    ("くもり雷", "曇り(雷あり)"),
    ("雷", "雷"),
    ("快晴後曇", "快晴"),
    ("晴後曇一時雨", "晴れ時々曇り"),
    ("晴一時雨", "晴れ時々雨"),
    ("日射", "晴れ"),
    ("くもり時々あめ", "曇り時々雨"),
    ("曇", "曇り"),
    ("あめ", "雨"),
]


def test_weather_rules(spark):
    df = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(CASES)], "i int, weather string")
    got = {r.i: r.weather_category for r in categorize_weather(df).collect()}
    assert [got[i] for i in range(len(CASES))] == [c for _, c in CASES]


def test_missing_weather_in_scoring_is_other(spark):
    df = spark.createDataFrame([(None,), ("nan",), ("None",)], "weather string")
    assert {r[0] for r in categorize_weather(df, null_as_text=True).collect()} == {"その他"}


def numeric(spark, high, low, cfg=Config()):
    df = spark.createDataFrame([(high, low)], "max_temp double, min_temp double")
    return numeric_features(df, cfg).first()


def test_thresholds_are_inclusive(spark):
    row = numeric(spark, 30.0, 5.0)
    assert (row.hot, row.cold) == (1, 1)
    row = numeric(spark, 29.9, 5.1)
    assert (row.hot, row.cold) == (0, 0)
    row = numeric(spark, 20.0, 16.0)
    assert (row.avg, row.cdd, row.hdd) == (18.0, 0.0, 0.0)


@pytest.mark.parametrize("missing", [None, math.nan])
def test_missing_temperature(spark, missing):
    row = numeric(spark, missing, 3.0)
    assert (row.avg, row.rng, row.cdd, row.hdd, row.max_temp) == (None,) * 5
    assert (row.hot, row.cold) == (0, 1)


def test_custom_thresholds(spark):
    cfg = Config(thresholds=Thresholds(hot_day=20, cold_day=0, cdd_base=10, hdd_base=25))
    row = numeric(spark, 20.0, 10.0, cfg)
    assert (row.hot, row.cold, row.cdd, row.hdd) == (1, 0, 5.0, 10.0)


def calendar(spark, *days):
    df = spark.createDataFrame([(d,) for d in days], "date date")
    return {r.date: r for r in calendar_features(df).collect()}


def test_calendar_edges(spark):
    rows = calendar(spark, dt.date(2024, 1, 1), dt.date(2024, 1, 7), dt.date(2024, 2, 12), None)
    monday, sunday = rows[dt.date(2024, 1, 1)], rows[dt.date(2024, 1, 7)]
    assert (monday.dow, monday.weekend, monday.holiday) == (0, 0, 1)
    assert (sunday.dow, sunday.weekend, sunday.holiday) == (6, 1, 0)
    assert rows[dt.date(2024, 2, 12)].holiday == 1
    assert (rows[None].year, rows[None].weekend, rows[None].holiday) == (None, 0, 0)
    assert monday.dow_sin**2 + monday.dow_cos**2 == pytest.approx(1)
    assert monday.mon_sin == pytest.approx(math.sin(2 * math.pi / 12))


def test_years_without_rules(spark):
    with pytest.raises(Exception, match="no holiday rules"):
        calendar(spark, dt.date(2151, 5, 3))
    with pytest.raises(ValueError):
        holidays_of(2151)
    rows = calendar(spark, dt.date(1947, 5, 3), dt.date(1948, 11, 3), dt.date(1990, 5, 4))
    assert {d: r.holiday for d, r in rows.items()} == {
        dt.date(1947, 5, 3): 0, dt.date(1948, 11, 3): 1, dt.date(1990, 5, 4): 1,
    }


def test_holidays_of_earlier_years_by_hand():
    def days(year):
        return [(d.month, d.day) for d in holidays_of(year)]

    assert days(1948) == [(9, 23), (11, 3), (11, 23)]
    # The holiday on Sunday, 11 February 1973 was not moved, that of 29 April was.
    assert days(1973) == [
        (1, 1), (1, 15), (2, 11), (3, 21), (4, 29), (4, 30), (5, 3), (5, 5), (9, 15), (9, 23), (9, 24), (10, 10), (11, 3),
        (11, 23),
    ]
    assert (5, 4) not in days(1985) and (5, 4) in days(1988)
    assert len(days(1989)) == 17 and (2, 24) in days(1989) and (12, 23) in days(1989) and (12, 23) not in days(1988)
    assert {(4, 10), (9, 24)} <= set(days(1959)) and (6, 9) in days(1993) and (11, 12) in days(1990)


def test_holidays_per_year():
    counts = {y: len(holidays_of(y)) for y in range(2019, 2026)}
    assert counts == {2019: 22, 2020: 18, 2021: 17, 2022: 16, 2023: 17, 2024: 21, 2025: 19}
    assert dt.date(2009, 9, 22) in holidays_of(2009)
    assert dt.date(2015, 9, 22) in holidays_of(2015)


def test_holidays_of_2024_by_hand():
    days = "1/1 1/8 2/11 2/12 2/23 3/20 4/29 5/3 5/4 5/5 5/6 7/15 8/11 8/12 9/16 9/22 9/23 10/14 11/3 11/4 11/23"
    assert list(holidays_of(2024)) == [dt.date(2024, *map(int, d.split("/"))) for d in days.split()]


def test_degree_days_exclude_each_other(spark, sf_dir):
    from loadcast.plans import inputs

    days = inputs.features(spark, sf_dir)
    assert days.filter((F.col("cdd") > 0) & (F.col("hdd") > 0)).isEmpty()
    assert days.select(*FEATURES.fieldNames()).schema == days.schema


def test_own_holiday_table(spark):
    days = spark.createDataFrame([(dt.date(2024, 5, 1), 25.0, 15.0, "晴", 3000)], MERGED)
    own = spark.createDataFrame([(dt.date(2024, 5, 1),)], "holiday_date date")
    assert make_features(days, holidays=own).first().holiday == 1
    assert make_features(days).first().holiday == 0


def test_config(tmp_path):
    file = tmp_path / "config.yaml"
    file.write_text(
        "split_date: 2024-10-01\ntest_ratio: 0.3\nstart_date: '2022-01-01'\nend_date: '2024-12-31'\n"
        "encoders:\n  - name: Ordinal\n    columns: [weather_category]\n"
        "feature_thresholds: {hot_day: 31, cold_day: 4, cdd_base: 17, hdd_base: 19}\n"
    )
    cfg = load_config(file)
    assert cfg.split_date == dt.date(2024, 10, 1) and cfg.test_ratio == 0.3
    assert cfg.encoders[0].columns == ("weather_category",)
    assert cfg.thresholds == Thresholds(31, 4, 17, 19)
    assert config_from_mapping({}) == Config()
