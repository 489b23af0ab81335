"""Explicit schemas of the stored tables."""

from __future__ import annotations

from pyspark.sql import types as T

READINGS = T.StructType([
    T.StructField("ts", T.TimestampType()),
    T.StructField("value", T.DoubleType()),
])

POWER_DAILY = T.StructType([
    T.StructField("date", T.DateType()),
    T.StructField("max_power", T.LongType()),
])

WEATHER_DAILY = T.StructType([
    T.StructField("date", T.DateType()),
    T.StructField("max_temp", T.DoubleType()),
    T.StructField("min_temp", T.DoubleType()),
    T.StructField("weather", T.StringType()),
])

MEMBERS_LANDED = T.StructType([
    T.StructField("source", T.StringType()),
    T.StructField("member", T.StringType()),
    T.StructField("content", T.BinaryType()),
])

MERGED = T.StructType([*WEATHER_DAILY.fields, T.StructField("max_power", T.LongType())])

FEATURES = T.StructType([
    T.StructField("date", T.DateType()),
    T.StructField("weather_category", T.StringType()),
    T.StructField("max_temp", T.DoubleType()),
    T.StructField("min_temp", T.DoubleType()),
    T.StructField("max_power", T.LongType()),
    T.StructField("avg", T.DoubleType()),
    T.StructField("rng", T.DoubleType()),
    T.StructField("cdd", T.DoubleType()),
    T.StructField("hdd", T.DoubleType()),
    T.StructField("hot", T.IntegerType()),
    T.StructField("cold", T.IntegerType()),
    T.StructField("year", T.IntegerType()),
    T.StructField("month", T.IntegerType()),
    T.StructField("day", T.IntegerType()),
    T.StructField("dow", T.IntegerType()),
    T.StructField("dow_sin", T.DoubleType()),
    T.StructField("dow_cos", T.DoubleType()),
    T.StructField("mon_sin", T.DoubleType()),
    T.StructField("mon_cos", T.DoubleType()),
    T.StructField("weekend", T.IntegerType()),
    T.StructField("holiday", T.IntegerType()),
])

FEATURE_VERSIONS = T.StructType([
    T.StructField("record_id", T.StringType()),
    T.StructField("event_time", T.StringType()),
    *FEATURES.fields,
])

WATERMARK = T.StructType([
    T.StructField("job_name", T.StringType()),
    T.StructField("last_processed", T.DateType()),
    T.StructField("updated_at", T.TimestampType()),
])

REQUEST_COLUMNS = ("date", "max_temp", "min_temp", "weather")

TARGET = "max_power"
