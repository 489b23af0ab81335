"""Regression metrics, their report and the quality gate."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

PENDING = "PendingManualApproval"


def regression_metrics(df: DataFrame, y: str, predicted: str, keys: Sequence[str] = ()) -> DataFrame:
    """`n, mse, rmse, mae, r2` in one pass over the rows that have both values.

    R² is 1 - SSE/SST, which goes below zero for a predictor worse than the mean. A constant target gives
    1 when every prediction is right and 0 otherwise; fewer than two rows give null.
    """
    actual, guess = F.col(y).cast("double"), F.col(predicted).cast("double")
    gap = actual - guess
    sums = (
        df.filter(actual.isNotNull() & guess.isNotNull())
        .groupBy(*keys)
        .agg(
            F.count("*").alias("n"),
            F.avg(gap * gap).alias("mse"),
            F.avg(F.abs(gap)).alias("mae"),
            F.var_pop(actual).alias("_spread"),
        )
    )
    ratio = F.col("mse") / F.nullif(F.col("_spread"), F.lit(0.0))
    r2 = (
        F.when(F.col("n") < 2, F.lit(None).cast("double"))
        .when(F.col("_spread") > 0, 1 - ratio)
        .otherwise(F.when(F.col("mse") == 0, 1.0).otherwise(0.0))
    )
    return sums.select(*keys, "n", "mse", F.sqrt("mse").alias("rmse"), "mae", r2.alias("r2"))


def metrics_json(metrics: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """`{"regression_metrics":{"mse":{"value":x}}}` as one text per metrics row."""
    mse = F.struct(F.struct(F.col("mse").alias("value")).alias("mse"))
    return metrics.select(*keys, F.to_json(F.struct(mse.alias("regression_metrics"))).alias("report"))


def write_metrics_json(metrics: DataFrame, path: str, keys: Sequence[str] = ()) -> None:
    """The reports as text files below `path`, one folder per value of the keys."""
    reports = metrics_json(metrics, keys).withColumnRenamed("report", "value")
    writer = (reports if keys else reports.coalesce(1)).write.mode("overwrite")
    (writer.partitionBy(*keys) if keys else writer).text(path)


def read_metrics_json(spark: SparkSession, path: str, keys: Sequence[str] = ()) -> DataFrame:
    """The stored reports under their keys, which are texts."""
    schema = ", ".join(["value string", *[f"{k} string" for k in keys]])
    return spark.read.schema(schema).text(path, wholetext=False).select(*keys, F.col("value").alias("report"))


def write_metrics_csv(metrics: DataFrame, path: str) -> None:
    metrics.write.mode("overwrite").csv(path, header=True)


def quality_gate(metrics: DataFrame, threshold: float) -> DataFrame:
    """Metrics rows at or below the threshold, marked as waiting for approval."""
    return metrics.filter(F.col("mse") <= F.lit(threshold)).withColumn("status", F.lit(PENDING))


def prediction_series(df: DataFrame, y: str, predicted: str, date_col: str = "date") -> DataFrame:
    return df.select(F.col(date_col).alias("date"), F.col(y).alias("actual"), F.col(predicted).alias("predicted"))


def prediction_extent(df: DataFrame, y: str, predicted: str, keys: Sequence[str] = ()) -> DataFrame:
    """The axis range of a scatter of both values: 5 % below the lowest, 5 % above the highest."""
    actual, guess = F.col(y).cast("double"), F.col(predicted).cast("double")
    return df.groupBy(*keys).agg(
        (F.least(F.min(actual), F.min(guess)) * 0.95).alias("low"),
        (F.greatest(F.max(actual), F.max(guess)) * 1.05).alias("high"),
    )
