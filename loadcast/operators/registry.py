"""Model registry events."""

from __future__ import annotations

import datetime as dt

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loadcast.operators.ranking import latest_per_key

APPROVED, REJECTED = "Approved", "Rejected"
EVENTS = "model_group string, version long, status string, created timestamp, mse double"


def append_events(events: DataFrame, path: str) -> None:
    """Add events to the registry; nothing in it is ever changed."""
    columns = [part.split()[0] for part in EVENTS.split(", ")]
    events.select(*columns).write.mode("append").parquet(path)


def read_events(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(EVENTS).parquet(path)


def register(gated: DataFrame, path: str, group: Column, version: Column, moment: dt.datetime) -> None:
    """One event per metrics row that has passed the gate, with the status that the gate gave it."""
    append_events(gated.select(
        group.alias("model_group"), version.cast("long").alias("version"), "status", F.lit(moment).alias("created"), "mse"
    ), path)


def decide(versions: DataFrame, path: str, status: str, moment: dt.datetime) -> None:
    """An event with a decision for each of the registered versions given."""
    append_events(versions.withColumns({"status": F.lit(status), "created": F.lit(moment)}), path)


def next_version(spark: SparkSession, path: str, group: str) -> int:
    """The version after the newest one of a group."""
    try:
        known = read_events(spark, path).filter(F.col("model_group") == group).agg(F.max("version")).first()[0]
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        known = None
    return (known or 0) + 1


def latest_approved(
    events: DataFrame, group: str = "model_group", created: str = "created", version: str = "version"
) -> DataFrame:
    """The newest approved model version of every group."""
    approved = events.filter(F.col("status") == APPROVED)
    return latest_per_key(approved, [group], [created, version])
