"""Landed days: which there are, by names alone, and the rows of wanted days, by partition pruning."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loadcast.operators.incremental import dates_in_keys


def landed_names(spark: SparkSession, path: str, pattern: str = "*.parquet") -> DataFrame:
    """`key` of every file below a folder. No file is opened: contents are not among the columns that are read."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", "true")
    return files.load(path).select(F.col("path").alias("key"))


def landed_days(spark: SparkSession, path: str, pattern: str = "*.parquet") -> DataFrame:
    """The distinct days named in the keys below a folder."""
    return dates_in_keys(landed_names(spark, path, pattern)).select(F.col("dt").cast("date").alias("date"))


def read_landed_days(spark: SparkSession, path: str, schema: T.StructType, days: DataFrame) -> DataFrame:
    """Rows of the folders of `days`, with their day `dt`.

    The days are joined to the partition column, so at run time the scan is pruned to their folders. Spark only does
    that for a broadcast side with a filter, and `days` as `unprocessed_dates` gives them have one.
    """
    parts = T.StructType([*[f for f in schema.fields if f.name != "dt"], T.StructField("dt", T.DateType())])
    landed = spark.read.schema(parts).parquet(path)
    wanted = days.select(F.col("date").alias("dt"))
    return landed.join(wanted, "dt", "left_semi")
