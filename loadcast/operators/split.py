"""Chronological train/test split."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loadcast.operators.ranking import running_total
from loadcast.session import lookup

TRAIN, TEST = "train", "test"


def target_first(df: DataFrame, target: str = "max_power") -> DataFrame:
    return df.select(target, *[c for c in df.columns if c != target])


def chrono_split(
    df: DataFrame,
    date: dt.date | None = None,
    ratio: float = 0.2,
    keys: Sequence[str] = (),
    date_col: str = "date",
) -> DataFrame:
    """Label every row `train` or `test` in a `split` column; a date wins over the ratio."""
    if date is not None:
        dated = df.filter(F.col(date_col).isNotNull())
        return dated.withColumn("split", F.when(F.col(date_col) < F.lit(date), TRAIN).otherwise(TEST))
    return _split_by_ratio(df, ratio, list(keys), date_col)


def _split_by_ratio(df: DataFrame, ratio: float, keys: list[str], date_col: str) -> DataFrame:
    """The first `int(n * (1 - ratio))` rows by day, per key.

    Only row counts per day are ordered, at most one row per key and calendar day; each day learns how
    many of its rows are for training. The rows themselves then only look up their day. At most one day
    per key is cut through, and only its rows are ranked.
    """
    by_day = Window.partitionBy(*keys).orderBy(F.col(date_col).asc_nulls_last())
    days = (
        df.groupBy(*keys, date_col)
        .agg(F.count("*").alias("_rows"))
        .withColumn("_before", F.coalesce(F.sum("_rows").over(by_day.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
        .withColumn("_all", F.sum("_rows").over(Window.partitionBy(*keys)))
        .withColumn("_train", F.floor(F.col("_all") * F.lit(1 - ratio)))
        .withColumn("_quota", F.greatest(F.lit(0), F.least("_rows", F.col("_train") - F.col("_before"))))
    )
    day_keys = [*keys, date_col]
    quotas = lookup(days.select(*[F.col(c).alias(f"_day_{c}") for c in day_keys], "_rows", "_quota"))
    match = [df[c].eqNullSafe(quotas[f"_day_{c}"]) for c in day_keys]
    placed = df.join(quotas, match).drop(*[f"_day_{c}" for c in day_keys])

    cut = (F.col("_quota") > 0) & (F.col("_quota") < F.col("_rows"))
    whole = placed.filter(~cut).withColumn("split", F.when(F.col("_quota") > 0, TRAIN).otherwise(TEST))
    result = whole.drop("_rows", "_quota")
    if quotas.filter(cut).isEmpty():
        return result
    ties = [c for c in df.columns if c not in day_keys]
    ranked = running_total(placed.filter(cut), day_keys, ties)
    label = F.when(F.col("before") < F.col("_quota"), TRAIN).otherwise(TEST)
    return result.unionByName(ranked.withColumn("split", label).drop("before", "_rows", "_quota"))


def parts(labelled: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Train and test rows without the label."""
    train = labelled.filter(F.col("split") == TRAIN).drop("split")
    test = labelled.filter(F.col("split") == TEST).drop("split")
    return train, test
