"""The three jobs: daily merge, model build, and batch scoring."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loadcast.config import Config
from loadcast.operators.control import ControlLog, Watermark
from loadcast.operators.encoders import encode
from loadcast.operators.features import make_features
from loadcast.operators.incremental import FIRST_WATERMARK, batch_watermark, needs_run, unprocessed_dates
from loadcast.operators.merge import daily_peak, merge_daily
from loadcast.operators.metrics import (
    quality_gate, read_metrics_json, regression_metrics, write_metrics_csv, write_metrics_json,
)
from loadcast.operators.model import Bundle, feature_importance, feature_names, fit_gbt, predict, save_bundle, score
from loadcast.operators.registry import next_version, register
from loadcast.operators.serving import format_predictions, parse_requests
from loadcast.operators.split import chrono_split, parts
from loadcast.operators.versions import append_versions, latest_features, stamp_versions
from loadcast.schemas import FEATURE_VERSIONS, FEATURES, MEMBERS_LANDED, MERGED, TARGET, WEATHER_DAILY
from loadcast.session import lookup, materialize
from loadcast.sources.files import parse_power_csv
from loadcast.sources.landing import landed_days, read_landed_days
from loadcast.sources.tables import read_merged, store, write_days, write_matrix

ETL_JOB = "etl_data"
MODEL_GROUP = "daily-peak"


def run_daily_merge(
    spark: SparkSession,
    readings: DataFrame,
    weather: DataFrame,
    merged_path: str,
    control_path: str,
    now: dt.datetime,
    job: str = ETL_JOB,
) -> dt.date | None:
    """Merge the days not yet processed and move the watermark; returns the new watermark, or None if idle.

    `readings` is `(ts, value)`, `weather` the daily table. A crash between the two writes only repeats the batch:
    overwriting its days again gives the same table.
    """
    log = ControlLog(spark, control_path)
    seen = log.read(job)
    landed = readings.select(F.to_date("ts").alias("date")).distinct()
    days = lookup(unprocessed_dates(landed, weather, seen.day))
    if not needs_run(days):
        return None
    dated = readings.withColumn("_day", F.to_date("ts")).join(days.withColumnRenamed("date", "_day"), "_day", "left_semi")
    power = daily_peak(dated.drop("_day"), strict=True)
    return _merge_and_advance(weather.join(days, "date", "left_semi"), power, days, merged_path, log, seen, now)


def run_daily_merge_from_raw(
    spark: SparkSession,
    power_path: str,
    weather_path: str,
    merged_path: str,
    control_path: str,
    now: dt.datetime,
    job: str = ETL_JOB,
    first: dt.date = FIRST_WATERMARK,
) -> dt.date | None:
    """The same from landed raw days: members of power archives as `landing_batch_writer` lands them, and daily weather.

    The days at hand come from names alone, and only the folders of unprocessed days are read.
    """
    log = ControlLog(spark, control_path)
    seen = log.read(job, first)
    found = unprocessed_dates(landed_days(spark, power_path), landed_days(spark, weather_path), seen.day)
    # The filter says again what holds anyway: with it the scans below are pruned at run time.
    days = lookup(found).filter(F.col("date") > F.lit(seen.day))
    if not needs_run(days):
        return None
    members = read_landed_days(spark, power_path, MEMBERS_LANDED, days)
    power = daily_peak(parse_power_csv(members, strict=True), ts="dt", strict=True)
    weather = read_landed_days(spark, weather_path, WEATHER_DAILY, days).select(*WEATHER_DAILY.fieldNames())
    return _merge_and_advance(weather, power, days, merged_path, log, seen, now)


def _merge_and_advance(
    weather: DataFrame, power: DataFrame, days: DataFrame, merged_path: str, log: ControlLog, seen: Watermark,
    now: dt.datetime,
) -> dt.date:
    """Write the merged days and move the watermark; a writer that another has overtaken is refused."""
    write_days(merge_daily(weather, power).select(*MERGED.fieldNames()), merged_path)
    last = batch_watermark(days).first()[0]
    log.advance(seen, last, now)
    return last


@dataclass(frozen=True)
class ModelRun:
    bundle: Bundle
    metrics: DataFrame
    report: DataFrame
    importance: DataFrame
    registered: DataFrame


def run_model_build(
    spark: SparkSession, merged_path: str, out_path: str, cfg: Config, moment: dt.datetime
) -> ModelRun:
    """Features, a new feature version, latest read, encoding, split, training, evaluation and the gate."""
    features = make_features(read_merged(spark, merged_path, MERGED), cfg).select(*FEATURES.fieldNames())
    stamped = stamp_versions(features, moment).select(*FEATURE_VERSIONS.fieldNames())
    append_versions(stamped, f"{out_path}/versions")
    versions = spark.read.schema(FEATURE_VERSIONS).parquet(f"{out_path}/versions")
    # The record key is the day itself, so the range may go to the scan.
    latest = latest_features(versions, cfg.start_date, cfg.end_date, key_is_date=True)
    encoded, encoders = encode(latest, cfg)
    labelled = store(chrono_split(encoded, cfg.split_date, cfg.test_ratio), "labelled")
    train, test = parts(labelled)
    names = feature_names(train)
    write_matrix(train, f"{out_path}/train", TARGET, names)
    write_matrix(test, f"{out_path}/test", TARGET, names)
    model = fit_gbt(train, names, cfg.boosting)
    bundle = Bundle(model, names, encoders, cfg)
    save_bundle(bundle, spark, f"{out_path}/bundle")
    metrics = materialize(regression_metrics(predict(model, test, names), TARGET, "prediction"))
    write_metrics_csv(metrics, f"{out_path}/metrics")
    write_metrics_json(metrics, f"{out_path}/evaluation")
    gated = quality_gate(metrics, cfg.mse_threshold)
    registry = f"{out_path}/registry"
    version = next_version(spark, registry, MODEL_GROUP)
    register(gated, registry, F.lit(MODEL_GROUP), F.lit(version), moment)
    return ModelRun(
        bundle, metrics, read_metrics_json(spark, f"{out_path}/evaluation"), feature_importance(model, names, spark), gated
    )


def run_scoring(requests: DataFrame, bundle: Bundle) -> tuple[DataFrame, DataFrame]:
    """`(responses, rejected)` for `(request_id, content_type, accept, body)` rows."""
    parsed = parse_requests(requests)
    rejected = parsed.filter(F.col("error").isNotNull()).select("request_id", "error")
    scored = score(parsed.filter(F.col("error").isNull()).drop("error"), bundle)
    return format_predictions(scored), rejected
