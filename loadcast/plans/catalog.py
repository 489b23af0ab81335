"""Every registered query: a function of the session and the table folder."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loadcast.config import Config
from loadcast.functions import dates
from loadcast.operators import (
    encoders, incremental, metrics, model, profile, registry, serving, split, versions,
)
from loadcast.operators import features as feature_ops
from loadcast.operators.merge import daily_peak
from loadcast.plans import daily, inputs
from loadcast.schemas import FEATURE_VERSIONS, FEATURES, MERGED, POWER_DAILY, TARGET, WEATHER_DAILY
from loadcast.session import scratch_path
from loadcast.sources import archives, files, tables
from loadcast.streaming import jobs, late

Query = Callable[[SparkSession, str], DataFrame]

CYCLES = ("dow_sin", "dow_cos", "mon_sin", "mon_cos")


def rounded(df: DataFrame, columns: Sequence[str], digits: int = 6) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) for c in columns if c in df.columns})


def features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The feature table with the cyclic columns at nine digits, as every query shows them."""
    return rounded(inputs.features(spark, sf_dir), CYCLES, 9)


def weather_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    categorized = feature_ops.categorize_weather(inputs.obs(spark, sf_dir))
    return categorized.select(*inputs.OBS_KEYS, "date", "weather_category")


def numeric_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return feature_ops.numeric_features(inputs.obs(spark, sf_dir).drop("weather"))


def calendar_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    days = inputs.obs(spark, sf_dir).select(*inputs.OBS_KEYS, "date")
    return rounded(feature_ops.calendar_features(days), CYCLES, 9)


def peaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return daily_peak(inputs.readings(spark, sf_dir))


# Landing and partitioned tables


def land_absent(spark: SparkSession, sf_dir: str) -> DataFrame:
    new = inputs.obs(spark, sf_dir).select(F.col("date").alias("dt"))
    landed = inputs.table(spark, sf_dir, "orders").select(F.to_date("o_orderdate").alias("dt"))
    return tables.land_if_absent(new, landed).groupBy("dt").agg(F.count("*").alias("n"))


def split_by_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "by-day")
    observed = inputs.obs(spark, sf_dir)
    tables.write_by_day(observed, path)
    schema = observed.schema.add("dt", "date")
    return spark.read.schema(schema).parquet(path).groupBy("dt").agg(F.count("*").alias("n"))


def dynamic_overwrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "overwritten")
    days = tables.store(inputs.merged(spark, sf_dir), "merged")
    tables.write_days(days, path)
    revised = days.filter(F.col("date") >= F.lit("2001-01-01").cast("date"))
    tables.write_days(revised.withColumn("max_power", F.col("max_power") + 1), path)
    return tables.read_merged(spark, path, MERGED)


def merged_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "merged")
    tables.write_days(inputs.merged(spark, sf_dir), path)
    return tables.read_merged(spark, path, MERGED)


# Far below the default, so that the small archives of the tests are read by several tasks as well.
RANGE_BYTES = 128 << 10


def _members(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = archives.read_zip_members(spark, inputs.write_power_archives(spark, sf_dir), RANGE_BYTES)
    return found.withColumn("member", F.element_at(F.split("member", "/"), -1))


def zip_member_explode(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _members(spark, sf_dir).select("dt", "member").distinct()


def _parsed_power(spark: SparkSession, sf_dir: str) -> DataFrame:
    return files.parse_power_csv(_members(spark, sf_dir).withColumnRenamed("member", "source"))


def power_csv_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    good = files.accept(_parsed_power(spark, sf_dir))
    return good.groupBy("dt").agg(F.count("value").alias("readings"), F.max("value").alias("peak"))


def bad_file_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return files.bad_report(_parsed_power(spark, sf_dir)).select("source", "error")


def weather_csv_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = files.read_weather(spark, inputs.write_weather_files(spark, sf_dir), "*.txt", strict=True)
    return parsed.select("date", "max_temp", "min_temp", "weather")


# Names, keys, dates and numbers


def dates_in_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    day = F.to_date("o_orderdate")
    keys = inputs.table(spark, sf_dir, "orders").select(
        dates.landing_key("raw_power_usage", day, "power_usage.csv").alias("key")
    )
    return incremental.dates_in_keys(keys)


def date_from_filename(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = F.concat(F.date_format("o_orderdate", "yyyyMMdd"), F.lit("_power_usage.csv"))
    names = inputs.table(spark, sf_dir, "orders").select(name.alias("name"))
    return names.select("name", dates.date_from_filename(F.col("name")).alias("date")).distinct()


def date_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    day, shape = F.to_date("l_shipdate"), F.col("l_linenumber")
    text = (
        F.when(shape == 1, F.date_format(day, "yyyy/M/d"))
        .when(shape == 2, F.date_format(day, "yyyy/MM/dd"))
        .when(shape == 3, F.date_format(day, "yyyyMMdd"))
        .when(shape == 4, F.date_format(day, "yyyy-MM-dd"))
        .when(shape == 5, F.concat(F.date_format(day, "yyyy"), F.lit("/13/45")))
        .when(shape == 6, F.concat(F.date_format(day, "yyyy"), F.lit("-02-30")))
        .otherwise("no date")
    )
    texts = inputs.table(spark, sf_dir, "lineitem").select(*inputs.OBS_KEYS, text.alias("text"))
    return texts.withColumn("date", dates.coerce_date(F.col("text")))


def numeric_coerce(spark: SparkSession, sf_dir: str) -> DataFrame:
    value, shape = F.col("l_quantity").cast("string"), F.col("l_linenumber")
    text = (
        F.when(shape <= 2, value)
        .when(shape == 3, F.concat(F.lit(" "), value, F.lit(" ")))
        .when(shape == 4, F.concat(value, F.lit("e1")))
        .when(shape == 5, F.concat(value, F.lit("kW")))
        .when(shape == 6, F.concat(value, F.lit("d")))
        .otherwise("nan")
    )
    texts = inputs.table(spark, sf_dir, "lineitem").select(*inputs.OBS_KEYS, text.alias("text"))
    return texts.withColumn("value", dates.coerce_number(F.col("text")))


# Incremental selection


def unprocessed_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    power = inputs.table(spark, sf_dir, "orders").select(F.to_date("o_orderdate").alias("date"))
    weather = inputs.obs(spark, sf_dir).select("date")
    return incremental.unprocessed_dates(power, weather, dt.date(2000, 1, 1))


def watermark_advance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One job per key: those of customers ran before, up to the last order; those of suppliers shipped since."""
    ordered = inputs.table(spark, sf_dir, "orders")
    control = ordered.groupBy(F.col("o_custkey").cast("string").alias("job_name")).agg(
        F.max(F.to_date("o_orderdate")).alias("last_processed"),
        F.lit(dt.datetime(2002, 1, 1)).alias("updated_at"),
    )
    shipped = inputs.table(spark, sf_dir, "lineitem")
    updates = shipped.select(
        F.col("l_suppkey").cast("string").alias("job_name"), F.to_date("l_shipdate").alias("last_processed")
    )
    state = incremental.advance_watermark(control, updates, dt.datetime(2003, 1, 1))
    return state.select("job_name", "last_processed", F.date_format("updated_at", "yyyy-MM-dd").alias("updated_on"))


# Feature versions


def feature_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    days = inputs.obs(spark, sf_dir).select(*inputs.OBS_KEYS, "date")
    return versions.stamp_versions(days, dt.datetime(2024, 12, 31, 3, 0, tzinfo=dt.timezone.utc))


def latest_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    history = inputs.obs(spark, sf_dir).withColumn("record_id", F.date_format("date", "yyyy-MM-dd"))
    latest = versions.latest_features(
        history, dt.date(1996, 1, 1), dt.date(2000, 12, 31), ["date"], inputs.OBS_KEYS, key_is_date=True
    )
    return feature_ops.numeric_features(feature_ops.categorize_weather(latest))


# Encoding and splitting


def one_hot(spark: SparkSession, sf_dir: str) -> DataFrame:
    days = inputs.features(spark, sf_dir).select("date", "weather_category")
    return encoders.OneHot(("weather_category",)).fit(days).transform(days)


def one_hot_sparse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A category of its own for every observation: where each row's vector has its 1."""
    keys = list(inputs.OBS_KEYS)
    rows = inputs.obs(spark, sf_dir).select(*keys, F.concat_ws("-", *keys).alias("label"))
    coded = encoders.SparseOneHot(("label",)).fit(rows).transform(rows)
    vector = F.unwrap_udt("label")
    return coded.select(
        *keys, vector["size"].alias("size"), F.get(vector["indices"], F.lit(0)).alias("place"),
        F.get(vector["values"], F.lit(0)).alias("value"),
    )


def ordinal_encode(spark: SparkSession, sf_dir: str) -> DataFrame:
    days = inputs.features(spark, sf_dir).select("date", "weather_category")
    coded = encoders.Ordinal(("weather_category",)).fit(days).transform(days)
    return coded.withColumnRenamed("weather_category", "code")


def train_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole encoded matrix through its headerless files and back, under the stored names and in date order."""
    path = scratch_path(spark, "matrix")
    encoded, _ = encoders.encode(features(spark, sf_dir), Config())
    names = model.feature_names(encoded)
    tables.write_matrix(encoded, path, TARGET, names)
    schema = split.target_first(encoded.drop("date")).schema
    assert tables.read_matrix_names(spark, path) == schema.fieldNames()
    return tables.read_matrix(spark, path, schema, position="position")


def split_by_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    days = inputs.merged(spark, sf_dir).select("date", "max_power")
    return split.chrono_split(days, date=dt.date(2000, 10, 1))


def split_by_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    return split.chrono_split(inputs.merged(spark, sf_dir).select("date", "max_power"), ratio=0.2)


def split_by_ratio_area(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Many rows a day and ten areas: the cut runs through a day, so sizes and borders are compared."""
    rows = inputs.obs(spark, sf_dir).withColumn("area", F.col("l_suppkey") % 10)
    labelled = split.chrono_split(rows, ratio=0.2, keys=["area"])
    return labelled.groupBy("area", "split").agg(
        F.count("*").alias("n"), F.min("date").alias("first_date"), F.max("date").alias("last_date")
    )


# Metrics and profile


def regression_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(metrics.regression_metrics(inputs.predicted(spark, sf_dir), TARGET, "predicted"), METRICS)


def _monthly_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    days = inputs.predicted(spark, sf_dir).withColumn("month", F.date_format("date", "yyyy-MM"))
    return metrics.regression_metrics(days, TARGET, "predicted", ["month"])


def regression_metrics_by_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(_monthly_metrics(spark, sf_dir), METRICS)


def prediction_extent(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(metrics.prediction_extent(inputs.predicted(spark, sf_dir), TARGET, "predicted"), ("low", "high"))


def metrics_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "reports")
    metrics.write_metrics_json(rounded(_monthly_metrics(spark, sf_dir), METRICS, 3), path, ["month"])
    return metrics.read_metrics_json(spark, path, ["month"])


def quality_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(metrics.quality_gate(_monthly_metrics(spark, sf_dir), 1_500_000.0), METRICS).select("month", "mse", "status")


def date_extent(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.date_extent(inputs.merged(spark, sf_dir))


def table_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.table_profile(inputs.merged(spark, sf_dir)).drop("type")


def category_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.category_counts(inputs.features(spark, sf_dir), "weather_category")


def distinct_weather(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.distinct_values(inputs.merged(spark, sf_dir), "weather")


def correlation_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All numeric features, plus two constant columns, one of them not exact in binary, without correlation."""
    table = inputs.features(spark, sf_dir).withColumns({"flat": F.lit(1.0), "tenth": F.lit(0.1)})
    return rounded(profile.correlation_pairs(table), ("r",))


def feature_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    binned = profile.histograms(inputs.features(spark, sf_dir), bins=10)
    return rounded(binned, ("lower", "upper"))


def feature_kde(spark: SparkSession, sf_dir: str) -> DataFrame:
    curves = profile.kde(inputs.features(spark, sf_dir))
    return rounded(rounded(curves, ("x",)), ("density",), 9)


def histogram_auto(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Automatic bins over all numeric columns of every observation, one of them with a few readings far off."""
    spike = F.when(F.col("l_orderkey") == 7, 10000.0).otherwise(F.col("max_temp"))
    return rounded(profile.histograms(inputs.obs(spark, sf_dir).withColumn("spike", spike)), ("lower", "upper"))


def rebuild_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    days = inputs.features(spark, sf_dir).select("year", "month", "day", "max_power")
    return profile.rebuild_date(days)


# Serving and registry


def parse_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    return serving.parse_requests(inputs.requests(spark, sf_dir)).drop("content_type")


def format_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One response per month: its days in order, as CSV in even months."""
    days = inputs.predicted(spark, sf_dir).select(
        F.date_format("date", "yyyy-MM").alias("request_id"),
        F.when(F.month("date") % 2 == 0, "text/csv").otherwise("application/json").alias("accept"),
        F.dayofmonth("date").alias("row_no"),
        F.col("predicted").alias("prediction"),
    )
    return serving.format_predictions(days)


def latest_approved(spark: SparkSession, sf_dir: str) -> DataFrame:
    return registry.latest_approved(inputs.registry_events(spark, sf_dir))


def gate_to_registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each year is a model group, each month a version: gate, events, decisions, and the newest approved one."""
    path = scratch_path(spark, "registry")
    gated = metrics.quality_gate(_monthly_metrics(spark, sf_dir), 1_500_000.0)
    year, month = F.substring("month", 1, 4), F.substring("month", 6, 2)
    registry.register(gated, path, year, month, dt.datetime(2024, 12, 30))
    pending = registry.read_events(spark, path)
    accurate = F.col("mse") <= 1_200_000.0
    registry.decide(pending.filter(accurate), path, registry.APPROVED, dt.datetime(2024, 12, 31))
    registry.decide(pending.filter(~accurate), path, registry.REJECTED, dt.datetime(2024, 12, 31))
    newest = registry.latest_approved(registry.read_events(spark, path))
    return rounded(newest, ("mse",)).select("model_group", "version", "status", "mse")


def score_columns_at_hand(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scoring without some trained columns and with unknown ones equals scoring with these columns missing."""
    bundle = _bundle(spark, sf_dir)
    encoded = encoders.apply_encoders(inputs.features(spark, sf_dir), bundle.encoders)
    lacking = ("rng", "hdd")
    partial = encoded.drop(*lacking).withColumn("unknown", F.lit(1))
    holes = encoded.withColumns({c: F.lit(None).cast("double") for c in lacking})
    guess = model.predict(bundle.model, partial, bundle.feature_names).select("date", F.col("prediction").alias("partial"))
    whole = model.predict(bundle.model, holes, bundle.feature_names).select("date", "prediction")
    both = whole.join(guess, "date")
    return both.select("date", (F.col("partial") == F.col("prediction")).alias("same"))


# Model


def _bundle(spark: SparkSession, sf_dir: str) -> model.Bundle:
    """One model per session and data set, kept in the scratch folder."""
    home = (spark.sparkContext.applicationId, sf_dir)
    if home not in _BUNDLES:
        path = scratch_path(spark, "bundle")
        cfg = Config(split_date=SPLIT_DATE)
        encoded, fitted = encoders.encode(tables.store(inputs.features(spark, sf_dir), "features"), cfg)
        train, _ = split.parts(split.chrono_split(encoded, cfg.split_date))
        names = model.feature_names(train)
        trained = model.fit_gbt(train, names, cfg.boosting)
        model.save_bundle(model.Bundle(trained, names, fitted, cfg), spark, path)
        _BUNDLES[home] = path
    return model.load_bundle(spark, _BUNDLES[home])


def _scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    return model.score(inputs.merged(spark, sf_dir), _bundle(spark, sf_dir))


def train_gbt(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metrics of the trained model on both parts of the split."""
    labelled = split.chrono_split(_scored(spark, sf_dir), SPLIT_DATE)
    return metrics.regression_metrics(labelled, TARGET, "prediction", ["split"])


def score_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _scored(spark, sf_dir).select("date", "prediction")


def topk_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    bundle = _bundle(spark, sf_dir)
    return model.feature_importance(bundle.model, bundle.feature_names, spark, 20)


def prediction_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.prediction_series(_scored(spark, sf_dir), TARGET, "prediction")


# Streams


def stream_daily_peak(spark: SparkSession, sf_dir: str) -> DataFrame:
    schema = inputs.table(spark, sf_dir, "events").schema
    # The table's own path, a file or a folder of part files; as a pattern, since a stream takes no single file.
    readings = jobs.stream_parquet(spark, f"{sf_dir}/events.parque[t]", schema)
    path = scratch_path(spark, "stream-peaks")
    jobs.run_available(jobs.daily_peak_stream(readings, "0 seconds"), f"{path}/checkpoint", f"{path}/table")
    return spark.read.schema(POWER_DAILY).parquet(f"{path}/table")


def stream_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "stream-features")
    inputs.merged(spark, sf_dir).write.parquet(f"{path}/in")
    moment = dt.datetime(2024, 12, 31, 3, 0, tzinfo=dt.timezone.utc)
    writer = jobs.feature_batch_writer(f"{path}/table", moment)
    arriving = jobs.stream_parquet(spark, f"{path}/in", MERGED, files_per_batch=4)
    jobs.run_available(arriving, f"{path}/checkpoint", each_batch=writer)
    landed = spark.read.schema(FEATURE_VERSIONS).parquet(f"{path}/table")
    return rounded(landed.select(*FEATURES.fieldNames()), CYCLES, 9)


def stream_new_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Archives land twice over the same checkpoint; the second run finds nothing new."""
    path = scratch_path(spark, "stream-files")
    source = inputs.write_power_archives(spark, sf_dir)
    for _ in range(2):
        _land_archives(spark, source, path)
    landed = spark.read.schema("dt date, member string").parquet(f"{path}/table")
    return landed.groupBy("dt").agg(F.count("member").alias("members"))


def _land_archives(spark: SparkSession, source: str, path: str) -> None:
    writer = jobs.landing_batch_writer(f"{path}/table", f"{path}/ledger")
    jobs.run_available(jobs.stream_archives(spark, source), f"{path}/checkpoint", each_batch=writer)


def daily_merge_from_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """From archives and weather files to the merged table; a second run of the whole chain is idle."""
    path, first = scratch_path(spark, "daily-raw"), dt.date(1900, 1, 1)
    power = inputs.write_daily_archives(spark, sf_dir)
    observed = inputs.write_weather_files(spark, sf_dir, inputs.weather_daily(spark, sf_dir))
    moved = []
    for run in range(2):
        _land_archives(spark, power, f"{path}/power")
        if not run:
            weather = files.read_weather(spark, observed, "*.txt", strict=True)
            tables.write_by_day(weather.select(*WEATHER_DAILY.fieldNames()), f"{path}/weather")
        moved.append(daily.run_daily_merge_from_raw(
            spark, f"{path}/power/table", f"{path}/weather", f"{path}/merged", f"{path}/control",
            dt.datetime(2024, 12, 31 - run), first=first,
        ))
    assert moved[0] is not None and moved[1] is None
    return tables.read_merged(spark, f"{path}/merged", MERGED)


def stream_late_peaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each day's highest reading arrives after all others: it raises the peaks of the last ten days, and is refused for
    the days before."""
    path, limit = scratch_path(spark, "late-peaks"), dt.timedelta(days=10)
    events = inputs.table(spark, sf_dir, "events").select("ts", "value")
    day = F.to_date("ts").alias("day")
    tops = events.groupBy(day).agg(F.max("value").alias("top"))
    marked = events.join(F.broadcast(tables.store(tops, "tops")), day == F.col("day")).select(
        "ts", "value", (F.col("value") == F.col("top")).alias("late")
    )
    marked = tables.store(marked, "marked")
    with late.late_state(spark):
        for arrives in (False, True):
            marked.filter(F.col("late") == arrives).select("ts", "value").write.mode("append").parquet(f"{path}/in")
            arriving = jobs.stream_parquet(spark, f"{path}/in", events.schema)
            changes = late.corrected_peak_stream(arriving, limit)
            jobs.run_available(changes, f"{path}/checkpoint", f"{path}/table")
    found = spark.read.schema(changes.schema).parquet(f"{path}/table")
    refused = F.col("kind") == late.REFUSED
    return found.groupBy("date").agg(
        F.max(F.when(~refused, F.col("max_power"))).alias("max_power"),
        F.coalesce(F.sum(F.when(refused, F.col("readings"))), F.lit(0)).alias("refused"),
    )


def stream_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "stream-score")
    inputs.merged(spark, sf_dir).write.parquet(f"{path}/in")
    scored = jobs.score_stream(jobs.stream_parquet(spark, f"{path}/in", MERGED), _bundle(spark, sf_dir))
    kept = scored.select("date", "prediction")
    jobs.run_available(kept, f"{path}/checkpoint", f"{path}/table")
    return spark.read.schema(kept.schema).parquet(f"{path}/table")


METRICS = ("mse", "rmse", "mae", "r2")
SPLIT_DATE = dt.date(2000, 10, 1)
_BUNDLES: dict[tuple[str, str], str] = {}

QUERIES: dict[str, Query] = {
    "make_features": features,
    "weather_category": weather_category,
    "numeric_features": numeric_features,
    "calendar_features": calendar_features,
    "merge_power_weather": inputs.merged,
    "daily_peak": peaks,
    "land_if_absent": land_absent,
    "split_by_day": split_by_day,
    "dynamic_overwrite": dynamic_overwrite,
    "merged_scan": merged_scan,
    "zip_member_explode": zip_member_explode,
    "power_csv_parse": power_csv_parse,
    "bad_file_report": bad_file_report,
    "weather_csv_parse": weather_csv_parse,
    "dates_in_keys": dates_in_keys,
    "date_from_filename": date_from_filename,
    "date_parse": date_parse,
    "numeric_coerce": numeric_coerce,
    "unprocessed_dates": unprocessed_dates,
    "watermark_advance": watermark_advance,
    "feature_versions": feature_versions,
    "latest_features": latest_features,
    "one_hot": one_hot,
    "one_hot_sparse": one_hot_sparse,
    "ordinal_encode": ordinal_encode,
    "train_matrix": train_matrix,
    "split_by_date": split_by_date,
    "split_by_ratio": split_by_ratio,
    "split_by_ratio_area": split_by_ratio_area,
    "regression_metrics": regression_metrics,
    "regression_metrics_by_month": regression_metrics_by_month,
    "prediction_extent": prediction_extent,
    "metrics_json": metrics_json,
    "quality_gate": quality_gate,
    "gate_to_registry": gate_to_registry,
    "score_columns_at_hand": score_columns_at_hand,
    "date_extent": date_extent,
    "table_profile": table_profile,
    "category_counts": category_counts,
    "distinct_weather": distinct_weather,
    "correlation_pairs": correlation_pairs,
    "feature_histogram": feature_histogram,
    "histogram_auto": histogram_auto,
    "feature_kde": feature_kde,
    "rebuild_date": rebuild_date,
    "parse_requests": parse_requests,
    "format_predictions": format_predictions,
    "latest_approved": latest_approved,
    "train_gbt": train_gbt,
    "score_batch": score_batch,
    "topk_importance": topk_importance,
    "prediction_series": prediction_series,
    "stream_daily_peak": stream_daily_peak,
    "stream_features": stream_features,
    "stream_new_files": stream_new_files,
    "stream_late_peaks": stream_late_peaks,
    "daily_merge_from_raw": daily_merge_from_raw,
    "stream_score": stream_score,
}
