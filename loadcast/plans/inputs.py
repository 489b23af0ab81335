"""Weather, power and request views over the supplied benchmark tables."""

from __future__ import annotations

import zipfile
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loadcast.operators.features import make_features
from loadcast.operators.merge import merge_daily
from loadcast.operators.ranking import first_per_key
from loadcast.schemas import FEATURES
from loadcast.session import scratch_path
from loadcast.sources.archives import locate
from loadcast.sources.files import POWER_COLUMN, POWER_HEADER_LINE, WEATHER_COLUMNS
from loadcast.sources.records import ENCODING

# The weather text for each remainder of l_partkey / 17; the last one is missing.
WEATHER_TEXTS = (
    "快晴", "晴", "晴後曇", "晴一時雨", "曇", "くもり時々雨", "雨", "あめ", "雪", "大雪時々曇", "雷",
    "雨一時雷を伴う", "晴一時雷", "曇一時雷を伴う", "霧", "快晴後薄曇", None,
)
OBS_KEYS = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def obs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One weather observation per line item."""
    texts = F.array(*[F.lit(t).cast("string") for t in WEATHER_TEXTS])
    high = F.col("l_quantity") - 10
    return table(spark, sf_dir, "lineitem").select(
        *OBS_KEYS,
        F.to_date("l_shipdate").alias("date"),
        high.alias("max_temp"),
        (high - F.round(F.col("l_discount") * 100)).alias("min_temp"),
        F.element_at(texts, (F.col("l_partkey") % len(WEATHER_TEXTS) + 1).cast("int")).alias("weather"),
    )


def weather_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    picked = first_per_key(obs(spark, sf_dir), ["date"], [*OBS_KEYS, "max_temp", "min_temp"])
    return picked.select("date", "max_temp", "min_temp", "weather")


def power_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        table(spark, sf_dir, "orders")
        .groupBy(F.to_date("o_orderdate").alias("date"))
        .agg(F.floor(F.max("o_totalprice") / 100).cast("long").alias("max_power"))
    )


def merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merge_daily(weather_daily(spark, sf_dir), power_daily(spark, sf_dir))


def features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return make_features(merged(spark, sf_dir)).select(*FEATURES.fieldNames())


def readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select("ts", "value")


def predicted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Merged days with a fixed linear predictor, so that metrics have a known answer."""
    guess = F.lit(4000.0) + 10 * F.col("max_temp") - 5 * F.col("min_temp")
    return merged(spark, sf_dir).withColumn("predicted", guess)


def write_power_archives(spark: SparkSession, sf_dir: str) -> str:
    """All events as ZIP archives of Shift-JIS day files below a folder, one archive per task.

    Events of type `error` go to files without the reading column, and each archive carries a text member
    that is not a CSV file, so that both rules for bad input have work to do.
    """
    path = scratch_path(spark, "power-archives")
    preamble = "\r\n".join(["電力使用状況,0"] * POWER_HEADER_LINE) + "\r\n"

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        task = TaskContext.get()
        store, folder = locate(path)
        store.create_dir(folder, recursive=True)
        name = f"{folder}/part-{task.partitionId():05d}"
        # A task that runs again replaces its archive.
        attempt = f"{name}.{task.taskAttemptId()}"
        with store.open_output_stream(attempt) as sink, zipfile.ZipFile(sink, "w", zipfile.ZIP_DEFLATED) as archive:
            archive.writestr("readme.txt", "not a day file")
            for number, batch in enumerate(batches):
                for (day, broken), rows in batch.groupby(["day", "broken"]):
                    column = "予備" if broken else POWER_COLUMN
                    lines = [f"DATE,TIME,{column}"]
                    lines += [f"{day},{at},{value!r}" for at, value in zip(rows["at"], rows["value"].tolist())]
                    kind = "broken" if broken else "power"
                    body = preamble + "\r\n".join(lines) + "\r\n"
                    archive.writestr(f"{number}/{day}_{kind}_usage.csv", body.encode(ENCODING))
        store.move(attempt, f"{name}.zip")
        yield pd.DataFrame({"archive": [f"{name}.zip"]})

    events = table(spark, sf_dir, "events").select(
        F.date_format("ts", "yyyyMMdd").alias("day"),
        F.date_format("ts", "HH:mm").alias("at"),
        "value",
        (F.col("event_type") == "error").alias("broken"),
    )
    events.mapInPandas(pack, "archive string").write.format("noop").mode("overwrite").save()
    return path


SLOTS = 288


def write_daily_archives(spark: SparkSession, sf_dir: str) -> str:
    """Orders as one Shift-JIS day file of at most 288 readings each, in one ZIP archive a month, as they are published."""
    path = scratch_path(spark, "daily-archives")
    slot = F.col("o_orderkey") % SLOTS
    readings = table(spark, sf_dir, "orders").groupBy(F.to_date("o_orderdate").alias("date"), slot.alias("slot")).agg(
        (F.max("o_totalprice") / 100).alias("value")
    )
    at = F.format_string("%d:%02d", (F.col("slot") / 12).cast("int"), (F.col("slot") % 12 * 5).cast("int"))
    line = F.concat_ws(",", F.date_format("date", "yyyy/M/d"), at, F.col("value").cast("string"))
    listed = F.array_sort(F.collect_list(F.struct("slot", line.alias("line"))))
    preamble = "\n".join(["電力使用状況,0"] * POWER_HEADER_LINE + [f"DATE,TIME,{POWER_COLUMN}", ""])
    body = F.concat(F.lit(preamble), F.array_join(F.transform(listed, lambda x: x["line"]), "\n"))
    days = readings.groupBy("date").agg(body.alias("body")).withColumn("month", F.date_format("date", "yyyyMM"))

    def pack(key: tuple, month: pd.DataFrame) -> pd.DataFrame:
        store, folder = locate(path)
        store.create_dir(folder, recursive=True)
        attempt = f"{folder}/{key[0]}.{TaskContext.get().taskAttemptId()}"
        with store.open_output_stream(attempt) as sink, zipfile.ZipFile(sink, "w", zipfile.ZIP_DEFLATED) as archive:
            for date, body in zip(month["date"], month["body"]):
                archive.writestr(f"{date:%Y%m%d}_power_usage.csv", body.encode(ENCODING))
        store.move(attempt, f"{folder}/{key[0]}_power_usage.zip")
        return pd.DataFrame({"archive": [key[0]]})

    days.groupBy("month").applyInPandas(pack, "archive string").write.format("noop").mode("overwrite").save()
    return path


def write_weather_files(spark: SparkSession, sf_dir: str, observed: DataFrame | None = None) -> str:
    """All observations as Shift-JIS weather files with preamble and header, one file per task.

    Every other day carries a quoted remark with quotes, a comma and a line end."""
    path = scratch_path(spark, "weather-files")
    high = [WEATHER_COLUMNS[c] for c in ("date", "max_temp", "max_temp", "min_temp")]
    names = [*high, "備考", WEATHER_COLUMNS["weather"]]
    remark = F.when(F.dayofmonth("date") % 2 == 0, '"注意\n""2"", 続き"').otherwise("")
    opening = ["地点", "", "東京", ",".join(names), "品質", "均質"]

    def lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head = opening
        for batch in batches:
            # All lines of a batch are one text, which ends in the line end that the writer adds.
            text = "\n".join([*head, *batch.column(0).to_pylist()])
            yield pa.RecordBatch.from_arrays([pa.array([text.encode(ENCODING)], pa.binary())], ["raw"])
            head = []

    # The second column of the same name must be ignored by the reader.
    line = F.concat_ws(
        ",",
        F.date_format("date", "yyyy/M/d"),
        F.col("max_temp").cast("string"),
        F.lit("999"),
        F.col("min_temp").cast("string"),
        remark,
        F.coalesce("weather", F.lit("")),
    )
    source = obs(spark, sf_dir) if observed is None else observed
    raw = source.select(line.alias("line")).mapInArrow(lines, "raw binary")
    raw.select(F.col("raw").cast("string").alias("value")).write.text(path)
    return path


def requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One scoring request per day of weather, in each of the accepted shapes and some that are refused."""
    days = weather_daily(spark, sf_dir)
    day = F.date_format("date", "yyyy-MM-dd")
    high, low = F.col("max_temp").cast("string"), F.col("min_temp").cast("string")
    quoted = F.concat(F.lit('"'), F.coalesce("weather", F.lit("")), F.lit('"'))
    word = F.when(F.col("weather").isNull(), "null").otherwise(quoted)
    csv = F.concat_ws(",", day, high, low, F.coalesce("weather", F.lit("")))
    item = F.concat(
        F.lit('{"date": "'), day, F.lit('", "max_temp": '), high, F.lit(', "min_temp": "'), low,
        F.lit('", "weather": '), word, F.lit("}"),
    )
    cells = F.concat(F.lit('["'), day, F.lit('", '), high, F.lit(", "), low, F.lit(", "), word, F.lit("]"))
    # A quoted field with a comma, a quote and a line end.
    multi = F.concat_ws(",", day, high, low, F.lit('"晴,\n""後"" 曇"'))
    shape, odd = F.weekday("date"), F.dayofmonth("date") % 2 == 1
    body = (
        F.when(shape == 0, F.concat(csv, F.lit("\n"), multi, F.lit("\n")))
        .when((shape == 1) & odd, F.concat(F.lit('\n{"features": ['), item, F.lit(", "), item, F.lit("]}")))
        .when(shape == 1, F.concat(F.lit("\n["), item, F.lit(", "), item, F.lit("]")))
        .when(shape == 2, item)
        .when(shape == 3, F.concat(F.lit('{"features": ['), cells, F.lit("]}")))
        .when(shape == 4, "[]")
        .when(shape == 5, csv)
        .otherwise('{"date": "2023-11-08"}')
    )
    kind = F.when(shape == 0, "text/csv; charset=utf-8").when(shape == 5, "text/plain").otherwise("application/json")
    return days.select(day.alias("request_id"), kind.alias("content_type"), body.alias("body"))


def registry_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders read as registry events: the customer is the model group, the order the version."""
    return table(spark, sf_dir, "orders").select(
        F.concat(F.lit("group-"), F.col("o_custkey").cast("string")).alias("model_group"),
        F.col("o_orderkey").alias("version"),
        F.when(F.col("o_orderstatus") == "F", "Approved")
        .when(F.col("o_orderstatus") == "O", "PendingManualApproval")
        .otherwise("Rejected")
        .alias("status"),
        F.to_date("o_orderdate").alias("created"),
    )
