"""Structured Streaming forms of landing, daily peaks, feature versions and scoring."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loadcast.config import Config
from loadcast.functions.weather import missing_if_nan
from loadcast.operators.features import DEFAULTS, make_features
from loadcast.operators.model import Bundle, score
from loadcast.operators.ranking import first_per_key
from loadcast.operators.versions import stamp_versions
from loadcast.sources.archives import member_names, read_members
from loadcast.sources.files import accept
from loadcast.sources.tables import land_if_absent, spread_by_day, store


def stream_parquet(
    spark: SparkSession, path: str, schema: T.StructType, pattern: str = "*.parquet", files_per_batch: int | None = None
) -> DataFrame:
    reader = spark.readStream.schema(schema).option("pathGlobFilter", pattern)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path)


def stream_archives(spark: SparkSession, path: str) -> DataFrame:
    """`(path, length)` of new `.zip` files below a folder, each delivered once per checkpoint; none is opened."""
    schema = "path string, modificationTime timestamp, length long, content binary"
    reader = spark.readStream.format("binaryFile").schema(schema).option("pathGlobFilter", "*.zip")
    return reader.option("recursiveFileLookup", "true").load(path).select("path", "length")


def run_available(
    stream: DataFrame,
    checkpoint: str,
    path: str | None = None,
    each_batch: Callable[[DataFrame, int], None] | None = None,
) -> None:
    """Process everything that has arrived, then stop."""
    writer = stream.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True)
    if each_batch is not None:
        query = writer.foreachBatch(each_batch).start()
    else:
        query = writer.outputMode("append").format("parquet").option("path", path).start()
    query.awaitTermination()


def daily_peak_stream(
    readings: DataFrame, delay: str, keys: Sequence[str] = (), ts: str = "ts", value: str = "value"
) -> DataFrame:
    """Daily peaks of closed days: a day is emitted once the watermark has passed its end.

    `delay` is how long readings may come late. Later ones are left out of their day; the state operator's
    `numRowsDroppedByWatermark` in the query's progress counts them.
    The state is one running maximum per open day and key; readings are reduced per task before they
    reach it. Windows are cut in UTC, so the session's wall clock is read as UTC for the window and back
    for the date: the days are the same as in the batch job.
    """
    zone = F.lit(readings.sparkSession.conf.get("spark.sql.session.timeZone"))
    wall_clock = F.from_utc_timestamp(F.col(ts).cast("timestamp"), zone)
    timed = readings.withColumn("_at", wall_clock).withWatermark("_at", delay)
    peaks = timed.groupBy(*keys, F.window("_at", "1 day")).agg(F.max(missing_if_nan(F.col(value))).alias("peak"))
    return peaks.filter(F.col("peak").isNotNull()).select(
        *keys,
        F.to_date(F.to_utc_timestamp("window.start", zone)).alias("date"),
        F.col("peak").cast("long").alias("max_power"),
    )


def feature_batch_writer(
    path: str,
    moment: dt.datetime,
    cfg: Config = DEFAULTS,
    holidays: DataFrame | None = None,
    after: dt.date | Callable[[], dt.date] | None = None,
) -> Callable[[DataFrame, int], None]:
    """A batch function that adds feature versions below `path`.

    A replayed batch overwrites its own folder, so a restart adds nothing twice. Days at or before
    `after` are late and left out: nothing else drops late rows in a stateless stream. A function is asked in every
    batch, such as one that reads the control log. All batches carry the stamp `moment`; their number, the
    partition column `batch_id`, is the second key of a version.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        limit = after() if callable(after) else after
        timely = batch if limit is None else batch.filter(F.col("date") > F.lit(limit))
        versions = stamp_versions(make_features(timely, cfg, holidays), moment)
        versions.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    return write


LEDGER = "dt date, batch_id int"


def landing_batch_writer(path: str, ledger: str, strict: bool = False) -> Callable[[DataFrame, int], None]:
    """A batch function that lands one archive member per day; a day landed by an earlier batch is skipped.

    Which days are landed stands in the ledger, days and batch numbers in one small file a batch, so neither landed
    contents nor their files are looked at. Of several members for a day the first readable one by archive and member
    name counts. Only members of days not in the ledger are read. A batch has its own folder and its ledger entry comes
    last: a replay compares itself with earlier batches, overwrites its own folder, and nothing lands twice.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        names = accept(member_names(batch).withColumnRenamed("archive", "source"), strict)
        landed = read_landed(spark, ledger, LEDGER)
        fresh = names.filter(F.col("dt").isNotNull())
        if landed is not None:
            fresh = land_if_absent(fresh, landed.filter(F.col("batch_id") < batch_id))
        members = read_members(fresh.withColumnRenamed("source", "archive")).withColumnRenamed("archive", "source")
        good = store(accept(members, strict).drop("error"), "members")
        # The choice looks at names alone; contents are joined to it once.
        chosen = first_per_key(good.select("dt", "source", "member"), ["dt"], ["source", "member"])
        kept = good.join(chosen, ["dt", "source", "member"], "left_semi")
        spread_by_day(kept, "dt").write.mode("overwrite").partitionBy("dt").parquet(f"{path}/batch_id={batch_id}")
        chosen.select("dt").coalesce(1).write.mode("overwrite").parquet(f"{ledger}/batch_id={batch_id}")

    return write


def read_landed(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame | None:
    """A table that batches write, or None before its first batch."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def score_stream(requests: DataFrame, bundle: Bundle, holidays: DataFrame | None = None) -> DataFrame:
    """Scoring keeps no state, so a stream goes through the same plan as a table."""
    return score(requests, bundle, holidays)
