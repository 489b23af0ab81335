"""Daily peaks on a stream, with corrections for late readings and a record of those that come too late."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from loadcast.functions.weather import missing_if_nan

CLOSED, CORRECTED, REFUSED = "closed", "corrected", "refused"
DAY_MS = 86_400_000
PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class DayPeaks(StatefulProcessor):
    """State of one day and key: its peak, and whether it has been emitted.

    The stream's watermark trails the newest reading by the limit for late ones. So a day is closed once the watermark
    comes within the limit of its end, and its state goes when the watermark passes the end.
    """

    def __init__(self, limit_ms: int, keys: Sequence[str]):
        self.limit_ms, self.keys = limit_ms, list(keys)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("peak", "peak double, closed boolean")

    def _row(self, key: tuple, kind: str, peak: float, readings: int | None) -> pd.DataFrame:
        values = {name: [value] for name, value in zip(self.keys, key[1:])}
        # A cast to an integer drops the fraction, as in the batch job.
        return pd.DataFrame({
            **values, "date": [dt.date(1970, 1, 1) + dt.timedelta(days=int(key[0]))], "kind": [kind],
            "max_power": [int(peak)], "readings": pd.array([readings], "Int64"),
        })

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues: object) -> Iterator[pd.DataFrame]:
        peak, readings = -float("inf"), 0
        for part in rows:
            peak, readings = max(peak, part["peak"].max()), readings + int(part["readings"].sum())
        watermark, end = timerValues.getCurrentWatermarkInMs(), (int(key[0]) + 1) * DAY_MS
        if watermark >= end:
            yield self._row(key, REFUSED, peak, readings)
            return
        known = self.state.get() if self.state.exists() else None
        closed = known[1] if known else watermark >= end - self.limit_ms
        if known is None:
            self.handle.registerTimer(end)
            if not closed:
                self.handle.registerTimer(max(end - self.limit_ms, 1))
        if closed and known is None:
            yield self._row(key, CLOSED, peak, readings)
        elif closed and int(peak) > int(known[0]):
            yield self._row(key, CORRECTED, peak, readings)
        self.state.update((max(peak, known[0] if known else peak), closed))

    def handleExpiredTimer(self, key: tuple, timerValues: object, expiredTimerInfo: object) -> Iterator[pd.DataFrame]:
        if not self.state.exists():
            return
        peak, closed = self.state.get()
        if not closed:
            yield self._row(key, CLOSED, peak, None)
        if expiredTimerInfo.getExpiryTimeInMs() >= (int(key[0]) + 1) * DAY_MS:
            self.state.clear()
        else:
            self.state.update((peak, True))

    def close(self) -> None:
        pass


def corrected_peak_stream(
    readings: DataFrame, limit: dt.timedelta, keys: Sequence[str] = (), ts: str = "ts", value: str = "value"
) -> DataFrame:
    """`(keys…, date, kind, max_power, readings)`: changes of daily peaks.

    A day's peak is `closed` when the newest reading lies past its end. A later reading that raises it gives a
    `corrected` row as long as the newest reading lies no more than `limit` past the day's end; after that the day's
    state is gone, and its readings give `refused` rows with their peak and number. So the last `closed` or `corrected`
    row of a day is its peak, and no reading vanishes without a trace.

    Each task hands on one row per day and key of a batch, whatever their number of readings. Days are cut in the
    session's zone, as in the batch job. The state needs the provider of `late_state`.
    """
    zone = F.lit(readings.sparkSession.conf.get("spark.sql.session.timeZone"))
    limit_ms = int(limit.total_seconds() * 1000)
    timed = readings.withColumn("_at", F.from_utc_timestamp(F.col(ts).cast("timestamp"), zone))
    timed = timed.withWatermark("_at", f"{limit_ms} milliseconds")
    # Past this selection Spark no longer knows the column as event time and hands on rows behind the watermark, too.
    dated = timed.filter("_at IS NOT NULL").select(
        F.unix_date(F.to_date(F.col(ts))).alias("_day"), *keys,
        missing_if_nan(F.col(value)).cast("double").alias("peak"), F.lit(1).cast("long").alias("readings"),
    ).filter("peak IS NOT NULL")
    named = ["_day", *keys]

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            table = pa.Table.from_batches([batch]).group_by(named).aggregate([("peak", "max"), ("readings", "sum")])
            table = table.rename_columns([*named, "peak", "readings"]) if table.column_names[0] == "_day" else (
                table.rename_columns(["peak", "readings", *named]).select([*named, "peak", "readings"])
            )
            yield from table.to_batches()

    by_key = [readings.schema[k] for k in keys]
    out = T.StructType([
        *by_key, T.StructField("date", T.DateType()), T.StructField("kind", T.StringType()),
        T.StructField("max_power", T.LongType()), T.StructField("readings", T.LongType()),
    ])
    folded = dated.mapInArrow(fold, dated.schema)
    return folded.groupBy(*named).transformWithStateInPandas(
        DayPeaks(limit_ms, keys), out, outputMode="Append", timeMode="EventTime"
    )


@contextmanager
def late_state(spark: SparkSession) -> Iterator[None]:
    """The state store that keyed state and timers need, for queries started inside."""
    old = spark.conf.get(PROVIDER)
    spark.conf.set(PROVIDER, ROCKSDB)
    try:
        yield
    finally:
        spark.conf.set(PROVIDER, old)
