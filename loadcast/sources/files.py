"""Raw archives and Shift-JIS CSV files as DataFrames.

Python opens archives, decodes Shift-JIS and cuts records into fields; column lookup, dates, numbers and error rules
are native. Every parser returns an `error` column next to the data: `accept` keeps the good rows or fails on the
first bad one, `bad_report` lists what was left out.
"""

from __future__ import annotations

import io
import zipfile
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loadcast.functions.dates import coerce_number, coerce_slash_date, date_from_filename
from loadcast.sources.records import ENCODING, UNCLOSED, Layout, cut_records, decode_fields, read_records

# Layout and column names of the published files. The dash in the weather column is U+301C.
POWER_HEADER_LINE = 54
POWER_COLUMN = "当日実績(５分間隔値)(万kW)"
WEATHER_HEADER_LINE = 3
WEATHER_SKIPPED_LINES = (0, 1, 2, 4, 5)
WEATHER_COLUMNS = {
    "date": "年月日",
    "max_temp": "最高気温(℃)",
    "min_temp": "最低気温(℃)",
    "weather": "天気概況(昼：06時〜18時)",
}
# The texts that count as missing in a CSV field.
MISSING_TEXTS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A",
    "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)
MEMBERS = "archive string, member string, content binary, error string"
FLUSH_BYTES = 32 * 1024 * 1024


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """`(path, content)` of every `.zip` below a folder. An archive is one row: the format cannot be split."""
    return _read_binary(spark, path, "*.zip")


def read_csv_files(spark: SparkSession, path: str) -> DataFrame:
    """`(path, content)` of every small `.csv` below a folder, such as one day of readings."""
    return _read_binary(spark, path, "*.csv")


def _read_binary(spark: SparkSession, path: str, pattern: str) -> DataFrame:
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", "true")
    return files.load(path).select("path", "content")


def explode_zip(files: DataFrame, only_csv: bool = True) -> DataFrame:
    """One row per archive member with its day; a broken archive is one row with an error."""

    def members(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows: list[tuple] = []
            held = 0
            for path, content in zip(batch["path"], batch["content"]):
                try:
                    with zipfile.ZipFile(io.BytesIO(content)) as archive:
                        for name in archive.namelist():
                            if name.endswith("/") or (only_csv and not name.endswith(".csv")):
                                continue
                            try:
                                rows.append((path, name, archive.read(name), None))
                                held += len(rows[-1][2])
                            except Exception as broken:
                                rows.append((path, name, None, f"unreadable member: {type(broken).__name__}"))
                            if held > FLUSH_BYTES:
                                yield _frame(rows, MEMBERS)
                                rows, held = [], 0
                except zipfile.BadZipFile:
                    rows.append((path, None, None, "not a ZIP archive"))
            if rows:
                yield _frame(rows, MEMBERS)

    exploded = files.select("path", "content").mapInPandas(members, MEMBERS)
    name = F.element_at(F.split("member", "/"), -1)
    return exploded.select("archive", "member", date_from_filename(name).alias("dt"), "content", "error")


def _frame(rows: list[tuple], schema: str) -> pd.DataFrame:
    return pd.DataFrame(rows, columns=[part.split()[0] for part in schema.split(", ")], dtype=object)


def _present(field: Column) -> Column:
    """Null for the texts that mean missing."""
    return F.when(~F.trim(field).isin(*MISSING_TEXTS), field)


def parse_power_csv(
    files: DataFrame, skip: int = POWER_HEADER_LINE, column: str = POWER_COLUMN, strict: bool = False
) -> DataFrame:
    """`(source, dt, position, value, error)`: the readings of each file, found under the column's name.

    `files` holds `(source, dt, content)` and, from archives, an `error`. A file is small (one day), so it is one row
    whose records are an array. A file without the column, with a bad number, an unclosed quote or a record longer than
    its header yields one error row and no reading, as the whole file is then left out; an empty one yields a missing
    reading. Fields count from the header's; spaces after a comma are dropped.
    """
    known = F.col("error") if "error" in files.columns else F.lit(None).cast("string")
    undated = F.when(F.col("dt").isNull(), "no date in the file name")
    listed = files.select("source", "dt", "content", F.coalesce(known, undated).alias("error"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Decoded fields of the records from the header on."""
        for batch in batches:
            rows, errors, held = [], [], 0
            first = 0
            for i, (content, error) in enumerate(zip(batch.column(2).to_pylist(), batch.column(3).to_pylist())):
                fields = None
                if error is None:
                    fields, error = file_fields(content, skip)
                    held += len(content)
                rows.append(fields)
                errors.append(error)
                if held > FLUSH_BYTES or i == batch.num_rows - 1:
                    yield pa.RecordBatch.from_arrays(
                        [
                            batch.column(0).slice(first, len(rows)), batch.column(1).slice(first, len(rows)),
                            pa.array(rows, pa.list_(pa.list_(pa.string()))), pa.array(errors, pa.string()),
                        ],
                        ["source", "dt", "records", "error"],
                    )
                    rows, errors, held, first = [], [], 0, i + 1

    schema = "source string, dt date, records array<array<string>>, error string"
    opened = listed.mapInArrow(cut, schema)
    header = F.get("records", F.lit(0))
    spot = F.array_position(header, column).cast("int")
    body = F.slice("records", 2, F.greatest(F.size("records") - 1, F.lit(0)))
    fields = opened.select(
        "source", "dt", "error", F.size(header).alias("_width"), spot.alias("_spot"), body.alias("_body")
    )
    texts = F.transform("_body", lambda r: F.get(r, F.col("_spot") - 1))
    longest = F.array_max(F.transform("_body", F.size))
    found = fields.select(
        "source", "dt",
        F.when(F.col("error").isNotNull(), F.col("error"))
        .when(F.col("_width").isNull() | (longest > F.col("_width")), "unreadable file")
        .when(F.coalesce(F.col("_spot"), F.lit(0)) == 0, "missing column").alias("error"),
        F.when(F.col("_spot") > 0, texts).alias("_texts"),
    )
    values = F.transform("_texts", lambda t: F.struct(_present(t).alias("text"), coerce_number(t).alias("value")))
    typed = found.select("source", "dt", "error", values.alias("_values"))
    unread = F.exists("_values", lambda v: v["text"].isNotNull() & v["value"].isNull())
    error = F.when(F.col("error").isNotNull(), F.col("error")).when(unread, "not a number")
    missing = F.array(F.struct(F.lit(None).cast("string").alias("text"), F.lit(None).cast("double").alias("value")))
    readings = F.when(error.isNull(), F.when(F.size("_values") > 0, F.col("_values")).otherwise(missing))
    parsed = typed.select("source", "dt", error.alias("error"), F.posexplode_outer(readings).alias("position", "_one"))
    parsed = parsed.select("source", "dt", "position", F.col("_one.value").alias("value"), "error")
    return accept(parsed, strict=True) if strict else parsed


def file_fields(content: bytes, skip: int) -> tuple[list[list[str]] | None, str | None]:
    """Fields of the records of a whole file after its first `skip` lines, blank ones left out, or an error."""
    try:
        content.decode(ENCODING)
    except UnicodeDecodeError:
        return None, "undecodable text"
    records, inside = cut_records(content.splitlines()[skip:], skip_space=True)
    if inside:
        return None, UNCLOSED
    fields, _ = decode_fields([record for _, record in records], skip_space=True)
    return [f for f in fields if f != [""]], None


WEATHER_LAYOUT = Layout(WEATHER_COLUMNS, WEATHER_HEADER_LINE, WEATHER_SKIPPED_LINES)


def read_weather(
    spark: SparkSession, path: str, pattern: str = "*.csv", strict: bool = False, layout: Layout = WEATHER_LAYOUT
) -> DataFrame:
    """The weather files below a folder, parsed."""
    return parse_weather_csv(read_records(spark, path, layout, pattern), strict)


def parse_weather_csv(records: DataFrame, strict: bool = False) -> DataFrame:
    """`(source, date, max_temp, min_temp, weather, error)` per record, see `records.read_records`.

    Columns are found by the header of their own file alone; a file without a header has no columns, whatever lies
    next to it.
    """
    # Texts, typed values and errors are separate steps, so that no text is parsed more often than needed.
    typed = records.withColumns({
        "date": coerce_slash_date(F.col("_date")),
        "max_temp": coerce_number(F.col("_max_temp")),
        "min_temp": coerce_number(F.col("_min_temp")),
    })

    def unread(key: str) -> Column:
        return F.col(key).isNull() & _present(F.col(f"_{key}")).isNotNull()

    error = (
        F.when(F.col("error").isNotNull(), F.col("error"))
        .when(F.col("_absent"), "missing column")
        .when(F.col("date").isNull(), "bad date")
        .when(unread("max_temp") | unread("min_temp"), "not a number")
    )
    row = F.struct(
        "source", "date", "max_temp", "min_temp", _present(F.col("_weather")).alias("weather"), error.alias("error")
    )
    # Through inline, a later filter on the error is not moved below the parsing and made to repeat it.
    parsed = typed.select(F.inline(F.array(row)))
    return accept(parsed, strict=True) if strict else parsed


def accept(parsed: DataFrame, strict: bool = False) -> DataFrame:
    """Rows without an error; with `strict`, reading a row that has one fails."""
    error = F.col("error")
    if strict:
        fail = F.raise_error(F.concat_ws(": ", F.col("source"), error)).cast("boolean")
        return parsed.filter(F.when(error.isNotNull(), fail).otherwise(True))
    return parsed.filter(error.isNull())


def bad_report(parsed: DataFrame) -> DataFrame:
    """What was left out: `(source, error, n)`."""
    return parsed.filter(F.col("error").isNotNull()).groupBy("source", "error").agg(F.count("*").alias("n"))
