"""Scoring requests: text bodies in, rows out; predictions in, response bodies out."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loadcast.functions.dates import coerce_date, coerce_number
from loadcast.schemas import REQUEST_COLUMNS
from loadcast.sources.files import MISSING_TEXTS

LINE_END = r"\r\n|\r|\n"
CSV_TYPE, JSON_TYPE = "text/csv", "application/json"
TEXT_ROW = "struct<" + ", ".join(f"{c}: string" for c in REQUEST_COLUMNS) + ">"


def _row(values: list[Column]) -> Column:
    return F.struct(*[v.cast("string").alias(c) for v, c in zip(values, REQUEST_COLUMNS)])


def parse_requests(requests: DataFrame, body: str = "body", content_type: str = "content_type") -> DataFrame:
    """One row per requested day, with the request's other columns, `row_no`, the typed inputs and `error`.

    Bodies are headerless CSV, whose quoted fields may hold line ends, a JSON list of objects, one JSON object,
    `{"features": [[…]]}` or `{"features": [{…}]}`. Of objects below `features` an absent column is a missing value, of
    others an error. A body that is none of these yields one row with an error. Bad dates and numbers become null.
    """
    text, kind = F.col(body), F.col(content_type)
    others = [c for c in requests.columns if c != body]
    is_csv, is_json = kind.startswith(CSV_TYPE), kind.startswith(JSON_TYPE)
    trimmed = F.btrim(text, F.lit(" \t\r\n"))
    columns = F.array(*[F.lit(c) for c in REQUEST_COLUMNS])

    ddl = ", ".join(f"{c} string" for c in REQUEST_COLUMNS)
    csv_rows = F.transform(_csv_records(text), lambda record: _csv_row(record, ddl))

    listed = F.when(trimmed.startswith("{"), F.concat(F.lit("["), trimmed, F.lit("]"))).otherwise(trimmed)
    outer = F.from_json(listed, "array<map<string,string>>")
    matrix = F.from_json(trimmed, "struct<features: array<array<string>>>")["features"]
    inner = F.from_json(trimmed, "struct<features: array<map<string,string>>>")["features"]
    has_features = F.coalesce(F.array_contains(F.json_object_keys(trimmed), "features"), F.lit(False))
    has_inner = F.coalesce(F.get_json_object(trimmed, "$.features[0]").startswith("{"), F.lit(False))

    staged = requests.select(
        *others,
        F.when(is_csv, csv_rows).alias("_csv"),
        F.when(is_json & has_features & ~has_inner, matrix).alias("_matrix"),
        F.when(is_json & has_features & has_inner, inner)
        .when(is_json & ~has_features & trimmed.rlike(r"^[\[{]"), outer).alias("_objects"),
        (is_json & has_features).alias("_loose"),
        (is_csv | is_json).alias("_known"),
    )
    named = F.array_distinct(F.flatten(F.transform("_objects", F.map_keys)))
    complete = F.col("_loose") | (F.size(F.array_except(columns, named)) == 0)
    ragged = F.exists("_matrix", lambda r: r.isNull() | (F.size(r) != len(REQUEST_COLUMNS)))
    broken = F.exists("_objects", lambda o: o.isNull())
    from_objects = F.transform("_objects", lambda o: _row([F.try_element_at(o, F.lit(c)) for c in REQUEST_COLUMNS]))
    from_matrix = F.transform("_matrix", lambda r: _row([F.get(r, F.lit(i)) for i in range(len(REQUEST_COLUMNS))]))
    rows = F.coalesce("_csv", from_matrix, from_objects)
    error = (
        F.when(~F.coalesce(F.col("_known"), F.lit(False)), "unsupported content type")
        .when(F.coalesce(ragged, F.lit(False)), "rows must have four values")
        .when(F.coalesce(broken, F.lit(False)), "not a list of objects")
        .when(F.size(F.col("_objects")) == 0, "no rows")
        .when(F.col("_objects").isNotNull() & ~F.coalesce(complete, F.lit(False)), "missing column")
        .when(F.coalesce(F.col("_csv"), from_matrix, from_objects).isNull(), "unreadable body")
        .when(F.size(rows) == 0, "no rows")
    )
    checked = staged.select(*others, error.alias("error"), rows.alias("_rows"))
    opened = checked.select(
        *others, "error", F.posexplode_outer(F.when(F.col("error").isNull(), F.col("_rows"))).alias("row_no", "_row")
    )
    return opened.select(
        *others,
        "row_no",
        coerce_date(F.col("_row.date")).alias("date"),
        coerce_number(F.col("_row.max_temp")).alias("max_temp"),
        coerce_number(F.col("_row.min_temp")).alias("min_temp"),
        F.col("_row.weather").alias("weather"),
        "error",
    )


# A code point that no text may hold: it stands for a line end between records.
RECORD_END = "\ufdd0"


def _csv_records(text: Column) -> Column:
    """The non-blank records of a body; null if a quoted field is not closed.

    Cut at its quotes, a text is by turns outside and inside a quoted field, doubled quotes leaving an empty part.
    Line ends are record ends in the outside parts only. A text without a quote at the beginning of a field has none.
    """
    parts = F.split(text, '"')
    marked = F.transform(
        parts, lambda part, i: F.when(i % 2 == 0, F.regexp_replace(part, LINE_END, RECORD_END)).otherwise(part)
    )
    closed = F.when(F.size(parts) % 2 == 1, F.split(F.array_join(marked, '"'), RECORD_END))
    quoted = text.rlike(r'(^|[,\r\n])"')
    records = F.when(quoted, closed).otherwise(F.split(text, LINE_END))
    return F.filter(records, lambda x: F.trim(x) != "")


def _csv_row(line: Column, ddl: str) -> Column:
    fields = F.from_csv(line, ddl, {"escape": '"'})
    return _row([F.when(~F.trim(fields[c]).isin(*MISSING_TEXTS), fields[c]) for c in REQUEST_COLUMNS])


def format_predictions(
    scored: DataFrame,
    request: str = "request_id",
    accept: str = "accept",
    row_no: str = "row_no",
    prediction: str = "prediction",
) -> DataFrame:
    """`(request, body, content_type)` with the predictions in request order; CSV on demand, else JSON.

    A response gathers the rows of one request, and those all came out of that request's single body.
    """
    gathered = scored.groupBy(request, accept).agg(
        F.array_sort(F.collect_list(F.struct(F.col(row_no).alias("at"), F.col(prediction).alias("p")))).alias("_rows")
    )
    values = F.transform("_rows", lambda r: r["p"])
    wants_csv = F.coalesce(F.col(accept).startswith(CSV_TYPE), F.lit(False))
    as_csv = F.concat(F.array_join(F.transform(values, lambda v: v.cast("string")), "\n", ""), F.lit("\n"))
    as_json = F.to_json(F.struct(values.alias("predictions")))
    return gathered.select(
        request,
        F.when(wants_csv, as_csv).otherwise(as_json).alias("body"),
        F.when(wants_csv, CSV_TYPE).otherwise(JSON_TYPE).alias("content_type"),
    )
