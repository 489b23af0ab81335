import datetime as dt
import json

import pytest

from loadcast.operators.serving import format_predictions, parse_requests

DAY = dt.date(2023, 11, 8)
ITEM = '{"date": "2023-11-08", "max_temp": 17.5, "min_temp": "6.25", "weather": "曇り"}'
FULL = [(0, DAY, 17.5, 6.25, "曇り")]
GOOD = [
    ("text/csv", "2023-11-08,17.5,6.25,曇り", FULL),
    ("text/csv; charset=utf-8", '2023-11-08,17.5,6.25,"曇り"\n\nbad,x,,nan\n', [*FULL, (1, None, None, None, None)]),
    ("application/json", ITEM, FULL),
    ("application/json", f"[{ITEM}, {ITEM}]", [*FULL, (1, *FULL[0][1:])]),
    ("application/json", '{"features":[["2023-11-08",17.5,6.25,"曇り"]]}', FULL),
    ("application/json; x", '[{"date": "2023-11-08", "max_temp": null, "min_temp": "x", "weather": null}]', [(0, DAY, None, None, None)]),
]
MULTI = '2023-11-08,17.5,6.25,"曇り,\n""後"" 雨"'
LINES = '曇り,\n"後" 雨'
GOOD += [
    ("text/csv", f"{MULTI}\r\n{MULTI}\n", [(0, *FULL[0][1:4], LINES), (1, *FULL[0][1:4], LINES)]),
    ("text/csv", '2023-11-08,17.5,6.25,5" rain', [(0, *FULL[0][1:4], '5" rain')]),
    ("application/json", f" \n\t[{ITEM}]\r\n", FULL),
    ("application/json", f"\n{ITEM}\n", FULL),
    ("application/json", '\n{"features":[' + ITEM + ', {"date": "2023-11-08", "other": 1}]}', [*FULL, (1, DAY, None, None, None)]),
]
BAD = [
    ("text/csv", '2023-11-08,17.5,6.25,"曇り\n2023-11-08,17.5,6.25,雨', "unreadable body"),
    ("application/json", '{"features":[' + ITEM + ", null]}", "not a list of objects"),
    ("application/json", "[]", "no rows"),
    ("application/json", "[1, 2]", "unreadable body"),
    ("application/json", "[null]", "not a list of objects"),
    ("application/json", "{oops", "unreadable body"),
    ("application/json", '{"date": "2023-11-08"}', "missing column"),
    ("application/json", '{"features":[["2023-11-08",17.5]]}', "rows must have four values"),
    ("application/json", '{"features":[]}', "no rows"),
    ("application/json", "7", "unreadable body"),
    ("text/csv", "", "no rows"),
    ("text/plain", "2023-11-08,17.5,6.25,曇り", "unsupported content type"),
    (None, "x", "unsupported content type"),
]


def parsed(spark, cases):
    rows = [(i, kind, body) for i, (kind, body, _) in enumerate(cases)]
    return parse_requests(spark.createDataFrame(rows, "request_id int, content_type string, body string")).collect()


def test_accepted_bodies(spark):
    rows = parsed(spark, GOOD)
    for i, (_, _, wanted) in enumerate(GOOD):
        mine = [r for r in rows if r.request_id == i]
        assert all(r.error is None for r in mine)
        assert sorted((r.row_no, r.date, r.max_temp, r.min_temp, r.weather) for r in mine) == wanted


def test_refused_bodies(spark):
    rows = parsed(spark, BAD)
    assert [r.error for r in sorted(rows, key=lambda r: r.request_id)] == [error for _, _, error in BAD]


@pytest.mark.parametrize("accept,kind", [(None, "application/json"), ("", "application/json"), ("image/png", "application/json"),
                                         ("application/json", "application/json"), ("text/csv", "text/csv")])
def test_response_formats(spark, accept, kind):
    rows = [(1, accept, i, p) for i, p in ((2, 3.5), (0, 1.0), (1, 2.0))]
    df = spark.createDataFrame(rows, "request_id int, accept string, row_no int, prediction double")
    row = format_predictions(df).first()
    assert row.content_type == kind
    if kind == "text/csv":
        assert row.body == "1.0\n2.0\n3.5\n"
    else:
        assert json.loads(row.body) == {"predictions": [1.0, 2.0, 3.5]}
