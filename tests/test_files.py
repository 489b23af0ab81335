import csv
import datetime as dt
import io
import itertools
import zipfile

import pyarrow as pa
import pytest

from loadcast.functions import dates
from loadcast.sources import archives as archive_source
from loadcast.sources import files, records
from pyspark.sql import functions as F

POWER = files.POWER_COLUMN
PREAMBLE = ["前置き"] * files.POWER_HEADER_LINE


def power_csv(values, column=POWER, end="\r\n"):
    lines = [*PREAMBLE, f"DATE,TIME,{column},太陽光", *[f"2024/4/1,0:00,{v},1" for v in values], ""]
    return end.join(lines).encode("shift_jis")


def archive(members):
    buffer = io.BytesIO()
    with zipfile.ZipFile(buffer, "w") as z:
        for name, content in members.items():
            z.writestr(name, content)
    return buffer.getvalue()


@pytest.fixture
def archives(tmp_path):
    (tmp_path / "202404_power_usage.zip").write_bytes(archive({
        "20240401_power_usage.csv": power_csv([4000.2, 4321.9, ""]),
        "20240402_power_usage.csv": power_csv([10], column="別"),
        "20240403_power_usage.csv": power_csv([10, "abc"]),
        "20240404_power_usage.csv": b"\x81" * 9,
        "nodate_power_usage.csv": power_csv([1]),
        "readme.txt": "x",
    }))
    (tmp_path / "broken.zip").write_bytes(b"not a zip")
    (tmp_path / "other.csv").write_bytes(power_csv([7]))
    return str(tmp_path)


def test_explode_keeps_csv_members_only(spark, archives):
    rows = files.explode_zip(files.read_archives(spark, archives)).collect()
    assert len(rows) == 6
    assert {r.dt for r in rows if r.error is None} == {None, *[dt.date(2024, 4, d) for d in (1, 2, 3, 4)]}
    assert [r.error for r in rows if r.error] == ["not a ZIP archive"]
    everything = files.explode_zip(files.read_archives(spark, archives), only_csv=False)
    assert everything.filter("member = 'readme.txt'").count() == 1


def test_power_csv_permissive_and_strict(spark, archives):
    members = files.explode_zip(files.read_archives(spark, archives)).withColumnRenamed("member", "source")
    parsed = files.parse_power_csv(members)
    good = sorted((r.dt, r.position, r.value) for r in files.accept(parsed).collect() if r.value is not None)
    assert good == [(dt.date(2024, 4, 1), 0, 4000.2), (dt.date(2024, 4, 1), 1, 4321.9)]
    report = {r.source: r.error for r in files.bad_report(parsed).collect()}
    assert report == {
        "20240402_power_usage.csv": "missing column",
        "20240403_power_usage.csv": "not a number",
        "20240404_power_usage.csv": "undecodable text",
        "nodate_power_usage.csv": "no date in the file name",
        None: "not a ZIP archive",
    }
    with pytest.raises(Exception, match="missing column|not a number|undecodable|no date|not a ZIP"):
        files.parse_power_csv(members, strict=True).collect()


HEADER = "年月日,最高気温(℃),最高気温(℃),最低気温(℃),天気概況(昼：06時〜18時)"


def weather_csv(rows, header=HEADER):
    return "\n".join(["a", "", "東京", header, "品質", "均質", *rows]).encode("shift_jis")


def test_weather_csv(spark, tmp_path):
    (tmp_path / "w.csv").write_bytes(weather_csv([
        '2024/4/1,20.5,99,10.0,"晴,のち曇"', "2024/04/02,NaN,99,,", "", "2024/13/45,1,1,1,雨", "2024/4/3,x,1,1,雨",
    ]))
    (tmp_path / "bad.csv").write_bytes(weather_csv(["2024/4/9,1"], header="年月日,別"))
    (tmp_path / "broken.csv").write_bytes(weather_csv(["2024/4/5,1,1,1,雨"]) + b"\n2024/4/6,1,1,1,\x81\n2024/4/7,1")
    parsed = files.read_weather(spark, str(tmp_path))
    good = sorted(tuple(r)[1:5] for r in files.accept(parsed).collect())
    assert good == [
        (dt.date(2024, 4, 1), 20.5, 10.0, "晴,のち曇"), (dt.date(2024, 4, 2), None, None, None),
        (dt.date(2024, 4, 5), 1.0, 1.0, "雨"), (dt.date(2024, 4, 7), 1.0, None, None),
    ]
    report = {(r.source[-5:], r.error): r.n for r in files.bad_report(parsed).collect()}
    assert report == {
        ("w.csv", "bad date"): 1, ("w.csv", "not a number"): 1, ("d.csv", "missing column"): 1,
        ("n.csv", "undecodable text"): 1,
    }
    with pytest.raises(Exception, match="bad date|missing column|not a number|undecodable"):
        files.read_weather(spark, str(tmp_path), strict=True).collect()


@pytest.fixture
def small_splits(spark):
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")

    def use(size):
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))

    yield use
    spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_a_split_weather_file_gives_every_line_once(spark, tmp_path, small_splits):
    days = [dt.date(2000, 1, 1) + dt.timedelta(days=i % 9000) for i in range(40000)]
    rows = [f"{d.year}/{d.month}/{d.day},{i},0,1,晴後曇" for i, d in enumerate(days)]
    (tmp_path / "w.csv").write_bytes(weather_csv(rows))
    small_splits(64 * 1024)
    assert spark.read.text(str(tmp_path)).rdd.getNumPartitions() > 4
    got = files.read_weather(spark, str(tmp_path), strict=True)
    assert sorted(r.max_temp for r in got.collect()) == list(range(40000))


def test_quoted_line_ends_at_every_border(spark, tmp_path, small_splits):
    """The border between splits goes through quoted fields, quotes and line ends, and over fields of several splits."""
    texts = ["晴", 'a\n"b", c', "\n" * 5, '"' * 3, "x" * 40 + "\n" + "y" * 150 + "\nz", "雨,\n曇", "", 'in 5" of']
    rows, wanted = [], []
    for i in range(60):
        text = texts[i % len(texts)]
        quoted = text if i % 8 in (0, 7) else '"' + text.replace('"', '""') + '"'
        rows.append(f"2024/1/{i % 28 + 1},{i},9,1,{quoted}")
        wanted.append((float(i), text or None))
    (tmp_path / "w.csv").write_bytes(weather_csv(rows))
    wanted = [(n, None if t is None or not t.strip(" ") else t) for n, t in wanted]
    for size in (120, 131, 150, 256, 1000):
        small_splits(size)
        got = files.read_weather(spark, str(tmp_path), strict=True)
        assert sorted((r.max_temp, r.weather) for r in got.collect()) == wanted, size
    whole = spark.createDataFrame([("s", bytearray((tmp_path / "w.csv").read_bytes()))], "source string, content binary")
    found = files.parse_weather_csv(records.records_of(whole, files.WEATHER_LAYOUT), strict=True)
    assert sorted((r.max_temp, r.weather) for r in found.collect()) == wanted


def test_unclosed_and_long_fields_are_errors(spark, tmp_path, small_splits, monkeypatch):
    (tmp_path / "open.csv").write_bytes(weather_csv(["2024/1/1,1,9,1,雨"] * 3 + ['2024/1/2,2,9,1,"雨'] + ["2024/1/3,1,9,1,雨"] * 9))
    (tmp_path / "fine.csv").write_bytes(weather_csv([f"2024/1/1,{i},9,1,雨" for i in range(20)]))
    for size in (130, 1 << 27):
        small_splits(size)
        parsed = files.read_weather(spark, str(tmp_path))
        assert files.accept(parsed).count() == 23
        report = [(r.source[-8:], r.error, r.n) for r in files.bad_report(parsed).collect()]
        assert report == [("open.csv", "unclosed quote", 1)]


def test_cut_files_are_read_twice(spark, tmp_path, small_splits):
    """Records over borders come from the first run through the splits: no third one reads the files again."""
    rows = [f'2024/1/{i % 28 + 1},{i},9,1,"晴\n""{i}"""' for i in range(400)]
    (tmp_path / "w.csv").write_bytes(weather_csv(rows))
    small_splits(997)
    got = files.read_weather(spark, str(tmp_path), strict=True)
    assert sorted((r.max_temp, r.weather) for r in got.collect()) == [(float(i), f'晴\n"{i}"') for i in range(400)]
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation [") == 1, plan


def test_header_over_lines_in_a_cut_file(spark, tmp_path, small_splits):
    """The columns of a record over a border are those of the header's whole record, as for the other records."""
    header = '"備\n考",' + HEADER
    rows = [f'x,2024/1/{i % 28 + 1},{i},9,1,"晴\n{i}"' for i in range(60)]
    (tmp_path / "w.csv").write_bytes(weather_csv(rows, header=header))
    found = {}
    for size in (150, 1 << 27):
        small_splits(size)
        got = files.read_weather(spark, str(tmp_path))
        found[size] = sorted((r.max_temp is None, r.max_temp or 0, r.weather or "", r.error or "") for r in got.collect())
    assert [r for r in found[1 << 27] if not r[3]] == [(False, float(i), f"晴\n{i}", "") for i in range(60)]


def test_sides_of_a_split():
    """Any cut of a text, in batches of any size, gives the pieces that a plain reading gives."""
    text = b'a,"b\n""c"", d",e\nf,g\n"h\n\n\ni",j\nk"l,"\n"\nm,n\n"o'
    lines = text.split(b"\n")
    for a, b, step in itertools.product(range(len(lines)), range(1, len(lines) + 1), (1, 2, 99)):
        part = lines[a:b]
        if not part:
            continue
        scout = records._Scout(files.WEATHER_LAYOUT, "s", 7)
        for k in range(0, len(part), step):
            scout.take(pa.array(part[k:k + step], pa.binary()))
        found = scout.result().to_pylist()[0]
        for inside, ends, rest in ((False, "outside", "open_outside"), (True, "inside", "open_inside")):
            state, held, head = inside, [], None
            for line in part:
                held = [*held, line] if state else [line]
                state = records.ends_inside(line, state)
                if not state and inside and head is None:
                    head = b"\n".join(held)
            assert found[ends] == state
            if inside:
                assert found["closed"] == (head is not None)
                assert found["head"] == (b"\n".join(held) if head is None else head)
            if state and not (inside and head is None):
                assert found[rest] == b"\n".join(held)


def test_open_ends_of_lines():
    for line, skip in itertools.product(("".join(c) for n in range(6) for c in itertools.product('",a ', repeat=n)), (False, True)):
        for inside in (False, True):
            text = ('"' if inside else "") + line + "\n"
            rows = list(csv.reader([text, 'z"'], skipinitialspace=skip))
            assert records.ends_inside(line.encode(), inside, skip) == (len(rows) == 1), (line, inside)


def test_records_of_contents(spark):
    df = spark.createDataFrame([("s", bytearray(weather_csv(["2024/4/1,1,2,3,雪"])))], "source string, content binary")
    row = files.parse_weather_csv(records.records_of(df, files.WEATHER_LAYOUT)).first()
    assert tuple(row)[1:] == (dt.date(2024, 4, 1), 1.0, 3.0, "雪", None)


def test_one_archive_feeds_many_tasks(spark, tmp_path):
    members = {f"d/202404{d:02d}_power_usage.csv": power_csv([d] * 300) for d in range(1, 31)}
    (tmp_path / "a.zip").write_bytes(archive({**members, "readme.txt": "x"}))
    (tmp_path / "broken.zip").write_bytes(b"not a zip")
    (tmp_path / "empty.zip").write_bytes(b"")
    size = (tmp_path / "a.zip").stat().st_size
    found = archive_source.read_zip_members(spark, str(tmp_path), range_bytes=size // 5)
    rows = found.withColumn("task", F.spark_partition_id()).collect()
    good = [r for r in rows if r.error is None]
    assert {r.member: bytes(r.content) for r in good} == members and len(good) == 30
    assert len({r.task for r in good}) >= 4 and {r.dt.day for r in good} == set(range(1, 31))
    assert sorted((r.archive[-10:], r.error) for r in rows if r.error) == [
        ("/empty.zip", "not a ZIP archive"), ("broken.zip", "not a ZIP archive"),
    ]
    listed = spark.read.format("binaryFile").option("pathGlobFilter", "*.zip").load(str(tmp_path)).select("path", "length")
    again = archive_source.zip_members(listed, size // 5).collect()
    # Listings for Spark leave files without bytes out.
    rows = [r for r in rows if not r.archive.endswith("empty.zip")]
    assert sorted((r.member or "", r.error or "") for r in again) == sorted((r.member or "", r.error or "") for r in rows)


def test_a_damaged_member_is_one_error(spark, tmp_path):
    content = bytearray(archive({"20240401_a.csv": power_csv(range(200)), "20240402_a.csv": power_csv([1])}))
    content[80:120] = bytes(40)
    (tmp_path / "a.zip").write_bytes(content)
    rows = sorted(archive_source.read_zip_members(spark, str(tmp_path)).collect(), key=lambda r: r.member)
    assert rows[0].error.startswith("unreadable member") and rows[1].error is None


@pytest.mark.parametrize("content, error", [
    (b"", "unreadable file"), (b"a\n" * 54 + b'x,"y\n1,2\n', "unclosed quote"), (b"a\n" * 54 + b"x,y\n1,2,3\n", "unreadable file"),
])
def test_unreadable_power_files(spark, content, error):
    df = spark.createDataFrame([("s", dt.date(2024, 1, 1), bytearray(content))], "source string, dt date, content binary")
    assert [(r.value, r.error) for r in files.parse_power_csv(df).collect()] == [(None, error)]


def test_power_file_with_spaces_quotes_and_no_rows(spark):
    body = "\n".join([*PREAMBLE, "", f'DATE, "{POWER}" ,"a\nb"', '2024/4/1,  "12" , "x\n, y"', "", "2024/4/1", "2024/4/1, n/a,"])
    empty = "\n".join([*PREAMBLE, f"DATE,{POWER}", ""])
    df = spark.createDataFrame(
        [(n, dt.date(2024, 1, 1), bytearray(t.encode("shift_jis"))) for n, t in (("s", body.replace('" ,', '",')), ("e", empty))],
        "source string, dt date, content binary",
    )
    got = sorted((r.source, r.position, r.value, r.error) for r in files.parse_power_csv(df).collect())
    assert got == [("e", 0, None, None), ("s", 0, 12.0, None), ("s", 1, None, None), ("s", 2, None, None)]


def one(spark, text, fn):
    return spark.createDataFrame([(text,)], "t string").select(fn(F.col("t"))).first()[0]


def test_dates_and_numbers(spark):
    day = dt.date(2022, 4, 1)
    assert one(spark, "2022/4/1", dates.slash_date) == one(spark, "2022/04/01", dates.slash_date) == day
    assert one(spark, "2022/13/45", dates.coerce_slash_date) is None
    assert one(spark, "20220401", dates.compact_date) == one(spark, "2022-04-01", dates.iso_date) == day
    with pytest.raises(Exception):
        one(spark, "2022/13/45", dates.slash_date)
    assert one(spark, "2022-04-01T10:00:00", dates.coerce_date) == day
    assert one(spark, "20220401_power_usage.csv", dates.date_from_filename) == day
    assert one(spark, "readme.txt", dates.date_from_filename) is None
    for text, value in (("1e3", 1000.0), (" 7 ", 7.0), (".5", 0.5), ("5.", 5.0), ("7d", None), ("1_0", None), ("", None)):
        assert one(spark, text, dates.coerce_number) == value
