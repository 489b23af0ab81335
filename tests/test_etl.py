import datetime as dt
from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F

from loadcast.operators import incremental as inc
from loadcast.operators.control import Conflict, ControlLog, Watermark
from loadcast.operators.merge import daily_peak, merge_daily
from loadcast.operators.ranking import exact_quantiles, first_per_key, latest_per_key, running_total
from loadcast.operators.registry import latest_approved
from loadcast.operators.versions import append_versions, latest_features, stamp_versions
from loadcast.plans.daily import run_daily_merge
from loadcast.schemas import MERGED, READINGS, WATERMARK, WEATHER_DAILY
from loadcast.session import lookup
from loadcast.sources.landing import landed_days, landed_names, read_landed_days
from loadcast.sources.tables import land_if_absent, read_merged, write_by_day, write_days

D = dt.date


def at(day, hour=12):
    return dt.datetime(2024, 12, day, hour)


def test_daily_peak_truncates(spark):
    df = spark.createDataFrame([(at(1), 4000.2), (at(1, 13), 4321.9), (at(2), None), (at(3), float("nan"))], READINGS)
    assert [tuple(r) for r in daily_peak(df).collect()] == [(D(2024, 12, 1), 4321)]
    assert daily_peak(df, truncate=False).first().max_power == 4321.9
    with pytest.raises(Exception, match="no reading on"):
        daily_peak(df, strict=True).collect()


def test_daily_peak_by_area(spark):
    df = spark.createDataFrame([("a", at(1), 1.0), ("b", at(1), 2.0)], "area string, ts timestamp, value double")
    peaks = daily_peak(df, keys=["area"])
    other = peaks.withColumn("max_temp", F.lit(1.0)).drop("max_power")
    assert sorted(r.max_power for r in merge_daily(other, peaks, ["area", "date"]).collect()) == [1, 2]


def test_unprocessed_dates(spark):
    power = spark.createDataFrame([(D(2024, 12, d),) for d in (18, 19, 20, 21, 22)], "date date")
    weather = spark.createDataFrame([(D(2024, 12, d),) for d in (19, 20, 21)], "date date")
    got = inc.unprocessed_dates(power, weather, D(2024, 12, 20)).collect()
    assert [r.date for r in got] == [D(2024, 12, 21)]
    done = spark.createDataFrame([(D(2024, 12, 20),)], "date date")
    again = inc.unprocessed_dates(power, weather, D(2024, 12, 20), done=done).collect()
    assert [r.date for r in again] == [D(2024, 12, 19), D(2024, 12, 21)]
    assert not inc.needs_run(inc.unprocessed_dates(power, weather, D(2024, 12, 31)))


def test_dates_in_keys(spark):
    keys = spark.createDataFrame([("raw/2024-12/2024-12-20/x.csv",), ("raw/2024-12/2024-12-20/y.csv",), ("raw/x",)], "key string")
    assert [r.dt for r in inc.dates_in_keys(keys).collect()] == ["2024-12-20"]


def test_watermark(spark):
    control = spark.createDataFrame([("a", D(2024, 12, 20), at(20)), ("b", None, None)], WATERMARK)
    assert inc.read_watermark(control, "a") == D(2024, 12, 20)
    assert inc.read_watermark(control, "missing") == D(2022, 1, 1)
    updates = spark.createDataFrame(
        [("a", D(2024, 12, 19)), ("b", D(2024, 12, 1)), ("c", D(2024, 12, 2))], "job_name string, last_processed date"
    )
    state = {r.job_name: r for r in inc.advance_watermark(control, updates, at(25)).collect()}
    assert state["a"].last_processed == D(2024, 12, 20) and state["a"].updated_at == at(20)
    assert state["b"].last_processed == D(2024, 12, 1) and state["b"].updated_at == at(25)
    assert state["c"].last_processed == D(2024, 12, 2)
    with pytest.raises(Exception, match="watermark not advanced: a"):
        inc.advance_watermark(control, updates, at(25), strict=True).collect()


def test_date_list_codec():
    days = [D(2024, 1, 1), D(2024, 1, 2)]
    assert inc.encode_dates(days) == "2024-01-01,2024-01-02"
    assert inc.decode_dates("2024-01-01, 2024-01-02") == days
    assert inc.decode_dates("") == []


def day(d, power=1, weather="晴"):
    return (d, 20.0, 10.0, weather, power)


def test_dynamic_overwrite_keeps_other_days(spark, tmp_path):
    path = str(tmp_path / "merged")
    write_days(spark.createDataFrame([day(D(2024, 1, 1)), day(D(2024, 1, 2))], MERGED), path)
    write_days(spark.createDataFrame([day(D(2024, 1, 2), 9)], MERGED), path)
    write_days(spark.createDataFrame([day(D(2024, 1, 2), 9)], MERGED), path)
    rows = {r.date: r.max_power for r in read_merged(spark, path, MERGED).collect()}
    assert rows == {D(2024, 1, 1): 1, D(2024, 1, 2): 9}
    assert read_merged(spark, path, MERGED, start=D(2024, 1, 2)).count() == 1
    plan = read_merged(spark, path, MERGED, start=D(2024, 1, 2))._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(dt" in plan


def test_read_merged_refuses_an_empty_folder(spark, tmp_path):
    with pytest.raises(ValueError):
        read_merged(spark, str(tmp_path), MERGED)


def test_large_days_are_cut(spark, tmp_path, monkeypatch):
    monkeypatch.setattr("loadcast.sources.tables.ROWS_PER_FILE", 100)
    path = tmp_path / "by-day"
    days = spark.range(1000).select(F.date_add(F.lit(D(2024, 1, 1)), (F.col("id") % 10 == 0).cast("int")).alias("date"), "id")
    write_by_day(days, str(path))
    files = [f for f in (path / "dt=2024-01-01").iterdir() if f.suffix == ".parquet"]
    assert len(files) > 1
    assert spark.read.parquet(str(path)).select("id").distinct().count() == 1000


def test_land_if_absent(spark):
    new = spark.createDataFrame([("2024-01-01", 1), ("2024-01-02", 2)], "dt string, x int")
    landed = spark.createDataFrame([("2024-01-01",)], "dt string")
    assert [r.x for r in land_if_absent(new, landed).collect()] == [2]


def test_latest_features(spark, tmp_path):
    path = str(tmp_path / "versions")
    for power, moment in ((1, at(1)), (2, at(3)), (3, at(2))):
        batch = spark.createDataFrame([day(D(2024, 1, d), power) for d in (1, 2, 3)], MERGED)
        append_versions(stamp_versions(batch, moment.replace(tzinfo=dt.timezone.utc)), path)
    history = spark.read.parquet(path)
    for fast in (True, False):
        rows = latest_features(history, D(2024, 1, 1), D(2024, 1, 2), key_is_date=fast).collect()
        assert sorted((r.date, r.max_power) for r in rows) == [(D(2024, 1, 1), 2), (D(2024, 1, 2), 2)]
        assert {r.event_time for r in rows} == {"2024-12-03T12:00:00Z"}
    assert set(rows[0].asDict()) == {*MERGED.fieldNames(), "record_id", "event_time"}


def test_latest_features_filters_after_the_choice(spark):
    moved = spark.createDataFrame(
        [("k", "2024-01-01T00:00:00Z", D(2024, 1, 1)), ("k", "2024-01-02T00:00:00Z", D(2025, 1, 1))],
        "record_id string, event_time string, date date",
    )
    assert latest_features(moved, D(2024, 1, 1), D(2024, 12, 31)).isEmpty()


def test_version_ties_are_deterministic(spark):
    rows = [("k", "v1", D(2024, 1, 1), x) for x in (3, 1, 2)]
    df = spark.createDataFrame(rows, "record_id string, event_time string, date date, x int").repartition(3)
    assert [r.x for r in latest_features(df).collect()] == [3]


def test_first_per_key(spark):
    df = spark.createDataFrame([("a", None, 1), ("a", 5, 2), ("a", 7, 3), (None, 1, 4), (None, 1, 5)], "k string, v int, x int")
    up = {r.k: (r.v, r.x) for r in first_per_key(df.filter("v is not null"), ["k"], ["v"]).collect()}
    down = {r.k: (r.v, r.x) for r in first_per_key(df, ["k"], ["v"], descending=True).collect()}
    assert up == {"a": (5, 2), None: (1, 4)}
    assert down == {"a": (7, 3), None: (1, 5)}


@pytest.mark.parametrize("limit", [200_000, 2])
def test_latest_per_key_equals_first_per_key(spark, monkeypatch, limit):
    """Nulls, ties to the last column, a hot key, a missing key, and more keys than a lookup takes."""
    monkeypatch.setattr("loadcast.operators.ranking.BROADCAST_ROWS", limit)
    rows = [("hot", i % 7, str(i % 5), i % 3) for i in range(300)] + [("a", None, "x", 1), ("a", None, None, 2)]
    rows += [("b", None, "x", 1), ("b", 3, None, None), ("b", 3, None, 4), (None, 5, "y", 1), (None, 5, "z", 0), ("c", 1, "1", 1)]
    df = spark.createDataFrame(rows, "k string, v int, w string, x int").repartition(5)
    for order in (["v"], ["v", "w"], ["w", "v"]):
        wanted = first_per_key(df, ["k"], order, descending=True).collect()
        got = latest_per_key(df, ["k"], order).collect()
        assert sorted(map(str, got)) == sorted(map(str, wanted)) and len(got) == 5
    assert latest_per_key(df.limit(0), ["k"], ["v"]).isEmpty()


def test_latest_rows_are_found_without_sorting(spark, sf_dir):
    from loadcast.plans import catalog

    for query in (catalog.latest_features, catalog.latest_approved):
        assert "SortAggregate" not in query(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()


def test_running_total_under_skew(spark):
    """One group holds most rows and a third of them are equal."""
    df = spark.range(3000).select(
        F.when(F.col("id") % 10 == 0, "small").otherwise("hot").alias("g"),
        F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("v"),
    )
    rows = running_total(df, ["g"], ["v"]).collect()
    for group in ("small", "hot"):
        mine = sorted((r.before, r.v) for r in rows if r.g == group)
        assert [b for b, _ in mine] == list(range(len(mine)))
        assert [v for _, v in mine] == sorted(v for _, v in mine)


def test_exact_quantiles(spark):
    import numpy as np

    values = [float((i * i) % 97) for i in range(500)]
    df = spark.createDataFrame([("a", v) for v in values] + [("b", 1.0)], "g string, v double")
    got = {(r.g, r.point): r["quantile"] for r in exact_quantiles(df, ["g"], "v", (0.1, 0.25, 0.75, 1.0)).collect()}
    for point in (0.1, 0.25, 0.75, 1.0):
        assert got["a", point] == pytest.approx(np.quantile(values, point))
        assert got["b", point] == 1.0


def test_latest_approved(spark):
    events = spark.createDataFrame(
        [("m", 1, "Approved", at(1)), ("m", 2, "Approved", at(2)), ("m", 3, "Rejected", at(3)), ("n", 1, "Rejected", at(1))],
        "model_group string, version int, status string, created timestamp",
    )
    assert [(r.model_group, r.version) for r in latest_approved(events).collect()] == [("m", 2)]


def test_daily_job_moves_the_watermark_once(spark, tmp_path):
    merged, control = str(tmp_path / "merged"), str(tmp_path / "control")
    log = ControlLog(spark, control)
    log.advance(log.read("etl_data"), D(2024, 12, 1), at(1))
    readings = spark.createDataFrame([(at(d, h), 1000.0 * d + h) for d in (1, 2, 3, 4) for h in (1, 2)], READINGS)
    weather = spark.createDataFrame([(D(2024, 12, d), 10.0, 5.0, "晴") for d in (1, 2, 3)], WEATHER_DAILY)
    assert run_daily_merge(spark, readings, weather, merged, control, at(5)) == D(2024, 12, 3)
    rows = sorted((r.date, r.max_power) for r in read_merged(spark, merged, MERGED).collect())
    assert rows == [(D(2024, 12, 2), 2002), (D(2024, 12, 3), 3002)]
    assert run_daily_merge(spark, readings, weather, merged, control, at(6)) is None
    assert [tuple(r) for r in log.table().collect()] == [("etl_data", D(2024, 12, 3), at(5))]


def test_of_two_writers_one_is_refused(spark, tmp_path):
    for path in (str(tmp_path / "a"), f"file://{tmp_path}/b"):
        log = ControlLog(spark, path)
        assert log.read("job") == Watermark("job", D(2022, 1, 1), 0)
        mine, other = log.read("job"), ControlLog(spark, path).read("job")
        assert log.advance(mine, D(2024, 1, 5), at(1)) == Watermark("job", D(2024, 1, 5), 1)
        with pytest.raises(Conflict, match="another writer"):
            log.advance(other, D(2024, 1, 9), at(2))
        seen = log.read("job")
        assert seen == Watermark("job", D(2024, 1, 5), 1)
        with pytest.raises(Conflict, match="not advanced"):
            log.advance(seen, D(2024, 1, 5), at(3))
        log.advance(seen, D(2024, 1, 6), at(4))
        log.advance(log.read("a/b c"), D(2024, 1, 1), at(5))
        table = {r.job_name: r.last_processed for r in log.table().collect()}
        assert table == {"job": D(2024, 1, 6), "a/b c": D(2024, 1, 1)}
        left = [p for p in tmp_path.rglob("*") if p.name.startswith(".") and not p.name.endswith(".crc")]
        assert left == []


def test_many_writers_at_once(spark, tmp_path):
    """Of eight writers that hold the same version exactly one gets through."""
    log = ControlLog(spark, str(tmp_path))
    seen = log.read("job")

    def write(n):
        try:
            log.advance(seen, D(2024, 1, 1 + n), at(1))
            return n
        except Conflict:
            return None

    with ThreadPoolExecutor(8) as pool:
        won = [n for n in pool.map(write, range(8)) if n is not None]
    assert len(won) == 1 and log.read("job") == Watermark("job", D(2024, 1, 1 + won[0]), 1)


def test_an_overtaken_daily_job_is_refused(spark, tmp_path, monkeypatch):
    control = str(tmp_path / "control")
    readings = spark.createDataFrame([(at(2), 1.0)], READINGS)
    weather = spark.createDataFrame([(D(2024, 12, 2), 10.0, 5.0, "晴")], WEATHER_DAILY)
    log = ControlLog(spark, control)

    def overtaken(*args):
        log.advance(log.read("etl_data"), D(2024, 12, 9), at(9))
        return write_days(*args)

    monkeypatch.setattr("loadcast.plans.daily.write_days", overtaken)
    with pytest.raises(Conflict):
        run_daily_merge(spark, readings, weather, str(tmp_path / "merged"), control, at(5))
    assert log.read("etl_data").day == D(2024, 12, 9)


def test_only_wanted_days_are_scanned(spark, tmp_path):
    path = str(tmp_path / "weather")
    rows = [(D(2024, 12, d), float(d), 1.0, "晴") for d in range(1, 21)]
    write_by_day(spark.createDataFrame(rows, WEATHER_DAILY), path)
    found = landed_days(spark, path)
    assert {r.date for r in found.collect()} == {r[0] for r in rows}
    names = landed_names(spark, path)._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<path" in names or "content" not in names
    days = lookup(inc.unprocessed_dates(found, found, D(2024, 12, 17))).filter(F.col("date") > F.lit(D(2024, 12, 17)))
    read = read_landed_days(spark, path, WEATHER_DAILY, days)
    assert "dynamicpruning" in read._jdf.queryExecution().executedPlan().toString()
    assert sorted(r.max_temp for r in read.collect()) == [18.0, 19.0, 20.0]
