import datetime as dt

import pytest
from test_files import archive, power_csv

from loadcast.operators.control import ControlLog
from loadcast.operators.features import make_features
from loadcast.operators.merge import daily_peak
from loadcast.operators.versions import latest_features
from loadcast.plans import inputs
from loadcast.schemas import MERGED, READINGS
from loadcast.streaming import jobs, late

MOMENT = dt.datetime(2024, 12, 31, 3, 0)


def test_archives_are_landed_once(spark, tmp_path):
    source, table, checkpoint = tmp_path / "in", str(tmp_path / "table"), str(tmp_path / "cp")
    source.mkdir()
    (source / "a.zip").write_bytes(archive({f"2024040{d}_power_usage.csv": power_csv([d]) for d in (1, 2)}))

    def run():
        writer = jobs.landing_batch_writer(table, str(tmp_path / "ledger"))
        jobs.run_available(jobs.stream_archives(spark, str(source)), checkpoint, each_batch=writer)
        return sorted((r.dt, r.source[-5:]) for r in spark.read.parquet(table).select("dt", "source").collect())

    first = [(dt.date(2024, 4, 1), "a.zip"), (dt.date(2024, 4, 2), "a.zip")]
    assert run() == first
    assert run() == first
    (source / "b.zip").write_bytes(archive({f"2024040{d}_power_usage.csv": power_csv([d]) for d in (2, 3)}))
    (source / "c.zip").write_bytes(b"not a zip")
    assert run() == [*first, (dt.date(2024, 4, 3), "b.zip")]
    ledger = spark.read.parquet(str(tmp_path / "ledger")).select("dt", "batch_id").collect()
    assert sorted(map(tuple, ledger)) == [(dt.date(2024, 4, 1), 0), (dt.date(2024, 4, 2), 0), (dt.date(2024, 4, 3), 1)]


def test_landing_survives_replays_and_damaged_members(spark, tmp_path):
    damaged = bytearray(archive({"20240401_power_usage.csv": power_csv(range(200))}))
    damaged[80:120] = bytes(40)
    (tmp_path / "a.zip").write_bytes(damaged)
    (tmp_path / "b.zip").write_bytes(archive({"x/20240401_power_usage.csv": power_csv([1]), "20240402_a.csv": b"", "y.csv": b""}))
    names = [(str(tmp_path / n), 1) for n in ("a.zip", "b.zip")]
    batch = spark.createDataFrame(names, "path string, length long")
    writer = jobs.landing_batch_writer(str(tmp_path / "table"), str(tmp_path / "ledger"))
    writer(batch, 0)
    writer(batch, 0)
    writer(batch, 1)
    rows = sorted((r.dt, r.source[-5:], r.member, r.batch_id) for r in spark.read.parquet(str(tmp_path / "table")).collect())
    assert rows == [
        (dt.date(2024, 4, 1), "b.zip", "x/20240401_power_usage.csv", 0), (dt.date(2024, 4, 2), "b.zip", "20240402_a.csv", 0),
    ]
    with pytest.raises(Exception, match="unreadable member"):
        jobs.landing_batch_writer(str(tmp_path / "t2"), str(tmp_path / "l2"), strict=True)(batch, 0)


def test_late_readings_correct_peaks_or_are_refused(spark, tmp_path):
    def day(d, h, value, area="x"):
        return (dt.datetime(2024, 1, d, h), value, area)

    arrivals = [
        [day(1, 1, 10.5), day(1, 5, 12.9), day(2, 1, 7.0), day(1, 2, 3.0, "y")],
        # The second day is over, the first one was.
        [day(3, 2, 5.0), day(2, 9, 9.5), day(1, 7, 11.0), day(1, 3, None), day(1, 3, float("nan"))],
        [day(1, 9, 20.2), day(2, 3, 9.8), day(2, 3, 30.0), day(1, 1, 50.0, "y")],
        # Two days of grace: those of the first day are over, those of the second last another hour.
        [day(4, 23, 1.0)],
        [day(1, 9, 99.0), day(1, 10, 98.0), day(2, 5, 31.0), day(4, 5, 8.0, "y")],
        [day(9, 1, 1.0)],
    ]
    schema = "ts timestamp, value double, area string"
    with late.late_state(spark):
        for n, rows in enumerate(arrivals):
            spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
            arriving = jobs.stream_parquet(spark, str(tmp_path / "in"), spark.createDataFrame([], schema).schema)
            changes = late.corrected_peak_stream(arriving, dt.timedelta(days=2), ["area"])
            jobs.run_available(changes, str(tmp_path / "cp"), str(tmp_path / "out"))
    got = sorted((r.area, r.date.day, r.kind, r.max_power, r.readings) for r in spark.read.parquet(str(tmp_path / "out")).collect())
    assert got == [
        ("x", 1, "closed", 12, None), ("x", 1, "corrected", 20, 1), ("x", 1, "refused", 99, 2),
        ("x", 2, "closed", 9, None), ("x", 2, "corrected", 30, 2), ("x", 2, "corrected", 31, 1),
        ("x", 3, "closed", 5, None), ("x", 4, "closed", 1, None),
        ("y", 1, "closed", 3, None), ("y", 1, "corrected", 50, 1), ("y", 4, "closed", 8, None),
    ]


def test_the_late_limit_is_read_from_the_control_log(spark, tmp_path):
    log = ControlLog(spark, str(tmp_path / "control"))
    log.advance(log.read("features"), dt.date(2024, 1, 1), MOMENT)
    writer = jobs.feature_batch_writer(str(tmp_path / "out"), MOMENT, after=lambda: log.read("features").day)
    rows = [(dt.date(2024, 1, d), 1.0, 1.0, "晴", d) for d in (1, 2, 3)]
    writer(spark.createDataFrame(rows, MERGED), 0)
    log.advance(log.read("features"), dt.date(2024, 1, 2), MOMENT)
    writer(spark.createDataFrame([(*r[:4], 10 * r[4]) for r in rows], MERGED), 1)
    found = spark.read.parquet(str(tmp_path / "out"))
    latest = latest_features(found, version=("event_time", "batch_id"))
    assert sorted((r.date.day, r.max_power, r.batch_id) for r in latest.collect()) == [(2, 2, 0), (3, 30, 1)]
    assert {r.event_time for r in found.collect()} == {"2024-12-31T03:00:00Z"}


def test_peaks_of_closed_days(spark, tmp_path):
    rows = [(dt.datetime(2024, 1, d, h), 100.0 * d + h + 0.7) for d in (1, 2, 3) for h in (0, 5, 23)]
    readings = spark.createDataFrame(rows, READINGS)
    readings.write.parquet(str(tmp_path / "in"))
    stream = jobs.daily_peak_stream(jobs.stream_parquet(spark, str(tmp_path / "in"), READINGS), "0 seconds")
    jobs.run_available(stream, str(tmp_path / "cp"), str(tmp_path / "out"))
    got = sorted(map(tuple, spark.read.parquet(str(tmp_path / "out")).collect()))
    assert got == sorted(map(tuple, daily_peak(readings).filter("date < '2024-01-03'").collect()))


def test_peaks_follow_the_session_zone(spark, tmp_path):
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    try:
        rows = [(f"2024-01-0{d} {h:02d}:00:00", 100.0 * d + h) for d in (1, 2, 3) for h in (0, 5, 23)]
        texts = spark.createDataFrame(rows, "t string, value double")
        for kind in ("timestamp", "timestamp_ntz"):
            readings = texts.selectExpr(f"cast(t as {kind}) as ts", "value")
            home = str(tmp_path / kind)
            readings.write.parquet(f"{home}/in")
            stream = jobs.daily_peak_stream(jobs.stream_parquet(spark, f"{home}/in", readings.schema), "0 seconds")
            jobs.run_available(stream, f"{home}/cp", f"{home}/out")
            got = sorted(map(tuple, spark.read.parquet(f"{home}/out").collect()))
            assert got == [(dt.date(2024, 1, 1), 123), (dt.date(2024, 1, 2), 223)]
            assert got == sorted(map(tuple, daily_peak(readings).collect()))[:2]
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_streamed_features_equal_batch_and_skip_late_days(spark, sf_dir, tmp_path):
    merged = inputs.merged(spark, sf_dir)
    merged.repartition(3).write.parquet(str(tmp_path / "in"))
    late = dt.date(1996, 1, 1)
    writer = jobs.feature_batch_writer(str(tmp_path / "out"), MOMENT, after=late)
    jobs.run_available(jobs.stream_parquet(spark, str(tmp_path / "in"), MERGED, files_per_batch=1), str(tmp_path / "cp"), each_batch=writer)
    columns = [c for c in make_features(merged).columns]
    got = spark.read.parquet(str(tmp_path / "out"))
    assert got.select("batch_id").distinct().count() == 3
    wanted = make_features(merged).filter(f"date > '{late}'")
    assert sorted(map(str, got.select(*columns).collect())) == sorted(map(str, wanted.select(*columns).collect()))


def test_replayed_feature_batch_overwrites_itself(spark, tmp_path):
    batch = spark.createDataFrame([(dt.date(2024, 1, 1), 1.0, 1.0, "晴", 5)], MERGED)
    writer = jobs.feature_batch_writer(str(tmp_path / "out"), MOMENT)
    writer(batch, 0)
    writer(batch, 0)
    assert spark.read.parquet(str(tmp_path / "out")).count() == 1
