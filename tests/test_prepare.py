import datetime as dt
import json
import math

import numpy as np
import pandas as pd
import pytest
from pyspark.ml.linalg import SparseVector
from pyspark.sql import functions as F

from loadcast.config import Config, EncoderSpec
from loadcast.operators import metrics, profile, ranking
from loadcast.operators.encoders import (
    OneHot, Ordinal, SparseOneHot, SparseOneHotModel, apply_encoders, encode, load_encoders, save_encoders,
)
from loadcast.operators.split import chrono_split, parts, target_first
from loadcast.sources.tables import read_matrix, read_matrix_names, write_matrix

D = dt.date


def days(spark, n, extra=()):
    rows = [(D(2024, 1, 1) + dt.timedelta(days=i), i) for i in range(n)] + list(extra)
    return spark.createDataFrame(rows, "date date, max_power long")


def categories(spark):
    rows = [(D(2024, 1, 3), "b"), (D(2024, 1, 1), "c"), (D(2024, 1, 2), "a"), (D(2024, 1, 2), "c")]
    return spark.createDataFrame(rows, "date date, w string")


def test_one_hot(spark):
    model = OneHot(("w",)).fit(categories(spark))
    out = model.transform(categories(spark).withColumn("z", F.lit(1)))
    assert out.columns == ["date", "w_a", "w_b", "w_c", "z"]
    assert all(r.w_a + r.w_b + r.w_c == 1 for r in out.collect())
    new = spark.createDataFrame([("x",), (None,)], "w string")
    assert [tuple(r) for r in model.transform(new).collect()] == [(0, 0, 0)] * 2


def test_one_hot_keeps_a_missing_value_seen_in_fitting(spark):
    df = spark.createDataFrame([("a(1)",), (None,)], "w string")
    out = OneHot(("w",)).fit(df).transform(df)
    assert out.columns == ["w_a(1)", "w_nan"]
    assert sorted(tuple(r) for r in out.collect()) == [(0, 1), (1, 0)]


def test_ordinal(spark):
    model = Ordinal(("w",)).fit(categories(spark))
    codes = {r["category"]: r["index"] for r in model.table.collect()}
    assert codes == {"c": 1, "a": 2, "b": 3}
    new = spark.createDataFrame([("b",), ("x",), (None,)], "w string")
    assert [r.w for r in model.transform(new).collect()] == [3, -1, -2]


def test_two_encoders_of_one_name_both_apply(spark, tmp_path):
    df = categories(spark).withColumn("v", F.upper("w")).withColumn("u", F.col("w"))
    cfg = Config(encoders=(EncoderSpec("One-Hot", ("w",)), EncoderSpec("One-Hot", ("v",)), EncoderSpec("Ordinal", ("u",))))
    out, models = encode(df, cfg)
    assert out.columns == ["date", "w_a", "w_b", "w_c", "v_A", "v_B", "v_C", "u"]
    path = str(tmp_path / "encoders")
    save_encoders(models, spark, path)
    again = apply_encoders(df, load_encoders(spark, path))
    assert again.columns == out.columns
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, out.collect()))
    assert apply_encoders(df.drop("v"), models).columns == ["date", "w_a", "w_b", "w_c", "u"]


def test_encoder_fitted_on_training_rows_only(spark):
    df = categories(spark)
    out, _ = encode(df, Config(encoders=(EncoderSpec("One-Hot", ("w",)),)), fit_on=df.filter("w <> 'b'"))
    assert out.columns == ["date", "w_a", "w_c"]


def test_split_by_date_wins(spark):
    train, test = parts(chrono_split(days(spark, 10, [(None, 99)]), date=D(2024, 1, 8), ratio=0.5))
    assert (train.count(), test.count()) == (7, 3)


@pytest.mark.parametrize("n,train", [(11, 8), (10, 8), (1, 0), (5, 4)])
def test_split_by_ratio(spark, n, train):
    labelled = chrono_split(days(spark, n), ratio=0.2).collect()
    assert sum(r.split == "train" for r in labelled) == train == int(n * (1 - 0.2))
    assert len(labelled) == n
    assert all(r.max_power < train for r in labelled if r.split == "train")


def test_split_through_a_hot_day(spark):
    """A day with half of all rows, most of them equal, is cut at the exact row."""
    hot = [(D(2024, 1, 5), 7)] * 40 + [(D(2024, 1, 5), i) for i in range(10)]
    df = days(spark, 50, hot)
    labelled = chrono_split(df, ratio=0.8).collect()
    assert sum(r.split == "train" for r in labelled) == int(100 * (1 - 0.8))
    assert len(labelled) == 100
    last = max(r.date for r in labelled if r.split == "train")
    assert last == min(r.date for r in labelled if r.split == "test") == D(2024, 1, 5)


def test_lookups_beyond_the_limit_give_the_same_answers(spark, monkeypatch):
    monkeypatch.setattr("loadcast.session.BROADCAST_ROWS", 0)
    hot = [(D(2024, 1, 5), 7)] * 40
    labelled = chrono_split(days(spark, 60, hot), ratio=0.8)
    assert labelled.filter("split = 'train'").count() == 19 and labelled.count() == 100
    assert "BroadcastHint" not in labelled._jdf.queryExecution().analyzed().toString()
    frame = sample()
    edges = np.histogram_bin_edges(frame["z"], "auto")
    wanted, _ = np.histogram(frame["z"], edges)
    rows = profile.histograms(spark.createDataFrame(frame), ["z"]).collect()
    assert {r.bin: r.n for r in rows} == dict(enumerate(wanted))


def test_split_by_area(spark):
    df = days(spark, 10).withColumn("area", F.lit("a")).unionByName(days(spark, 5).withColumn("area", F.lit("b")))
    labelled = chrono_split(df, ratio=0.2, keys=["area"])
    sizes = {(r.area, r.split): r.n for r in labelled.groupBy("area", "split").agg(F.count("*").alias("n")).collect()}
    assert sizes == {("a", "train"): 8, ("a", "test"): 2, ("b", "train"): 4, ("b", "test"): 1}


def test_matrix_keeps_the_order(spark, tmp_path):
    path = str(tmp_path / "matrix")
    days = spark.range(500).select(
        F.date_add(F.lit(dt.date(2024, 1, 1)), (F.col("id") * 37 % 400).cast("int")).alias("date"),
        (F.col("id") % 50).alias("y"), F.col("id").cast("double").alias("x"),
    ).repartition(5)
    write_matrix(days, path, "y", ["x"])
    schema = days.select("y", "x").schema
    found = read_matrix(spark, path, schema, position="at").orderBy("at").collect()
    wanted = sorted((r.date, r.y, r.x) for r in days.collect())
    assert [(r.at, r.y, r.x) for r in found] == [(i, y, x) for i, (_, y, x) in enumerate(wanted)]
    index = sorted(spark.read.parquet(f"{path}/order").collect(), key=lambda r: r.part)
    assert len(index) > 1 and sum(r.rows for r in index) == 500
    assert all(a.last <= b.first for a, b in zip(index, index[1:]))
    spark.createDataFrame([(1, 2.0)], "y long, x double").write.mode("append").csv(f"{path}/data/part=0")
    with pytest.raises(Exception, match="does not match its index"):
        read_matrix(spark, path, schema, position="at").collect()


def test_sparse_one_hot(spark):
    df = spark.createDataFrame([(1, "b"), (2, None), (3, "a"), (4, "b"), (5, "é")], "id int, c string")
    fitted = SparseOneHot(("c",)).fit(df)
    new = spark.createDataFrame([(1, "b"), (2, None), (3, "zz"), (4, "é")], "id int, c string")
    rows = {r.id: r.c for r in fitted.transform(new).collect()}
    assert {i: (v.size, v.indices.tolist()) for i, v in rows.items()} == {1: (4, [1]), 2: (4, [3]), 3: (4, []), 4: (4, [2])}
    assert fitted.transform(df).columns == ["id", "c"]
    assert SparseOneHot(("c",)).fit(df.limit(0)).transform(df.limit(0)).isEmpty()


def test_sparse_one_hot_keeps_no_name_per_place(spark):
    """The plan holds the vector's length, not an attribute for each of its places."""
    places = spark.range(3).selectExpr("'c' AS column", "CAST(id AS STRING) AS category", "id AS index")
    model = SparseOneHotModel(("c",), places, {"c": 2_000_000_000})
    df = spark.createDataFrame([("2", 1), ("x", 2), (None, 3)], "c string, k int")
    out = model.transform(df)
    assert out.schema["c"].metadata == {"ml_attr": {"num_attrs": 2_000_000_000}}
    found = {r.k: r.c for r in out.collect()}
    assert found[1] == SparseVector(2_000_000_000, [2], [1.0])
    assert found[2] == found[3] == SparseVector(2_000_000_000, [], [])


def test_too_many_categories_become_no_columns(spark, monkeypatch):
    monkeypatch.setattr("loadcast.operators.encoders.MOST_COLUMNS", 2)
    df = spark.createDataFrame([("a",), ("b",), (None,)], "c string")
    with pytest.raises(ValueError, match="SparseOneHot"):
        OneHot(("c",)).fit(df)


def test_matrix_round_trip(spark, tmp_path):
    path = str(tmp_path / "matrix")
    df = target_first(days(spark, 3).withColumn("a(1)", F.lit(0.1) * F.col("max_power")).drop("date"))
    write_matrix(df, path, "max_power", ["a(1)"])
    assert read_matrix_names(spark, path) == ["max_power", "a(1)"]
    assert sorted(map(tuple, read_matrix(spark, path, df.schema).collect())) == sorted(map(tuple, df.collect()))


def measured(spark, rows):
    return metrics.regression_metrics(spark.createDataFrame(rows, "y double, p double"), "y", "p").first()


def test_metrics(spark):
    row = measured(spark, [(1.0, 3.0), (2.0, 5.0), (3.0, 8.0), (None, 1.0)])
    assert row.n == 3
    assert row.r2 == pytest.approx(-18.0)
    assert row.mse == pytest.approx(38 / 3) and row.rmse == pytest.approx(math.sqrt(38 / 3))
    assert row.mae == pytest.approx(10 / 3)
    assert measured(spark, [(1.0, 2.0), (2.0, 2.0), (3.0, 2.0)]).r2 == pytest.approx(0)
    assert measured(spark, [(5.0, 5.0), (5.0, 5.0)]).r2 == 1.0
    assert measured(spark, [(5.0, 5.0), (5.0, 6.0)]).r2 == 0.0
    assert measured(spark, [(5.0, 5.0)]).r2 is None


def test_report_gate_and_csv(spark, tmp_path):
    table = metrics.regression_metrics(spark.createDataFrame([(1.0, 3.0), (2.0, 2.0)], "y double, p double"), "y", "p")
    report = json.loads(metrics.metrics_json(table).first().report)
    assert report == {"regression_metrics": {"mse": {"value": 2.0}}}
    assert metrics.quality_gate(table, 2.0).first().status == "PendingManualApproval"
    assert metrics.quality_gate(table, 1.9).isEmpty()
    metrics.write_metrics_csv(table, str(tmp_path / "m"))
    assert spark.read.csv(str(tmp_path / "m"), header=True).columns == ["n", "mse", "rmse", "mae", "r2"]


def test_prediction_extent(spark):
    df = spark.createDataFrame([(10.0, 20.0), (40.0, 30.0)], "y double, p double")
    assert tuple(metrics.prediction_extent(df, "y", "p").first()) == (9.5, 42.0)


def sample(n=300):
    rng = np.random.default_rng(3)
    x = rng.normal(1e6, 1.0, n)
    frame = pd.DataFrame({"x": x, "y": x * 2 + rng.normal(0, 1, n), "z": rng.uniform(0, 1, n), "c": 5.0})
    frame.loc[::7, "y"] = np.nan
    frame["area"] = np.where(np.arange(n) % 3, "a", "b")
    return frame


def test_correlation_is_pairwise_complete(spark):
    frame = sample()
    got = {(r.x, r.y): r.r for r in profile.correlation_pairs(spark.createDataFrame(frame).repartition(5)).collect()}
    wanted = frame.drop(columns="area").corr()
    assert set(got) == {("x", "y"), ("x", "z"), ("x", "c"), ("y", "z"), ("y", "c"), ("z", "c")}
    for (a, b), r in got.items():
        if "c" in (a, b):
            assert r is None
        else:
            assert r == pytest.approx(wanted.loc[a, b], abs=1e-9)


def test_correlation_by_area(spark, monkeypatch):
    monkeypatch.setattr(profile, "MAX_HELD_KEYS", 0)
    frame = sample()
    rows = profile.correlation_pairs(spark.createDataFrame(frame).repartition(3), ["x", "y"], ["area"]).collect()
    got = {r.area: r.r for r in rows}
    for area, part in frame.groupby("area"):
        assert got[area] == pytest.approx(part["x"].corr(part["y"]), abs=1e-9)


def test_histogram_matches_the_array_library(spark):
    frame = sample()
    df = spark.createDataFrame(frame)
    for column, bins in (("x", 7), ("z", None), ("x", None), ("c", None)):
        edges = np.histogram_bin_edges(frame[column], bins or "auto")
        wanted, _ = np.histogram(frame[column], edges)
        rows = profile.histograms(df, [column], bins).collect()
        assert {r.bin: r.n for r in rows} == dict(enumerate(wanted))
        for r in rows:
            assert (r.lower, r.upper) == pytest.approx((edges[r.bin], edges[r.bin + 1]))


def test_kde(spark):
    frame = sample()
    curve = profile.kde(spark.createDataFrame(frame), ["z", "c"], grid=50).orderBy("point").toPandas()
    assert set(curve["column"]) == {"z"}
    z = frame["z"].to_numpy()
    h = z.std(ddof=1) * len(z) ** -0.2
    grid = np.linspace(z.min(), z.max(), 50)
    wanted = np.exp(-0.5 * ((grid[:, None] - z) / h) ** 2).sum(axis=1) / (len(z) * h * math.sqrt(2 * math.pi))
    assert np.allclose(curve["x"], grid) and np.allclose(curve["density"], wanted)


def test_kde_by_area_with_far_values_and_small_parts(spark, monkeypatch):
    monkeypatch.setattr(profile, "HELD_CELLS", 50)
    monkeypatch.setattr(profile, "MAX_HELD_KEYS", 0)
    frame = sample()
    frame.loc[5, "x"] = 1e9
    frame["none"] = np.nan
    df = spark.createDataFrame(frame).repartition(3)
    curves = profile.kde(df, ["x", "y", "none"], grid=40, keys=["area"]).toPandas()
    assert len(curves) == 2 * 2 * 40
    for (area, column), curve in curves.groupby(["area", "column"]):
        x = frame.loc[frame["area"] == area, column].dropna().to_numpy()
        h = x.std(ddof=1) * len(x) ** -0.2
        grid = np.linspace(x.min(), x.max(), 40)
        wanted = np.exp(-0.5 * ((grid[:, None] - x) / h) ** 2).sum(axis=1) / (len(x) * h * math.sqrt(2 * math.pi))
        curve = curve.sort_values("point")
        assert np.allclose(curve["x"], grid) and np.allclose(curve["density"], wanted, rtol=1e-9, atol=1e-18)
    assert profile.kde(df.filter("z > 5"), ["x"]).isEmpty()


def test_kde_cells_are_as_exact_as_doubles():
    rng = np.random.default_rng(1)
    x = np.concatenate([rng.normal(size=5000), [300.0]])
    curve = profile._Curve(x.min(), x.max(), 0.2, 200)
    for part in np.array_split(x, 7):
        curve.add(part)
    curve.lay()
    wanted = np.exp(-0.5 * ((curve.spots[:, None] - x) / 0.2) ** 2).sum(axis=1)
    assert np.abs(curve.mass - wanted).max() < 1e-12 * wanted.max()


@pytest.mark.parametrize("far", [0, 1, 3])
def test_quantiles_with_far_values_rank_few_rows(spark, monkeypatch, far):
    monkeypatch.setattr(ranking, "RANKED_ROWS", 100)
    ranked = []
    plain = ranking.running_total

    def watched(df, *rest):
        ranked.append(df.count())
        return plain(df, *rest)

    monkeypatch.setattr(ranking, "running_total", watched)
    x = np.random.default_rng(2).uniform(0, 1, 20000)
    x[:far] = 10.0 ** (12 * np.arange(1, far + 1))
    df = spark.createDataFrame(pd.DataFrame({"g": "a", "x": x})).repartition(4)
    points = (0.0, 0.25, 0.5, 0.999, 1.0)
    got = {r.point: r.quantile for r in ranking.exact_quantiles(df, ["g"], "x", points).collect()}
    assert got == pytest.approx({p: np.quantile(x, p) for p in points}, rel=1e-12)
    assert ranked[0] <= 100
    same = spark.createDataFrame(pd.DataFrame({"g": "a", "x": [7.0] * 500 + [9.0]}))
    assert ranking.exact_quantiles(same, ["g"], "x", (0.5,)).first().quantile == 7.0
    assert ranking.exact_quantiles(same.filter("x < 0"), ["g"], "x", (0.5,)).isEmpty()


def test_constant_columns_have_no_correlation(spark):
    df = spark.range(5000, numPartitions=4).selectExpr("0.1D AS a", "1D / 3 AS b", "sin(id) AS c", "cos(id) AS d")
    rows = {(r.x, r.y): r.r for r in profile.correlation_pairs(df).collect()}
    assert [pair for pair, r in rows.items() if r is not None] == [("c", "d")]


def test_numeric_columns_count_small_integers(spark):
    df = spark.createDataFrame([(1, 1, 1.0, D(2024, 1, 1), "s")], "a int, b long, c double, d date, e string")
    assert profile.numeric_columns(df) == ["a", "b", "c"]


def test_table_profile_and_counts(spark):
    df = spark.createDataFrame([(1, None), (2, "x"), (3, "x"), (4, "y")], "a int, `b.c` string")
    rows = {r.column: (r.type, r.rows, r.non_null) for r in profile.table_profile(df).collect()}
    assert rows == {"a": ("int", 4, 4), "b.c": ("string", 4, 3)}
    assert [r.n for r in profile.category_counts(df.toDF("a", "b"), "b").collect()] == [2, 1, 1]
