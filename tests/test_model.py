import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from loadcast.config import BoostingParams, Config
from loadcast.operators import model as model_ops
from loadcast.operators import registry
from loadcast.operators.encoders import apply_encoders
from loadcast.operators.metrics import regression_metrics
from loadcast.plans import catalog, inputs
from loadcast.plans.daily import MODEL_GROUP, run_model_build, run_scoring
from loadcast.schemas import FEATURES, MERGED
from loadcast.sources.tables import store, write_days
from loadcast.streaming import jobs


@pytest.fixture(scope="module")
def merged(spark, sf_dir):
    return store(inputs.merged(spark, sf_dir), "merged")


@pytest.fixture(scope="module")
def planted(spark, merged):
    """A target with a known signal."""
    high, low = F.col("max_temp"), F.col("min_temp")
    mean = (high + low) / 2
    signal = 3000 + 40 * F.greatest(mean - 18, F.lit(0.0)) + 25 * F.greatest(18 - mean, F.lit(0.0))
    weekend = F.when(F.weekday("date") >= 5, 200).otherwise(0)
    return store(merged.withColumn("max_power", F.floor(signal - weekend).cast("long")), "planted")


@pytest.fixture(scope="module")
def run(spark, planted, tmp_path_factory):
    home = tmp_path_factory.mktemp("build")
    write_days(planted, str(home / "merged"))
    cfg = Config(
        split_date=dt.date(2000, 10, 1), start_date=dt.date(1995, 1, 1), end_date=dt.date(2001, 6, 30),
        boosting=BoostingParams(trees=10), mse_threshold=999999.0,
    )
    return home, run_model_build(spark, str(home / "merged"), str(home / "out"), cfg, dt.datetime(2024, 12, 31))


def test_model_beats_the_mean_by_far(run):
    _, built = run
    assert built.metrics.first().r2 > 0.8
    assert built.registered.first().status == "PendingManualApproval"
    assert json.loads(built.report.first().report)["regression_metrics"]["mse"]["value"] == built.metrics.first().mse


def test_range_limits_training_data(spark, run):
    home, built = run
    versions = spark.read.parquet(str(home / "out" / "versions"))
    assert versions.filter("date > '2001-06-30'").count() > 0
    wanted = versions.filter("date between '2000-10-01' and '2001-06-30'").count()
    assert built.metrics.first().n == wanted


def test_importance_names_the_signal(run):
    _, built = run
    rows = built.importance.collect()
    assert len(rows) == 20
    assert {"avg", "cdd", "hdd", "weekend", "dow", "dow_sin", "dow_cos", "max_temp", "min_temp"} & {r.feature for r in rows[:3]}
    assert [r.importance for r in rows] == sorted((r.importance for r in rows), reverse=True)


def test_saved_bundle_scores_the_same(spark, run, planted):
    home, built = run
    loaded = model_ops.load_bundle(spark, str(home / "out" / "bundle"))
    assert loaded.feature_names == built.bundle.feature_names
    assert loaded.cfg == built.bundle.cfg
    requests = planted.drop("max_power")
    first = {r.date: r.prediction for r in model_ops.score(requests, built.bundle).collect()}
    second = {r.date: r.prediction for r in model_ops.score(requests, loaded).collect()}
    assert first == second


def test_report_and_registry_are_written(spark, run):
    home, built = run
    mse = built.metrics.first().mse
    report = json.loads(spark.read.text(str(home / "out" / "evaluation")).first().value)
    assert report == {"regression_metrics": {"mse": {"value": mse}}}
    assert json.loads(built.report.first().report) == report
    events = registry.read_events(spark, str(home / "out" / "registry"))
    passed = mse <= built.bundle.cfg.mse_threshold
    assert [(r.version, r.status, r.mse) for r in events.collect()] == [(1, "PendingManualApproval", mse)] * passed
    assert registry.next_version(spark, str(home / "out" / "registry"), MODEL_GROUP) == 1 + passed


def test_registered_queries_train_all_trees(spark, sf_dir):
    assert catalog._bundle(spark, sf_dir).model.stages[-1].getNumTrees == BoostingParams().trees == 100


def test_same_seed_same_model(spark, run, planted):
    _, built = run
    names = [c for c in FEATURES.fieldNames() if c not in ("date", "weather_category", "max_power")]
    from loadcast.operators.features import make_features

    table = store(make_features(planted), "features")
    params = BoostingParams(trees=3)
    guesses = [
        sorted(r.prediction for r in model_ops.predict(model_ops.fit_gbt(table, names, params), table, names).collect())
        for _ in range(2)
    ]
    assert guesses[0] == guesses[1]


def test_scoring_with_the_columns_at_hand(spark, run, planted):
    from loadcast.operators.features import make_features

    _, built = run
    table = store(apply_encoders(make_features(planted), built.bundle.encoders), "encoded")
    names = built.bundle.feature_names
    holes = table.withColumn("avg", F.lit(None).cast("double"))
    fewer = table.drop("avg").withColumn("more", F.lit(1))
    wanted = {r.date: r.prediction for r in model_ops.predict(built.bundle.model, holes, names).collect()}
    found = model_ops.predict(built.bundle.model, fewer, names)
    assert found.columns == [*fewer.columns, "prediction"]
    assert {r.date: r.prediction for r in found.collect()} == wanted
    with pytest.raises(ValueError, match="at hand"):
        model_ops.predict(built.bundle.model, table.select("date"), names)


def test_missing_features_still_train(spark, planted):
    names = ["max_temp", "min_temp"]
    holes = planted.withColumn("max_temp", F.when(F.dayofmonth("date") % 5 > 0, F.col("max_temp")))
    fitted = model_ops.fit_gbt(holes, names, BoostingParams(trees=3))
    scored = model_ops.predict(fitted, holes, names)
    assert regression_metrics(scored, "max_power", "prediction").first().r2 > 0


def test_align_keeps_training_order(spark):
    df = spark.createDataFrame([(1, 2, 3)], "c int, a int, b int")
    assert tuple(model_ops.align(df, ["a", "x", "c"]).first()) == (2, None, 1)
    assert model_ops.align(df, ["a", "x"], keep=["c", "a"]).columns == ["c", "a", "x"]


def test_scoring_job(spark, run):
    _, built = run
    rows = [
        (1, "text/csv", None, "2023-11-08,17.5,6.25,曇り\n2023-11-09,17.5,6.25,"),
        (2, "application/json", "text/csv", '{"date": "2023-11-08", "max_temp": 17.5, "min_temp": 6.25, "weather": "曇り"}'),
        (3, "text/plain", None, "x"),
    ]
    requests = spark.createDataFrame(rows, "request_id int, content_type string, accept string, body string")
    responses, rejected = run_scoring(requests, built.bundle)
    got = {r.request_id: r for r in responses.collect()}
    both = json.loads(got[1].body)["predictions"]
    assert len(both) == 2 and got[2].body == f"{both[0]}\n"
    assert [tuple(r) for r in rejected.collect()] == [(3, "unsupported content type")]


def test_streamed_scores_equal_batch(spark, run, planted, tmp_path):
    _, built = run
    requests = planted.drop("max_power")
    requests.write.parquet(str(tmp_path / "in"))
    stream = jobs.stream_parquet(spark, str(tmp_path / "in"), requests.schema)
    jobs.run_available(jobs.score_stream(stream, built.bundle).select("date", "prediction"), str(tmp_path / "cp"), str(tmp_path / "out"))
    batch = model_ops.score(requests, built.bundle).select("date", "prediction")
    assert sorted(map(tuple, spark.read.parquet(str(tmp_path / "out")).collect())) == sorted(map(tuple, batch.collect()))


def test_merged_schema(merged):
    assert merged.columns == MERGED.fieldNames()
