"""Boosted-tree training, the saved model bundle, scoring and importances."""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loadcast.config import BoostingParams, Config, config_from_mapping, config_to_mapping
from loadcast.functions.weather import missing_if_nan
from loadcast.operators.encoders import Model, apply_encoders, load_encoders, save_encoders
from loadcast.operators.features import make_features
from loadcast.schemas import TARGET
from loadcast.session import scratch_root

# Trees here take no missing values, so a missing feature gets a value below all real ones and can be split off.
MISSING_FEATURE = -1e9
# Columns that identify a row rather than describe the day.
KEY_COLUMNS = ("date", "record_id", "event_time", "latest", "split", TARGET)


@dataclass(frozen=True)
class Bundle:
    """Everything scoring needs: the model, the feature order, the encoders and the configuration."""

    model: PipelineModel
    feature_names: list[str]
    encoders: list[Model]
    cfg: Config


def feature_names(df: DataFrame, drop: Sequence[str] = KEY_COLUMNS) -> list[str]:
    return [c for c in df.columns if c not in drop]


def align(df: DataFrame, names: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """The columns to keep, then the training columns in training order; one that is not at hand is missing.

    Columns that the model does not know are left out. None at hand is an error, as nothing could be told apart.
    """
    if names and not set(names) & set(df.columns):
        raise ValueError("none of the model's features is at hand")
    at_hand = set(df.columns)
    features = [F.col(f"`{n}`") if n in at_hand else F.lit(None).cast("double").alias(n) for n in names]
    return df.select(*[F.col(f"`{k}`") for k in keep], *[f for n, f in zip(names, features) if n not in keep])


def fit_gbt(
    df: DataFrame, features: Sequence[str], params: BoostingParams = BoostingParams(), target: str = TARGET
) -> PipelineModel:
    """Squared-error boosting; a depth of five allows about as many leaves as the usual leaf-wise default."""
    # A checkpoint folder lets boosting cut its growing lineage every few trees.
    scratch_root(df.sparkSession)
    assemble = VectorAssembler(inputCols=positions(len(features)), outputCol="features")
    named = [column.alias(name) for name, column in model_inputs(features).items()]
    trees = GBTRegressor(
        featuresCol="features",
        labelCol=target,
        predictionCol="prediction",
        maxIter=params.trees,
        stepSize=params.learning_rate,
        seed=params.seed,
        maxDepth=params.depth,
        lossType="squared",
    )
    return Pipeline(stages=[assemble, trees]).fit(df.select(target, *named))


def positions(n: int) -> list[str]:
    return [f"f{i}" for i in range(n)]


def model_inputs(features: Sequence[str]) -> dict[str, Column]:
    """The features under plain positional names: the assembler cannot read names with parentheses."""
    filled = [F.coalesce(missing_if_nan(F.col(f"`{c}`")), F.lit(MISSING_FEATURE)) for c in features]
    return dict(zip(positions(len(features)), filled))


def predict(model: PipelineModel, df: DataFrame, features: Sequence[str]) -> DataFrame:
    """`df` with a `prediction` column, from the features at hand: see `align`."""
    lacking = [c for c in features if c not in df.columns]
    named = model_inputs(features)
    scored = model.transform(align(df, features, keep=df.columns).withColumns(named))
    return scored.drop("features", *named, *lacking)


def score(df: DataFrame, bundle: Bundle, holidays: DataFrame | None = None) -> DataFrame:
    """Raw request rows to predictions: features, encoders, training order, model. Other columns stay."""
    featured = make_features(df, bundle.cfg, holidays, null_as_text=True)
    encoded = apply_encoders(featured, bundle.encoders)
    return predict(bundle.model, encoded, bundle.feature_names).select(*[c for c in df.columns if c != "weather"], "prediction")


def save_bundle(bundle: Bundle, spark: SparkSession, path: str) -> None:
    """The model, the feature order, the encoders and the whole configuration."""
    bundle.model.write().overwrite().save(f"{path}/model")
    names = [(i, n) for i, n in enumerate(bundle.feature_names)]
    spark.createDataFrame(names, "position int, name string").write.mode("overwrite").parquet(f"{path}/features")
    settings = json.dumps(config_to_mapping(bundle.cfg), ensure_ascii=False)
    spark.createDataFrame([(settings,)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/config")
    save_encoders(bundle.encoders, spark, f"{path}/encoders")


def load_bundle(spark: SparkSession, path: str) -> Bundle:
    names = [r.name for r in sorted(spark.read.parquet(f"{path}/features").collect(), key=lambda r: r.position)]
    settings = json.loads(spark.read.text(f"{path}/config").first().value)
    return Bundle(
        PipelineModel.load(f"{path}/model"), names, load_encoders(spark, f"{path}/encoders"), config_from_mapping(settings)
    )


def feature_importance(model: PipelineModel, names: Sequence[str], spark: SparkSession, n: int = 20) -> DataFrame:
    """The `n` most important features with their normalised gain; equal ones by name."""
    gains = model.stages[-1].featureImportances.toArray()
    table = spark.createDataFrame([(f, float(g)) for f, g in zip(names, gains)], "feature string, importance double")
    return table.orderBy(F.desc("importance"), "feature").limit(n)
