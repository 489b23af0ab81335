"""One-hot and ordinal encoders whose fitted state is a small mapping table."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loadcast.config import Config, EncoderSpec
from loadcast.operators.ranking import running_total
from loadcast.session import lookup
from loadcast.sources.tables import store

MAPPING = "encoder string, step int, column string, category string, index long"
UNSEEN, MISSING = -1, -2
# Categories that become columns of their own.
MOST_COLUMNS = 2000
VECTOR = T.StructType([T.StructField("vector", VectorUDT())])


def sparse_one(place: Column, size: int) -> Column:
    """A sparse vector of `size` places with a 1 at `place`, or without any if that is beyond them."""
    inside = place < size
    vector = F.struct(
        F.lit(0).alias("type"), F.lit(size).alias("size"),
        F.when(inside, F.array(place)).otherwise(F.array()).alias("indices"),
        F.when(inside, F.array(F.lit(1.0))).otherwise(F.array()).alias("values"),
    )
    # No cast leads from a struct to a vector; reading JSON by a schema does.
    return F.from_json(F.to_json(F.struct(vector.alias("vector"))), VECTOR)["vector"]


@dataclass(frozen=True)
class OneHotModel:
    """`categories[column]` lists the fitted categories; null stands for a missing value seen in fitting."""

    columns: tuple[str, ...]
    categories: dict[str, list[str | None]]
    name: str = field(default="One-Hot", init=False)

    def output_columns(self, column: str) -> list[str]:
        return [f"{column}_{'nan' if c is None else c}" for c in self.categories[column]]

    def transform(self, df: DataFrame) -> DataFrame:
        """Each encoded column gives way to its 0/1 columns, in place; an unseen category is all zeros."""
        picked: list[Column] = []
        for name in df.columns:
            source = F.col(f"`{name}`")
            if name not in self.columns:
                picked.append(source)
                continue
            for category, alias in zip(self.categories[name], self.output_columns(name)):
                hit = source.isNull() if category is None else source == F.lit(category)
                picked.append(F.coalesce(hit.cast("int"), F.lit(0)).alias(alias))
        return df.select(*picked)

    def mapping(self, spark: SparkSession, step: int) -> DataFrame:
        rows = [
            (self.name, step, column, category, index)
            for column in self.columns
            for index, category in enumerate(self.categories[column])
        ]
        return spark.createDataFrame(rows, MAPPING)


@dataclass(frozen=True)
class OneHot:
    columns: tuple[str, ...]

    def fit(self, df: DataFrame) -> OneHotModel:
        """Distinct categories in code-point order, the missing one last. They become columns, so each is a name
        in the plan; of more than `MOST_COLUMNS` none is fetched, and `SparseOneHot` or `Ordinal` is to be used."""
        found: dict[str, list[str | None]] = {}
        for column in self.columns:
            distinct = df.select(F.col(column).cast("string").alias("category")).distinct()
            values = [r.category for r in distinct.limit(MOST_COLUMNS + 1).collect()]
            if len(values) > MOST_COLUMNS:
                raise ValueError(f"more than {MOST_COLUMNS} categories of {column}: use SparseOneHot or Ordinal")
            found[column] = sorted(v for v in values if v is not None) + [None] * (None in values)
        return OneHotModel(tuple(self.columns), found)


@dataclass(frozen=True)
class SparseOneHotModel:
    """`table(column, category, index)` holds the fitted places as a DataFrame of any size, `sizes` their numbers."""

    columns: tuple[str, ...]
    table: DataFrame
    sizes: dict[str, int]

    def transform(self, df: DataFrame) -> DataFrame:
        """Each encoded column gives way to a sparse vector with a 1 at the place of its category; an unseen category
        has no 1. Places are joined to the rows. The vector's length is its only metadata: MLlib's own encoder names
        every place there, on the driver."""
        result = df
        for column in self.columns:
            size = self.sizes[column]
            codes = lookup(self.table.filter(F.col("column") == column).select(
                F.col("category").alias("_category"), F.col("index").alias("_index")
            ))
            joined = result.join(codes, result[column].cast("string").eqNullSafe(codes["_category"]), "left")
            place, width = F.coalesce(F.col("_index"), F.lit(size)), max(size, 1)
            vector = sparse_one(place, width).alias(column, metadata={"ml_attr": {"num_attrs": width}})
            result = joined.select(*[vector if c == column else F.col(f"`{c}`") for c in df.columns])
        return result


@dataclass(frozen=True)
class SparseOneHot:
    """One-hot encoding for columns of any number of categories, up to a key per row."""

    columns: tuple[str, ...]

    def fit(self, df: DataFrame) -> SparseOneHotModel:
        """Places from 0 in code-point order, the missing category last. Ranges of the categories are numbered side by
        side; only their number comes to the driver."""
        found = None
        for column in self.columns:
            values = df.select(F.lit(column).alias("column"), F.col(column).cast("string").alias("category")).distinct()
            found = values if found is None else found.unionByName(values)
        ranked = running_total(found, ["column"], ["category"])
        table = store(ranked.select("column", "category", F.col("before").alias("index")), "places")
        counts = {r["column"]: r["n"] for r in table.groupBy("column").agg(F.count("*").alias("n")).collect()}
        return SparseOneHotModel(tuple(self.columns), table, {c: counts.get(c, 0) for c in self.columns})


@dataclass(frozen=True)
class OrdinalModel:
    """`table(column, category, index)` holds the fitted codes as a DataFrame of any size."""

    columns: tuple[str, ...]
    table: DataFrame
    name: str = field(default="Ordinal", init=False)

    def transform(self, df: DataFrame) -> DataFrame:
        """Codes replace the categories; -1 marks an unseen category, -2 a missing one not met in fitting."""
        result = df
        for column in self.columns:
            codes = lookup(self.table.filter(F.col("column") == column).select(
                F.col("category").alias("_category"), F.col("index").alias("_index")
            ))
            text = result[column].cast("string")
            joined = result.join(codes, text.eqNullSafe(codes["_category"]), "left")
            fallback = F.when(F.col(column).isNull(), MISSING).otherwise(UNSEEN)
            result = joined.withColumn(column, F.coalesce(F.col("_index"), fallback.cast("long"))).select(*df.columns)
        return result

    def mapping(self, spark: SparkSession, step: int) -> DataFrame:
        return self.table.select(
            F.lit(self.name).alias("encoder"), F.lit(step).alias("step"), "column", "category", "index"
        )


@dataclass(frozen=True)
class Ordinal:
    columns: tuple[str, ...]
    order_by: str = "date"

    def fit(self, df: DataFrame) -> OrdinalModel:
        """Codes from 1 in order of first appearance by `order_by`, then by name."""
        firsts = [
            df.groupBy(F.lit(column).alias("column"), F.col(column).cast("string").alias("category"))
            .agg(F.min(self.order_by).alias("_first"))
            for column in self.columns
        ]
        seen = firsts[0]
        for other in firsts[1:]:
            seen = seen.unionByName(other)
        ranked = running_total(seen, ["column"], ["_first", "category"])
        table = store(ranked.select("column", "category", (F.col("before") + 1).alias("index")), "codes")
        return OrdinalModel(tuple(self.columns), table)


Model = OneHotModel | OrdinalModel


def fit_encoder(spec: EncoderSpec, df: DataFrame) -> Model:
    if spec.name == "One-Hot":
        return OneHot(spec.columns).fit(df)
    if spec.name == "Ordinal":
        return Ordinal(spec.columns).fit(df)
    raise ValueError(f"unknown encoder {spec.name!r}")


def encode(df: DataFrame, cfg: Config, fit_on: DataFrame | None = None) -> tuple[DataFrame, list[Model]]:
    """Fit and apply every configured encoder in turn.

    Every entry is fitted for its own columns, also when two entries share an encoder name. The
    categories come from all rows by default; pass the training rows as `fit_on` to keep the test rows out.
    """
    models: list[Model] = []
    basis = df if fit_on is None else fit_on
    for spec in cfg.encoders:
        model = fit_encoder(spec, basis)
        models.append(model)
        df, basis = model.transform(df), model.transform(basis)
    return df, models


def apply_encoders(df: DataFrame, models: Sequence[Model]) -> DataFrame:
    """Apply fitted encoders; one whose columns are not all present is skipped."""
    for model in models:
        if set(model.columns) <= set(df.columns):
            df = model.transform(df)
    return df


def save_encoders(models: Sequence[Model], spark: SparkSession, path: str) -> None:
    """All fitted mappings in one Parquet table."""
    table = spark.createDataFrame([], MAPPING)
    for step, model in enumerate(models):
        table = table.unionByName(model.mapping(spark, step))
    table.write.mode("overwrite").parquet(path)


def load_encoders(spark: SparkSession, path: str) -> list[Model]:
    table = spark.read.schema(MAPPING).parquet(path)
    heads = table.select("step", "encoder", "column").distinct().collect()
    models: list[Model] = []
    for step in sorted({h.step for h in heads}):
        mine = table.filter(F.col("step") == step)
        columns = tuple(sorted(h.column for h in heads if h.step == step))
        if next(h.encoder for h in heads if h.step == step) == "One-Hot":
            rows = mine.select("column", "category", "index").collect()
            found = {c: [r["category"] for r in sorted(rows, key=lambda r: r["index"]) if r["column"] == c] for c in columns}
            models.append(OneHotModel(columns, found))
        else:
            models.append(OrdinalModel(columns, mine.select("column", "category", "index")))
    return models
