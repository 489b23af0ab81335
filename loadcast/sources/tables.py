"""Partitioned Parquet tables, the landing rule and the train/test matrix files."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loadcast.session import lookup, scratch_path

ROWS_PER_FILE = 5_000_000


def store(df: DataFrame, label: str) -> DataFrame:
    """Write a working table to the shared scratch folder and read it back: lineage ends there."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def land_if_absent(new: DataFrame, landed: DataFrame, on: str | Sequence[str] = "dt") -> DataFrame:
    """The rows whose day has not been landed before."""
    names = [on] if isinstance(on, str) else list(on)
    return new.join(lookup(landed.select(*names).distinct()), names, "left_anti")


def _tasks(df: DataFrame) -> int:
    """Writers per job. An explicit number, because tiny days would otherwise be merged into one slow writer."""
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def write_by_day(df: DataFrame, path: str, date_col: str = "date", mode: str = "append") -> None:
    """One folder per day and one file in it, except that a day of more than `ROWS_PER_FILE` rows is cut.

    The day sizes come first, from a pass over the day column alone, so a day that holds a third of all
    rows is written by as many tasks as it needs.
    """
    dated = df.withColumn("dt", F.col(date_col))
    cuts = lookup(dated.groupBy(F.col("dt").alias("_day")).agg(F.ceil(F.count("*") / ROWS_PER_FILE).alias("_cuts")))
    sliced = dated.join(cuts, dated["dt"].eqNullSafe(cuts["_day"])).withColumn(
        # By content: a task that runs again sends each row where it went before.
        "_slice", F.pmod(F.xxhash64(*dated.columns), F.col("_cuts"))
    )
    spread = sliced.repartition(_tasks(df), "dt", "_slice").select(*dated.columns)
    spread.write.mode(mode).partitionBy("dt").parquet(path)


def spread_by_day(df: DataFrame, day: str) -> DataFrame:
    """Days dealt to writers, one writer a day.

    The days are hashed once more: a plain repartition by a column the input is already partitioned by
    would be dropped by the planner, and with it the number of writers.
    """
    return df.repartition(_tasks(df), F.xxhash64(day))


def write_days(df: DataFrame, path: str, date_col: str = "date") -> None:
    """Replace exactly the days present in `df`, one row per day and area; other days stay as they are."""
    (
        spread_by_day(df.withColumn("dt", F.col(date_col)), "dt")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("dt")
        .parquet(path)
    )


def read_merged(
    spark: SparkSession, path: str, schema: T.StructType, start: object = None, end: object = None
) -> DataFrame:
    """All parts below `path` without the partition column; a date range prunes whole folders."""
    parts = T.StructType([*schema.fields, T.StructField("dt", T.DateType())])
    table = spark.read.schema(parts).parquet(path)
    if table.isEmpty():
        raise ValueError(f"no merged days under {path}")
    if start is not None:
        table = table.filter(F.col("dt") >= F.lit(start))
    if end is not None:
        table = table.filter(F.col("dt") <= F.lit(end))
    return table.drop("dt")


ORDER = "part int, rows long, first string, last string"


def write_matrix(
    df: DataFrame, path: str, target: str, features: Sequence[str], order_by: Sequence[str] = ("date",)
) -> None:
    """Headerless CSV, target first, in the order of `order_by`; the column names go to a text table next to it.

    Rows are cut into ranges of the order, each written sorted to a folder of its own, `part=0` first. An index keeps
    the rows, the first and the last place in the order of each part. The ranges are stored before they are written,
    because their borders are sampled and must be the same for the data and the index. Rows of one place go by their
    values, so the files are the same on every run. Without any column of `order_by` the target orders the rows.
    """
    names = [target, *features]
    order_by = [c for c in order_by if c in df.columns] or names[:1]
    placing = [*order_by, *[c for c in names if c not in order_by]]
    columns = list(dict.fromkeys([*order_by, *names]))
    ranged = df.select(*[F.col(f"`{c}`") for c in columns])
    ranged = ranged.repartitionByRange(_tasks(df), *[F.col(f"`{c}`") for c in placing])
    placed = store(ranged.withColumn("part", F.spark_partition_id()), "matrix")
    sorted_parts = placed.repartition(_tasks(df), "part").sortWithinPartitions("part", *[F.col(f"`{c}`") for c in placing])
    data = sorted_parts.select(*[F.col(f"`{c}`") for c in names], "part")
    data.write.mode("overwrite").partitionBy("part").csv(f"{path}/data", header=False)
    place = F.to_json(F.struct(*[F.col(f"`{c}`") for c in order_by]))
    lead = F.col(f"`{order_by[0]}`")
    index = placed.groupBy("part").agg(
        F.count("*").alias("rows"), F.min_by(place, lead).alias("first"), F.max_by(place, lead).alias("last")
    )
    index.coalesce(1).write.mode("overwrite").parquet(f"{path}/order")
    spark = df.sparkSession
    listed = spark.createDataFrame([(n,) for n in names], "value string").coalesce(1)
    listed.write.mode("overwrite").text(f"{path}/features")


def read_matrix(spark: SparkSession, path: str, schema: T.StructType, position: str | None = None) -> DataFrame:
    """Read the headerless matrix back; `schema` lists the columns in file order.

    With `position` a column of that name tells each row's place in the written order, from 0: the rows of the parts
    before, from the index, and its place in its own part. A part whose rows are not those of the index is an error.
    """
    if position is None:
        whole = spark.read.schema(schema).csv(f"{path}/data", header=False)
        return whole.select(*[F.col(f"`{f.name}`") for f in schema.fields])
    parts = T.StructType([*schema.fields, T.StructField("part", T.IntegerType())])
    # Within a split rows come in file order, and splits are told apart by where they begin.
    rows = spark.read.schema(parts).csv(f"{path}/data", header=False).withColumns({
        "_start": F.col("_metadata.file_block_start"), "_row": F.monotonically_increasing_id(),
    })
    place = F.row_number().over(Window.partitionBy("part").orderBy("_start", "_row"))
    ahead = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    index = spark.read.schema(ORDER).parquet(f"{path}/order").select(
        "part", F.col("rows").alias("_rows"), F.coalesce(F.sum("rows").over(ahead), F.lit(0)).alias("_ahead")
    )
    held = F.count("*").over(Window.partitionBy("part"))
    numbered = rows.join(F.broadcast(index), "part", "left").withColumns({"_place": place, "_held": held})
    wrong = F.raise_error(F.concat(F.lit("matrix part does not match its index: "), F.col("part").cast("string")))
    at = F.when(F.col("_held") == F.col("_rows"), F.col("_ahead") + F.col("_place") - 1).otherwise(wrong.cast("long"))
    return numbered.select(*[F.col(f"`{f.name}`") for f in schema.fields], at.alias(position))


def read_matrix_names(spark: SparkSession, path: str) -> list[str]:
    """The stored column names: one short text file, written in one part, so the order holds."""
    return [row.value for row in spark.read.text(f"{path}/features").collect() if row.value.strip()]
