"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# A lookup side of a few narrow columns stays below some tens of megabytes up to this many rows.
BROADCAST_ROWS = 200_000

SETTINGS = {
    # Days are cut in UTC, so the answer does not depend on where a driver runs.
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
}


def build_session(app: str = "loadcast", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the operators expect; `conf` keys use `__` for dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **{k.replace("__", "."): v for k, v in conf.items()}}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_root(spark: SparkSession) -> str:
    """The folder every executor can reach: `spark.checkpoint.dir`, or a temporary one in local mode."""
    context = spark.sparkContext
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared and not context.getCheckpointDir():
        context.setCheckpointDir(shared)
    current = shared or context.getCheckpointDir()
    if current:
        return current
    if not context.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="loadcast-"))
    return context.getCheckpointDir()


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared scratch folder."""
    return f"{scratch_root(spark).rstrip('/')}/loadcast/{label}-{uuid.uuid4().hex}"


def materialize(df: DataFrame) -> DataFrame:
    """Cut the lineage with a reliable checkpoint, which outlives a lost executor."""
    scratch_root(df.sparkSession)
    return df.checkpoint(eager=True)


def lookup(df: DataFrame) -> DataFrame:
    """A narrow side table, computed once and broadcast if its counted rows allow it.

    The planner cannot foresee how far an aggregate shrinks a large table and would shuffle the other
    side. A table beyond the limit is joined as the planner sees fit, with skew handling.
    """
    kept = materialize(df)
    return F.broadcast(kept) if kept.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS else kept
