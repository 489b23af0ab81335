"""Profile tables of a feature set: extents, counts, histograms, density curves and correlations."""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loadcast.functions.weather import missing_if_nan
from loadcast.operators.ranking import exact_quantiles
from loadcast.session import lookup, materialize

GRID_POINTS = 200
MOMENTS = ("_n", "_mx", "_my", "_vx", "_vy", "_c", "_lx", "_ly", "_hx", "_hy")
# A task hands its matrices over once it holds this many keys, so its memory stays bounded.
MAX_HELD_KEYS = 1000
# Width of a density cell in bandwidths, terms of its series, and cells of a curve that a task holds.
CELL, TERMS, HELD_CELLS = 0.25, 14, 10_000


def numeric_columns(df: DataFrame) -> list[str]:
    """Integers and floating-point numbers of any width; dates, texts and flags are not numeric."""
    kinds = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType)
    return [f.name for f in df.schema.fields if isinstance(f.dataType, kinds)]


def date_extent(df: DataFrame, date_col: str = "date", keys: Sequence[str] = ()) -> DataFrame:
    return df.groupBy(*keys).agg(F.min(date_col).alias("first_date"), F.max(date_col).alias("last_date"))


def category_counts(df: DataFrame, col: str) -> DataFrame:
    """Value counts, most frequent first; equal counts by name."""
    return df.groupBy(col).agg(F.count("*").alias("n")).orderBy(F.desc("n"), col)


def distinct_values(df: DataFrame, col: str) -> DataFrame:
    return df.select(col).distinct()


def table_profile(df: DataFrame) -> DataFrame:
    """One row per column: position, name, type, table rows and non-null count, from a single aggregate."""
    fields = df.schema.fields
    counts = df.agg(
        F.count("*").alias("_rows"), *[F.count(F.col(f"`{f.name}`")).alias(f"_{i}") for i, f in enumerate(fields)]
    )
    entries = [
        F.struct(
            F.lit(i).alias("position"),
            F.lit(f.name).alias("column"),
            F.lit(f.dataType.simpleString()).alias("type"),
            F.col("_rows").alias("rows"),
            F.col(f"_{i}").alias("non_null"),
        )
        for i, f in enumerate(fields)
    ]
    return counts.select(F.inline(F.array(*entries)))


def _long_form(df: DataFrame, cols: Sequence[str], keys: Sequence[str]) -> DataFrame:
    """`(keys…, column, x)` without missing values."""
    values = [missing_if_nan(F.col(f"`{c}`").cast("double")).alias(c) for c in cols]
    return (
        df.select(*keys, *values)
        .unpivot(list(keys), [f"`{c}`" for c in cols], "column", "x")
        .filter(F.col("x").isNotNull())
    )


def _plain_columns(df: DataFrame, cols: Sequence[str], keys: Sequence[str]) -> DataFrame:
    """The keys, and the columns as doubles named `_x0`, `_x1`, …"""
    return df.select(
        *keys, *[missing_if_nan(F.col(f"`{c}`").cast("double")).alias(f"_x{i}") for i, c in enumerate(cols)]
    )


def _wide_stats(df: DataFrame, cols: Sequence[str], keys: Sequence[str]) -> DataFrame:
    """`(keys…, _0, _1, …)`: a struct `(column, n, lo, hi, sd)` for each column, from one pass."""
    at = [missing_if_nan(F.col(f"`{c}`").cast("double")) for c in cols]
    sums = [
        F.struct(
            F.lit(c).alias("column"),
            F.count(v).alias("n"),
            F.min(v).alias("lo"),
            F.max(v).alias("hi"),
            F.stddev(v).alias("sd"),
        ).alias(f"_{i}")
        for i, (c, v) in enumerate(zip(cols, at))
    ]
    return df.groupBy(*keys).agg(*sums)


def _column_stats(df: DataFrame, cols: Sequence[str], keys: Sequence[str]) -> DataFrame:
    """`(keys…, column, n, lo, hi, sd)` of every column that has a value, from one pass over the columns."""
    wide = _wide_stats(df, cols, keys)
    return wide.select(*keys, F.inline(F.array(*[F.col(f"_{i}") for i in range(len(cols))]))).filter("n > 0")


def _auto_bins(values: DataFrame, stats: DataFrame, group: list[str]) -> DataFrame:
    """Bin counts as the narrower of the Sturges and Freedman-Diaconis widths gives them."""
    quartiles = (
        exact_quantiles(values, group, "x", (0.25, 0.75))
        .groupBy(*group)
        .agg((F.max("quantile") - F.min("quantile")).alias("_iqr"))
    )
    n, spread = F.col("n").cast("double"), F.col("hi") - F.col("lo")
    sturges = spread / (F.log2(n) + 1)
    diaconis = 2 * F.col("_iqr") / F.cbrt(n)
    width = F.when(diaconis > 0, F.least(sturges, diaconis)).otherwise(sturges)
    bins = F.when(spread > 0, F.ceil(spread / width)).otherwise(1)
    return stats.join(quartiles, group).withColumn("k", bins.cast("long")).drop("_iqr")


def histograms(
    df: DataFrame, cols: Sequence[str] | None = None, bins: int | None = None, keys: Sequence[str] = ()
) -> DataFrame:
    """`(keys…, column, bin, lower, upper, n)` for every bin, empty ones included.

    Bins are equal in width from the lowest to the highest value; the highest belongs to the last bin.
    """
    names = numeric_columns(df) if cols is None else list(cols)
    group = [*keys, "column"]
    values = _long_form(df, names, keys)
    stats = _column_stats(df, names, keys)
    sized = _auto_bins(values, stats, group) if bins is None else stats.withColumn("k", F.lit(bins).cast("long"))
    # A constant column gets one unit around its value, as the usual histogram rule has it.
    flat = F.col("lo") == F.col("hi")
    edges = sized.select(
        *group,
        "k",
        F.when(flat, F.col("lo") - 0.5).otherwise(F.col("lo")).alias("lo"),
        F.when(flat, F.col("hi") + 0.5).otherwise(F.col("hi")).alias("hi"),
    )
    width = (F.col("hi") - F.col("lo")) / F.col("k")
    slot = F.least(F.floor((F.col("x") - F.col("lo")) / width), F.col("k") - 1)
    edges = lookup(edges)
    filled = values.join(edges, group).groupBy(*group, slot.alias("bin")).agg(F.count("*").alias("_held"))
    bins_of = edges.withColumn("bin", F.explode(F.sequence(F.lit(0).cast("long"), F.col("k") - 1)))
    return bins_of.join(filled, [*group, "bin"], "left").select(
        *group,
        "bin",
        (F.col("lo") + F.col("bin") * width).alias("lower"),
        (F.col("lo") + (F.col("bin") + 1) * width).alias("upper"),
        F.coalesce("_held", F.lit(0)).alias("n"),
    )


class _Curve:
    """Kernel sums of one column on its grid.

    A value lies in a cell of `CELL` bandwidths at a distance of u from its centre, u being 1/8 at most. With v the
    distance of a grid point from the centre, exp(-(v - u)**2 / 2) is exp(-v**2 / 2) times the sum of He_k(v) u**k / k!
    over all k, He being the Hermite polynomials. A cell keeps the sums of u**k / k! for k below `TERMS`. As
    |He_k(v)| exp(-v**2 / 4) <= 1.09 sqrt(k!), what is left out is below 1.09 (1/8)**14 / sqrt(14!) * 1.04 < 1e-18 a
    value, less than a double rounds of the kernel's peak, 1. Every value counts on every point; a column of n values
    has 6 n**0.7 cells at most.
    """

    def __init__(self, low: float, high: float, width: float, grid: int):
        self.low, self.width = low, width
        self.spots = low + np.arange(grid) * ((high - low) / (grid - 1))
        self.mass = np.zeros(grid)
        self.held: list[tuple[np.ndarray, np.ndarray]] = []

    def add(self, x: np.ndarray) -> None:
        place = (x - self.low) / self.width
        cells, inverse = np.unique(np.floor(place / CELL), return_inverse=True)
        offset = place - (cells[inverse] + 0.5) * CELL
        sums, weight = np.empty((len(cells), TERMS)), np.ones(len(x))
        for k in range(TERMS):
            sums[:, k] = np.bincount(inverse, weight, len(cells))
            weight = weight * offset / (k + 1)
        self.held.append((cells, sums))
        if sum(len(c) for c, _ in self.held) > HELD_CELLS:
            self.lay()

    def lay(self) -> None:
        """Evaluate the held cells on the grid."""
        if not self.held:
            return
        cells, inverse = np.unique(np.concatenate([c for c, _ in self.held]), return_inverse=True)
        sums = np.zeros((len(cells), TERMS))
        np.add.at(sums, inverse, np.concatenate([m for _, m in self.held]))
        self.held.clear()
        for first in range(0, len(cells), 1000):
            part = sums[first:first + 1000]
            centres = self.low + (cells[first:first + 1000] + 0.5) * CELL * self.width
            # At 40 bandwidths a kernel is zero in double precision.
            v = np.clip((self.spots[:, None] - centres) / self.width, -40, 40)
            last, now = np.zeros_like(v), np.exp(-0.5 * v * v)
            for k in range(TERMS):
                self.mass += now @ part[:, k]
                last, now = now, v * now - k * last


def _grid_masses(
    batches: Iterator[pd.DataFrame], keys: list[str], width: int, grid: int, shared: list | None
) -> Iterator[pd.DataFrame]:
    """Per task, key and column: the kernel sums over the task's values, as one array for the grid. `shared` has low,
    high and bandwidth by column where there are no keys; otherwise every row carries them in `_spans`."""
    held: dict[tuple, dict[int, _Curve]] = {}

    def drain() -> pd.DataFrame:
        rows = []
        for key, curves in held.items():
            for i, curve in curves.items():
                curve.lay()
                rows.append((*key, i, curve.mass))
        held.clear()
        return pd.DataFrame(rows, columns=[*keys, "_i", "_masses"])

    for batch in batches:
        for key, rows in batch.groupby(keys, dropna=False) if keys else [((), batch)]:
            if key not in held:
                flat = np.asarray(rows["_spans"].iat[0] if keys else shared, float).reshape(-1, 3)
                held[key] = {i: _Curve(*flat[i], grid) for i in range(width) if flat[i, 2] > 0}
            for i, curve in held[key].items():
                x = rows[f"_x{i}"].to_numpy()
                x = x[~np.isnan(x)]
                if len(x):
                    curve.add(x)
        if sum(len(curves) for curves in held.values()) > MAX_HELD_KEYS:
            yield drain()
    if held:
        yield drain()


def kde(
    df: DataFrame, cols: Sequence[str] | None = None, grid: int = GRID_POINTS, keys: Sequence[str] = ()
) -> DataFrame:
    """`(keys…, column, point, x, density)`: a Gaussian density from the lowest to the highest value.

    Scott's bandwidth. Every value counts on every grid point, through a fast transform with a proven error; each task
    folds its values into one vector per column before the shuffle. A column without spread has no curve.
    """
    names, by = numeric_columns(df) if cols is None else list(cols), list(keys)
    group = [*by, "column"]
    wide = materialize(_wide_stats(df, names, by))
    one_each = F.array(*[F.col(f"_{i}") for i in range(len(names))])
    bandwidth = F.col("sd") * F.pow(F.col("n").cast("double"), F.lit(-0.2))
    stats = wide.select(*by, F.inline(one_each)).filter("sd > 0").select(
        *group,
        F.col("lo").alias("_lo"),
        ((F.col("hi") - F.col("lo")) / (grid - 1)).alias("_step"),
        bandwidth.alias("_h"),
        F.col("n").alias("_n"),
    )
    span = F.flatten(F.transform(one_each, lambda c: F.array(
        F.coalesce(c["lo"], F.lit(0.0)), F.coalesce(c["hi"], F.lit(0.0)),
        F.coalesce(c["sd"] * F.pow(c["n"].cast("double"), F.lit(-0.2)), F.lit(0.0)),
    )))
    spans, values, shared = wide.select(*by, span.alias("_spans")), _plain_columns(df, names, by), None
    if by:
        values = values.join(lookup(spans), by)
    else:
        shared = spans.first()["_spans"]
    masses = T.StructType([
        *[values.schema[name] for name in by], T.StructField("_i", T.IntegerType()),
        T.StructField("_masses", T.ArrayType(T.DoubleType())),
    ])
    folded = values.mapInPandas(lambda it: _grid_masses(it, by, len(names), grid, shared), masses)
    listed = F.array(*[F.lit(c) for c in names])
    shares = (
        folded.select(*by, F.get(listed, F.col("_i")).alias("column"), F.posexplode("_masses").alias("point", "_mass"))
        .groupBy(*group, "point").agg(F.sum("_mass").alias("_mass"))
    )
    scale = F.col("_n") * F.col("_h") * math.sqrt(2 * math.pi)
    return shares.join(lookup(stats), group).select(
        *group,
        "point",
        (F.col("_lo") + F.col("point") * F.col("_step")).alias("x"),
        (F.col("_mass") / scale).alias("density"),
    )


def _pair_moments(batches: Iterator[pd.DataFrame], keys: list[str], width: int) -> Iterator[pd.DataFrame]:
    """Per task and key: the count, means, centred sums and extents of every column pair over its complete rows."""
    held: dict[tuple, list[np.ndarray]] = {}
    upper = np.triu_indices(width, 1)
    columns = [f"_x{i}" for i in range(width)]

    def drain() -> pd.DataFrame:
        rows = []
        for key, (n, mean, spread, cross, low, high) in held.items():
            part = pd.DataFrame({
                "_i": upper[0], "_j": upper[1], "_n": n[upper], "_mx": mean[upper], "_my": mean.T[upper],
                "_vx": spread[upper], "_vy": spread.T[upper], "_c": cross[upper],
                "_lx": low[upper], "_ly": low.T[upper], "_hx": high[upper], "_hy": high.T[upper],
            })
            for name, value in zip(keys, key):
                part[name] = value
            rows.append(part)
        held.clear()
        return pd.concat(rows)

    for batch in batches:
        groups = batch.groupby(keys, dropna=False) if keys else [((), batch)]
        for key, group in groups:
            if not len(group):
                continue
            x = group[columns].to_numpy(float)
            there = ~np.isnan(x)
            # Row i, column j: the extent of column i over the rows that also have column j. Columns j without missing
            # values have the same extents.
            low = np.repeat(np.where(there, x, np.inf).min(axis=0)[:, None], width, axis=1)
            high = np.repeat(np.where(there, x, -np.inf).max(axis=0)[:, None], width, axis=1)
            for j in np.flatnonzero(~there.all(axis=0)):
                both = there & there[:, [j]]
                low[:, j] = np.where(both, x, np.inf).min(axis=0)
                high[:, j] = np.where(both, x, -np.inf).max(axis=0)
            # Moving each column to its own batch mean first keeps the sums free of cancellation.
            middle = np.where(there, x, 0).sum(axis=0) / np.maximum(there.sum(axis=0), 1)
            x = np.where(there, x - middle, 0)
            mask = there.astype(float)
            n = mask.T @ mask
            share = (x.T @ mask) / np.maximum(n, 1)
            now = [n, middle[:, None] + share, (x * x).T @ mask - n * share**2, x.T @ x - n * share * share.T, low, high]
            if key in held:
                n0, mean0, spread0, cross0, low0, high0 = held[key]
                total = np.maximum(n0 + n, 1)
                step = np.where((n0 > 0) & (n > 0), now[1] - mean0, 0)
                both = n0 * n / total
                now = [
                    n0 + n,
                    (n0 * mean0 + n * now[1]) / total,
                    spread0 + now[2] + both * step**2,
                    cross0 + now[3] + both * step * step.T,
                    np.minimum(low0, low),
                    np.maximum(high0, high),
                ]
            held[key] = now
        if len(held) > MAX_HELD_KEYS:
            yield drain()
    if held:
        yield drain()


def correlation_pairs(df: DataFrame, cols: Sequence[str] | None = None, keys: Sequence[str] = ()) -> DataFrame:
    """`(keys…, x, y, r)` below the diagonal: each pair once, over the rows that have both values.

    Every task reduces its plain columns to one small moment matrix with array arithmetic, several times faster
    than opening each row into its pairs; the matrices are then merged around the common means, which
    stays accurate for values far from zero. A pair whose lowest and highest value agree on either side has no
    spread and gives null; sums alone would leave rounding in its place.
    """
    names = numeric_columns(df) if cols is None else list(cols)
    by = list(keys)
    fields = [*[f for f in df.schema.fields if f.name in by]]
    moments = T.StructType([
        T.StructField("_i", T.IntegerType()),
        T.StructField("_j", T.IntegerType()),
        *[T.StructField(c, T.DoubleType()) for c in MOMENTS],
        *fields,
    ])
    partial = _plain_columns(df, names, by).mapInPandas(lambda it: _pair_moments(it, by, len(names)), moments)
    pair = Window.partitionBy(*by, "_i", "_j")
    off_x = F.col("_mx") - F.sum(F.col("_n") * F.col("_mx")).over(pair) / F.col("_all")
    off_y = F.col("_my") - F.sum(F.col("_n") * F.col("_my")).over(pair) / F.col("_all")
    sums = (
        partial.withColumn("_all", F.nullif(F.sum("_n").over(pair), F.lit(0.0)))
        .withColumns({"_dx": off_x, "_dy": off_y})
        .groupBy(*by, "_i", "_j")
        .agg(
            F.sum(F.col("_c") + F.col("_n") * F.col("_dx") * F.col("_dy")).alias("_cross"),
            F.sum(F.col("_vx") + F.col("_n") * F.col("_dx") * F.col("_dx")).alias("_spread_x"),
            F.sum(F.col("_vy") + F.col("_n") * F.col("_dy") * F.col("_dy")).alias("_spread_y"),
            ((F.min("_lx") < F.max("_hx")) & (F.min("_ly") < F.max("_hy"))).alias("_varies"),
        )
    )
    listed = F.array(*[F.lit(c) for c in names])
    return sums.select(
        *by,
        F.get(listed, F.col("_i")).alias("x"),
        F.get(listed, F.col("_j")).alias("y"),
        F.when(
            F.col("_varies"), F.try_divide(F.col("_cross"), F.sqrt("_spread_x") * F.sqrt("_spread_y"))
        ).alias("r"),
    )


def rebuild_date(df: DataFrame) -> DataFrame:
    return df.withColumn("date", F.make_date("year", "month", "day"))
