"""First row per key, exact running totals and exact quantiles that hold up under skew."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loadcast.session import BROADCAST_ROWS, lookup, materialize
from loadcast.sources.tables import store

COARSE_SLOTS = 4096
# Quantiles rank at most this many rows at once where narrower slots can still part them, and the levels of slots.
RANKED_ROWS, LEVELS = 200_000, 5


def _matches(left: DataFrame, right: DataFrame, pairs: Sequence[tuple[str, str]]) -> Column:
    test = F.lit(True)
    for mine, theirs in pairs:
        test = test & left[mine].eqNullSafe(right[theirs])
    return test


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str], descending: bool = False) -> DataFrame:
    """One row per key, the first by `order` and then by the other columns.

    Missing values sort as in SQL: first when ascending, last when descending. The smallest (or largest)
    row is an aggregate, so every task hands on one row per key whatever the size of the key, and no rank
    is computed over all its rows.
    """
    named = {*keys, *order}
    row = F.struct(*[c for c in order if c not in keys], *[c for c in df.columns if c not in named])
    best = df.groupBy(*keys).agg((F.max(row) if descending else F.min(row)).alias("_best"))
    return best.select(*[F.col(c) if c in keys else F.col("_best")[c].alias(c) for c in df.columns])


# Types whose extreme is kept in place by a hash aggregate; for others Spark sorts every task's rows.
FIXED_WIDTH = (T.NumericType, T.DateType, T.TimestampType, T.TimestampNTZType, T.BooleanType)


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """What `first_per_key(df, keys, order, descending=True)` gives, without sorting and without moving whole rows.

    The greatest leading version of each key comes from a hash aggregate over the key and version columns alone. The
    rows of that version are fetched by a lookup, so only they are read in full; most keys have one. Where several
    share it, they are set apart, and the remaining columns decide among them in a ranking that every task cuts to one
    row a key first. Keys beyond the lookup's limit, or a leading version of varying width, go through `first_per_key`.
    """
    lead = order[0]
    if lead in keys or not isinstance(df.schema[lead].dataType, FIXED_WIDTH):
        return first_per_key(df, keys, order, descending=True)
    newest = materialize(df.groupBy(*keys).agg(F.max(lead).alias("_newest")))
    if newest.limit(BROADCAST_ROWS + 1).count() > BROADCAST_ROWS:
        return first_per_key(df, keys, order, descending=True)
    named = newest.select(*[F.col(k).alias(f"_key_{k}") for k in keys], "_newest")
    pairs = [(k, f"_key_{k}") for k in keys]
    hits = df.join(F.broadcast(named), _matches(df, named, [*pairs, (lead, "_newest")]), "left_semi")
    candidates = store(hits, "newest")
    shared = candidates.groupBy(*[F.col(k).alias(f"_key_{k}") for k in keys]).agg(F.count("*").alias("_n"))
    shared = materialize(shared.filter("_n > 1").drop("_n"))
    if shared.isEmpty():
        return candidates
    tie = _matches(candidates, shared, pairs)
    rest = [c for c in [*order[1:], *df.columns] if c not in (lead, *keys)]
    ranking = Window.partitionBy(*keys).orderBy(*[F.col(f"`{c}`").desc_nulls_last() for c in dict.fromkeys(rest)], F.lit(1))
    ties = candidates.join(F.broadcast(shared), tie, "left_semi").withColumn("_rank", F.row_number().over(ranking))
    alone = candidates.join(F.broadcast(shared), tie, "left_anti")
    return alone.unionByName(ties.filter("_rank = 1").drop("_rank"))


def running_total(
    df: DataFrame, group: Sequence[str], order: Sequence[str], weight: str | None = None
) -> DataFrame:
    """Add `before`: the summed weight (or the number) of the rows ahead of this one in its group.

    Rows are range-partitioned on group and order, so one group may span many tasks. Each slice is
    summed, the slice totals are accumulated, and every row adds its own slice's running sum. A hash of the whole
    row as last sort key lets rows of equal order spread over several slices, and is the same if a task runs
    again. The placed rows are stored first because
    range bounds are sampled and must be the same for both readers.
    """
    placing = [*group, *order, "_spread"]
    placed = store(
        df.withColumn("_spread", F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]))
        .repartitionByRange(*[F.col(c).asc_nulls_last() for c in placing])
        .withColumn("_slice", F.spark_partition_id()),
        "ranked",
    )
    amount = F.lit(1).cast("long") if weight is None else F.col(weight)
    slices = placed.groupBy(*group, "_slice").agg(F.sum(amount).alias("_slice_sum"))
    ahead = Window.partitionBy(*group).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = lookup(slices.select(
        *[F.col(c).alias(f"_key_{c}") for c in group],
        F.col("_slice").alias("_key__slice"),
        F.coalesce(F.sum("_slice_sum").over(ahead), F.lit(0)).alias("_offset"),
    ))
    inside = (
        Window.partitionBy(*group, "_slice")
        .orderBy(*[F.col(c).asc_nulls_last() for c in [*order, "_spread"]])
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    counted = placed.withColumn("_inside", F.coalesce(F.sum(amount).over(inside), F.lit(0)))
    return (
        counted.join(offsets, _matches(counted, offsets, [(c, f"_key_{c}") for c in [*group, "_slice"]]))
        .withColumn("before", F.col("_inside") + F.col("_offset"))
        .select(*df.columns, "before")
    )


def exact_quantiles(df: DataFrame, group: Sequence[str], value: str, points: Sequence[float]) -> DataFrame:
    """Linear-interpolated quantiles per group (at least one group column) as `(group…, point, quantile)`.

    A first pass counts values in `COARSE_SLOTS` equal slots per group, which tells in which slots the wanted ranks
    fall. While those with different values hold more than `RANKED_ROWS` rows and a level still sets some aside, each
    is cut into as many slots again, now from the lowest to the highest value that it really holds: after far outliers
    the second level follows the bulk of the column. Only the values of the last slots are counted and ranked, so next
    to nothing is shuffled. Should one slot still hold most values, the ranking spreads it: equal values are counted as
    one and the rest is cut into ranges.
    """
    by, x = list(group), F.col(value)
    slots_of = [*by, "_path"]
    there = df.filter(x.isNotNull()).select(*by, value, F.lit(0).cast("long").alias("_path"))
    wanted, held = None, None
    for _ in range(LEVELS):
        spans = lookup(
            there.groupBy(*slots_of).agg(F.count("*").alias("_total"), F.min(x).alias("_lo"), F.max(x).alias("_hi"))
        )
        if wanted is None:
            wanted = _wanted_ranks(spans, by, points)
        share = F.coalesce(F.try_divide(x - F.col("_lo"), F.col("_hi") - F.col("_lo")), F.lit(0.0))
        slot = F.least(F.floor(share * COARSE_SLOTS), F.lit(COARSE_SLOTS - 1))
        placed = there.join(spans, slots_of).select(*slots_of, value, slot.alias("_slot"))
        ahead = Window.partitionBy(*slots_of).orderBy("_slot").rowsBetween(Window.unboundedPreceding, -1)
        slots = (
            placed.groupBy(*slots_of, "_slot")
            .agg(F.count("*").alias("_in_slot"), (F.min(x) < F.max(x)).alias("_mixed"))
            .withColumn("_before", F.coalesce(F.sum("_in_slot").over(ahead), F.lit(0)))
        )
        inside = (F.col("_rank") >= F.col("_before")) & (F.col("_rank") < F.col("_before") + F.col("_in_slot"))
        path = (F.col("_path") * COARSE_SLOTS + F.col("_slot")).alias("_path")
        wanted = lookup(wanted.join(slots, slots_of).filter(inside).select(
            *by, path, "point", "_share", "_is_low", (F.col("_rank") - F.col("_before")).alias("_rank"),
            "_in_slot", "_mixed",
        ))
        needed = wanted.select(*slots_of, "_in_slot", "_mixed").distinct()
        there = placed.select(*by, path, value).join(lookup(needed.select(*slots_of)), slots_of, "left_semi")
        # Slots of equal values need no parting, as those are counted as one.
        before, held = held, needed.agg(F.sum(F.when(F.col("_mixed"), F.col("_in_slot")))).first()[0] or 0
        wanted = wanted.drop("_in_slot", "_mixed")
        if held <= RANKED_ROWS or held == before:
            break

    counted = there.groupBy(*slots_of, value).agg(F.count("*").alias("_n"))
    ranked = running_total(counted, slots_of, [value], "_n")
    hit = (F.col("_rank") >= F.col("before")) & (F.col("_rank") < F.col("before") + F.col("_n"))
    found = ranked.join(wanted, slots_of).filter(hit)
    lower, upper = F.max(F.when(F.col("_is_low"), x)), F.max(F.when(~F.col("_is_low"), x))
    return found.groupBy(*by, "point").agg((lower + F.max("_share") * (upper - lower)).alias("quantile"))


def _wanted_ranks(spans: DataFrame, by: list[str], points: Sequence[float]) -> DataFrame:
    """`(group…, _path, point, _share, _is_low, _rank)`: the two ranks between which each quantile lies."""
    ranks = spans.select(
        *by, "_path", "_total", F.explode(F.array(*[F.lit(float(p)) for p in points])).alias("point")
    ).withColumn("_at", (F.col("_total") - 1) * F.col("point"))
    low = F.floor("_at")
    return ranks.select(
        *by, "_path", "point", (F.col("_at") - low).alias("_share"),
        F.inline(F.array(
            F.struct(F.lit(True).alias("_is_low"), low.alias("_rank")),
            F.struct(F.lit(False).alias("_is_low"), F.least(low + 1, F.col("_total") - 1).alias("_rank")),
        )),
    )
