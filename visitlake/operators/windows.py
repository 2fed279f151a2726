"""Window operators.

Plain windows run on aggregated rows whose number a dimension or the calendar bounds.
Whatever would order an unbounded set in one task goes through two levels instead:
a total per bin or per range first, then positions inside each.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from visitlake.session import stored

_LOCAL_BITS = 33  # monotonically_increasing_id keeps the row position in its low 33 bits


def dedupe_latest(df: DataFrame, key: str, latest: list[str]) -> DataFrame:
    """The latest row per key. Every other column follows as a tie-break, so the choice
    does not depend on row order. Spark filters to one candidate per task before the
    shuffle, which keeps a heavily repeated key small."""
    others = [c for c in df.columns if c != key and c not in latest]
    order = Window.partitionBy(key).orderBy(*(F.col(c).desc() for c in [*latest, *others]))
    ranked = df.withColumn("_rank", F.row_number().over(order))
    return ranked.filter("_rank = 1").drop("_rank")


def with_lag(df: DataFrame, columns: list[str], n: int, order: str, partition: list[str] = ()) -> DataFrame:
    """Adds ``Prior<column>``: the value ``n`` rows earlier. For aggregated rows."""
    window = Window.partitionBy(*partition).orderBy(order)
    return df.withColumns({f"Prior{c}": F.lag(c, n).over(window) for c in columns})


def running_total(column: str, order: list[str], partition: list[str] = ()) -> Column:
    """Running sum over aggregated rows, at most one per date and partition."""
    window = Window.partitionBy(*partition).orderBy(*order)
    return F.sum(column).over(window.rowsBetween(Window.unboundedPreceding, Window.currentRow))


def with_totals(df: DataFrame, columns: list[str]) -> DataFrame:
    """Adds ``All<column>``, the grand total of each column, to every aggregated row.

    A scalar subquery instead of an empty window, so rows stay where they are. Name every
    aggregate of ``df``: the subquery then reads the same shuffle as the main query and
    nothing is computed twice.
    """
    totals = df.agg(F.struct(*(F.sum(c).alias(c) for c in columns)).alias("_totals"))
    df = df.withColumn("_totals", totals.scalar())
    return df.withColumns({f"All{c}": F.col(f"_totals.{c}") for c in columns}).drop("_totals")


def dense_ranked(df: DataFrame, partition: list[str], order: list[Column], alias: str) -> DataFrame:
    return df.withColumn(alias, F.dense_rank().over(Window.partitionBy(*partition).orderBy(*order)))


def top_with_ties(df: DataFrame, order: list[Column], k: int, alias: str, partition: list[str] = ()) -> DataFrame:
    """Rows ranked at most ``k``, ties kept. The rank filter sits directly on the window,
    so each task drops its losers before the shuffle."""
    return dense_ranked(df, partition, order, alias).filter(F.col(alias) <= k)


def dense_rank_by_value(
    df: DataFrame, value: str, alias: str, per_unit: int | Decimal, partition: list[str] = ()
) -> DataFrame:
    """``DENSE_RANK`` by ``value`` descending over any number of rows.

    Distinct values fall into bins of width ``1 / per_unit``. The rank is the number of
    distinct values in higher bins plus the rank inside the bin, so a task orders either
    the bins or the distinct values of one bin. The value range times ``per_unit`` bounds
    the bins.
    """
    keys = list(partition)
    bin_ = F.floor(F.col(value) * per_unit).alias("_bin")
    values = df.filter(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.lit(1).alias("_one"))
    values = values.select(*keys, value, bin_)
    bins = values.groupBy(*keys, "_bin").agg(F.count(F.lit(1)).alias("_n"))
    higher = Window.partitionBy(*keys).orderBy(F.desc("_bin")).rowsBetween(Window.unboundedPreceding, -1)
    bins = bins.select(*keys, "_bin", F.coalesce(F.sum("_n").over(higher), F.lit(0)).alias("_above"))
    inside = Window.partitionBy(*keys, "_bin").orderBy(F.desc(value))
    bins = bins.toDF(*(f"_b_{c}" for c in [*keys, "_bin"]), "_above")
    same = F.col("_bin") == F.col("_b__bin")
    for c in keys:
        same = same & F.col(c).eqNullSafe(F.col(f"_b_{c}"))
    ranks = values.withColumn("_inside", F.row_number().over(inside)).join(bins, same)
    ranks = ranks.select(*keys, value, (F.col("_above") + F.col("_inside")).alias(alias))
    ranks = ranks.toDF(*(f"_r_{c}" for c in [*keys, value]), alias)
    match = F.lit(True)
    for c in [*keys, value]:  # NULL peers are peers of each other
        match = match & F.col(c).eqNullSafe(F.col(f"_r_{c}"))
    return df.join(ranks, match, "left").drop(*(f"_r_{c}" for c in [*keys, value]))


def numbered(df: DataFrame, keys: list[str], alias: str) -> DataFrame:
    """Rows with their 0-based position in key order, for any number of rows; equal keys in any order.

    Rows are range-partitioned and sorted, numbered inside each partition, and written
    to the shared folder so that both later reads see the same ranges. Only the row count
    per partition, one row each, is then summed up and broadcast.
    """
    ordered = df.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn("_id", F.monotonically_increasing_id())
    ordered = stored(ordered).withColumn("_part", F.shiftright("_id", _LOCAL_BITS))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = ordered.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    starts = starts.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    position = F.col("_id").bitwiseAND((1 << _LOCAL_BITS) - 1)
    return ordered.join(F.broadcast(starts), "_part").select(
        *df.columns, (F.col("_start") + position).alias(alias)
    )


def dense_index(dim: DataFrame, keys: list[str], alias: str) -> DataFrame:
    """0-based position of each distinct key in key order, for a dimension of any size."""
    return numbered(dim.select(*keys).distinct(), keys, alias)


def small_index(dim: DataFrame, keys: list[str], alias: str, limit: int = 256) -> DataFrame:
    """``dense_index`` for a dimension whose code fits one byte. A key beyond ``limit`` stops
    the job: more keys than that must not be ordered in one task, nor fit the code."""
    position = F.row_number().over(Window.orderBy(*keys)) - 1
    fits = F.when(position < limit, position).otherwise(F.raise_error(F.lit(f"{alias}: more than {limit} keys")))
    return dim.select(*keys).distinct().withColumn(alias, fits)


def gap_tiers(df: DataFrame, value: str, gap, alias: str) -> DataFrame:
    """Numbers the runs of ``value`` separated by more than ``gap``; for small summaries."""
    order = Window.orderBy(value)
    step = F.when(F.col(value) - F.lag(value).over(order) > gap, 1).otherwise(0)
    stepped = df.withColumn("_step", step)
    running = F.sum("_step").over(order.rangeBetween(Window.unboundedPreceding, Window.currentRow))
    return stepped.withColumn(alias, (running + 1).cast("int")).drop("_step")
