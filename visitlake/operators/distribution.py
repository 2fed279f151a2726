"""Histograms and exact percentiles taken from them.

Values are whole minutes. A histogram is a plain grouping, so repeated values combine
before the shuffle, and percentiles never gather the rows of a group. A ``PrefixHistogram``
is stored once for the finest group and answers every coarser one.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from visitlake.session import stored

BIN = 1024  # distinct values one task orders; an int column has at most 2**22 bins


def histogram(df: DataFrame, by: list[str], value: str) -> DataFrame:
    return df.filter(F.col(value).isNotNull()).groupBy(*by, value).agg(F.count(F.lit(1)).alias("Visits"))


def cumulative_upto(hist: DataFrame, by: list[str], value: str, threshold: int, alias: str) -> DataFrame:
    return hist.groupBy(*by).agg(
        F.coalesce(F.sum(F.when(F.col(value) <= threshold, F.col("Visits"))), F.lit(0)).alias(alias)
    )


def _with_positions(hist: DataFrame, by: list[str], value: str) -> DataFrame:
    """Adds the first and last 1-based position each value holds in its sorted group, and
    the group's size. Two levels, so a task orders the bins of a group or the values of
    one bin."""
    binned = hist.withColumn("_bin", F.floor(F.col(value) / BIN))
    bins = binned.groupBy(*by, "_bin").agg(F.sum("Visits").alias("_n"))
    group = Window.partitionBy(*by)
    earlier = group.orderBy("_bin").rowsBetween(Window.unboundedPreceding, -1)
    bins = bins.select(
        *(F.col(c).alias(f"_by_{c}") for c in by), F.col("_bin").alias("_bin2"),
        F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"),
        F.sum("_n").over(group).alias("_size"),
    )
    match = F.col("_bin") == F.col("_bin2")
    for c in by:
        match = match & F.col(c).eqNullSafe(F.col(f"_by_{c}"))
    inside = Window.partitionBy(*by, "_bin").orderBy(value)
    inside = F.sum("Visits").over(inside.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    positioned = binned.withColumn("_inside", inside).join(bins, match)
    return positioned.select(
        *by, value, (F.col("_before") + F.col("_inside")).alias("_last"),
        (F.col("_before") + F.col("_inside") - F.col("Visits") + 1).alias("_first"), "_size",
    )


def percentiles(
    df: DataFrame, by: list[str], value: str, points: dict[str, int], method: str = "inc"
) -> DataFrame:
    """Percentiles of an integer column per group; ``points`` maps names to percents.

    ``inc`` interpolates between neighbours (position ``1 + p * (n - 1)``), ``nearest``
    takes the value at rank ``ceil(p * n)``. Both are exact.
    """
    rows = _with_positions(histogram(df, by, value), by, value)
    return _at_points(rows, by, value, points, method)


def _at_points(rows: DataFrame, by: list[str], value: str, points: dict[str, int], method: str) -> DataFrame:
    """Of values with the positions they hold (``_first`` to ``_last`` of ``_size``)."""
    size, out = F.col("_size"), []

    def at(position):
        covers = (F.col("_first") <= position) & (position <= F.col("_last"))
        return F.max(F.when(covers, F.col(value)))

    for name, point in points.items():
        if method == "nearest":
            scaled = size * point
            rank = F.greatest(F.floor((scaled + 99) / 100), F.lit(1))
            out.append(at(rank).cast("int").alias(name))
        else:
            scaled = (size - 1) * point
            whole, rest = F.floor(scaled / 100), F.max(scaled % 100)
            low, high = at(whole + 1), at(F.least(whole + 2, size))
            hundredths = low.cast("bigint") * 100 + rest * (high - low)
            out.append((hundredths.cast("decimal(20,0)") / 100).cast("decimal(18,2)").alias(name))
    return rows.groupBy(*by).agg(*out)


@dataclass(frozen=True)
class PrefixHistogram:
    """A stored histogram with running counts: ``by``, the value, ``Visits`` and ``Upto``, the
    visits of the group with this value or a smaller one. Rows without a value come first.

    Running counts of a group and of any coarser one follow from the same small table; the
    rows it was built from are read once, when it is built.
    """

    table: DataFrame
    by: tuple[str, ...]
    value: str

    @classmethod
    def build(cls, df: DataFrame, by: list[str], value: str, path: str | None = None) -> PrefixHistogram:
        counts = stored(df.groupBy(*by, value).agg(F.count(F.lit(1)).alias("Visits")))
        return cls(stored(cls._running(counts, list(by), value), path), tuple(by), value)

    @staticmethod
    def _running(counts: DataFrame, by: list[str], value: str) -> DataFrame:
        known = _with_positions(counts.filter(F.col(value).isNotNull()), by, value).select(
            *by, value, (F.col("_last") - F.col("_first") + 1).alias("Visits"), F.col("_last").alias("Upto"))
        without = counts.filter(F.col(value).isNull())
        return known.unionByName(without.withColumn("Upto", F.lit(0).cast("bigint")))

    def covers(self, columns) -> bool:
        return set(columns) <= set(self.by)

    def over(self, by: list[str], keep: Column | None = None) -> PrefixHistogram:
        """Rolled up to fewer columns, of the groups that ``keep`` lets in."""
        if not self.covers(by):
            raise ValueError(f"grouped by {list(self.by)}, not by {list(by)}")
        rows = self.table if keep is None else self.table.filter(keep)
        if keep is None and set(by) == set(self.by):
            return self
        counts = rows.groupBy(*by, self.value).agg(F.sum("Visits").alias("Visits"))
        return PrefixHistogram(self._running(counts, list(by), self.value), tuple(by), self.value)

    def histogram(self) -> DataFrame:
        return self.table.filter(F.col(self.value).isNotNull()).select(*self.by, self.value, "Visits")

    def sizes(self, alias: str) -> DataFrame:
        """Rows of each group, with or without a value."""
        return self.table.groupBy(*self.by).agg(F.coalesce(F.sum("Visits"), F.lit(0)).alias(alias))

    def upto(self, threshold: int, alias: str) -> DataFrame:
        """Rows of each group with a value up to ``threshold``: one look at the running counts."""
        known = self.table.filter(F.col(self.value).isNotNull())
        within = F.max(F.when(F.col(self.value) <= threshold, F.col("Upto")))
        return known.groupBy(*self.by).agg(F.coalesce(within, F.lit(0)).alias(alias))

    def percentiles(self, points: Mapping[str, int], method: str = "inc") -> DataFrame:
        """``percentiles`` of each group."""
        size = F.max("Upto").over(Window.partitionBy(*self.by))
        known = self.table.filter(F.col(self.value).isNotNull()).select(
            *self.by, self.value, F.col("Upto").alias("_last"), (F.col("Upto") - F.col("Visits") + 1).alias("_first"), size.alias("_size"))
        return _at_points(known, list(self.by), self.value, dict(points), method)
