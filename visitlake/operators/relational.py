"""Joins, filters, unions and set differences shaped for skewed, growing tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def project(df: DataFrame, columns) -> DataFrame:
    """``columns`` is a list of names or a mapping of new name to old."""
    if isinstance(columns, dict):
        return df.select(*(F.col(old).alias(new) for new, old in columns.items()))
    return df.select(*columns)


def lookup(df: DataFrame, column: str, value) -> DataFrame:
    """Point lookup; on a sorted or bucketed layout only matching row groups are read."""
    return df.filter(F.col(column) == F.lit(value))


def apply_filters(df: DataFrame, filters: dict | None) -> DataFrame:
    """Multi-select slicers: a column maps to the values kept, an empty list keeps all."""
    for column, values in (filters or {}).items():
        if values:
            df = df.filter(F.col(column).isin(list(values)))
    return df


def join_dim(fact: DataFrame, dim: DataFrame, key: str, how: str = "inner") -> DataFrame:
    return fact.join(dim, key, how)


def keep_matching(fact: DataFrame, dim: DataFrame, key: str) -> DataFrame:
    """Existence filter: no dimension column is kept, so a semi join is enough."""
    return fact.join(dim.select(key), key, "left_semi")


def map_values(df: DataFrame, column: str, alias: DataFrame) -> DataFrame:
    """Replaces ``Variant`` spellings of ``column`` by their ``Canonical`` one."""
    mapping = alias.select(F.col("Variant").alias(column), F.col("Canonical").alias("_canonical"))
    mapped = df.join(mapping, column, "left")
    kept = [
        F.coalesce("_canonical", column).alias(column) if c == column else F.col(c) for c in df.columns
    ]
    return mapped.select(*kept)


def rollup_dim(
    fact: DataFrame, dims: list[tuple[str, DataFrame]], names: list[str], sums: dict[str, Column]
) -> DataFrame:
    """Aggregate a fact by dimension *names*, in two steps.

    First by the foreign keys, where map-side combining shrinks any hot key to one row
    per task, then, after the join, by the names. The joins and the second shuffle see
    one row per key combination instead of one per visit. ``sums`` must be additive.
    """
    keys = list(dict.fromkeys(key for key, _ in dims))
    by_key = fact.groupBy(*keys).agg(*(column.alias(name) for name, column in sums.items()))
    for key, dim in dims:
        by_key = by_key.join(dim, key)
    return by_key.groupBy(*names).agg(*(F.sum(name).alias(name) for name in sums))


def per_entity(
    df: DataFrame, by: list[str], entity: str, sums: dict[str, Column], distinct: str
) -> DataFrame:
    """Additive ``sums`` and the distinct ``entity`` values of each group.

    Goes through one row per group and entity, so a large group is spread over its
    entities, and a large entity shrinks before the shuffle.
    """
    entities = df.groupBy(*by, entity).agg(*(column.alias(name) for name, column in sums.items()))
    return entities.groupBy(*by).agg(
        F.count(entity).alias(distinct), *(F.sum(name).alias(name) for name in sums)
    )


def union_periods(frames: list[DataFrame]) -> DataFrame:
    return reduce(lambda left, right: left.unionByName(right), frames)


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    counts = [df.agg(F.count(F.lit(1)).alias("RowCount")).select(F.lit(label).alias("Dataset"), "RowCount")
              for label, df in tables.items()]
    return union_periods(counts)


def key_diff(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Keys present on one side only, with the side. One grouping instead of two anti
    joins: repeated keys collapse before the shuffle, so a hot key costs nothing."""
    tagged = left.select(*keys, F.lit(1).alias("_side")).unionByName(
        right.select(*keys, F.lit(2).alias("_side"))
    )
    sides = tagged.groupBy(*keys).agg(F.bit_or("_side").alias("_sides"))
    return sides.filter("_sides < 3").select(
        *keys, F.when(F.col("_sides") == 1, "left").otherwise("right").alias("OnlyIn")
    )
