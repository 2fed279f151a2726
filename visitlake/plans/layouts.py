"""Layouts of the fact: files in which a workload finds its rows together.

A Morton layout serves two keys at once. Both are scaled to ``MORTON_BITS`` bits in their own
order and their bits interleaved, so rows that are near in either key are near in the file, and
the statistics of a row group are narrow in both. A Bloom filter in each row group tells
lookups of one key that the group does not hold it, whatever its statistics span.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from visitlake.operators.windows import dense_index

MORTON_BITS = 16
#: Rows that are still a row group of their own make a lookup cheap and a scan no dearer.
ROW_GROUP_BYTES = 16 << 20


def spread_bits(code: Column) -> Column:
    """The bits of a ``MORTON_BITS``-bit number at every other place: halves are moved apart, then quarters, down to bits."""
    out = code.cast("bigint")
    for step, mask in ((8, 0x00FF00FF), (4, 0x0F0F0F0F), (2, 0x33333333), (1, 0x55555555)):
        out = out.bitwiseOR(F.shiftleft(out, step)).bitwiseAND(F.lit(mask).cast("bigint"))
    return out


def morton(first: Column, second: Column) -> Column:
    """The bits of two numbers in turn, those of ``first`` above."""
    return F.shiftleft(spread_bits(first), 1).bitwiseOR(spread_bits(second))


def scaled(value: Column, low: Column, high: Column) -> Column:
    """A whole number between two others as ``MORTON_BITS`` bits, in order. A missing one is the least."""
    cells = (1 << MORTON_BITS) - 1
    span = F.greatest(high - low, F.lit(1)).cast("double")
    place = F.least(F.floor((value - low) / span * cells), F.lit(cells))
    return F.when(value.isNotNull(), place).otherwise(0).cast("int")


def with_morton(rows: DataFrame, key: str, day: str, alias: str) -> DataFrame:
    """Rows with the Morton code of a key of any type, by its rank, and a date."""
    ranks = dense_index(rows.filter(F.col(key).isNotNull()), [key], "_rank")
    bounds = rows.agg(F.min(F.unix_date(day)).alias("low"), F.max(F.unix_date(day)).alias("high"))
    last = ranks.agg(F.max("_rank"))
    edges = bounds.select(F.struct("low", "high")).scalar()
    coded = rows.join(ranks, key, "left").withColumns({"_edges": edges, "_last": last.scalar()})
    code = morton(scaled(F.col("_rank"), F.lit(0), F.col("_last")), scaled(F.unix_date(day), F.col("_edges.low"), F.col("_edges.high")))
    return coded.select(*rows.columns, code.alias(alias))


def write_morton(rows: DataFrame, path: str, key: str, day: str, unique: str, distinct: int, row_group: int = ROW_GROUP_BYTES) -> None:
    """Files in Morton order of a key and a date, with a Bloom filter on the key for ``distinct`` keys a row group.

    ``unique`` splits rows of one code over files, so no single task writes a hot key."""
    ordered = with_morton(rows, key, day, "_morton").repartitionByRange("_morton", unique).sortWithinPartitions("_morton").drop("_morton")
    options = {f"parquet.bloom.filter.enabled#{key}": "true", f"parquet.bloom.filter.expected.ndv#{key}": str(distinct), "parquet.block.size": str(row_group)}
    reduce(lambda writer, item: writer.option(*item), options.items(), ordered.write.mode("overwrite")).parquet(path)
