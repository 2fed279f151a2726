"""Order-independent fingerprints of tables, whole and by leaves of a key.

The fingerprint of some rows is their number with the sum and the exclusive or of a hash of
each: any order and any partitioning give the same, a changed, lost or repeated row another
one. Fingerprints of parts add up to that of the whole, so a table is a tree: leaves are hash
buckets of the key, branches group leaves, the root is the whole. Two tables are compared
from the root down, and only rows in leaves that differ are worth a join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LEAVES, BRANCHES = 4096, 64
PARTS = ("Rows", "Sum", "Xor")


def digest(columns: list[Column]) -> Column:
    """60 bits of a row: the head of the MD5 of its cells as text, each with its length, so that
    no two rows read alike. Any engine that has MD5 can take it again."""
    cells = [F.coalesce(F.concat(F.length(c).cast("string"), F.lit(":"), c), F.lit("-")) for c in (c.cast("string") for c in columns)]
    return F.conv(F.substring(F.md5(F.concat(*cells).cast("binary")), 1, 15), 16, 10).cast("bigint")


def row_hash(columns: list[Column]) -> Column:
    """64 bits of a row, for comparisons within the library. NULL differs from any text."""
    return F.xxhash64(*(x for c in columns for x in (c, c.isNull())))


def parts(value: Column) -> list[Column]:
    """The aggregates a fingerprint consists of."""
    return [F.count(value).alias("Rows"), F.coalesce(F.sum(value.cast("decimal(38,0)")), F.lit(0)).cast("decimal(38,0)").alias("Sum"),
            F.coalesce(F.bit_xor(value), F.lit(0)).alias("Xor")]


def text_of(count: Column, total: Column, xor: Column) -> Column:
    """A fingerprint in one word."""
    return F.concat_ws("-", count.cast("string"), F.pmod(total, F.lit(10**18).cast("decimal(38,0)")).cast("string"), xor.cast("string"))


def fingerprint(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """One row, ``Rows, Sum, Xor``, for the whole table."""
    return df.agg(*parts(row_hash([F.col(c) for c in columns or df.columns])))


def leaf(keys: list[str], leaves: int = LEAVES) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(leaves)).cast("int")


def tree(df: DataFrame, keys: list[str], columns: list[str], leaves: int = LEAVES) -> DataFrame:
    """``Leaf, Rows, Sum, Xor``: at most ``leaves`` rows, combined before the shuffle."""
    return df.groupBy(leaf(keys, leaves).alias("Leaf")).agg(*parts(row_hash([F.col(c) for c in columns])))


def branches(leaves: DataFrame, count: int = BRANCHES) -> DataFrame:
    """The level above the leaves, from their fingerprints alone."""
    return leaves.groupBy((F.col("Leaf") % count).alias("Branch")).agg(
        F.sum("Rows").alias("Rows"), F.sum("Sum").cast("decimal(38,0)").alias("Sum"), F.bit_xor("Xor").alias("Xor"))


def _unequal(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    tagged = left.withColumn("_side", F.lit(1)).unionByName(right.withColumn("_side", F.lit(2)))
    sides = tagged.groupBy(key, *PARTS).agg(F.count(F.lit(1)).alias("_n"))
    return sides.filter("_n < 2").select(key).distinct()


def differing(left: DataFrame, right: DataFrame, count: int = BRANCHES) -> DataFrame:
    """``Leaf`` of the leaves that differ: branches first, then the leaves of those that do."""
    bad = _unequal(branches(left, count), branches(right, count), "Branch")
    under = [side.join(bad, F.col("Leaf") % count == F.col("Branch"), "left_semi") for side in (left, right)]
    return _unequal(*under, "Leaf")
