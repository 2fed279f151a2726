"""Helpers the text operators share."""

from __future__ import annotations

import hashlib
import os
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from visitlake.session import stored

__all__ = ["fewer", "importable", "line_key", "narrow", "read", "sha256_hex", "stored", "unused"]
ROOT = str(Path(__file__).resolve().parents[2])


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def importable(df: DataFrame) -> DataFrame:
    """Lets Python workers find this package where the driver has it (on a cluster it is
    installed on every machine or sent along with ``--py-files``)."""
    environment = df.sparkSession.sparkContext.environment
    paths = [p for p in environment.get("PYTHONPATH", "").split(os.pathsep) if p]
    if ROOT not in paths:
        environment["PYTHONPATH"] = os.pathsep.join([*paths, ROOT])
    return df


def narrow(df: DataFrame, **columns: str) -> DataFrame:
    """Only the named columns, under the operator's own names, so that whatever else the
    table carries cannot clash with a column the operator adds."""
    return df.select(*[F.col(f"`{theirs}`").alias(ours) for ours, theirs in columns.items()])


def unused(df: DataFrame, *names: str) -> list[str]:
    """The names, with as many underscores in front as no column of the table has."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        out.append(name)
    return out


def fewer(df: DataFrame, rows: int, at_once: int) -> DataFrame:
    """The table, in no more partitions than ``rows`` rows (as many as it can have) fill with ``at_once``
    each: what many tasks make of few rows is stored in a few files, not in one for each task."""
    return df.coalesce(1 + rows // at_once)


def line_key(text: Column) -> list[Column]:
    """128 bits of a string as two longs: two seeds, so the halves are independent."""
    return [F.xxhash64(text).alias("h1"), F.xxhash64(F.lit(1), text).alias("h2")]


def sha256_hex(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()
