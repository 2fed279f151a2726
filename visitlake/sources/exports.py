"""CSV and table exports with a record of what was written."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from visitlake.operators import fingerprint
from visitlake.sources.tables import CSV_CELLS, MODEL_COLUMNS, read_export


def model_table(df: DataFrame, name: str) -> DataFrame:
    """A model table in its exported shape: fixed columns, ordered by key."""
    columns = MODEL_COLUMNS[name]
    return df.select(*columns).orderBy(columns[0])


@dataclass(frozen=True)
class Written:
    """What went into an output: its rows, and a fingerprint of their cells."""

    rows: int
    fingerprint: str


def export_csv(df: DataFrame, path: str, order_by: list[str] = ()) -> Written:
    """A folder of CSV files with headers, without loss: NULL is an empty cell and an empty
    text a quoted one, quotes are doubled, blanks and line breaks stay. Files follow the
    sort order when one is given. Rows are counted and fingerprinted while they are written."""
    seen = Observation()
    ordered = df.orderBy(*order_by) if order_by else df
    ordered = ordered.observe(seen, *fingerprint.parts(fingerprint.digest([F.col(f"`{c}`") for c in df.columns])))
    ordered.write.mode("overwrite").options(**CSV_CELLS, emptyValue='""', nullValue="").csv(path)
    found = seen.get
    return Written(found["Rows"], f"{found['Rows']}-{int(found['Sum']) % 10**18}-{found['Xor']}")


def fingerprint_of(df: DataFrame) -> str:
    """The fingerprint an export of ``df`` has, taken in a read of its own."""
    taken = df.agg(*fingerprint.parts(fingerprint.digest([F.col(f"`{c}`") for c in df.columns])))
    return taken.select(fingerprint.text_of(F.col("Rows"), F.col("Sum"), F.col("Xor")).alias("text")).first().text


def export_all(results: dict[str, DataFrame], folder: str, source: str) -> DataFrame:
    """Exports every result under its own name and returns the manifest: one row per
    output with the rows written and their fingerprint."""
    written = {name: export_csv(df, f"{folder}/{name}") for name, df in results.items()}
    spark = next(iter(results.values())).sparkSession
    return manifest(spark, written, source)


def manifest(spark: SparkSession, written: dict[str, Written], source: str) -> DataFrame:
    rows = [(name, w.rows, w.fingerprint, source, "visitlake") for name, w in written.items()]
    return spark.createDataFrame(rows, "Output string, RowCount long, Fingerprint string, Source string, Producer string")


def altered(manifest: DataFrame, folder: str, schemas: dict[str, StructType]) -> DataFrame:
    """``Output, Expected, Actual`` of the outputs of a manifest whose files hold other cells than were written."""
    spark = manifest.sparkSession
    found = [(name, fingerprint_of(read_export(spark, f"{folder}/{name}", schema))) for name, schema in schemas.items()]
    actual = spark.createDataFrame(found, "Output string, Actual string")
    return manifest.join(actual, "Output").filter("Fingerprint <> Actual").select("Output", F.col("Fingerprint").alias("Expected"), "Actual")


def write_manifest(rows: DataFrame, path: str) -> None:
    rows.write.mode("append").parquet(path)


def save_as(df: DataFrame, name: str) -> DataFrame:
    """Creates a table from a query."""
    df.write.mode("overwrite").saveAsTable(name)
    return df.sparkSession.table(name)


def round_trip(spark: SparkSession, df: DataFrame, path: str) -> DataFrame:
    export_csv(df, path)
    return read_export(spark, path, df.schema)
