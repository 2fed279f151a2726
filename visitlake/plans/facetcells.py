"""Facet cells: the fact summed up once, so that any cross-filter is answered without it.

A cell is one combination of the facets' members and the day type. Sums add up over cells;
patients do not, so each cell also holds a set of them. Patients have dense codes, and a set
is one row for each word of 64 codes: a bit for each patient seen in the cell, and a second
bit for those seen there more than once. Sets of any cells merge word by word, exactly: a
patient is in the union if in one of them, and comes again if twice in one or once in two.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from visitlake.operators.relational import apply_filters
from visitlake.operators.windows import dense_index
from visitlake.plans.measures import visits_in
from visitlake.session import stored
from visitlake.sources.star import Star

FACETS = {
    "department": "DepartmentName",
    "payment": "PaymentMethod",
    "age": "AgeBand",
    "month": "YearMonth",
}
MEMBERS = [*FACETS.values(), "DayType"]
SUMS = {"Visits": None, "Revenue": "BillAmount", "WaitMinutes": "WaitTimeMinutes", "Scores": "SatisfactionScore"}
WORD_BITS = 64
REPEAT = 2  # visits that make a patient a repeat patient


def _year() -> Column:
    return F.substring("YearMonth", 1, 4).cast("int")


def _place(code: Column, patient: Column) -> tuple[Column, Column]:
    """The word a patient's bit is in, and the bit. A patient that no dimension row knows has
    a word of its own below zero, all visits without a patient have one together."""
    unknown = F.when(patient.isNull(), F.lit(-1).cast("bigint")).otherwise(
        -F.shiftrightunsigned(F.xxhash64(patient), 1) - 2)
    word = F.when(code.isNotNull(), F.floor(code / WORD_BITS)).otherwise(unknown)
    shift = F.when(code.isNotNull(), code % WORD_BITS).otherwise(0).cast("int")
    return word.cast("bigint"), F.call_function("shiftleft", F.lit(1).cast("bigint"), shift)


def merged(sets: Column) -> Column:
    """Union of an array of ``(once, twice)`` words."""
    start = F.struct(F.lit(0).cast("bigint").alias("once"), F.lit(0).cast("bigint").alias("twice"))
    return F.aggregate(sets, start, lambda a, x: F.struct(
        a["once"].bitwiseOR(x["once"]).alias("once"),
        a["twice"].bitwiseOR(x["twice"]).bitwiseOR(a["once"].bitwiseAND(x["once"])).alias("twice"),
    ))


@dataclass(frozen=True)
class FacetCells:
    """``cells``: members and sums. ``sets``: members, ``word``, ``once``, ``twice``."""

    cells: DataFrame
    sets: DataFrame

    @classmethod
    def build(cls, star: Star, folder: str | None = None) -> FacetCells:
        """Reads the fact once. Visits shrink to one row per cell and patient before codes are joined."""
        rows = visits_in(star, [*MEMBERS, "PatientID", *filter(None, SUMS.values())], {})
        sums = [(F.sum(c) if c else F.count(F.lit(1))).alias(name) for name, c in SUMS.items()]
        by_patient = rows.groupBy(*MEMBERS, "PatientID").agg(*sums)
        codes = dense_index(star.dims["patient"], ["PatientID"], "_code")
        word, bit = _place(F.col("_code"), F.col("PatientID"))
        placed = by_patient.join(codes, "PatientID", "left").withColumns({"word": word, "_bit": bit})
        sets = placed.groupBy(*MEMBERS, "word").agg(
            *(F.sum(name).alias(name) for name in SUMS), F.bit_or("_bit").alias("once"),
            F.coalesce(F.bit_or(F.when(F.col("Visits") >= REPEAT, F.col("_bit"))), F.lit(0)).cast("bigint").alias("twice"),
        )
        sets = stored(sets, folder and f"{folder}/sets")
        cells = stored(sets.groupBy(*MEMBERS).agg(*(F.sum(name).alias(name) for name in SUMS)), folder and f"{folder}/cells")
        return cls(cells, sets)

    @classmethod
    def read(cls, spark: SparkSession, folder: str) -> FacetCells:
        return cls(spark.read.parquet(f"{folder}/cells"), spark.read.parquet(f"{folder}/sets"))

    @staticmethod
    def answers(filters: dict) -> bool:
        """Whether filters are on members only."""
        return set(filters) <= {*MEMBERS, "Year"}

    @staticmethod
    def _picked(df: DataFrame, filters: dict) -> DataFrame:
        years = filters.get("Year") or []
        df = apply_filters(df, {c: v for c, v in filters.items() if c != "Year"})
        return df.filter(_year().isin(list(years))) if years else df

    def by(self, *members: str) -> DataFrame:
        """Sums per member of one or several facets, or per ``Year``."""
        return self.cells.withColumn("Year", _year()).groupBy(*members).agg(*(F.sum(name).alias(name) for name in SUMS))

    def picked(self, filters: dict) -> DataFrame:
        return self._picked(self.cells, filters)

    def patients(self, filters: dict) -> DataFrame:
        """One row: patients of the filtered visits, and those with more than one of them.

        A list holds a word's cells, of which there are at most as many as cells."""
        words = self._picked(self.sets, filters).groupBy("word").agg(
            merged(F.collect_list(F.struct("once", "twice"))).alias("all"))
        return words.agg(
            F.coalesce(F.sum(F.bit_count("all.once")), F.lit(0)).alias("Patients"),
            F.coalesce(F.sum(F.bit_count("all.twice")), F.lit(0)).alias("RepeatPatients"),
        )
