"""The star: a fact of visits and the dimensions its keys point at."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from visitlake.functions.bands import AGE_BANDS, age_band, age_band_on, band_birthdays, band_order
from visitlake.functions.dates import CALENDAR, age_at
from visitlake.functions.text import full_name
from visitlake.sources.tables import MODEL_COLUMNS, VISIT_COLUMNS

# Dimension -> the fact column that refers to it.
DIMENSION_KEYS = {
    "patient": "PatientID",
    "doctor": "DoctorID",
    "department": "DepartmentID",
    "diagnosis": "DiagnosisID",
    "treatment": "TreatmentID",
    "payment": "PaymentMethodID",
}
AGE_COLUMNS = {"AgeAtVisit", "AgeBand", "AgeBandOrder"}


def with_doctor_names(doctor_raw: DataFrame) -> DataFrame:
    return doctor_raw.withColumn("DoctorName", full_name(F.col("FirstName"), F.col("LastName")))


def with_age_columns(df: DataFrame) -> DataFrame:
    """Adds the three age columns to rows that carry ``DOB`` and ``VisitDate``."""
    df = df.withColumn("AgeAtVisit", age_at(F.col("DOB"), F.col("VisitDate")))
    df = df.withColumn("AgeBand", age_band(F.col("AgeAtVisit")))
    return df.withColumn("AgeBandOrder", band_order(F.col("AgeBand"), AGE_BANDS))


class LazyTables(Mapping):
    """Tables built the first time they are asked for."""

    def __init__(self, builders: dict[str, Callable[[], DataFrame]]):
        self._builders, self._built = builders, {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._built:
            self._built[name] = self._builders[name]()
        return self._built[name]

    def __iter__(self) -> Iterator[str]:
        return iter(self._builders)

    def __len__(self) -> int:
        return len(self._builders)


@dataclass
class Star:
    """``visits(*columns)`` returns the fact cut down to those columns; a source that
    assembles the fact from several tables then joins only what is asked for. Dimension
    columns it can attach more cheaply itself are listed in ``attached``."""

    visits: Callable[..., DataFrame]
    dims: Mapping[str, DataFrame]
    attached: set[str] = field(default_factory=set)

    @classmethod
    def of(cls, visits: DataFrame, **dims: DataFrame) -> Star:
        return cls(lambda *columns: visits.select(*columns), dims)

    def owner(self, column: str) -> str | None:
        """The dimension that supplies ``column``, if it is not a fact column."""
        if column in VISIT_COLUMNS or column in self.attached:
            return None
        known = (name for name in self.dims if column in MODEL_COLUMNS.get(name, ()))
        return next(known, None) or next((n for n, dim in self.dims.items() if column in dim.columns), None)

    def flat(self, *columns: str) -> DataFrame:
        """One row per visit with any mix of fact, calendar, age and dimension columns.

        Dimensions are left-joined on their unique keys and only when one of their
        columns is wanted. No broadcast is forced: Catalyst picks it from the size of
        the dimension, and a large one is shuffled with adaptive skew splitting.
        """
        wanted = list(dict.fromkeys(columns))
        ages = AGE_COLUMNS.intersection(wanted) - self.attached
        banded = "AgeBand" in ages and "AgeAtVisit" not in ages
        fact, per_dim = [], {"patient": []} if banded else {}
        for column in [*wanted, *(["DOB"] if ages and not banded else [])]:
            if column in ages or (column in CALENDAR and column not in self.attached):
                fact.append("VisitDate")
                continue
            owner = self.owner(column)
            if owner is None:
                fact.append(column)
            else:
                per_dim.setdefault(owner, []).append(column)
        fact.extend(DIMENSION_KEYS[name] for name in per_dim)
        df = self.visits(*dict.fromkeys(fact))
        for name, extra in per_dim.items():
            key, dim = DIMENSION_KEYS[name], self.dims[name]
            until = band_birthdays(F.col("DOB")) if banded and name == "patient" else {}
            extra = [*dict.fromkeys(extra), *(column.alias(c) for c, column in until.items())]
            df = df.join(dim.select(key, *extra), key, "left")
        if banded:
            df = df.withColumn("AgeBand", age_band_on(F.col("VisitDate")))
            df = df.withColumn("AgeBandOrder", band_order(F.col("AgeBand"), AGE_BANDS))
        elif ages:
            df = with_age_columns(df)
        own = [c for c in wanted if c in CALENDAR and c not in self.attached]
        df = df.withColumns({c: CALENDAR[c](F.col("VisitDate")) for c in own})
        return df.select(*wanted)
