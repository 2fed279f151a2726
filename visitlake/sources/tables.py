"""Declared schemas and typed reads. Nothing is inferred."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

S, I, D = T.StringType(), T.IntegerType(), T.DateType()
MONEY = T.DecimalType(18, 2)


def _schema(**columns) -> T.StructType:
    return T.StructType([T.StructField(name, type_) for name, type_ in columns.items()])


VISIT_KEYS = ["PatientID", "DoctorID", "DepartmentID", "DiagnosisID", "TreatmentID", "PaymentMethodID"]
VISIT_COLUMNS = [
    "VisitID", *VISIT_KEYS, "VisitDate", "VisitTime", "DischargeDate",
    "BillAmount", "InsuranceAmount", "SatisfactionScore", "WaitTimeMinutes",
]

SCHEMAS = {
    "patient_raw": _schema(PatientID=S, FirstName=S, LastName=S, Gender=S, DOB=D, CityStateCountry=S),
    "department_raw": _schema(
        DepartmentID=S, DepartmentName=S, DepartmentCategory=S, Specialization=S, HOD=S
    ),
    "doctor_raw": _schema(DoctorID=S, FirstName=S, LastName=S, Gender=S, ExperienceYears=I),
    "patient": _schema(PatientID=S, FullName=S, Gender=S, DOB=D, City=S, State=S, Country=S),
    "department": _schema(DepartmentID=S, DepartmentName=S, DepartmentCategory=S),
    "doctor": _schema(DoctorID=S, DoctorName=S, Gender=S, ExperienceYears=I),
    "diagnosis": _schema(DiagnosisID=S, DiagnosisName=S),
    "treatment": _schema(TreatmentID=S, TreatmentName=S),
    "payment": _schema(PaymentMethodID=S, PaymentMethod=S),
    "city_alias": _schema(Variant=S, Canonical=S),
    "visits": _schema(
        VisitID=S, **{key: S for key in VISIT_KEYS}, VisitDate=D, VisitTime=S, DischargeDate=D,
        BillAmount=MONEY, InsuranceAmount=MONEY, SatisfactionScore=I, WaitTimeMinutes=I,
    ),
}

# Column order of the exported model tables.
MODEL_COLUMNS = {
    "patient": ["PatientID", "FullName", "Gender", "DOB", "City", "State", "Country"],
    "department": ["DepartmentID", "DepartmentName", "DepartmentCategory"],
    "doctor": ["DoctorID", "DoctorName", "Gender", "ExperienceYears"],
    "diagnosis": ["DiagnosisID", "DiagnosisName"],
    "treatment": ["TreatmentID", "TreatmentName"],
    "payment": ["PaymentMethodID", "PaymentMethod"],
    "visits": VISIT_COLUMNS,
}


def read_table(
    spark: SparkSession, path: str, schema: T.StructType | str, format: str = "parquet"
) -> DataFrame:
    if format == "csv":
        return read_csv(spark, path, schema)
    return spark.read.schema(schema).format(format).load(path)


# How a CSV cell is written and read: with a header, doubled quotes, and all its blanks.
CSV_CELLS = {
    "header": True, "encoding": "UTF-8", "quote": '"', "escape": '"',
    "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False,
}
NO_CELL = "\u0000"  # no cell holds it, so only a cell that is empty and not quoted is NULL


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """A CSV with a header line, its columns found by name wherever they stand. Types come
    from ``schema``; a cell that does not fit its type is NULL. A byte-order mark in front of
    the first name is dropped; a missing column is an error that names it."""
    declared = schema if isinstance(schema, T.StructType) else T.StructType.fromDDL(schema)
    cells = spark.read.options(**CSV_CELLS, multiLine=True, inferSchema=False, nullValue=NO_CELL, emptyValue="").csv(path)
    cells = cells.toDF(*(c.removeprefix("\ufeff") for c in cells.columns))
    missing = [f.name for f in declared if f.name not in cells.columns]
    if missing:
        raise ValueError(f"{path} has no column {', '.join(missing)}")
    return cells.select(*(
        F.col(f"`{f.name}`") if isinstance(f.dataType, T.StringType) else F.col(f"`{f.name}`").try_cast(f.dataType).alias(f.name)
        for f in declared
    ))


def read_export(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return read_csv(spark, path, schema)


def literal_rows(spark: SparkSession, columns: list[str], rows: list[tuple]) -> DataFrame:
    """A handful of fixed rows, generated inside the plan. Their number is known here, so
    joins may broadcast them."""
    structs = [
        F.struct(*(F.lit(value).alias(name) for name, value in zip(columns, row, strict=True)))
        for row in rows
    ]
    return F.broadcast(spark.range(1).select(F.inline(F.array(*structs))))
