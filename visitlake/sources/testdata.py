"""The star seen through the order tables.

One visit is one order line: the customer is the patient, the supplier the doctor,
the part the department (brand as its name, type as its category), the order
priority the payment method. Every proxy column is integer or decimal arithmetic
on the source columns, so any SQL engine reproduces it exactly.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from visitlake.functions.bands import age_band_on, band_birthdays, banded
from visitlake.functions.dates import clock_text
from visitlake.sources.star import LazyTables, Star
from visitlake.sources.tables import VISIT_COLUMNS, literal_rows, read_table

# Satisfaction by wait; the proxy wait runs from 1 to 50.
PROXY_SCORES = [(10, 5), (20, 4), (30, 3), (40, 2), (None, 1)]
# The five order priorities and the payment method each stands for.
PAYMENTS = [
    ("1-URGENT", "Urgent"), ("2-HIGH", "High"), ("3-MEDIUM", "Medium"),
    ("4-NOT SPECIFIED", "Not specified"), ("5-LOW", "Low"),
]
# City spellings that cleaning maps; others are left for the sound-alike check.
CITY_ALIASES = [("Africaa", "Africa"), ("Americaa", "America"), ("Europee", "Europe")]
# Half-open period ranges of the order dates.
PERIODS = [
    ("1995-1996", "1995-01-01", "1997-01-01"),
    ("1997-1998", "1997-01-01", "1999-01-01"),
    ("1999", "1999-01-01", "2000-01-01"),
    ("2000-2001", "2000-01-01", "2002-01-01"),
]
PERIOD_START, PERIOD_END = "1995-01-01", "2002-01-01"
BASE_YEAR, MONTHS, BILL_OFFSET = 1995, 96, 900


# Declared, so that building a plan never opens a file.
TABLES = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
    "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
    "l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return read_table(spark, f"{sf_dir}/{name}.parquet", TABLES[name])


def bill() -> Column:
    return F.col("l_extendedprice").cast("decimal(18,2)")


def insurance() -> Column:
    return (bill() * F.col("l_discount").cast("decimal(4,2)")).cast("decimal(18,2)")


def wait() -> Column:
    return F.col("l_quantity").cast("int")


def _visit_time() -> Column:
    line, part, supplier = F.col("l_linenumber"), F.col("l_partkey"), F.col("l_suppkey")
    return clock_text(F.lit(7) + (line * 7) % 14, (part * 13) % 60, (supplier * 19) % 60)


FROM_LINE = {
    "VisitID": lambda: F.concat_ws("-", "l_orderkey", "l_linenumber"),
    "DoctorID": lambda: F.col("l_suppkey"),
    "DepartmentID": lambda: F.col("l_partkey"),
    "DiagnosisID": lambda: F.col("l_partkey"),
    "TreatmentID": lambda: F.col("l_partkey"),
    "VisitTime": _visit_time,
    "DischargeDate": lambda: F.col("l_shipdate").cast("date"),
    "BillAmount": bill,
    "InsuranceAmount": insurance,
    "SatisfactionScore": lambda: banded(wait(), PROXY_SCORES),
    "WaitTimeMinutes": wait,
}
FROM_ORDER = {
    "PatientID": lambda: F.col("o_custkey"),
    "PaymentMethodID": lambda: F.col("o_orderpriority"),
    "VisitDate": lambda: F.col("o_orderdate").cast("date"),
}
# Dimension columns that depend on the order alone, so they join at order grain.
ORDER_DIMENSIONS = {
    "DOB": ["PatientID"], "PaymentMethod": ["PaymentMethodID"], "AgeBand": ["PatientID", "VisitDate"],
}


def visits(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    """The fact, joining the order header only when one of its columns is wanted."""
    columns = columns or tuple(VISIT_COLUMNS)
    lines = table(spark, sf_dir, "lineitem")
    headers = [c for c in columns if c not in FROM_LINE]
    if not headers:
        return lines.select(*(FROM_LINE[c]().alias(c) for c in columns))
    plain = dict.fromkeys(source for c in headers for source in ORDER_DIMENSIONS.get(c, [c]))
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("l_orderkey"), *(FROM_ORDER[c]().alias(c) for c in plain)
    )
    if "DOB" in headers or "AgeBand" in headers:
        until = {name: column for name, column in band_birthdays(F.col("DOB")).items() if "AgeBand" in headers}
        orders = orders.join(patients(spark, sf_dir).withColumns(until), "PatientID", "left")
    if "AgeBand" in headers:
        orders = orders.withColumn("AgeBand", age_band_on(F.col("VisitDate")))
    if "PaymentMethod" in headers:
        orders = orders.join(payments(spark), "PaymentMethodID", "left")
    # A left join keeps every line, and never makes the lines the broadcast side. Columns of a line are made
    # after it: each source column is shuffled once, however many columns come from it.
    joined = lines.join(orders.select("l_orderkey", *headers), "l_orderkey", "left")
    return joined.select(*(FROM_LINE[c]().alias(c) if c in FROM_LINE else F.col(c) for c in columns))


def birth_date(key: Column) -> Column:
    return F.date_add(F.lit("1935-01-01").cast("date"), ((key * 7919) % 25000).cast("int"))


def patients(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("c_custkey")
    return table(spark, sf_dir, "customer").select(key.alias("PatientID"), birth_date(key).alias("DOB"))


def doctors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("DoctorID"), F.col("s_name").alias("DoctorName")
    )


def departments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("DepartmentID"),
        F.col("p_brand").alias("DepartmentName"),
        F.col("p_type").alias("DepartmentCategory"),
    )


def diagnoses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("DiagnosisID"), F.col("p_brand").alias("DiagnosisName")
    )


def treatments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("TreatmentID"), F.col("p_type").alias("TreatmentName")
    )


def payments(spark: SparkSession) -> DataFrame:
    return literal_rows(spark, ["PaymentMethodID", "PaymentMethod"], PAYMENTS)


def city_aliases(spark: SparkSession) -> DataFrame:
    return literal_rows(spark, ["Variant", "Canonical"], CITY_ALIASES)


def star(spark: SparkSession, sf_dir: str) -> Star:
    dims = {
        "patient": lambda: patients(spark, sf_dir),
        "doctor": lambda: doctors(spark, sf_dir),
        "department": lambda: departments(spark, sf_dir),
        "diagnosis": lambda: diagnoses(spark, sf_dir),
        "treatment": lambda: treatments(spark, sf_dir),
        "payment": lambda: payments(spark),
    }
    return Star(
        lambda *columns: visits(spark, sf_dir, *columns), LazyTables(dims), attached=set(ORDER_DIMENSIONS)
    )


def raw_patients(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers dirtied by rules on their key: blanks, mixed case, misspelt cities,
    unknown genders, missing dates and locations with too few or too many parts."""
    key = F.col("c_custkey")
    region = F.concat(
        F.substring("r_name", 1, 1), F.lower(F.expr("substring(r_name, 2)"))
    )
    last_letter = F.expr("lower(right(r_name, 1))")
    city = F.when(key % 50 == 7, F.concat(region, last_letter)).otherwise(region)
    customers = table(spark, sf_dir, "customer")
    nations = table(spark, sf_dir, "nation").join(
        table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey")
    )
    joined = customers.join(nations, F.col("c_nationkey") == F.col("n_nationkey"))
    blanks = F.repeat(F.lit(" "), (key % 4).cast("int"))
    return joined.select(
        key.alias("PatientID"),
        F.when(key % 41 == 0, F.lit("   "))
        .when(key % 3 == 0, F.concat(blanks, F.lower("c_mktsegment")))
        .otherwise(F.concat(blanks, F.col("c_mktsegment")))
        .alias("FirstName"),
        F.concat(F.lit("  "), F.upper("c_name"), blanks).alias("LastName"),
        F.when(key % 53 == 0, F.lit("X"))
        .when(key % 59 == 0, F.lit(None).cast("string"))
        .when(key % 4 == 0, F.lit("M"))
        .when(key % 4 == 1, F.lit(" female "))
        .when(key % 4 == 2, F.lit("Male"))
        .otherwise(F.lit("f"))
        .alias("Gender"),
        F.when(key % 61 != 0, birth_date(key)).alias("DOB"),
        F.when(key % 73 == 0, F.lit(None).cast("string"))
        .when(key % 67 == 0, F.concat(city, F.lit(", "), F.col("n_name")))
        .when(key % 71 == 0, F.concat(F.lit("Ward 9, "), city, F.lit(", "), F.col("n_name"), F.lit(", "), F.col("r_name")))
        .otherwise(F.concat(city, F.lit(", "), F.col("n_name"), F.lit(" ,"), F.col("r_name")))
        .alias("CityStateCountry"),
    )


def raw_departments(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("p_partkey")
    return table(spark, sf_dir, "part").select(
        key.alias("DepartmentID"),
        F.concat(F.lit("Dept- "), F.col("p_brand")).alias("DepartmentName"),
        F.when(key % 43 != 0, F.concat(F.lit(" "), F.col("p_type"))).alias("DepartmentCategory"),
        F.when(key % 47 == 0, F.lit("  "))
        .otherwise(F.concat(F.col("p_brand"), F.lit("  ")))
        .alias("Specialization"),
    )
