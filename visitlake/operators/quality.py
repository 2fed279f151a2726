"""Declarative data-quality rules.

All row rules of a table are counted in one scan; ``profile`` adds its keys to the same scan.
Results are one row per rule: ``(CheckID, Severity, Violations, Sample, Passed)``.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from visitlake.operators.relational import union_periods

#: Spellings shown of a phonetic code, and the slices its spellings are dealt into to find them.
SHOWN, SLICES = 100, 64

@dataclass(frozen=True)
class Rule:
    """``broken`` marks a violating row; NULL counts as fine, as in a CHECK."""

    id: str
    broken: Column
    severity: str = "error"


class QualityError(RuntimeError):
    pass


def _result(df: DataFrame, id_: str, violations: Column, sample: Column, severity: str = "error") -> DataFrame:
    return df.select(
        F.lit(id_).alias("CheckID"), F.lit(severity).alias("Severity"),
        violations.cast("bigint").alias("Violations"), sample.cast("string").alias("Sample"),
        (violations == 0).alias("Passed"),
    )


def row_rules(df: DataFrame, rules: list[Rule], key: str) -> DataFrame:
    """Counts each rule's violating rows and keeps the smallest violating key."""
    aggregates = []
    for i, rule in enumerate(rules):
        aggregates.append(F.count_if(rule.broken).alias(f"_n{i}"))
        aggregates.append(F.min(F.when(rule.broken, F.col(key))).cast("string").alias(f"_s{i}"))
    rows = [
        F.struct(
            F.lit(rule.id).alias("CheckID"), F.lit(rule.severity).alias("Severity"),
            F.col(f"_n{i}").alias("Violations"), F.col(f"_s{i}").alias("Sample"),
            (F.col(f"_n{i}") == 0).alias("Passed"),
        )
        for i, rule in enumerate(rules)
    ]
    return df.agg(*aggregates).select(F.inline(F.array(*rows)))


def unique_key(df: DataFrame, key: str, check_id: str) -> DataFrame:
    """Keys held by more than one row."""
    repeated = df.groupBy(key).agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1")
    found = repeated.agg(F.count(F.lit(1)).alias("_v"), F.min(key).alias("_s"))
    return _result(found, check_id, F.col("_v"), F.col("_s"))


#: Kinds of keys that are counted as numbers.
WHOLE = ("tinyint", "smallint", "int", "bigint")


def profile(
    facts: DataFrame, key: str, rules: list[Rule] = (), unique: bool = False, dims: dict[str, DataFrame] | None = None
) -> DataFrame:
    """Row rules, the unique ``key`` and the foreign keys of a fact in one scan and one shuffle.

    Every row lists what it is asked about: its own key, its foreign keys, and its key once more for
    each rule it breaks. An entry is the number of its check and the value, as a whole number where both sides
    have one. Equal entries combine before the shuffle, so a key value that a third of all rows hold leaves each
    task as one row. The dimensions' keys are entries of the same grouping, so no join follows it.
    """
    dims, kinds = dims or {}, dict(facts.dtypes)
    every = [(rule.id, rule.severity) for rule in rules] + [(f"unique {key}", "error")] * unique + [(f"orphan {name}", "error") for name in dims]
    first_dim = len(rules) + unique
    whole = {name: kinds[name] in WHOLE and dict(dim.dtypes)[name] in WHOLE for name, dim in dims.items()}
    own_whole = kinds[key] in WHOLE

    def entry(check: int, value: Column, as_number: bool) -> list[Column]:
        text, number = (F.lit(None), value) if as_number else (value, F.lit(None))
        return [F.lit(check).alias("_check"), text.cast("string").alias("_text"), number.cast("bigint").alias("_number")]

    own = lambda check: F.struct(*entry(check, F.col(key), own_whole))
    asked = [own(len(rules))] * unique + [F.struct(*entry(first_dim + i, F.col(name), whole[name])) for i, name in enumerate(dims)]
    broken = [F.when(F.coalesce(rule.broken, F.lit(False)), own(i)) for i, rule in enumerate(rules)]
    items = F.concat(F.array(*asked), F.array_compact(F.array(*broken))) if asked and broken else (
        F.array(*asked) if asked else F.array_compact(F.array(*broken)))
    entries = facts.select(F.inline(items)).select("*", F.lit(1).alias("_n"), F.lit(0).alias("_known"))
    known = [dim.filter(F.col(name).isNotNull()).select(*entry(first_dim + i, F.col(name), whole[name]), F.lit(0).alias("_n"), F.lit(1).alias("_known"))
             for i, (name, dim) in enumerate(dims.items())]
    counted = union_periods([entries, *known]).groupBy("_check", "_text", "_number").agg(
        F.sum("_n").alias("_n"), F.max("_known").alias("_known"))
    repeated = (F.col("_check") == len(rules)) & F.lit(unique)
    found = F.when(F.col("_known") == 1, 0).when(repeated, F.when(F.col("_n") > 1, 1).otherwise(0)).otherwise(F.col("_n"))
    # A number that is compared as a text still stands in the order of numbers.
    ordered = [i for i, name in enumerate([key] * first_dim + list(dims)) if kinds[name] in WHOLE or kinds[name].startswith("decimal")]
    number = F.when(F.col("_check").isin(ordered), F.coalesce(F.col("_number"), F.col("_text").try_cast("decimal(38,0)"))) if ordered else F.lit(None)
    shown = F.coalesce(F.col("_text"), F.col("_number").cast("string"))
    value = F.when(shown.isNotNull(), F.struct(number.cast("decimal(38,0)").alias("_number"), shown.alias("_text")))
    checked = counted.select("_check", found.cast("bigint").alias("_v"), value.alias("_s")).filter("_v > 0")
    totals = checked.groupBy("_check").agg(F.sum("_v").alias("_v"), F.min("_s").alias("_s"))
    listed = facts.sparkSession.range(1).select(F.inline(F.array(*(
        F.struct(F.lit(i).alias("_place"), F.lit(name).alias("_name"), F.lit(severity).alias("_severity")) for i, (name, severity) in enumerate(every)))))
    results = listed.join(totals, F.col("_place") == F.col("_check"), "left")
    violations = F.coalesce("_v", F.lit(0)).cast("bigint")
    return results.select(F.col("_name").alias("CheckID"), F.col("_severity").alias("Severity"), violations.alias("Violations"),
                          F.col("_s._text").alias("Sample"), (violations == 0).alias("Passed"))


def orphans(visits: Callable[..., DataFrame], dims: dict[str, DataFrame]) -> DataFrame:
    """Fact rows per foreign key that no dimension row answers, with the smallest such key.

    ``visits(*columns)`` gives the fact cut to those columns; it is read once for all keys.
    """
    first = next(iter(dims))
    return profile(visits(*dims), first, dims=dims)


def expected_counts(actual: DataFrame, expected: DataFrame, label: str) -> DataFrame:
    """Compares two ``(label, RowCount)`` tables; the violation is the difference."""
    pairs = actual.select(F.col(label).alias("_label"), F.col("RowCount").alias("_a")).join(
        expected.select(F.col(label).alias("_label"), F.col("RowCount").alias("_e")), "_label", "full"
    )
    off = F.abs(F.coalesce("_a", F.lit(0)) - F.coalesce("_e", F.lit(0)))
    sample = F.when(off > 0, F.concat_ws(" of ", F.coalesce("_a", F.lit(0)), F.coalesce("_e", F.lit(0))))
    return pairs.select(
        F.concat(F.lit("rows "), F.col("_label")).alias("CheckID"), F.lit("error").alias("Severity"),
        off.cast("bigint").alias("Violations"), sample.alias("Sample"), (off == 0).alias("Passed"),
    )


def spellings(df: DataFrame, column: str) -> DataFrame:
    """``Code, Spelling``: every distinct spelling with its phonetic code, in long form."""
    distinct = df.select(F.col(column).alias("Spelling")).distinct()
    return distinct.select(F.soundex("Spelling").alias("Code"), "Spelling")


def soundalikes(df: DataFrame, column: str) -> DataFrame:
    """Groups of distinct spellings that share a phonetic code: how many, and the first ``SHOWN`` of them.

    The first ones of a code are found in slices of its spellings and then among those of the
    slices, so no task lists a whole group; ``spellings`` has all of them.
    """
    slices = Window.partitionBy("Code", F.pmod(F.xxhash64("Spelling"), F.lit(SLICES))).orderBy("Spelling")
    whole = Window.partitionBy("Code").orderBy("Spelling")
    every = spellings(df, column)
    counts = every.groupBy("Code").agg(F.count(F.lit(1)).alias("Spellings")).filter("Spellings > 1")
    first = every.withColumn("_i", F.row_number().over(slices)).filter(F.col("_i") <= SHOWN)
    first = first.withColumn("_i", F.row_number().over(whole)).filter(F.col("_i") <= SHOWN)
    shown = first.groupBy(F.col("Code").alias("_code")).agg(F.sort_array(F.collect_list("Spelling")).alias("_shown"))
    more = F.when(F.col("Spellings") > SHOWN, F.lit(" / …")).otherwise("")
    return counts.join(shown, F.col("Code").eqNullSafe(F.col("_code"))).select(
        "Code", "Spellings", F.concat(F.array_join("_shown", " / "), more).alias("Collision"))


def soundalike_check(df: DataFrame, column: str, check_id: str) -> DataFrame:
    """Counts the groups and shows the first; ``soundalikes`` lists them all."""
    found = soundalikes(df, column).agg(F.count(F.lit(1)).alias("_v"), F.min("Collision").alias("_s"))
    return _result(found, check_id, F.col("_v"), F.col("_s"))


def leftover_variants(df: DataFrame, column: str, alias: DataFrame, check_id: str) -> DataFrame:
    """Rows that still carry a spelling the alias table should have mapped."""
    left = df.join(alias.select(F.col("Variant").alias(column)), column, "left_semi")
    found = left.agg(F.count(F.lit(1)).alias("_v"), F.min(column).alias("_s"))
    return _result(found, check_id, F.col("_v"), F.col("_s"))


def enforce(results: DataFrame) -> None:
    """Fails fast when an error rule is broken. Reads one row per rule."""
    broken = results.filter("not Passed and Severity = 'error'").collect()
    if broken:
        lines = [f"{r.CheckID}: {r.Violations} violations (e.g. {r.Sample})" for r in broken]
        raise QualityError("; ".join(sorted(lines)))
