"""Data checks. A check fails with the rows its query returns; no row means it passed."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F


@dataclass(frozen=True)
class Check:
    name: str
    column: str
    rule: Column | None = None          # true for a bad row
    grouped: bool = False               # failures are distinct values, not rows
    repeated: bool = False              # bad values are those seen more than once


def unique(column: str) -> Check:
    """Values that occur more than once; NULLs are ignored."""
    return Check("unique", column, grouped=True, repeated=True)


def not_null(column: str) -> Check:
    return Check("not_null", column, F.col(column).isNull())


def accepted_values(column: str, values: list) -> Check:
    """Distinct values outside the list; NULL is not judged."""
    return Check("accepted_values", column, ~F.col(column).isin(values), grouped=True)


def accepted_range(column: str, low=None, high=None, inclusive: bool = True) -> Check:
    value = F.col(column)
    bad = F.lit(False)
    if low is not None:
        bad = bad | ((value < low) if inclusive else (value <= low))
    if high is not None:
        bad = bad | ((value > high) if inclusive else (value >= high))
    return Check("accepted_range", column, bad)


def no_rows_where(name: str, column: str, rule: Column) -> Check:
    """A free-form test: any row the rule selects is a failure."""
    return Check(name, column, rule)


def offending(df: DataFrame, check: Check) -> DataFrame:
    """What a check complains about: bad rows, or values with their number of rows."""
    if not check.grouped:
        return df.filter(check.rule)
    candidates = df.filter(F.col(check.column).isNotNull() if check.repeated else check.rule)
    counted = candidates.groupBy(check.column).agg(F.count(F.lit(1)).alias("n_records"))
    return counted.filter("n_records > 1") if check.repeated else counted


def run_checks(df: DataFrame, checks: list[Check]) -> DataFrame:
    """One report row per check: ``check, column, failures``.

    All checks share one scan and one shuffle: a row sends an entry only for a rule it breaks, and one for each of its
    values that must be unique, and entries are counted per task before the shuffle, so neither a rule that every row
    breaks nor a value that most rows have makes a large group.
    """
    kinds = {c.column: df.select(c.column).schema[0].dataType for c in checks if c.repeated}   # compared in their own type

    def entry(position: int, check: Check) -> Column:
        text = F.col(check.column).cast("string") if check.grouped and not check.repeated else F.lit(None).cast("string")
        values = [(F.col(name) if check.repeated and name == check.column else F.lit(None).cast(kind)).alias(f"v{i}")
                  for i, (name, kind) in enumerate(kinds.items())]
        hit = F.col(check.column).isNotNull() if check.repeated else check.rule
        return F.when(hit, F.struct(F.lit(position).alias("position"), text.alias("text"), *values))

    def failures(position: int, check: Check) -> Column:
        mine = F.col("position") == position
        if check.grouped:
            return F.count_if(mine & (F.col("n") > 1) if check.repeated else mine)
        return F.coalesce(F.sum(F.when(mine, F.col("n"))), F.lit(0))

    entries = F.array(*[entry(i, check) for i, check in enumerate(checks)])
    found = df.select(F.inline(entries)).filter(F.col("position").isNotNull())
    counted = found.groupBy(*found.columns).agg(F.count(F.lit(1)).alias("n"))
    totals = counted.agg(*[failures(i, check).alias(f"c{i}") for i, check in enumerate(checks)])
    return totals.select(F.inline(F.array(*[
        F.struct(F.lit(check.name).alias("check"), F.lit(check.column).alias("column"), F.col(f"c{i}").alias("failures"))
        for i, check in enumerate(checks)])))


# The two routes of the quality decision.
NORMAL_FLOW = "process_normal_flow"
REPROCESS = "trigger_reprocess_alert"


def verdict(report: DataFrame, tolerance: int = 0) -> DataFrame:
    """The report reduced to one row: total failures and the route they lead to."""
    total = report.agg(F.sum("failures").alias("failures"))
    return total.withColumn(
        "route", F.when(F.col("failures") <= tolerance, F.lit(NORMAL_FLOW)).otherwise(F.lit(REPROCESS)))


def choose_route(report: DataFrame, tolerance: int = 0) -> str:
    """The route as text, for the driver's ``if``: reads the single verdict row."""
    return verdict(report, tolerance).first()["route"]


def write_by_route(df: DataFrame, report: DataFrame, normal_path: str, reprocess_path: str, tolerance: int = 0) -> str:
    """Write the rows where the verdict sends them, and say which route it was."""
    route = choose_route(report, tolerance)
    df.write.mode("overwrite").parquet(normal_path if route == NORMAL_FLOW else reprocess_path)
    return route
