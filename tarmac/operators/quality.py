"""Data-quality checks on the staging table and the deduplicated table.

Each check returns the rows that violate it (a check passes at zero rows).
The report computes every row-level check of the staging table in a single
aggregation pass (``count_if`` per check) and the uniqueness check in one
grouped pass, then unpivots the counts into one row per check.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Staging columns that must never be null.
NOT_NULL_COLUMNS = (
    "unique_row_id", "year", "month", "reporting_period_date", "reporting_airport",
    "origin_destination_country", "origin_destination", "airline_name",
    "number_flights_matched",
)
# Count columns that must not be negative.
NON_NEGATIVE_COLUMNS = (
    "number_flights_matched", "actual_flights_unmatched",
    "planned_flights_unmatched", "number_flights_cancelled",
)
# Percentages that must lie in 0..100.
PERCENT_COLUMNS = (
    "flights_cancelled_percent", "flights_unmatched_percent",
    "more_than_360_mins_late_percent",
)


def _any(preds: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, preds)


def non_negative_violation() -> Column:
    """True when a count is negative (null counts pass, as in SQL)."""
    return F.coalesce(_any([F.col(c) < 0 for c in NON_NEGATIVE_COLUMNS]), F.lit(False))


def percent_violation() -> Column:
    """True when a percentage is outside 0..100. NaN is turned into null at
    normalisation, so it never reaches this comparison."""
    return F.coalesce(_any([(F.col(c) < 0) | (F.col(c) > 100) for c in PERCENT_COLUMNS]),
                      F.lit(False))


def violations_non_negative(stg: DataFrame) -> DataFrame:
    return stg.filter(non_negative_violation())


def violations_percent_bounds(stg: DataFrame) -> DataFrame:
    return stg.filter(percent_violation())


def check_not_null(df: DataFrame, cols: tuple[str, ...] = NOT_NULL_COLUMNS) -> DataFrame:
    """(column_name, failing_rows): null count per column, one pass."""
    counts = df.agg(*[F.count_if(F.col(f"`{c}`").isNull()).alias(c) for c in cols])
    return counts.unpivot([], list(cols), "column_name", "failing_rows")


def duplicate_keys(df: DataFrame, cols: tuple[str, ...] = ("unique_row_id",)) -> DataFrame:
    """Key values that occur more than once (null keys are not compared),
    with their row count ``n``. Partial aggregation makes a key holding a
    third of the rows one partial count per map task."""
    keyed = df.filter(reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in cols]))
    return (keyed.groupBy(*cols).agg(F.count(F.lit(1)).alias("n"))
            .filter(F.col("n") > 1))


def dq_report(stg: DataFrame, sch: DataFrame, quarantine: DataFrame | None = None) -> DataFrame:
    """One row per check: ``check_name``, ``failing_rows``, ``status``.

    Staging checks share one aggregation pass; the deduplicated table gets a
    not-null pass and a duplicate-key pass. Rows that a load quarantined, if
    given, are a check of their own."""
    rows = [_long(stg.agg(*staging_checks())), _long(sch.agg(*scheduled_checks()))]
    return _report(rows, sch, quarantine)


def staging_checks() -> list[Column]:
    """The row-level checks of the staging table, each a count of failing rows."""
    return [*[F.count_if(F.col(f"`{c}`").isNull()).alias(f"not_null_stg_{c}") for c in NOT_NULL_COLUMNS],
            F.count_if(non_negative_violation()).alias("non_negative_counts"),
            F.count_if(percent_violation()).alias("percent_bounds")]


def scheduled_checks() -> list[Column]:
    """The row-level checks of the deduplicated table."""
    return [F.count_if(F.col("unique_row_id").isNull()).alias("not_null_int_unique_row_id")]


def dq_report_of_build(counted: DataFrame, sch: DataFrame, quarantine: DataFrame | None = None) -> DataFrame:
    """The report of a build that counted its row-level checks (check_name,
    failing_rows) while it wrote its tables: only the keys are read again."""
    return _report([counted.select("check_name", "failing_rows")], sch, quarantine)


def _long(counts: DataFrame) -> DataFrame:
    return counts.unpivot([], counts.columns, "check_name", "failing_rows")


def _report(rows: list[DataFrame], sch: DataFrame, quarantine: DataFrame | None) -> DataFrame:
    rows = [*rows, _long(duplicate_keys(sch).agg(F.count(F.lit(1)).alias("unique_int_unique_row_id")))]
    if quarantine is not None:
        rows.append(_long(quarantine.agg(F.count(F.lit(1)).alias("quarantined_rows"))))
    return reduce(DataFrame.unionByName, rows).withColumn(
        "status", F.when(F.col("failing_rows") == 0, F.lit("pass")).otherwise(F.lit("fail")))


class DataQualityError(RuntimeError):
    """At least one check of a data-quality report failed."""


def dq_gate(report: DataFrame) -> DataFrame:
    """The report, if all its checks pass; else the run stops with the names
    and numbers of the failing ones. A report has one row per check, so its
    rows are what is returned: the checks run once."""
    rows = report.collect()
    failed = sorted((r for r in rows if r["status"] == "fail"), key=lambda r: r["check_name"])
    if failed:
        raise DataQualityError(", ".join(f"{r['check_name']}: {r['failing_rows']} rows" for r in failed))
    return report.sparkSession.createDataFrame(rows, report.schema)
