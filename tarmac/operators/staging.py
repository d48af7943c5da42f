"""Staging and deduplication: surrogate key, first-of-month date, the fixed
staging projection, the scheduled subset and one row per key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Surrogate-key inputs, concatenated in this order with no
# delimiter; nulls count as empty text.
KEY_COLUMNS = (
    "month", "year", "reporting_airport", "origin_destination",
    "airline_name", "scheduled_charter",
)

# The staging table's columns, in order, with their types.
STAGING_COLUMNS = (
    ("unique_row_id", "string"),
    ("year", "int"),
    ("month", "int"),
    ("reporting_period_date", "date"),
    ("reporting_airport", "string"),
    ("origin_destination_country", "string"),
    ("origin_destination", "string"),
    ("airline_name", "string"),
    ("scheduled_charter", "string"),
    ("number_flights_matched", "bigint"),
    ("actual_flights_unmatched", "bigint"),
    ("early_to_15_mins_late_percent", "double"),
    ("16_to_30_mins_late_percent", "double"),
    ("31_to_60_mins_late_percent", "double"),
    ("61_to_180_mins_late_percent", "double"),
    ("181_to_360_mins_late_percent", "double"),
    ("more_than_360_mins_late_percent", "double"),
    ("average_delay_mins", "double"),
    ("planned_flights_unmatched", "bigint"),
    ("more_than_15_mins_early_percent", "double"),
    ("15_mins_early_to_1_minute_early_percent", "double"),
    ("0_to_15_mins_late_percent", "double"),
    ("flights_unmatched_percent", "double"),
    ("flights_cancelled_percent", "double"),
    ("number_flights_cancelled", "bigint"),
)
STAGING_NAMES = tuple(name for name, _ in STAGING_COLUMNS)

# Columns constant within one dedupe group (they feed the key).
_GROUP_COLUMNS = ("unique_row_id", "year", "month", "reporting_period_date", "scheduled_charter")

# Survivor order within a key: the original order (date, year, month, all
# constant inside a group), then a total tie-break so the survivor does not
# depend on partitioning: flights matched first, then every other column,
# each descending with nulls last.
DEDUPE_ORDER = (
    ("reporting_period_date", "year", "month", "number_flights_matched")
    + tuple(n for n in STAGING_NAMES
            if n not in _GROUP_COLUMNS and n != "number_flights_matched")
)


def unique_row_id() -> Column:
    """MD5 (hex) of the key columns' text, nulls as empty, no delimiter."""
    key = ", ".join(f"coalesce(CAST(`{c}` AS STRING), '')" for c in KEY_COLUMNS)
    return F.expr(f"md5(concat({key}))")


def period_date() -> Column:
    """First day of the month (null when either part is null)."""
    return F.expr("make_date(`year`, `month`, 1)")


def staging(normalized: DataFrame) -> DataFrame:
    """The staging projection; columns the input lacks come out null.
    Built as SQL expression text: one call per column instead of a chain of
    column objects (driver-side planning cost only)."""
    present = set(normalized.columns)
    derived = {"unique_row_id": unique_row_id(), "reporting_period_date": period_date()}

    def column(name: str, dtype: str) -> Column:
        if name in derived:
            return derived[name].alias(name)
        return F.expr(f"CAST({f'`{name}`' if name in present else 'NULL'} AS {dtype}) AS `{name}`")

    return normalized.select(*[column(n, t) for n, t in STAGING_COLUMNS])


def scheduled(stg: DataFrame) -> DataFrame:
    return stg.filter(F.col("scheduled_charter") == "S")


def dedupe_rank() -> Column:
    """``row_number()`` within a key, by a total order. Partitioned by (year,
    month, unique_row_id): year and month are inputs of the key, so the groups
    are the same as by the key alone, and a filter on year or month can pass
    below the window down to the scan."""
    order = ", ".join(f"`{c}` DESC NULLS LAST" for c in DEDUPE_ORDER)
    return F.expr(f"row_number() OVER (PARTITION BY `year`, `month`, `unique_row_id` "
                  f"ORDER BY {order})")


def int_scheduled_flights(stg: DataFrame) -> DataFrame:
    """One scheduled row per key.

    ``row_number() == 1`` lets Spark add a partial WindowGroupLimit before
    the shuffle, so each map task keeps at most one row per key: a key with
    a third of all rows costs one row per task in the exchange, not a third
    of the data in one reducer."""
    return (scheduled(stg).withColumn("_rn", dedupe_rank())
            .filter(F.col("_rn") == 1).drop("_rn"))
