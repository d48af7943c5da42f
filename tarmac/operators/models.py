"""Intermediate models and marts over the staging table (``stg``) and its
deduplicated scheduled subset (``sch``).

Each function returns a lazy DataFrame. Latest-period predicates take a
``periods`` frame (year, month) for their subqueries; it defaults to the rows
themselves. A build writes a small table of periods for it. Passing
``scheduled(stg)`` instead gives the same values (deduplication keeps at
least one row of every (year, month, key) group) without running the
dedupe window a second time inside the subquery.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tarmac.functions.exprs import (
    month_name, round_half, safe_divide, valid_delay_filter, weighted_mean_all,
)
from tarmac.functions.periods import latest_period_filter, latest_year_filter

N = "number_flights_matched"
D = "average_delay_mins"


def _avg_delay(digits: int = 0):
    return weighted_mean_all(N, D, digits).alias("avg_delay_mins")


# ------------------------------------------------------------------ marts

def fct_delay_over_years(sch: DataFrame) -> DataFrame:
    """Flight-weighted delay per year, rounded to whole minutes."""
    return (sch.filter(F.col(N) > 0)
            .groupBy("year").agg(_avg_delay(0))
            .orderBy("year"))


def fct_delay_vs_month_last_year(sch: DataFrame, as_of: str | None = None) -> DataFrame:
    """Weighted delay per month of the year before ``as_of`` (default: today),
    two decimals, with the month's name."""
    today = F.current_date() if as_of is None else F.to_date(F.lit(as_of))
    return (sch.filter((F.col("year") == F.year(today) - 1) & (F.col(N) > 0))
            .groupBy("month").agg(_avg_delay(2))
            .select("month", month_name("month").alias("month_name"), "avg_delay_mins")
            .orderBy("month"))


def fct_recent_airport_delays(sch: DataFrame, periods: DataFrame | None = None) -> DataFrame:
    """Weighted delay per airport in the latest month of the latest year."""
    periods = sch if periods is None else periods
    return (sch.filter(latest_period_filter(periods))
            .groupBy("reporting_airport").agg(_avg_delay(0)))


def fct_recent_number_tracked_flights(stg: DataFrame, periods: DataFrame | None = None) -> DataFrame:
    """Flights in the latest month, over all staging rows (duplicates and
    charters included). Always one row; null when nothing matches."""
    return (stg.filter(latest_period_filter(stg if periods is None else periods))
            .agg(F.sum(N).alias("total_tracked_flights")))


def fct_recent_published_date(stg: DataFrame, periods: DataFrame | None = None) -> DataFrame:
    """``"<Month> <year>"`` of the latest month; no row for an empty table."""
    label = F.concat(month_name("month"), F.lit(" "), F.col("year").cast("string"))
    return (stg.filter(latest_period_filter(stg if periods is None else periods))
            .select(label.alias("recent_published_date"))
            .limit(1))


# ----------------------------------------------------------- intermediate

def dim_recent_reporting_airports(stg: DataFrame, periods: DataFrame | None = None) -> DataFrame:
    """Distinct airports reporting in the latest year, sorted."""
    return (stg.filter(latest_year_filter(stg if periods is None else periods))
            .select("reporting_airport").distinct()
            .orderBy("reporting_airport"))


def airport_extreme(sch: DataFrame, order: str = "asc") -> DataFrame:
    """Per year, the airport with the lowest (``asc``) or highest (``desc``)
    weighted delay over valid rows (positive flights, delay present and not
    NaN), with its flights and cancellations. Ties go to the airport name in
    ascending order."""
    per_airport = (
        sch.filter(valid_delay_filter(N, D))
        .groupBy("reporting_airport", "year")
        .agg(F.sum(N).alias("total_flights"),
             F.sum("number_flights_cancelled").alias("total_cancelled_flights"),
             _avg_delay(0))
    )
    delay = F.col("avg_delay_mins")
    key = delay.asc_nulls_first() if order == "asc" else delay.desc_nulls_last()
    w = Window.partitionBy("year").orderBy(key, F.col("reporting_airport").asc_nulls_first())
    return (per_airport.withColumn("_rank", F.row_number().over(w))
            .filter(F.col("_rank") == 1)
            .select("reporting_airport", "year", "total_flights",
                    "total_cancelled_flights", "avg_delay_mins")
            .orderBy("year"))


def fct_airport_least_delays_by_year(sch: DataFrame) -> DataFrame:
    return airport_extreme(sch, "asc")


def fct_airport_most_delays_by_year(sch: DataFrame) -> DataFrame:
    return airport_extreme(sch, "desc")


def fct_country_delay_by_year(stg: DataFrame, sch: DataFrame,
                              periods: DataFrame | None = None) -> DataFrame:
    """Country summary for the latest scheduled year over all staging rows
    with flights: flights, weighted delay and the plain mean of the 0-15
    minute band."""
    periods = sch if periods is None else periods
    return (stg.filter(latest_year_filter(periods) & (F.col(N) > 0))
            .groupBy("origin_destination_country", "year")
            .agg(F.sum(N).alias("total_flights_matched"),
                 _avg_delay(0),
                 round_half(F.avg("0_to_15_mins_late_percent"), 2)
                 .alias("avg_0_to_15_mins_late_percent"))
            .drop("year")
            .orderBy(F.col("avg_delay_mins").desc_nulls_last()))


def fct_fraction_charter_scheduled(stg: DataFrame) -> DataFrame:
    """Share of charter and scheduled flights per year, newest first."""
    flights = F.col(N)
    flag = F.col("scheduled_charter")
    yearly = stg.groupBy("year").agg(
        F.sum(F.when(flag == "C", flights).otherwise(0)).alias("total_charter_flights"),
        F.sum(F.when(flag == "S", flights).otherwise(0)).alias("total_scheduled_flights"),
        F.sum(flights).alias("total_flights"),
    )
    return (yearly.select(
        "year",
        round_half(safe_divide("total_charter_flights", "total_flights"), 2)
        .alias("fraction_charter_flights"),
        round_half(safe_divide("total_scheduled_flights", "total_flights"), 2)
        .alias("fraction_scheduled_flights"),
        "total_flights")
        .orderBy(F.col("year").desc_nulls_last()))


def int_recent_busiest_airlines(sch: DataFrame, periods: DataFrame | None = None,
                                top: int = 20) -> DataFrame:
    """The ``top`` airlines by flights in the latest year (ties by name).
    Sort + limit plans as a single TakeOrderedAndProject: each task keeps
    its own top rows, so only ``top`` rows per task are exchanged."""
    periods = sch if periods is None else periods
    return (sch.filter(latest_year_filter(periods))
            .groupBy("airline_name").agg(F.sum(N).alias("total_flights"))
            .orderBy(F.col("total_flights").desc_nulls_last(),
                     F.col("airline_name").asc_nulls_first())
            .limit(top))


def fct_recent_avg_delay_airlines(stg: DataFrame, sch: DataFrame,
                                  periods: DataFrame | None = None,
                                  top: int = 20) -> DataFrame:
    """Weighted delay of the busiest airlines over all staging rows of the
    latest scheduled year. The airline list has at most ``top`` rows, a
    proven bound, so it is broadcast into a semi join."""
    periods = sch if periods is None else periods
    busiest = int_recent_busiest_airlines(sch, periods, top).select("airline_name")
    return (stg.filter(latest_year_filter(periods))
            .join(F.broadcast(busiest), "airline_name", "left_semi")
            .groupBy("airline_name").agg(_avg_delay(0))
            .orderBy(F.col("avg_delay_mins").desc_nulls_last()))
