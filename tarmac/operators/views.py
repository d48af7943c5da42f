"""Dashboard-ready datasets: the table half of the dashboard (drawing is
not built). Each input is a mart of a few dozen rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarmac.functions.exprs import month_name, round_half, safe_divide
from tarmac.functions.periods import latest_period_filter
from tarmac.operators import models

NOT_AVAILABLE = "N/A"


def annual_trend(delay_over_years: DataFrame) -> DataFrame:
    """Annual series with ``year`` as text for a categorical axis."""
    return (delay_over_years.select(F.col("year").cast("string").alias("year"), "avg_delay_mins")
            .orderBy("year"))


def monthly_bars(delay_by_month: DataFrame) -> DataFrame:
    """Monthly bars in calendar order."""
    return delay_by_month.orderBy("month")


def airport_treemap(airport_delays: DataFrame) -> DataFrame:
    """Airports by delay, largest first."""
    return airport_delays.orderBy(F.col("avg_delay_mins").desc_nulls_last(),
                                  F.col("reporting_airport").asc_nulls_first())


def kpis(tracked_flights: DataFrame, published_date: DataFrame) -> DataFrame:
    """One row: the latest period label and the thousands-separated flight
    count, each ``N/A`` when missing. One global aggregate over both inputs,
    so there is a row even when they are empty."""
    both = tracked_flights.select("total_tracked_flights").unionByName(
        published_date.select("recent_published_date"), allowMissingColumns=True)
    return both.agg(
        F.coalesce(F.max("recent_published_date"), F.lit(NOT_AVAILABLE)).alias("recent_published_date"),
        F.coalesce(F.format_number(F.max("total_tracked_flights"), 0), F.lit(NOT_AVAILABLE))
        .alias("total_tracked_flights"))


#: The marts the dashboard loads, and which columns of each hold its key and its value.
BUNDLE = {
    "fct_delay_over_years": (("year",), "avg_delay_mins"),
    "fct_recent_published_date": (("recent_published_date",), None),
    "fct_recent_number_tracked_flights": ((), "total_tracked_flights"),
    "fct_delay_vs_month_last_year": (("month", "month_name"), "avg_delay_mins"),
    "fct_recent_airport_delays": (("reporting_airport",), "avg_delay_mins"),
}


def dashboard_bundle(stg: DataFrame, sch: DataFrame, as_of: str | None = None) -> dict[str, DataFrame]:
    """The five marts the dashboard loads, by table name. ``sch`` is read once,
    for the levels of :func:`delay_levels`; a caller that writes the marts
    should write those levels first and pass them to :func:`marts_of_levels`."""
    return {**marts_of_levels(delay_levels(sch), as_of), **staging_marts(stg)}


def staging_marts(stg: DataFrame, periods: DataFrame | None = None) -> dict[str, DataFrame]:
    """The two marts over all staging rows, both of the latest month."""
    return {"fct_recent_published_date": models.fct_recent_published_date(stg, periods),
            "fct_recent_number_tracked_flights": models.fct_recent_number_tracked_flights(stg, periods)}


def delay_levels(sch: DataFrame) -> DataFrame:
    """One pass over the scheduled flights for all three delay marts: the sums
    of the weighted means by year, month and airport, rolled up to year and
    month and to the year. ``level`` counts the columns that name the row.

    Rows are first summed to cells, so only those are rolled up. ``flown_*``
    leave out rows without flights, as two of the marts do."""
    n, d = F.col(models.N), F.col(models.D)
    flown = n > 0
    cells = sch.groupBy("year", "month", "reporting_airport").agg(
        F.sum(n * d).alias("delay"), F.sum(n).alias("flights"),
        F.sum(F.when(flown, n * d)).alias("flown_delay"), F.sum(F.when(flown, n)).alias("flown_flights"))
    sums = [F.sum(c).alias(c) for c in ("delay", "flights", "flown_delay", "flown_flights")]
    # grouping_id has a bit for each column that is rolled up
    gone = F.grouping_id()
    return (cells.rollup("year", "month", "reporting_airport").agg(
        F.when(gone == 0, 3).when(gone == 1, 2).when(gone == 3, 1).otherwise(0).alias("level"), *sums)
        .filter("level > 0"))


def marts_of_levels(levels: DataFrame, as_of: str | None = None) -> dict[str, DataFrame]:
    """The three delay marts from the levels of :func:`delay_levels`."""
    today = F.current_date() if as_of is None else F.to_date(F.lit(as_of))

    def mean(delay: str, flights: str, digits: int):
        return round_half(safe_divide(delay, flights), digits).alias("avg_delay_mins")

    flown = levels.filter(F.col("flown_flights").isNotNull())
    months = levels.filter("level = 2").select("year", "month")
    return {
        "fct_delay_over_years": flown.filter("level = 1").select(
            "year", mean("flown_delay", "flown_flights", 0)).orderBy("year"),
        "fct_delay_vs_month_last_year": flown.filter(
            (F.col("level") == 2) & (F.col("year") == F.year(today) - 1)).select(
            "month", month_name("month").alias("month_name"), mean("flown_delay", "flown_flights", 2))
        .orderBy("month"),
        "fct_recent_airport_delays": levels.filter("level = 3").filter(latest_period_filter(months)).select(
            "reporting_airport", mean("delay", "flights", 0)),
    }


def long_form(marts: dict[str, DataFrame]) -> DataFrame:
    """All rows of the bundle's marts as (table_name, key, value)."""
    frames = []
    for name, (keys, value) in BUNDLE.items():
        key = F.concat_ws(" ", *[F.col(k).cast("string") for k in keys])
        number = F.col(value).cast("double") if value else F.lit(None).cast("double")
        frames.append(marts[name].select(F.lit(name).alias("table_name"), key.alias("key"), number.alias("value")))
    return reduce(DataFrame.unionByName, frames)
