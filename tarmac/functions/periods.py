"""Latest-period predicates built from uncorrelated scalar subqueries.

``year = (select max(year) ...)`` stays a scalar subquery in the plan. On a
table partitioned by ``year``/``month`` it becomes a partition filter, so
the main scan reads one partition; the subquery itself is a partial +
final global aggregate over one column.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def max_year(source: DataFrame) -> Column:
    return source.select(F.max("year")).scalar()


def latest_year_filter(source: DataFrame) -> Column:
    """``year = max(year) of source``."""
    return F.col("year") == max_year(source)


def latest_period_filter(source: DataFrame) -> Column:
    """``year = max(year)`` and ``month = max(month) within that year``."""
    year = max_year(source)
    month = source.filter(F.col("year") == year).select(F.max("month")).scalar()
    return (F.col("year") == year) & (F.col("month") == month)
