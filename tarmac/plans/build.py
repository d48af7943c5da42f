"""End-to-end build over the driver tables: raw layouts -> normalised table
-> staging -> deduplicated scheduled flights, plus the dashboard bundle.

All steps are lazy; callers decide what to materialise. ``stg`` is the one
frame worth persisting or writing when several models run in one job (the
original pipeline materialises it as a table for the same reason).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from tarmac.operators.normalize import normalize_files
from tarmac.operators.staging import int_scheduled_flights, scheduled, staging
from tarmac.plans.fixture import flight_cells, raw_flights


@dataclass(frozen=True)
class Flights:
    """The frames every model starts from."""

    normalized: DataFrame | None  # None when read from a written staging table
    quarantine: DataFrame | None
    stg: DataFrame
    sch: DataFrame
    # (year, month) of scheduled and of all staging rows: sources of latest-period subqueries
    periods: DataFrame
    stg_periods: DataFrame
    checks: DataFrame | None = None  # row-level checks, counted while the tables were written


def flights_from_frames(frames: list[DataFrame]) -> Flights:
    normalized, quarantine = normalize_files(frames)
    stg = staging(normalized)
    return Flights(normalized=normalized, quarantine=quarantine, stg=stg,
                   sch=int_scheduled_flights(stg), periods=scheduled(stg), stg_periods=stg)


def flights(spark: SparkSession, sf_dir: str) -> Flights:
    """Both layouts arrive as one frame (their union by name), so the fixture's
    join and aggregation run once."""
    return flights_from_frames([raw_flights(flight_cells(spark, sf_dir))])
