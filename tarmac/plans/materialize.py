"""Tables written once that many queries read: the raw cells, the staging
table and its deduplicated scheduled rows.

The staging model is a table, not a view, for the same reason as in the
original pipeline: a dozen models read it; and every scheduled model needs the
same deduplication, whose shuffle is the largest of the pipeline. Both are
written in one build per input and code version under the session's
``spark.checkpoint.dir`` (a shared folder on a cluster), partitioned by year
and month. Reading a written table also cuts the lineage, so a lost executor
costs a re-read of files, not a re-run of the ingest joins.

A build writes a folder of its own and a marker after it, so readers only see
whole builds; the newest marker counts. The version is a digest of the input
files' names, sizes and times (for any file system) and of this package's
code; a build removes what older versions of the same input left, but for the
newest of them, which a running query may still read.
"""

from __future__ import annotations

import hashlib
import time
import uuid
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

from tarmac.operators.quality import scheduled_checks, staging_checks
from tarmac.operators.staging import STAGING_NAMES, int_scheduled_flights, unique_row_id
from tarmac.operators.views import delay_levels, marts_of_levels, staging_marts
from tarmac.plans.build import Flights, flights
from tarmac.plans.fixture import flight_cells, land_csv
from tarmac.plans.load import load_union, load_year
from tarmac.session import ensure_checkpoint_dir
from tarmac.sources import files
from tarmac.sources.tables import (
    load_model, mark_complete, periods_of, read_staging, write_mart, write_periods, write_staging,
)

_INPUTS = ("lineitem", "orders", "customer", "supplier", "part", "nation", "region")
_PACKAGE = Path(__file__).resolve().parents[1]
_PARTS = ("functions", "operators", "plans", "sources")
LEVELS = "delay_levels"


def _code_digest() -> str:
    h = hashlib.sha1()
    for part in _PARTS:
        for path in sorted((_PACKAGE / part).rglob("*.py")):
            h.update(path.relative_to(_PACKAGE).as_posix().encode())
            h.update(path.read_bytes())
    return h.hexdigest()


def _bases(spark: SparkSession, sf_dir: str, kind: str) -> tuple[str, str]:
    """Folder of all builds of an input, and that of its current version."""
    root = ensure_checkpoint_dir(spark).rstrip("/")
    where = files.qualified(spark, sf_dir.rstrip("/"))
    state = files.fingerprint(spark, [f"{where}/{name}.parquet" for name in _INPUTS])
    version = hashlib.sha1((state + _code_digest()).encode()).hexdigest()[:20]
    family = f"{root}/tarmac/{kind}/{hashlib.sha1(where.encode()).hexdigest()[:20]}"
    return family, f"{family}/{version}"


def _complete_attempts(spark: SparkSession, base: str) -> list[str]:
    """Whole builds under ``base``, oldest first (names start with their time)."""
    return [f"{base}/{f.name.removesuffix('.complete')}" for f in files.listing(spark, base)
            if f.name.endswith(".complete")]


def _retire(spark: SparkSession, family: str, base: str) -> None:
    """Remove all builds of the input but the newest two of the current
    version and the newest of any older one."""
    current = _complete_attempts(spark, base)
    for old in current[:-2]:
        files.delete(spark, f"{old}.complete")
        files.delete(spark, old)
    versions = sorted((f for f in files.listing(spark, family) if f.is_dir and not base.endswith(f.name)),
                      key=lambda f: f.modified)
    for f in versions[:-1]:
        files.delete(spark, f.path)


def _built(spark: SparkSession, sf_dir: str, kind: str, write: Callable[[str], None],
           force: bool) -> str:
    family, base = _bases(spark, sf_dir, kind)
    if not force:
        found = _complete_attempts(spark, base)
        if found:
            return found[-1]
    attempt = f"{base}/v{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"
    write(attempt)
    mark_complete(spark, attempt)
    _retire(spark, family, base)
    return attempt


def build_staging(spark: SparkSession, sf_dir: str, force: bool = False) -> str:
    """Write ``stg`` and ``sch`` unless a whole build of this version exists;
    return its folder. ``force`` builds anew, and readers then see that."""
    def write(path: str) -> None:
        # The key is 32 random digits, a large part of a shuffled row.
        key = {"unique_row_id": unique_row_id()}
        counted = write_staging(flights(spark, sf_dir).stg, f"{path}/stg", staging_checks(), key)
        stg = read_staging(spark, f"{path}/stg", STAGING_NAMES)
        counted |= write_staging(int_scheduled_flights(stg), f"{path}/sch", scheduled_checks(), key)
        for name in ("stg", "sch"):
            write_periods(spark, f"{path}/{name}")
        write_mart(spark.createDataFrame(list(counted.items()), "check_name string, failing_rows bigint"),
                   f"{path}/checks")

    return _built(spark, sf_dir, "staging", write, force)


def staged_flights(spark: SparkSession, sf_dir: str) -> Flights:
    """Models' inputs over the written tables. The latest-period subqueries read
    the small tables of periods written with them."""
    path = build_staging(spark, sf_dir)
    stg, sch = (read_staging(spark, f"{path}/{name}", STAGING_NAMES) for name in ("stg", "sch"))
    periods, stg_periods = (spark.read.schema("year int, month int").parquet(periods_of(f"{path}/{name}"))
                            for name in ("sch", "stg"))
    checks = spark.read.schema("check_name string, failing_rows bigint").parquet(f"{path}/checks")
    return Flights(normalized=None, quarantine=None, stg=stg, sch=sch, periods=periods,
                   stg_periods=stg_periods, checks=checks)


def raw_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fixture's aggregated cells, written once: both raw layouts and all
    ingest queries read them, so the joins run once. The tasks that aggregate
    them write them, by year, so landing a year reads no others."""
    def write(path: str) -> None:
        flight_cells(spark, sf_dir).write.mode("overwrite").partitionBy("y").parquet(path)

    return spark.read.parquet(_built(spark, sf_dir, "cells", write, False))


def landed_csv(spark: SparkSession, sf_dir: str) -> str:
    """The fixture landed as CSV files; returns the landing folder."""
    return _built(spark, sf_dir, "landing", lambda path: land_csv(raw_cells(spark, sf_dir), path), False)


def landed_years(spark: SparkSession, landing: str) -> list[str]:
    return [f.name for f in files.listing(spark, landing) if f.is_dir]


def loaded_tables(spark: SparkSession, sf_dir: str) -> str:
    """The landing folder loaded: yearly tables and the union table."""
    def write(path: str) -> None:
        landing = landed_csv(spark, sf_dir)
        for year in landed_years(spark, landing):
            load_year(spark, landing, path, year)
        load_union(spark, path)

    return _built(spark, sf_dir, "tables", write, False)


def written_marts(spark: SparkSession, sf_dir: str, as_of: str) -> str:
    """The dashboard's marts as tables; returns their folder. The deduplicated
    flights are read once, for a small table of sums that three marts share."""
    def write(path: str) -> None:
        f = staged_flights(spark, sf_dir)
        write_mart(delay_levels(f.sch), f"{path}/{LEVELS}")
        levels = load_model(spark, f"{path}/{LEVELS}", LEVELS)
        for name, mart in {**marts_of_levels(levels, as_of), **staging_marts(f.stg, f.stg_periods)}.items():
            write_mart(mart, f"{path}/{name}")

    return _built(spark, sf_dir, "marts", write, False)


def written_models(spark: SparkSession, root: str) -> list[str]:
    """Names of the models written under a folder, but for the shared sums."""
    return [f.name for f in files.listing(spark, root) if f.is_dir and f.name != LEVELS]
