"""Table sinks and loaders: yearly loads, the normalised union, the
partitioned staging table and the small mart tables.

Paths may be local or any Hadoop-compatible URI; only the DataFrame reader
and writer, and Spark's file-system layer, touch them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tarmac.sources import files, versioned
from tarmac.sources.versioned import MAX_RECORDS_PER_FILE


def path_exists(spark: SparkSession, path: str) -> bool:
    return files.exists(spark, path)


def _marker(path: str) -> str:
    return f"{path.rstrip('/')}.complete"


def mark_complete(spark: SparkSession, path: str) -> None:
    """Record that the table at ``path`` was fully committed. Written after
    the table's own job commits, so its presence implies a whole table; it
    holds the table's path."""
    (spark.range(1).select(F.lit(path.rstrip("/")).alias("value"))
     .repartition(1).write.mode("overwrite").text(_marker(path)))


def is_complete(spark: SparkSession, path: str) -> bool:
    return path_exists(spark, _marker(path))


def load_model(spark: SparkSession, path: str, name: str | None = None) -> DataFrame:
    """Read a written table (the newest version of one that has versions), with
    a clear error naming it when it is missing."""
    if versioned.exists(spark, path):
        return versioned.read(spark, path)
    # a folder of versions without any whole one is no table yet
    if not path_exists(spark, path) or any(
            f.name.startswith("data-") for f in files.listing(spark, path)):
        raise ValueError(f"there is no table {name or path} yet; build its model first")
    return spark.read.parquet(path)


# ------------------------------------------------------------ yearly tables

def year_table(root: str, prefix: str, year: str | int) -> str:
    """Each landed year is a table of its own, as in the original pipeline."""
    return f"{root.rstrip('/')}/{prefix}{year}"


def write_year(df: DataFrame, root: str, prefix: str, year: str | int) -> None:
    """Replace the table of one landed year in one step, whatever years its
    rows name: a stray row of another year stays in the table of the folder it
    came from. Readers see the old rows until the new ones are all there."""
    versioned.replace(df, year_table(root, prefix, year))


def year_exists(spark: SparkSession, root: str, prefix: str, year: str | int) -> bool:
    return versioned.exists(spark, year_table(root, prefix, year))


def _loaded(spark: SparkSession, root: str, prefix: str) -> list[str]:
    """Names of whole tables under ``root`` that start with ``prefix``, sorted."""
    return [f.name for f in files.listing(spark, root)
            if f.is_dir and f.name.startswith(prefix) and versioned.exists(spark, f.path)]


def source_tables(spark: SparkSession, root: str, prefix: str, destination: str | None = None) -> list[str]:
    """Names of the tables under ``root`` that start with ``prefix``, sorted,
    without the union table itself. Raises when there are none."""
    found = [name for name in _loaded(spark, root, prefix) if name != destination]
    if not found:
        raise ValueError(f"no table under {root} starts with {prefix!r}")
    return found


def loaded_years(spark: SparkSession, root: str, prefix: str) -> DataFrame:
    """(year): the years that have a table under ``root``."""
    names = [name.removeprefix(prefix) for name in _loaded(spark, root, prefix)]
    return spark.createDataFrame([(n,) for n in names if n.isdigit()], "year string")


def write_normalized(df: DataFrame, path: str) -> None:
    """Replace the whole normalised union table in one step."""
    versioned.replace(df, path)


# ------------------------------------------------------- staging and marts

def write_staging(stg: DataFrame, path: str, checks: list[Column] | None = None,
                  derived: dict[str, Column] | None = None) -> dict[str, int]:
    """Staging sink: partitioned by ``year``/``month`` so latest-period
    filters prune directories; rows sorted by route and airline inside each
    file so Parquet min/max statistics skip row groups on those columns.

    The ``rebalance`` hint groups rows of a month into few tasks (few files
    per directory) while AQE splits any partition above the advisory size,
    so a month or key holding a third of the data is written by many tasks,
    not one. ``maxRecordsPerFile`` caps file size. The whole table is
    replaced: a month that the new rows lack is gone afterwards.

    ``derived`` are columns of ``stg`` that its other columns give: they are left
    out of the shuffle and worked out again by the tasks that write.

    ``checks`` are aggregates over the rows. They are observed by the tasks that
    write, so they cost no further scan; the result is their values by name."""
    derived = derived or {}
    rows = (stg.drop(*derived).hint("rebalance", "year", "month").withColumns(derived).select(stg.columns)
            .sortWithinPartitions("year", "month", "origin_destination", "airline_name"))
    seen = Observation() if checks else None
    ((rows.observe(seen, *checks) if seen else rows).write.mode("overwrite")
     .option("partitionOverwriteMode", "static")
     .option("maxRecordsPerFile", MAX_RECORDS_PER_FILE)
     .partitionBy("year", "month").parquet(path))
    return dict(seen.get) if seen else {}


def write_periods(spark: SparkSession, path: str) -> None:
    """Beside a table partitioned by ``year``/``month``, a small one of its
    periods: looking up the latest one opens no file of the table."""
    periods = spark.read.parquet(path).select("year", "month").distinct()
    write_mart(periods, periods_of(path))


def periods_of(path: str) -> str:
    return f"{path.rstrip('/')}_periods"


def read_staging(spark: SparkSession, path: str, columns: tuple[str, ...]) -> DataFrame:
    """The staging table with its original column order (partition columns
    come back last from the reader)."""
    return spark.read.parquet(path).select(*[F.col(f"`{c}`") for c in columns])


def write_mart(df: DataFrame, path: str) -> None:
    """Marts are a few dozen rows: one file, full overwrite. ``repartition``
    leaves the aggregation before it as parallel as it was."""
    df.repartition(1).write.mode("overwrite").parquet(path)
