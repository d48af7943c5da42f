"""File load: landed CSV folders -> one raw table per year -> the normalised
union table, as batch functions.

``{landing}/{year}/...csv`` is read whole into ``{tables}/{prefix}{year}``;
rows with a bad period, a bad count or too many fields go, with all their raw
columns and their file, to ``{tables}/quarantine/{prefix}{year}`` (or stop the
year's load). The union table is built from whatever yearly tables there are.
"""

from __future__ import annotations

import hashlib
import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarmac.operators.normalize import (
    assert_periods, conform, normalize, parse_file, parse_rows, typed, union_layouts,
)
from tarmac.sources import files, versioned
from tarmac.sources.csv import REJECTED, read_csv, read_csv_mixed_encoding
from tarmac.sources.tables import source_tables, write_year, year_exists, year_table

PREFIX = "punctuality_data_"
DESTINATION = "punctuality_data_all_years"
QUARANTINE = "quarantine"

# Listings write one path with one or three slashes after its scheme.
SCHEME = "^[a-zA-Z][a-zA-Z0-9+.-]*:/+"


def plain_path(path: str) -> str:
    return re.sub(SCHEME, "/", path)


def parsed_year(spark: SparkSession, landing: str, year: str | int,
                paths: list[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """(parsed rows, quarantined rows) of one landed year (of just its files
    ``paths``). Parsed rows are raw
    text plus ``year`` and ``month``; a quarantined row has all its raw columns,
    ``source_file`` and ``period_problem``, or ``fields`` and the raw record."""
    raw = read_csv(spark, landing, year, paths)
    whole = raw.filter(F.col(REJECTED).isNull()).drop(REJECTED)
    good, bad = parse_rows(whole)
    broken = raw.filter(F.col(REJECTED).isNotNull()).select(
        "source_file", REJECTED, F.lit("fields").alias("period_problem"))
    return good, bad.unionByName(broken, allowMissingColumns=True)


def load_year(spark: SparkSession, landing: str, tables: str, year: str | int, prefix: str = PREFIX,
              on_bad: str = "quarantine", overwrite: bool = True) -> bool:
    """Load one landed year; False when its table exists and stays as it is."""
    if not overwrite and year_exists(spark, tables, prefix, year):
        return False
    if on_bad == "fail":
        raw = read_csv_mixed_encoding(spark, landing, year)
        assert_periods(raw)
        write_year(parse_file(raw), tables, prefix, year)
        return True
    good, bad = parsed_year(spark, landing, year)
    # The rejected rows first: a year that can be read has its quarantine.
    versioned.replace(bad, f"{tables.rstrip('/')}/{QUARANTINE}/{prefix}{year}")
    write_year(good, tables, prefix, year)
    return True


def append_files(spark: SparkSession, landing: str, tables: str, year: str | int, paths: list[str],
                 prefix: str = PREFIX) -> list[str]:
    """Add newly landed files to a year's table, as a part of their own; returns
    the files that were not in it yet. Only those are read.

    The ledger of loaded files is the table itself: every row names its file,
    and a version either has a batch's rows or not. So loading the same files
    again, after a failure or a batch load of the year, adds nothing. (A file
    of which no row was good is looked up in the quarantine.) ``load_year``
    makes one part of all."""
    table = year_table(tables, prefix, year)
    quarantine = f"{tables.rstrip('/')}/{QUARANTINE}/{prefix}{year}"
    by_name = {plain_path(p): p for p in paths}
    loaded: set[str] = set()
    version = versioned.current(spark, table)
    if version:
        # The quarantine is written first: its rows count if the table has their part.
        rejected = versioned.current(spark, quarantine)
        parts = set(version.parts)
        for where, only in ((table, parts), (quarantine, parts & set(rejected.parts if rejected else ()))):
            if only:
                rows = versioned.read(spark, where, only).select("source_file").distinct()
                # at most one row for each file of the batch
                named = spark.createDataFrame([(n,) for n in by_name], "n string")
                loaded |= {r["n"] for r in rows.select(F.url_decode(F.replace(
                    F.regexp_replace("source_file", SCHEME, "/"), F.lit("+"), F.lit("%2B"))).alias("n"))
                    .join(F.broadcast(named), "n", "left_semi").collect()}
    new = [p for name, p in by_name.items() if name not in loaded]
    if new:
        part = hashlib.sha1("\n".join(sorted(plain_path(p) for p in new)).encode()).hexdigest()
        good, bad = parsed_year(spark, landing, year, new)
        versioned.replace_parts(spark, quarantine, {part: bad})
        versioned.replace_parts(spark, table, {part: good})
    return new


def quarantined(spark: SparkSession, tables: str) -> DataFrame | None:
    """All quarantined rows, or None when no year was loaded."""
    root = f"{tables.rstrip('/')}/{QUARANTINE}"
    frames = [versioned.read(spark, f.path) for f in files.listing(spark, root)
              if f.is_dir and versioned.exists(spark, f.path)]
    return union_layouts(frames) if frames else None


def united(spark: SparkSession, tables: str, prefix: str = PREFIX,
           destination: str = DESTINATION) -> DataFrame:
    """The normalised union of all yearly tables but the union table itself."""
    names = source_tables(spark, tables, prefix, destination)
    return union_layouts([_normalized(spark, tables, name) for name in names])


def _normalized(spark: SparkSession, tables: str, name: str) -> DataFrame:
    return conform(normalize(typed(versioned.read(spark, f"{tables.rstrip('/')}/{name}"))))


def load_union(spark: SparkSession, tables: str, prefix: str = PREFIX,
               destination: str = DESTINATION, full: bool = False) -> str:
    """Bring the union table up to date; returns its path.

    A part remembers which data of its yearly table it was made from. Parts
    of other data are written anew, those of tables that are gone leave, and
    all others stay as they are (``full`` rewrites all). Normalisation looks at
    single rows, so the parts together are the union's normalisation."""
    path = f"{tables.rstrip('/')}/{destination}"
    names = source_tables(spark, tables, prefix, destination)
    now = {name: versioned.state(spark, f"{tables.rstrip('/')}/{name}") for name in names}
    version = versioned.current(spark, path)
    before = version.parts if version and not full else {}
    stale = [name for name in names if name not in before or before[name].source != now[name]]
    gone = tuple(name for name in (version.parts if version else {}) if name not in now)
    if stale or gone:
        versioned.replace_parts(spark, path, {name: _normalized(spark, tables, name) for name in stale},
                                {name: now[name] for name in stale}, drop=gone)
    return path
