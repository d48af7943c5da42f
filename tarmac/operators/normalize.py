"""Ingest normalisation: parse periods, union file layouts, merge renamed
columns, fill coarse bands from fine ones and project the final columns.

Everything is one narrow (shuffle-free) projection per step; the union is
``unionByName``. Nothing is collected except the bounded sample of bad
values used in an error message.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarmac.functions.text import (
    NULL_TOKENS, period_is_valid, period_month, period_problem, period_year,
)

# Raw column -> standard column, in precedence order. When the
# standard column already exists, its nulls are filled from the raw column.
RENAME_MAP = (
    ("flights_more_than_15_minutes_early_percent", "more_than_15_mins_early_percent"),
    ("flights_15_minutes_early_to_1_minute_early_percent", "15_mins_early_to_1_minute_early_percent"),
    ("flights_0_to_15_minutes_late_percent", "0_to_15_mins_late_percent"),
    ("flts_16_to_30_mins_late_percent", "16_to_30_mins_late_percent"),
    ("flts_31_to_60_mins_late_percent", "31_to_60_mins_late_percent"),
    ("flts_61_to_180_mins_late_percent", "61_to_180_mins_late_percent"),
    ("flts_181_to_360_mins_late_percent", "181_to_360_mins_late_percent"),
    ("flights_between_16_and_30_minutes_late_percent", "16_to_30_mins_late_percent"),
    ("flights_between_31_and_60_minutes_late_percent", "31_to_60_mins_late_percent"),
    ("flights_between_61_and_120_minutes_late_percent", "61_to_120_mins_late_percent"),
    ("flights_between_121_and_180_minutes_late_percent", "121_to_180_mins_late_percent"),
    ("flights_between_181_and_360_minutes_late_percent", "181_to_360_mins_late_percent"),
    ("flights_more_than_360_minutes_late_percent", "more_than_360_mins_late_percent"),
)

# Ordered columns of the normalised table; absent ones are
# skipped. The two "_and_" names are never produced by the renames above, so
# those bands are dropped, as in the original pipeline.
FINAL_COLUMNS = (
    "reporting_airport",
    "origin_destination_country",
    "origin_destination",
    "airline_name",
    "scheduled_charter",
    "year",
    "month",
    "number_flights_matched",
    "actual_flights_unmatched",
    "more_than_15_mins_early_percent",
    "15_mins_early_to_1_minute_early_percent",
    "0_to_15_mins_late_percent",
    "early_to_15_mins_late_percent",
    "16_to_30_mins_late_percent",
    "31_to_60_mins_late_percent",
    "61_and_120_mins_late_percent",
    "121_and_180_mins_late_percent",
    "61_to_180_mins_late_percent",
    "181_to_360_mins_late_percent",
    "more_than_360_mins_late_percent",
    "flights_unmatched_percent",
    "flights_cancelled_percent",
    "number_flights_cancelled",
    "average_delay_mins",
    "planned_flights_unmatched",
)

TEXT_COLUMNS = (
    "reporting_airport", "origin_destination_country", "origin_destination",
    "airline_name", "scheduled_charter",
)
COUNT_COLUMNS = (
    "number_flights_matched", "actual_flights_unmatched",
    "planned_flights_unmatched", "number_flights_cancelled",
)
DROPPED_COLUMNS = ("reporting_period", "run_date", "source_file")
DROPPED_PREFIX = "previous_year_"


def _is_measure(name: str) -> bool:
    return name.endswith("_percent") or name == "average_delay_mins"


def _sql_text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


_TOKENS_SQL = ", ".join(_sql_text(t) for t in NULL_TOKENS)


def _clean_sql(c: str) -> str:
    return f"(CASE WHEN {c} IN ({_TOKENS_SQL}) THEN NULL ELSE {c} END)"


def _count_sql(c: str) -> str:
    """A whole number from text, null for anything else."""
    number = f"try_cast({c} AS DOUBLE)"
    return (f"coalesce(try_cast({c} AS BIGINT), "
            f"CASE WHEN {number} = floor({number}) THEN try_cast({number} AS BIGINT) END)")


def _typed_column(name: str, dtype: str) -> Column:
    """Clean one column and give it the type its name stands for.

    Text columns (as a CSV read yields them) lose missing-value tokens and
    are cast with ``try_cast`` (null on bad values, never an error); typed
    columns pass through, with NaN measures turned into null. Written as SQL
    expression text, one call per column."""
    c = f"`{name}`"
    if name in ("year", "month"):
        return F.col(c)
    if dtype == "string":
        c = _clean_sql(c)
        if name in COUNT_COLUMNS:
            # "12" and "12.0" both read as 12; a text that is no whole number
            # never gets here from a load, which quarantines it.
            return F.expr(_count_sql(c))
        if _is_measure(name):
            return F.expr(f"nanvl(try_cast({c} AS DOUBLE), CAST(NULL AS DOUBLE))")
        return F.expr(c)
    if name in COUNT_COLUMNS:
        return F.expr(f"CAST({c} AS BIGINT)")
    if _is_measure(name):
        return F.expr(f"nanvl(CAST({c} AS DOUBLE), CAST(NULL AS DOUBLE))")
    return F.col(c)


# ------------------------------------------------------------ N1-N3, N5

def _with_period(df: DataFrame) -> DataFrame:
    if "reporting_period" not in df.columns:
        raise ValueError("without a reporting_period column a file's rows have no year and month")
    return df


def parse_file(df: DataFrame) -> DataFrame:
    """Add ``year``/``month`` parsed from ``reporting_period`` and drop
    ``run_date``. Rows keep their period text until normalisation."""
    out = _with_period(df).withColumns({
        "year": period_year("reporting_period"),
        "month": period_month("reporting_period"),
    })
    return out.drop("run_date")


def parse_rows(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(parsed good rows, bad rows as they were read, with ``period_problem``)."""
    good, bad = split_periods(_with_period(df))
    return parse_file(good), bad


def count_problem(df: DataFrame) -> Column:
    """``count`` when a count column holds text that is no whole number
    (missing-value tokens are nulls, not problems), else null."""
    tests = []
    for name, dtype in df.dtypes:
        if name in COUNT_COLUMNS and dtype == "string":
            clean = _clean_sql(f"`{name}`")
            tests.append(f"({clean} IS NOT NULL AND {_count_sql(clean)} IS NULL)")
    return F.expr(f"CASE WHEN {' OR '.join(tests)} THEN 'count' END") if tests else \
        F.lit(None).cast("string")


def split_periods(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(good rows, quarantined rows with a ``period_problem`` column).

    A quarantined row keeps all its raw columns. Its problem is the period's
    format or month, or a count that is no whole number. The good side is a
    cheap predicate, since the optimizer may push it far down (below an
    aggregation, onto raw rows); the reason for a rejection is only worked out
    on the quarantined side."""
    wrong = count_problem(df)
    valid = period_is_valid("reporting_period") & wrong.isNull()
    bad = df.filter(~valid).withColumn(
        "period_problem", F.coalesce(period_problem("reporting_period"), wrong))
    return df.filter(valid), bad


def assert_periods(df: DataFrame, examples: int = 20) -> None:
    """Stop when a row would be quarantined, as the original loader stops a
    whole file. The message names up to ``examples`` of the values."""
    _, bad = split_periods(_with_period(df))
    found = bad.groupBy("period_problem").agg(
        F.count(F.lit(1)).alias("n"),
        F.slice(F.sort_array(F.collect_set("reporting_period")), 1, examples).alias("values"))
    reasons = {"format": "not written as YYYYMM or YYYY-MM", "month": "a month outside 01 to 12",
               "count": "a flight count that is no whole number"}
    rows = sorted(found.collect(), key=lambda r: r["period_problem"])
    if rows:
        raise ValueError("; ".join(
            f"{r['n']} rows with {reasons[r['period_problem']]} (periods {r['values']})" for r in rows))


def union_layouts(frames: list[DataFrame]) -> DataFrame:
    """Outer union by column name; columns missing from a frame are null."""
    if not frames:
        raise ValueError("no frames to union")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


# ------------------------------------------------------------ N6-N10

def drop_noise(df: DataFrame) -> DataFrame:
    return df.drop(*[c for c in df.columns
                     if c in DROPPED_COLUMNS or c.startswith(DROPPED_PREFIX)])


def coalesce_rename(df: DataFrame, mapping=RENAME_MAP) -> DataFrame:
    """Apply the rename map in one projection.

    For each target: ``coalesce(target, source_1, source_2, ...)`` over the
    columns present, sources in map order; the sources disappear. Columns
    not involved keep their place."""
    present = set(df.columns)
    sources_of: dict[str, list[str]] = {}
    for source, target in mapping:
        if source in present:
            sources_of.setdefault(target, []).append(source)
    consumed = {s for srcs in sources_of.values() for s in srcs}
    out: list[Column] = []
    emitted = set()
    for name in df.columns:
        if name in consumed:
            target = next(t for t, srcs in sources_of.items() if name in srcs)
            if target in present or target in emitted:
                continue
            name_expr = target
        elif name in sources_of:
            name_expr = name
        else:
            out.append(F.col(f"`{name}`"))
            continue
        parts = ([name_expr] if name_expr in present else []) + sources_of[name_expr]
        out.append(F.coalesce(*[F.col(f"`{p}`") for p in parts]).alias(name_expr)
                   if len(parts) > 1 else F.col(f"`{parts[0]}`").alias(name_expr))
        emitted.add(name_expr)
    return df.select(*out)


def _or_null(df: DataFrame, name: str) -> Column:
    return F.col(f"`{name}`") if name in df.columns else F.lit(None).cast("double")


def fill_bands(df: DataFrame) -> DataFrame:
    """Coarse bands from fine ones where the coarse value is null. A null
    part leaves the sum null. Missing columns count as null."""
    c = lambda n: _or_null(df, n)
    return df.withColumns({
        "61_to_180_mins_late_percent": F.coalesce(
            c("61_to_180_mins_late_percent"),
            c("61_to_120_mins_late_percent") + c("121_to_180_mins_late_percent")),
        "early_to_15_mins_late_percent": F.coalesce(
            c("early_to_15_mins_late_percent"),
            (c("15_mins_early_to_1_minute_early_percent") + c("0_to_15_mins_late_percent"))
            + c("more_than_15_mins_early_percent")),
    })


def normalize(df: DataFrame) -> DataFrame:
    """Raw text union -> typed, standard-named, ordered table."""
    df = coalesce_rename(typed(drop_noise(df)))
    df = fill_bands(df)
    return df.select(*[F.col(f"`{c}`") for c in FINAL_COLUMNS if c in df.columns])


def typed(df: DataFrame) -> DataFrame:
    """Missing-value tokens to null and every column to its type. Frames are
    typed before they are united, so a text frame and a typed one can meet."""
    return df.select(*[_typed_column(c, t).alias(c) for c, t in df.dtypes])


def normalize_files(frames: list[DataFrame], on_bad: str = "quarantine") -> tuple[DataFrame, DataFrame]:
    """Per-file parse, bad rows apart, typing, union and normalisation.

    Returns (normalised table, quarantined rows with all their raw columns).
    With ``on_bad="fail"`` a bad row stops the load instead."""
    if on_bad not in ("quarantine", "fail"):
        raise ValueError(f"on_bad is {on_bad!r}, not 'quarantine' or 'fail'")
    goods, bads = [], []
    for frame in frames:
        if on_bad == "fail":
            assert_periods(frame)
        good, bad = parse_rows(frame)
        goods.append(typed(good))
        bads.append(bad.select(*[F.col(f"`{c}`").cast("string").alias(c) for c in bad.columns]))
    return normalize(union_layouts(goods)), union_layouts(bads)


def conform(normalized: DataFrame) -> DataFrame:
    """All final columns with fixed types (absent ones null), so tables
    written from different layouts share one schema."""
    present = set(normalized.columns)

    def type_of(name: str) -> str:
        if name in ("year", "month"):
            return "int"
        if name in COUNT_COLUMNS:
            return "bigint"
        return "string" if name in TEXT_COLUMNS else "double"

    return normalized.select(*[
        (F.col(f"`{c}`") if c in present else F.lit(None)).cast(type_of(c)).alias(c)
        for c in FINAL_COLUMNS])
