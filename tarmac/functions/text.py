"""String column expressions: reporting periods, file names, missing-value
tokens. All are built-in Spark expressions (no Python per row)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tarmac.functions.exprs import let

# Texts a default pandas CSV read turns into missing values.
NULL_TOKENS = (
    "", "NA", "N/A", "n/a", "#N/A", "#N/A N/A", "#NA", "NaN", "nan", "-NaN",
    "-nan", "NULL", "null", "None", "<NA>", "1.#IND", "-1.#IND", "1.#QNAN",
    "-1.#QNAN",
)

# The characters Python's str.strip() removes (Unicode white
# space), so text is trimmed the same way without a regular expression.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# Accepted reporting-period shapes, YYYYMM or YYYY-MM.
PERIOD_PATTERN = r"^(\d{4})-?(\d{2})$"
# A period inside a link title is the first "20" + four digits.
TITLE_PERIOD_PATTERN = r"(20\d{4})"


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def null_tokens(c: str | Column, tokens: tuple[str, ...] = NULL_TOKENS) -> Column:
    """Missing-value tokens become null; other texts pass unchanged."""
    c = _col(c)
    return F.when(c.isin(*tokens), F.lit(None).cast("string")).otherwise(c)


def strip_text(c: str | Column) -> Column:
    """Remove leading and trailing Unicode white space (plain ``trim`` only
    removes blanks)."""
    return F.btrim(_col(c), F.lit(WHITESPACE))


# ---------------------------------------------------------------- periods

def period_text(c: str | Column) -> Column:
    """The period as trimmed text, the form validation and parsing see."""
    return strip_text(_col(c).cast("string"))


def _period_group(c: str | Column, group: int) -> Column:
    """One capture group of the period pattern; empty text when the period
    does not match."""
    return F.regexp_extract(period_text(c), PERIOD_PATTERN, group)


def period_is_valid(c: str | Column) -> Column:
    """Well formed and a month 01..12, in one regex evaluation per row (a
    set lookup on the captured month). Null input is not valid."""
    months = [f"{m:02d}" for m in range(1, 13)]
    return F.coalesce(_period_group(c, 2).isin(*months), F.lit(False))


def period_is_well_formed(c: str | Column) -> Column:
    """True when the period is YYYYMM or YYYY-MM (null input: false)."""
    return F.coalesce(period_text(c).rlike(PERIOD_PATTERN), F.lit(False))


def period_year(c: str | Column) -> Column:
    text = _period_group(c, 1)
    return F.when(text != "", text.cast("int"))


def period_month(c: str | Column) -> Column:
    text = _period_group(c, 2)
    return F.when(text != "", text.cast("int"))


def period_problem(c: str | Column) -> Column:
    """Why a period is rejected: ``format``, ``month`` or null when valid.

    Format is checked first, as a whole file is refused on the first kind of
    problem found."""
    return (F.when(~period_is_well_formed(c), F.lit("format"))
            .when(~period_is_valid(c), F.lit("month")))


def reporting_period_from_text(text: str | Column, as_of_year: int | Column | None = None) -> Column:
    """First ``20dddd`` in the text as ``YYYYMM``; empty text unless the year
    lies in 2000..as_of_year and the month in 1..12. Only the first match is
    considered. ``as_of_year`` defaults to the current year."""
    limit = F.year(F.current_date()) if as_of_year is None else (
        F.lit(as_of_year) if isinstance(as_of_year, int) else as_of_year)

    def checked(found: Column) -> Column:
        year = F.substring(found, 1, 4).try_cast("int")
        month = F.substring(found, 5, 2).try_cast("int")
        ok = (found != "") & year.between(F.lit(2000), limit) & month.between(1, 12)
        return F.when(ok, found).otherwise(F.lit(""))

    return let(F.regexp_extract(_col(text), TITLE_PERIOD_PATTERN, 1), checked)


# -------------------------------------------------------------- file names

def safe_filename(text: str | Column) -> Column:
    """Lower case, runs of characters outside ``[a-z0-9]`` become one ``_``,
    and ``_`` is stripped from both ends."""
    lowered = F.lower(strip_text(text))
    collapsed = F.regexp_replace(lowered, r"[^a-z0-9]+", "_")
    return F.btrim(collapsed, F.lit("_"))


def record_filename(title: str | Column, period: str | Column) -> Column:
    """Stable CSV file name for a link title and its period. Each step's text
    is bound once, so the pattern work is not repeated by the steps after it."""
    period, suffix = _col(period), "csv_document"

    def without_suffix(base: Column) -> Column:
        return F.when(base.endswith(suffix), F.rtrim(
            F.left(base, F.length(base) - len(suffix)), F.lit("_"))).otherwise(base)

    def with_extension(base: Column) -> Column:
        return F.when(base.endswith("csv"), base).otherwise(F.concat(base, F.lit(".csv")))

    def with_period(base: Column) -> Column:
        return F.when(base.startswith(period), base).otherwise(F.concat(period, F.lit("_"), base))

    base = F.replace(safe_filename(title), F.lit("fullanalysis"), F.lit("full_analysis"))
    return let(let(let(base, without_suffix), with_extension), with_period)


def destination_path(period: str | Column, filename: str | Column, prefix: str = "") -> Column:
    """``{prefix/}{YYYY}/{filename}``; a non-empty prefix ends in exactly one
    ``/``."""
    norm = prefix.rstrip("/")
    head = f"{norm}/" if norm else ""
    return F.concat(F.lit(head), F.substring(_col(period), 1, 4), F.lit("/"), _col(filename))
