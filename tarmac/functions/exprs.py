"""Shared column expressions: weighted means, safe division, rounding,
month names and NaN handling. Everything here is a plain Column built from
``pyspark.sql.functions`` so it stays inside whole-stage codegen.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# English month names, January first.
MONTH_NAMES = (
    "January", "February", "March", "April", "May", "June",
    "July", "August", "September", "October", "November", "December",
)


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` evaluated once per row, however often
    ``body`` names it (an expression named twice would be written out twice)."""
    return F.element_at(F.transform(F.array(value), body), 1)


def round_half(x: str | Column, digits: int = 0) -> Column:
    """Round half away from zero on the scaled double.

    ``round(x, 2)`` in Spark rounds the decimal text of the double (0.285 ->
    0.29) while most SQL engines round the binary value (0.285 -> 0.28).
    Scaling first, rounding to an integer and scaling back gives the binary
    form in every engine.
    """
    x = _col(x)
    if digits == 0:
        return F.round(x, 0)
    scale = F.lit(float(10 ** digits))
    return F.round(x * scale, 0) / scale


def safe_divide(num: str | Column, den: str | Column) -> Column:
    """Null instead of an error when the denominator is zero (ANSI-safe)."""
    return F.try_divide(_col(num), _col(den))


def weighted_sum_parts(n: str | Column, d: str | Column) -> tuple[Column, Column]:
    """The two aggregates of a weighted mean: sum(n * d) and sum(n)."""
    n, d = _col(n), _col(d)
    return F.sum(n * d), F.sum(n)


def weighted_mean_all(n: str | Column, d: str | Column, digits: int = 0) -> Column:
    """sum(n*d) / nullif(sum(n), 0): a null ``d`` keeps its ``n`` in the
    denominator (variant A of the marts)."""
    num, den = weighted_sum_parts(n, d)
    return round_half(safe_divide(num, den), digits)


def valid_delay_filter(n: str | Column, d: str | Column) -> Column:
    """Rows that count for variant B: positive weight, non-null, non-NaN value."""
    n, d = _col(n), _col(d)
    return (n > 0) & d.isNotNull() & ~F.isnan(d)


def weighted_mean_valid(n: str | Column, d: str | Column, digits: int = 0) -> Column:
    """Weighted mean over valid rows only (variant B), as one aggregate.

    Equivalent to filtering with :func:`valid_delay_filter` first and then
    taking :func:`weighted_mean_all`.
    """
    n, d = _col(n), _col(d)
    ok = valid_delay_filter(n, d)
    num = F.sum(F.when(ok, n * d))
    den = F.sum(F.when(ok, n))
    return round_half(safe_divide(num, den), digits)


def month_name(month: str | Column) -> Column:
    """English month name for 1..12, null otherwise."""
    month = _col(month)
    names = F.array(*[F.lit(name) for name in MONTH_NAMES])
    return F.when(month.between(1, 12), F.try_element_at(names, month.cast("int")))
