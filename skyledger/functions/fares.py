"""Fare arithmetic: averages over decimals, safe division, labels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def decimal_avg(c) -> Column:
    """Mean of a decimal column as a double: exact decimal sum / non-null count.

    The sum is exact; the single double division gives the same value in any
    engine, unlike ``avg(decimal)`` whose result type differs between engines.
    """
    c = _c(c)
    return F.try_divide(F.sum(c).cast("double"), F.count(c))


def mean_rounded(total, count, digits: int) -> Column:
    """Exact decimal ``total / count`` rounded half-up to ``digits``, as a double.

    ``total`` is a decimal sum, so the quotient is computed in decimal
    arithmetic and rounded exactly; rounding a double mean instead makes
    x.xx5 means land on either side depending on binary representation.
    Zero count gives null.
    """
    q = F.try_divide(_c(total), _c(count).cast("decimal(20,0)"))
    return F.round(q, digits).cast("double")


def decimal_avg_rounded(c, digits: int) -> Column:
    """Mean of a decimal column rounded half-up exactly (see :func:`mean_rounded`)."""
    c = _c(c)
    return mean_rounded(F.sum(c), F.count(c), digits)


def safe_div(a, b) -> Column:
    """a / b with a zero or null denominator giving null (pandas NaN)."""
    return F.try_divide(_c(a).cast("double"), _c(b).cast("double"))


def pct(a, b, digits: int) -> Column:
    """100 * a / b rounded; null when b is zero."""
    return F.round(safe_div(a, b) * F.lit(100.0), digits)


def round_half_up(c, digits: int) -> Column:
    return F.round(_c(c), digits)


def route_label(src="source", dst="destination", sep: str = " → ") -> Column:
    """'src → dst'; null when either side is null (like string + in pandas)."""
    return F.concat(_c(src), F.lit(sep), _c(dst))


def format_bdt(c) -> Column:
    """Taka amount with thousands separators and 2 decimals, e.g. ৳12,345.60."""
    return F.concat(F.lit("৳"), F.format_number(_c(c), 2))
