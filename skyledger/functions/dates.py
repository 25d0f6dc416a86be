"""Date/time parsing, calendar parts and season rules."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from skyledger.schemas import OFF_PEAK_LABEL, PEAK_MONTHS, PEAK_SEASONS


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def lenient_timestamp(c) -> Column:
    """Parse text to a zone-less timestamp; unparsable text -> null (errors='coerce').

    A direct ``try_cast`` to ``timestamp_ntz`` never consults the session
    time zone, so wall-clock times cannot shift across a DST gap.
    """
    return _c(c).cast("string").try_cast("timestamp_ntz")


def lenient_double(c) -> Column:
    """Parse text to a double; non-numeric text -> null."""
    return _c(c).try_cast("double")


def weekday_mon0(c) -> Column:
    """Day of week with Monday = 0 (``dayofweek`` is Sunday = 1)."""
    return F.weekday(_c(c))


def hours_between(start, end) -> Column:
    """(end - start) in hours as a double.

    Zone-less timestamps are subtracted as a day-time interval and its
    fields summed: ``timestamp_diff`` would route through the session time
    zone and lose or gain an hour across a DST change.
    """
    iv = _c(end) - _c(start)
    secs = (F.extract(F.lit("DAY"), iv) * 86400 + F.extract(F.lit("HOUR"), iv) * 3600
            + F.extract(F.lit("MINUTE"), iv) * 60 + F.extract(F.lit("SECOND"), iv))
    return secs.cast("double") / F.lit(3600.0)


def month_day(c) -> Column:
    """month * 100 + day, the key season windows are written in."""
    c = _c(c)
    return F.month(c) * 100 + F.dayofmonth(c)


def _season_case(c) -> Column:
    md = month_day(c)
    expr = None
    for label, windows in PEAK_SEASONS:
        hit = None
        for m1, d1, m2, d2 in windows:
            w = md.between(m1 * 100 + d1, m2 * 100 + d2)
            hit = w if hit is None else (hit | w)
        expr = F.when(hit, F.lit(label)) if expr is None else expr.when(hit, F.lit(label))
    return expr


def season_label(c) -> Column:
    """First peak season (list order) whose window holds the date, else 'Regular'.

    Written as one CASE chain: a projection inside whole-stage codegen instead
    of a range join against a window table.
    """
    return F.coalesce(_season_case(c), F.lit(OFF_PEAK_LABEL))


def is_peak_season(c) -> Column:
    """1 when the date falls in any peak-season window, else 0 (null date -> 0)."""
    return F.when(_season_case(c).isNotNull(), F.lit(1)).otherwise(F.lit(0))


def peak_month_label(c) -> Column:
    """'Peak' for departures in the peak months, else 'Off-Peak' (null -> Off-Peak)."""
    return F.when(F.month(_c(c)).isin(*PEAK_MONTHS), F.lit("Peak")).otherwise(F.lit("Off-Peak"))
