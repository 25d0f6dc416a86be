"""Column-expression helpers (built-in Spark functions only, no UDFs)."""

from skyledger.functions.fares import (  # noqa: F401
    decimal_avg, decimal_avg_rounded, format_bdt, mean_rounded, pct, round_half_up, route_label, safe_div,
)
from skyledger.functions.dates import (  # noqa: F401
    hours_between, is_peak_season, lenient_double, lenient_timestamp,
    month_day, peak_month_label, season_label, weekday_mon0,
)
from skyledger.functions.codes import encode_stops, to_snake_case  # noqa: F401
