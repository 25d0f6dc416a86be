"""Sources and sinks: bookings feeds, CSV ingest, run-partitioned tables."""

from skyledger.sources.bookings import read_table, tpch_bookings  # noqa: F401
from skyledger.sources.csv import ingest, read_bookings_csv, write_csv  # noqa: F401
from skyledger.sources.landing import land_run, scan_landing  # noqa: F401
from skyledger.sources.tables import (  # noqa: F401
    RunTable, append_run, replace_table, scan_run, transfer_run,
)
