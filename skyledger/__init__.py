"""skyledger: booking-fare analytics on Spark (DataFrame, SQL and Spark ML)."""

__version__ = "0.1.0"
