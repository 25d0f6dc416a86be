"""Hand-made edge-case frames (raw landing rows)."""

from datetime import datetime
from decimal import Decimal as D

from skyledger.schemas import RAW_SCHEMA

RAW_FIELDS = [f.name for f in RAW_SCHEMA.fields if f.name != "load_timestamp"]


def raw_row(i, airline="A", source="Dhaka", destination="Sylhet", dep=datetime(2024, 3, 1, 10),
            arr=datetime(2024, 3, 1, 11), duration=1.0, stops="Direct", base=D("100.00"),
            tax=D("10.00"), total=D("110.00"), run="r1", klass="Economy", channel="Online Website",
            days=10, seasonality=None):
    return (i, airline, source, destination, dep, arr, duration, stops, "ATR", klass, channel,
            days, seasonality, base, tax, total, run)


def raw_df(spark, rows):
    from pyspark.sql import types as T
    schema = T.StructType([f for f in RAW_SCHEMA.fields if f.name != "load_timestamp"])
    return spark.createDataFrame(rows, schema)


def raw_edge(spark):
    rows = [
        raw_row(0),                                                     # clean
        raw_row(1, base=D("-200.00"), total=D("-190.00")),              # negative base
        raw_row(2, base=None, total=None),                              # null base
        raw_row(3, tax=None, total=None),                               # null tax
        raw_row(4, airline=None),                                       # null airline
        raw_row(5, destination="Paris"),                                # unknown city
        raw_row(6, total=D("999.00")),                                  # stated total wrong
        raw_row(7), raw_row(7),                                         # exact duplicate
        raw_row(8, dep=None),                                           # unparsable timestamp -> null
        raw_row(9, duration=None),                                      # non-numeric duration -> null
    ]
    return raw_df(spark, rows)
