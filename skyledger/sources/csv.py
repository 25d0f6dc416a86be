"""CSV source/sink: header mapping, tolerant projection, lenient parsing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyledger.functions.codes import to_snake_case
from skyledger.functions.dates import lenient_double, lenient_timestamp
from skyledger.operators.ranking import sequence_index
from skyledger.schemas import CSV_HEADER_MAP, FARE, RAW_COLUMNS

# Raw-column order used to number rows (travel date first: the landing table
# comes out clustered by date, which helps row-group pruning).
ID_ORDER = [
    "departure_time", "airline", "source", "destination", "arrival_time",
    "duration", "stops", "aircraft_type", "booking_class", "booking_source",
    "days_before_departure", "seasonality", "base_fare", "tax_and_surcharge",
    "total_fare",
]


def normalise_headers(df: DataFrame, header_map: dict | None = None) -> DataFrame:
    """Rename known headers by the fixed map, snake_case every other header."""
    header_map = CSV_HEADER_MAP if header_map is None else header_map
    return df.toDF(*[header_map.get(c, to_snake_case(c)) for c in df.columns])


def read_bookings_csv(spark: SparkSession, path: str, header_map: dict | None = None) -> DataFrame:
    """Read booking CSV files as text columns (no inference pass), then rename.

    PERMISSIVE mode keeps malformed lines (missing fields become null) rather
    than failing the job; typed parsing happens in :func:`typed_raw`. Spark
    names columns by one file's header, so every other file's header is held
    against it: a different order ends the read instead of swapping columns.
    """
    reader = spark.read.option("header", True).option("mode", "PERMISSIVE").option("multiLine", False)
    df = reader.option("enforceSchema", False).schema(reader.csv(path).schema).csv(path)
    return normalise_headers(df, header_map)


def typed_raw(df: DataFrame, extra_cols: tuple[str, ...] = ()) -> DataFrame:
    """Tolerant projection onto the raw columns with lenient casts."""
    casts = {
        "departure_time": lenient_timestamp,
        "arrival_time": lenient_timestamp,
        "duration": lenient_double,
        "days_before_departure": lambda c: F.col(c).try_cast("bigint"),
        "base_fare": lambda c: F.col(c).try_cast(FARE),
        "tax_and_surcharge": lambda c: F.col(c).try_cast(FARE),
        "total_fare": lambda c: F.col(c).try_cast(FARE),
    }
    cols = []
    for c in [*RAW_COLUMNS, *extra_cols]:
        if c not in df.columns:
            continue
        dtype = dict(df.dtypes)[c]
        if c in casts and dtype == "string":
            cols.append(casts[c](c).alias(c))
        else:
            cols.append(F.col(c))
    return df.select(*cols)


def ingest(df: DataFrame, run_id: str, with_clock: bool = True,
           extra_cols: tuple[str, ...] = (), num_partitions: int | None = None) -> DataFrame:
    """Landing rows for one run: typed raw columns, row id, run id, load time.

    ``id`` numbers rows by the full raw-column order (ties are identical rows),
    so a re-run of the same input gives the same ids; the numbering is
    distributed (:func:`sequence_index`), not a single-task window.
    """
    raw = typed_raw(df, extra_cols)
    order = [c for c in ID_ORDER if c in raw.columns]
    out = sequence_index(raw, order, name="id", num_partitions=num_partitions)
    out = out.withColumn("pipeline_run_id", F.lit(run_id))
    if with_clock:
        out = out.withColumn("load_timestamp", F.current_timestamp())
    return out


def write_csv(df: DataFrame, path: str, single_file: bool = False) -> None:
    """CSV sink with a header. ``single_file`` is for small result tables only."""
    out = df.coalesce(1) if single_file else df
    out.write.mode("overwrite").option("header", True).csv(path)
