"""Cleaning, row status, season classification and data-quality reports.

Every check is a column expression or one aggregate pass; no row is dropped
by validation (bad rows are flagged and stay auditable).
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skyledger.functions.codes import encode_stops
from skyledger.functions.dates import is_peak_season, season_label
from skyledger.schemas import FARE, REQUIRED_COLUMNS, VALID_CITIES, VALIDATED_COLUMNS
from skyledger.session import released_shuffles, scan_tasks, scratch_table_path, setting

STATUS_VALUES = ("valid", "corrected", "flagged")

# Row-level notes: (note text, condition on the raw row). Order = note order.
def _notes(raw_total, new_total):
    base, tax = F.col("base_fare"), F.col("tax_and_surcharge")
    corrections = [
        ("negative base_fare made positive", base < 0),
        ("missing tax_and_surcharge set to 0", tax.isNull()),
        ("total_fare recomputed", raw_total.isNotNull() & (raw_total != new_total)),
    ]
    problems = [(f"missing {c}", F.col(c).isNull())
                for c in ("airline", "source", "destination", "base_fare")]
    return corrections, problems


def validate(raw: DataFrame) -> DataFrame:
    """Cleaned rows: |base|, tax default 0, total = base + tax, season, status.

    Status is 'flagged' when a required field cannot be repaired (null
    airline, source, destination or base fare), 'corrected' when a fare was
    repaired, else 'valid'. ``validation_notes`` lists every rule applied.
    """
    raw_total = F.col("total_fare") if "total_fare" in raw.columns else F.lit(None).cast(FARE)
    base = F.abs(F.col("base_fare")).cast(FARE)
    tax = F.coalesce(F.col("tax_and_surcharge"), F.lit(0).cast(FARE)).cast(FARE)
    total = (base + tax).cast(FARE)
    corrections, problems = _notes(raw_total, total)
    any_problem = F.lit(False)
    for _, cond in problems:
        any_problem = any_problem | F.coalesce(cond, F.lit(False))
    any_fix = F.lit(False)
    for _, cond in corrections:
        any_fix = any_fix | F.coalesce(cond, F.lit(False))
    status = (F.when(any_problem, "flagged").when(any_fix, "corrected").otherwise("valid"))
    notes = F.nullif(F.concat_ws("; ", *[F.when(cond, F.lit(text))
                                          for text, cond in corrections + problems]), F.lit(""))
    dep = F.col("departure_time")
    cols = {
        "raw_id": F.col("id"),
        "airline": F.col("airline"),
        "source": F.col("source"),
        "destination": F.col("destination"),
        "departure_time": dep,
        "arrival_time": F.col("arrival_time"),
        "duration": F.col("duration"),
        "duration_minutes": F.round(F.col("duration") * 60).cast("int"),
        "stops": encode_stops("stops"),
        "aircraft_type": F.col("aircraft_type"),
        "booking_class": F.col("booking_class"),
        "booking_source": F.col("booking_source"),
        "days_before_departure": F.col("days_before_departure"),
        "seasonality": F.col("seasonality"),
        "base_fare": base,
        "tax_and_surcharge": tax,
        "total_fare": total,
        "travel_date": F.to_date(dep),
        "is_peak_season": is_peak_season(dep),
        "season_label": season_label(dep),
        "validation_status": status,
        "validation_notes": notes,
        "pipeline_run_id": F.col("pipeline_run_id"),
    }
    order = list(VALIDATED_COLUMNS)
    if "load_timestamp" in raw.columns:
        cols["load_timestamp"] = F.col("load_timestamp")
        order.append("load_timestamp")
    return raw.select(*[cols[c].alias(c) for c in order])


def season_classify(df: DataFrame, date_col: str = "departure_time") -> DataFrame:
    """Adds ``is_peak_season`` and ``season_label`` from the peak-season windows."""
    return df.withColumns({"is_peak_season": is_peak_season(date_col),
                           "season_label": season_label(date_col)})


# Column defaults on write (what the table DDL declares).
DEFAULTS = {"tax_and_surcharge": 0, "stops": 0, "is_peak_season": 0, "validation_status": "valid"}
DEFAULT_TYPES = {"tax_and_surcharge": FARE}


def apply_defaults(df: DataFrame, with_clock: bool = True) -> DataFrame:
    """Fill declared defaults for null or absent columns in the writer projection."""
    out = df
    for c, value in DEFAULTS.items():
        default = F.lit(value).cast(DEFAULT_TYPES[c]) if c in DEFAULT_TYPES else F.lit(value)
        out = out.withColumn(c, F.coalesce(F.col(c), default) if c in out.columns else default)
    if with_clock:
        ts = F.current_timestamp()
        out = out.withColumn("load_timestamp",
                             F.coalesce(F.col("load_timestamp"), ts) if "load_timestamp" in out.columns else ts)
    return out


def dq_required(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Per required column: present?, rows checked, null rows (one aggregate pass)."""
    columns = REQUIRED_COLUMNS if columns is None else columns
    present = [c for c in columns if c in df.columns]
    agg = df.agg(F.count(F.lit(1)).alias("_rows"),
                 *[F.count_if(F.col(c).isNull()).alias(f"_n{i}") for i, c in enumerate(present)])
    rows = []
    for i, c in enumerate(columns):
        if c in present:
            rows.append(F.struct(F.lit(c).alias("column_name"), F.lit(True).alias("present"),
                                 F.col("_rows").alias("records_checked"),
                                 F.col(f"_n{present.index(c)}").alias("null_count")))
        else:
            rows.append(F.struct(F.lit(c).alias("column_name"), F.lit(False).alias("present"),
                                 F.col("_rows").alias("records_checked"),
                                 F.col("_rows").alias("null_count")))
    return agg.select(F.inline(F.array(*rows)))


def fare_mismatch(raw: DataFrame) -> DataFrame:
    """Raw rows whose stated total differs from |base| + coalesce(tax, 0)."""
    recomputed = (F.abs(F.col("base_fare")) + F.coalesce(F.col("tax_and_surcharge"), F.lit(0).cast(FARE))).cast(FARE)
    return (raw.where(F.col("total_fare").isNotNull() & recomputed.isNotNull()
                      & (F.col("total_fare") != recomputed))
            .select(F.col("id").alias("raw_id"), "base_fare", "tax_and_surcharge",
                    F.col("total_fare").alias("stated_total"),
                    recomputed.alias("recomputed_total"),
                    (recomputed - F.col("total_fare")).cast(FARE).alias("difference")))


def status_counts(validated: DataFrame) -> DataFrame:
    """Rows per validation status (every status listed, zero when absent)."""
    agg = validated.agg(*[F.count_if(F.col("validation_status") == s).alias(s) for s in STATUS_VALUES])
    return agg.select(F.inline(F.array(*[
        F.struct(F.lit(s).alias("validation_status"), F.col(s).alias("rows")) for s in STATUS_VALUES])))


def validation_audit(raw: DataFrame, validated: DataFrame) -> DataFrame:
    """Audit rows (check_name, PASS/FAIL/WARN, records checked/failed, details).

    One aggregate pass over each table, then unpivoted to one row per check.
    Corrections are WARN (the row was repaired), missing required values FAIL.
    """
    r = raw.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(F.col("base_fare") < 0).alias("negative_base"),
        F.count_if(F.col("tax_and_surcharge").isNull()).alias("null_tax"),
        *[F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in ("airline", "source", "destination", "base_fare")],
    )
    v = validated.agg(
        F.count(F.lit(1)).alias("v_rows"),
        F.count_if(F.col("total_fare") != F.col("base_fare") + F.col("tax_and_surcharge")).alias("v_total_bad"),
        F.count_if(F.col("base_fare") < 0).alias("v_negative"),
        F.count_if(F.col("validation_status") == "flagged").alias("v_flagged"),
    )
    both = r.crossJoin(v)  # one row x one row

    def check(name, failed, checked, fail_result, detail):
        return F.struct(
            F.lit(name).alias("check_name"),
            F.when(failed == 0, F.lit("PASS")).otherwise(F.lit(fail_result)).alias("check_result"),
            checked.alias("records_checked"), failed.alias("records_failed"),
            F.lit(detail).alias("details"))

    checks = [
        check("row_count_preserved", F.abs(F.col("rows") - F.col("v_rows")), F.col("rows"), "FAIL",
              "validated rows equal raw rows"),
        check("negative_base_fare", F.col("negative_base"), F.col("rows"), "WARN",
              "negative base fares corrected with abs()"),
        check("null_tax_and_surcharge", F.col("null_tax"), F.col("rows"), "WARN",
              "null tax set to 0"),
        *[check(f"required_{c}", F.col(f"null_{c}"), F.col("rows"), "FAIL", f"{c} must not be null")
          for c in ("airline", "source", "destination", "base_fare")],
        check("total_equals_base_plus_tax", F.col("v_total_bad"), F.col("v_rows"), "FAIL",
              "total_fare = base_fare + tax_and_surcharge after cleaning"),
        check("no_negative_fares_after_cleaning", F.col("v_negative"), F.col("v_rows"), "FAIL",
              "base_fare >= 0 after cleaning"),
        check("flagged_rows", F.col("v_flagged"), F.col("v_rows"), "WARN",
              "rows kept but flagged for review"),
    ]
    return both.select(F.inline(F.array(*checks)))


def run_log(raw: DataFrame, validated: DataFrame) -> DataFrame:
    """One row per run: rows ingested / validated / rejected and a status.

    Rejected = flagged validated rows plus raw rows with no validated row.
    Status 'success' when nothing was lost, else 'failed'.
    """
    r = raw.groupBy("pipeline_run_id").agg(F.count(F.lit(1)).alias("rows_ingested"))
    v = validated.groupBy("pipeline_run_id").agg(
        F.count(F.lit(1)).alias("rows_validated"),
        F.count_if(F.col("validation_status") == "flagged").alias("rows_flagged"))
    j = r.join(v, "pipeline_run_id", "full")
    ing = F.coalesce(F.col("rows_ingested"), F.lit(0))
    val = F.coalesce(F.col("rows_validated"), F.lit(0))
    flagged = F.coalesce(F.col("rows_flagged"), F.lit(0))
    missing = F.greatest(ing - val, F.lit(0))
    return j.select(
        F.col("pipeline_run_id").alias("run_id"),
        ing.alias("rows_ingested"), val.alias("rows_validated"),
        (flagged + missing).cast("bigint").alias("rows_rejected"),
        F.when((ing == val) & (ing > 0), F.lit("success")).otherwise(F.lit("failed")).alias("status"))


def invalid_city_rows(df: DataFrame, cols=("source", "destination"), cities=None) -> DataFrame:
    """Rows whose source or destination is not a known city (null counts as unknown).

    The city list is a fixed 10-value set, so membership is an ``IN`` set test
    inside the scan's codegen stage rather than a join.
    """
    cities = VALID_CITIES if cities is None else cities
    flags = {f"{c}_valid": F.coalesce(F.col(c).isin(*cities), F.lit(False)) for c in cols}
    out = df.withColumns(flags)
    bad = None
    for c in cols:
        e = ~F.col(f"{c}_valid")
        bad = e if bad is None else bad | e
    return out.where(bad)


def rejected_rows(raw: DataFrame, validated: DataFrame) -> DataFrame:
    """Raw rows without a clean validated row: no match on (run, raw_id), or flagged."""
    ok = validated.where(F.col("validation_status") != "flagged").select(
        "pipeline_run_id", F.col("raw_id").alias("id"))
    return raw.join(ok, ["pipeline_run_id", "id"], "left_anti")


#: Slots (2^SLOTS) of the bitmap of row hashes that come again, and bits (2^PIECE) of one row of it.
SLOTS, PIECE = 27, 15
#: Types whose equal values have equal hashes.
HASHED = (T.NumericType, T.BooleanType, T.DateType, T.TimestampType, T.TimestampNTZType, T.BinaryType)


def clean_dedup(df: DataFrame, subset: list[str] | None = None, num_partitions: int | None = None) -> DataFrame:
    """Full-row (or subset) de-duplication; a hash-partitioned distinct.

    ``num_partitions`` deals the rows to that many tasks first, where the
    session's number is too small for them: a task then keeps only the distinct
    rows of its own share, neither those of a whole scan task nor more as the table grows.
    Rows whose hash occurs once stay where they are: 8 bytes a row are shuffled to
    find them, the others whole, once a batch. ``df`` is read three times and must
    give the same rows each time."""
    keys = subset or df.columns
    if num_partitions and num_partitions > int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")):
        if all(isinstance(df.schema[c].dataType, HASHED) or df.schema[c].dataType == T.StringType() for c in keys):
            once, again = _by_repeats(df, keys, num_partitions)
            again = again.mapInArrow(_once_a_batch(keys), df.schema).repartition(num_partitions, *keys)
            return once.unionByName(again.dropDuplicates(keys))
        df = df.repartition(num_partitions, *keys)
    return df.dropDuplicates(subset) if subset else df.dropDuplicates()


def _by_repeats(df: DataFrame, keys: list[str], num_partitions: int) -> tuple[DataFrame, DataFrame]:
    """(rows of which no other has the same ``keys``, all others and a few of the former)."""
    spark, path = df.sparkSession, scratch_table_path(df.sparkSession, "repeats")
    floats = {f.name for f in df.schema if isinstance(f.dataType, T.FractionalType) and not isinstance(f.dataType, T.DecimalType)}
    hashed = F.xxhash64(*[F.col(c) + F.lit(0.0) if c in floats else F.col(c) for c in keys])  # -0.0 is 0.0
    slot = F.col("_h").bitwiseAND(F.lit((1 << SLOTS) - 1))
    piece, place = F.shiftright(slot, PIECE), slot.bitwiseAND(F.lit((1 << PIECE) - 1))
    with scan_tasks(spark, num_partitions), setting(spark, "spark.sql.shuffle.partitions", str(num_partitions)), released_shuffles(spark):
        (df.select(hashed.alias("_h")).groupBy("_h").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
         .groupBy(piece.alias("_piece")).agg(F.bitmap_construct_agg(place).alias("_bits"))
         .write.parquet(path))
    bits = F.broadcast(spark.read.schema("_piece bigint, _bits binary").parquet(path))  # 2^SLOTS bits at most
    marked = df.withColumn("_h", hashed).withColumn("_piece", piece).join(bits, "_piece", "left")
    byte = F.conv(F.hex(F.substring("_bits", F.shiftright(place, 3).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    marked = marked.withColumn("_again", F.col("_bits").isNotNull() & (F.getbit(byte, place.bitwiseAND(F.lit(7)).cast("int")) == 1))
    return (marked.where(~F.col("_again")).select(*df.columns), marked.where("_again").select(*df.columns))


def _once_a_batch(keys: list[str]):
    """Equal rows that lie together become one before they are shuffled."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            t = pa.Table.from_batches([b])
            at = t.select(keys).append_column("_at", pa.array(range(len(t)), pa.int64()))
            first = at.group_by(keys, use_threads=False).aggregate([("_at", "min")]).column("_at_min")
            yield from t.take(first).combine_chunks().to_batches()
    return run
