"""Landing and validated tables built from the driver's parquet tables.

This is the daily ETL (ingest -> land -> validate -> store) run once per
session and data folder; KPI and profile queries then read the stored
validated table, as the marts read the validated table in the source
pipeline. Tables live under the session's shared checkpoint folder.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyledger.operators.quality import validate
from skyledger.session import released_shuffles, scan_tasks, scratch_table_path
from skyledger.sources.bookings import booking_partitions, tpch_bookings
from skyledger.sources.landing import land_run, scan_landing
from skyledger.sources.tables import append_run, scan_run

FIXTURE_RUN_ID = "fixture-run-0001"

_RAW: dict[tuple[str, str], str] = {}
_TABLES: dict[tuple[str, str], tuple[str, str]] = {}


def _key(spark: SparkSession, sf_dir: str) -> tuple[str, str]:
    return spark.sparkContext.applicationId, os.path.abspath(sf_dir)


def build_raw(spark: SparkSession, sf_dir: str, run_id: str = FIXTURE_RUN_ID) -> str:
    """Ingest the bookings feed as one run; returns the landing table's path."""
    key = _key(spark, sf_dir)
    if key not in _RAW:
        path = scratch_table_path(spark, "raw_bookings")
        with released_shuffles(spark):
            land_run(tpch_bookings(spark, sf_dir), run_id, path, num_partitions=booking_partitions(spark, sf_dir))
        _RAW[key] = path
    return _RAW[key]


def build_tables(spark: SparkSession, sf_dir: str, run_id: str = FIXTURE_RUN_ID) -> tuple[str, str]:
    """Ingest the bookings feed as one run, then validate it; returns table paths."""
    key = _key(spark, sf_dir)
    if key in _TABLES:
        return _TABLES[key]
    raw_path = build_raw(spark, sf_dir, run_id)
    val_path = scratch_table_path(spark, "validated_bookings")
    with scan_tasks(spark, booking_partitions(spark, sf_dir)):  # a file a task, so later scans can have as many
        append_run(validate(scan_landing(spark, raw_path, run_id)), val_path)
    _TABLES[key] = (raw_path, val_path)
    return raw_path, val_path


def raw_table(spark: SparkSession, sf_dir: str, run_id: str | None = FIXTURE_RUN_ID,
              with_clock: bool = False) -> DataFrame:
    df = scan_landing(spark, build_raw(spark, sf_dir), run_id)
    return df if with_clock else df.drop("load_timestamp")


def validated_table(spark: SparkSession, sf_dir: str, run_id: str | None = FIXTURE_RUN_ID,
                    with_clock: bool = False) -> DataFrame:
    df = scan_run(spark, build_tables(spark, sf_dir)[1], run_id)
    return df if with_clock else df.drop("load_timestamp")


_FEATURES: dict[tuple[str, str], str] = {}


def features_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Engineered features + split/fold + log target, stored once per session.

    Model fitting reads this table many times (folds, presets), so it is
    written to the shared folder instead of recomputed from the bookings.
    """
    from skyledger.operators.features import engineer, log_target, split_assign
    key = _key(spark, sf_dir)
    if key not in _FEATURES:
        path = scratch_table_path(spark, "features")
        feats = log_target(split_assign(engineer(validated_table(spark, sf_dir))))
        with scan_tasks(spark, booking_partitions(spark, sf_dir)):
            feats.write.mode("overwrite").parquet(path)
        _FEATURES[key] = path
    return spark.read.parquet(_FEATURES[key])


def run_column_last(df: DataFrame) -> DataFrame:
    cols = [c for c in df.columns if c != "pipeline_run_id"]
    return df.select(*cols, F.col("pipeline_run_id"))
