"""Daily pipeline: ingest -> land -> validate -> transfer -> SQL marts.

Each stage is a Spark job writing a run-partitioned parquet table; a stage
re-run for the same run id replaces that run's partition (idempotent), and
the next stage reads the previous stage's table, never an in-process cache.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from skyledger.operators import marts as M
from skyledger.operators.quality import run_log, validate, validation_audit
from skyledger.sources.csv import read_bookings_csv
from skyledger.sources.landing import land_run, scan_landing
from skyledger.sources.tables import append_run, replace_table, scan_run, transfer_run

# Columns the analytics copy keeps (departure_time is carried through so the
# seasonal mart sees real months).
ANALYTICS_COLUMNS = ["airline", "source", "destination", "departure_time",
                     "base_fare", "tax_and_surcharge", "total_fare", "pipeline_run_id", "load_timestamp"]


@dataclass(frozen=True)
class Warehouse:
    """Table locations under one root folder (shared storage on a cluster)."""

    root: str

    def path(self, name: str) -> str:
        return f"{self.root.rstrip('/')}/{name}"

    @property
    def raw(self):
        return self.path("raw_bookings")

    @property
    def validated(self):
        return self.path("validated_bookings")

    @property
    def analytics(self):
        return self.path("analytics_bookings")

    @property
    def audit(self):
        return self.path("validation_audit")

    @property
    def runs(self):
        return self.path("pipeline_runs")


def stage_ingest(spark: SparkSession, source: DataFrame, wh: Warehouse, run_id: str | None = None) -> dict:
    run_id = run_id or str(uuid.uuid4())
    return land_run(source, run_id, wh.raw)


def stage_validate(spark: SparkSession, wh: Warehouse, run_id: str) -> dict:
    obs = Observation("validate")
    raw = scan_landing(spark, wh.raw, run_id)
    append_run(validate(raw).observe(obs, F.count(F.lit(1)).alias("rows")), wh.validated)
    v = scan_run(spark, wh.validated, run_id)
    now = F.current_timestamp()
    append_run(validation_audit(raw, v).withColumns({"checked_at": now, "pipeline_run_id": F.lit(run_id)}),
               wh.audit)
    append_run(run_log(raw, v).withColumn("end_time", now).withColumnRenamed("run_id", "pipeline_run_id"),
               wh.runs)
    return {"validated_rows": int(obs.get["rows"])}


def stage_transfer(spark: SparkSession, wh: Warehouse, run_id: str) -> dict:
    return transfer_run(spark, wh.validated, wh.analytics, run_id, ANALYTICS_COLUMNS)


def stage_marts(spark: SparkSession, wh: Warehouse) -> dict:
    """Rebuild the three SQL marts over every run in the analytics table."""
    stg = M.stg_bookings(spark.read.parquet(wh.analytics))
    out = {}
    for name, df in (("kpi_avg_fare", M.kpi_avg_fare(stg)),
                     ("kpi_popular_routes", M.kpi_popular_routes(stg)),
                     ("kpi_seasonal_variation", M.kpi_seasonal_variation(stg))):
        replace_table(df, wh.path(name))
        out[name] = wh.path(name)
    return out


def run_daily_csv(spark: SparkSession, csv_path: str, wh: Warehouse, run_id: str | None = None) -> dict:
    """The whole daily flow from a booking CSV drop."""
    info = stage_ingest(spark, read_bookings_csv(spark, csv_path), wh, run_id)
    info.update(stage_validate(spark, wh, info["run_id"]))
    info.update(stage_transfer(spark, wh, info["run_id"]))
    info["marts"] = stage_marts(spark, wh)
    return info
