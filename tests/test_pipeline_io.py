import os
import time

import pytest
from pyspark.sql import functions as F

from conftest import SF001
from skyledger.plans.etl import Warehouse, run_daily_csv, stage_ingest
from skyledger.plans.kpis import compute_all_kpis
from skyledger.sources.bookings import tpch_bookings
from skyledger.sources.csv import ingest, read_bookings_csv, write_csv
from skyledger.sources.tables import append_run, scan_run

CSV_HEADERS = {
    "airline": "Airline", "source": "Source", "destination": "Destination",
    "departure_time": "Departure Date & Time", "arrival_time": "Arrival Date & Time",
    "duration": "Duration (hrs)", "stops": "Stopovers", "aircraft_type": "Aircraft Type",
    "booking_class": "Class", "booking_source": "Booking Source",
    "days_before_departure": "Days Before Departure", "seasonality": "Seasonality",
    "base_fare": "Base Fare (BDT)", "tax_and_surcharge": "Tax & Surcharge (BDT)",
    "total_fare": "Total Fare (BDT)",
}


def bookings_csv(spark, path):
    b = tpch_bookings(spark, SF001).drop("booking_key")
    write_csv(b.select(*[F.col(c).alias(h) for c, h in CSV_HEADERS.items()]), path)
    return b


def test_csv_round_trip_equals_parquet_ingest(spark, tmpdir_path):
    path = os.path.join(tmpdir_path, "drop")
    b = bookings_csv(spark, path)
    from_csv = ingest(read_bookings_csv(spark, path), "r1", with_clock=False)
    from_pq = ingest(b, "r1", with_clock=False)
    assert from_csv.count() == from_pq.count() > 0
    assert from_csv.exceptAll(from_pq).count() == 0


def test_daily_flow_and_kpis(spark, tmpdir_path):
    path = os.path.join(tmpdir_path, "drop")
    bookings_csv(spark, path)
    wh = Warehouse(os.path.join(tmpdir_path, "wh"))
    info = run_daily_csv(spark, path, wh, run_id="day-1")
    assert info["rows"] == info["validated_rows"] == info["rows_transferred"] > 0
    marts = {k: spark.read.parquet(p).count() for k, p in info["marts"].items()}
    assert marts["kpi_avg_fare"] > 0 and marts["kpi_seasonal_variation"] > marts["kpi_avg_fare"] - 1
    audit = spark.read.parquet(wh.audit).where("pipeline_run_id = 'day-1'")
    assert audit.count() == 10 and audit.where("checked_at IS NULL").count() == 0
    runs = spark.read.parquet(wh.runs).where("pipeline_run_id = 'day-1'").collect()
    assert runs[0]["status"] == "success" and runs[0]["end_time"] is not None
    res = compute_all_kpis(spark, wh.validated, "day-1", out_root=os.path.join(tmpdir_path, "kpi"))
    assert res["summary"]["total_rows"] == info["rows"]
    assert res["summary"]["kpi_popular_routes_rows"] == res["kpis"]["kpi_popular_routes"].count()
    written = spark.read.parquet(os.path.join(tmpdir_path, "kpi", "kpi_avg_fare_by_airline"))
    assert "computed_at" in written.columns
    with pytest.raises(ValueError):
        compute_all_kpis(spark, wh.validated, "no-such-run")


def test_append_is_idempotent_per_run(spark, tmpdir_path):
    wh = Warehouse(os.path.join(tmpdir_path, "wh2"))
    b = tpch_bookings(spark, SF001)
    stage_ingest(spark, b, wh, "a")
    stage_ingest(spark, b, wh, "b")
    stage_ingest(spark, b, wh, "a")  # re-run of run a replaces it
    n = b.count()
    assert scan_run(spark, wh.raw, "a").count() == n
    assert scan_run(spark, wh.raw).count() == 2 * n
    plan = scan_run(spark, wh.raw, "a")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "pipeline_run_id" in plan


def test_incremental_stream_matches_batch(spark, tmpdir_path):
    from skyledger.streaming import start_incremental_ingest
    drop = os.path.join(tmpdir_path, "drops")
    bookings_csv(spark, drop)
    wh = Warehouse(os.path.join(tmpdir_path, "wh3"))
    q = start_incremental_ingest(spark, drop, wh, os.path.join(tmpdir_path, "stream-ckpt"))
    q.awaitTermination(300)
    assert q.exception() is None
    v = spark.read.parquet(wh.validated)
    assert v.count() == tpch_bookings(spark, SF001).count()
    runs = v.select("pipeline_run_id").distinct().count()
    assert runs >= 1
    # a second stream into the same warehouse adds runs, it replaces none
    q = start_incremental_ingest(spark, drop, wh, os.path.join(tmpdir_path, "stream-ckpt-2"))
    q.awaitTermination(300)
    assert spark.read.parquet(wh.validated).select("pipeline_run_id").distinct().count() == 2 * runs


def test_landing_without_its_offsets_is_an_error(spark, tmpdir_path):
    from skyledger.sources.landing import land_run, offsets_path, scan_landing
    b, path = tpch_bookings(spark, SF001).limit(500), os.path.join(tmpdir_path, "land")
    land_run(b, "r", path)
    assert scan_landing(spark, path, "r").select("id").distinct().count() == 500
    old = spark.read.parquet(offsets_path(path)).collect()
    land_run(b.limit(400), "r", path)
    spark.createDataFrame(old, spark.read.parquet(offsets_path(path)).schema).write.mode("overwrite") \
        .partitionBy("pipeline_run_id").parquet(offsets_path(path))
    assert scan_landing(spark, path, "r").count() == 400
    with pytest.raises(Exception, match="no offsets"):
        scan_landing(spark, path, "r").collect()


def test_csv_headers_of_another_order_are_an_error(spark, tmpdir_path):
    from skyledger.sources.csv import read_bookings_csv
    drop = os.path.join(tmpdir_path, "orders")
    os.makedirs(drop)
    for name, text in (("a", "Airline,Source\nX,DAC\n"), ("b", "Source,Airline\nDAC,X\n")):
        with open(os.path.join(drop, f"{name}.csv"), "w") as f:
            f.write(text)
    with pytest.raises(Exception, match="(?i)header"):
        read_bookings_csv(spark, drop).collect()


def test_model_save_load(spark, tmpdir_path):
    from pyspark.ml import PipelineModel
    from skyledger.operators import models as ML
    from skyledger.plans.fixture import features_table
    feats = features_table(spark, SF001)
    spec = ML.ModelSpec("Decision Tree", "tree", {"maxDepth": 4})
    model = ML.pipeline(spec).fit(feats.where("split = 'train'"))
    p = os.path.join(tmpdir_path, "model")
    model.write().overwrite().save(p)
    again = PipelineModel.load(p)
    a = model.transform(feats).select("raw_id", "prediction")
    b = again.transform(feats).select("raw_id", "prediction")
    assert a.exceptAll(b).count() == 0


def test_temp_view_model_layer(spark):
    from skyledger.operators import marts as M
    from skyledger.plans.fixture import validated_table
    M.stg_bookings(validated_table(spark, SF001)).createOrReplaceTempView("stg_flights")
    sql = spark.sql("SELECT airline, COUNT(*) AS bookings FROM stg_flights GROUP BY airline")
    api = M.kpi_avg_fare(M.stg_bookings(validated_table(spark, SF001))).select("airline", "bookings")
    assert sql.exceptAll(api).count() == 0


def test_daily_job_entry_point(spark, tmpdir_path):
    from skyledger.plans.daily_job import main
    drop = os.path.join(tmpdir_path, "drop")
    bookings_csv(spark, drop)
    out = main(["--csv", drop, "--warehouse", os.path.join(tmpdir_path, "whd"), "--run-id", "d1"])
    assert out["rows"] == out["validated_rows"] == out["rows_transferred"] == out["summary"]["total_rows"]
    kpi = spark.read.parquet(os.path.join(tmpdir_path, "whd", "kpis", "kpi_route_airline_performance"))
    assert kpi.count() > 0
