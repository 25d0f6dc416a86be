"""Registered queries: name -> callable(spark, sf_dir) -> DataFrame.

Every query reads the driver's tables (through the landing / validated
tables Spark builds from them) over whole tables.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyledger.functions.codes import encode_stops
from skyledger.functions.dates import hours_between, lenient_double, lenient_timestamp
from skyledger.operators import features as FE
from skyledger.operators import linear as L
from skyledger.operators import marts as M
from skyledger.operators import profile as P
from skyledger.operators import quality as Q
from skyledger.plans import fare_model as FM
from skyledger.plans.etl import ANALYTICS_COLUMNS as ETL_ANALYTICS_COLUMNS
from skyledger.plans.fixture import FIXTURE_RUN_ID, build_tables, features_table, raw_table, validated_table
from skyledger.session import scratch_table_path
from skyledger.sources.bookings import booking_partitions, tpch_bookings
from skyledger.sources.csv import ingest
from skyledger.sources.tables import scan_run, transfer_run

Query = Callable[[SparkSession, str], DataFrame]
RUN = FIXTURE_RUN_ID

# The analytics copy's columns, without the load clock (kept out of checked results).
ANALYTICS_COLUMNS = [c for c in ETL_ANALYTICS_COLUMNS if c != "load_timestamp"]


def _v(spark, sf):
    return validated_table(spark, sf)


def _raw(spark, sf):
    return raw_table(spark, sf)


def _stg(spark, sf):
    return M.stg_bookings(validated_table(spark, sf), with_clock=False)


def _feat(spark, sf):
    return features_table(spark, sf)


def _scaled(spark, sf):
    f = _feat(spark, sf)
    cols = FE.NUM_FEATURES
    return FE.apply_scaler(f, FE.fit_scaler(f.where(F.col("split") == "train"), cols), cols, digits=6) \
        .select("raw_id", *cols)


def _transfer(spark, sf):
    _, val_path = build_tables(spark, sf)
    dst = scratch_table_path(spark, "analytics_bookings")
    transfer_run(spark, val_path, dst, RUN, ANALYTICS_COLUMNS)
    return scan_run(spark, dst, RUN)


QUERIES: dict[str, Query] = {
    # sources / sinks
    "ingest_bookings": lambda s, sf: ingest(tpch_bookings(s, sf), RUN, with_clock=False,
                                            num_partitions=booking_partitions(s, sf)),
    "scan_run": lambda s, sf: _raw(s, sf),
    "transfer_run": _transfer,
    "apply_defaults": lambda s, sf: Q.apply_defaults(_v(s, sf), with_clock=False).select(
        "raw_id", "stops", "tax_and_surcharge", "is_peak_season", "validation_status"),
    # validation and quality
    "validate_bookings": lambda s, sf: _v(s, sf),
    "season_classify": lambda s, sf: Q.season_classify(_raw(s, sf)).select(
        F.col("id").alias("raw_id"), "departure_time", "is_peak_season", "season_label"),
    "dq_required": lambda s, sf: Q.dq_required(_raw(s, sf)),
    "fare_mismatch": lambda s, sf: Q.fare_mismatch(_raw(s, sf)),
    "validation_status": lambda s, sf: Q.status_counts(_v(s, sf)),
    "validation_audit": lambda s, sf: Q.validation_audit(_raw(s, sf), _v(s, sf)),
    "run_log": lambda s, sf: Q.run_log(_raw(s, sf), _v(s, sf)),
    "invalid_city_rows": lambda s, sf: Q.invalid_city_rows(_v(s, sf)).select(
        "raw_id", "source", "destination", "source_valid", "destination_valid"),
    "rejected_rows": lambda s, sf: Q.rejected_rows(_raw(s, sf), _v(s, sf)),
    "clean_dedup": lambda s, sf: Q.clean_dedup(_raw(s, sf).drop("id"), num_partitions=booking_partitions(s, sf)),
    # SQL marts
    "stg_bookings": _stg,
    "kpi_avg_fare": lambda s, sf: M.kpi_avg_fare(_stg(s, sf)),
    "kpi_popular_routes": lambda s, sf: M.kpi_popular_routes(_stg(s, sf)),
    "kpi_seasonal_variation": lambda s, sf: M.kpi_seasonal_variation(_stg(s, sf)),
    # run-scoped KPIs
    "kpi_avg_fare_by_airline": lambda s, sf: M.kpi_avg_fare_by_airline(_v(s, sf), RUN),
    "kpi_seasonal_premium": lambda s, sf: M.kpi_seasonal_premium(_v(s, sf), RUN),
    "kpi_booking_count": lambda s, sf: M.kpi_booking_count(_v(s, sf), RUN),
    "kpi_popular_routes_topn": lambda s, sf: M.kpi_popular_routes_topn(_v(s, sf), RUN),
    "kpi_route_airline": lambda s, sf: M.kpi_route_airline(_v(s, sf), RUN),
    "kpi_run_summary": lambda s, sf: M.kpi_run_summary(_v(s, sf), RUN),
    "dominant_airline": lambda s, sf: M.dominant_airline(_v(s, sf)),
    "distinct_routes": lambda s, sf: M.distinct_routes(_v(s, sf)),
    # exploratory summaries and reports
    "airline_avg_fare": lambda s, sf: M.airline_avg_fare(_v(s, sf)),
    "season_avg_fare": lambda s, sf: M.season_avg_fare(_v(s, sf)),
    "top_route": lambda s, sf: M.top_route(_v(s, sf)),
    "expensive_routes": lambda s, sf: M.expensive_routes(_v(s, sf), 5),
    "airline_fare_spread": lambda s, sf: M.airline_fare_spread(_v(s, sf)),
    "season_premium": lambda s, sf: M.season_premium(_v(s, sf)),
    "report_top_routes": lambda s, sf: M.report_top_routes(M.kpi_popular_routes(_stg(s, sf))),
    "report_avg_fare": lambda s, sf: M.report_avg_fare(M.kpi_avg_fare(_stg(s, sf))),
    "report_seasonal": lambda s, sf: M.report_seasonal(M.kpi_seasonal_variation(_stg(s, sf))),
    # profiling (tables behind the EDA plots)
    "profile_nonnull": lambda s, sf: P.profile_nonnull(_v(s, sf)),
    "missing_report": lambda s, sf: P.missing_report(_v(s, sf)),
    "describe_numeric": lambda s, sf: P.describe_numeric(_v(s, sf)),
    "describe_categorical": lambda s, sf: P.describe_categorical(_v(s, sf)),
    "value_counts": lambda s, sf: P.value_counts(_v(s, sf)),
    "fare_distribution": lambda s, sf: P.fare_distribution(_v(s, sf)),
    "iqr_outliers": lambda s, sf: P.iqr_outliers(_v(s, sf)),
    "corr_target": lambda s, sf: P.corr_target(_v(s, sf)),
    "corr_matrix": lambda s, sf: P.corr_matrix(_v(s, sf)),
    "fare_histogram": lambda s, sf: P.histogram(_v(s, sf)),
    "fare_skew": lambda s, sf: P.fare_skew(_v(s, sf)),
    "fare_summary": lambda s, sf: P.fare_summary(_v(s, sf)),
    "airline_fare_stats": lambda s, sf: P.grouped_fare_stats(_v(s, sf), "airline"),
    "median_fare_by_dim": lambda s, sf: P.median_by_dims(_v(s, sf)),
    "box_stats": lambda s, sf: P.box_stats(_v(s, sf)),
    # features and SQL-checkable model preparation
    "engineer_features": lambda s, sf: FE.engineer(_v(s, sf)).drop("pipeline_run_id"),
    "intl_counts": lambda s, sf: FE.intl_counts(FE.engineer(_v(s, sf))),
    "parse_lenient": lambda s, sf: _v(s, sf).select(
        "raw_id", lenient_timestamp(F.col("departure_time").cast("string")).alias("departure_parsed"),
        lenient_double(F.col("duration").cast("string")).alias("duration_parsed"),
        lenient_double("aircraft_type").alias("aircraft_type_numeric")),
    "derive_duration": lambda s, sf: _v(s, sf).select(
        "raw_id", hours_between("departure_time", "arrival_time").alias("duration_hrs_derived")),
    "encode_stops": lambda s, sf: _raw(s, sf).select(
        F.col("id").alias("raw_id"), "stops", encode_stops("stops").alias("stops_code")),
    "log_target": lambda s, sf: FE.log_target(_v(s, sf)).select(
        "raw_id", F.round("label", 8).alias("label")),
    "impute_nulls": lambda s, sf: FE.impute_nulls(
        _raw(s, sf).select("id", "tax_and_surcharge", "total_fare", "seasonality"),
        ["tax_and_surcharge", "total_fare"], ["seasonality"]),
    "label_encode": lambda s, sf: FE.label_vocabulary(FE.engineer(_v(s, sf))),
    "train_test_split": lambda s, sf: FE.split_assign(_v(s, sf)).select("raw_id", "split", "fold"),
    "standard_scale": _scaled,
    "regression_metrics": lambda s, sf: FE.regression_metrics(FE.baseline_predictions(_feat(s, sf))),
    "residual_summary": lambda s, sf: FE.residual_summary(FE.baseline_predictions(_feat(s, sf))),
    "dim_lookup": lambda s, sf: FE.dim_lookup(_v(s, sf)),
    "season_multiplier": lambda s, sf: FE.season_multiplier(FE.engineer(_v(s, sf))),
    # models (full presets, whole train split)
    "prepare": lambda s, sf: _feat(s, sf).drop("pipeline_run_id").withColumn("label", F.round("label", 8)),
    "train_linear": lambda s, sf: FM.linear_board(s, sf),
    "linear_cv": lambda s, sf: L.fold_scores(s, FM.linear(s, sf)),
    "coef_table": lambda s, sf: L.coef_table(s, FM.linear(s, sf)),
    "penalty_curve": lambda s, sf: FM.penalty_curve(s, sf),
    "train_tree": lambda s, sf: FM.tree_board(s, sf),
    "cross_validate": lambda s, sf: L.fold_scores(s, FM.linear(s, sf)).unionByName(FM.tree_folds(s, sf)),
    "validation_curve": lambda s, sf: FM.depth_curve(s, sf).unionByName(FM.penalty_curve(s, sf)),
    "feature_importance": lambda s, sf: FM.feature_importance(s, sf),
    "batch_score": lambda s, sf: FM.batch_score(s, sf),
    "batch_rejects": lambda s, sf: FM.batch_rejects(s, sf),
}
