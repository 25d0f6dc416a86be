"""KPI batch for one run: five KPI tables plus a run summary.

The run's validated rows come from a partition-pruned scan; the two route
KPIs share one (route, airline) aggregate, persisted while the batch runs
(it is small: routes x airlines rows, and recomputable from the scan if an
executor is lost).
"""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from skyledger.operators import marts as M
from skyledger.schemas import TOP_N_ROUTES
from skyledger.sources.tables import replace_table, scan_run


def compute_all_kpis(spark: SparkSession, validated_path: str, run_id: str,
                     top_n_routes: int = TOP_N_ROUTES, out_root: str | None = None) -> dict:
    """Returns ``{"summary": dict, "kpis": {name: DataFrame}}``; raises
    ``ValueError`` when the run has no validated rows. With ``out_root`` each
    KPI is written (replacing the previous table) with a ``computed_at`` stamp.
    """
    v = scan_run(spark, validated_path, run_id)
    if v.isEmpty():
        raise ValueError(f"No validated rows found for run_id={run_id}")
    ra = M.route_airline_agg(v).persist()
    try:
        kpis = {
            "kpi_avg_fare_by_airline": M.kpi_avg_fare_by_airline(v, run_id),
            "kpi_seasonal_fare_variation": M.kpi_seasonal_premium(v, run_id),
            "kpi_booking_count_by_airline": M.kpi_booking_count(v, run_id),
            "kpi_popular_routes": M.kpi_popular_routes_topn(v, run_id, top_n_routes, ra=ra),
            "kpi_route_airline_performance": M.kpi_route_airline(v, run_id, ra=ra),
        }
        summary = M.kpi_run_summary(v, run_id, top_n_routes).first().asDict()
        summary["run_id"] = summary.pop("pipeline_run_id", run_id)
        if out_root:
            for name, df in kpis.items():
                replace_table(df.withColumn("computed_at", F.current_timestamp()),
                              f"{out_root.rstrip('/')}/{name}")
    finally:
        if out_root:
            ra.unpersist()
    return {"summary": summary, "kpis": kpis}
