"""spark-submit entry point for the daily run.

    spark-submit --py-files skyledger.zip skyledger/plans/daily_job.py \
        --csv <drop folder> --warehouse <shared folder> [--run-id ID] [--top-n 20]

Runs ingest -> land -> validate (+ audit, run log) -> transfer -> SQL marts,
then the KPI batch for the run, writing every table under ``--warehouse``.
Prints one JSON line with the run id and row counts.
"""

from __future__ import annotations

import argparse
import json

from skyledger.plans.etl import Warehouse, run_daily_csv
from skyledger.plans.kpis import compute_all_kpis
from skyledger.schemas import TOP_N_ROUTES
from skyledger.session import build_session


def main(argv: list[str] | None = None) -> dict:
    ap = argparse.ArgumentParser(description="daily booking pipeline")
    ap.add_argument("--csv", required=True, help="folder or file(s) of booking CSV")
    ap.add_argument("--warehouse", required=True, help="root folder for all tables (shared storage)")
    ap.add_argument("--run-id", default=None)
    ap.add_argument("--top-n", type=int, default=TOP_N_ROUTES)
    ap.add_argument("--master", default=None, help="only for local runs, e.g. local[8]")
    args = ap.parse_args(argv)

    spark = build_session(args.master, app="skyledger-daily")
    wh = Warehouse(args.warehouse)
    info = run_daily_csv(spark, args.csv, wh, args.run_id)
    kpis = compute_all_kpis(spark, wh.validated, info["run_id"], args.top_n, out_root=wh.path("kpis"))
    out = {"run_id": info["run_id"], "rows": info["rows"], "validated_rows": info["validated_rows"],
           "rows_transferred": info["rows_transferred"], "summary": kpis["summary"]}
    print(json.dumps(out, default=str))
    return out


if __name__ == "__main__":
    main()
