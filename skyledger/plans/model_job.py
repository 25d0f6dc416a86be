"""Fare-model run: features -> profile -> train all -> tune -> leaderboard -> save.

    spark-submit --py-files skyledger.zip skyledger/plans/model_job.py \
        --validated <validated table> --out <shared folder> [--run-id ID]

Every step is a Spark job; the leaderboard (one row per model) is written as
a single CSV, the profile tables as parquet, the best model with Spark ML
persistence.
"""

from __future__ import annotations

import argparse
import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyledger.operators import models as ML
from skyledger.operators import profile as P
from skyledger.operators.features import engineer, log_target, split_assign
from skyledger.sources.csv import write_csv
from skyledger.sources.tables import scan_run


def run_fare_model(spark: SparkSession, validated: DataFrame, out: str, specs: list[ML.ModelSpec] | None = None,
                   grid: list[dict] | None = None, with_profile: bool = True) -> dict:
    """``specs`` and ``grid`` replace the registry's presets and the search draws."""
    out = out.rstrip("/")
    feats_path = f"{out}/features"
    log_target(split_assign(engineer(validated))).write.mode("overwrite").parquet(feats_path)
    feats = spark.read.parquet(feats_path)
    if with_profile:
        for name, df in P.profile(validated).items():
            df.write.mode("overwrite").parquet(f"{out}/eda/{name}")
    res = ML.train_all(spark, feats, specs, vectors_path=f"{out}/model_vectors")
    tuned_row, tuned_model, search = ML.tune_gbt(spark, res.vectors, grid, prep=res.prep)
    board = ML.combined_leaderboard(res.leaderboard, tuned_row)
    write_csv(board, f"{out}/model_comparison", single_file=True)  # <= 9 rows
    search.write.mode("overwrite").parquet(f"{out}/tuning_search")
    best = board.first()["model"]
    model = tuned_model if best == "XGBoost (Tuned)" else res.models[best]
    model.write().overwrite().save(f"{out}/best_model")
    return {"best_model": best, "models": board.count(), "out": out}


def main(argv: list[str] | None = None) -> dict:
    from skyledger.session import build_session
    ap = argparse.ArgumentParser(description="fare model run")
    ap.add_argument("--validated", required=True)
    ap.add_argument("--out", required=True)
    ap.add_argument("--run-id", default=None)
    ap.add_argument("--master", default=None)
    args = ap.parse_args(argv)
    spark = build_session(args.master, app="skyledger-fare-model")
    v = scan_run(spark, args.validated, args.run_id).where(F.col("validation_status") != "flagged")
    out = run_fare_model(spark, v, args.out)
    print(json.dumps(out))
    return out


if __name__ == "__main__":
    main()
